"""Standard scaling with the population deviation, fitted for all model keys in one aggregate."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from gaugeline.plans.joins import broadcast_if_small


def fit_scaler(features: DataFrame, columns: Sequence[str], group: str = "sensor_type") -> DataFrame:
    """One row per group and feature: mean and scale; a constant feature has scale 1."""
    stats = features.groupBy(group).agg(
        *[F.avg(c).alias(f"_mean_{c}") for c in columns], *[F.stddev_pop(c).alias(f"_std_{c}") for c in columns]
    )
    params = F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("feature"),
                    F.col(f"_mean_{c}").alias("mean"),
                    F.when(F.col(f"_std_{c}") > 0, F.col(f"_std_{c}")).otherwise(F.lit(1.0)).alias("scale"),
                )
                for c in columns
            ]
        )
    )
    return stats.select(group, params)


def apply_scaler(
    features: DataFrame, params: DataFrame, columns: Sequence[str], group: str = "sensor_type"
) -> DataFrame:
    """Replace `columns` by (value - mean) / scale. Rows of a group without parameters are dropped."""
    wide = params.groupBy(group).agg(
        *[F.max(F.when(F.col("feature") == c, F.col("mean"))).alias(f"_mean_{c}") for c in columns],
        *[F.max(F.when(F.col("feature") == c, F.col("scale"))).alias(f"_scale_{c}") for c in columns],
    )
    joined = features.join(broadcast_if_small(wide), group)
    scaled = {c: (F.col(c) - F.col(f"_mean_{c}")) / F.col(f"_scale_{c}") for c in columns}
    return joined.withColumns(scaled).select(*features.columns)
