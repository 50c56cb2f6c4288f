"""Trailing row-frame statistics: the z-score that flags anomalies, and the per-sensor features of the models."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from gaugeline.plans.chunks import CHUNK, OWN, ROWS_PER_CHUNK, split_groups
from gaugeline.schemas import ALARM_STATUSES

ORDER = ("ts", "id")
PRECEDING = 100
Z_LIMIT = 3.0
EPSILON = 1e-6


def nan_to_null(name: str) -> Column:
    """A NaN would poison every frame it is in and compare above any limit; a null is skipped."""
    return F.nanvl(F.col(name), F.lit(None).cast("double"))


def _ordered(keys: Sequence[str], order: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*keys, CHUNK).orderBy(*order)


def rolling_zscore(
    df: DataFrame,
    keys: Sequence[str] = ("sensor_type", "location"),
    order: Sequence[str] = ORDER,
    preceding: int = PRECEDING,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Mean over the row and the `preceding` ones before it, the root mean square of each row's distance to its own
    trailing mean over the same frame, and the z-score from both."""
    clean = df.withColumn("value", nan_to_null("value"))
    # Each mean looks `preceding` rows back and the deviation looks that far back over means.
    parts = split_groups(clean, keys, order, halo=2 * preceding, rows_per_chunk=rows_per_chunk)
    frame = _ordered(keys, order).rowsBetween(-preceding, 0)
    scored = parts.rows.withColumn("rolling_mean", F.avg("value").over(frame)).withColumn(
        "rolling_std", F.sqrt(F.avg(F.pow(F.col("value") - F.col("rolling_mean"), F.lit(2))).over(frame))
    )
    distance = F.abs(F.col("value") - F.col("rolling_mean"))
    z = F.when(F.col("rolling_std") > 0, distance / F.col("rolling_std")).otherwise(F.lit(0.0))
    return scored.withColumn("z_score", z).filter(OWN).drop(CHUNK, OWN)


def flag_anomalies(scored: DataFrame, z_limit: float = Z_LIMIT) -> DataFrame:
    """Statistical flag, status flag, and either of them; a missing status leaves the status flag null."""
    return scored.withColumns(
        {
            "is_anomaly_statistical": F.col("z_score") > z_limit,
            "is_anomaly_status": F.col("status").isin(*ALARM_STATUSES),
        }
    ).withColumn("is_anomaly", F.col("is_anomaly_statistical") | F.col("is_anomaly_status"))


def detect_anomalies(df: DataFrame, **options) -> DataFrame:
    return flag_anomalies(rolling_zscore(df, **options))


def only_anomalies(flagged: DataFrame) -> DataFrame:
    return flagged.filter("is_anomaly")


CALENDAR_FEATURES = ("hour", "day_of_week", "month")
# The model features.
FEATURES = (
    "value",
    "hour",
    "day_of_week",
    "month",
    "rolling_mean_5",
    "rolling_std_5",
    "rolling_mean_20",
    "rolling_std_20",
    "value_diff",
    "value_diff_abs",
    "deviation_from_mean_5",
    "deviation_from_mean_20",
    "z_score_5",
    "z_score_20",
)


def raw_features(
    df: DataFrame,
    sensor: str = "sensor_id",
    order: Sequence[str] = ORDER,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """The 14 model features of every reading, nulls not yet filled. One shuffle, by sensor."""
    clean = df.withColumn("value", nan_to_null("value"))
    parts = split_groups(clean, [sensor], order, halo=19, rows_per_chunk=rows_per_chunk)
    by_time = _ordered([sensor], order)
    last_5, last_20 = by_time.rowsBetween(-4, 0), by_time.rowsBetween(-19, 0)
    value, time = F.col("value"), F.col(order[0])
    rolled = parts.rows.select(
        "*",
        F.avg("value").over(last_5).alias("rolling_mean_5"),
        F.stddev_samp("value").over(last_5).alias("rolling_std_5"),
        F.avg("value").over(last_20).alias("rolling_mean_20"),
        F.stddev_samp("value").over(last_20).alias("rolling_std_20"),
        (value - F.lag("value", 1).over(by_time)).alias("value_diff"),
    )
    with_derived = {
        "hour": F.hour(time),
        "day_of_week": F.weekday(time),
        "month": F.month(time),
        "value_diff_abs": F.abs("value_diff"),
    }
    for n in (5, 20):
        offset = value - F.col(f"rolling_mean_{n}")
        with_derived[f"deviation_from_mean_{n}"] = F.abs(offset)
        with_derived[f"z_score_{n}"] = offset / (F.col(f"rolling_std_{n}") + F.lit(EPSILON))
    return rolled.filter(OWN).drop(CHUNK, OWN).withColumns(with_derived)
