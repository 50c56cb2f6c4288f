"""Quantiles of growing data from mergeable sketches: one KLL sketch per group and day, merged for any range of days.

A day that gets new rows is sketched anew, the others stay; a range costs as many rows as it has days. The error is one
of rank, the same for merged sketches as for one over all rows: with k = 800 it stays under RANK_ERROR of the rows with
more than 99 % probability, so a caller who needs the exact value knows the few rows among which it lies.
"""

from datetime import date

from pyspark.sql import DataFrame, functions as F

SKETCH_K = 800
RANK_ERROR = 0.005  # the bound for k = 800, with room


def quantile_sketches(df: DataFrame, group: str = "sensor_type", value: str = "value", time: str = "ts", k: int = SKETCH_K) -> DataFrame:
    """(group, date, n, lo, hi, sketch) of the values that are numbers; built before the shuffle, a few KB each."""
    rows = df.filter(F.col(value).isNotNull() & ~F.isnan(value)).withColumn("date", F.to_date(time))
    return rows.groupBy(group, "date").agg(
        F.count("*").alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi"), F.kll_sketch_agg_double(value, F.lit(k)).alias("sketch")
    )


def update_sketches(df: DataFrame, path: str, group: str = "sensor_type", value: str = "value", time: str = "ts") -> None:
    """Store the sketches of whole days, in place of those of the same days."""
    rows = quantile_sketches(df, group, value, time).repartition("date").sortWithinPartitions("date", group)
    rows.write.partitionBy("date").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def merged_quantile(
    sketches: DataFrame, q: float, start: date | None = None, stop: date | None = None, group: str = "sensor_type"
) -> DataFrame:
    """(group, n, quantile) over the days of [start, stop): a value that is there, whose rank is within RANK_ERROR of q."""
    chosen = sketches
    if start is not None:
        chosen = chosen.filter(F.col("date") >= F.lit(start))
    if stop is not None:
        chosen = chosen.filter(F.col("date") < F.lit(stop))
    merged = chosen.groupBy(group).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))
    return merged.select(group, "n", F.kll_sketch_get_quantile_double("sketch", F.lit(q)).alias("quantile"))


def rank_bounds(df: DataFrame, quantiles: DataFrame, group: str = "sensor_type", value: str = "value") -> DataFrame:
    """(group, n, below, up_to): how many values lie below the quantile, and up to it, counted exactly."""
    rows = df.filter(F.col(value).isNotNull() & ~F.isnan(value)).select(group, F.col(value).alias("v"))
    # One row a group, from an aggregate over days.
    joined = rows.join(quantiles.select(group, "quantile"), group)
    return joined.groupBy(group).agg(
        F.count("*").alias("n"), F.count_if(F.col("v") < F.col("quantile")).alias("below"), F.count_if(F.col("v") <= F.col("quantile")).alias("up_to")
    )
