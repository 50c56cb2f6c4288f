"""Hourly and daily sums of the point table, and window means over long ranges that read them instead of points.

{path}/hours and {path}/days hold, per series and hour or day, the number of values, their sum and extremes. They are laid
out by day like the points. A call of `write_points` touches some days; only those are summed up again. (number, sum, least,
largest) can be merged, so a window takes whole days from the rollups, and points only at the two ends of a range.
"""

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from gaugeline.functions.durations import MICROS, parse_duration, window_bounds
from gaugeline.operators.aggregates import PLACE
from gaugeline.operators.filters import any_of
from gaugeline.plans.joins import broadcast_if_small
from gaugeline.plans.scratch import materialize
from gaugeline.schemas import SERIES_KEY
from gaugeline.sources.tables import read_points, write_points

UNITS = {"hours": "hour", "days": "day"}


def summed(rows: DataFrame, unit: str, time: str = "ts") -> DataFrame:
    """Points per series and unit of time; rollups of a smaller unit can be given as well."""
    at = F.date_trunc(unit, time).cast(dict(rows.dtypes)[time]).alias(time)
    if "n" in rows.columns:
        parts = [F.sum("n"), F.sum("total"), F.min("lo"), F.max("hi")]
    else:
        parts = [F.count("value"), F.sum("value"), F.min("value"), F.max("value")]
    named = [p.alias(name) for p, name in zip(parts, ("n", "total", "lo", "hi"), strict=True)]
    return rows.groupBy(*SERIES_KEY, at, "date").agg(*named)


def write_points_and_rollups(readings: DataFrame, points: str, rollups: str, time: str = "ts", arrival: str = "id", files_per_day: int = 1) -> None:
    """`write_points`, and the rollups of the days that `readings` touch. Many series need more files a day."""
    spark = readings.sparkSession
    days = materialize(readings.select(F.to_date(time).alias("_day")).distinct(), "touched-days")
    write_points(readings, points, time, arrival)
    there = spark.read.parquet(points)
    touched = there.join(broadcast_if_small(days), F.col("date").eqNullSafe(F.col("_day")), "left_semi")
    rows = touched
    for name, unit in UNITS.items():
        rows = summed(rows, unit, time)
        spread = rows.repartition("date", F.pmod(F.xxhash64(*SERIES_KEY), F.lit(files_per_day)))
        spread = spread.sortWithinPartitions("date", "sensor_id", time).write.partitionBy("date")
        spread.option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(f"{rollups}/{name}")
        rows = spark.read.parquet(f"{rollups}/{name}").join(broadcast_if_small(days), F.col("date").eqNullSafe(F.col("_day")), "left_semi")


def _midnight(moment: datetime) -> datetime:
    return moment.replace(hour=0, minute=0, second=0, microsecond=0)


def range_parts(
    spark: SparkSession, points: str, rollups: str, start: datetime, stop: datetime, every: str, time: str = "ts"
) -> tuple[list[DataFrame], DataFrame | None]:
    """(points at the ends of [start, stop), rollups of the whole days between them).

    Days answer windows of whole days or months, hours those of whole hours; other lengths need the points.
    """
    length = parse_duration(every)
    unit = "days" if length.months or length.micros % MICROS["d"] == 0 else "hours" if length.micros % MICROS["h"] == 0 else None
    first = _midnight(start) if start == _midnight(start) else _midnight(start) + timedelta(days=1)
    last = _midnight(stop)
    if unit is None or first >= last:
        return [read_points(spark, points, start, stop, time)], None
    ends = [read_points(spark, points, a, b, time) for a, b in ((start, first), (last, stop)) if a < b]
    whole = spark.read.parquet(f"{rollups}/{unit}").filter((F.col("date") >= F.lit(first.date())) & (F.col("date") < F.lit(last.date())))
    return ends, whole


def window_mean_of_points(
    spark: SparkSession, points: str, rollups: str, start: datetime, stop: datetime, every: str = "1h",
    sensor_types: Sequence[str] | None = None, locations: Sequence[str] | None = None, time: str = "ts", collapse: bool = False,
) -> DataFrame:
    """`window_mean` over the stored points of [start, stop): the same rows, mostly from rollups."""
    ends, whole = range_parts(spark, points, rollups, start, stop, every, time)
    columns = [*SERIES_KEY, time, "n", "total"]
    value = F.col("value")
    parts = [e.select(*SERIES_KEY, time, F.when(value.isNotNull(), 1).otherwise(0).cast("bigint").alias("n"), value.alias("total")) for e in ends]
    parts += [] if whole is None else [whole.select(*columns)]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    rows = any_of(any_of(rows, "sensor_type", sensor_types), "location", locations)
    begin, end = window_bounds(time, parse_duration(every))
    key = PLACE if collapse else SERIES_KEY
    kind = dict(rows.dtypes)[time]
    mean = (F.sum("total") / F.nullif(F.sum("n"), F.lit(0))).alias("mean_value")
    means = rows.groupBy(begin.alias("_begin"), end.alias("_end"), *key).agg(mean)
    clipped = F.least(F.col("_end").cast(kind), F.lit(stop).cast(kind))
    return means.select(clipped.alias("timestamp"), *key, "mean_value", F.lit(every).alias("window"))
