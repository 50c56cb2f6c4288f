"""Parquet tables of readings and points."""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from gaugeline.operators.filters import in_time_range
from gaugeline.operators.registry import latest_points
from gaugeline.operators.validate import REQUIRED_IN_TABLE, require_columns
from gaugeline.plans.joins import broadcast_if_small
from gaugeline.plans.scratch import materialize, path_exists
from gaugeline.schemas import READINGS_TABLE, SERIES_KEY
from gaugeline.sources.stored import StoredTable


def create_readings(spark: SparkSession, path: str, **options) -> StoredTable:
    """The readings table at `path`, created empty unless there is one."""
    return StoredTable.create(spark, path, READINGS_TABLE, **options)


def append_readings(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """Append rows under new ids and return those that a NOT NULL column rejects."""
    checked = require_columns(rows, REQUIRED_IN_TABLE)
    StoredTable(spark, path).append(checked.valid)
    return checked.quarantine


def write_points(readings: DataFrame, path: str, time: str = "ts", arrival: str = "id") -> None:
    """Merge the points of `readings` into the table: one value per series and time, where a later call wins.

    The table is laid out by day, sorted by sensor and time, so that a time range prunes folders and a sensor prunes row
    groups; see `read_points`. Only days that the new points touch are read and written again. A busy day is spread
    over files by sensor and hour.
    """
    spark = readings.sparkSession
    points = latest_points(readings, time, arrival)
    if path_exists(spark, path):
        points = materialize(points, "points-new")
        days = broadcast_if_small(points.select(F.col("date").alias("_day")).distinct())
        there = spark.read.parquet(path)
        touched = there.join(days, F.col("date").eqNullSafe(F.col("_day")), "left_semi")
        both = touched.withColumn("_call", F.lit(0)).unionByName(points.withColumn("_call", F.lit(1)))
        merged = both.groupBy(*SERIES_KEY, time, "date").agg(F.max_by("value", "_call").alias("value"))
        points = materialize(merged, "points-merged")  # the days cannot be read while they are replaced
    spread = points.repartition("date", "sensor_id", F.date_trunc("hour", time))
    rows = spread.sortWithinPartitions("date", "sensor_id", time).write.partitionBy("date")
    rows.option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def read_points(
    spark: SparkSession, path: str, start: datetime | str, stop: datetime | str, time: str = "ts"
) -> DataFrame:
    """Points of [start, stop); days outside are not opened."""
    rows = in_time_range(spark.read.parquet(path), start, stop, time)
    return rows.filter(F.col("date").between(F.lit(start).cast("date"), F.lit(stop).cast("date")))
