"""Reads of the readings table: newest rows, one row, history of a sensor, statistics."""

from collections.abc import Sequence
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame, Window, functions as F

from gaugeline.functions.text import to_second
from gaugeline.operators.filters import default_range, in_time_range
from gaugeline.schemas import SERIES_KEY

TABLE_COLUMNS = ("sensor_id", "sensor_type", "value", "unit", "ts", "location")
SALTS = 64


def recent(df: DataFrame, limit: int = 100, columns: Sequence[str] = TABLE_COLUMNS) -> DataFrame:
    """The newest rows by id, newest first. Every task keeps only its own top rows."""
    return df.orderBy(F.desc("id")).limit(limit).select(*columns)


def recent_page(df: DataFrame, newest: int = 10, last: int = 5, time: str = "ts") -> DataFrame:
    """The last `last` of the `newest` rows by id, with the time cut to the second."""
    top = df.orderBy(F.desc("id")).limit(newest)
    page = top.offset(max(newest - last, 0))
    return page.select("id", "sensor_id", "value", "unit", to_second(F.col(time)).alias("time"))


def reading_by_id(df: DataFrame, reading_id: int, columns: Sequence[str] = TABLE_COLUMNS) -> DataFrame:
    """The row with this id; an empty result means it does not exist."""
    return df.filter(F.col("id") == reading_id).select(*columns)


def series_limit(
    df: DataFrame, n: int, key: Sequence[str] = SERIES_KEY, order: Sequence[str] = ("ts", "id")
) -> DataFrame:
    """The oldest `n` rows of every series. A salted first round keeps at most n rows per series and salt, so a series
    that fills the table is not sorted in one task."""
    salt = F.pmod(F.xxhash64(*order), F.lit(SALTS)).alias("_salt")
    kept = df.select("*", salt)
    for part in ((*key, "_salt"), tuple(key)):
        rank = F.row_number().over(Window.partitionBy(*part).orderBy(*order))
        kept = kept.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")
    return kept.drop("_salt")


def sensor_history(
    df: DataFrame,
    sensor_id: str,
    now: datetime,
    start: datetime | None = None,
    stop: datetime | None = None,
    limit: int = 1000,
    time: str = "ts",
    ties: Sequence[str] = ("id",),
) -> DataFrame:
    """Rows of one sensor in [start, stop), the oldest `limit` of each of its series. Points have no `ties`."""
    chosen = in_time_range(df, *default_range(now, start, stop), time).filter(F.col("sensor_id") == sensor_id)
    rows = series_limit(chosen, limit, order=(time, *ties))
    return rows.select(F.col(time).alias("timestamp"), "sensor_id", "value", "sensor_type", "location")


def distinct_sensors(df: DataFrame) -> DataFrame:
    return df.select("sensor_id").distinct()


class Statistics(NamedTuple):
    summary: DataFrame
    sensors: DataFrame


def statistics(df: DataFrame, time: str = "ts") -> Statistics:
    """One row with the number of readings, of sensors, and the latest reading (the highest id among equal times), and
    the sensors as rows of their own: a list of unknown length stays distributed."""
    names = [c for c in TABLE_COLUMNS if c != "ts"] + [time]
    newest = [F.max_by(F.struct(*names), F.struct(time, "id")).alias("latest"), F.max(F.struct(time, "id")).alias("at")]
    # One scan: a row per sensor, then one row over these; readings without a sensor make a row that counts as a sensor.
    by_sensor = df.groupBy("sensor_id").agg(F.count("*").alias("n"), *newest)
    merged = by_sensor.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_readings"),
        F.count("*").alias("unique_sensors"),
        F.max_by("latest", "at").alias("latest"),
    )
    latest = [F.col(f"latest.{c}").alias(f"latest_{c}") for c in names]
    return Statistics(merged.select("total_readings", "unique_sensors", *latest), distinct_sensors(df))
