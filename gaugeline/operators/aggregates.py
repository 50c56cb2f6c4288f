"""Tumbling-window aggregates by sensor type and location, and window means per series."""

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from gaugeline.functions.durations import parse_duration, window_bounds
from gaugeline.operators.changes import assign_ids
from gaugeline.operators.filters import any_of, in_time_range
from gaugeline.plans.joins import lookup_join
from gaugeline.schemas import SERIES_KEY

PLACE = ("sensor_type", "location")


def anomaly_count() -> Column:
    """Rows flagged as anomalous; a null flag counts as no anomaly."""
    return F.sum(F.when(F.col("is_anomaly"), 1).otherwise(0))


def _flat(windowed: DataFrame) -> DataFrame:
    rest = [c for c in windowed.columns if c != "window"]
    return windowed.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest)


def minute_aggregate(
    df: DataFrame, time: str = "ts", length: str = "1 minute", sensor_ids: str = "none"
) -> DataFrame:
    """Count, mean, extremes, sample deviation and anomalies per window, type and location: one mergeable aggregate.

    The sensors of a window are rows of `window_sensors`. On request they become one column: sensor_ids "counts"
    gives an array of (sensor_id, n), "list" repeats every id n times (null ids are left out). Then rows are first reduced
    to one per sensor and window, and the row of a window grows with its sensors. "sketch" gives their number, estimated
    from a sketch of bounded size (within about 2 %), as `sensors`. Works on a stream that carries a watermark on `time`.
    """
    if sensor_ids not in ("counts", "list", "none", "sketch"):
        raise ValueError(f"unknown form of sensor ids {sensor_ids!r}")
    value = F.col("value")
    if sensor_ids in ("none", "sketch"):
        sensors = F.hll_sketch_estimate(F.hll_sketch_agg("sensor_id")).alias("sensors")
        return _flat(
            df.groupBy(F.window(time, length), *PLACE).agg(
                F.count("*").alias("reading_count"),
                F.avg(value).alias("avg_value"),
                F.min(value).alias("min_value"),
                F.max(value).alias("max_value"),
                anomaly_count().alias("anomaly_count"),
                F.stddev_samp(value).alias("stddev_value"),
                *([sensors] if sensor_ids == "sketch" else []),
            )
        )
    per_sensor = df.groupBy(F.window(time, length), *PLACE, "sensor_id").agg(
        F.count("*").alias("n"),
        F.count(value).alias("n_value"),
        F.sum(value).alias("total"),
        F.avg(value).alias("mean"),
        (F.var_pop(value) * F.count(value)).alias("squares"),
        F.min(value).alias("lo"),
        F.max(value).alias("hi"),
        anomaly_count().alias("anomalies"),
    )
    by_place = per_sensor.groupBy("window", *PLACE).agg(
        F.sum("n").alias("reading_count"),
        (F.sum("total") / F.nullif(F.sum("n_value"), F.lit(0))).alias("avg_value"),
        F.min("lo").alias("min_value"),
        F.max("hi").alias("max_value"),
        F.sum("n_value").alias("_n"),
        F.sum("anomalies").alias("anomaly_count"),
        F.collect_list(F.struct("sensor_id", "n", "n_value", "mean", "squares")).alias("_parts"),
    )
    # Deviations of the parts are merged around the common mean; a difference of large sums would lose digits.
    squares = F.aggregate(
        F.filter("_parts", lambda p: p["n_value"] > 0),
        F.lit(0.0),
        lambda acc, p: acc + p["squares"] + p["n_value"] * F.pow(p["mean"] - F.col("avg_value"), F.lit(2)),
    )
    named = F.filter("_parts", lambda p: p["sensor_id"].isNotNull())
    ids = F.array_sort(F.transform(named, lambda p: F.struct(p["sensor_id"], p["n"])))
    merged = by_place.withColumn("stddev_value", F.when(F.col("_n") > 1, F.sqrt(squares / (F.col("_n") - 1))))
    if sensor_ids == "counts":
        merged = merged.withColumn("sensor_ids", ids)
    else:
        merged = merged.withColumn(
            "sensor_ids", F.flatten(F.transform(ids, lambda p: F.array_repeat(p["sensor_id"], p["n"].cast("int"))))
        )
    return _flat(merged.drop("_n", "_parts"))


def window_sensors(df: DataFrame, time: str = "ts", length: str = "1 minute") -> DataFrame:
    """Sensors of every window, type and location with their number of readings, a row each."""
    counted = df.groupBy(F.window(time, length), *PLACE, "sensor_id").agg(F.count("*").alias("n"))
    return _flat(counted)


def sensor_numbers(df: DataFrame) -> DataFrame:
    """(sensor_id, number): all sensors, numbered from 1 without gaps."""
    return assign_ids(df.select("sensor_id").filter("sensor_id IS NOT NULL").distinct(), 0, "number")


def window_bitmaps(df: DataFrame, numbers: DataFrame, time: str = "ts", length: str = "1 minute") -> DataFrame:
    """Sensors of every window, type and location as bitmaps over their numbers, one for each 32,768 numbers, and the
    readings behind them.

    A bitmap has a fixed size, is built before the shuffle, and can be merged into those of longer windows; see
    `merged_bitmaps`. Sensors without a number are left out. Works on a watermarked stream with a static `numbers`.
    """
    numbered = lookup_join(df, numbers, ["sensor_id"], "inner")
    bucket, bit = F.bitmap_bucket_number("number").alias("bucket"), F.bitmap_bit_position("number")
    grouped = numbered.groupBy(F.window(time, length), *PLACE, bucket)
    return _flat(grouped.agg(F.count("*").alias("readings"), F.bitmap_construct_agg(bit).alias("sensors")))


def merged_bitmaps(bitmaps: DataFrame, length: str) -> DataFrame:
    """Bitmaps of longer windows from those of shorter ones that they consist of."""
    longer = F.window("window_start", length)
    grouped = bitmaps.drop("window_end").groupBy(longer, *PLACE, "bucket")
    return _flat(grouped.agg(F.sum("readings").alias("readings"), F.bitmap_or_agg("sensors").alias("sensors")))


def bitmap_counts(bitmaps: DataFrame) -> DataFrame:
    """Readings and the exact number of sensors per window, type and location."""
    grouped = bitmaps.groupBy("window_start", "window_end", *PLACE)
    return grouped.agg(F.sum("readings").alias("readings"), F.sum(F.bitmap_count("sensors")).alias("sensors"))


def bitmap_sensors(bitmaps: DataFrame, numbers: DataFrame) -> DataFrame:
    """The sensors behind bitmaps, a row each."""
    bit = F.bitmap_bit_position("number")
    placed = numbers.select("sensor_id", F.bitmap_bucket_number("number").alias("bucket"), bit.alias("_bit"))
    byte = F.conv(F.hex(F.substring("sensors", (F.floor(F.col("_bit") / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_set = F.getbit(byte, (F.col("_bit") % 8).cast("int")) == 1
    found = lookup_join(bitmaps, placed, ["bucket"], "inner").filter(is_set)
    return found.select("window_start", "window_end", *PLACE, "sensor_id")


def hour_aggregate(df: DataFrame, time: str = "ts", length: str = "1 hour") -> DataFrame:
    """Count, mean, extremes and anomalies per window, type and location. Works on a watermarked stream."""
    return _flat(
        df.groupBy(F.window(time, length), *PLACE).agg(
            F.count("*").alias("reading_count"),
            F.avg("value").alias("avg_value"),
            F.min("value").alias("min_value"),
            F.max("value").alias("max_value"),
            anomaly_count().alias("anomaly_count"),
        )
    )


def window_mean(
    df: DataFrame,
    start: datetime | str,
    stop: datetime | str,
    every: str = "1h",
    sensor_types: Sequence[str] | None = None,
    locations: Sequence[str] | None = None,
    time: str = "ts",
    collapse: bool = False,
) -> DataFrame:
    """Mean per series and window over [start, stop). The time of a result is the end of its window, or `stop` if that
    is earlier; windows without rows give no result. collapse=True joins the series of a type and location."""
    chosen = in_time_range(df, start, stop, time)
    chosen = any_of(any_of(chosen, "sensor_type", sensor_types), "location", locations)
    begin, end = window_bounds(time, parse_duration(every))
    key = PLACE if collapse else SERIES_KEY
    time_type = dict(df.dtypes)[time]
    means = chosen.groupBy(begin.alias("_begin"), end.alias("_end"), *key).agg(F.avg("value").alias("mean_value"))
    clipped = F.least(F.col("_end").cast(time_type), F.lit(stop).cast(time_type))
    return means.select(clipped.alias("timestamp"), *key, "mean_value", F.lit(every).alias("window"))
