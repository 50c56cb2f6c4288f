"""Sensor registry: what each sensor last reported and how often it reported."""

from pyspark.sql import DataFrame, functions as F

from gaugeline.operators.filters import equals

STATE = ("sensor_type", "location", "status")


def sensor_registry(df: DataFrame, time: str = "ts", arrival: str = "id") -> DataFrame:
    """Per sensor the type, location, status and time of the reading that arrived last, and the number of readings.

    The first grouping carries numbers only, so it hash-aggregates before the shuffle however many rows a sensor has;
    the second one sees a row per sensor and state.
    """
    per_state = df.groupBy("sensor_id", *STATE).agg(
        F.count("*").alias("n"), F.max(arrival).alias("arrived"), F.max_by(time, arrival).alias("last_seen")
    )
    last = F.max_by(F.struct(*STATE, "last_seen"), "arrived").alias("last")
    return per_state.groupBy("sensor_id").agg(last, F.sum("n").alias("total_readings")).select(
        "sensor_id",
        "last.sensor_type",
        "last.location",
        "last.last_seen",
        "last.status",
        "total_readings",
    )


def merge_registry(current: DataFrame, update: DataFrame) -> DataFrame:
    """Registry after the readings summed up in `update`, which arrived later than those behind `current`."""
    both = current.withColumn("_age", F.lit(0)).unionByName(update.withColumn("_age", F.lit(1)))
    last = F.max_by(F.struct("sensor_type", "location", "last_seen", "status"), "_age").alias("last")
    return both.groupBy("sensor_id").agg(last, F.sum("total_readings").alias("total_readings")).select(
        "sensor_id", "last.*", "total_readings"
    )


def list_sensors(
    registry: DataFrame, sensor_type: str | None = None, location: str | None = None, time_type: str = "timestamp"
) -> DataFrame:
    """Registry rows, optionally of one type or location. Stored text is converted; a missing status reads "unknown",
    a missing count 0."""
    chosen = equals(registry, sensor_type=sensor_type, location=location)
    return chosen.select(
        "sensor_id",
        "sensor_type",
        "location",
        F.col("last_seen").try_cast(time_type).alias("last_seen"),
        F.coalesce("status", F.lit("unknown")).alias("status"),
        F.coalesce(F.col("total_readings").try_cast("bigint"), F.lit(0)).alias("total_readings"),
    )


def latest_points(df: DataFrame, time: str = "ts", arrival: str = "id") -> DataFrame:
    """Time-series points: one value per series and time, the last arrived one. Unit and metadata are not kept."""
    points = df.groupBy("sensor_id", "sensor_type", "location", "status", time).agg(
        F.max_by("value", arrival).alias("value")
    )
    return points.withColumn("date", F.to_date(time))
