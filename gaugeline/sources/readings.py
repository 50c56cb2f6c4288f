"""Where readings come from: the readings table and the mapping of a generic event table."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from gaugeline.sources.stored import StoredTable

# Units of the event types that stand in for sensor types.
EVENT_UNITS = {"click": "clicks", "error": "errors", "purchase": "EUR", "signup": "users", "view": "views"}
EVENT_RANGE = (1.0, 150.0)
SENSORS_PER_TYPE = 20
LOCATIONS = 11


def readings_from_events(events: DataFrame) -> DataFrame:
    """View an event table as readings: one sensor per event type and user slot, alarm status by value range."""
    lo, hi = EVENT_RANGE
    slot = F.col("user_id") % SENSORS_PER_TYPE
    unit = F.lit("n/a")
    for kind, name in EVENT_UNITS.items():
        unit = F.when(F.col("event_type") == kind, F.lit(name)).otherwise(unit)
    status = F.when(F.col("value") > hi, "HIGH_ALARM").when(F.col("value") < lo, "LOW_ALARM").otherwise("NORMAL")
    return events.select(
        (F.col("event_id") + 1).alias("id"),
        F.concat("event_type", F.lit("_"), slot.cast("string")).alias("sensor_id"),
        F.col("event_type").alias("sensor_type"),
        F.concat(F.lit("Zone-"), (slot % LOCATIONS).cast("string")).alias("location"),
        "ts",
        "value",
        unit.alias("unit"),
        status.alias("status"),
        F.from_json("props", "map<string,string>").alias("metadata"),
    )


def load_events(spark: SparkSession, folder: str) -> DataFrame:
    return readings_from_events(spark.read.parquet(f"{folder}/events.parquet"))


def scan_readings(spark: SparkSession, path: str) -> DataFrame:
    """The readings table without its id; Parquet reads only the columns and row groups a query needs."""
    return StoredTable(spark, path).read().drop("id")
