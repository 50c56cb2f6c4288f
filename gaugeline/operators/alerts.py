"""Rules by sensor type (normal range, alarm status, threshold) and the alerts made from anomalous readings."""

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gaugeline.functions.text import format_range, parse_range
from gaugeline.operators.filters import equals, since_hours
from gaugeline.operators.rolling import Z_LIMIT
from gaugeline.plans.joins import lookup_join
from gaugeline.schemas import ALARM_STATUSES

# Per type the normal range, unit, failure rate, drift factor and number of sensors.
CATALOGUE = (
    ("temperature", 18.0, 25.0, "°C", 0.02, 0.1, 50),
    ("vibration", 0.0, 50.0, "Hz", 0.05, 2.0, 30),
    ("pressure", 50.0, 200.0, "PSI", 0.03, 5.0, 25),
    ("humidity", 40.0, 60.0, "%RH", 0.01, 1.0, 20),
)

# Per type the usual range, unit and anomaly threshold of the second kind of device.
THRESHOLDS = (
    ("temperature", 15.0, 35.0, "°C", 45.0),
    ("pressure", 0.8, 2.5, "bar", 3.0),
    ("vibration", 0.1, 2.0, "m/s²", 5.0),
    ("humidity", 30.0, 70.0, "%", 90.0),
)

# Sensor id prefix per type.
ID_PREFIXES = {"temperature": "TEMP", "vibration": "VIB", "pressure": "PRES", "humidity": "HUM"}


def catalogue(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(CATALOGUE),
        "sensor_type string, range_lo double, range_hi double, unit string, failure_rate double, drift_factor double, "
        "sensors int",
    )


def catalogue_sensors(spark: SparkSession) -> DataFrame:
    """One row per catalogued sensor, numbered from 0 within its type."""
    prefix = F.element_at(F.create_map(*[F.lit(x) for kv in ID_PREFIXES.items() for x in kv]), F.col("sensor_type"))
    number = F.explode(F.sequence(F.lit(0), F.col("sensors") - 1)).alias("n")
    return catalogue(spark).select("*", number).select(
        F.format_string("%s_%03d", prefix, "n").alias("sensor_id"),
        "sensor_type",
        "range_lo",
        "range_hi",
        "unit",
        "failure_rate",
        "drift_factor",
    )


def thresholds(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(THRESHOLDS),
        "sensor_type string, usual_lo double, usual_hi double, unit string, anomaly_threshold double",
    )


def with_ranges(df: DataFrame, ranges: DataFrame) -> DataFrame:
    """Add range_lo and range_hi of the sensor type; null for a type without a range."""
    return lookup_join(df, ranges.select("sensor_type", "range_lo", "range_hi"), ["sensor_type"])


def alarm_status(df: DataFrame, ranges: DataFrame, keep_existing: bool = True) -> DataFrame:
    """Status by range where it is missing (or everywhere): above is HIGH_ALARM, below is LOW_ALARM."""
    high, low = ALARM_STATUSES
    judged = (
        F.when(F.col("value") > F.col("range_hi"), high)
        .when(F.col("value") < F.col("range_lo"), low)
        .when(F.col("range_lo").isNotNull() & F.col("value").isNotNull(), "NORMAL")
    )
    status = F.coalesce("status", judged) if keep_existing else judged
    return with_ranges(df, ranges).withColumn("status", status)


def threshold_anomaly(df: DataFrame, limits: DataFrame) -> DataFrame:
    """True for readings at or above the anomaly threshold of their type."""
    joined = lookup_join(df, limits.select("sensor_type", "anomaly_threshold"), ["sensor_type"])
    return joined.withColumn("is_threshold_anomaly", F.col("value") >= F.col("anomaly_threshold"))


def clamp(value: Column, lo: Column, hi: Column) -> Column:
    """Nearest value inside the range; a missing value stays missing, and a missing bound is none."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, lo), hi))


def build_alerts(anomalies: DataFrame, ranges: DataFrame, time: str = "ts") -> DataFrame:
    """Alerts of anomalous, scored readings. Severity: critical if alarm status and z-score agree, high for the alarm
    alone, medium for the z-score alone."""
    statistical, alarm = F.col("z_score") > Z_LIMIT, F.coalesce("is_anomaly_status", F.lit(False))
    severity = F.when(alarm & statistical, "critical").when(alarm, "high").when(statistical, "medium")
    message = F.format_string(
        "%s %s at %s: value %.2f, z-score %.2f",
        F.col("sensor_type"),
        F.coalesce("status", F.lit("unknown")),
        F.coalesce("location", F.lit("unknown")),
        "value",
        "z_score",
    )
    return with_ranges(anomalies, ranges).select(
        F.sha2(F.concat_ws("|", "sensor_id", F.col(time).cast("string")), 256).alias("alert_id"),
        "sensor_id",
        "sensor_type",
        F.col(time).alias("timestamp"),
        "value",
        format_range(F.col("range_lo"), F.col("range_hi")).alias("expected_range"),
        severity.alias("severity"),
        message.alias("message"),
    )


def read_alerts(stored: DataFrame) -> DataFrame:
    """Stored alerts with the expected range as two numbers."""
    lo, hi = parse_range(F.col("expected_range"))
    return stored.withColumns({"range_lo": lo, "range_hi": hi}).drop("expected_range")


def list_alerts(
    stored: DataFrame,
    now: datetime,
    hours: int = 24,
    sensor_type: str | None = None,
    severity: str | None = None,
) -> DataFrame:
    """Recent alerts, newest first."""
    chosen = equals(since_hours(stored, now, hours), sensor_type=sensor_type, severity=severity)
    return read_alerts(chosen).orderBy(F.desc("timestamp"), "alert_id")
