"""Decoding of JSON messages and the typed checks at the edge. Bad input becomes a row with a reason, never an error."""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from gaugeline.operators.rolling import nan_to_null
from gaugeline.schemas import RAW_READING_SCHEMA, READING_SCHEMA

REQUIRED = ("sensor_id", "sensor_type", "location", "timestamp", "value", "unit", "status")
REQUIRED_IN_TABLE = ("sensor_id", "sensor_type", "value", "unit", "timestamp")


def decode_messages(envelope: DataFrame) -> DataFrame:
    """Topic, arrival time and the fields of the JSON value. A malformed message gives a row of nulls."""
    message = _once(F.from_json(F.col("value").cast("string"), READING_SCHEMA)).alias("data")
    place = [F.col(c).alias(f"kafka_{c}") for c in ("partition", "offset") if c in envelope.columns]
    return envelope.select("topic", F.col("timestamp").alias("kafka_timestamp"), *place, message).select(
        "topic", "kafka_timestamp", *[f"kafka_{c}" for c in ("partition", "offset") if c in envelope.columns], "data.*"
    )


def _once(parsed: Column) -> Column:
    """A generator of the one value: columns taken from it later refer to it, where a plain expression is copied."""
    return F.explode(F.array(parsed))


def enrich(decoded: DataFrame) -> DataFrame:
    """Processing time, parsed event time, and its hour and day of the year."""
    return decoded.withColumns(
        {"processing_time": F.current_timestamp(), "sensor_timestamp": F.try_to_timestamp("timestamp")}
    ).withColumns({"hour": F.hour("sensor_timestamp"), "day": F.dayofyear("sensor_timestamp")})


def decode_and_enrich(envelope: DataFrame) -> DataFrame:
    return enrich(decode_messages(envelope))


class Checked(NamedTuple):
    valid: DataFrame
    quarantine: DataFrame


def _reason(required: tuple[str, ...]) -> Column:
    raw = F.col("raw")
    missing = [F.when(raw[c].isNull(), F.lit(f"missing {c}")) for c in required]
    return F.coalesce(
        F.when(F.coalesce(*[raw[c] for c in READING_SCHEMA.fieldNames() if c != "metadata"]).isNull(), "malformed"),
        *missing,
        F.when(F.col("_value").isNull(), "value is not a number"),
        F.when(F.abs("_value") == float("inf"), "value is not finite"),
        F.when(F.col("_time").isNull(), "timestamp is not a time"),
    )


def judge_messages(messages: DataFrame, column: str = "value", required: tuple[str, ...] = REQUIRED) -> DataFrame:
    """Messages with their parsed text `raw`, typed `_value` and `_time`, and the first reason to reject them, or null.

    Every message is parsed once. Write this table once to take both outputs of `check_messages` from one pass.
    """
    raw = _once(F.from_json(F.col(column).cast("string"), RAW_READING_SCHEMA))
    typed = messages.select("*", raw.alias("raw")).withColumns(
        {"_value": F.col("raw.value").try_cast("double"), "_time": F.try_to_timestamp("raw.timestamp")}
    )
    return typed.withColumn("reject_reason", _reason(required))


def check_messages(
    messages: DataFrame, column: str = "value", required: tuple[str, ...] = REQUIRED
) -> Checked:
    """Split JSON messages into typed readings and rejected messages with the first reason found.

    Numbers and times may come as text. REQUIRED_IN_TABLE makes location and status optional. Metadata defaults to an
    empty map.
    """
    judged = judge_messages(messages, column, required)
    rest = [c for c in messages.columns if c != column]
    good = judged.filter(F.col("reject_reason").isNull()).select(
        *rest,
        "raw.sensor_id",
        "raw.sensor_type",
        "raw.location",
        F.col("_time").alias("timestamp"),
        F.col("_value").alias("value"),
        "raw.unit",
        "raw.status",
        F.coalesce("raw.metadata", F.create_map().cast("map<string,string>")).alias("metadata"),
    )
    bad = judged.filter(F.col("reject_reason").isNotNull()).select(*rest, column, "reject_reason")
    return Checked(good.withColumn("value", nan_to_null("value")), bad)


def require_columns(df: DataFrame, required: tuple[str, ...]) -> Checked:
    """Rows that satisfy the NOT NULL columns of a table, and the others with the first missing column."""
    reason = F.coalesce(*[F.when(F.col(c).isNull(), F.lit(f"missing {c}")) for c in required])
    judged = df.withColumn("reject_reason", reason)
    return Checked(
        judged.filter(F.col("reject_reason").isNull()).drop("reject_reason"),
        judged.filter(F.col("reject_reason").isNotNull()),
    )
