"""Topics as streaming sources and sinks. The format is a parameter: "kafka" in production, files to replay a topic,
"console" or "memory" to look at one."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from gaugeline.functions.text import topic_of
from gaugeline.schemas import ENVELOPE_SCHEMA, READING_TOPICS

# Times in messages keep their microseconds.
JSON_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
ENVELOPE = ("topic", "partition", "offset", "timestamp", "key", "value")


def read_topics(
    spark: SparkSession,
    fmt: str = "kafka",
    topics: Sequence[str] = READING_TOPICS,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """All topics as one stream of messages. A broker starts at the newest messages and outlives lost ones; a file
    format replays messages stored in its `path`. Rates are options: maxOffsetsPerTrigger, maxFilesPerTrigger."""
    if fmt == "kafka":
        defaults = {"subscribe": ",".join(topics), "startingOffsets": "latest", "failOnDataLoss": "false"}
        return spark.readStream.format(fmt).options(**{**defaults, **(options or {})}).load().select(*ENVELOPE)
    stream = spark.readStream.format(fmt).schema(ENVELOPE_SCHEMA).options(**(options or {})).load()
    return stream.filter(F.col("topic").isin(*topics))


def as_messages(df: DataFrame, key: Column | str = "sensor_id") -> DataFrame:
    """Rows as keyed JSON messages: the key as text, the whole row as value."""
    key = F.col(key) if isinstance(key, str) else key
    return df.select(key.cast("string").alias("key"), F.to_json(F.struct(*df.columns), JSON_TIMES).alias("value"))


def place_key() -> Column:
    """Key of the aggregates, which have no sensor."""
    return F.concat_ws("|", "sensor_type", "location")


def route_readings(readings: DataFrame) -> DataFrame:
    """Readings as messages with the topic of their type; a sink without a fixed topic delivers them."""
    return readings.select(
        topic_of(F.col("sensor_type")).alias("topic"),
        F.col("sensor_id").alias("key"),
        F.to_json(F.struct(*readings.columns), JSON_TIMES).alias("value"),
    )


def write_topic(
    messages: DataFrame,
    name: str,
    checkpoint: str,
    topic: str | None = None,
    fmt: str = "kafka",
    options: Mapping[str, str] | None = None,
    every: str = "5 seconds",
    available_now: bool = False,
) -> StreamingQuery:
    """Append messages to a topic; with no topic each message names its own. Files are laid out by topic."""
    writer = messages.writeStream.queryName(name).outputMode("append").option("checkpointLocation", f"{checkpoint}/{name}")
    if fmt == "kafka":
        writer = writer.option("topic", topic) if topic else writer
    elif "topic" in messages.columns:
        writer = writer.partitionBy("topic")
    return start(writer.format(fmt).options(**(options or {})), every, available_now)


def write_console(
    df: DataFrame, name: str, mode: str = "append", every: str = "10 seconds", available_now: bool = False
) -> StreamingQuery:
    writer = df.writeStream.queryName(name).outputMode(mode).format("console")
    return start(writer.option("truncate", "false").option("numRows", 20), every, available_now)


def live_tail(messages: DataFrame) -> DataFrame:
    """Each message as one JSON object, as a subscriber sees it; a message that is none as an error with its text."""
    text = F.col("value").cast("string")
    parsed = F.try_parse_json(text)
    kind = F.schema_of_variant(parsed)
    broken = F.to_json(F.struct(F.lit("not a JSON object").alias("error"), text.alias("message")))
    return messages.select(F.when(kind.startswith("OBJECT"), F.to_json(parsed)).otherwise(broken).alias("data"))


def start(writer: DataStreamWriter, every: str, available_now: bool) -> StreamingQuery:
    """Micro-batches on a timer, or everything there is and then stop (tests and backfills)."""
    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    return writer.trigger(**trigger).start()
