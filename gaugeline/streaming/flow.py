"""The running system: score readings, then alerts and aggregates from the scored rows, each a query of its own.

Scored rows are older than the watermark that released them, so the aggregates cannot follow in the same query; they
read the written rows and set their own watermarks.
"""

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from gaugeline.operators.aggregates import hour_aggregate, minute_aggregate
from gaugeline.operators.rolling import only_anomalies
from gaugeline.operators.validate import check_messages, decode_and_enrich
from gaugeline.schemas import ALERT_TOPIC, HOUR_TOPIC, MINUTE_TOPIC, READING_TOPICS
from gaugeline.sources.topics import as_messages, place_key, read_topics, write_console, write_topic
from gaugeline.streaming.accounting import ProgressLog, stream_accounts
from gaugeline.streaming.registry import RegistryKeeper
from gaugeline.streaming.scoring import RollingScorer, start_scoring

MINUTE_WATERMARK = "2 minutes"
HOUR_WATERMARK = "1 hour"
QUERIES = (
    "readings_scored", "sensor_registry", "quarantined_messages", "anomaly_alerts", "minute_aggregations", "hour_aggregations",
    "anomaly_console",
)


@dataclass
class FlowConfig:
    """Formats, places and pace. Sink options may name a {topic}."""

    folder: str
    checkpoint: str
    source_format: str = "kafka"
    source_options: dict[str, str] = field(default_factory=dict)
    sink_format: str = "kafka"
    sink_options: dict[str, str] = field(default_factory=dict)
    topics: tuple[str, ...] = READING_TOPICS
    available_now: bool = False
    console: bool = True


def session(app_name: str = "gaugeline") -> SparkSession:
    return (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.streaming.metricsEnabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def identified(enriched: DataFrame) -> DataFrame:
    """Decoded readings with the columns scoring needs: the event time, and an id that orders equal times."""
    same = [c for c in enriched.columns if c not in ("metadata", "processing_time")]
    return enriched.select("*", F.col("sensor_timestamp").alias("ts"), F.xxhash64(*same).alias("id"))


def arrival() -> Column:
    """Order in which messages arrived: the broker's time, then the place in the topic."""
    return F.struct("kafka_timestamp", "kafka_partition", "kafka_offset")


def minute_stream(scored: DataFrame, sensor_ids: str = "sketch", **options) -> DataFrame:
    return minute_aggregate(scored.withWatermark("ts", MINUTE_WATERMARK), sensor_ids=sensor_ids, **options)


def hour_stream(scored: DataFrame, **options) -> DataFrame:
    return hour_aggregate(scored.withWatermark("ts", HOUR_WATERMARK), **options)


def start_flow(spark: SparkSession, config: FlowConfig) -> list[StreamingQuery]:
    """Start scoring, registry, quarantine, alerts, minute and hour aggregates, and the console. With available_now
    the scoring is finished before the queries that read its rows start.

    Progress reports of all of them go to {folder}/reports, see `stream_accounts`. Messages that fail the checks go to {folder}/quarantine with the reason, wherever scoring puts them.
    """
    spark.streams.addListener(ProgressLog(spark, f"{config.folder}/reports", QUERIES))
    messages = read_topics(spark, config.source_format, config.topics, config.source_options)
    readings = identified(decode_and_enrich(messages))
    scorer = RollingScorer(config.folder)
    scoring = start_scoring(readings, scorer, config.checkpoint, available_now=config.available_now)
    if config.available_now:
        scoring.awaitTermination()

    keeper = RegistryKeeper(f"{config.folder}/registry", arrival="arrived")
    arrived = readings.filter("sensor_id IS NOT NULL").withColumn("arrived", arrival())
    registry = start_scoring(arrived, keeper, config.checkpoint, "sensor_registry", available_now=config.available_now)
    rejected = check_messages(messages.select("topic", "partition", "offset", "timestamp", "value")).quarantine
    quarantine = write_topic(
        rejected, "quarantined_messages", config.checkpoint, fmt="parquet", available_now=config.available_now,
        options={"path": f"{config.folder}/quarantine"},
    )

    def scored() -> DataFrame:
        return scorer.read(spark, stream=True, reading=readings.schema)

    def sink(df: DataFrame, key, topic: str, name: str) -> StreamingQuery:
        options = {k: v.format(topic=topic) for k, v in config.sink_options.items()}
        return write_topic(
            as_messages(df, key), name, config.checkpoint, topic, config.sink_format, options,
            available_now=config.available_now,
        )

    queries = [
        scoring,
        registry,
        quarantine,
        sink(only_anomalies(scored()), "sensor_id", ALERT_TOPIC, "anomaly_alerts"),
        sink(minute_stream(scored()), place_key(), MINUTE_TOPIC, "minute_aggregations"),
        sink(hour_stream(scored()), place_key(), HOUR_TOPIC, "hour_aggregations"),
    ]
    if config.console:
        queries.append(
            write_console(only_anomalies(scored()), "anomaly_console", available_now=config.available_now)
        )
    return queries


def wait(spark: SparkSession, queries: list[StreamingQuery]) -> None:
    """Until any query ends or the user interrupts; then stop all of them."""
    try:
        spark.streams.awaitAnyTermination()
    except KeyboardInterrupt:
        pass
    finally:
        for query in queries:
            query.stop()


def dropped_by_watermark(spark: SparkSession, reports: str, name: str) -> int:
    """Rows of a query that arrived behind the watermark, over all its runs, from the reports that `ProgressLog` wrote."""
    found = stream_accounts(spark, reports).filter(F.col("name") == name).first()
    return found["dropped"] if found else 0
