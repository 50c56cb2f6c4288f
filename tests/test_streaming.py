import json
import os
import time
from collections import Counter
from datetime import timedelta
from types import SimpleNamespace

import pytest
from helpers import COLUMNS, T0, frame, random_readings, reading, same_rows
from pyspark.sql import functions as F

from gaugeline.operators.aggregates import hour_aggregate, minute_aggregate
from gaugeline.operators.registry import sensor_registry
from gaugeline.operators.rolling import detect_anomalies
from gaugeline.sources.topics import live_tail, read_topics, route_readings, start, write_console, write_topic
from gaugeline.streaming.accounting import ProgressLog, progress_table
from gaugeline.streaming.flow import FlowConfig, dropped_by_watermark, hour_stream, minute_stream, start_flow, wait
from gaugeline.streaming.registry import RegistryKeeper
from gaugeline.streaming.scoring import RollingScorer, start_scoring


def instants(df):
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


def add_file(spark, path, rows):
    instants(frame(spark, rows)).coalesce(1).write.mode("append").parquet(path)
    time.sleep(0.02)  # files are taken in the order of their times


def stream(spark, path):
    schema = instants(spark.createDataFrame([], COLUMNS)).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def in_time_order(n):
    """One reading per minute; with equal times across files, the later file's row would be late."""
    return [(*r[:4], T0 + timedelta(minutes=i), *r[5:]) for i, r in enumerate(random_readings(n))]


def run_scoring(spark, folder, **options):
    scorer = RollingScorer(f"{folder}/flow", **options)
    start_scoring(stream(spark, f"{folder}/in"), scorer, f"{folder}/checkpoint", available_now=True).awaitTermination()
    return scorer


@pytest.mark.parametrize("rows_per_chunk", [10_000, 50])
def test_stream_scores_equal_batch_scores(spark, folder, rows_per_chunk):
    rows = in_time_order(700)
    for part in (rows[:250], rows[250:260], rows[260:]):
        add_file(spark, f"{folder}/in", part)
    scorer = run_scoring(spark, folder, delay="0 seconds", rows_per_chunk=rows_per_chunk)
    same_rows(detect_anomalies(instants(frame(spark, rows))), scorer.read(spark))


def test_late_rows_are_dropped_and_near_ones_put_in_order(spark, folder):
    early = [reading(i, float(i), minute=i) for i in range(0, 30, 2)]
    add_file(spark, f"{folder}/in", early)
    # The watermark is now at minute 26.
    add_file(spark, f"{folder}/in", [reading(100, 5.0, minute=27), reading(101, 5.0, minute=3), reading(102, 1.0, minute=60)])
    scorer = run_scoring(spark, folder)
    assert [r["reject_reason"] for r in scorer.rejected(spark).collect()] == ["late"]
    kept = early + [reading(100, 5.0, minute=27)]
    same_rows(detect_anomalies(instants(frame(spark, kept))), scorer.read(spark))


def test_restart_goes_on_warm_and_a_repeated_batch_changes_nothing(spark, folder):
    rows = in_time_order(500)
    add_file(spark, f"{folder}/in", rows[:300])
    run_scoring(spark, folder, delay="0 seconds")
    add_file(spark, f"{folder}/in", rows[300:])
    scorer = run_scoring(spark, folder, delay="0 seconds")
    expected = detect_anomalies(instants(frame(spark, rows)))
    same_rows(expected, scorer.read(spark))
    scorer(instants(frame(spark, rows[300:])), 1)
    same_rows(expected, scorer.read(spark))


def test_a_new_checkpoint_loses_nothing(spark, folder):
    rows = in_time_order(120)
    add_file(spark, f"{folder}/in", rows[:70])
    run_scoring(spark, folder, delay="0 seconds")
    add_file(spark, f"{folder}/more", [*rows[70:], (*reading(500, 1.0)[:4], None, 1.0, "C", "NORMAL")])
    scorer = RollingScorer(f"{folder}/flow", delay="0 seconds")
    start_scoring(stream(spark, f"{folder}/more"), scorer, f"{folder}/checkpoint2", available_now=True).awaitTermination()
    assert scorer.read(spark).count() == 120
    assert [r["reject_reason"] for r in scorer.rejected(spark).collect()] == ["no event time"]


def test_a_registry_without_its_past_is_an_error(spark, folder):
    keeper = RegistryKeeper(f"{folder}/registry")
    with pytest.raises(RuntimeError, match="no registry before epoch 7"):
        keeper(instants(frame(spark, in_time_order(5))), 7)


def test_aggregates_append_closed_windows_once(spark, folder):
    rows = in_time_order(400)
    for part in (rows[:200], rows[200:]):
        add_file(spark, f"{folder}/in", part)
    scorer = run_scoring(spark, folder, delay="0 seconds")
    schema = stream(spark, f"{folder}/in").schema
    batch = detect_anomalies(instants(frame(spark, rows)))
    last = max(r[4] for r in rows)
    for name, make, plain, delay in (
        ("minutes", minute_stream, minute_aggregate, "2 minutes"),
        ("hours", hour_stream, hour_aggregate, "1 hour"),
    ):
        df = make(scorer.read(spark, stream=True, reading=schema))
        writer = df.writeStream.format("memory").queryName(name).outputMode("append")
        query = start(writer.option("checkpointLocation", f"{folder}/{name}"), "1 second", True)
        query.awaitTermination()
        closed = plain(batch).filter(F.col("window_end") <= F.lit(last).cast("timestamp") - F.expr(f"INTERVAL {delay}"))
        got = spark.table(name)
        assert got.count() == closed.count() > 0
        numbers = [c for c in closed.columns if c != "sensor_ids"]
        same_rows(closed.select(numbers), got.select(numbers))


def test_rows_behind_the_watermark_are_reported(spark, folder):
    # Late rows are judged by the watermark of the batch before, so the third file is the first that can be late.
    for i, minute in enumerate((600, 601, 10)):
        flagged = instants(frame(spark, [reading(i, 1.0, minute=minute)])).withColumn("is_anomaly", F.lit(False))
        flagged.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        time.sleep(0.02)
    df = spark.readStream.schema(flagged.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    writer = hour_stream(df).writeStream.format("memory").queryName("dropped").outputMode("append")
    log = ProgressLog(spark, f"{folder}/reports", ("dropped",))
    spark.streams.addListener(log)
    query = start(writer, "1 second", True)
    query.awaitTermination()
    log.stop()
    assert dropped_by_watermark(spark, f"{folder}/reports", "dropped") == 1
    assert dropped_by_watermark(spark, f"{folder}/reports", "other") == 0
    # A batch that is reported again replaces its report.
    before = progress_table(spark, f"{folder}/reports").count()
    for p in query.recentProgress:
        log.onQueryProgress(SimpleNamespace(progress=p))
    assert progress_table(spark, f"{folder}/reports").count() == before >= 3
    assert dropped_by_watermark(spark, f"{folder}/reports", "dropped") == 1


def test_registry_stream_counts_on(spark, folder):
    rows = in_time_order(200)
    for part in (rows[:120], rows[120:]):
        add_file(spark, f"{folder}/in", part)
    keeper = RegistryKeeper(f"{folder}/registry")
    start_scoring(stream(spark, f"{folder}/in"), keeper, f"{folder}/checkpoint", "registry", available_now=True).awaitTermination()
    same_rows(sensor_registry(instants(frame(spark, rows))), keeper.latest(spark))


def messages(spark, rows):
    df = instants(frame(spark, rows))
    body = F.struct("sensor_id", "sensor_type", "location", F.col("ts").cast("string").alias("timestamp"), "value", "unit", "status")
    return df.select(
        F.concat(F.lit("sensors."), "sensor_type").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("id").alias("offset"),
        F.col("ts").alias("timestamp"),
        F.col("sensor_id").cast("binary").alias("key"),
        F.to_json(body).cast("binary").alias("value"),
    )


def test_whole_flow_on_files(spark, folder):
    rows = [r for r in in_time_order(400) if r[5] is not None]
    rows[50] = (*rows[50][:5], 500.0, "C", "HIGH_ALARM")
    broken = messages(spark, rows[:1]).withColumn("value", F.lit("{broken").cast("binary"))
    for part in (messages(spark, rows[:200]).union(broken), messages(spark, rows[200:])):
        part.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        time.sleep(0.02)
    for topic in ("alerts.anomalies", "aggregations.minute", "aggregations.hour"):
        os.makedirs(f"{folder}/out/{topic}")
    config = FlowConfig(
        f"{folder}/flow", f"{folder}/checkpoint", "parquet", {"path": f"{folder}/in", "maxFilesPerTrigger": "1"},
        "json", {"path": f"{folder}/out/{{topic}}"}, available_now=True, console=False,
    )
    queries = start_flow(spark, config)
    names = ["readings_scored", "sensor_registry", "quarantined_messages", "anomaly_alerts", "minute_aggregations", "hour_aggregations"]
    assert [q.name for q in queries] == names
    for q in queries:
        q.awaitTermination()
    batch = detect_anomalies(instants(frame(spark, rows)))
    last = max(r[4] for r in rows)
    released = batch.filter(F.col("ts") <= F.lit(last).cast("timestamp") - F.expr("INTERVAL 2 MINUTES"))
    alerts = spark.read.json(f"{folder}/out/alerts.anomalies").collect()
    assert len(alerts) == released.filter("is_anomaly").count() > 0
    assert {a["key"] for a in alerts} == {r["sensor_id"] for r in released.filter("is_anomaly").collect()}
    whole = json.loads(alerts[0]["value"])
    assert whole["is_anomaly"] is True and whole["timestamp"] and "kafka_offset" in whole
    reasons = Counter(r["reject_reason"] for r in spark.read.parquet(f"{folder}/flow/quarantine").collect())
    assert reasons == {"malformed": 1, "missing location": sum(r[3] is None for r in rows)}
    runs = os.listdir(f"{folder}/flow/registry")
    registry = spark.read.parquet(f"{folder}/flow/registry/{runs[0]}/epoch=1")
    want = Counter(r[1] for r in rows)
    assert len(runs) == 1 and {r["sensor_id"]: r["total_readings"] for r in registry.collect()} == want
    minutes = spark.read.json(f"{folder}/out/aggregations.minute").collect()
    assert minutes and all("|" in m["key"] or m["key"] == "temperature" for m in minutes)
    assert spark.read.json(f"{folder}/out/aggregations.hour").count() > 0


def test_topics_are_read_together_and_routed(spark, folder):
    rows = [reading(0, 1.0), reading(1, 2.0, "v", "vibration"), reading(2, 3.0, "x", "unknown")]
    messages(spark, rows).coalesce(1).write.parquet(f"{folder}/in")
    source = read_topics(spark, "parquet", options={"path": f"{folder}/in"})
    tail = live_tail(source).writeStream.format("memory").queryName("tail")
    start(tail, "1 second", True).awaitTermination()
    assert sorted(json.loads(r["data"])["sensor_id"] for r in spark.table("tail").collect()) == ["s1", "v"]
    routed = route_readings(instants(frame(spark, rows)))
    assert sorted(r["topic"] for r in routed.collect()) == ["sensors.temperature", "sensors.unknown", "sensors.vibration"]
    os.makedirs(f"{folder}/out")
    sink = route_readings(stream(spark, add(spark, folder, rows)))
    write_topic(sink, "routed", f"{folder}/checkpoint", fmt="json", options={"path": f"{folder}/out"}, available_now=True).awaitTermination()
    assert sorted(d for d in os.listdir(f"{folder}/out") if d.startswith("topic=")) == [
        "topic=sensors.temperature", "topic=sensors.unknown", "topic=sensors.vibration",
    ]


def add(spark, folder, rows):
    add_file(spark, f"{folder}/readings", rows)
    return f"{folder}/readings"


def test_console_and_wait(spark, folder):
    df = stream(spark, add(spark, folder, [reading(0, 1.0)]))
    spark.streams.resetTerminated()
    query = write_console(df, "shown", available_now=True)
    wait(spark, [query])
    assert not query.isActive
