import inspect
from datetime import datetime, timedelta

import pytest
from helpers import T0, frame, random_readings, reading, same_rows
from pyspark.sql import functions as F

from gaugeline.functions.durations import Duration, parse_duration
from gaugeline.functions.text import parse_range
from gaugeline.operators import alerts, queries
from gaugeline.operators.aggregates import (
    bitmap_counts, bitmap_sensors, hour_aggregate, merged_bitmaps, minute_aggregate, sensor_numbers, window_bitmaps, window_mean,
)
from gaugeline.operators.changes import apply_changes, assign_ids
from gaugeline.operators.filters import any_of, default_range, equals, since_hours
from gaugeline.operators.registry import latest_points, list_sensors, merge_registry, sensor_registry
from gaugeline.operators.rolling import detect_anomalies
from gaugeline.operators.validate import REQUIRED_IN_TABLE, check_messages, decode_and_enrich
from gaugeline.plans.joins import fits_broadcast, hot_safe_join
from gaugeline.sources.tables import append_readings, create_readings, read_points, write_points
from gaugeline.streaming.flow import minute_stream


def test_durations():
    assert parse_duration("1h30m") == Duration(micros=5_400_000_000)
    assert parse_duration("2y") == Duration(months=24) and parse_duration("1mo") == Duration(months=1)
    for bad in ("", "h", "1x", "1mo2d", "0s", "1 h"):
        with pytest.raises(ValueError):
            parse_duration(bad)


def test_minute_aggregate_row(spark):
    rows = [
        reading(0, 1.0, "a", minute=0),
        reading(1, 3.0, "b", minute=0),
        reading(2, 5.0, "a", minute=0, status=None),
        reading(3, None, "c", minute=0, status="HIGH_ALARM"),
        reading(4, 9.0, "a", minute=1),
    ]
    df = detect_anomalies(frame(spark, rows))
    first, second = minute_aggregate(df, sensor_ids="counts").orderBy("window_start").collect()
    assert (first["reading_count"], first["avg_value"], first["min_value"], first["max_value"]) == (4, 3.0, 1.0, 5.0)
    assert first["stddev_value"] == pytest.approx(2.0) and first["anomaly_count"] == 1
    assert [tuple(p) for p in first["sensor_ids"]] == [("a", 2), ("b", 1), ("c", 1)]
    assert second["window_start"] == T0 + timedelta(minutes=1) and second["stddev_value"] is None
    listed = minute_aggregate(df, sensor_ids="list").orderBy("window_start").first()
    assert listed["sensor_ids"] == ["a", "a", "b", "c"]
    assert "sensor_ids" not in minute_aggregate(df, sensor_ids="none").columns


def test_deviation_of_far_away_values_keeps_its_digits(spark):
    rows = [reading(i, 1e9 + i % 3, f"s{i % 4}", minute=0) for i in range(60)]
    row = minute_aggregate(detect_anomalies(frame(spark, rows))).first()
    assert row["stddev_value"] == pytest.approx(frame(spark, rows).agg(F.stddev("value")).first()[0], rel=1e-7)  # a mean near 1e9 is known to 1e-7


def test_hour_aggregate_counts_null_flags_as_normal(spark):
    df = detect_anomalies(frame(spark, [reading(0, 1.0, status=None), reading(1, 1.0, status="LOW_ALARM")]))
    row = hour_aggregate(df).first()
    assert row["reading_count"] == 2 and row["anomaly_count"] == 1


def test_window_mean_edges(spark):
    rows = [reading(i, float(i), minute=i) for i in (0, 59, 60, 90, 100)]
    got = window_mean(frame(spark, rows), T0, T0 + timedelta(minutes=100), "1h").orderBy("timestamp").collect()
    assert [(r["timestamp"], r["mean_value"]) for r in got] == [
        (T0 + timedelta(minutes=60), 29.5),
        (T0 + timedelta(minutes=100), 75.0),  # clipped to stop; the row on stop is outside
    ]
    assert got[0]["window"] == "1h"


def test_window_mean_keeps_series_apart(spark):
    rows = [reading(0, 1.0), reading(1, 3.0, status="LOW_ALARM"), reading(2, 8.0, "s2")]
    df, stop = frame(spark, rows), T0 + timedelta(hours=1)
    assert window_mean(df, T0, stop).count() == 3
    assert [r["mean_value"] for r in window_mean(df, T0, stop, collapse=True).collect()] == [4.0]


def test_optional_filters(spark):
    df = frame(spark, [reading(0, 1.0, kind="a"), reading(1, 1.0, kind="b", location="x"), reading(2, 1.0, kind="c")])
    assert any_of(df, "sensor_type", ["a", "b"]).count() == 2
    assert any_of(df, "sensor_type", []).count() == any_of(df, "sensor_type", None).count() == 3
    assert equals(df, sensor_type="b", location="x").count() == 1 and equals(df, sensor_type="").count() == 3
    assert since_hours(df, T0 + timedelta(hours=1, minutes=1), 1, "ts").count() == 2
    assert default_range(T0) == (T0 - timedelta(hours=24), T0)


def test_recent_page_and_lookup(spark):
    df = frame(spark, [reading(i, float(i)) for i in range(1, 21)])
    assert [r["value"] for r in queries.recent(df, 3).collect()] == [20.0, 19.0, 18.0]
    page = queries.recent_page(df).collect()
    assert [r["id"] for r in page] == [15, 14, 13, 12, 11] and page[0]["time"] == "2024-01-01T00:15:00"
    assert queries.reading_by_id(df, 7).first()["value"] == 7.0
    assert queries.reading_by_id(df, 99).isEmpty()
    assert "TakeOrderedAndProject" in queries.recent(df, 3)._jdf.queryExecution().executedPlan().toString()


def test_series_limit_is_per_series(spark):
    rows = [reading(i, float(i), status="NORMAL" if i % 2 else "LOW_ALARM") for i in range(300)]
    assert sorted(r["id"] for r in queries.series_limit(frame(spark, rows), 1).collect()) == [0, 1]
    history = queries.sensor_history(frame(spark, rows), "s1", T0 + timedelta(minutes=200), limit=2)
    assert sorted(r["value"] for r in history.collect()) == [0.0, 1.0, 2.0, 3.0]
    assert history.columns == ["timestamp", "sensor_id", "value", "sensor_type", "location"]


def test_statistics(spark):
    df = frame(spark, [reading(1, 1.0), reading(2, 2.0, "s2", minute=5), reading(3, 3.0, "s3", minute=5)])
    summary, sensors = queries.statistics(df)
    row = summary.first()
    assert (row["total_readings"], row["unique_sensors"], row["latest_value"]) == (3, 3, 3.0)
    assert sorted(r[0] for r in sensors.collect()) == ["s1", "s2", "s3"]
    empty = queries.statistics(df.filter("false")).summary.first()
    assert empty["total_readings"] == 0 and empty["unique_sensors"] == 0 and empty["latest_sensor_id"] is None


def test_registry_takes_the_last_arrived(spark):
    df = frame(spark, [reading(1, 1.0, minute=9), reading(2, 2.0, minute=3, location="roof", status="HIGH_ALARM")])
    row = sensor_registry(df).first()
    assert (row["location"], row["status"], row["last_seen"]) == ("roof", "HIGH_ALARM", T0 + timedelta(minutes=3))
    assert row["total_readings"] == 2
    later = sensor_registry(frame(spark, [reading(3, 1.0, minute=1, status="NORMAL"), reading(4, 1.0, "s2")]))
    merged = {r["sensor_id"]: r for r in merge_registry(sensor_registry(df), later).collect()}
    assert merged["s1"]["total_readings"] == 3 and merged["s1"]["status"] == "NORMAL" and len(merged) == 2


def test_registry_defaults(spark):
    stored = spark.createDataFrame(
        [("a", "t", "l", None, None, None), ("b", "t", "l", "2024-01-01T00:00:00", "NORMAL", "7")],
        "sensor_id string, sensor_type string, location string, last_seen string, status string, total_readings string",
    )
    a, b = list_sensors(stored).orderBy("sensor_id").collect()
    assert (a["status"], a["total_readings"], a["last_seen"]) == ("unknown", 0, None)
    assert b["total_readings"] == 7 and b["last_seen"] is not None


def test_points_are_overwritten_by_later_arrivals(spark, folder):
    rows = [reading(1, 1.0, minute=0), reading(2, 2.0, minute=0), reading(3, 9.0, minute=0, status="HIGH_ALARM")]
    df = frame(spark, rows)
    assert sorted(r["value"] for r in latest_points(df).collect()) == [2.0, 9.0]
    write_points(df, f"{folder}/points")
    assert "unit" not in spark.read.parquet(f"{folder}/points").columns


def test_points_of_all_calls_are_kept(spark, folder):
    path = f"{folder}/points"
    first = [reading(i, float(i), minute=i * 600) for i in range(10)]
    second = [reading(20, 7.5, minute=600), reading(21, 8.0, minute=601), reading(22, 9.0, minute=100_000)]
    write_points(frame(spark, first), path)
    write_points(frame(spark, second), path)
    got = {r["ts"]: r["value"] for r in spark.read.parquet(path).collect()}
    assert got == {r[4]: r[5] for r in first} | {r[4]: r[5] for r in second}
    day = read_points(spark, path, datetime(2024, 1, 2), datetime(2024, 1, 3))
    assert sorted(r["value"] for r in day.collect()) == [3.0, 4.0]
    plan = day._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_changes(spark):
    base = spark.createDataFrame([(i, float(i)) for i in range(1, 8)], "id bigint, value double")
    log = [
        (1, 10.0, "U", 1), (1, 11.0, "U", 2),
        (2, 0.0, "U", 1), (2, 0.0, "D", 2),
        (3, 0.0, "D", 1), (3, 0.0, "U", 2),
        (4, 0.0, "D", 1), (4, 44.0, "I", 2), (4, 45.0, "U", 3),
        (90, 1.0, "U", 1),
        (91, 1.0, "D", 1),
        (92, 5.0, "I", 1),
        (93, 5.0, "I", 1), (93, 0.0, "D", 2),
        (94, 1.0, "U", 1), (94, 6.0, "I", 2),
        (95, 0.0, "D", 1), (95, 7.0, "I", 2), (95, 8.0, "U", 3),
        (6, 0.0, "D", 1), (6, 0.0, "D", 2), (6, 9.0, "I", 1_000_003), (6, 9.5, "U", 1_000_004),
    ]
    got = apply_changes(base, spark.createDataFrame(log, "id bigint, value double, op string, seq bigint"))
    assert dict(got.snapshot.collect()) == {1: 11.0, 4: 45.0, 5: 5.0, 6: 9.5, 7: 7.0, 92: 5.0, 94: 6.0, 95: 8.0}
    assert sorted(map(tuple, got.not_found.collect())) == [(3, 2), (6, 2), (90, 1), (91, 1), (94, 1), (95, 1)]
    assert dict(got.updated.collect()) == {1: 11.0, 4: 45.0, 6: 9.5, 95: 8.0}


def test_ids_are_dense(spark):
    df = assign_ids(spark.range(0, 1000, 1, 7).withColumnRenamed("id", "n"), 41)
    ids = sorted(r["id"] for r in df.collect())
    assert ids == list(range(42, 1042))


def test_table_rejects_missing_columns(spark, folder):
    path = f"{folder}/readings"
    create_readings(spark, path)
    create_readings(spark, path)
    rows = spark.createDataFrame(
        [("a", "t", 1.0, "C", T0, None), ("b", None, 1.0, "C", T0, "l"), ("c", "t", 2.0, "C", T0, "l")],
        "sensor_id string, sensor_type string, value double, unit string, timestamp timestamp, location string",
    )
    rejected = append_readings(spark, path, rows).collect()
    assert [r["reject_reason"] for r in rejected] == ["missing sensor_type"]
    append_readings(spark, path, rows)
    assert sorted(r["id"] for r in create_readings(spark, path).read().collect()) == [1, 2, 3, 4]


GOOD = '{"sensor_id":"a","sensor_type":"t","location":"l","timestamp":"2024-01-01T00:00:00Z","value":1.5,"unit":"C","status":"NORMAL"'


def test_messages_are_checked(spark):
    texts = {
        "plain": GOOD + ',"metadata":{"level":7}}',
        "text number": GOOD.replace("1.5", '"1.5"') + "}",
        "bad number": GOOD.replace("1.5", '"warm"') + "}",
        "bad time": GOOD.replace("2024-01-01T00:00:00Z", "noon") + "}",
        "no unit": GOOD.replace('"unit":"C",', "") + "}",
        "no status": GOOD.replace(',"status":"NORMAL"', "") + "}",
        "broken": GOOD[:20],
    }
    df = spark.createDataFrame(list(texts.items()), "name string, value string")
    checked = check_messages(df)
    valid = {r["name"]: r for r in checked.valid.collect()}
    assert set(valid) == {"plain", "text number"} and valid["text number"]["value"] == 1.5
    assert valid["plain"]["metadata"] == {"level": "7"} and valid["text number"]["metadata"] == {}
    assert {r["name"]: r["reject_reason"] for r in checked.quarantine.collect()} == {
        "bad number": "value is not a number",
        "bad time": "timestamp is not a time",
        "no unit": "missing unit",
        "no status": "missing status",
        "broken": "malformed",
    }
    assert check_messages(df, required=REQUIRED_IN_TABLE).valid.count() == 3


def test_decoding_is_lenient(spark):
    rows = [("t", 0, 1, datetime(2024, 2, 1), None, v.encode()) for v in (GOOD + "}", "nonsense")]
    good, bad = decode_and_enrich(
        spark.createDataFrame(
            rows, "topic string, partition int, offset bigint, timestamp timestamp, key binary, value binary"
        )
    ).orderBy(F.col("sensor_id").isNull()).collect()
    assert (good["value"], good["hour"], good["day"]) == (1.5, 0, 1) and good["processing_time"] is not None
    assert bad["topic"] == "t" and bad["sensor_id"] is None and bad["sensor_timestamp"] is None
    assert "offset" not in good and "partition" not in good


def test_rules_by_type(spark):
    rows = [reading(i, v, kind=k, status=None) for i, (k, v) in enumerate(
        [("temperature", 26.0), ("temperature", 17.0), ("humidity", 50.0), ("unknown", 1.0), ("vibration", 5.0)]
    )]
    df = frame(spark, rows)
    status = {r["id"]: r["status"] for r in alerts.alarm_status(df, alerts.catalogue(spark)).collect()}
    assert status == {0: "HIGH_ALARM", 1: "LOW_ALARM", 2: "NORMAL", 3: None, 4: "NORMAL"}
    kept = alerts.alarm_status(df.withColumn("status", F.lit("NORMAL")), alerts.catalogue(spark))
    assert {r["status"] for r in kept.collect()} == {"NORMAL"}
    over = {r["id"]: r["is_threshold_anomaly"] for r in alerts.threshold_anomaly(df, alerts.thresholds(spark)).collect()}
    assert over == {0: False, 1: False, 2: False, 3: None, 4: True}
    assert alerts.catalogue_sensors(spark).count() == 125


def test_alerts(spark):
    rows = [reading(i, 20.0) for i in range(50)] + [reading(50, 400.0), reading(51, 26.0, status="HIGH_ALARM"),
            reading(52, 900.0, status="HIGH_ALARM")]
    found = detect_anomalies(frame(spark, rows)).filter("is_anomaly")
    made = alerts.build_alerts(found, alerts.catalogue(spark))
    assert [r["severity"] for r in made.orderBy("timestamp").collect()] == ["medium", "high", "critical"]
    now = T0 + timedelta(minutes=60)
    listed = alerts.list_alerts(made, now, 1).collect()
    assert [r["severity"] for r in listed] == ["critical", "high", "medium"]
    assert (listed[0]["range_lo"], listed[0]["range_hi"]) == (18.0, 25.0)
    assert alerts.list_alerts(made, now, 1, severity="high").count() == 1
    assert made.select("alert_id").distinct().count() == 3


def test_range_text_is_parsed_not_run(spark):
    texts = ["(1, 2.5)", "[-3e1,4]", None, "__import__('os')", "(1, x)"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    lo, hi = parse_range(F.col("t"))
    assert [tuple(r) for r in df.select(lo, hi).collect()] == [(1.0, 2.5), (-30.0, 4.0)] + [(0.0, 100.0)] * 3


def test_hot_keys_join_whole(spark):
    facts = spark.createDataFrame([(k, i) for i in range(300) for k in ([1] if i % 3 else [i])], "k bigint, v bigint")
    dim = spark.createDataFrame([(k, k * 2) for k in range(0, 200)], "k bigint, w bigint")
    for how in ("inner", "left"):
        same_rows(facts.join(dim, "k", how), hot_safe_join(facts, dim, ["k"], how, hot_rows=20))
    assert fits_broadcast(dim, 200) and not fits_broadcast(dim, 199)


def test_random_readings_aggregate_like_plain_spark(spark):
    df = detect_anomalies(frame(spark, random_readings(500)))
    merged = minute_aggregate(df, length="30 minutes", sensor_ids="none")
    plain = df.groupBy(F.window("ts", "30 minutes"), "sensor_type", "location").agg(
        F.count("*").alias("reading_count"), F.avg("value").alias("avg_value"), F.min("value").alias("min_value"),
        F.max("value").alias("max_value"), F.stddev("value").alias("stddev_value"),
        F.sum(F.when(F.col("is_anomaly"), 1).otherwise(0)).alias("anomaly_count"),
    )
    columns = ["sensor_type", "location", "reading_count", "avg_value", "min_value", "max_value", "stddev_value", "anomaly_count"]
    same_rows(merged.select("window_start", *columns), plain.select(F.col("window.start").alias("window_start"), *columns))


def test_bitmaps_hold_the_sensors_of_windows(spark):
    rows = [reading(i, 1.0, sensor=f"s{i % 7}" if i % 5 else None, minute=i // 10) for i in range(200)]
    df = frame(spark, rows)
    numbers = sensor_numbers(df)
    assert sorted(r["number"] for r in numbers.collect()) == list(range(1, 8))
    wide = numbers.withColumn("number", F.col("number") * 20_000)  # over several buckets
    for table in (numbers, wide):
        minutes = window_bitmaps(df, table)
        for length, bitmaps in ((1, minutes), (5, merged_bitmaps(minutes, "5 minutes"))):
            want = {}
            for r in rows:
                if r[1] is not None:
                    want.setdefault(r[4].minute // length, set()).add(r[1])
            got = {}
            for r in bitmap_sensors(bitmaps, table).collect():
                got.setdefault(r["window_start"].minute // length, set()).add(r["sensor_id"])
            assert got == want
            counts = {r["window_start"].minute // length: (r["sensors"], r["readings"]) for r in bitmap_counts(bitmaps).collect()}
            assert counts == {w: (len(s), sum(r[1] is not None and r[4].minute // length == w for r in rows)) for w, s in want.items()}


def test_the_running_flow_lists_no_ids(spark):
    flagged = frame(spark, [reading(i, 1.0, sensor=f"s{i % 3}", minute=0) for i in range(9)]).withColumn("is_anomaly", F.lit(False))
    df = minute_aggregate(flagged, sensor_ids="sketch")
    assert df.first()["sensors"] == 3 and "collect_list" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert inspect.signature(minute_stream).parameters["sensor_ids"].default == "sketch"


def test_clamp_keeps_missing_values(spark):
    df = spark.createDataFrame([(None, 1.0, 5.0), (0.0, 1.0, 5.0), (3.0, 1.0, 5.0), (9.0, 1.0, 5.0), (9.0, 1.0, None)], "v double, lo double, hi double")
    got = df.select(alerts.clamp(F.col("v"), F.col("lo"), F.col("hi")).alias("v")).collect()
    assert [r["v"] for r in got] == [None, 1.0, 3.0, 5.0, 9.0]
