"""

The ``events`` table is viewed as sensor readings (see ``gaugeline.sources.readings``); every query reads all of it.
"""

from __future__ import annotations

import importlib.util
import os
import sys
from collections.abc import Callable
from datetime import datetime, timedelta

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gaugeline.operators import aggregates, alerts, changes, dbscan, fill, queries as reads, registry, rolling, sketches, validate
from gaugeline.operators.quantile import quantile_table
from gaugeline.operators.scaler import apply_scaler, fit_scaler
from gaugeline.plans import outliers
from gaugeline.plans.scratch import materialize, scratch_path
from gaugeline.sources.readings import EVENT_RANGE, EVENT_UNITS, load_events, readings_from_events, scan_readings
from gaugeline.sources.rollups import window_mean_of_points, write_points_and_rollups
from gaugeline.sources.stored import StoredTable
from gaugeline.sources.tables import append_readings, create_readings, read_points, write_points
from gaugeline.sources.topics import live_tail, route_readings, write_topic
from gaugeline.streaming.accounting import ProgressLog, stream_accounts
from gaugeline.streaming.flow import hour_stream, minute_stream
from gaugeline.streaming.registry import RegistryKeeper
from gaugeline.streaming.scoring import RollingScorer, start_scoring
from gaugeline.streaming.stateful import start_state_scoring

NOW = datetime(2024, 1, 31)
START, STOP = datetime(2024, 1, 5, 3, 30), datetime(2024, 1, 25, 13, 15)
THRESHOLD = 120.0
STORED_RANGE = 5_000


def _r(column: str, digits: int = 8) -> Column:
    return F.round(column, digits).alias(column)


def _readings(spark: SparkSession, folder: str) -> DataFrame:
    return load_events(spark, folder)


def _scored(spark: SparkSession, folder: str, **options) -> DataFrame:
    return rolling.detect_anomalies(_readings(spark, folder), **options)


def _score_columns(df: DataFrame) -> DataFrame:
    flags = ["is_anomaly_statistical", "is_anomaly_status", "is_anomaly"]
    return df.select("id", "sensor_id", "ts", "value", _r("rolling_mean"), _r("rolling_std", 5), _r("z_score", 5), *flags)


def _ranges(spark: SparkSession) -> DataFrame:
    rows = [(kind, *EVENT_RANGE, THRESHOLD) for kind in EVENT_UNITS]
    return spark.createDataFrame(rows, "sensor_type string, range_lo double, range_hi double, anomaly_threshold double")


# ---- scoring -------------------------------------------------------------------------------------------------------


def rolling_zscore(spark, folder):
    return _score_columns(_scored(spark, folder))


def rolling_zscore_chunked(spark, folder):
    """The same rows with every group split, which at full size only large groups are."""
    groups = _readings(spark, folder).groupBy("sensor_type", "location").count()
    bound = max(groups.agg(F.avg("count")).first()[0] // 3, 10)
    return _score_columns(_scored(spark, folder, rows_per_chunk=int(bound)))


def anomalies(spark, folder):
    return _score_columns(rolling.only_anomalies(_scored(spark, folder)))


# ---- windows -------------------------------------------------------------------------------------------------------


def _minute(df: DataFrame, ids: Column | None) -> DataFrame:
    columns = ["window_start", "window_end", "sensor_type", "location", "reading_count"]
    values = [_r("avg_value"), "min_value", "max_value", _r("stddev_value", 5), "anomaly_count"]
    return df.select(*columns, *values, *([] if ids is None else [ids.alias("sensor_ids")]))


def _counted_ids() -> Column:
    return F.array_join(F.transform("sensor_ids", lambda p: F.concat(p["sensor_id"], F.lit(":"), p["n"].cast("string"))), ",")


def minute_agg(spark, folder):
    return _minute(aggregates.minute_aggregate(_scored(spark, folder), sensor_ids="counts"), _counted_ids())


def minute_agg_numbers(spark, folder):
    """The same without the sensors: one shuffle."""
    return _minute(aggregates.minute_aggregate(_scored(spark, folder)), None)


def window_sensors(spark, folder):
    """Sensors of each minute, a row each."""
    return aggregates.window_sensors(_readings(spark, folder))


def minute_agg_bitmap(spark, folder):
    """Sensors of each minute and of each day, counted from bitmaps; those of a day are merged from its minutes."""
    readings = _readings(spark, folder)
    minutes = materialize(aggregates.window_bitmaps(readings, aggregates.sensor_numbers(readings)), "bitmaps")
    parts = [minutes, aggregates.merged_bitmaps(minutes, "1 day")]
    return aggregates.bitmap_counts(parts[0]).unionByName(aggregates.bitmap_counts(parts[1]))


def minute_agg_id_list_minutes(spark, folder):
    df = aggregates.minute_aggregate(_scored(spark, folder), sensor_ids="list")
    return _minute(df, F.array_join("sensor_ids", ","))


def minute_agg_id_list(spark, folder):
    df = aggregates.minute_aggregate(_scored(spark, folder), length="6 hours", sensor_ids="list")
    return _minute(df, F.array_join("sensor_ids", ","))


def hour_agg(spark, folder):
    df = aggregates.hour_aggregate(_scored(spark, folder))
    keys = ["window_start", "window_end", "sensor_type", "location", "reading_count"]
    return df.select(*keys, _r("avg_value"), "min_value", "max_value", "anomaly_count")


def _means(spark, folder, every, **options):
    df = aggregates.window_mean(_readings(spark, folder), START, STOP, every, **options)
    return df.withColumn("mean_value", F.round("mean_value", 8))


def window_mean(spark, folder):
    return _means(spark, folder, "1h")


def window_mean_filtered(spark, folder):
    return _means(spark, folder, "7h", sensor_types=["click", "view"], locations=["Zone-1", "Zone-2", "Zone-3"])


def window_mean_collapsed(spark, folder):
    return _means(spark, folder, "1d", collapse=True)


def window_mean_months(spark, folder):
    return _means(spark, folder, "1mo", collapse=True)


# ---- reads of the table --------------------------------------------------------------------------------------------


def recent_readings(spark, folder):
    return reads.recent(_readings(spark, folder), 100, ("id", *reads.TABLE_COLUMNS))


def page_slice(spark, folder):
    return reads.recent_page(_readings(spark, folder))


def reading_by_id(spark, folder):
    return reads.reading_by_id(_readings(spark, folder), 42)


def sensor_history(spark, folder):
    return reads.sensor_history(_readings(spark, folder), "click_3", NOW, datetime(2024, 1, 1), NOW, limit=10)


def history_defaults(spark, folder):
    return reads.sensor_history(_readings(spark, folder), "view_5", NOW)


def history_count(spark, folder):
    return history_defaults(spark, folder).agg(F.count("*").alias("count"))


def series_limit(spark, folder):
    df = reads.series_limit(_readings(spark, folder), 3)
    return df.select("id", "sensor_id", "sensor_type", "location", "status", "ts", "value")


def stats(spark, folder):
    return reads.statistics(_readings(spark, folder)).summary


def sensors(spark, folder):
    return reads.statistics(_readings(spark, folder)).sensors


# ---- ingest --------------------------------------------------------------------------------------------------------


def _messages(spark: SparkSession, folder: str) -> DataFrame:
    """Readings as JSON messages, some of them broken by rule: text for numbers, bad times, missing fields, cut text."""
    df = _readings(spark, folder)
    i = F.col("id")
    body = F.struct(
        F.when(i % 83 != 0, F.col("sensor_id")).alias("sensor_id"),
        "sensor_type",
        "location",
        F.when(i % 89 == 0, F.lit("yesterday")).otherwise(F.col("ts").cast("string")).alias("timestamp"),
        F.when(i % 97 == 0, F.lit("abc")).otherwise(F.col("value").cast("string")).alias("value"),
        "unit",
        F.when(i % 79 != 0, F.col("status")).alias("status"),
        F.when(i % 3 != 0, F.col("metadata")).alias("metadata"),
    )
    text = F.to_json(body)
    text = F.when(i % 101 == 0, F.lit("{broken")).otherwise(text)
    return df.select(
        i,
        F.concat(F.lit("sensors."), "sensor_type").alias("topic"),
        F.lit(0).alias("partition"),
        i.alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        text.cast("binary").alias("value"),
    )


def validated(spark, folder):
    checked = validate.check_messages(_messages(spark, folder).select("id", "value"))
    named = F.get_json_object(F.to_json("metadata"), "$.k").try_cast("int").alias("k")
    ts = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts")
    return checked.valid.select("id", "sensor_id", "sensor_type", "location", ts, "value", "unit", "status", named)


def quarantined(spark, folder):
    return validate.check_messages(_messages(spark, folder).select("id", "value")).quarantine.select("id", "reject_reason")


def decoded(spark, folder):
    """Lenient decoding: a message that does not fit gives nulls. A number sent as text is none here."""
    df = validate.decode_and_enrich(_messages(spark, folder))
    kept = ["topic", "sensor_id", "sensor_type", "status", "hour", "day"]
    at = F.date_format("kafka_timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("arrived")
    return df.select(at, *kept, F.col("processing_time").isNotNull().alias("stamped"))


def routed(spark, folder):
    df = route_readings(_readings(spark, folder))
    body = F.from_json("value", "sensor_id string, value double, status string")
    return df.select("topic", "key", body.alias("b")).groupBy("topic", "key").agg(
        F.count("*").alias("messages"), F.round(F.sum("b.value"), 4).alias("total"), F.count("b.status").alias("statuses")
    )


# ---- rules and alerts ----------------------------------------------------------------------------------------------


def alarm_status(spark, folder):
    df = alerts.alarm_status(_readings(spark, folder).drop("status").withColumn("status", F.lit(None).cast("string")), _ranges(spark))
    return df.select("id", "sensor_type", "value", "range_lo", "range_hi", "status")


def threshold_anomaly(spark, folder):
    df = alerts.threshold_anomaly(_readings(spark, folder), _ranges(spark))
    return df.select("id", "value", "is_threshold_anomaly")


def clamped(spark, folder):
    """Values moved into the range of their type, in whole tenths."""
    df = alerts.alarm_status(_readings(spark, folder), _ranges(spark))
    value = F.round(alerts.clamp(F.col("value"), F.col("range_lo") + 20, F.col("range_hi") - 20), 1)
    return df.select("id", "sensor_type", value.alias("value"))


def _alerts(spark, folder):
    return alerts.build_alerts(rolling.only_anomalies(_scored(spark, folder)), _ranges(spark))


def built_alerts(spark, folder):
    return _alerts(spark, folder).select("alert_id", "sensor_id", "sensor_type", "timestamp", "value", "expected_range", "severity")


def recent_alerts(spark, folder):
    df = alerts.list_alerts(_alerts(spark, folder), NOW, hours=240, severity="high")
    return df.select("alert_id", "sensor_id", "timestamp", "value", "range_lo", "range_hi", "severity")


# ---- registry, points, changes -------------------------------------------------------------------------------------


def sensor_registry(spark, folder):
    return registry.list_sensors(registry.sensor_registry(_readings(spark, folder)), time_type="timestamp_ntz")


def registry_filtered(spark, folder):
    df = registry.sensor_registry(_readings(spark, folder))
    return registry.list_sensors(df, "click", "Zone-2", time_type="timestamp_ntz")


def latest_points(spark, folder):
    """Points at hour resolution, where later arrivals replace earlier ones."""
    df = _readings(spark, folder).withColumn("ts", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    return registry.latest_points(df)


def stored_readings(spark, folder):
    """A readings table that was created, appended to under new ids, and scanned."""
    path = scratch_path(spark, "readings")
    create_readings(spark, path)
    rows = _readings(spark, folder).withColumn("timestamp", F.col("ts").cast("timestamp"))
    append_readings(spark, path, rows)
    return _ntz(scan_readings(spark, path), "timestamp")


def tail(spark, folder):
    """What a subscriber sees: JSON objects, and errors for messages that are none."""
    data = live_tail(_messages(spark, folder))
    fields = [F.get_json_object("data", f"$.{c}").alias(c) for c in ("sensor_id", "location", "error")]
    return data.select(*fields).groupBy("sensor_id", "location", "error").agg(F.count("*").alias("messages"))


def _stored_points(spark: SparkSession, folder: str, start: datetime, stop: datetime) -> DataFrame:
    """Points written in two calls, read back for a time range."""
    readings = _readings(spark, folder)
    path = scratch_path(spark, "points")
    for part in (0, 1):
        write_points(readings.filter(F.col("id") % 2 == part), path)
    return read_points(spark, path, start, stop)


def points_history(spark, folder):
    points = _stored_points(spark, folder, datetime(2024, 1, 1), NOW)
    return reads.sensor_history(points, "click_3", NOW, datetime(2024, 1, 1), NOW, limit=10, ties=())


def points_window_mean(spark, folder):
    df = aggregates.window_mean(_stored_points(spark, folder, START, STOP), START, STOP, "1h")
    return df.withColumn("mean_value", F.round("mean_value", 8))


def window_mean_rollup(spark, folder):
    """The same means from hourly rollups, and points only at the ends of the range."""
    readings, path = _readings(spark, folder), scratch_path(spark, "points")
    for part in (0, 1):
        write_points_and_rollups(readings.filter(F.col("id") % 2 == part), f"{path}/points", f"{path}/rollups")
    df = window_mean_of_points(spark, f"{path}/points", f"{path}/rollups", START, STOP, "1h")
    return df.withColumn("mean_value", F.round("mean_value", 8))


def _changes(df: DataFrame) -> DataFrame:
    """Changes derived from the table: updates, deletes after updates or twice, inserts, and changes of unknown ids."""
    i = F.col("id")
    top = F.lit(10_000_000_000)
    op = (
        F.when(i % 7 == 0, F.array(F.lit("U")))
        .when(i % 11 == 0, F.array(F.lit("U"), F.lit("D")))
        .when(i % 13 == 0, F.array(F.lit("D"), F.lit("I"), F.lit("U")))
        .when(i % 17 == 0, F.array(F.lit("D"), F.lit("U")))
        .when(i % 19 == 0, F.array(F.lit("I"), F.lit("U")))
        .when(i % 23 == 0, F.array(F.lit("U")))
        .when(i % 29 == 0, F.array(F.lit("U"), F.lit("I")))
        .when(i % 31 == 0, F.array(F.lit("D"), F.lit("I")))
        .when(i % 37 == 0, F.array(F.lit("D"), F.lit("D")))
    )
    known = (i % 7 == 0) | (i % 11 == 0) | (i % 13 == 0) | (i % 17 == 0)
    twice = (i % 37 == 0) & (i % 19 != 0) & (i % 23 != 0) & (i % 29 != 0) & (i % 31 != 0)
    moved = F.when(known | twice, i).otherwise(i + top)
    rows = df.select(moved.alias("id"), *[c for c in df.columns if c != "id"], F.posexplode(op).alias("p", "op"))
    return rows.withColumns({"value": F.col("value") + 1000 * (F.col("p") + 1), "seq": F.col("p").cast("bigint")}).drop("p")


def _applied(spark, folder):
    base = _readings(spark, folder).select("id", *reads.TABLE_COLUMNS)
    return changes.apply_changes(base, _changes(base))


def apply_changes(spark, folder):
    return _applied(spark, folder).snapshot.withColumn("value", F.round("value", 4))


def changes_not_found(spark, folder):
    return _applied(spark, folder).not_found


def changes_updated(spark, folder):
    return _applied(spark, folder).updated.withColumn("value", F.round("value", 4))


def _changed_table(spark: SparkSession, folder: str):
    """A stored table, changed by three batches one after the other."""
    base = _readings(spark, folder).select("id", *reads.TABLE_COLUMNS)
    table = StoredTable.create(spark, scratch_path(spark, "stored"), base.schema, ids_per_range=STORED_RANGE)
    table.load(base)
    log = materialize(_changes(base), "log")
    done = [table.apply(log.filter(F.col("seq") == batch)) for batch in range(3)]
    return table, done


def changes_stored(spark, folder):
    """The table after the changes, and the version before them, which is still there."""
    table, _ = _changed_table(spark, folder)
    states = [table.read(v).withColumn("state", F.lit(name)) for v, name in ((1, "before"), (table.latest(), "after"))]
    return states[0].unionByName(states[1]).withColumn("value", F.round("value", 4))


def changes_stored_not_found(spark, folder):
    _, (first, second, third) = _changed_table(spark, folder)
    return first.not_found.unionByName(second.not_found).unionByName(third.not_found)


def appended_twice(spark, folder):
    """Two appends to one table: ids without gaps, every row there."""
    rows = _readings(spark, folder).select("id", "sensor_id", "ts", "value")
    table = StoredTable.create(spark, scratch_path(spark, "stored"), rows.schema, ids_per_range=STORED_RANGE)
    for part in (0, 1):
        table.append(rows.filter(F.col("id") % 2 == part))
    value = F.round(F.sum("value"), 4).alias("value_sum")
    return table.read().agg(
        F.count("*").alias("rows"), F.count_distinct("id").alias("ids"), F.min("id").alias("first_id"), F.max("id").alias("last_id"), value
    )


def assigned_ids(spark, folder):
    """Appending gives every row its own id without gaps."""
    df = changes.assign_ids(_readings(spark, folder).select("sensor_id", "ts", "value"), 500)
    return df.agg(
        F.count("*").alias("rows"), F.min("id").alias("first_id"), F.max("id").alias("last_id"),
        F.sum("id").cast("bigint").alias("id_sum"),
    )


# ---- features and models -------------------------------------------------------------------------------------------

_EXACT = ("value", "hour", "day_of_week", "month", "value_diff", "value_diff_abs")


def _feature_columns(df: DataFrame) -> DataFrame:
    columns = []
    for c in rolling.FEATURES:
        digits = 8 if c.startswith(("rolling_mean", "value_", "deviation")) or c == "value" else 5
        columns.append(F.col(c).cast("int").alias(c) if c in rolling.CALENDAR_FEATURES else _r(c, digits))
    return df.select("id", "sensor_id", *columns)


def features_raw(spark, folder):
    return _feature_columns(rolling.raw_features(_readings(spark, folder)))


def features_filled(spark, folder):
    return _feature_columns(fill.prepare_features(_readings(spark, folder)))


def features_filled_split(spark, folder):
    """The same with the frame cut into 25 segments and more."""
    readings = _readings(spark, folder)
    return _feature_columns(fill.prepare_features(readings, fill_rows=readings.count() // 25))


def features_filled_per_sensor(spark, folder):
    return _feature_columns(fill.prepare_features(_readings(spark, folder), scope="sensor"))


def scaler_params(spark, folder):
    df = fit_scaler(fill.prepare_features(_readings(spark, folder)), dbscan.FEATURES)
    return df.select("sensor_type", "feature", _r("mean", 6), _r("scale", 6))


def _points(spark, folder):
    df = materialize(fill.prepare_features(_readings(spark, folder)), "features")
    return apply_scaler(df, fit_scaler(df, dbscan.FEATURES), dbscan.FEATURES)


def scaled_features(spark, folder):
    return _points(spark, folder).select("id", *[_r(c, 6) for c in dbscan.FEATURES])


def dbscan_noise(spark, folder):
    points = materialize(_points(spark, folder).select("sensor_type", "id", *dbscan.FEATURES), "points")
    return dbscan.dbscan(points, clusters=False)


def dbscan_clusters(spark, folder):
    points = materialize(_points(spark, folder).select("sensor_type", "id", *dbscan.FEATURES), "points")
    return dbscan.dbscan(points)


def value_quantiles(spark, folder):
    df = quantile_table(_readings(spark, folder), "sensor_type", "value", 0.1)
    return df.select("sensor_type", _r("quantile"))


def quantile_by_day(spark, folder):
    """The 0.1-quantile per type of a range of days, from stored daily sketches: whether its exact rank is within the bound."""
    readings, path = _readings(spark, folder), scratch_path(spark, "sketches")
    sketches.update_sketches(readings, path)
    first, last = START.date(), STOP.date()
    found = sketches.merged_quantile(spark.read.parquet(path), 0.1, first, last)
    inside = readings.filter(F.to_date("ts").between(F.lit(first), F.lit(last - timedelta(days=1))))
    slack = sketches.RANK_ERROR * F.col("n") + 1
    within = F.col("below").cast("double") <= 0.1 * F.col("n") + slack
    within &= F.col("up_to").cast("double") >= 0.1 * F.col("n") - slack
    return sketches.rank_bounds(inside, found).select("sensor_type", "n", within.alias("within"))


def forest_training(spark, folder):
    """Share of anomalies per type in the data an isolation forest was trained on: a tenth, by its threshold."""
    models = outliers.train(_readings(spark, folder), models=(outliers.ISOLATION,))
    return models.summary().select("model_key", "rows", _r("anomaly_ratio", 2))


def outlier_predictions(spark, folder):
    """Both models, trained on all readings, stored, loaded again, and applied to them. Features and DBSCAN's labels of
    these readings are the same in training and after it, so they are computed once."""
    readings = _readings(spark, folder)
    path = scratch_path(spark, "models")
    same = {"features": outliers.prepared(readings)}
    same["labels"] = outliers.clustered(same["features"])
    outliers.save_models(outliers.train(readings, **same), path)
    return outliers.predict(outliers.load_models(spark, path), readings, **same)


def outlier_facts(spark, folder):
    """What has to hold for the predictions: a row per reading and model, DBSCAN's share of noise, a tenth of the readings
    flagged by the forest that was trained on them, and scores whose sign is the flag."""
    df = outlier_predictions(spark, folder)
    exact = F.avg(F.col("is_anomaly").cast("double"))
    share = F.when(F.col("model") == "dbscan", F.round(exact, 4)).otherwise(F.round(exact, 1)).alias("share")
    agrees = F.coalesce((F.col("score") < 0) == F.col("is_anomaly"), F.lit(True))
    return df.groupBy("sensor_type", "model").agg(F.count("*").alias("rows"), share, F.bool_and(agrees).alias("agrees"))


# ---- streams -------------------------------------------------------------------------------------------------------


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    schema = spark.read.parquet(f"{folder}/events.parquet").schema
    events = spark.readStream.schema(schema).parquet(f"{folder}/events.parque[t]")
    return readings_from_events(events).withColumn("ts", F.col("ts").cast("timestamp")).drop("metadata")


def _stream_scored(spark: SparkSession, folder: str) -> tuple[RollingScorer, DataFrame]:
    stream = _event_stream(spark, folder)
    path = scratch_path(spark, "stream")
    scorer = RollingScorer(f"{path}/flow")
    start_scoring(stream, scorer, f"{path}/checkpoint", available_now=True).awaitTermination()
    return scorer, scorer.read(spark, stream=True, reading=stream.schema)


def _run(df: DataFrame, spark: SparkSession) -> DataFrame:
    """Run a stream over what there is, into Parquet, and read the result."""
    path = scratch_path(spark, "sink")
    writer = df.writeStream.format("parquet").option("checkpointLocation", f"{path}/checkpoint").outputMode("append")
    writer.trigger(availableNow=True).start(f"{path}/rows").awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{path}/rows")


def _ntz(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def stream_scored(spark, folder):
    scorer, _ = _stream_scored(spark, folder)
    return _ntz(_score_columns(scorer.read(spark)), "ts")


def _event_files(spark: SparkSession, folder: str, files: int = 4) -> str:
    """The readings as files in time order, one after the other, for a stream that takes one per micro-batch."""
    rows = _readings(spark, folder).withColumn("ts", F.col("ts").cast("timestamp")).drop("metadata")
    first, last = rows.agg(F.min("ts").cast("double"), F.max("ts").cast("double")).first()
    path = scratch_path(spark, "files")
    part = F.least(F.floor((F.col("ts").cast("double") - first) / (last - first) * files), F.lit(files - 1))
    for i in range(files):
        rows.filter(part == i).coalesce(1).write.mode("append").parquet(path)
    return path


def stream_scored_stateful(spark, folder):
    """Rolling scores by Spark's own state and timers, over four micro-batches."""
    path, out = _event_files(spark, folder), scratch_path(spark, "stateful")
    stream = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 1).parquet(path)
    start_state_scoring(stream, f"{out}/rows", f"{out}/checkpoint", available_now=True).awaitTermination()
    return _ntz(_score_columns(spark.read.parquet(f"{out}/rows")), "ts")


def stream_quarantined(spark, folder):
    """Messages that fail the checks, as a stream writes them with the reason."""
    path, out = scratch_path(spark, "messages"), scratch_path(spark, "quarantine")
    _messages(spark, folder).write.parquet(path)
    messages = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    rejected = validate.check_messages(messages.select("id", "value")).quarantine
    options = {"path": f"{out}/rows"}
    write_topic(rejected, "quarantine", f"{out}/checkpoint", fmt="parquet", options=options, available_now=True).awaitTermination()
    return spark.read.parquet(f"{out}/rows").select("id", "reject_reason")


#: Late days come last: two files set the watermark, the others are behind it; the last one follows a restart.
_LATE_FILES = (("2024-01-21", "2024-01-26"), ("2024-01-26", "2024-02-05"), ("2023-12-01", "2024-01-11"), ("2024-01-11", "2024-01-21"))


def stream_dropped(spark, folder):
    """Groups of readings that came behind the watermark, summed over the reports of two runs."""
    readings = _readings(spark, folder).withColumn("ts", F.col("ts").cast("timestamp")).drop("metadata")
    path, out = scratch_path(spark, "late"), scratch_path(spark, "accounts")
    log = ProgressLog(spark, f"{out}/reports", ("late_hours",))
    spark.streams.addListener(log)
    try:
        for files in (_LATE_FILES[:3], _LATE_FILES[3:]):
            for start, stop in files:
                part = readings.filter((F.col("ts") >= F.lit(start).cast("timestamp")) & (F.col("ts") < F.lit(stop).cast("timestamp")))
                part.coalesce(1).write.mode("append").parquet(path)
            stream = spark.readStream.schema(readings.schema).option("maxFilesPerTrigger", 1).parquet(path).withWatermark("ts", "2 minutes")
            counts = stream.groupBy(F.window("ts", "1 hour"), "sensor_type", "location").count()
            writer = counts.writeStream.queryName("late_hours").format("parquet").option("path", f"{out}/rows")
            writer.option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    finally:
        log.stop()
    return stream_accounts(spark, f"{out}/reports").select("name", "rows", "dropped")


def stream_minute_agg(spark, folder):
    _, scored = _stream_scored(spark, folder)
    df = _minute(_run(minute_stream(scored, "counts"), spark), _counted_ids())
    return _ntz(df, "window_start", "window_end")


def stream_hour_agg(spark, folder):
    _, scored = _stream_scored(spark, folder)
    df = _run(hour_stream(scored), spark).withColumn("avg_value", F.round("avg_value", 8))
    return _ntz(df, "window_start", "window_end")


def stream_registry(spark, folder):
    stream = _event_stream(spark, folder)
    path = scratch_path(spark, "registry")
    keeper = RegistryKeeper(f"{path}/snapshots")
    start_scoring(stream, keeper, f"{path}/checkpoint", "registry", available_now=True).awaitTermination()
    return _ntz(keeper.latest(spark), "last_seen")


def entry(spark: SparkSession) -> DataFrame:
    return anomalies(spark, "/root/testdata/sf0.001")


_QUERIES: tuple[Callable[[SparkSession, str], DataFrame], ...] = (
    rolling_zscore,
    rolling_zscore_chunked,
    anomalies,
    minute_agg,
    minute_agg_numbers,
    window_sensors,
    minute_agg_bitmap,
    minute_agg_id_list,
    minute_agg_id_list_minutes,
    hour_agg,
    window_mean,
    window_mean_filtered,
    window_mean_collapsed,
    window_mean_months,
    recent_readings,
    page_slice,
    reading_by_id,
    sensor_history,
    history_defaults,
    history_count,
    series_limit,
    stats,
    sensors,
    validated,
    quarantined,
    decoded,
    routed,
    alarm_status,
    threshold_anomaly,
    clamped,
    built_alerts,
    recent_alerts,
    sensor_registry,
    registry_filtered,
    latest_points,
    stored_readings,
    tail,
    points_history,
    points_window_mean,
    window_mean_rollup,
    apply_changes,
    changes_not_found,
    changes_updated,
    changes_stored,
    changes_stored_not_found,
    appended_twice,
    assigned_ids,
    features_raw,
    features_filled,
    features_filled_split,
    features_filled_per_sensor,
    scaler_params,
    scaled_features,
    dbscan_noise,
    dbscan_clusters,
    value_quantiles,
    quantile_by_day,
    forest_training,
    outlier_predictions,
    outlier_facts,
    stream_scored,
    stream_scored_stateful,
    stream_quarantined,
    stream_dropped,
    stream_minute_agg,
    stream_hour_agg,
    stream_registry,
)


def _present(name: str) -> bool:
    """True for a module or package with files; a folder left behind without any is none."""
    spec = importlib.util.find_spec(name)
    return spec is not None and spec.origin is not None


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {q.__name__: q for q in _QUERIES}
    if _present("gaugeline.llm"):
        from gaugeline.llm.queries import QUERIES

        found |= QUERIES
        if _present("corpus_pipeline"):
            import corpus_pipeline

            found["pipeline"] = corpus_pipeline.run
    return found


def oracle_sql() -> dict[str, str]:
    from oracles import ORACLES

    found = dict(ORACLES)
    if _present("gaugeline.llm"):
        from gaugeline.llm.queries import ORACLES as MORE

        found |= MORE
        if _present("corpus_pipeline"):
            import corpus_pipeline

            found |= {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return found
