"""The registered queries as plain SQL over the same tables. Each one states its rule by itself."""

READINGS = """
readings AS (
  SELECT event_id + 1 AS id,
         event_type || '_' || CAST(user_id % 20 AS VARCHAR) AS sensor_id,
         event_type AS sensor_type,
         'Zone-' || CAST((user_id % 20) % 11 AS VARCHAR) AS location,
         ts, value,
         CASE event_type WHEN 'click' THEN 'clicks' WHEN 'error' THEN 'errors' WHEN 'purchase' THEN 'EUR'
                         WHEN 'signup' THEN 'users' WHEN 'view' THEN 'views' ELSE 'n/a' END AS unit,
         CASE WHEN value > 150 THEN 'HIGH_ALARM' WHEN value < 1 THEN 'LOW_ALARM' ELSE 'NORMAL' END AS status,
         CAST(props->>'k' AS INTEGER) AS k
  FROM events)"""

SCORED = f"""{READINGS},
means AS (
  SELECT *, avg(value) OVER w AS m FROM readings
  WINDOW w AS (PARTITION BY sensor_type, location ORDER BY ts, id ROWS BETWEEN 100 PRECEDING AND CURRENT ROW)),
deviations AS (
  SELECT *, sqrt(avg((value - m) * (value - m)) OVER w) AS s FROM means
  WINDOW w AS (PARTITION BY sensor_type, location ORDER BY ts, id ROWS BETWEEN 100 PRECEDING AND CURRENT ROW)),
scored AS (
  SELECT *, z > 3.0 AS is_anomaly_statistical, status IN ('HIGH_ALARM', 'LOW_ALARM') AS is_anomaly_status,
         (z > 3.0) OR status IN ('HIGH_ALARM', 'LOW_ALARM') AS is_anomaly
  FROM (SELECT *, CASE WHEN s > 0 THEN abs(value - m) / s ELSE 0.0 END AS z FROM deviations))"""

SCORE_COLUMNS = """id, sensor_id, ts, value, round(m, 8) AS rolling_mean, round(s, 5) AS rolling_std,
  round(z, 5) AS z_score, is_anomaly_statistical, is_anomaly_status, is_anomaly"""

RELEASED = f"{SCORED}, released AS (SELECT * FROM scored WHERE ts <= (SELECT max(ts) FROM events) - INTERVAL 2 MINUTE)"


def _minute(source: str, length: str, ids: str, having: str = "") -> str:
    start = f"time_bucket(INTERVAL '{length}', ts, TIMESTAMP '1970-01-01')"
    return f"""
  SELECT w AS window_start, w + INTERVAL '{length}' AS window_end, sensor_type, location,
         CAST(sum(n) AS BIGINT) AS reading_count, round(any_value(avg_v), 8) AS avg_value,
         min(lo) AS min_value, max(hi) AS max_value, round(any_value(sd), 5) AS stddev_value,
         CAST(sum(bad) AS BIGINT) AS anomaly_count, {ids} AS sensor_ids
  FROM (SELECT w, sensor_type, location, sensor_id, count(*) AS n, min(value) AS lo, max(value) AS hi,
               count(*) FILTER (WHERE is_anomaly) AS bad, any_value(avg_v) AS avg_v, any_value(sd) AS sd
        FROM (SELECT *, avg(value) OVER p AS avg_v, stddev_samp(value) OVER p AS sd
              FROM (SELECT *, {start} AS w FROM {source}) WINDOW p AS (PARTITION BY w, sensor_type, location))
        GROUP BY w, sensor_type, location, sensor_id)
  GROUP BY w, sensor_type, location {having}"""


COUNTED = "string_agg(sensor_id || ':' || CAST(n AS VARCHAR), ',' ORDER BY sensor_id)"
LISTED = "string_agg(rtrim(repeat(sensor_id || ',', n), ','), ',' ORDER BY sensor_id)"


def _hour(source: str, having: str = "") -> str:
    return f"""
  SELECT w AS window_start, w + INTERVAL 1 HOUR AS window_end, sensor_type, location, count(*) AS reading_count,
         round(avg(value), 8) AS avg_value, min(value) AS min_value, max(value) AS max_value,
         count(*) FILTER (WHERE is_anomaly) AS anomaly_count
  FROM (SELECT *, date_trunc('hour', ts) AS w FROM {source}) GROUP BY w, sensor_type, location {having}"""


# A stream emits a window once the watermark has passed its end. The highest event time it has seen is that of the
# released rows.
SEEN = "(SELECT max(ts) FROM released)"


def _means(text: str, start: str, end: str, key: str, where: str = "") -> str:
    return f"""WITH {READINGS}
  SELECT least(e, TIMESTAMP '2024-01-25 13:15:00') AS "timestamp", {key}, round(avg(value), 8) AS mean_value,
         '{text}' AS "window"
  FROM (SELECT *, {start} AS b, {end} AS e FROM readings
        WHERE ts >= TIMESTAMP '2024-01-05 03:30:00' AND ts < TIMESTAMP '2024-01-25 13:15:00' {where})
  GROUP BY b, e, {key}"""


def _bucket(length: str) -> tuple[str, str]:
    start = f"time_bucket(INTERVAL '{length}', ts, TIMESTAMP '1970-01-01')"
    return start, f"{start} + INTERVAL '{length}'"


SERIES = "sensor_id, sensor_type, location, status"
TABLE = "sensor_id, sensor_type, value, unit, ts, location"

JUDGED = f"""{READINGS},
judged AS (
  SELECT *, CASE WHEN id % 101 = 0 THEN 'malformed'
                 WHEN id % 83 = 0 THEN 'missing sensor_id'
                 WHEN id % 79 = 0 THEN 'missing status'
                 WHEN id % 97 = 0 THEN 'value is not a number'
                 WHEN id % 89 = 0 THEN 'timestamp is not a time' END AS reject_reason
  FROM readings)"""

ALERTS = f"""{SCORED},
alerts AS (
  SELECT sha256(sensor_id || '|' || rtrim(rtrim(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), '0'), '.')) AS alert_id,
         sensor_id, sensor_type, ts, value, '(1.0, 150.0)' AS expected_range,
         CASE WHEN is_anomaly_status AND is_anomaly_statistical THEN 'critical' WHEN is_anomaly_status THEN 'high'
              ELSE 'medium' END AS severity
  FROM scored WHERE is_anomaly)"""

REGISTRY = f"""{READINGS},
registry AS (
  SELECT sensor_id, sensor_type, location, ts AS last_seen, status, total_readings
  FROM (SELECT *, row_number() OVER (PARTITION BY sensor_id ORDER BY id DESC) AS r,
               count(*) OVER (PARTITION BY sensor_id) AS total_readings FROM readings) WHERE r = 1)"""

CHANGES = f"""{READINGS},
kinds AS (
  SELECT *, CASE WHEN id % 7 = 0 THEN 7 WHEN id % 11 = 0 THEN 11 WHEN id % 13 = 0 THEN 13 WHEN id % 17 = 0 THEN 17
                 WHEN id % 19 = 0 THEN 19 WHEN id % 23 = 0 THEN 23 WHEN id % 29 = 0 THEN 29 WHEN id % 31 = 0 THEN 31
                 WHEN id % 37 = 0 THEN 37 ELSE 0 END AS kind FROM readings)"""

FEATURES = f"""{READINGS},
rolled AS (
  SELECT *, avg(value) OVER w5 AS rolling_mean_5, stddev_samp(value) OVER w5 AS rolling_std_5,
         avg(value) OVER w20 AS rolling_mean_20, stddev_samp(value) OVER w20 AS rolling_std_20,
         value - lag(value) OVER (PARTITION BY sensor_id ORDER BY ts, id) AS value_diff
  FROM readings
  WINDOW w5 AS (PARTITION BY sensor_id ORDER BY ts, id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
         w20 AS (PARTITION BY sensor_id ORDER BY ts, id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)),
features AS (
  SELECT id, sensor_id, sensor_type, ts, value, CAST(hour(ts) AS INTEGER) AS hour,
         CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week, CAST(month(ts) AS INTEGER) AS month,
         rolling_mean_5, rolling_std_5, rolling_mean_20, rolling_std_20, value_diff, abs(value_diff) AS value_diff_abs,
         abs(value - rolling_mean_5) AS deviation_from_mean_5, abs(value - rolling_mean_20) AS deviation_from_mean_20,
         (value - rolling_mean_5) / (rolling_std_5 + 1e-6) AS z_score_5,
         (value - rolling_mean_20) / (rolling_std_20 + 1e-6) AS z_score_20
  FROM rolled)"""

FEATURE_NAMES = (
    "value", "hour", "day_of_week", "month", "rolling_mean_5", "rolling_std_5", "rolling_mean_20", "rolling_std_20",
    "value_diff", "value_diff_abs", "deviation_from_mean_5", "deviation_from_mean_20", "z_score_5", "z_score_20",
)
GAPS = ("rolling_std_5", "rolling_std_20", "value_diff", "value_diff_abs", "z_score_5", "z_score_20")


def _filled(partition: str) -> str:
    order = f"{partition} ORDER BY ts, id"
    ahead = f"OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    behind = f"OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    columns = [
        f"coalesce(first_value({c} IGNORE NULLS) {ahead}, last_value({c} IGNORE NULLS) {behind}, 0) AS {c}"
        if c in GAPS else c for c in FEATURE_NAMES
    ]
    return f"{FEATURES}, filled AS (SELECT id, sensor_id, sensor_type, {', '.join(columns)} FROM features)"


def _feature_columns() -> str:
    out = []
    for c in FEATURE_NAMES:
        if c in ("hour", "day_of_week", "month"):
            out.append(c)
        else:
            digits = 8 if c.startswith(("rolling_mean", "value", "deviation")) else 5
            out.append(f"round({c}, {digits}) AS {c}")
    return "id, sensor_id, " + ", ".join(out)


DENSITY = ("value", "rolling_mean_5", "rolling_std_5", "value_diff")
SCALED = f"""{_filled('')},
scaled AS (
  SELECT f.sensor_type, id, {', '.join(f'({c} - m_{c}) / s_{c} AS {c}' for c in DENSITY)}
  FROM filled f JOIN (
    SELECT sensor_type, {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}' for c in DENSITY)}
    FROM filled GROUP BY sensor_type) p ON f.sensor_type = p.sensor_type)"""

DISTANCE = " + ".join(f"(p.{c} - q.{c}) * (p.{c} - q.{c})" for c in DENSITY)

CLUSTERS = f"""WITH RECURSIVE {SCALED},
near AS MATERIALIZED (
  SELECT p.sensor_type, p.id AS a, q.id AS b FROM scaled p JOIN scaled q
    ON p.sensor_type = q.sensor_type AND q.value BETWEEN p.value - 0.51 AND p.value + 0.51 WHERE {DISTANCE} <= 0.25),
core AS MATERIALIZED (SELECT a FROM near GROUP BY a HAVING count(*) >= 5),
links AS MATERIALIZED (SELECT a, b FROM near WHERE a IN (SELECT a FROM core) AND b IN (SELECT a FROM core)),
smallest(a, l) USING KEY (a) AS (
  SELECT a, a FROM core
  UNION SELECT n.a, min(s.l) FROM smallest s JOIN links n ON n.b = s.a JOIN recurring.smallest c ON c.a = n.a
  WHERE s.l < c.l GROUP BY n.a),
around AS (SELECT n.a, min(s.l) AS l FROM near n JOIN smallest s ON s.a = n.b GROUP BY n.a),
clusters AS (
  SELECT sensor_type, id, coalesce(s.l, r.l, -1) AS label, coalesce(s.l, r.l) IS NULL AS is_anomaly
  FROM scaled LEFT JOIN smallest s ON s.a = id LEFT JOIN around r ON r.a = id)"""

POINTS = f"""{READINGS},
points AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {SERIES}, ts ORDER BY id % 2 DESC, id DESC) AS r FROM readings)
  WHERE r = 1)"""

APPLIED = f"""WITH {CHANGES}
  SELECT id, {TABLE.replace('value', 'round(value, 4) AS value')} FROM kinds WHERE kind IN (0, 19, 23, 29, 31)
  UNION ALL SELECT id, {TABLE.replace('value', 'round(value + 1000, 4)')} FROM kinds WHERE kind = 7
  UNION ALL SELECT id, {TABLE.replace('value', 'round(value + 3000, 4)')} FROM kinds WHERE kind = 13
  UNION ALL SELECT id + 10000000000, {TABLE.replace('value', 'round(value + 2000, 4)')} FROM kinds
    WHERE kind IN (19, 29, 31)"""

NOT_FOUND = f"""WITH {CHANGES} SELECT id, CAST(1 AS BIGINT) AS seq FROM kinds WHERE kind IN (17, 37)
  UNION ALL SELECT id + 10000000000, 0 FROM kinds WHERE kind IN (23, 29, 31)"""

ORACLES = {
    "rolling_zscore": f"WITH {SCORED} SELECT {SCORE_COLUMNS} FROM scored",
    "rolling_zscore_chunked": f"WITH {SCORED} SELECT {SCORE_COLUMNS} FROM scored",
    "anomalies": f"WITH {SCORED} SELECT {SCORE_COLUMNS} FROM scored WHERE is_anomaly",
    "minute_agg": f"WITH {SCORED} {_minute('scored', '1 minute', COUNTED)}",
    "minute_agg_numbers": f"""WITH {SCORED} SELECT * EXCLUDE (sensor_ids) FROM ({_minute('scored', '1 minute', COUNTED)})""",
    "window_sensors": f"""WITH {READINGS} SELECT w AS window_start, w + INTERVAL 1 MINUTE AS window_end, sensor_type, location,
          sensor_id, count(*) AS n FROM (SELECT *, date_trunc('minute', ts) AS w FROM readings) GROUP BY ALL""",
    "minute_agg_id_list_minutes": f"WITH {SCORED} {_minute('scored', '1 minute', LISTED)}",
    "minute_agg_bitmap": " UNION ALL ".join(
        f"""SELECT w AS window_start, w + INTERVAL 1 {unit} AS window_end, sensor_type, location, count(*) AS readings,
          count(DISTINCT sensor_id) AS sensors
        FROM (WITH {READINGS} SELECT *, date_trunc('{unit}', ts) AS w FROM readings) GROUP BY w, sensor_type, location"""
        for unit in ("minute", "day")
    ),
    "minute_agg_id_list": f"WITH {SCORED} {_minute('scored', '6 hours', LISTED)}",
    "hour_agg": f"WITH {SCORED} {_hour('scored')}",
    "window_mean": _means("1h", *_bucket("1 hour"), SERIES),
    "window_mean_filtered": _means(
        "7h", *_bucket("7 hours"), SERIES,
        "AND sensor_type IN ('click', 'view') AND location IN ('Zone-1', 'Zone-2', 'Zone-3')",
    ),
    "window_mean_collapsed": _means("1d", *_bucket("1 day"), "sensor_type, location"),
    "window_mean_months": _means(
        "1mo", "date_trunc('month', ts)", "date_trunc('month', ts) + INTERVAL 1 MONTH", "sensor_type, location"
    ),
    "recent_readings": f"WITH {READINGS} SELECT id, {TABLE} FROM readings ORDER BY id DESC LIMIT 100",
    "page_slice": f"""WITH {READINGS} SELECT id, sensor_id, value, unit, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS "time"
        FROM readings ORDER BY id DESC LIMIT 5 OFFSET 5""",
    "reading_by_id": f"WITH {READINGS} SELECT {TABLE} FROM readings WHERE id = 42",
    "sensor_history": f"""WITH {READINGS}
        SELECT ts AS "timestamp", sensor_id, value, sensor_type, location FROM (
          SELECT *, row_number() OVER (PARTITION BY {SERIES} ORDER BY ts, id) AS r FROM readings
          WHERE sensor_id = 'click_3' AND ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-31') WHERE r <= 10""",
    "history_defaults": f"""WITH {READINGS}
        SELECT ts AS "timestamp", sensor_id, value, sensor_type, location FROM readings
        WHERE sensor_id = 'view_5' AND ts >= TIMESTAMP '2024-01-30' AND ts < TIMESTAMP '2024-01-31'""",
    "history_count": f"""WITH {READINGS} SELECT count(*) AS "count" FROM readings
        WHERE sensor_id = 'view_5' AND ts >= TIMESTAMP '2024-01-30' AND ts < TIMESTAMP '2024-01-31'""",
    "series_limit": f"""WITH {READINGS} SELECT id, {SERIES}, ts, value FROM (
          SELECT *, row_number() OVER (PARTITION BY {SERIES} ORDER BY ts, id) AS r FROM readings) WHERE r <= 3""",
    "stats": f"""WITH {READINGS} SELECT (SELECT count(*) FROM readings) AS total_readings,
          (SELECT count(DISTINCT sensor_id) FROM readings) AS unique_sensors, sensor_id AS latest_sensor_id,
          sensor_type AS latest_sensor_type, value AS latest_value, unit AS latest_unit, location AS latest_location,
          ts AS latest_ts
        FROM readings ORDER BY ts DESC, id DESC LIMIT 1""",
    "sensors": f"WITH {READINGS} SELECT DISTINCT sensor_id FROM readings",
    "validated": f"""WITH {JUDGED} SELECT id, sensor_id, sensor_type, location,
          strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, value, unit, status, CASE WHEN id % 3 <> 0 THEN k END AS k
        FROM judged WHERE reject_reason IS NULL""",
    "quarantined": f"WITH {JUDGED} SELECT id, reject_reason FROM judged WHERE reject_reason IS NOT NULL",
    "decoded": f"""WITH {READINGS} SELECT strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS arrived,
          'sensors.' || sensor_type AS topic,
          CASE WHEN id % 101 <> 0 AND id % 83 <> 0 THEN sensor_id END AS sensor_id,
          CASE WHEN id % 101 <> 0 THEN sensor_type END AS sensor_type,
          CASE WHEN id % 101 <> 0 AND id % 79 <> 0 THEN status END AS status,
          CASE WHEN id % 101 <> 0 AND id % 89 <> 0 THEN CAST(hour(ts) AS INTEGER) END AS hour,
          CASE WHEN id % 101 <> 0 AND id % 89 <> 0 THEN CAST(dayofyear(ts) AS INTEGER) END AS day, true AS stamped
        FROM readings""",
    "routed": f"""WITH {READINGS} SELECT 'sensors.' || sensor_type AS topic, sensor_id AS "key", count(*) AS messages,
          round(sum(value), 4) AS total, count(status) AS statuses FROM readings GROUP BY 1, 2""",
    "alarm_status": f"""WITH {READINGS} SELECT id, sensor_type, value, CAST(1 AS DOUBLE) AS range_lo,
          CAST(150 AS DOUBLE) AS range_hi, status FROM readings""",
    "threshold_anomaly": f"WITH {READINGS} SELECT id, value, value >= 120 AS is_threshold_anomaly FROM readings",
    "built_alerts": f"""WITH {ALERTS} SELECT alert_id, sensor_id, sensor_type, ts AS "timestamp", value, expected_range,
          severity FROM alerts""",
    "recent_alerts": f"""WITH {ALERTS} SELECT alert_id, sensor_id, ts AS "timestamp", value,
          CAST(1 AS DOUBLE) AS range_lo, CAST(150 AS DOUBLE) AS range_hi, severity FROM alerts
        WHERE severity = 'high' AND ts >= TIMESTAMP '2024-01-21' ORDER BY ts DESC, alert_id""",
    "sensor_registry": f"WITH {REGISTRY} SELECT * FROM registry",
    "registry_filtered": f"WITH {REGISTRY} SELECT * FROM registry WHERE sensor_type = 'click' AND location = 'Zone-2'",
    "latest_points": f"""WITH {READINGS} SELECT {SERIES}, h AS ts, value, CAST(h AS DATE) AS date FROM (
          SELECT *, row_number() OVER (PARTITION BY {SERIES}, h ORDER BY id DESC) AS r
          FROM (SELECT *, date_trunc('hour', ts) AS h FROM readings)) WHERE r = 1""",
    "apply_changes": APPLIED,
    "changes_stored": f"""SELECT *, 'after' AS state FROM ({APPLIED})
        UNION ALL SELECT *, 'before' FROM (WITH {READINGS} SELECT id, {TABLE.replace('value', 'round(value, 4) AS value')} FROM readings)""",
    "changes_not_found": NOT_FOUND,
    "changes_stored_not_found": NOT_FOUND,
    "changes_updated": f"""WITH {CHANGES}
        SELECT id, {TABLE.replace('value', 'round(value + 1000, 4) AS value')} FROM kinds WHERE kind = 7
        UNION ALL SELECT id, {TABLE.replace('value', 'round(value + 3000, 4)')} FROM kinds WHERE kind = 13
        UNION ALL SELECT id + 10000000000, {TABLE.replace('value', 'round(value + 2000, 4)')} FROM kinds WHERE kind = 19""",
    "appended_twice": """SELECT count(*) AS "rows", count(*) AS ids, CAST(1 AS BIGINT) AS first_id, count(*) AS last_id,
          round(sum(value), 4) AS value_sum FROM events""",
    "assigned_ids": """SELECT count(*) AS "rows", CAST(501 AS BIGINT) AS first_id, 500 + count(*) AS last_id,
          CAST(count(*) * 500 + count(*) * (count(*) + 1) / 2 AS BIGINT) AS id_sum FROM events""",
    "features_raw": f"WITH {FEATURES} SELECT {_feature_columns()} FROM features",
    "features_filled": f"WITH {_filled('')} SELECT {_feature_columns()} FROM filled",
    "features_filled_split": f"WITH {_filled('')} SELECT {_feature_columns()} FROM filled",
    "features_filled_per_sensor": f"WITH {_filled('PARTITION BY sensor_id')} SELECT {_feature_columns()} FROM filled",
    "scaler_params": f"WITH {_filled('')} "
    + " UNION ALL ".join(
        f"""SELECT sensor_type, '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS "scale"
        FROM filled GROUP BY sensor_type""" for c in DENSITY
    ),
    "scaled_features": f"WITH {SCALED} SELECT id, {', '.join(f'round({c}, 6) AS {c}' for c in DENSITY)} FROM scaled",
    "dbscan_noise": f"""WITH {SCALED},
        near AS MATERIALIZED (SELECT p.sensor_type, p.id AS a, q.id AS b FROM scaled p JOIN scaled q
          ON p.sensor_type = q.sensor_type AND q.value BETWEEN p.value - 0.51 AND p.value + 0.51
          WHERE {DISTANCE} <= 0.25),
        core AS (SELECT a FROM near GROUP BY a HAVING count(*) >= 5)
        SELECT sensor_type, id, id NOT IN (SELECT a FROM near WHERE b IN (SELECT a FROM core)) AS is_anomaly FROM scaled""",
    "value_quantiles": """SELECT event_type AS sensor_type, round(quantile_cont(value, 0.1), 8) AS quantile
        FROM events GROUP BY event_type""",
    "stream_dropped": f"""WITH {READINGS} SELECT 'late_hours' AS name, (SELECT count(*) FROM readings) AS "rows", count(*) AS dropped
        FROM (SELECT DISTINCT date_trunc('hour', ts), ts < TIMESTAMP '2024-01-11', sensor_type, location FROM readings
              WHERE ts < TIMESTAMP '2024-01-21')""",
    "clamped": """SELECT event_id + 1 AS id, event_type AS sensor_type, round(least(greatest(value, 21.0), 130.0), 1) AS value FROM events""",
    "quantile_by_day": """SELECT event_type AS sensor_type, count(*) AS n, true AS within FROM events
        WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-25' AND value IS NOT NULL GROUP BY event_type""",
    "stream_scored": f"WITH {RELEASED} SELECT {SCORE_COLUMNS} FROM released",
    "stream_scored_stateful": f"WITH {RELEASED} SELECT {SCORE_COLUMNS} FROM released",
    "stream_quarantined": f"WITH {JUDGED} SELECT id, reject_reason FROM judged WHERE reject_reason IS NOT NULL",
    "stream_minute_agg": f"WITH {RELEASED} "
    + _minute("released", "1 minute", COUNTED, f"HAVING w + INTERVAL 1 MINUTE <= {SEEN} - INTERVAL 2 MINUTE"),
    "stream_hour_agg": f"WITH {RELEASED} "
    + _hour("released", f"HAVING w + INTERVAL 1 HOUR <= {SEEN} - INTERVAL 1 HOUR"),
    "stream_registry": f"WITH {REGISTRY} SELECT * FROM registry",
    "dbscan_clusters": f"{CLUSTERS} SELECT * FROM clusters",
    "outlier_facts": f"""{CLUSTERS}
        SELECT sensor_type, 'dbscan' AS model, count(*) AS "rows", round(avg(CAST(is_anomaly AS INTEGER)), 4) AS share,
          true AS agrees FROM clusters GROUP BY sensor_type
        UNION ALL SELECT event_type, 'isolation_forest', count(*), 0.1, true FROM events GROUP BY event_type""",
    "forest_training": """SELECT event_type || '_isolation' AS model_key, count(*) AS "rows",
          CAST(0.1 AS DOUBLE) AS anomaly_ratio FROM events GROUP BY event_type""",
    "stored_readings": f"""WITH {READINGS} SELECT sensor_id, sensor_type, value, unit, ts AS "timestamp", location FROM readings""",
    "tail": f"""WITH {JUDGED} SELECT CASE WHEN id % 101 <> 0 AND id % 83 <> 0 THEN sensor_id END AS sensor_id,
          CASE WHEN id % 101 <> 0 THEN location END AS location,
          CASE WHEN id % 101 = 0 THEN 'not a JSON object' END AS error, count(*) AS messages FROM judged GROUP BY 1, 2, 3""",
    "points_history": f"""WITH {POINTS}
        SELECT ts AS "timestamp", sensor_id, value, sensor_type, location FROM (
          SELECT * EXCLUDE (r), row_number() OVER (PARTITION BY {SERIES} ORDER BY ts) AS n FROM points
          WHERE sensor_id = 'click_3' AND ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-31') WHERE n <= 10""",
}
ORACLES["points_window_mean"] = (
    ORACLES["window_mean"].replace(READINGS, POINTS).replace("AS e FROM readings", "AS e FROM points")
)
ORACLES["window_mean_rollup"] = ORACLES["points_window_mean"]
