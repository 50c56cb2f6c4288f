import numpy as np
import pandas as pd
import pytest
from helpers import frame, random_readings, reading, same_rows
from pyspark.sql import functions as F

from gaugeline.operators.fill import fill_gaps, prepare_features
from gaugeline.operators.rolling import FEATURES, detect_anomalies, raw_features, rolling_zscore
from gaugeline.plans.chunks import CHUNK, OWN, split_groups
from gaugeline.plans.scan import carried_over


def scored(df):
    return {r["id"]: r for r in detect_anomalies(df).collect()}


def test_frame_holds_the_row_and_100_before(spark):
    rows = scored(frame(spark, [reading(i, 1000.0 if i == 1 else 0.0) for i in range(1, 104)]))
    assert rows[101]["rolling_mean"] == pytest.approx(1000 / 101)
    assert rows[102]["rolling_mean"] == 0


def test_deviation_uses_each_rows_own_mean(spark):
    values = [1.0, 4.0, 2.0, 8.0]
    rows = scored(frame(spark, [reading(i, v) for i, v in enumerate(values)]))
    means = [np.mean(values[: i + 1]) for i in range(4)]
    expected = np.sqrt(np.mean([(v - m) ** 2 for v, m in zip(values, means)]))
    assert rows[3]["rolling_std"] == pytest.approx(expected)
    assert rows[3]["z_score"] == pytest.approx(abs(8 - means[3]) / expected)


def test_constant_and_single_rows_have_score_zero(spark):
    rows = scored(frame(spark, [reading(i, 7.0) for i in range(5)] + [reading(9, 3.0, location="roof")]))
    assert {r["z_score"] for r in rows.values()} == {0.0}
    assert rows[9]["rolling_std"] == 0


def test_nan_and_null_values_do_not_spread(spark):
    rows = scored(frame(spark, [reading(0, 1.0), reading(1, float("nan")), reading(2, None), reading(3, 3.0)]))
    assert rows[1]["value"] is None and rows[1]["is_anomaly_statistical"] is False
    assert rows[3]["rolling_mean"] == 2.0


def test_flags_follow_null_logic(spark):
    rows = scored(frame(spark, [reading(0, 1.0, status=None), reading(1, 1.0, status="LOW_ALARM"), reading(2, 1.0)]))
    assert rows[0]["is_anomaly_status"] is None and rows[0]["is_anomaly"] is None
    assert rows[1]["is_anomaly"] is True and rows[2]["is_anomaly"] is False


def test_equal_times_are_ordered_by_id(spark):
    rows = scored(frame(spark, [reading(2, 10.0, minute=0), reading(1, 20.0, minute=0)]))
    assert rows[1]["rolling_mean"] == 20 and rows[2]["rolling_mean"] == 15


@pytest.mark.parametrize("rows_per_chunk", [15, 90, 400])
def test_split_groups_change_nothing(spark, rows_per_chunk):
    df = frame(spark, random_readings(1200))
    plain = rolling_zscore(df)
    same_rows(plain, rolling_zscore(df.repartition(7), rows_per_chunk=rows_per_chunk))


def test_split_groups_on_instants_and_null_keys(spark):
    df = frame(spark, random_readings(600)).withColumn("ts", F.col("ts").cast("timestamp"))
    same_rows(rolling_zscore(df), rolling_zscore(df, rows_per_chunk=40))


def test_chunks_are_bounded_contiguous_and_whole(spark):
    df = frame(spark, random_readings(2000, hot=0.9))
    parts = split_groups(df, ["sensor_id"], ["ts", "id"], halo=19, rows_per_chunk=200)
    assert parts.split
    own = parts.rows.filter(OWN)
    assert own.count() == 2000 and own.select("id").distinct().count() == 2000
    sizes = own.groupBy("sensor_id", CHUNK).agg(F.count("*").alias("n"), F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    rows = sorted((r[CHUNK], r["n"], r["lo"], r["hi"]) for r in sizes.filter("sensor_id = 'hot'").collect())
    assert len(rows) > 5 and max(r[1] for r in rows) <= 2 * 200
    assert all(a[3] <= b[2] for a, b in zip(rows, rows[1:]))


def test_small_groups_keep_their_plain_plan(spark):
    df = frame(spark, random_readings(2000, hot=0.9))
    rows = split_groups(df, ["sensor_id"], ["ts", "id"], halo=5, rows_per_chunk=300).rows
    assert {r["sensor_id"] for r in rows.filter(F.col(CHUNK) >= 0).select("sensor_id").distinct().collect()} == {"hot"}
    plain = rows.filter(F.col(CHUNK) < 0)
    assert plain.filter("sensor_id = 'hot'").isEmpty() and plain.filter(~F.col(OWN)).isEmpty()


@pytest.mark.parametrize("fan", [2, 3, 100])
def test_values_are_carried_over_levels_of_segments(spark, fan):
    rng = np.random.default_rng(fan)
    rows = [
        (k, at, *(None if rng.random() < 0.7 else float(rng.integers(100)) for _ in range(2)))
        for k in ("a", None) for at in sorted(rng.choice(200, 60, replace=False).tolist())
    ]
    rows = [(k, at, x, x if y is None or x is None else y) for k, at, x, y in rows]  # a segment has both ends or none
    df = spark.createDataFrame(rows, "k string, at int, _first_v double, _last_v double")
    got = {(r["k"], r["at"]): (r["_prev_v"], r["_next_v"]) for r in carried_over(df, ["k"], "at", ["v"], fan).collect()}
    for k, at, _, _ in rows:
        before = [y for j, t, _, y in rows if j == k and t < at and y is not None]
        after = [x for j, t, x, _ in rows if j == k and t > at and x is not None]
        assert got[k, at] == (before[-1] if before else None, after[0] if after else None)


def test_equal_times_can_fill_a_group(spark):
    df = frame(spark, [reading(i, float(i % 17), minute=0) for i in range(700)])
    same_rows(rolling_zscore(df), rolling_zscore(df, rows_per_chunk=60))


def pandas_features(rows):
    df = pd.DataFrame(rows, columns=["id", "sensor_id", "t", "l", "ts", "value", "u", "s"]).sort_values(["ts", "id"])
    by = df.groupby("sensor_id")["value"]
    for n in (5, 20):
        df[f"rolling_mean_{n}"] = by.transform(lambda v: v.rolling(n, min_periods=1).mean())
        df[f"rolling_std_{n}"] = by.transform(lambda v: v.rolling(n, min_periods=1).std())
        df[f"deviation_from_mean_{n}"] = (df["value"] - df[f"rolling_mean_{n}"]).abs()
        df[f"z_score_{n}"] = (df["value"] - df[f"rolling_mean_{n}"]) / (df[f"rolling_std_{n}"] + 1e-6)
    df["value_diff"] = by.diff()
    df["value_diff_abs"] = df["value_diff"].abs()
    df["hour"], df["day_of_week"], df["month"] = df["ts"].dt.hour, df["ts"].dt.dayofweek, df["ts"].dt.month
    return df


@pytest.mark.parametrize("scope", ["frame", "sensor"])
@pytest.mark.parametrize("rows_per_chunk", [10_000, 37])
def test_features_equal_pandas(spark, scope, rows_per_chunk):
    rows = random_readings(800)
    raw = pandas_features(rows)
    columns = list(FEATURES)
    if scope == "frame":
        filled = raw[columns].bfill().ffill().fillna(0)
    else:
        filled = raw.groupby("sensor_id")[columns].transform(lambda c: c.bfill().ffill()).fillna(0)
    expected = filled.assign(id=raw["id"]).sort_values("id")
    df = frame(spark, rows).repartition(5)
    got = prepare_features(df, scope, rows_per_chunk, fill_rows=rows_per_chunk).toPandas().sort_values("id")
    assert not got[columns].isnull().any().any()
    np.testing.assert_allclose(got[columns].to_numpy(float), expected[columns].to_numpy(float), rtol=1e-6, atol=1e-6)


def test_raw_features_start_with_gaps(spark):
    first = raw_features(frame(spark, [reading(0, 4.0), reading(1, 6.0)])).filter("id = 0").first()
    assert first["rolling_std_5"] is None and first["value_diff"] is None and first["z_score_5"] is None
    assert first["day_of_week"] == 0 and first["hour"] == 0 and first["month"] == 1


@pytest.mark.parametrize("rows_per_chunk", [4, 100])
def test_fill_runs_across_chunks_and_ends_with_zero(spark, rows_per_chunk):
    values = [None] * 7 + [1.0] + [None] * 15 + [2.0, 3.0] + [None] * 9
    rows = [(i, None if v is None else float(v), None) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "id bigint, a double, b double").withColumn("ts", F.col("id"))
    got = fill_gaps(df, ["a", "b"], rows_per_chunk=rows_per_chunk, fan=2).orderBy("id").collect()
    expected = pd.Series(values, dtype=float).bfill().ffill().fillna(0)
    assert [r["a"] for r in got] == expected.tolist()
    assert {r["b"] for r in got} == {0.0}
