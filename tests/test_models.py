import itertools
from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from helpers import brute_dbscan, frame, reading
from pyspark.sql import functions as F

import __spark_entry__ as entry
from gaugeline.operators import dbscan, forest, quantile
from gaugeline.operators.quantile import exact_quantile, quantile_table
from gaugeline.operators.rolling import FEATURES
from gaugeline.operators.scaler import apply_scaler, fit_scaler
from gaugeline.plans import outliers
from gaugeline.plans.components import connected_components
from gaugeline.plans.scratch import local_table

XS = ["x0", "x1", "x2", "x3"]


def points(spark, rows):
    return spark.createDataFrame(rows, "sensor_type string, id bigint, x0 double, x1 double, x2 double, x3 double")


def check_dbscan(spark, rows, clusters=True, **options):
    table = points(spark, rows).repartition(3)
    expected = brute_dbscan(pd.DataFrame(rows, columns=["sensor_type", "id", *XS]), 0.5, 5)
    got = dbscan.dbscan(table, XS, clusters=clusters, **options).collect()
    if clusters:
        assert {r["id"]: r["label"] for r in got} == expected
    assert {r["id"]: r["is_anomaly"] for r in got} == {i: label == -1 for i, label in expected.items()}
    assert len(got) == len(rows)


def mixed_rows():
    """Dense and loose clouds, scattered points, and copies of a point."""
    rng = np.random.default_rng(7)
    blobs = [rng.normal(0, 0.35, (160, 4)), rng.normal(2.2, 0.15, (150, 4)), rng.uniform(-3, 4, (90, 4))]
    copies = np.repeat([[1.0, 1.0, 1.0, 1.0], [0.9, 0.0, 0.0, 0.0]], [60, 3], axis=0)
    return [("ab"[i % 2], i, *map(float, p)) for i, p in enumerate(np.vstack([*blobs, copies]))]


def test_dbscan_clusters_on_mixed_densities_with_hot_cells(spark):
    check_dbscan(spark, mixed_rows(), hot_rows=10)


def test_dbscan_noise_on_mixed_densities(spark):
    check_dbscan(spark, mixed_rows(), clusters=False)


@pytest.mark.parametrize("clusters", [True, False])
def test_dbscan_over_many_ranges(spark, clusters):
    """Clusters that cross ranges of a few items are one, and a chain of them too."""
    chain = [("a", 1000 + i, 5.0 + 0.12 * i, 0.1 * (i % 3), -2.0, 0.07 * i) for i in range(120)]
    check_dbscan(spark, mixed_rows() + chain, clusters=clusters, range_items=25)


def test_dbscan_cuts_crowded_boxes_only_where_needed(spark, monkeypatch):
    """Points and pairs of cells that a range's boxes leave open are decided by smaller boxes."""
    calls = []
    for name in ("_found", "_linked"):
        whole = getattr(dbscan, name)
        monkeypatch.setattr(dbscan, name, lambda *a, _whole=whole, _name=name: (calls.append(_name), _whole(*a))[1])
    rng = np.random.default_rng(11)
    left = rng.uniform(0.0, [0.24, 0.05, 0.05, 0.05], (400, 4))
    right = rng.uniform([0.7, 0, 0, 0], [0.95, 0.05, 0.05, 0.05], (400, 4))
    lone = [(0.47, 0.42, 0.0, 0.0), (0.1, 0.52, 0.0, 0.1), (0.1, 0.0, 0.53, 0.01)]
    rows = [("a", i, *map(float, p)) for i, p in enumerate(np.vstack([left, right, lone]))]
    check_dbscan(spark, rows)
    check_dbscan(spark, rows, range_items=10)
    assert {"_found", "_linked"} <= set(calls)


def test_a_dbscan_task_is_bounded_in_a_dense_place(spark):
    """Few probes beside thousands of points that no box sums up: a task takes a part of these, and all are counted."""
    rng = np.random.default_rng(5)
    rows = [("a", i, *map(float, p)) for i, p in enumerate(rng.uniform(0, 0.9, (4000, 4)))]
    rows += [("a", 9000 + i, 1.2, 0.05 + 0.05 * i, 0.1, 0.1) for i in range(20)]
    grid = dbscan.Grid("sensor_type", XS, 0.5)
    table = points(spark, rows)
    boxes = dbscan._boxes(grid, table, dbscan.FIRST_LEVEL)
    cells = boxes.groupBy(*grid.cell).agg((F.sum("n") >= 5).alias("dense"))
    items = dbscan.materialize(dbscan._items(grid, table, boxes, None, cells), "items")
    sizes = [r["count"] for r in dbscan._around(grid, items.filter("NOT dense"), items, 40).count().collect()]
    assert max(sizes) < 1000 and sum(sizes) > 2000
    check_dbscan(spark, rows, range_items=40)


@pytest.mark.parametrize("clusters", [True, False])
def test_dbscan_tasks_get_only_the_columns_they_use(spark, monkeypatch, clusters):
    """Counting needs no ids and no spots, reaching no row numbers: a task holds a few copies of every column."""
    count, reach = dbscan.count_near, dbscan.reach_nodes

    def counted(rows, *options):
        assert not {"id", "s0", "s3"} & set(rows.columns), list(rows.columns)
        return count(rows, *options)

    def reached(rows, *options):
        assert not {"row", "n"} & set(rows.columns), list(rows.columns)
        return reach(rows, *options)

    monkeypatch.setattr(dbscan, "count_near", counted)
    monkeypatch.setattr(dbscan, "reach_nodes", reached)
    check_dbscan(spark, mixed_rows(), clusters=clusters, range_items=40)


def test_dbscan_borders(spark):
    """By type: crowded cells whose nearest points are just inside (a) or outside (b) the radius; copies and lone
    points (c); a border point exactly on the radius of two clusters (d)."""
    rng = np.random.default_rng(3)
    rows = []
    for kind, gap in (("a", 0.4999), ("b", 0.5001)):
        left = rng.uniform([0.0, 0, 0, 0], [0.2, 0.02, 0.02, 0.02], (60, 4))
        right = rng.uniform([0.2 + gap, 0, 0, 0], [0.45 + gap, 0.02, 0.02, 0.02], (60, 4))
        left[0], right[0] = (0.2, 0, 0, 0), (0.2 + gap, 0, 0, 0)
        rows += [(kind, *map(float, p)) for p in np.vstack([left, right, [[0.95 + gap, 0.1, 0, 0]]])]
    rows += [("c", 0.1, 0.1, 0.1, 0.1)] * 5 + [("c", 5.0 * i + 9, 0.0, 0.0, 0.0) for i in range(4)]
    rows += [("d", 0.1, 0.1, 0.1, 0.1)] * 5 + [("d", 1.1, 0.1, 0.1, 0.1)] * 5 + [("d", 0.6, 0.1, 0.1, 0.1)]
    check_dbscan(spark, [(r[0], i, *r[1:]) for i, r in enumerate(rows)])


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 25)]
    star = [(100, 100 + i) for i in range(1, 20)]
    ring = [(200 + i, 200 + (i * 7 + 3) % 20) for i in range(20)]
    nodes = sorted({n for e in chain + star + ring for n in e} | {999})
    parent = {n: n for n in nodes}

    def find(n):
        return n if parent[n] == n else find(parent[n])

    for a, b in chain + star + ring:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    table = spark.createDataFrame([(n,) for n in nodes], "node bigint")
    for hot in (5,):
        got = connected_components(table, spark.createDataFrame(chain + star + ring, "a bigint, b bigint"), hot_rows=hot)
        assert dict(got.collect()) == {n: find(n) for n in nodes}


def test_scaler_is_population_scaled_and_survives_constants(spark):
    df = spark.createDataFrame([("a", 1, 1.0, 5.0), ("a", 2, 3.0, 5.0)], "sensor_type string, id bigint, x double, y double")
    params = fit_scaler(df, ["x", "y"])
    got = apply_scaler(df, params, ["x", "y"]).orderBy("id").collect()
    assert [(r["x"], r["y"]) for r in got] == [(-1.0, 0.0), (1.0, 0.0)]


@pytest.mark.parametrize("q", [0.0, 0.1, 0.5, 0.93, 1.0])
def test_exact_quantile(spark, q):
    rng = np.random.default_rng(1)
    rows = [("a", float(v)) for v in rng.lognormal(0, 3, 501)] + [("b", v) for v in [1.0] * 90 + [2.0] * 10 + [1e300]]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    got = exact_quantile(df, "g", "v", q)
    for g in "ab":
        assert got[g] == pytest.approx(np.quantile([v for k, v in rows if k == g], q), rel=1e-12)
    assert quantile_table(df, "g", "v", q, approximate=True).count() == 2


def test_quantile_of_extreme_and_many_values(spark, monkeypatch):
    inf = float("inf")
    rows = [("a", v) for v in [-inf] * 3 + [float(i) for i in range(15)] + [inf] * 3] + [(None, 4.0), (None, 6.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    assert exact_quantile(df, "g", "v", 0.5) == {"a": 7.0, None: 5.0}
    assert exact_quantile(df, "g", "v", 1.0)["a"] == inf
    monkeypatch.setattr(quantile, "FEW_VALUES", 10)
    monkeypatch.setattr(quantile, "ACCURACY", 50)
    rng = np.random.default_rng(2)
    values = np.concatenate([rng.normal(0, 1, 4000), [1e300, -1e300], np.full(500, 0.25)])
    df = spark.createDataFrame([("x", float(v)) for v in values], "g string, v double").repartition(4)
    for q in (0.0, 0.1, 0.55, 0.9999, 1.0):
        assert exact_quantile(df, "g", "v", q)["x"] == pytest.approx(np.quantile(values, q), rel=1e-12)
    monkeypatch.setattr(quantile, "MAX_GROUPS", 0)
    with pytest.raises(ValueError, match="groups"):
        exact_quantile(df, "g", "v", 0.5)


def test_trees_draw_from_all_rows(spark):
    df = spark.range(30_000).select("id", F.lit("t").alias("sensor_type"), F.rand(1).alias("x"))
    drawn = forest.sample_rows(df, {"t": 30_000}, trees=20, sample=64)
    per_tree = {r["tree"]: r["count"] for r in drawn.groupBy("tree").count().collect()}
    assert len(per_tree) == 20 and all(n == 64 for n in per_tree.values())
    again = forest.sample_rows(df.repartition(7), {"t": 30_000}, trees=20, sample=64)
    assert sorted(drawn.select("tree", "id").collect()) == sorted(again.select("tree", "id").collect())
    ids = [r["id"] for r in drawn.collect()]
    assert len(set(ids)) > 1100 and abs(np.mean(ids) - 15_000) < 1_500


def minute_frame(n=1000, outliers_at=50, offset=15.0):
    """One temperature sensor, a reading per minute, some of them far off."""
    rng = np.random.default_rng(42)
    values = rng.normal(22, 2, n)
    values[rng.choice(n, outliers_at, replace=False)] += rng.normal(offset, 5, outliers_at)
    return [reading(i, float(v), "TEST_001") for i, v in enumerate(values)]


@pytest.fixture(scope="module")
def trained(spark):
    other = [reading(5000 + i, float(i % 9), "P1", "pressure") for i in range(200)]
    return outliers.train(frame(spark, minute_frame() + other), trees=10)


def test_training_gives_models_by_type(spark, trained):
    keys = {r[0] for r in trained.keys().collect()}
    assert keys == {f"{t}_{m}" for t in ("temperature", "pressure") for m in ("isolation", "dbscan")}
    share = {r["model_key"]: r["anomaly_ratio"] for r in trained.summary().collect()}
    assert share["temperature_isolation"] == pytest.approx(0.1, abs=0.005)
    assert 0 < share["temperature_dbscan"] < 0.5
    sizes = trained.iforest_nodes.groupBy("sensor_type", "tree").count().agg(F.max("count"), F.count("*")).first()
    assert sizes[0] < 2 * forest.SAMPLE and sizes[1] == 20


def test_stored_models_find_obvious_outliers(spark, trained, folder):
    outliers.save_models(trained, f"{folder}/models")
    models = outliers.load_models(spark, f"{folder}/models")
    last = minute_frame()[-100:]
    rows = last[:90] + [r[:5] + (100.0,) + r[6:] for r in last[90:]]
    strange = [reading(9000 + i, 1.0, "X", "unknown") for i in range(5)]
    got = outliers.predict(models, frame(spark, rows + strange))
    found = {tuple(r) for r in got.filter("is_anomaly").select("id", "model").collect()}
    assert {(r[0], "isolation_forest") for r in rows[90:]} & found
    assert {r["sensor_type"] for r in got.select("sensor_type").distinct().collect()} == {"temperature"}
    by_forest = got.filter("model = 'isolation_forest'")
    assert by_forest.filter("is_anomaly <> (score < 0) OR is_anomaly <> (prediction = -1)").isEmpty()
    assert by_forest.count() == 100 and got.count() == 200


def test_training_and_applying_to_the_same_readings_share_features_and_labels(spark, monkeypatch):
    rows = minute_frame(600) + [reading(5000 + i, float(i % 9), "P1", "pressure") for i in range(200)]
    readings = frame(spark, rows)
    apart = outliers.predict(outliers.train(readings), readings).collect()
    calls = []
    for module, name in ((outliers, "prepare_features"), (outliers.dbscan, "dbscan")):
        whole = getattr(module, name)
        monkeypatch.setattr(module, name, lambda *a, _whole=whole, _name=name, **o: (calls.append(_name), _whole(*a, **o))[1])
    monkeypatch.setattr(entry, "_readings", lambda spark, folder: readings)
    together = entry.outlier_predictions(spark, "").collect()
    assert sorted(calls) == ["dbscan", "prepare_features"]
    assert sorted(map(str, together)) == sorted(map(str, apart)) and len(apart) == 1600


def test_tables_of_the_driver_start_no_python_workers(spark):
    rows = [("a", 1.5, -1.0), (None, float("inf"), 2.0)]
    df = local_table(spark, rows, "g string, lo double, hi double")
    assert [tuple(r) for r in df.collect()] == rows
    limits = quantile_table(df, "g", "lo", 0.5)
    empty = local_table(spark, [], forest.NODE_SCHEMA)
    assert empty.isEmpty() and empty.schema.simpleString() == spark.createDataFrame([], forest.NODE_SCHEMA).schema.simpleString()
    for table in (df, limits, empty):
        assert "ExistingRDD" not in table._jdf.queryExecution().toString()


def test_a_reader_during_a_save_sees_one_whole_version(spark, trained, folder, monkeypatch):
    path, seen = f"{folder}/models", []
    first = outliers.save_models(trained, path)
    changed = replace(trained, iforest_meta=trained.iforest_meta.limit(0), dbscan_meta=trained.dbscan_meta.limit(0))
    claimed = outliers.claim

    def slow(*args, **options):
        seen.append(outliers.load_models(spark, path).keys().count())  # all tables are written, the version is not there yet
        return claimed(*args, **options)

    monkeypatch.setattr(outliers, "claim", slow)
    second = outliers.save_models(changed, path)
    assert second == first + 1 and seen == [trained.keys().count()]
    assert outliers.load_models(spark, path).keys().count() == 0
    # Loaded models can be saved to where they came from.
    third = outliers.save_models(outliers.load_models(spark, path, first), path)
    assert third == second + 1 and outliers.load_models(spark, path).keys().count() == seen[0]
    monkeypatch.setattr(outliers, "KEPT_VERSIONS", 1)
    outliers.save_models(changed, path)
    assert outliers._versions(spark, path) == [third + 1]
    with pytest.raises(FileNotFoundError):
        outliers.load_models(spark, f"{folder}/none")


def test_only_present_models_answer(spark, trained):
    part = replace(trained, dbscan_meta=trained.dbscan_meta.filter("false"))
    got = outliers.predict(part, frame(spark, minute_frame()[:50]))
    assert {r["model"] for r in got.select("model").distinct().collect()} == {"isolation_forest"}
    assert {r["sensor_type"]: r["anomalies"] for r in outliers.count_anomalies(got).collect()}.keys() == {"temperature"}


def scaled_rows(spark, n=900):
    rng = np.random.default_rng(5)
    rows = [("a", i, *map(float, rng.normal(0, 1, 3))) for i in range(n)]
    return spark.createDataFrame(rows, "sensor_type string, id bigint, p double, q double, r double")


def test_samples_do_not_depend_on_partitions(spark):
    df = scaled_rows(spark)
    drawn = [
        sorted(forest.sample_rows(d, {"a": 900}, trees=7).select("tree", "id").collect())
        for d in (df.repartition(2), df.repartition(9))
    ]
    assert drawn[0] == drawn[1]
    counts = [sum(1 for r in drawn[0] if r["tree"] == t) for t in range(7)]
    assert counts == [forest.SAMPLE] * 7


def test_forest_is_reproducible_and_slices_agree(spark):
    df = scaled_rows(spark).unionByName(scaled_rows(spark, 400).withColumns({"sensor_type": F.lit("b"), "id": F.col("id") + 5000}))
    columns = ["p", "q", "r"]

    def scores(d, **options):
        nodes = forest.grow_forest(forest.sample_rows(d, {"a": 900, "b": 400}, trees=9), columns)
        scored = forest.score_rows(d, nodes, columns, 1300, **options)
        return {r["id"]: round(r["score_sample"], 9) for r in scored.select("id", "score_sample").collect()}

    first = scores(df.repartition(2))
    assert first == scores(df.repartition(6)) == scores(df, max_nodes=10)
    assert len(first) == 1300 and all(-1 < s < 0 for s in first.values())


def test_scores_follow_the_definition(spark):
    """Walk every row through the node table by hand."""
    df = scaled_rows(spark, 300)
    columns = ["p", "q", "r"]
    nodes = forest.grow_forest(forest.sample_rows(df, {"a": 300}, trees=4), columns).toPandas()
    table = spark.createDataFrame(nodes)
    tree = {(t, n): row for t, n, row in zip(nodes["tree"], nodes["node"], nodes.itertuples())}
    norm = 2 * (np.log(255) + 0.5772156649015329) - 2 * 255 / 256
    for r in forest.score_rows(df, table, columns, 300).filter("id < 20").collect():
        depth = 0.0
        for t in range(4):
            at = tree[t, 0]
            while at.feature >= 0:
                at = tree[t, at.left if r[columns[at.feature]] <= at.threshold else at.right]
            depth += at.path
        assert r["score_sample"] == pytest.approx(-(2 ** (-depth / 4 / norm)))


def test_model_features(spark):
    assert len(FEATURES) == 14 and set(dbscan.FEATURES) <= set(FEATURES)
    assert len(set(itertools.chain(FEATURES))) == 14
