"""Hard negatives against all scores, and the bounds against the scores they bound."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gaugeline.llm import negatives

COLUMNS = "vec_id bigint, label int, embedding array<float>"


def plain_codes(x):
    return [math.floor(256 * float(np.float32(v))) for v in x]


def plain_negatives(rows, step=10):
    usable = [
        (i, c, plain_codes(e)) for i, c, e in rows
        if i is not None and c is not None and e is not None and all(v is not None and math.isfinite(v) for v in e)
    ]
    found = set()
    for i, c, a in usable:
        if i % step:
            continue
        others = {(-sum(x * y for x, y in zip(a, b)), j, d == c) for j, d, b in usable if j != i}
        for ps, p in sorted((s, j) for s, j, same in others if same)[:5]:
            low, high = 30 * -ps, 90 * -ps
            fits = sorted({(s, j) for s, j, same in others if not same and low <= 100 * -s <= high})
            found |= {(i, p, rank, j, -ps, -s) for rank, (s, j) in enumerate(fits[:10], 1)}
    return sorted(found)


def mined(spark, rows, step=10):
    return sorted(map(tuple, negatives.hard_negatives(spark.createDataFrame(rows, COLUMNS), F.col("vec_id") % step == 0).collect()))


def clustered(n, seed, dim=64, hot=0.3):
    """Clusters with their own labels, a vector that a third of the rows share, and ties."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 0.3, (8, dim))
    rows = []
    for i in range(n):
        k = int(rng.integers(8))
        v = centres[0] if rng.random() < hot else np.round(centres[k] + rng.normal(0, 0.1, dim), 1)
        rows.append((i, int(rng.integers(4)) if rng.random() < 0.5 else k % 4, v.astype(np.float32).tolist()))
    return rows


@pytest.mark.parametrize("dim", [1, 7, 64, 130])
def test_equal_to_all_scores(spark, dim):
    rows = clustered(300, dim, dim)
    assert mined(spark, rows) == plain_negatives(rows)


def test_rounds_and_blocks_change_nothing(spark, monkeypatch):
    rows = clustered(1500, 5)
    want = plain_negatives(rows)
    monkeypatch.setattr(negatives, "FIRST_ROWS", 40)
    monkeypatch.setattr(negatives, "GROWTH", 6)
    monkeypatch.setattr(negatives, "BLOCK_BYTES", 64 * 8 * 60)
    monkeypatch.setattr(negatives, "ANCHORS_AT_ONCE", 7)
    assert want and mined(spark, rows) == want


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 2.0]), (10, 1, []), (20, 2, [0.0, 0.0]), (30, None, [1.0]), (40, 1, None), (50, 1, [1.0, None]),
        (60, 1, [nan, 1.0]), (70, 1, [1.0, -inf]), (None, 1, [1.0, 1.0]), (1, 1, [1.0, 1.0, 5.0]), (1, 1, [1.0, 1.0, 5.0]),
        (2, 1, [2.0]), (3, 2, [1.0, 0.5]), (3, 2, [1.0, 0.5]), (4, 2, [0.5, 0.5]), (5, 3, [-1.0, -1.0]), (80, 3, [-2.0, -1.0]),
        (-10, 1, [1.0, 2.0]), (1, 1, [0.5]), (0, 1, [1.0, 2.0]), (9, 1, [0.0]), (8, 2, [0.0]),
    ]
    assert mined(spark, rows) == plain_negatives(rows) != []
    assert mined(spark, []) == mined(spark, [(1, 1, [1.0])]) == []
    wide = spark.createDataFrame(rows, COLUMNS).withColumns({c: F.lit(1) for c in ("anchor", "score", "id", "codes", "list", "positive")})
    assert sorted(map(tuple, negatives.hard_negatives(wide, F.col("vec_id") % 10 == 0).collect())) == plain_negatives(rows)


def test_huge_components_are_cut(spark):
    rows = [(0, 1, [1e30, 1.0]), (1, 1, [1e30, 0.0]), (2, 2, [5e4, 0.0]), (3, 2, [-1e30, 0.0])]
    got = mined(spark, rows)
    limit = math.isqrt((1 << 55) // 64)
    assert got == [(0, 1, 1, 2, limit * limit, limit * 256 * 50_000)]


def _vectors(x, ids=None):
    x = negatives.padded(np.asarray(x, np.int64))
    flat = np.hstack([p for pair in negatives.summaries(x) for p in pair])
    return negatives.Vectors(np.arange(len(x)) if ids is None else ids, np.zeros(len(x), np.int64), x.astype(np.int32), flat)


@pytest.mark.parametrize("scale", [1, 300, 20_000_000])
def test_bounds_hold_and_tighten(scale):
    rng = np.random.default_rng(1)
    centre = rng.integers(-scale, scale + 1, 128)
    x = np.concatenate([rng.integers(-scale, scale + 1, (40, 128)), centre + rng.integers(-scale // 9, scale // 9 + 1, (40, 128))])
    v = _vectors(x)
    exact = (x.astype(object) @ x.T.astype(object)).astype(float)
    widths = []
    for s in negatives._split(v.flat, 128):
        under, over = negatives.bounds(s, s)
        assert (under <= exact).all() and (exact <= over).all()
        widths.append(float((over - under).mean()))
    assert widths[0] > widths[1] > widths[2]
    assert (negatives.scores(v.codes, v.codes) == exact).all() or scale > 1000
    assert (negatives.scores(v.codes, v.codes).astype(object) == x.astype(object) @ x.T.astype(object)).all()


def test_summaries_drop_most_pairs_and_no_wanted_one():
    rng = np.random.default_rng(2)
    steps = np.repeat(rng.integers(-200, 200, (20, 32)), 4, axis=1)
    x = steps[rng.integers(0, 20, 2000)] + rng.integers(-5, 6, (2000, 128))
    rows, anchors = _vectors(x), _vectors(x[:30])
    exact = negatives.scores(anchors.codes, rows.codes)
    among = np.ones(exact.shape, bool)
    least = np.full(30, -np.inf)
    left = negatives.survivors(anchors, rows, least, -least, among, best=5)
    assert (np.sort(np.where(left, exact, -(1 << 60)), axis=1)[:, -5:] == np.sort(exact, axis=1)[:, -5:]).all()
    assert left.mean() < 0.2


def test_stored_summaries_fill_up():
    x = np.arange(1, 71).reshape(1, 70)
    stored = pa.array([x[0].tolist(), [], [5]], pa.list_(pa.int32()))
    batch = pa.record_batch({
        "vec_id": pa.array([3, 1, 2]), "label": pa.array([0, 0, 0]), "codes": stored, "summary": negatives._summarise(stored),
    })
    v = negatives.Vectors.of(batch, 128)
    assert v.ids.tolist() == [1, 2, 3]
    whole = _vectors(v.codes)
    assert np.allclose(v.flat, whole.flat)
