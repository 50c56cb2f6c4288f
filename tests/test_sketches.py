"""Merged sketches against exact ranks."""

from datetime import date, timedelta

import numpy as np
import pytest
from helpers import T0, frame, reading

from gaugeline.operators.sketches import RANK_ERROR, merged_quantile, quantile_sketches, rank_bounds, update_sketches


def rows(n=6000):
    rng = np.random.default_rng(9)
    kinds = rng.choice(["a", "b", "c"], n, p=[0.7, 0.2, 0.1]).tolist()
    values = np.where(rng.random(n) < 0.3, 5.0, rng.lognormal(1, 2, n)).tolist()  # a value that a third of the rows share
    made = [(*reading(i, v, kind=k)[:4], T0 + timedelta(minutes=3 * i), *reading(i, v, kind=k)[5:]) for i, (k, v) in enumerate(zip(kinds, values))]
    return made + [reading(n, float("nan"), kind="a"), reading(n + 1, None, kind="a")]


@pytest.mark.parametrize("q", [0.0, 0.01, 0.1, 0.5, 0.99, 1.0])
def test_merged_ranks_are_within_the_bound(spark, q):
    df = frame(spark, rows())
    found = merged_quantile(quantile_sketches(df), q)
    got = rank_bounds(df, found).collect()
    assert len(got) == 3
    for r in got:
        assert r["below"] - RANK_ERROR * r["n"] <= q * r["n"] <= r["up_to"] + RANK_ERROR * r["n"] + 1


def test_a_range_takes_its_days_and_a_day_is_replaced(spark, folder):
    made, path = rows(), f"{folder}/sketches"
    df = frame(spark, made)
    update_sketches(df, path)
    start, stop = date(2024, 1, 3), date(2024, 1, 6)
    inside = [r for r in made[:-2] if start <= r[4].date() < stop]
    got = {r["sensor_type"]: r["n"] for r in merged_quantile(spark.read.parquet(path), 0.5, start, stop).collect()}
    assert got == {k: sum(r[2] == k for r in inside) for k in "abc"}
    day = [(*r[:5], 1.0, *r[6:]) for r in made[:-2] if r[4].date() == start]
    update_sketches(frame(spark, day), path)
    sketches = spark.read.parquet(path)
    one = {r["sensor_type"]: r["quantile"] for r in merged_quantile(sketches, 0.9, start, date(2024, 1, 4)).collect()}
    assert set(one.values()) == {1.0}
    assert sketches.agg({"n": "sum"}).first()[0] == len(made) - 2
