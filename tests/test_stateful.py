"""Scores by Spark's keyed state against the batch, over micro-batches and a restart."""

from datetime import timedelta

import numpy as np
import pandas as pd
import pytest
from helpers import T0, frame, random_readings, reading, same_rows
from pyspark.sql import functions as F
from test_streaming import add_file, in_time_order, instants, stream

from gaugeline.operators.rolling import detect_anomalies
from gaugeline.streaming import stateful
from gaugeline.streaming.stateful import score_after, start_state_scoring


def run(spark, folder, **options):
    query = start_state_scoring(stream(spark, f"{folder}/in"), f"{folder}/out", f"{folder}/checkpoint", available_now=True, **options)
    query.awaitTermination()
    return query, spark.read.parquet(f"{folder}/out")


def test_micro_batches_and_a_restart_equal_the_batch(spark, folder):
    rows = in_time_order(700)
    for part in (rows[:250], rows[250:260], rows[260:500]):
        add_file(spark, f"{folder}/in", part)
    query, got = run(spark, folder, delay="0 seconds")
    assert sum(p["numInputRows"] > 0 for p in query.recentProgress) == 3
    same_rows(detect_anomalies(instants(frame(spark, rows[:500]))), got, digits=9)
    add_file(spark, f"{folder}/in", rows[500:])
    _, got = run(spark, folder, delay="0 seconds")
    same_rows(detect_anomalies(instants(frame(spark, rows))), got, digits=9)


def test_rows_wait_for_the_watermark_and_come_in_order(spark, folder):
    early = [reading(i, float(i), minute=i) for i in range(0, 30, 2)]
    add_file(spark, f"{folder}/in", early)
    add_file(spark, f"{folder}/in", [reading(100, 5.0, minute=27), reading(101, 5.0, minute=29), reading(102, 1.0, minute=60)])
    _, got = run(spark, folder)
    kept = sorted(early + [reading(100, 5.0, minute=27), reading(101, 5.0, minute=29)], key=lambda r: r[4])
    same_rows(detect_anomalies(instants(frame(spark, kept))), got, digits=9)
    assert got.filter("id = 102").isEmpty()


def test_null_keys_values_and_times(spark, folder):
    rows = [(*r[:3], None if i % 2 else "hall", *r[4:]) for i, r in enumerate(in_time_order(60))]
    nan = [(*reading(900, float("nan"))[:4], T0 + timedelta(minutes=70), float("nan"), "C", None)]
    none = [(*reading(901, 1.0)[:4], None, 1.0, "C", "NORMAL")]
    last = [reading(902, 1.0, minute=500)]
    add_file(spark, f"{folder}/in", rows + nan + none)
    add_file(spark, f"{folder}/in", last)
    _, got = run(spark, folder)
    same_rows(detect_anomalies(instants(frame(spark, rows + nan))), got, digits=9)


def test_waiting_rows_are_packed_by_the_batch(monkeypatch):
    """One call of the state for a batch of rows, not one element a row."""
    calls = []
    state = stateful.RollingState()
    state.waiting = type("L", (), {"appendValue": lambda _, v: calls.append(v), "appendList": lambda _, v: calls.extend(v)})()
    monkeypatch.setattr(state, "_wake", lambda us: None)
    rows = pd.DataFrame({"us": range(500), "id": range(500), "value": [1.0, np.nan] * 250, "row": ["{}"] * 500})
    list(state.handleInputRows("k", iter([rows]), None))
    assert len(calls) == 1
    pd.testing.assert_frame_equal(stateful._unpacked(calls[0][0]), rows)


@pytest.mark.parametrize("cuts", [[], [1], [3, 3, 50], list(range(0, 400, 7))])
def test_numbers_do_not_depend_on_where_batches_end(cuts):
    rng = np.random.default_rng(4)
    values = np.where(rng.random(400) < 0.1, np.nan, rng.normal(20, 5, 400))
    whole = score_after(np.zeros((0, 2)), values, 100)
    parts, history = [], np.zeros((0, 2))
    for part in np.split(values, cuts):
        *numbers, history = score_after(history, part, 100)
        parts.append(numbers)
    for a, b in zip(whole[:3], map(np.concatenate, zip(*parts)), strict=True):
        assert np.allclose(a, b, equal_nan=True)
