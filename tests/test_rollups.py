"""Window means from rollups against window means over all points."""

from datetime import datetime, timedelta

import pytest
from helpers import T0, frame, random_readings, reading, same_rows

from gaugeline.operators.aggregates import window_mean
from gaugeline.sources.rollups import range_parts, window_mean_of_points, write_points_and_rollups


@pytest.fixture
def stored(spark, folder):
    rows = [(*r[:4], T0 + timedelta(minutes=37 * i), *r[5:]) for i, r in enumerate(random_readings(400))]  # ten days
    paths = f"{folder}/points", f"{folder}/rollups"
    for part in (rows[::2], rows[1::2]):
        write_points_and_rollups(frame(spark, part), *paths)
    return paths


RANGES = [(T0, T0 + timedelta(days=11)), (T0 + timedelta(days=1, hours=5, minutes=20), T0 + timedelta(days=7, hours=13)), (T0 + timedelta(hours=2), T0 + timedelta(hours=7))]


@pytest.mark.parametrize("start, stop", RANGES)
@pytest.mark.parametrize("every", ["1h", "1d", "7h", "90m", "1mo", "3d"])
def test_means_equal_those_of_points(spark, stored, start, stop, every):
    want = window_mean(spark.read.parquet(stored[0]), start, stop, every, locations=["hall"], collapse=every == "3d")
    same_rows(want, window_mean_of_points(spark, *stored, start, stop, every, locations=["hall"], collapse=every == "3d"), digits=5)


def test_whole_days_of_points_are_not_opened(spark, stored):
    start, stop = RANGES[1]
    ends, whole = range_parts(spark, *stored, start, stop, "1h")
    for e, day in zip(ends, ("2024-01-02", "2024-01-08"), strict=True):
        assert {str(r["date"]) for r in e.select("date").distinct().collect()} == {day}
        scan = e._jdf.queryExecution().executedPlan().toString()
        assert scan.split("PartitionFilters: [")[1].split("]")[0].count("date#") >= 2
    assert {str(r["date"]) for r in whole.select("date").distinct().collect()} == {f"2024-01-0{d}" for d in range(3, 8)}


def test_only_touched_days_are_summed_again(spark, stored):
    def files():
        return {f.split("date=")[1][:10]: f for f in sorted(spark.read.parquet(f"{stored[1]}/hours").inputFiles())}

    before = files()
    write_points_and_rollups(frame(spark, [reading(9000, 500.0, minute=60 * 24 * 3 + 5)]), *stored)
    after = files()
    assert {d for d in after if after[d] != before.get(d)} == {"2024-01-04"}
    day = spark.read.parquet(f"{stored[1]}/days").filter("date = '2024-01-04'")
    assert day.agg({"hi": "max"}).first()[0] == 500.0
    want = window_mean(spark.read.parquet(stored[0]), T0, datetime(2024, 1, 9), "1d")
    same_rows(want, window_mean_of_points(spark, *stored, T0, datetime(2024, 1, 9), "1d"))
