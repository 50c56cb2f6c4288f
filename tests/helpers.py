from datetime import datetime, timedelta

import numpy as np
import pandas as pd

T0 = datetime(2024, 1, 1)
COLUMNS = (
    "id bigint, sensor_id string, sensor_type string, location string, ts timestamp_ntz, value double, unit string, "
    "status string"
)


def reading(i, value, sensor="s1", kind="temperature", location="hall", status="NORMAL", minute=None):
    at = T0 + timedelta(minutes=i if minute is None else minute)
    return (i, sensor, kind, location, at, value, "C", status)


def frame(spark, rows):
    return spark.createDataFrame(rows, COLUMNS)


def random_readings(n, seed=42, hot=0.6):
    """Readings where one sensor holds most of the rows and some values and locations are missing."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        sensor = "hot" if rng.random() < hot else f"s{rng.integers(5)}"
        value = None if rng.random() < 0.03 else float(np.round(rng.normal(20, 5), 2))
        rows.append(reading(i, value, sensor, location=None if sensor == "s1" else "hall", minute=int(rng.integers(n // 2))))
    return rows


def same_rows(a, b, digits=6):
    def plain(df):
        rows = [
            tuple(round(x, digits) + 0.0 if isinstance(x, float) else x for x in r) for r in df.select(*a.columns).collect()
        ]
        return sorted(rows, key=lambda r: tuple((x is not None, str(x)) for x in r))

    assert plain(a) == plain(b)


def brute_dbscan(points: pd.DataFrame, eps: float, min_points: int) -> dict:
    """Labels by definition, over all pairs: smallest core id of the cluster, smallest label for border points, or -1."""
    none, labels = np.iinfo(np.int64).max, {}
    for _, g in points.groupby("sensor_type"):
        ids, x = g["id"].to_numpy(), g.drop(columns=["sensor_type", "id"]).to_numpy(float)
        near = np.array([((x - p) ** 2).sum(axis=1) <= eps * eps for p in x])
        core = near.sum(axis=1) >= min_points
        label = np.where(core, ids, none)
        while True:
            best = np.where(near & core[None, :], label[None, :], none).min(axis=1)
            new = np.where(core, np.minimum(label, best), none)
            if (new == label).all():
                break
            label = new
        border = np.where(near & core[None, :], label[None, :], none).min(axis=1)
        final = np.where(core, label, border)
        labels.update(zip(ids.tolist(), np.where(final == none, -1, final).tolist()))
    return labels
