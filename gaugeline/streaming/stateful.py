"""Rolling z-scores on a stream by Spark's own keyed state and event-time timers.

Each group keeps two lists in the state store: rows that wait for the watermark, and what the last `preceding` released
rows leave to the frames of later ones (their values, and their squared distances to their own means). A timer at the
earliest waiting time releases all rows up to the watermark, in (time, id) order, with the same numbers as the batch
operator. The state is part of the query's checkpoint, so a restart goes on where the last micro-batch ended and a repeated
one changes nothing; nothing is read or written beside it.

A group is handled by one task, and what it keeps is bounded by the rows within the watermark's delay. Where a single
group is more than a task can take, use `RollingScorer`, which splits it. Rows without an event time never enter; rows
behind the watermark are dropped and counted by Spark.
"""

from collections.abc import Iterator, Sequence
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from gaugeline.operators.rolling import ORDER, PRECEDING, flag_anomalies, nan_to_null
from gaugeline.sources.topics import start

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
WAITING = "rows binary"
HISTORY = "value double, square double"
RELEASED = "row string, rolling_mean double, rolling_std double, z_score double"
ROWS_AT_ONCE = 20_000


def _trailing_means(x: np.ndarray, length: int) -> np.ndarray:
    """Mean of each value and those before it, `length` in all; NaN is no value. The first length - 1 only precede."""
    found = []
    for at in range(0, len(x) - length + 1, ROWS_AT_ONCE):
        frames = np.lib.stride_tricks.sliding_window_view(x[at : at + ROWS_AT_ONCE + length - 1], length)
        there = ~np.isnan(frames)
        count = there.sum(axis=1)
        found.append(np.where(there, frames, 0.0).sum(axis=1) / np.where(count, count, np.nan))
    return np.concatenate(found) if found else np.zeros(0)


def score_after(history: np.ndarray, values: np.ndarray, preceding: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(mean, deviation, z, history) of `values`, which follow the rows of `history` (value, square)."""
    before = np.full((preceding, 2), np.nan)
    if len(history):
        before[-len(history) :] = history[-preceding:]
    means = _trailing_means(np.concatenate([before[:, 0], values]), preceding + 1)
    squares = (values - means) ** 2
    deviations = np.sqrt(_trailing_means(np.concatenate([before[:, 1], squares]), preceding + 1))
    with np.errstate(divide="ignore", invalid="ignore"):
        z = np.where(deviations > 0, np.abs(values - means) / deviations, 0.0)
    left = np.concatenate([history.reshape(-1, 2), np.stack([values, squares], axis=1)])[-preceding:]
    return means, deviations, z, left


def _number(x: float) -> float | None:
    return None if np.isnan(x) else float(x)


def _packed(rows: pd.DataFrame) -> bytes:
    """Rows as one element of the state: a call for each row would cost far more than the row."""
    sink = pa.BufferOutputStream()
    table = pa.Table.from_pandas(rows, preserve_index=False)
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(bytes(data)).read_all().to_pandas()


class RollingState(StatefulProcessor):
    """Waiting rows, packed by the batch, and history of one group."""

    def __init__(self, preceding: int = PRECEDING):
        self.preceding = preceding

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", WAITING)
        self.history = handle.getListState("history", HISTORY)
        self.timer = handle.getValueState("timer", "ms bigint")

    def _wake(self, us: int) -> None:
        """Ask for a call once the watermark has reached a time."""
        ms = us // 1000 - 1  # timers before the watermark fire
        if self.timer.exists():
            old = self.timer.get()[0]
            if old <= ms:
                return
            self.handle.deleteTimer(old)
        self.handle.registerTimer(ms)
        self.timer.update((ms,))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        for part in rows:
            self.waiting.appendValue((_packed(part[["us", "id", "value", "row"]]),))
            self._wake(int(part["us"].min()))
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        until = timerValues.getCurrentWatermarkInMs() * 1000
        parts = [_unpacked(r[0]) for r in self.waiting.get()]
        rows = pd.concat(parts, ignore_index=True).sort_values(["us", "id"], kind="stable", ignore_index=True)
        count = int(rows["us"].searchsorted(until, "right"))
        ready, rest = rows.iloc[:count], rows.iloc[count:]
        self.timer.clear()
        if len(rest):
            self.waiting.put([(_packed(rest.iloc[at : at + ROWS_AT_ONCE]),) for at in range(0, len(rest), ROWS_AT_ONCE)])
            self._wake(int(rest["us"].iloc[0]))
        else:
            self.waiting.clear()
        if not len(ready):
            return
        history = np.array([[np.nan if x is None else x for x in r] for r in self.history.get()] if self.history.exists() else [], float)
        values = ready["value"].to_numpy(float)
        means, deviations, z, left = score_after(history.reshape(-1, 2), values, self.preceding)
        self.history.put([(_number(v), _number(s)) for v, s in left])
        out = pd.DataFrame({"row": ready["row"].to_numpy(), "rolling_mean": means, "rolling_std": deviations, "z_score": z})
        for at in range(0, count, ROWS_AT_ONCE):
            yield out.iloc[at : at + ROWS_AT_ONCE]

    def close(self) -> None:
        pass


def scored_by_state(
    readings: DataFrame,
    keys: Sequence[str] = ("sensor_type", "location"),
    order: Sequence[str] = ORDER,
    preceding: int = PRECEDING,
    delay: str = "2 minutes",
) -> DataFrame:
    """The stream of readings with rolling mean, deviation, z-score and flags, released by the watermark.

    `order` is the event time and an id (bigint) that tells equal times apart. Other columns travel as JSON.
    """
    time, ident = order
    schema = readings.schema
    rows = readings.filter(F.col(time).isNotNull()).withColumn("value", nan_to_null("value")).withWatermark(time, delay)
    slim = rows.select(
        F.to_json(F.struct(*keys)).alias("key"), F.unix_micros(time).alias("us"), F.col(ident).alias("id"), "value", F.col(time).alias("at"),
        F.to_json(F.struct(*[F.col(c) for c in schema.fieldNames()]), TIMES).alias("row"),
    )
    released = slim.groupBy("key").transformWithStateInPandas(
        RollingState(preceding), outputStructType=T.StructType.fromDDL(RELEASED), outputMode="Append", timeMode="EventTime"
    )
    whole = released.withColumn("row", F.from_json("row", schema, TIMES))
    numbers = [nan_to_null(c).alias(c) for c in ("rolling_mean", "rolling_std", "z_score")]
    return flag_anomalies(whole.select("row.*", *numbers))


def start_state_scoring(
    readings: DataFrame, path: str, checkpoint: str, name: str = "readings_scored_by_state", every: str = "5 seconds",
    available_now: bool = False, **options,
) -> StreamingQuery:
    """Run `scored_by_state` into Parquet at `path`, with its state in RocksDB."""
    spark = readings.sparkSession
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        writer = scored_by_state(readings, **options).writeStream.format("parquet").outputMode("append").queryName(name)
        return start(writer.option("checkpointLocation", f"{checkpoint}/{name}").option("path", path), every, available_now)
    finally:
        spark.conf.set(PROVIDER, before)
