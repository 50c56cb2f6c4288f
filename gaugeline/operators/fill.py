"""Gap filling along the time order: the next value, else the last one, else zero."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from gaugeline.operators.rolling import FEATURES, ORDER, raw_features
from gaugeline.plans.chunks import CHUNK, PLAIN, ROWS_PER_CHUNK, prefixed, same_key, split_groups
from gaugeline.plans.joins import broadcast_if_small
from gaugeline.plans.scan import FAN, carried_over

FILL_ROWS_PER_CHUNK = 250_000



def _segments(rows: DataFrame, keys: list[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per chunk of a split group the first and the last value of each column."""
    at = F.struct(*order)
    ends = []
    for c in columns:
        known = F.when(F.col(c).isNotNull(), at)
        ends += [F.min_by(c, known).alias(f"_first_{c}"), F.max_by(c, known).alias(f"_last_{c}")]
    return rows.filter(F.col(CHUNK) != PLAIN).groupBy(*keys, CHUNK).agg(*ends)


def fill_gaps(
    df: DataFrame,
    columns: Sequence[str],
    order: Sequence[str] = ORDER,
    scope: str = "frame",
    sensor: str = "sensor_id",
    rows_per_chunk: int = FILL_ROWS_PER_CHUNK,
    fan: int = FAN,
) -> DataFrame:
    """Fill `columns` with the next value in `order`, else the last one, else 0.

    scope "frame" runs over all rows, across sensors; "sensor" keeps every sensor to itself. The frame is never sorted
    in one task: chunks are filled on their own, and what crosses a chunk border comes from a scan over a table
    of one row per chunk.
    """
    if scope not in ("frame", "sensor"):
        raise ValueError(f"unknown scope {scope!r}")
    keys = [sensor] if scope == "sensor" else []
    parts = split_groups(df, keys, order, halo=0, rows_per_chunk=rows_per_chunk)
    here = Window.partitionBy(*keys, CHUNK)
    # "First value from here on" read backwards is a running last; a frame to the end would rescan it for every row.
    backward = here.orderBy(*[F.desc(o) for o in order]).rowsBetween(Window.unboundedPreceding, 0)
    forward = here.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = parts.rows.select(
        "*",
        *[F.last(c, ignorenulls=True).over(forward).alias(f"_ffill_{c}") for c in columns],
        *[F.last(c, ignorenulls=True).over(backward).alias(f"_bfill_{c}") for c in columns],
    )
    picks = {c: [f"_bfill_{c}", f"_ffill_{c}"] for c in columns}
    if parts.split:
        carry = carried_over(_segments(parts.rows, keys, order, columns), keys, CHUNK, columns, fan)
        carry = broadcast_if_small(prefixed(carry, [*keys, CHUNK]))
        rows = rows.join(carry, same_key(rows, carry, [*keys, CHUNK]), "left")
        picks = {c: [f"_bfill_{c}", f"_next_{c}", f"_ffill_{c}", f"_prev_{c}"] for c in columns}
    types = dict(df.dtypes)
    filled = [
        F.coalesce(*picks[c], F.lit(0)).cast(types[c]).alias(c) if c in picks else F.col(c) for c in df.columns
    ]
    return rows.select(*filled)


def prepare_features(
    df: DataFrame, scope: str = "frame", rows_per_chunk: int = ROWS_PER_CHUNK, fill_rows: int = FILL_ROWS_PER_CHUNK
) -> DataFrame:
    """All model features of the given readings, without nulls. Nothing outside `df` is looked at."""
    return fill_gaps(
        raw_features(df, rows_per_chunk=rows_per_chunk), FEATURES, scope=scope, rows_per_chunk=fill_rows
    )
