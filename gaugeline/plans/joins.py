"""Joins that stay safe when a side is larger, or a key hotter, than expected."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

BROADCAST_ROWS = 100_000


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """True when `df` has at most `max_rows` rows. Stops counting one row past the bound."""
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after the size was checked; otherwise leave the join to Spark's sort-merge and skew split."""
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df


def lookup_join(facts: DataFrame, dim: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join a fact table with a dimension table of a checked size."""
    return facts.join(broadcast_if_small(dim), list(on), how)


HOT_ROWS = 2_000_000
MAX_HOT_KEYS = 20_000


def hot_safe_join(
    facts: DataFrame, dim: DataFrame, on: Sequence[str], how: str = "inner", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Join (inner or left) with a table of one row per key, where one key may hold a large part of `facts`.

    Keys with more than `hot_rows` rows are counted first. Their few table rows are broadcast, so their facts stay
    where they are; the rest is joined as usual.
    """
    on = list(on)
    counts = facts.groupBy(*on).count()
    total, largest = counts.agg(F.sum("count"), F.max("count")).first()
    hot_rows = max(hot_rows, (total or 0) // MAX_HOT_KEYS)
    if not total or largest <= hot_rows:
        return facts.join(dim, on, how)
    # Fewer than total / hot_rows <= MAX_HOT_KEYS keys are above the bound.
    hot_keys = counts.filter(F.col("count") > hot_rows).select(*on)
    hot = F.broadcast(facts.sparkSession.createDataFrame(hot_keys.collect(), hot_keys.schema))
    hot_dim = F.broadcast(dim.join(hot, on, "left_semi"))
    from_hot = facts.join(hot, on, "left_semi").join(hot_dim, on, how)
    return from_hot.unionByName(facts.join(hot, on, "left_anti").join(dim, on, how))
