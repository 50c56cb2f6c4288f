"""Prefix scans over segments that are too many for one task."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from gaugeline.plans.chunks import prefixed, same_key
from gaugeline.plans.joins import broadcast_if_small
from gaugeline.plans.scratch import materialize

FAN = 4096


def carried_over(segments: DataFrame, keys: Sequence[str], at: str, columns: Sequence[str], fan: int = FAN) -> DataFrame:
    """What crosses the borders of segments: (keys, at, _prev_c, _next_c) for each of `columns`.

    `segments` has one row per group and segment number `at` (0 or more), with the first and the last value that are not
    null, _first_c and _last_c. The pair is a monoid, so segments are combined in a tree: `fan` neighbours at a time, each
    level a written table, until a group has at most `fan` of them; on the way back every level adds what lies beyond it.
    """
    keys, ends = list(keys), [f"_{e}_{c}" for c in columns for e in ("first", "last")]
    segments = materialize(segments.select(*keys, at, *ends), "segments")
    top = (segments.agg(F.max(at)).first()[0] or 0) < fan
    block = f"{at}_block"
    rows = segments.withColumn(block, F.floor(F.col(at) / F.lit(fan)).cast("bigint"))
    inner = Window.partitionBy(*keys, F.lit(0) if top else block)
    before = inner.orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    after = inner.orderBy(F.desc(at)).rowsBetween(Window.unboundedPreceding, -1)
    found = rows.select(
        *keys, at, block,
        *[F.last(f"_last_{c}", ignorenulls=True).over(before).alias(f"_prev_{c}") for c in columns],
        *[F.last(f"_first_{c}", ignorenulls=True).over(after).alias(f"_next_{c}") for c in columns],
    )
    if top:
        return found.drop(block)
    summed = []
    for c in columns:
        for end, pick in (("first", F.min_by), ("last", F.max_by)):
            name = f"_{end}_{c}"
            summed.append(pick(name, F.when(F.col(name).isNotNull(), F.col(at))).alias(name))
    blocks = rows.groupBy(*keys, block).agg(*summed)
    outer = carried_over(blocks, keys, block, columns, fan)
    outer = outer.withColumnsRenamed({f"_{e}_{c}": f"_outer_{e}_{c}" for c in columns for e in ("prev", "next")})
    outer = broadcast_if_small(prefixed(outer, [*keys, block]))
    joined = found.join(outer, same_key(found, outer, [*keys, block]), "left")
    picked = [F.coalesce(f"_{e}_{c}", f"_outer_{e}_{c}").alias(f"_{e}_{c}") for c in columns for e in ("prev", "next")]
    return joined.select(*keys, at, *picked)
