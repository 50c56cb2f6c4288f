"""Size-bounded chunks of ordered groups.

A row frame such as "this row and the 100 before it" makes Spark sort a whole group in one task. One group may hold a
third of a 100 TB table, so groups above a bound are range-partitioned by (group, order): Spark samples the order, and
every partition holds about as many rows, however busy an hour or a sensor is. The sorted partitions are written once,
so every row keeps its place whatever happens to a task, and a chunk is what a run of `rows_per_chunk` places holds of a
group. It also receives the last rows of the chunks before it (the halo), enough to give its own rows the frames they
would have in the whole group. Those rows are found by their place, from a table of one row per chunk.

A group below the bound keeps its plain plan and is neither written nor partitioned anew. Neither the number of chunks
nor that of split groups is limited, and nothing of them passes through the driver.
"""

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from gaugeline.plans.scratch import materialize

CHUNK = "_chunk"
OWN = "_own"
PLAIN = -1  # number of the only chunk of a group that is not split

ROWS_PER_CHUNK = 2_000_000
CHUNKS_PER_RANGE, MOST_CHUNKS = 8, 256  # of a range partition: aimed at, and the numbers kept free for them
BROADCAST_CHUNKS = 1_000_000
_PLACE = (1 << 33) - 1  # the low bits of a row's number count within its partition


@dataclass(frozen=True)
class Chunked:
    """`rows` holds every input row once with OWN true, and again with OWN false in each chunk that needs it as halo."""

    rows: DataFrame
    split: bool


def same_key(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str = "_k_") -> Column:
    """Equal keys, where nulls are equal; the right side has its keys under a prefix."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[f"{prefix}{k}"])
    return cond


def prefixed(df: DataFrame, keys: Sequence[str], prefix: str = "_k_") -> DataFrame:
    return df.withColumnsRenamed({k: f"{prefix}{k}" for k in keys})


def _halo_rows(stored: DataFrame, keys: list[str], halo: int) -> DataFrame:
    """Copies of the last rows of every chunk, for the chunks whose frames reach back to them."""
    chunks = stored.groupBy(*keys, CHUNK).agg(F.count("*").alias("_n"), F.max("_place").alias("_last"))
    chunks = materialize(chunks, "chunks")
    by_group = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(CHUNK)
    between = F.lag("_n").over(by_group).isNotNull() & F.lead("_n").over(by_group).isNotNull()
    shortest, count = chunks.select(F.when(between, F.col("_n")).alias("_n")).agg(F.min("_n"), F.count("*")).first()
    reach = 1 if shortest is None else min(halo, 1 + math.ceil(halo / shortest))
    later = F.collect_list(F.struct(CHUNK, "_n")).over(by_group.rowsBetween(1, reach))
    # A later chunk, and how many rows lie between it and this one.
    targets = F.transform(
        later, lambda x, i: F.struct(x[CHUNK].alias("to"), F.aggregate(F.slice(later, 1, i), F.lit(0).cast("bigint"), lambda n, y: n + y["_n"]).alias("gap"))
    )
    ends = chunks.select(*keys, F.col(CHUNK).alias("_c"), "_last", targets.alias("_targets")).filter(F.size("_targets") > 0)
    ends = prefixed(ends, keys)
    ends = F.broadcast(ends) if count <= BROADCAST_CHUNKS else ends
    tails = stored.join(ends, same_key(stored, ends, keys) & (stored[CHUNK] == ends["_c"]) & (ends["_last"] - stored["_place"] < halo))
    wanted = F.filter("_targets", lambda t: F.col("_last") - F.col("_place") + t["gap"] < halo)
    rest = [c for c in stored.columns if c not in (CHUNK, "_place")]
    return tails.select(*rest, F.explode(wanted).alias("_t")).select(*rest, F.col("_t.to").alias(CHUNK), F.lit(False).alias(OWN))


def split_groups(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], halo: int, rows_per_chunk: int = ROWS_PER_CHUNK
) -> Chunked:
    """Add CHUNK and OWN so that (keys, CHUNK) never holds much more than `rows_per_chunk` rows.

    `order` must tell the rows of a group apart. Callers partition their windows by (keys, CHUNK), sort by `order`, and
    keep the OWN rows afterwards. Chunk numbers rise with the order. With no keys the whole frame is one group.
    """
    keys, order, columns = list(keys), list(order), df.columns
    plain = {CHUNK: F.lit(PLAIN).cast("bigint"), OWN: F.lit(True)}
    sizes = df.groupBy(*keys).count()
    hot = F.col("count") > rows_per_chunk
    groups, hot_groups, hot_rows = sizes.agg(F.count("*"), F.count_if(hot), F.sum(F.when(hot, F.col("count")))).first()
    if not hot_groups:
        return Chunked(df.withColumns(plain), split=False)
    some, rest = df, None
    if hot_groups < groups:
        hot_keys = prefixed(sizes.filter(hot).select(*keys), keys)
        hot_keys = F.broadcast(hot_keys) if hot_groups <= BROADCAST_CHUNKS else hot_keys
        some = df.join(hot_keys, same_key(df, hot_keys, keys), "left_semi")
        rest = df.join(hot_keys, same_key(df, hot_keys, keys), "left_anti").withColumns(plain)
    chunks = math.ceil(hot_rows / rows_per_chunk)
    ranges = max(math.ceil(chunks / CHUNKS_PER_RANGE), min(chunks, df.sparkSession.sparkContext.defaultParallelism))
    dealt = some.repartitionByRange(ranges, *keys, *order).sortWithinPartitions(*keys, *order)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACE))
    step = F.least(F.floor(place / F.lit(rows_per_chunk)), F.lit(MOST_CHUNKS - 1))
    number = F.spark_partition_id().cast("bigint") * MOST_CHUNKS + step
    stored = materialize(dealt.withColumns({CHUNK: number, "_place": place}), "ranges")
    rows = stored.select(*columns, CHUNK, F.lit(True).alias(OWN))
    if halo:
        rows = rows.unionByName(_halo_rows(stored, keys, halo))
    return Chunked(rows if rest is None else rows.unionByName(rest), split=True)
