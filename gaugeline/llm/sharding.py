"""Sharding by longest-processing-time scheduling.

Documents with equal texts form a group that stays together. Groups go, from the largest to the smallest, to the
least-loaded shard, which a heap names. The heap never sees all groups: groups that alone weigh more than a
thousandth of a shard (at most a thousand for each shard) go to the last round as they are; the others are dealt by
hash into packs of about `pack_groups`, and each pack is scheduled into `pack_bins` bins of nearly equal size by the
same rule. Bins are then items like groups. Rounds repeat until no more than `last_items` are left, and these are
scheduled onto the shards.

Defined cases: a null text has 0 bytes and belongs to the group of empty texts. Equal sizes go in the order of the
group's digest, equally loaded shards in the order of their number. Repeated rows are members of one group. Slots
count within a shard without gaps, by part of the id hash and then by id; equal rows are interchangeable. An empty
table gives an empty result.
"""

import heapq
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from gaugeline.llm.common import shuffle_partitions, table
from gaugeline.plans.joins import broadcast_if_small
from gaugeline.plans.scratch import materialize

SHARDS = 8
PACK_GROUPS, PACK_BINS, LAST_ITEMS = 20_000, 64, 50_000
ROWS_PER_PART = 50_000


def schedule(items: Iterable[tuple[int, str]], shards: int) -> Iterator[tuple[str, int]]:
    """(item, shard) for items of (weight, item): largest first, each to the least-loaded shard."""
    heap = [(0, s) for s in range(shards)]
    for weight, item in sorted(items, key=lambda x: (-x[0], x[1])):
        load, shard = heapq.heappop(heap)
        yield item, shard
        heapq.heappush(heap, (load + weight, shard))


def _packer(bins: int):
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        label = str(rows["pack"].iloc[0])
        placed = schedule(zip(rows["weight"].tolist(), rows["item"].tolist(), strict=True), bins)
        return pd.DataFrame([(item, f"{label}/{b}") for item, b in placed], columns=["item", "bin"])

    return pack


def assign_groups(
    groups: DataFrame, shards: int = SHARDS, pack_groups: int = PACK_GROUPS, pack_bins: int = PACK_BINS, last_items: int = LAST_ITEMS
) -> DataFrame:
    """(item, shard) of `groups` (item string, weight long)."""
    spark = groups.sparkSession
    total, count = groups.agg(F.sum("weight"), F.count("*")).first()
    heavy = (total or 0) / (shards * 1000)
    items, placed, last, level = groups, None, None, 0
    while count > last_items:
        large = items.filter(F.col("weight") > heavy)
        last = large if last is None else last.unionByName(large)
        small = items.filter(F.col("weight") <= heavy)
        packs = -(-count // pack_groups)
        name = F.concat(F.lit(f"{level}/"), F.pmod(F.xxhash64("item", F.lit(level)), F.lit(packs)).cast("string"))
        packed = small.withColumn("pack", name).groupBy("pack").applyInPandas(_packer(pack_bins), "item string, bin string")
        packed = materialize(packed, "pack")
        bins = packed.join(items, "item").groupBy("bin").agg(F.sum("weight").alias("weight"))
        items = materialize(bins.select(F.col("bin").alias("item"), "weight"), "bins")
        # A later round moves bins into larger bins; each is a row of a table smaller by pack_groups / pack_bins.
        if placed is None:
            placed = packed
        else:
            next_bins = broadcast_if_small(packed.select(F.col("item").alias("_was"), F.col("bin").alias("_now")))
            moved = placed.join(next_bins, F.col("bin") == F.col("_was"), "left")
            placed = moved.select("item", F.coalesce("_now", "bin").alias("bin"))
        count, level = items.count(), level + 1
    last = items if last is None else last.unionByName(items)
    final = list(schedule(((r["weight"], r["item"]) for r in last.select("weight", "item").collect()), shards))
    shards_of = F.broadcast(spark.createDataFrame(final, "bin string, shard int"))  # last_items + 1000 * shards at most
    if placed is None:
        return shards_of.withColumnRenamed("bin", "item")
    every = placed.unionByName(groups.filter(F.col("weight") > heavy).select("item", F.col("item").alias("bin")))
    return every.join(shards_of, "bin").select("item", "shard")


def with_slots(rows: DataFrame, rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """`rows` (with `shard`, `doc_id`, `text_crc32`, `group`) with a gapless `slot` in each shard.

    A shard is counted in parts of about `rows_per_part` rows; what the parts before hold is added. The table of parts
    is small next to the rows.
    """
    parts = max(shuffle_partitions(rows.sparkSession), -(-rows.count() // rows_per_part))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "group"), F.lit(parts)))
    counts = rows.groupBy("shard", "part").count()
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    nth = F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id", "group")) - 1
    numbered = rows.withColumn("nth", nth).join(broadcast_if_small(offsets), ["shard", "part"])
    return numbered.withColumn("slot", (F.col("nth") + F.col("offset")).cast("bigint")).drop("part", "nth", "offset")


def shard_documents(docs: DataFrame, shards: int = SHARDS, text: str = "text") -> DataFrame:
    """(doc_id, group, size, text_crc32, shard, slot), one row for each document."""
    data = F.encode(F.coalesce(text, F.lit("")), "UTF-8")
    rows = docs.select(
        "doc_id", F.md5(data).alias("group"), (F.octet_length(data) + 1).cast("bigint").alias("size"), F.crc32(data).alias("text_crc32")
    )
    rows = materialize(rows, "shard-rows")
    groups = materialize(rows.groupBy(F.col("group").alias("item")).agg(F.sum("size").alias("weight")), "shard-groups")
    placed = assign_groups(groups, shards).withColumnRenamed("item", "group")
    return with_slots(materialize(rows.join(placed, "group"), "shard-placed"))


def op10_shards(spark: SparkSession, folder: str) -> DataFrame:
    placed = shard_documents(table(spark, folder, "documents").select("doc_id", "text"))
    law, grown = F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return placed.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown, "group")
