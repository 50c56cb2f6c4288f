"""Inserts, updates and deletes by id, applied to the readings table as one batch, and ids for appended rows."""

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, Window, functions as F

from gaugeline.plans.joins import fits_broadcast
from gaugeline.plans.scratch import materialize

INSERT, UPDATE, DELETE = "I", "U", "D"
SEQS_PER_STRETCH = 1_000_000


class Applied(NamedTuple):
    snapshot: DataFrame
    not_found: DataFrame
    updated: DataFrame


def apply_changes(base: DataFrame, changes: DataFrame, key: str = "id") -> Applied:
    """Apply `changes` (the columns of `base`, op I/U/D and an increasing seq) and return the new table, the (id, seq)
    of updates and deletes that found no row at their turn, and the updated rows.

    Changes are reduced to one row per key first, however many a key has. Only those keys meet the table: they are
    broadcast when they were counted to be few, so that the table itself is not shuffled. Write the snapshot to a new
    path; the files behind `base` must stay until it is written.
    """
    columns = base.columns
    op, seq = F.col("op"), F.col("seq")
    row = F.struct(*columns)
    folded = changes.groupBy(key).agg(
        F.max_by(op, F.when(op != UPDATE, seq)).alias("_made"),
        F.max(F.when(op != UPDATE, seq)).alias("_made_at"),
        F.max(F.when(op == UPDATE, seq)).alias("_updated_at"),
        F.max_by(row, F.when(op != DELETE, seq)).alias("_row"),
    )
    folded = materialize(folded, "changes")  # counted, joined and split into three outputs
    small = fits_broadcast(folded)

    def side(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if small else df

    touched = side(folded.select(key))
    # Ids are unique in the table, so at most one row per changed key exists.
    existing = side(base.join(touched, key, "left_semi").select(key, F.lit(True).alias("_in_base")))
    state = folded.join(existing, key, "left").withColumn("_in_base", F.coalesce("_in_base", F.lit(False)))
    state = materialize(state, "changes-state")  # else each of the outputs looks the keys up in the table again
    made, updated_after = F.col("_made"), F.col("_updated_at") > F.coalesce("_made_at", F.lit(-1))
    alive = F.when(made.isNull(), F.col("_in_base")).otherwise(made == INSERT)
    written = state.filter(alive & F.col("_row").isNotNull())
    untouched = base.join(touched, key, "left_anti")
    return Applied(
        snapshot=untouched.unionByName(written.select("_row.*").select(*columns)),
        not_found=_not_found(changes.select(key, "op", "seq"), state.select(key, "_in_base"), key),
        updated=written.filter(F.coalesce(updated_after, F.lit(False))).select("_row.*").select(*columns),
    )


def _not_found(changes: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Updates and deletes of keys without a row at that moment.

    What a change finds is the last insert or delete before it, or else the table. A key's changes are cut into stretches
    of SEQS_PER_STRETCH numbers; each stretch starts from the last insert or delete of those before, so a key with very
    many changes is not ordered in one task.
    """
    stretch = F.floor(F.col("seq") / SEQS_PER_STRETCH).alias("_stretch")
    rows = changes.select("*", stretch)
    made = F.when(F.col("op") != UPDATE, F.col("op"))
    ends = rows.groupBy(key, "_stretch").agg(F.max_by("op", F.when(F.col("op") != UPDATE, F.col("seq"))).alias("_made"))
    before = Window.partitionBy(key).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select(key, "_stretch", F.last("_made", ignorenulls=True).over(before).alias("_start"))
    within = Window.partitionBy(key, "_stretch").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    judged = rows.withColumn("_last", F.last(made, ignorenulls=True).over(within)).join(starts, [key, "_stretch"])
    last = F.coalesce("_last", "_start")
    alive = F.when(last.isNull(), F.col("_in_base")).otherwise(last == INSERT)
    return judged.join(known, key).filter((F.col("op") != INSERT) & ~alive).select(key, "seq")


def assign_ids(rows: DataFrame, last_id: int | Callable[[int], int], key: str = "id") -> DataFrame:
    """Give arriving rows the ids after `last_id`, without gaps, in partition order. It may be a function that reserves a
    number of ids and returns the one before them; it is called once, when the rows have been counted.

    The rows are written once with their partition number and place in it, so the numbering cannot move when a task
    runs again; only one count per partition reaches the driver. Sort or range-partition `rows` first if the order of
    ids matters.
    """
    place = F.monotonically_increasing_id()
    stamped = rows.withColumn("_part", F.shiftright(place, 33)).withColumn(
        "_place", place.bitwiseAND(F.lit((1 << 33) - 1))
    )
    kept = materialize(stamped, "arrivals")
    counts = sorted(kept.groupBy("_part").agg(F.max("_place") + 1).collect())
    if callable(last_id):
        last_id = last_id(sum(n for _, n in counts))
    offsets, before = [], last_id + 1
    for part, n in counts:
        offsets.append((part, before))
        before += n
    table = kept.sparkSession.createDataFrame(offsets, "_part bigint, _first bigint")
    # One row per written partition.
    numbered = kept.join(F.broadcast(table), "_part").withColumn(key, F.col("_first") + F.col("_place"))
    return numbered.select(key, *[c for c in rows.columns if c != key])
