"""Mixing sources to target weights by pivotal dependent rounding.

A source's target divided by its size is the number of copies each of its documents is due: a whole part that all
get, and a fraction that is rounded dependently. Two documents with fractional copy probabilities meet, and words
move from one probability to the other, in the direction a hash draws, until one of them is 0 or 1. The words of the
pair and every document's expected copies stay what they were, so a source ends within one document of its target.

Documents of a source are dealt into blocks by hash. A block is one fold that leaves at most one fractional
document; the residuals of `block_rows` neighbouring blocks form a block of the next level, until a source has one
block, whose residual is drawn on its own. Every level is a written table. A block is bounded whatever a source's
share is, and only DataFrame functions are used. The numbers drawn depend on keys alone, so reruns and other
partitionings agree.

Defined cases: a null text has size 0. A null source is a source of its own, last in order. Documents of size 0 are
never taken. Repeated rows are numbered and rounded one by one; equal rows are interchangeable. Ties in the order
within a block fall to the row's key. A folder without words has targets of 0, an empty table gives an empty result.
"""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from gaugeline.llm.common import fresh_name, table, uniform, word_count
from gaugeline.plans.joins import broadcast_if_small
from gaugeline.plans.scratch import materialize

WEIGHTS = (5.0, 2.0, 1.0)
SHARE, MOST = 1.5, 2.0
BLOCK_ROWS = 128
ROWS_PER_EXPLODE = 10_000
SEED = "mix"
_KEY = ("doc_id", "fingerprint", "copy")
_WHOLE = 1e-12


def document_sizes(docs: DataFrame, source: str = "source", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, source, size): the words of a document, and a hash of its text to tell repeated ids apart."""
    return docs.select(
        "doc_id", F.xxhash64(text).alias("fingerprint"), F.col(source).alias("source"), word_count(text).alias("size")
    )


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """(source, source_size, documents, target). Weights repeat over the sources in code point order, null last.

    Resharing what lies above the caps until nothing does ends where every target is the smaller of its cap and one
    common multiple of its weight. With sources in the order of cap / weight, that multiple is the first one that the
    next cap allows. The table has one row a source; only that small table is ordered as a whole.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("documents"))
    listed = F.array(*[F.lit(float(w)) for w in weights])
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    rows = totals.withColumn("weight", F.element_at(listed, (place % len(weights) + 1).cast("int")))
    rows = rows.withColumn("cap", F.col("source_size") * most)
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    below = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_words = F.sum("source_size").over(every) * share - below
    rows = rows.withColumn("multiple", open_words / F.sum("weight").over(rest))
    fits = F.when(F.col("multiple") * F.col("weight") <= F.col("cap"), F.col("multiple"))
    common = F.first(fits, ignorenulls=True).over(every)
    target = F.coalesce(F.least("cap", common * F.col("weight")), "cap")
    return rows.select("source", F.coalesce("source_size", F.lit(0)).alias("source_size"), "documents", target.alias("target"))


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _whole(p: Column) -> Column:
    return (p < _WHOLE) | (p > 1 - _WHOLE)


def _fold(items: Column, level: int) -> Column:
    """{held, done} of a block: at most one fractional item, and the decided ones with `p` 0 or 1."""
    kind = "struct<key:struct<doc_id:bigint,fingerprint:bigint,copy:bigint>,size:double,p:double>"

    def unit(of: Column, p: Column) -> Column:
        return F.struct(of["key"].alias("key"), of["size"].alias("size"), p.alias("p")).cast(kind)

    def meet(held: Column, new: Column) -> Column:
        per = new["size"] / held["size"]  # of the held probability for one of the new
        move = F.struct(
            F.least(1 - held["p"], new["p"] * per).alias("up"),
            F.least(held["p"], (1 - new["p"]) * per).alias("down"),
            per.alias("per"),
        )

        def moved(m: Column) -> Column:
            draw = uniform(held["key"], new["key"], F.lit(level), seed=SEED)
            shift = F.when(draw * (m["up"] + m["down"]) < m["down"], m["up"]).otherwise(-m["down"])
            return _bind(shift, lambda s: F.array(unit(held, held["p"] + s), unit(new, new["p"] - s / m["per"])))

        return _bind(move, moved)

    def step(state: Column, item: Column) -> Column:
        pair = F.when(state["held"].isNull(), F.array(unit(item, item["p"]))).otherwise(meet(state["held"], item))
        return _bind(
            pair,
            lambda both: F.struct(
                F.get(F.filter(both, lambda u: ~_whole(u["p"])), F.lit(0)).alias("held"),
                F.concat(state["done"], F.filter(both, lambda u: _whole(u["p"]))).alias("done"),
            ).cast(f"struct<held:{kind},done:array<{kind}>>"),
        )

    start = F.struct(F.lit(None).cast(kind).alias("held"), F.array().cast(f"array<{kind}>").alias("done"))
    return F.aggregate(items, start, step)


def mix_documents(
    sizes: DataFrame, targets: DataFrame, most: float = MOST, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """One row for each row of `sizes`: doc_id, fingerprint, source, size, source_size, target, copies."""
    known = broadcast_if_small(targets)
    due = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(most))).otherwise(0.0)

    def with_targets(df: DataFrame) -> DataFrame:
        of = known.withColumnRenamed("source", "_source")
        joined = df.join(of, F.col("source").eqNullSafe(F.col("_source"))).drop("_source").withColumn("due", due)
        return joined.withColumn("part", F.col("due") - F.floor("due"))

    # A row that is repeated very often is numbered in runs, so that no task unrolls all of it.
    same = sizes.groupBy("doc_id", "fingerprint", "source", "size").count()
    runs = same.withColumn("run", F.explode(F.sequence(F.lit(0), F.floor((F.col("count") - 1) / ROWS_PER_EXPLODE))))
    runs = runs.repartition("doc_id", "fingerprint", "run")
    first = F.col("run") * ROWS_PER_EXPLODE
    last = F.least(first + ROWS_PER_EXPLODE, "count") - 1
    rows = runs.select("doc_id", "fingerprint", F.explode(F.sequence(first, last)).alias("copy"), "source", "size")
    rows = materialize(with_targets(rows), "mix-rows")
    key = F.struct(*[F.col(c).cast("bigint").alias(c) for c in _KEY]).alias("key")
    fractional = (F.col("size") > 0) & ~_whole(F.col("part"))

    def decided(df: DataFrame) -> DataFrame:
        return df.select(F.explode("folded.done").alias("u"), "source").select("u.key.*", "source", "u.size", "u.p")

    blocks = F.ceil(F.col("documents") / block_rows)
    units = rows.filter(fractional).select(
        "source", key, F.col("size").cast("double").alias("size"), F.col("part").alias("p"), blocks.alias("blocks"),
        F.pmod(F.xxhash64(F.lit(SEED), "doc_id", "fingerprint", "copy"), blocks).alias("block"),
    )
    parts, level = [], 0
    widest = targets.agg(F.max("documents")).first()[0] or 0
    while True:
        widest = -(-widest // block_rows)
        item = F.struct(F.xxhash64(F.lit(SEED), "key").alias("order"), "key", "size", "p")
        grouped = units.groupBy("source", "blocks", "block").agg(F.sort_array(F.collect_list(item)).alias("items"))
        folded = materialize(grouped.select("source", "blocks", "block", _fold(F.col("items"), level).alias("folded")), "mix-level")
        parts.append(decided(folded))
        held = folded.filter("folded.held is not null").select("source", "folded.held.*", "blocks", "block")
        level += 1
        if widest <= 1:
            break
        units = held.withColumns({"blocks": F.ceil(F.col("blocks") / block_rows), "block": F.floor(F.col("block") / block_rows)})
    drawn = uniform("key", F.lit(level), seed=SEED) < F.col("p")
    parts.append(held.select("key.*", "source", "size", drawn.cast("double").alias("p")))
    settled = rows.filter(~fractional).select(
        *[F.col(c).cast("bigint").alias(c) for c in _KEY], "source", F.col("size").cast("double").alias("size"), F.round("part").alias("p")
    )
    every = settled
    for part in parts:
        every = every.unionByName(part)
    copies = F.when(F.col("size") > 0, F.floor("due") + F.when(F.col("p") > 0.5, 1).otherwise(0)).otherwise(0)
    out = with_targets(every.withColumn("size", F.col("size").cast("bigint")))
    return out.select("doc_id", "fingerprint", "source", "size", "source_size", "target", copies.cast("bigint").alias("copies"))


def mix_sources(docs: DataFrame, **options) -> DataFrame:
    sizes = materialize(document_sizes(docs), "mix-sizes")
    return mix_documents(sizes, materialize(source_targets(sizes), "mix-targets"), **options)


def copied_documents(docs: DataFrame) -> DataFrame:
    """`docs` with every row as often as the mix takes it, columns unchanged.

    Rows are told apart by all their columns, so rows that share an id and a text and differ elsewhere each get copies of
    their own.
    """
    digest, nth = fresh_name(docs, "_digest"), fresh_name(docs, "_nth")
    columns = [F.to_json(F.struct(c)) if "map<" in kind or "variant" in kind else F.col(f"`{c}`") for c, kind in docs.dtypes]
    wide = docs.withColumn(digest, F.xxhash64(*columns))
    sizes = wide.select("doc_id", F.col(digest).alias("fingerprint"), "source", word_count("text").alias("size"))
    sizes = materialize(sizes, "mix-sizes")
    mixed = mix_documents(sizes, materialize(source_targets(sizes), "mix-targets"))
    mixed = mixed.groupBy("doc_id", "fingerprint", "source").agg(F.sum("copies").alias("copies"))
    one = wide.dropDuplicates(["doc_id", digest, "source"])
    on = F.col("d.doc_id").eqNullSafe(F.col("m.doc_id")) & F.col("d.source").eqNullSafe(F.col("m.source"))
    on &= F.col(f"d.{digest}") == F.col("m.fingerprint")
    joined = one.alias("d").join(mixed.filter("copies > 0").alias("m"), on)
    each = F.explode(F.sequence(F.lit(1), F.col("m.copies"))).alias(nth)
    return joined.select(*[F.col(f"d.`{c}`") for c in docs.columns], each).drop(nth)


def op8_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mix_sources(table(spark, folder, "documents").select("doc_id", "text", "source"))
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken, "source", "copies")
