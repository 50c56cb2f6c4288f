"""Hard-negative mining by segment summaries.

For each anchor its best rows of the same label are positives; for each positive, the best rows of other labels whose
score lies between two shares of the positive's score are hard negatives. Scores are inner products of integer vectors.

Every vector is stored with the mean and the deviation of its segments, at segment lengths 64, 16 and 4. Within a
segment of length n the inner product is n * mean * mean plus a rest of at most n * deviation * deviation, so sums over
segments bound a score from above and below. A task bounds all its rows for all anchors by the longest segments, drops
what cannot be among the best known so far, goes on with shorter segments for the rest, and multiplies only what is left.
Anchors and rows may lie anywhere: bounds are per pair, rows are never grouped by likeness or label, and a frequent
vector, label or tie is no bottleneck.

The anchors are the stated query set. They meet all rows in blocks of `BLOCK_BYTES`, each sent to all tasks, so no row
is shuffled. Rows are taken in rounds of growing size, `FIRST_ROWS` and then 16 times as many: after the first round
every anchor has a bound to beat, and a task answers only with rows that beat it. So answers stay in proportion to the
anchors, with a number of rounds that grows with the logarithm of the table.

Defined cases: rows without an id, a label or a vector take no part, nor do those with a null, infinite or NaN component.
Scaled components are cut to a size at which scores fit in 55 bits (23.7 million for 64 components). A shorter vector is filled up with zeros; an empty one scores 0 with all. Rows that repeat an id and a score count
once per anchor; rows with the same id and different vectors are different rows, but never positives or negatives of
each other. An empty table, or one without anchors, gives an empty result. Other columns are not read.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gaugeline.llm.common import table, uniform
from gaugeline.plans.scratch import materialize

POSITIVES, NEGATIVES = 5, 10
LOW_PERCENT, HIGH_PERCENT = 30, 90
SCALE = 256
SEGMENTS = (64, 16, 4)
SCORE_BITS = 55
FIRST_ROWS, GROWTH = 1 << 17, 16
BLOCK_BYTES = 32 << 20
ANCHORS_AT_ONCE = 256
_SLACK = 1e-5  # summaries are stored in single precision
FOUND = "anchor bigint, positive int, score bigint, id bigint"


# ---- summaries -----------------------------------------------------------------------------------------------------


def padded(vectors: np.ndarray, width: int | None = None) -> np.ndarray:
    """Vectors filled up with zeros, to whole segments or to `width`."""
    width = width or -(-max(vectors.shape[1], 1) // SEGMENTS[0]) * SEGMENTS[0]
    return np.pad(vectors, ((0, 0), (0, width - vectors.shape[1])))


def summaries(vectors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(means, deviations) of the segments for each length, both times the root of the length.

    So a product of two of them belongs to a whole segment. The last deviation is none: it is a share of the vector's
    length and makes up for rounding.
    """
    x = vectors.astype(np.float64)
    slack = np.sqrt(_SLACK) * np.sqrt((x * x).sum(axis=1, keepdims=True))
    found = []
    for n in SEGMENTS:
        parts = x.reshape(len(x), -1, n)
        means = parts.mean(axis=2)
        rest = np.sqrt(((parts - means[:, :, None]) ** 2).sum(axis=2))
        found.append(((means * math.sqrt(n)).astype(np.float32), np.hstack([rest, slack]).astype(np.float32)))
    return found


def bounds(a: tuple, b: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of all scores between two sets of summaries of one length."""
    middle, reach = a[0] @ b[0].T, a[1] @ b[1].T + 1
    return middle - reach, middle + reach


def _split(flat: np.ndarray, width: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Summaries from their stored form, a row of all lengths."""
    found, at = [], 0
    for n in SEGMENTS:
        count = width // n
        found.append((flat[:, at : at + count], flat[:, at + count : at + 2 * count + 1]))
        at += 2 * count + 1
    return found


def _filled(flat: np.ndarray, old: int, new: int) -> np.ndarray:
    """Stored summaries of vectors that are filled up with zeros from one width to a larger one."""
    if old == new:
        return flat
    parts = []
    for (means, rest), n in zip(_split(flat, old), SEGMENTS, strict=True):
        more = np.zeros((len(flat), (new - old) // n), np.float32)
        parts += [means, more, rest[:, :-1], more, rest[:, -1:]]
    return np.hstack(parts)


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer vectors."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 1 << 53:  # every partial sum is a whole number that a double holds
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


# ---- the search in a task ------------------------------------------------------------------------------------------


class Vectors:
    """Vectors of a batch or block: ids, labels, components and summaries, by id."""

    def __init__(self, ids, labels, codes: np.ndarray, flat: np.ndarray):
        self.ids, self.labels, self.codes, self.flat = ids, labels, codes, flat

    @classmethod
    def of(cls, batch, width: int) -> "Vectors":
        """From a batch with vec_id, label, codes and summary, filled up to `width` components."""
        ids, labels = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "label"))
        lists = batch.column("codes")
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
        summary = batch.column("summary")
        codes = np.zeros((len(ids), width), np.int32)
        flat = np.zeros((len(ids), sum(2 * (width // n) + 1 for n in SEGMENTS)), np.float32)
        values, stored = lists.flatten().to_numpy(zero_copy_only=False), summary.flatten().to_numpy(zero_copy_only=False)
        begins = np.cumsum(sizes) - sizes
        lengths = summary.value_lengths().to_numpy(zero_copy_only=False)
        starts = np.cumsum(lengths) - lengths
        for size in np.unique(sizes):
            rows = np.flatnonzero(sizes == size)
            codes[rows, :size] = values[begins[rows, None] + np.arange(size)]
            old = -(-max(int(size), 1) // SEGMENTS[0]) * SEGMENTS[0]
            flat[rows] = _filled(stored[starts[rows, None] + np.arange(lengths[rows[0]])], old, width)
        return cls(ids, labels, codes, flat).take(np.argsort(ids, kind="stable"))

    def take(self, at) -> "Vectors":
        return Vectors(self.ids[at], self.labels[at], self.codes[at], self.flat[at])

    def __len__(self) -> int:
        return len(self.ids)


def survivors(a: Vectors, b: Vectors, low: np.ndarray, high: np.ndarray, among: np.ndarray, best: int = 0) -> np.ndarray:
    """Pairs of `among` whose score may lie in [low, high] of the anchor, by segments of falling length.

    With `best`, only the so many highest are wanted, and lower bounds of others raise the bar.
    """
    width = a.codes.shape[1]
    left = among.copy()
    fresh = np.append(True, b.ids[1:] != b.ids[:-1])  # a repeated row does not raise the bar twice
    for x, y in zip(_split(a.flat, width), _split(b.flat, width), strict=True):
        rows = np.flatnonzero(left.any(axis=0))
        if not len(rows):
            break
        under, over = bounds(x, tuple(p[rows] for p in y))
        some = left[:, rows]
        if best and len(rows) >= best:
            sure = np.where(some & fresh[rows], under, -np.inf)
            low = np.maximum(low, np.partition(sure, len(rows) - best, axis=1)[:, len(rows) - best])
        left[:, rows] = some & (over >= low[:, None]) & (under <= high[:, None])
    return left


def first_of(score: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of the first rows by falling score and rising id, without repeated (score, id)."""
    order = np.lexsort((ids, -score))
    s, i = score[order], ids[order]
    return order[np.append(True, (np.diff(s) != 0) | (np.diff(i) != 0))][:most] if len(order) else order


class Search:
    """The best rows of one block of anchors, over the batches of a task.

    Without ranges these are the positives: rows of the anchor's label. With ranges (low, high per anchor and positive)
    they are the negatives of each. `known` holds for each of them the score and id that have to be beaten.
    """

    def __init__(self, anchors: Vectors, most: int, known: tuple[np.ndarray, np.ndarray], ranges: tuple | None = None):
        self.anchors, self.most, self.known, self.ranges = anchors, most, known, ranges
        self.found: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def read(self, rows: Vectors) -> None:
        for begin in range(0, len(self.anchors), ANCHORS_AT_ONCE):
            at = np.arange(begin, min(begin + ANCHORS_AT_ONCE, len(self.anchors)))
            anchors = self.anchors.take(at)
            if self.ranges is None:
                for label in np.unique(anchors.labels):
                    self._meet(at[anchors.labels == label], rows.take(np.flatnonzero(rows.labels == label)))
            else:
                self._meet(at, rows)

    def _meet(self, at: np.ndarray, rows: Vectors) -> None:
        if not len(rows):
            return
        anchors = self.anchors.take(at)
        among = anchors.ids[:, None] != rows.ids[None, :]
        bar = self.known[0][at]
        if self.ranges is None:
            low, high, best = bar[:, 0].astype(float), np.full(len(at), np.inf), self.most
        else:
            among &= anchors.labels[:, None] != rows.labels[None, :]
            lows, highs = (r[at] for r in self.ranges)
            wanted = lows <= highs
            low = np.where(wanted, np.maximum(lows, bar), np.inf).min(axis=1, initial=np.inf)
            high = np.where(wanted, highs, -np.inf).max(axis=1, initial=-np.inf)
            best = 0
        left = survivors(anchors, rows, low, high, among, best)
        some = np.flatnonzero(left.any(axis=0))
        if not len(some):
            return
        exact = scores(anchors.codes, rows.codes[some])
        ids, left = rows.ids[some], left[:, some]
        for i in np.flatnonzero(left.any(axis=1)).tolist():
            places = np.flatnonzero(left[i])
            self._keep(int(at[i]), exact[i, places], ids[places])

    def _keep(self, anchor: int, score: np.ndarray, ids: np.ndarray) -> None:
        if self.ranges is None:
            self._best(anchor, 0, score, ids)
            return
        # Rows come by rising id, so a stable sort leaves equal scores in order, and every range is a run of the sorted rows.
        order = np.argsort(-score, kind="stable")
        score, ids = score[order], ids[order]
        for p, (low, high) in enumerate(zip(*(r[anchor].tolist() for r in self.ranges), strict=True)):
            if low > high:
                continue
            begin = int(np.searchsorted(-score, -high))
            end = int(np.searchsorted(-score, -low, side="right"))
            if end - begin > self.most:  # the same row may be there more than once
                score_, ids_ = score[begin:end], ids[begin:end]
                new = np.append(True, (np.diff(score_) != 0) | (np.diff(ids_) != 0))
                keep = np.flatnonzero(new)[: self.most]
                self._best(anchor, p, score_[keep], ids_[keep])
            elif end > begin:
                self._best(anchor, p, score[begin:end], ids[begin:end])

    def _best(self, anchor: int, p: int, score: np.ndarray, ids: np.ndarray) -> None:
        bar, bar_id = self.known[0][anchor, p], self.known[1][anchor, p]
        better = (score > bar) | ((score == bar) & (ids < bar_id))
        if not better.any():
            return
        score, ids = score[better], ids[better]
        if (anchor, p) in self.found:
            s, i = self.found[anchor, p]
            score, ids = np.concatenate([s, score]), np.concatenate([i, ids])
        at = first_of(score, ids, self.most)
        score, ids = score[at], ids[at]
        self.found[anchor, p] = score, ids
        if len(at) == self.most:  # what comes later has to beat the last one
            self.known[0][anchor, p], self.known[1][anchor, p] = score[-1], ids[-1]

    def answers(self, names: np.ndarray) -> pa.RecordBatch:
        keys = [k for k, (s, _) in self.found.items() for _ in range(len(s))]
        anchors, positives = np.array(keys, np.int64).reshape(-1, 2).T
        none = np.zeros(0, np.int64)
        score, ids = (np.concatenate([none, *[v[j] for v in self.found.values()]]) for j in (0, 1))
        columns = [names[anchors], positives.astype(np.int32), score, ids]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [c.split()[0] for c in FOUND.split(", ")])


def _searcher(block, most: int, width: int, slots: int, ranged: bool):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Vectors.of sorts by id; the names, ranges and bars follow it.
        rows = block.value
        order = np.argsort(rows.column("vec_id").to_numpy(), kind="stable")
        rows = rows.take(pa.array(order)).combine_chunks()
        anchors = Vectors.of(rows.to_batches(max_chunksize=len(order))[0], width)

        def grid(name: str) -> np.ndarray:
            return np.array(rows.column(name).to_pylist(), np.int64).reshape(len(rows), slots)

        ranges = (grid("lows"), grid("highs")) if ranged else None
        found = Search(anchors, most, (grid("bars"), grid("bar_ids")), ranges)
        for batch in batches:
            if batch.num_rows:
                found.read(Vectors.of(batch, width))
        yield found.answers(rows.column("anchor").to_numpy())

    return search


# ---- the operator --------------------------------------------------------------------------------------------------


def _summarise(codes: pa.Array) -> pa.Array:
    sizes = codes.value_lengths().to_numpy(zero_copy_only=False)
    values = codes.flatten().to_numpy(zero_copy_only=False)
    begins = np.cumsum(sizes) - sizes
    lengths = np.zeros(len(sizes), np.int64)
    parts = {}
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        found = summaries(padded(values[begins[rows, None] + np.arange(size)]))
        parts[size] = rows, np.hstack([x for pair in found for x in pair])
        lengths[rows] = parts[size][1].shape[1]
    ends = np.cumsum(lengths)
    flat = np.zeros(ends[-1] if len(ends) else 0, np.float32)
    for rows, part in parts.values():
        flat[(ends - lengths)[rows, None] + np.arange(part.shape[1])] = part
    return pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(flat))


def whole_vectors(rows: DataFrame, scale: int = SCALE) -> tuple[DataFrame, int]:
    """(vec_id, label, codes, summary) as a written table, and the width: the most components, in whole segments."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = rows.filter("vec_id is not null and label is not null and embedding is not null").filter(~bad)
    most = usable.agg(F.max(F.size("embedding"))).first()[0]
    width = -(-max(most or 1, 1) // SEGMENTS[0]) * SEGMENTS[0]
    limit = float(math.isqrt((1 << SCORE_BITS) // width))

    def code(x: Column) -> Column:
        whole = F.floor(F.greatest(F.lit(-limit), F.least(F.lit(limit), x.cast("double") * scale)))
        return whole.cast("int")

    codes = usable.select(F.col("vec_id").cast("bigint"), F.col("label").cast("bigint"), F.transform("embedding", code).alias("codes"))
    return materialize(codes.withColumn("summary", F.arrow_udf(_summarise, "array<float>")(F.col("codes"))), "vectors"), width


def _rounds(rows: int) -> list[Column]:
    """Conditions that deal all rows to rounds, by a hash of the id."""
    edges, size = [0.0], FIRST_ROWS
    while size < rows:
        edges.append(size / rows)
        size *= GROWTH
    u = uniform("vec_id", seed="negatives")
    return [(u >= a) & (u < b) for a, b in zip(edges, [*edges[1:], 1.0], strict=True)]


def _best(found: DataFrame, most: int) -> DataFrame:
    """(anchor, positive, list): the first rows by falling score and rising id."""
    row = F.struct((-F.col("score")).alias("falling"), "id")
    return found.groupBy("anchor", "positive").agg(F.slice(F.sort_array(F.collect_set(row)), 1, most).alias("list"))


def _searched(vectors: DataFrame, width: int, anchors: DataFrame, count: int, slots: int, most: int, ranged: bool) -> DataFrame:
    """(anchor, positive, list) over all rows, in rounds; `anchors` has the rows to search for, with lows and highs."""
    spark = vectors.sparkSession
    per_block = max(1, BLOCK_BYTES // (8 * width))
    blocks = -(-count // per_block)
    best = None
    low, top = F.lit(-(1 << 62)), F.lit((1 << 62))
    for condition in _rounds(vectors.count()):
        asked = anchors
        if best is not None:
            last = F.when(F.size("list") == most, F.element_at("list", -1))
            each = best.select("anchor", "positive", (-last["falling"]).alias("bar"), last["id"].alias("bar_id"))
            bars = each.groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("positive", F.struct("bar", "bar_id")))).alias("b"))
            asked = anchors.join(bars, "anchor", "left")
        slot = F.sequence(F.lit(0), F.lit(slots - 1))

        def bar(field: str, other: Column) -> Column:
            if best is None:
                return F.array_repeat(other, slots)
            return F.transform(slot, lambda p: F.coalesce(F.try_element_at("b", p)[field], other))

        columns = ["anchor", "vec_id", "label", "codes", "summary", *(["lows", "highs"] if ranged else [])]
        asked = materialize(asked.select(*columns, bar("bar", low).alias("bars"), bar("bar_id", top).alias("bar_ids")), "anchors")
        found = best.select("anchor", "positive", F.explode("list").alias("r")) if best is not None else None
        if found is not None:
            found = found.select("anchor", "positive", (-F.col("r.falling")).alias("score"), "r.id")
        for b in range(blocks):
            block = asked.filter(F.pmod("anchor", F.lit(blocks)) == b).toArrow()
            if not len(block):
                continue
            sent = spark.sparkContext.broadcast(block)
            rows = vectors.filter(condition).mapInArrow(_searcher(sent, most, width, slots, ranged), FOUND)
            rows = materialize(rows, "found")
            sent.destroy()
            found = rows if found is None else found.unionByName(rows)
        if found is None:
            return spark.createDataFrame([], "anchor bigint, positive int, list array<struct<falling:bigint,id:bigint>>")
        best = materialize(_best(found, most), "best")
    return best


def hard_negatives(
    rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
    low_percent: int = LOW_PERCENT, high_percent: int = HIGH_PERCENT, scale: int = SCALE,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for rows with vec_id, label, embedding."""
    vectors, width = whole_vectors(rows, scale)
    name = F.xxhash64("vec_id", "label", "codes").alias("anchor")
    anchors = materialize(vectors.filter(is_anchor).select(name, "*").dropDuplicates(["anchor"]), "anchors")
    count = anchors.count()
    if not count:
        empty = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
        return rows.sparkSession.createDataFrame([], empty)
    near = _searched(vectors, width, anchors, count, 1, positives, False).select("anchor", "list")
    # Whole scores between the shares. A missing positive, or one below zero, has an empty range.
    each = F.transform(F.sequence(F.lit(0), F.lit(positives - 1)), lambda p: -F.get("list", p)["falling"])
    low = F.transform(each, lambda s: F.when(s >= 0, F.call_function("div", s * low_percent + 99, F.lit(100))).otherwise(1))
    high = F.transform(each, lambda s: F.when(s >= 0, F.call_function("div", s * high_percent, F.lit(100))).otherwise(0))
    ranged = materialize(anchors.join(near, "anchor").withColumns({"lows": low, "highs": high}), "anchors")
    best = _searched(vectors, width, ranged.drop("list"), count, positives, negatives, True)
    each = best.select("anchor", "positive", F.posexplode("list").alias("at", "n"))
    joined = each.join(ranged.select("anchor", "vec_id", "list"), "anchor")
    positive = F.get("list", F.col("positive"))
    return joined.select(
        F.col("vec_id").alias("anchor_id"),
        positive["id"].alias("positive_id"),
        (F.col("at") + 1).alias("rank"),
        F.col("n.id").alias("negative_id"),
        (-positive["falling"]).alias("positive_score"),
        (-F.col("n.falling")).alias("negative_score"),
    )


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    label = F.col("label").cast("bigint")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives(rows.select("vec_id", label.alias("label"), "embedding"), F.col("vec_id") % 100 == 0)


SQL = """
WITH usable AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS codes
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, x.vec_id, a.label = x.label AS same, list_dot_product(a.codes, x.codes)::BIGINT AS score
    FROM (SELECT * FROM usable WHERE vec_id % 100 = 0) a JOIN usable x ON x.vec_id <> a.vec_id
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
        row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place
    FROM scored WHERE same
), ranked AS (
    SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank
    FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
        AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
    WHERE p.place <= 5
)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10
"""
