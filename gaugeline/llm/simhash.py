"""SimHash near-duplicates by a segment-popcount embedding.

Fingerprints within `distance` differing bits are linked. A fingerprint is embedded by the bit counts of its 32
two-bit segments. The Manhattan distance of two embeddings never exceeds the Hamming distance, so it is a lower
bound that only the exact test has to confirm. The embedding is kept in unary, where every segment has its ones
first: then the Manhattan distance is again a count of differing bits, and a step along one axis sets one bit.

Candidates come from a grid join. Of two vectors at distance 3 or less, one of the two halves (16 axes) is at
distance 1 or less. Each half is a grid with cells of side 1: every fingerprint is stored in its own cell and asks
for the cells one step up each axis, so every pair meets once for each half that is close. The lower bound over all
axes and the exact distance are conditions of that join, so only links leave it, never the pairs of a cell; a cell
that many fingerprints share is a skewed key, which adaptive execution splits. Links stay sparse: no more than 128
fingerprints can be pairwise within 3 bits.

Defined cases: a text that is null or has no word has fingerprint zero and is linked like any other. Fewer words
than a shingle give one shingle of all words. Equal fingerprints are one node, so exact copies, repeated rows and
null ids cost nothing; the component id is the smallest non-null doc_id. An empty table gives an empty result. Other
columns stay.
"""

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gaugeline.llm.common import WORD, fresh_name, table
from gaugeline.plans.components import connected_components
from gaugeline.plans.scratch import materialize

SHINGLE_WORDS, SEED, DISTANCE = 3, 42, 3
_BYTES_WORD = re.compile(WORD.encode())
_ODD = 0x5555555555555555


def fingerprint(text: bytes | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of a text, unsigned."""
    words = _BYTES_WORD.findall(text.lower()) if text else []
    if not words:
        return 0
    if len(words) <= shingle_words:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    runs = zip(*[words[i:] for i in range(shingle_words)])
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(b" ".join(r), SEED) for r in runs), ">u8", len(words) - shingle_words + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        ones += np.unpackbits(hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(">u8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", name: str = "fingerprint", shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """`docs` with the fingerprint as a (signed) bigint column."""

    def simhash(texts: pa.Array) -> pa.Array:
        values = [fingerprint(t, shingle_words) for t in texts.cast(pa.binary()).to_pylist()]
        return pa.array(np.array(values, np.uint64).view(np.int64))

    return docs.withColumn(name, F.arrow_udf(simhash, "bigint")(F.col(text)))


def _shift(x: Column, n: int) -> Column:
    return F.shiftrightunsigned(x, n)


def unary_counts(fp: Column) -> Column:
    """Each two-bit segment with its ones moved down: the embedding in unary."""
    odd = F.lit(_ODD)
    both = fp.bitwiseAND(_shift(fp, 1)).bitwiseAND(odd)
    some = fp.bitwiseOR(_shift(fp, 1)).bitwiseAND(odd)
    return F.shiftleft(both, 1).bitwiseOR(some)


def _grid(fps: DataFrame) -> DataFrame:
    """(cell, probe, fp): every fingerprint in its own cell of both halves, and as a probe in the cells one step up."""
    unary = fps.select("fp", unary_counts(F.col("fp")).alias("u"))
    halves = F.array(*[F.struct(F.lit(h).alias("half"), _shift(F.col("u"), 32 * h).bitwiseAND(F.lit(0xFFFFFFFF)).alias("v")) for h in (0, 1)])
    rows = unary.select("fp", F.explode(halves).alias("h")).select("fp", "h.half", "h.v")
    cells = [F.struct(F.col("v").alias("v"), F.lit(False).alias("probe"))]
    for axis in range(16):
        low, high = F.lit(1 << (2 * axis)), F.lit(2 << (2 * axis))
        step = F.when(F.col("v").bitwiseAND(low) == 0, low).when(F.col("v").bitwiseAND(high) == 0, high)
        cells.append(F.when(step.isNotNull(), F.struct(F.col("v").bitwiseOR(step).alias("v"), F.lit(True).alias("probe"))))
    cell = F.shiftleft(F.col("half").cast("bigint"), 32).bitwiseOR(F.col("c.v")).alias("cell")
    return rows.select("fp", "half", F.explode(F.array(*cells)).alias("c")).filter("c is not null").select(cell, "c.probe", "fp")


def linked_fingerprints(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links (a, b) of distinct fingerprints (fp) with at most `distance` (3 or less) differing bits."""
    if not 0 <= distance <= DISTANCE:
        raise ValueError(f"the grid finds distances up to {DISTANCE}")
    grid = _grid(fps)
    stored = grid.filter("not probe").select("cell", F.col("fp").alias("a"))
    asking = grid.select("cell", "probe", F.col("fp").alias("b"))

    def differing(x: Column, y: Column) -> Column:
        return F.bit_count(x.bitwiseXOR(y))

    a, b = F.col("a"), F.col("b")
    once = F.col("probe") | (a < b)
    bound = differing(unary_counts(a), unary_counts(b)) <= distance
    pairs = stored.join(asking, "cell").filter(once & bound & (differing(a, b) <= distance))
    return materialize(pairs.select("a", "b"), "simhash-links")


def components(rows: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(fingerprint, root, component_id) of the distinct fingerprints of `rows` (doc_id, fingerprint).

    The root is the smallest fingerprint of the component, component_id the smallest doc_id.
    """
    fps = materialize(rows.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("doc_id").alias("first_id")), "simhash-fps")
    links = linked_fingerprints(fps, distance)
    nodes = materialize(links.select(F.col("a").alias("node")).union(links.select("b")).distinct(), "simhash-nodes")
    roots = connected_components(nodes, links)
    linked = roots.join(fps, F.col("node") == F.col("fp")).select("fp", "root", "first_id")
    ids = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    found = linked.join(ids, "root").select(F.col("fp").alias("_fp"), "root", "component_id")
    every = fps.join(found, F.col("fp") == F.col("_fp"), "left")
    single = F.col("root").isNull()
    labels = every.select(
        F.col("fp").alias("fingerprint"),
        F.coalesce("root", "fp").alias("root"),
        F.when(single, F.col("first_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
    # Read from a table, so that in the join with all rows both sides are plain shuffles and a frequent fingerprint can be split.
    return materialize(labels, "simhash-components")


def simhash_rows(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, text_hash, fingerprint) of every document, as a written table."""
    rows = with_fingerprint(docs.select("doc_id", F.xxhash64(text).alias("text_hash"), F.col(text).alias("text")))
    return materialize(rows.select("doc_id", "text_hash", "fingerprint"), "simhash-rows")


def keep_one(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with one document of each component: the one with the smallest doc_id (null last), then text hash."""
    rows = simhash_rows(docs, text)
    labelled = rows.join(components(rows), "fingerprint")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    best = labelled.groupBy("root").agg(F.min(first).alias("best")).select("best.doc_id", "best.text_hash")
    kept_id, kept_hash = fresh_name(docs, "_id"), fresh_name(docs, "_hash")
    kept = materialize(best.withColumnsRenamed({"doc_id": kept_id, "text_hash": kept_hash}), "simhash-kept")
    on = F.col("doc_id").eqNullSafe(F.col(kept_id)) & (F.xxhash64(text) == F.col(kept_hash))
    left = docs.join(kept, on, "left_semi")
    repeated = rows.groupBy("doc_id", "text_hash").count().filter("count > 1")
    if repeated.isEmpty():
        return left
    return left.withColumn(kept_hash, F.xxhash64(text)).dropDuplicates(["doc_id", kept_hash]).drop(kept_hash)


def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    rows = simhash_rows(table(spark, folder, "documents"))
    labelled = rows.join(components(rows), "fingerprint")
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint")
    return labelled.select("doc_id", digits, "component_id")
