"""Document fingerprints by content-defined chunking.

A gear hash over the last 32 bytes marks boundaries. Chunks are normalised: short ones need a rarer mark, long ones
a more frequent one, and both a smallest and a largest length hold. Because the smallest length covers the window of
the hash, a boundary depends on the text near it alone, so an insertion shifts the chunks after it but does not
change them. A fingerprint is the set of chunk digests with chunk lengths; the likeness of a document to another is
the share of its distinct chunk bytes that the other has too (containment, 0 to 1).

Editing needs the next document in the order of doc_id. Pairs of doc_id and a hash of the text are cut into ranges of
about `block_documents`, so rows that share an id are spread too; every row goes to the partition of its range, once, and
one first row of a range also to the range before it (of the first to the last). A partition is sorted by Spark and
read as a stream that holds two documents at a time. What the driver sees is the first pair of each range.

Defined cases: a null text is empty and has an empty fingerprint. Two empty fingerprints have likeness 1, an empty
one to another 0. A null doc_id comes before all others. Rows with one doc_id are ordered by a hash of their texts,
so equal rows follow each other. A single document is its own next one. An empty table gives an empty result.
"""

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from gaugeline.llm.common import table

SMALLEST, NORMAL, LARGEST = 32, 128, 512
#: Leading zero bits that end a chunk, before and after the normal length of 2^7 bytes.
RARE_BITS, FREQUENT_BITS = 9, 5
BLOCK_DOCUMENTS = 5_000
GEAR = np.array([xxhash.xxh64_intdigest(bytes([b]), 7) & 0xFFFFFFFF for b in range(256)], np.uint32)
RESULT = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string())]
    + [("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The hash of the 32 bytes that end at each byte: the sum of the bytes' gear values, shifted by their age."""
    h = GEAR[data]
    for age in (1, 2, 4, 8, 16):
        older = h[:-age] << np.uint32(age)
        h[age:] += older
    return h


def boundaries(data: bytes) -> list[int]:
    """Ends of the chunks of `data`."""
    n = len(data)
    if n <= SMALLEST:
        return [n] if n else []
    h = gear_hashes(np.frombuffer(data, np.uint8))
    frequent = np.flatnonzero(h < np.uint32(1 << (32 - FREQUENT_BITS)))
    rare = frequent[h[frequent] < np.uint32(1 << (32 - RARE_BITS))]
    frequent, rare = (frequent + 1).tolist(), (rare + 1).tolist()
    ends, start = [], 0
    while start < n:
        limit = min(start + NORMAL, n)
        i = bisect_left(rare, start + SMALLEST)
        if i < len(rare) and rare[i] < limit:
            end = rare[i]
        else:
            i = bisect_left(frequent, max(limit, start + SMALLEST))
            end = min(frequent[i] if i < len(frequent) else n, start + LARGEST, n)
        ends.append(end)
        start = end
    return ends


def chunk_set(data: bytes) -> dict[int, int]:
    """Digest to length of the distinct chunks."""
    found, start = {}, 0
    for end in boundaries(data):
        found[xxhash.xxh64_intdigest(data[start:end])] = end - start
        start = end
    return found


def containment(a: dict[int, int], b: dict[int, int]) -> float:
    total = sum(a.values())
    if not total:
        return 0.0 if b else 1.0
    return sum(n for digest, n in a.items() if digest in b) / total


def as_text(chunks: dict[int, int]) -> str:
    return " ".join(f"{digest:016x}:{n}" for digest, n in sorted(chunks.items()))


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first ones of the following text."""
    cut = len(text) // 2
    return text[: len(text) - cut] + following[:cut]


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, str, str]]:
    """(doc_id, text, next text) of a sorted range whose last rows are the first of the range that follows."""
    before, ended = None, False
    for batch in batches:
        for doc_id, text, is_next in zip(*[batch[c].to_pylist() for c in ("doc_id", "text", "is_next")], strict=True):
            if ended:
                continue
            text = text or ""
            if before is not None:
                yield *before, text
            before, ended = (doc_id, text), is_next


def _fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), RESULT, strict=True)], schema=RESULT)

    rows, last_text, last = [], None, {}
    for doc_id, text, following in _pairs(batches):
        own = last if last_text is text else chunk_set(text.encode())
        last_text, last = following, own if following == text else chunk_set(following.encode())
        changed = edited(text, following).encode()
        new = chunk_set(changed)
        sha = hashlib.sha256(changed).hexdigest()
        rows.append((doc_id, len(text), sha, as_text(own), as_text(new), containment(own, new), containment(own, last)))
        if len(rows) == 500:
            yield out(rows)
            rows = []
    if rows:
        yield out(rows)


def _keys(ids: pa.Array, hashes: pa.Array) -> np.ndarray:
    """Ids and hashes as bytes in the order of (id with nulls first, hash)."""
    out = np.zeros(len(ids), np.dtype([("known", "u1"), ("id", ">u8"), ("hash", ">u8")]))
    out["known"] = np.asarray(ids.is_valid())
    sign = np.uint64(1 << 63)
    out["id"] = np.asarray(ids.fill_null(-(2**63))).astype(np.int64).view(np.uint64) ^ sign
    out["hash"] = np.asarray(hashes).astype(np.int64).view(np.uint64) ^ sign
    return out.view(f"S{out.dtype.itemsize}")


def _first_keys(keys: DataFrame, block_documents: int) -> pa.Table:
    """The first (doc_id, hash) of every range that has rows, in order."""
    parts = max(1, -(-keys.count() // block_documents))
    ranged = keys.repartitionByRange(parts, "doc_id", "hash") if parts > 1 else keys
    part = F.spark_partition_id() if parts > 1 else F.lit(0)
    firsts = ranged.withColumn("part", part).groupBy("part").agg(F.min(F.struct("doc_id", "hash")).alias("first"))
    return firsts.orderBy("part").select("first.*").toArrow()


def with_next(docs: DataFrame, block_documents: int = BLOCK_DOCUMENTS) -> DataFrame:
    """(doc_id, text, is_next) of `docs` in one sorted partition for each range of (doc_id, hash); see `_pairs`."""
    hashed = F.xxhash64("text").alias("hash")
    found = _first_keys(docs.select("doc_id", hashed), block_documents)
    ranges = max(1, len(found))
    firsts = _keys(*[found.column(c).combine_chunks() for c in ("doc_id", "hash")])

    def places(ids: pa.Array, hashes: pa.Array) -> pa.Array:
        """Twice the place of a row's range, and one more if the row is a first one."""
        keys = _keys(ids, hashes)
        at = np.searchsorted(firsts, keys, side="right") - 1
        return pa.array(2 * at + (firsts[at] == keys), pa.int32())

    coded = docs.select("doc_id", "text", F.arrow_udf(places, "int")("doc_id", hashed).alias("code"))
    own = coded.select("doc_id", "text", F.lit(False).alias("is_next"), F.shiftright("code", 1).alias("place"))
    # Of equal first rows, one goes to the range before.
    sent = coded.filter(F.col("code").bitwiseAND(1) == 1).dropDuplicates(["code"])
    sent = sent.select("doc_id", "text", F.lit(True), F.pmod(F.shiftright("code", 1) - 1, F.lit(ranges)))
    rows = own.union(sent).repartitionById(ranges, "place")
    ordered = rows.sortWithinPartitions("is_next", F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    return ordered.select("doc_id", "text", "is_next")


def fingerprint_documents(docs: DataFrame, block_documents: int = BLOCK_DOCUMENTS) -> DataFrame:
    """Fingerprints of `docs` (doc_id, text), of their edited texts, and their likenesses."""
    ddl = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_next(docs.select("doc_id", "text"), block_documents).mapInArrow(_fingerprint, ddl)


def op5_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint_documents(table(spark, folder, "documents"))
