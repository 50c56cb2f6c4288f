"""Benchmark decontamination: seeds of word pairs and Smith-Waterman alignment.

A match gives 2, a mismatch or a gap costs 1, and a copy counts if its alignment reaches `least` (one half) of the
item's own score. Seeds lose none of these copies. An alignment of m words with costs of c scores 2 m - c, so if it
reaches half of the score of n words, at least s = (n - 1) // 2 of its steps from one matched word to the next cost
no more than 1: both words are at distance 1 or 2 in the item, and at distance 1 or 2 in the document. The pairs of
words at these distances are counted over all documents. Each item leaves out those s - 1 first words whose pairs are
most frequent; a copy holds a pair of the others, however often the item leaked. Around its pairs a document is
aligned with the item, as far as an alignment can drift, unless too few words agree to reach the score.

Items are read in blocks of at most `BLOCK_ITEMS` items and `BLOCK_BYTES` bytes; a block travels to the tasks with
its seeds, and all documents meet all blocks. Documents stay where they are: no shuffle depends on how often an item
leaked.

Defined cases: null and empty texts match nothing. Items with fewer than three words are too short to be evidence
and are left out. Words are runs of letters and digits, lower-cased. Repeated items are found under each of their
ids. A document that holds an item several times reports its best copy, the first of equal ones. Empty tables give
empty results.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gaugeline.llm.common import fresh_name, table
from gaugeline.llm.tokens import ALPHANUMERIC, batches_of, mixed, words_of

LEAST_WORDS = 3
MATCH, COST, LEAST = 2, 1, 0.5
BLOCK_ITEMS, BLOCK_BYTES = 20_000, 8 << 20
FOUND = "array<struct<item_id:bigint,similarity:double,score:int,first_word:int,last_word:int>>"
_FOUND = pa.list_(
    pa.struct([("item_id", pa.int64()), ("similarity", pa.float64()), ("score", pa.int32()), ("first_word", pa.int32()), ("last_word", pa.int32())])
)
_FILTER_BITS = 22


def _lower(texts: list[str | None]) -> list[bytes]:
    return [(t or "").lower().encode() for t in texts]


def word_pairs(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the pairs of words at distance 1 and 2, for words in a row, and the place of each pair's first word."""
    parts = [mixed(mixed(hashes[:-d]) * np.uint64(3) + hashes[d:]) for d in (1, 2)]
    return np.concatenate(parts), np.concatenate([np.arange(len(x)) for x in parts])


def fewest_steps(n: int, least: float) -> int:
    """How many steps of cost 0 or 1 a copy of `n` words has that reaches `least` of the item's score."""
    return max(1, int(np.ceil(least * n - 1)))


class Lookup:
    """Places of 64-bit keys in a sorted array, behind a bit table that turns most others away."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.bits = np.zeros(1 << _FILTER_BITS, bool)
        self.bits[keys >> np.uint64(64 - _FILTER_BITS)] = True

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in `wanted`, places in the keys) of what is there."""
        at = np.flatnonzero(self.bits[wanted >> np.uint64(64 - _FILTER_BITS)])
        place = np.searchsorted(self.keys, wanted[at])
        place[place == len(self.keys)] = 0
        good = self.keys[place] == wanted[at] if len(self.keys) else np.zeros(0, bool)
        return at[good], place[good]


@dataclass
class Block:
    """Items of a block: ids, hashes of their words, and their pairs as (hash, item, place)."""

    ids: list[int | None]
    words: list[np.ndarray]
    hashes: np.ndarray
    item: np.ndarray
    place: np.ndarray


def make_block(items: list[tuple[int | None, str]]) -> Block:
    ids, words, parts = [], [], []
    for item_id, text in items:
        found = words_of(_lower([text]), ALPHANUMERIC).hashes
        if len(found) >= LEAST_WORDS:
            g, place = word_pairs(found)
            parts.append((g, np.full(len(g), len(ids)), place))
            ids.append(item_id)
            words.append(found)
    columns = [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [np.zeros(0, np.uint64), np.zeros(0, int), np.zeros(0, int)]
    return Block(ids, words, *columns)


def item_blocks(items: DataFrame, most: int = BLOCK_ITEMS) -> Iterator[Block]:
    """Blocks of `items` (item_id, text); the driver holds one at a time."""
    held, size = [], 0
    for row in items.filter("text is not null").select("item_id", "text").toLocalIterator():
        held.append((row["item_id"], row["text"]))
        size += len(row["text"])
        if len(held) >= most or size >= BLOCK_BYTES:
            yield make_block(held)
            held, size = [], 0
    if held:
        yield make_block(held)


def _document_pairs(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(number of the first text, word hashes, text of each word, pair hashes, first word of each pair) in runs of texts.

    A pair that crosses texts has the hash 0.
    """
    for first, part in batches_of(texts):
        w = words_of(part, ALPHANUMERIC)
        g, place = word_pairs(w.hashes)
        if len(g):
            g[np.concatenate([w.owner[d:] != w.owner[:-d] for d in (1, 2)])] = 0
        yield first, w.hashes, w.owner, g, place


def pair_counts(docs: DataFrame, block: Block, text: str = "text") -> np.ndarray:
    """How often each pair of the block occurs in all documents, in the order of its unique hashes."""
    keys = np.unique(block.hashes)
    state: list[Lookup] = []

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not state:
            state.append(Lookup(keys))
        total = np.zeros(len(keys), np.int64)
        for batch in batches:
            for *_, g, _ in _document_pairs(_lower(batch["text"].to_pylist())):
                total += np.bincount(state[0].find(g)[1], minlength=len(keys))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["pair", "n"])

    rows = docs.select(F.col(text).alias("text")).mapInArrow(count, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = np.zeros(len(keys), np.int64)
    for row in rows.collect():  # at most one row for each pair of the block
        counts[row["pair"]] = row["n"]
    return counts


def sure_seeds(block: Block, counts: np.ndarray, least: float = LEAST) -> Block:
    """The block with those pairs as its only ones of which every copy that reaches `least` has one."""
    frequency = counts[np.searchsorted(np.unique(block.hashes), block.hashes)]
    chosen = np.ones(len(block.hashes), bool)
    sizes = np.bincount(block.item, minlength=len(block.ids))
    begin = 0
    for words, n in zip(block.words, sizes.tolist(), strict=True):
        spare = fewest_steps(len(words), least) - 1
        if spare:
            place = block.place[begin : begin + n]
            load = np.bincount(place, frequency[begin : begin + n])
            chosen[begin : begin + n] = ~np.isin(place, np.argsort(-load, kind="stable")[:spare])
        begin += n
    by_hash = np.flatnonzero(chosen)[np.argsort(block.hashes[chosen], kind="stable")]
    return Block(block.ids, block.words, block.hashes[by_hash], block.item[by_hash], block.place[by_hash])


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Best local score, and the last item word and last passage word of the first alignment that has it."""
    width = len(passage)
    slope = np.arange(1, width + 1) * COST
    above = np.zeros(width + 1, np.int64)
    best = (0, 0, 0)
    for i, word in enumerate(item):
        step = above[:-1] + np.where(passage == word, MATCH, -COST)
        row = np.maximum(np.maximum(step, above[1:] - COST), 0)
        row = np.maximum.accumulate(row + slope) - slope  # gaps in the item, any number of words long
        above[1:] = row
        top = int(row.argmax())
        if row[top] > best[0]:
            best = (int(row[top]), i, top)
    return best


class Finder:
    """Copies of the items of a block in texts."""

    def __init__(self, seeds: Block, least: float):
        self.seeds, self.least = seeds, least
        self.keys, self.begins = np.unique(seeds.hashes, return_index=True)
        self.ends = np.append(self.begins[1:], len(seeds.hashes))
        self.lookup = Lookup(self.keys)
        self.sizes = np.array([len(w) for w in seeds.words], np.int64)
        # The costs of a copy, and so its drift, are at most the score of all its words less the score it must reach.
        self.drift = np.ceil((1 - least) * MATCH * self.sizes).astype(np.int64)
        self.needed = np.ceil(least * self.sizes).astype(np.int64)

    def _passages(self, at: np.ndarray, key: np.ndarray, owner: np.ndarray):
        """(text, item, first word, past the last word) around seeds, near ones joined."""
        sizes = self.ends[key] - self.begins[key]
        s = np.repeat(self.begins[key], sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        item, begin, text = self.seeds.item[s], np.repeat(at, sizes) - self.seeds.place[s], np.repeat(owner[at], sizes)
        slack = self.drift[item]
        begin, end = begin - slack, begin + self.sizes[item] + slack
        order = np.lexsort((begin, item, text))
        text, item, begin, end = text[order], item[order], begin[order], end[order]
        # All passages of an item are equally long, so ends are in order too.
        new = np.ones(len(text), bool)
        new[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (begin[1:] > end[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(text)) - 1
        return zip(text[first].tolist(), item[first].tolist(), begin[first].tolist(), end[last].tolist(), strict=True)

    def find(self, texts: list[str | None]) -> list[list[dict]]:
        found: list[dict[int, dict]] = [{} for _ in texts]
        for first, words, owner, g, place in _document_pairs(_lower(texts)):
            at, key = self.lookup.find(g)
            if not len(at):
                continue
            at = place[at]
            text_begins = np.searchsorted(owner, np.arange(int(owner[-1]) + 2))
            for text, item, begin, end in self._passages(at, key, owner):
                low, high = int(text_begins[text]), int(text_begins[text + 1])
                begin, end = max(begin, low), min(end, high)
                own = self.seeds.words[item]
                if np.isin(own, words[begin:end]).sum() < self.needed[item]:
                    continue
                score, last_item, last = align(own, words[begin:end])
                known = found[first + text].get(item)
                if score < self.least * MATCH * len(own) or known and known["score"] >= score:
                    continue
                _, _, back = align(own[last_item::-1], words[begin : begin + last + 1][::-1])
                where = begin - low + last
                found[first + text][item] = {
                    "item_id": self.seeds.ids[item], "similarity": score / (MATCH * len(own)), "score": score,
                    "first_word": where - back, "last_word": where,
                }
        return [[hits[i] for i in sorted(hits)] for hits in found]


def copies_column(seeds: Block, text: str, least: float = LEAST) -> Column:
    """The copies of a block's items in a text, as an array."""
    state: list[Finder] = []

    def find(texts: pa.Array) -> pa.Array:
        if not state:
            state.append(Finder(seeds, least))
        return pa.array(state[0].find(texts.to_pylist()), _FOUND)

    return F.arrow_udf(find, FOUND)(F.col(text))


def seed_blocks(docs: DataFrame, items: DataFrame, text: str = "text", least: float = LEAST) -> Iterator[Block]:
    for block in item_blocks(items):
        if block.ids:
            yield sure_seeds(block, pair_counts(docs, block, text), least)


def find_copies(docs: DataFrame, items: DataFrame, least: float = LEAST) -> DataFrame:
    """(doc_id, item_id, similarity, score, first_word, last_word) of `docs` (doc_id, text) and `items` (item_id, text)."""
    found = None
    for seeds in seed_blocks(docs, items, "text", least):
        hits = docs.select("doc_id", copies_column(seeds, "text", least).alias("found")).filter(F.size("found") > 0)
        rows = hits.select("doc_id", F.inline("found"))
        found = rows if found is None else found.unionByName(rows)
    if found is None:
        none = docs.limit(0).select("doc_id", F.lit(None).cast(FOUND).alias("found"))
        return none.select("doc_id", F.inline("found"))
    return found


def without_copies(docs: DataFrame, items: DataFrame, least: float = LEAST) -> DataFrame:
    """`docs` without those that hold a copy of an item; columns stay."""
    for seeds in seed_blocks(docs, items, "text", least):
        name = fresh_name(docs, "_copies")
        docs = docs.withColumn(name, copies_column(seeds, "text", least)).filter(F.size(name) == 0).drop(name)
    return docs


def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return find_copies(docs, table(spark, folder, "benchmark").select("item_id", "text"))
