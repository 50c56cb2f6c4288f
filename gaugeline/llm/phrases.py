"""Phrase collocation mining: counts of word runs by HAT-tries, and the runs whose parts rarely occur apart.

Runs of one to `MAX_WORDS` words are counted in passes over the whole texts, a pass for each length. A run can only be
frequent if both runs that are one word shorter are, so each pass after the first leaves out runs with a part that is
not. Which parts are, it asks a bitmap of `FILTER_BITS` bits, whatever the size of the corpus: a wrong bit lets a rare
run be counted, and the exact count drops it later; no bit hides a frequent one.

A task counts in one HAT-trie per language: a shallow trie over the identity of a run, whose leading bits name
the run's prefix (all words but the last), over hash containers of sorted arrays that burst into a level of the trie when
they fill up. Beyond `TASK_ENTRIES` entries the largest subtrees are spilled whole: they leave the task as sorted runs,
one row for each range of identities. A range, so a set of whole prefixes, is merged in a task of its own from the
sorted runs of all tasks. The number of ranges follows the size of the text. The words after one prefix are dealt over 16
places, so a prefix that holds a third of all words is no bottleneck. Everything after the counts is joins of frequent runs.

Words, prefixes and runs are told apart by 64-bit hashes.

Defined cases: a null text is empty and has no word. A null language is `und`, as is that name itself. Repeated rows
count as often as they are there. Very long texts are read in parts that overlap by as many words as a run may reach
back; a word longer than a part is read whole. An empty table, or one without a frequent run, gives an empty result. Only
the text and the language are read, so other columns cannot clash.
"""

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from gaugeline.llm.common import table
from gaugeline.llm.tokens import batches_of, from_planes, mixed, planes, prefix_sums, span_hashes
from gaugeline.plans.scratch import materialize

MIN_COUNT, MAX_WORDS, COVERED_PERCENT, SCALE, TOP = 30, 4, 80, 2_000_000, 2000
RANGE_BYTES = 16 << 20
TASK_ENTRIES, CONTAINER_ENTRIES = 2 << 20, 1 << 15
FILTER_BITS = 26
PART_BYTES = 4 << 20
DIGIT_BITS = 4

_SEPARATOR = np.array([chr(b) in ".,;:!?" or 0x0A <= b <= 0x0D for b in range(256)])
_WORD = np.array([b not in (0x20, 0x09) for b in range(256)]) & ~_SEPARATOR
_GAP = re.compile(rb"[\x20\x09.,;:!?\x0A-\x0D]")
_PREFIX_BITS = np.uint64(24)
_STEP = np.uint64(0x9E3779B97F4A7C15)
RUNS = "lang string, range int, words binary, counts binary, texts binary"
FREQUENT = "lang string, run bigint, a bigint, words array<bigint>, firsts array<bigint>, rests array<bigint>, word string"


# ---- identities ----------------------------------------------------------------------------------------------------


def language_seed(lang: str) -> np.uint64:
    data = np.frombuffer(lang.encode() + b"\n", np.uint8)
    return span_hashes(prefix_sums(data), np.array([0]), np.array([len(data)]))[0]


def extended(runs: np.ndarray | None, words: np.ndarray, seed: np.uint64) -> np.ndarray:
    """Hashes of runs that are continued by a word; None stands for the empty run of a language."""
    return mixed(words ^ seed) if runs is None else mixed(runs * _STEP + words)


def run_hashes(words: np.ndarray, seed: np.uint64) -> np.ndarray:
    """Hashes of whole runs, whose words are the columns."""
    runs = None
    for column in words.T:
        runs = extended(runs, column, seed)
    return runs


def identities(words: np.ndarray, seed: np.uint64) -> np.ndarray:
    """64 bits that sort runs: 24 for the prefix and the place of its last word, then 40 for the run. See `summed`."""
    if words.shape[1] == 1:
        return run_hashes(words, seed)
    prefix = run_hashes(words[:, :-1], seed)
    rest = np.uint64(64) - _PREFIX_BITS
    place = mixed(prefix + (words[:, -1] >> np.uint64(60))) >> rest << rest
    return place | extended(prefix, words[:, -1], seed) >> _PREFIX_BITS


def summed(ids: np.ndarray, words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One entry per run, sorted by identity; runs that share an identity by chance are told apart by their words.

    The stable sort merges runs of entries that are sorted already.
    """
    if not len(ids):
        return ids, words, counts
    order = np.argsort(ids, kind="stable")
    same = ids[order[1:]] == ids[order[:-1]]
    unlike = (words[order[1:]] != words[order[:-1]]).any(axis=1)
    if (same & unlike).any():
        order = np.lexsort((*words.T, ids))
        unlike = (words[order[1:]] != words[order[:-1]]).any(axis=1)
    first = np.flatnonzero(np.append(True, unlike))
    return ids[order[first]], words[order[first]], np.add.reduceat(counts[order], first)


# ---- HAT-trie ------------------------------------------------------------------------------------------------------


class Container:
    """Entries in sorted arrays, and those that arrived since."""

    def __init__(self):
        self.parts: list[tuple] = []
        self.fresh = self.settled = 0

    def add(self, part: tuple) -> None:
        self.parts.append(part)
        self.fresh += len(part[0])
        if self.fresh > max(CONTAINER_ENTRIES // 4, self.settled):
            self.settle()

    def settle(self) -> tuple:
        part = self.parts[0] if len(self.parts) == 1 else summed(*map(np.concatenate, zip(*self.parts, strict=True)))
        self.parts, self.fresh, self.settled = [part], 0, len(part[0])
        return part

    def __len__(self) -> int:
        return self.fresh + self.settled


class HatTrie:
    """Counts of runs: levels of the trie are lists by the next digit of an identity, leaves are containers.

    Runs with the same identity are in the same container.
    """

    def __init__(self):
        self.root: list = [None] * (1 << DIGIT_BITS)
        self.sizes = np.zeros(1 << DIGIT_BITS, np.int64)

    def add(self, ids: np.ndarray, words: np.ndarray, counts: np.ndarray) -> None:
        """Entries of distinct runs, sorted by identity."""
        self._deal(self.root, 0, (ids, words, counts))
        self.sizes[:] = [self._size(child) for child in self.root]

    def _deal(self, level: list, depth: int, part: tuple) -> None:
        digits = (part[0] << np.uint64(depth * DIGIT_BITS)) >> np.uint64(64 - DIGIT_BITS)
        ends = np.searchsorted(digits, np.arange(1 << DIGIT_BITS), side="right")
        begin = 0
        for digit, end in enumerate(ends.tolist()):
            if end > begin:
                level[digit] = self._insert(level[digit], depth + 1, tuple(x[begin:end] for x in part))
            begin = end

    def _insert(self, node, depth: int, part: tuple):
        if isinstance(node, list):
            self._deal(node, depth, part)
            return node
        node = node or Container()
        node.add(part)
        if node.settled <= CONTAINER_ENTRIES or (depth + 1) * DIGIT_BITS > 64:
            return node
        level: list = [None] * (1 << DIGIT_BITS)
        self._deal(level, depth, node.settle())
        return level

    def _size(self, node) -> int:
        if isinstance(node, list):
            return sum(self._size(child) for child in node)
        return len(node) if node else 0

    def _leaves(self, node) -> Iterator[tuple]:
        if isinstance(node, list):
            for child in node:
                yield from self._leaves(child)
        elif node:
            yield node.settle()

    def spill(self, down_to: int = 0) -> Iterator[tuple]:
        """Take out the largest subtrees until `down_to` entries are left; each as one sorted run."""
        while self.sizes.sum() > down_to:
            digit = int(self.sizes.argmax())
            leaves = list(self._leaves(self.root[digit]))
            self.root[digit], self.sizes[digit] = None, 0
            yield tuple(map(np.concatenate, zip(*leaves, strict=True)))


# ---- counting in tasks ---------------------------------------------------------------------------------------------


class Filter:
    """Bitmap of frequent runs; may take a rare run for a frequent one, never the other way round."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def known(self, runs: np.ndarray) -> np.ndarray:
        at = runs >> np.uint64(64 - FILTER_BITS)
        return (self.bits[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


class Read:
    """Words of a buffer: their places and hashes, and the number of the piece that each is in."""

    def __init__(self, buffer: bytes):
        self.buffer = buffer
        data = np.frombuffer(buffer, np.uint8)
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = _WORD[data]
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.begins, self.ends = edges[::2], edges[1::2]
        self.words = span_hashes(prefix_sums(data), self.begins, self.ends)
        self.piece = np.cumsum(_SEPARATOR[data], dtype=np.int32)[self.begins]


def _reads(texts: list[bytes], reach: int) -> Iterator[tuple[Read, int]]:
    """(words, number of the first byte whose words count) for all texts; texts are pieces of their own.

    A part of a long text begins `reach` words before the bytes that it adds.
    """
    for _, part in batches_of(texts):
        buffer = b"\n".join([*part, b""]).lower()
        begin = done = 0
        while done < len(buffer):
            gap = _GAP.search(buffer, done + PART_BYTES)
            cut = gap.start() if gap else len(buffer)
            read = Read(buffer[begin:cut])
            yield read, done - begin
            begin, done = begin + (int(read.begins[-reach]) if len(read.begins) >= reach else 0), cut


def count_texts(texts: list[bytes], length: int, seed: np.uint64, known: Filter | None, seen: dict | None) -> Iterator[tuple]:
    """Entries (identities, words, counts) of the runs of one length whose shorter parts may be frequent."""
    for read, skip in _reads(texts, MAX_WORDS - 1):
        n = len(read.words) - length + 1
        if n <= 0:
            continue
        runs = None
        for i in range(length - 1):
            runs = extended(runs, read.words[i : i + n + 1], seed)
        keep = (read.piece[:n] == read.piece[length - 1 :]) & (read.begins[length - 1 :] >= skip)
        if length > 1:
            frequent = known.known(runs)
            keep &= frequent[:-1] & frequent[1:]
        at = np.flatnonzero(keep)
        if not len(at):
            continue
        words = np.stack([read.words[at + i] for i in range(length)], axis=1)
        ids = identities(words, seed)
        if seen is not None:  # the identity of a single word is its hash
            some, first = np.unique(ids, return_index=True)
            for h, b, e in zip(some.tolist(), read.begins[at[first]].tolist(), read.ends[at[first]].tolist(), strict=True):
                if h not in seen:
                    seen[h] = read.buffer[b:e]
        yield summed(ids, words, np.ones(len(ids), np.int64))


def _packed(lang: str, run: tuple, range_bits: int, seen: dict | None) -> Iterator[tuple]:
    """The rows of a sorted run, one for each range. Words go as steps from row to row, which repeat a lot."""
    ids, words, counts = run
    ranges = ids >> np.uint64(64 - range_bits) if range_bits else np.zeros(len(ids), np.uint64)
    begins = np.flatnonzero(np.diff(ranges, prepend=~ranges[:1]))
    for begin, end in zip(begins, [*begins[1:], len(ids)], strict=True):
        part = slice(begin, end)
        texts = b"" if seen is None else b"\n".join([seen.pop(i) for i in ids[part].tolist()])
        steps = np.diff(words[part], axis=0, prepend=np.zeros((1, words.shape[1]), np.uint64))
        yield lang, int(ranges[begin]), planes(steps.T.ravel(), np.uint64), planes(counts[part], np.uint64), texts


def _table(rows: list[tuple], kinds: list, schema: str) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    names = [c.split()[0] for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _counter(length: int, range_bits: int, known, entries: int):
    kinds = [pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = Filter(known.value) if known else None
        tries: dict[str, tuple] = {}
        waiting: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}

        def read(lang: str) -> None:
            if lang not in tries:
                tries[lang] = HatTrie(), language_seed(lang), {} if length == 1 else None
            trie, seed, seen = tries[lang]
            for part in count_texts(waiting.pop(lang), length, seed, bits, seen):
                trie.add(*part)
            sizes.pop(lang)

        def spilled(down_to: int) -> Iterator[pa.RecordBatch]:
            while tries and sum(t.sizes.sum() for t, _, _ in tries.values()) > down_to:
                lang = max(tries, key=lambda x: tries[x][0].sizes.sum())
                trie, _, seen = tries[lang]
                for run in trie.spill(int(trie.sizes.sum()) // 2 if down_to else 0):
                    yield from (_table([row], kinds, RUNS) for row in _packed(lang, run, range_bits, seen))

        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1)
            for lang, text in zip(langs, texts, strict=True):
                value = text.as_py()
                if not value:
                    continue
                waiting.setdefault(lang, []).append(value)
                sizes[lang] = sizes.get(lang, 0) + len(value)
                if sizes[lang] > PART_BYTES // 4:
                    read(lang)
                    yield from spilled(entries)
        for lang in list(waiting):
            read(lang)
            yield from spilled(entries)
        yield from spilled(0)

    return count


# ---- merging in tasks ----------------------------------------------------------------------------------------------


def _signed(hashes: np.ndarray) -> list[int]:
    return np.ascontiguousarray(hashes).view(np.int64).tolist()


def _merger(length: int, at_least: int):
    kinds = [pa.string(), pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * 3, pa.string()]

    def merge(rows: pa.Table) -> pa.Table:
        lang = rows.column("lang")[0].as_py()
        seed = language_seed(lang)
        words, counts, texts = [], [], []
        for w, c, t in zip(*(rows.column(x).to_pylist() for x in ("words", "counts", "texts")), strict=True):
            steps = from_planes(w, np.uint64).reshape(length, -1)
            words.append(np.cumsum(steps, axis=1, dtype=np.uint64).T)
            counts.append(from_planes(c, np.uint64).astype(np.int64))
            texts += t.split(b"\n") if length == 1 else []
        words, counts = np.concatenate(words), np.concatenate(counts)
        ids = identities(words, seed)
        if length == 1:
            names = dict(zip(ids.tolist(), texts, strict=True))
        total = int(counts.sum())
        ids, words, counts = summed(ids, words, counts)
        kept = counts >= at_least
        ids, words, counts = ids[kept], words[kept], counts[kept]
        n = len(ids)
        single = np.stack([run_hashes(words[:, i : i + 1], seed) for i in range(length)], axis=1)
        cuts = range(1, length)
        firsts = np.stack([run_hashes(words[:, :c], seed) for c in cuts], axis=1) if length > 1 else np.zeros((n, 0), np.uint64)
        rests = np.stack([run_hashes(words[:, c:], seed) for c in cuts], axis=1) if length > 1 else np.zeros((n, 0), np.uint64)
        named = [names[i].decode("utf-8", "replace") for i in ids.tolist()] if length == 1 else [None] * n
        columns = [
            [lang] * n, _signed(run_hashes(words, seed)), counts.tolist(), _signed(single), _signed(firsts), _signed(rests), named,
        ]
        if length == 1:  # one row without a run tells how many words the range has
            for column, value in zip(columns, [lang, None, total, None, None, None, None], strict=True):
                column.append(value)
        names_ = [c.split()[0] for c in FREQUENT.split(", ")]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names_)

    return merge


# ---- the operator --------------------------------------------------------------------------------------------------


def _filter_of(frequent: DataFrame) -> np.ndarray:
    """The bitmap of runs; at most 2^FILTER_BITS bits reach the driver."""
    at = F.shiftrightunsigned("run", 64 - FILTER_BITS)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), at.bitwiseAND(F.lit(63)).cast("int"))
    found = frequent.groupBy(F.shiftrightunsigned(at, 6).alias("at")).agg(F.bit_or(bit).alias("bits")).toArrow()
    bits = np.zeros(1 << max(FILTER_BITS - 6, 0), np.uint64)
    bits[found.column("at").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return bits


def frequent_runs(
    docs: DataFrame, text: str = "text", lang: str = "lang", at_least: int = MIN_COUNT, max_words: int = MAX_WORDS,
    range_bytes: int = RANGE_BYTES, task_entries: int = TASK_ENTRIES,
) -> list[DataFrame]:
    """Written tables of the runs of 1, 2, ... words that occur `at_least` times (1 or more), as in FREQUENT.

    Rows of the first table without a run hold the number of all words of a language, in parts.
    """
    if not (at_least >= 1 and 1 <= max_words <= MAX_WORDS):
        raise ValueError(f"at_least is 1 or more, max_words 1 to {MAX_WORDS}")
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(lang, F.lit("und")).alias("lang"), F.col(text).cast("binary").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    range_bits = max(0, math.ceil(math.log2(max(size, 1) / range_bytes)))
    found: list[DataFrame] = []
    for length in range(1, max_words + 1):
        known = None
        if length > 1:
            known = spark.sparkContext.broadcast(_filter_of(found[-1].filter("run is not null")))
        runs = rows.mapInArrow(_counter(length, range_bits, known, task_entries), RUNS)
        merged = runs.groupBy("lang", "range").applyInArrow(_merger(length, at_least), FREQUENT)
        found.append(materialize(merged, f"runs-{length}"))
        if known:
            known.destroy()
    return found


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", at_least: int = MIN_COUNT,
    covered_percent: int = COVERED_PERCENT, top: int = TOP, **options,
) -> DataFrame:
    """The `top` phrases of each language: lang, rank, phrase, a, l, r, n, score, cut.

    The score of a cut is 2a / (l + r), here in parts of a million; the lowest cut counts. A phrase that mostly occurs
    within one longer phrase is left out: the longer one takes its place.
    """
    found = frequent_runs(docs, text, lang, at_least, **options)
    words = found[0]
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    counts = every.filter("run is not null").select("run", "a")
    totals = words.filter("run is null").groupBy("lang").agg(F.sum("a").alias("n"))
    phrases = every.filter(F.size("words") > 1)

    cuts = phrases.select("run", "a", F.posexplode(F.arrays_zip("firsts", "rests")).alias("cut", "p"))
    parts = cuts.select("run", "a", (F.col("cut") + 1).alias("cut"), F.col("p.firsts").alias("first"), F.col("p.rests").alias("rest"))
    left = counts.select(F.col("run").alias("first"), F.col("a").alias("l"))
    right = counts.select(F.col("run").alias("rest"), F.col("a").alias("r"))
    exact = f"cast(cast({SCALE} as decimal(10,0)) * cast(a as decimal(19,0)) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0))) as bigint)"
    scored = parts.join(left, "first").join(right, "rest").withColumn("score", F.expr(exact))
    lowest = scored.groupBy("run").agg(F.min(F.struct("score", "cut", "l", "r")).alias("low"))

    # A longer phrase that covers enough has a part of one more word that does, too.
    longer = phrases.filter(F.size("words") > 2)
    inside = F.array(F.element_at("firsts", -1), F.element_at("rests", 1))
    covers = longer.select(F.explode(inside).alias("run"), "a").groupBy("run").agg(F.max("a").alias("longer"))
    kept = phrases.join(covers, "run", "left").filter(
        F.col("longer").isNull() | (F.col("longer").cast("decimal(22,0)") * 100 < F.col("a").cast("decimal(22,0)") * covered_percent)
    )
    names = words.filter("run is not null").select(F.col("run").alias("w"), "word")
    spelled = kept.select("run", F.posexplode("words").alias("i", "w")).join(names, "w").groupBy("run")
    spelled = spelled.agg(F.sort_array(F.collect_list(F.struct("i", "word"))).alias("s"))
    phrase = F.array_join(F.transform("s", lambda x: x["word"]), " ").alias("phrase")
    rows = kept.select("run", "lang", "a").join(lowest, "run").join(spelled.select("run", phrase), "run")
    rows = rows.select("lang", "phrase", "a", "low.l", "low.r", "low.score", "low.cut")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = rows.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "cut")


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents")).drop("cut")


SQL = """
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents WHERE text IS NOT NULL
), lists AS (
    SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM pieces
), starts AS (
    SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM lists
), runs AS (
    SELECT lang, k, array_to_string(ws[i : i + k - 1], ' ') AS phrase, ws[i : i + k - 1] AS words
    FROM starts, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE i + k - 1 <= len(ws)
), counts AS (
    SELECT lang, k, phrase, any_value(words) AS words, count(*) AS f FROM runs GROUP BY lang, k, phrase
), totals AS (
    SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang
), candidates AS (
    SELECT lang, k, phrase, words, f AS a FROM counts WHERE k > 1 AND f >= 30
), cuts AS (
    SELECT c.lang, c.phrase, c.a, c.cut, x.f AS l, y.f AS r, ((2000000::HUGEINT * c.a) // (x.f + y.f))::BIGINT AS score
    FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates) c
    JOIN counts x ON x.lang = c.lang AND x.k = c.cut AND x.phrase = array_to_string(c.words[1 : c.cut], ' ')
    JOIN counts y ON y.lang = c.lang AND y.k = c.k - c.cut AND y.phrase = array_to_string(c.words[c.cut + 1 : c.k], ' ')
), lowest AS (
    SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS place FROM cuts
), inside AS (
    SELECT lang, array_to_string(words[i : i + m - 1], ' ') AS phrase, max(a) AS longer
    FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM candidates))
    GROUP BY 1, 2
), ranked AS (
    SELECT l.lang, l.phrase, l.a, l.l, l.r, l.score,
        row_number() OVER (PARTITION BY l.lang ORDER BY l.score DESC, l.a DESC, l.phrase) AS rank
    FROM lowest l LEFT JOIN inside i ON i.lang = l.lang AND i.phrase = l.phrase
    WHERE l.place = 1 AND (i.longer IS NULL OR 100 * i.longer::HUGEINT < 80 * l.a::HUGEINT)
)
SELECT lang, rank::INT AS rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
