"""Language-model scoring with an Elias-Fano n-gram trie.

The model is a bigram model with a Dirichlet prior: p(w | v) = (c(v, w) + m * p(w)) / (c(v) + m), where p(w) is the
base (add one half) and m is `PRIOR`. Tokens are the words of a text and one end; a text begins in a context of its
own.

The model grows with the corpus, so it is never sent to tasks as a whole. Documents are dealt into groups of about
`GROUP_BYTES`. A group lists its distinct words and word pairs, with their counts in training documents, in lists
packed as arrays, one for each shard of the model. A shard merges the lists of all groups, builds its trie
(contexts, pointers and successors as Elias-Fano sequences, and the first part of the sum above as one-byte codes,
all memory-mapped), looks up every pair by a successor search within its context, and answers every list with a list
of the same order. The group then scores whole documents. Pairs go to the shard of their context, except those of
the few contexts that hold more than a quarter of a shard's share of tokens: these are spread over all shards by
their words. There are at most four such contexts a shard.

Defined cases: a null text is empty and has one token, the end. Words are told apart by 64-bit hashes, in a shard by
48 bits of them. Rows without an id count as training rows. Repeated rows count as often as they are there. Without
training rows every count is 0. An empty table gives an empty result.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from gaugeline.llm.common import remainder, table
from gaugeline.llm.eliasfano import Trie, quantised, shares_of
from gaugeline.llm.tokens import NOT_SPACE, batches_of, joined_planes, mixed, planes, words_of
from gaugeline.plans.scratch import materialize

GROUP_BYTES = SHARD_BYTES = 5 << 20
PRIOR = 300.0
START, END = np.uint64(0xD1B54A32D192ED03), np.uint64(0xABC98388FB8FAC03)
_SHORT = 6  # bytes of a word's hash in a list of pairs
LISTS = "shard int, group int, pairs boolean, keys binary, runs binary, more binary, counts binary"
SCORES = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_())]
    + [(c, pa.int64()) for c in ("n_tokens", "n_known", "train_tokens")]
    + [(c, pa.float64()) for c in ("base_score", "score")]
)


def _shard(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shards in the order of the keys."""
    return ((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int32)


def _slices(shard: np.ndarray) -> Iterator[tuple[int, slice]]:
    """The shards that occur in a sorted array, and where."""
    held, at = np.unique(shard, return_index=True)
    for s, begin, end in zip(held.tolist(), at.tolist(), [*at[1:].tolist(), len(shard)], strict=False):
        yield s, slice(begin, end)


class Tokens:
    """Tokens of a group of texts: distinct words and pairs, and where each token has them."""

    def __init__(self, texts: list[bytes], train: np.ndarray, hot: np.ndarray, shards: int):
        hashes, owner = [], []
        for first, part in batches_of(texts):
            w = words_of([t.lower() for t in part], NOT_SPACE)
            hashes.append(w.hashes)
            owner.append((w.owner + first).astype(np.int32))
        every = np.arange(len(texts), dtype=np.int32)
        owner = np.concatenate([*owner, every])
        order = np.argsort(owner, kind="stable")  # the end comes after the words of its text
        self.owner = owner[order]
        hashes = np.concatenate([*hashes, np.full(len(texts), END, np.uint64)])[order]
        self.words, word = np.unique(np.append(hashes, START), return_inverse=True)
        del hashes, order
        word = word.astype(np.int32)
        start, self.word = word[-1], word[:-1]
        self.context = np.concatenate([[start], self.word[:-1]])
        self.context[np.flatnonzero(np.diff(self.owner, prepend=-1))] = start
        self.train = train[self.owner]
        pairs, pair = np.unique(self.context.astype(np.uint64) << np.uint64(32) | self.word.astype(np.uint64), return_inverse=True)
        context, follower = self.words[pairs >> np.uint64(32)], self.words[pairs & np.uint64(0xFFFFFFFF)]
        spread = np.isin(context, hot)
        shard = _shard(np.where(spread, mixed(context * np.uint64(3) + follower), context), shards)
        order = np.argsort(shard, kind="stable")
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        self.pair = place[pair]
        self.pair_shard, self.contexts, self.followers = shard[order], context[order], follower[order]

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Training counts of the words and of the pairs."""
        return (
            np.bincount(self.word, self.train, len(self.words)).astype(np.uint32),
            np.bincount(self.pair, self.train, len(self.contexts)).astype(np.uint32),
        )

    def lists(self, shards: int) -> Iterator[tuple[int, bool, bytes, bytes, bytes, bytes]]:
        words, pairs = self.counts()
        for s, part in _slices(_shard(self.words, shards)):
            yield s, False, planes(self.words[part], np.uint64), b"", b"", planes(words[part], np.uint32)
        for s, part in _slices(self.pair_shard):
            contexts = self.contexts[part]
            begins = np.flatnonzero(np.diff(contexts, prepend=~contexts[0]))
            runs = planes(np.diff(begins, append=len(contexts)), np.uint32)
            more = planes(self.followers[part], np.uint64, _SHORT)
            yield s, True, planes(contexts[begins], np.uint64), runs, more, planes(pairs[part], np.uint32)


def _column(rows: pa.Table, name: str) -> list:
    return rows.column(name).to_pylist()


def _group(rows: pa.Table, hot: np.ndarray, shards: int) -> Tokens:
    texts = [t or b"" for t in rows.column("text").cast(pa.large_binary()).to_pylist()]
    return Tokens(texts, np.array(_column(rows, "train"), bool), hot, shards)


def _asker(hot: np.ndarray, shards: int):
    def ask(rows: pa.Table) -> pa.Table:
        group = rows.column("group")[0].as_py()
        lists = [(s, group, *rest) for s, *rest in _group(rows, hot, shards).lists(shards)]
        types = [pa.int32(), pa.int32(), pa.bool_(), *[pa.binary()] * 4]
        columns = zip(*lists, strict=True) if lists else [[]] * len(types)
        names = [c.split()[0] for c in LISTS.split(", ")]
        return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return ask


def _merge_words(keys: list[bytes], counts: list[bytes]) -> list[bytes]:
    """Total counts for every list of words."""
    if not keys:
        return []
    words = joined_planes(keys, np.uint64)
    unique, place = np.unique(words, return_inverse=True)
    total = np.bincount(place, joined_planes(counts, np.uint32), len(unique)).astype(np.uint64)
    answers = total[place]
    ends = np.cumsum([len(k) // 8 for k in keys])
    return [planes(a, np.uint64) for a in np.split(answers, ends[:-1])]


def _merge_pairs(rows: list[dict], hot: np.ndarray, hot_counts: np.ndarray) -> list[bytes]:
    """Codes for every list of pairs, from a trie over the training pairs of all lists."""
    if not rows:
        return []
    runs = joined_planes([r["runs"] for r in rows], np.uint32)
    contexts = np.repeat(joined_planes([r["keys"] for r in rows], np.uint64), runs)
    words = joined_planes([r["more"] for r in rows], np.uint64, _SHORT)
    counts = joined_planes([r["counts"] for r in rows], np.uint32)
    seen = np.flatnonzero(counts)
    seen = seen[np.lexsort((words[seen], contexts[seen]))]
    new = np.ones(len(seen), bool)
    new[1:] = (contexts[seen][1:] != contexts[seen][:-1]) | (words[seen][1:] != words[seen][:-1])
    begins = np.flatnonzero(new)
    total = np.add.reduceat(counts[seen].astype(np.int64), begins) if len(begins) else np.zeros(0, np.int64)
    context, word = contexts[seen][begins], words[seen][begins]
    unique, place = np.unique(context, return_inverse=True)
    of_context = np.bincount(place, total, len(unique))
    if len(hot) and len(unique):
        at = np.minimum(np.searchsorted(hot, unique), len(hot) - 1)
        of_context = np.where(hot[at] == unique, hot_counts[at], of_context)
    trie = Trie(context, word, quantised(total / (of_context[place] + PRIOR)))
    codes = trie.find(contexts, words)
    ends = np.cumsum([len(r["more"]) // _SHORT for r in rows])
    return [c.tobytes() for c in np.split(codes, ends[:-1])]


def _answerer(hot: np.ndarray, hot_counts: np.ndarray):
    def answer(rows: pa.Table) -> pa.Table:
        lists = rows.to_pylist()
        words, pairs = [r for r in lists if not r["pairs"]], [r for r in lists if r["pairs"]]
        answers = _merge_words([r["keys"] for r in words], [r["counts"] for r in words]) + _merge_pairs(pairs, hot, hot_counts)
        every = words + pairs
        columns = [pa.array([r[c] for r in every], t) for c, t in (("group", pa.int32()), ("shard", pa.int32()), ("pairs", pa.bool_()))]
        return pa.table([*columns, pa.array(answers, pa.binary())], names=["group", "shard", "pairs", "answer"])

    return answer


def _scorer(hot: np.ndarray, shards: int, train_tokens: int, distinct: int):
    norm = train_tokens + 0.5 * (distinct + 1)

    def score(rows: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(rows):
            return SCORES.empty_table()
        group = _group(rows, hot, shards)
        by_shard = sorted(answers.select(["pairs", "shard", "answer"]).to_pylist(), key=lambda r: r["shard"])
        count = joined_planes([r["answer"] for r in by_shard if not r["pairs"]], np.uint64).astype(float)
        code = np.frombuffer(b"".join(r["answer"] for r in by_shard if r["pairs"]), np.uint8)
        if len(count) != len(group.words) or len(code) != len(group.contexts):
            raise ValueError("the answers do not fit the lists")
        base = (count + 0.5) / norm
        texts = np.array(_column(rows, "train_texts"))[0]
        context_count = np.where(group.words == START, texts, count)
        rest = PRIOR / (context_count + PRIOR)
        p = shares_of(code)[group.pair] + rest[group.context] * base[group.word]
        n = len(rows)

        def sums(values: np.ndarray) -> np.ndarray:
            return np.bincount(group.owner, values, n)

        tokens = np.bincount(group.owner, minlength=n)
        known = sums(count[group.word] > 0).astype(np.int64)
        columns = [
            rows.column("doc_id"), pa.array(~np.array(_column(rows, "train"), bool)), tokens, known, np.full(n, train_tokens),
            sums(np.log10(base)[group.word]), sums(np.log10(np.minimum(p, 1.0))),
        ]
        return pa.table(columns, schema=SCORES)

    return score


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, counts = [], []
        for _, part in batches_of([t or b"" for t in batch["text"].cast(pa.large_binary()).to_pylist()]):
            keys.append(words_of([t.lower() for t in part], NOT_SPACE).hashes)
        if not keys:
            continue
        keys, counts = np.unique(np.concatenate(keys), return_counts=True)
        some = list(_slices(_shard(keys, 256)))
        columns = [[s for s, _ in some], *[[planes(a[part], t) for _, part in some] for a, t in ((keys, np.uint64), (counts, np.uint32))]]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.binary(), pa.binary()), strict=True)], ["part", "keys", "counts"])


def _sum_words(rows: pa.Table) -> pa.Table:
    keys = joined_planes(_column(rows, "keys"), np.uint64)
    unique, place = np.unique(keys, return_inverse=True)
    total = np.bincount(place, joined_planes(_column(rows, "counts"), np.uint32), len(unique))
    return pa.table([pa.array(unique.view(np.int64)), pa.array(total.astype(np.int64))], names=["word", "n"])


def word_counts(docs: DataFrame) -> DataFrame:
    """(word hash, n) of the words of `docs` (text), as a written table: the first level of the model."""
    parts = docs.select("text").mapInArrow(_count_words, "part int, keys binary, counts binary")
    return materialize(parts.groupBy("part").applyInArrow(_sum_words, "word bigint, n bigint"), "lm-words")


def score_documents(docs: DataFrame, held_out, group_bytes: int = GROUP_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Scores of `docs` (doc_id, text) by a model of the rows for which the column `held_out` is false."""
    rows = docs.select("doc_id", "text", (~held_out).alias("train"))
    n, size = rows.agg(F.sum(F.col("train").cast("bigint")), F.sum(F.octet_length("text"))).first()
    texts, size = n or 0, size or 0
    groups, shards = 1 + size // group_bytes, 1 + size // shard_bytes
    words = word_counts(rows.filter("train"))
    total, distinct = words.agg(F.sum("n"), F.count("*")).first()
    train_tokens, distinct = (total or 0) + texts, distinct + (texts > 0)
    # Fewer than 4 * shards words are above the bound.
    many = words.filter(F.col("n") > train_tokens / (4 * shards)).collect()
    hot = np.array([r["word"] for r in many] + [int(START.astype(np.int64))], np.int64).view(np.uint64)
    hot_counts = np.array([r["n"] for r in many] + [texts], float)
    order = np.argsort(hot)
    hot, hot_counts = hot[order], hot_counts[order]
    group = F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)).cast("int")
    dealt = rows.select("doc_id", "text", "train", F.lit(texts).alias("train_texts"), group.alias("group"))
    lists = dealt.groupBy("group").applyInArrow(_asker(hot, shards), LISTS)
    answers = lists.groupBy("shard").applyInArrow(_answerer(hot, hot_counts), "group int, shard int, pairs boolean, answer binary")
    ddl = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return dealt.groupBy("group").cogroup(answers.groupBy("group")).applyInArrow(_scorer(hot, shards, train_tokens, distinct), ddl)


def op7_language_model(spark: SparkSession, folder: str) -> DataFrame:
    return score_documents(table(spark, folder, "documents").select("doc_id", "text"), remainder("doc_id") == 1)
