"""Language identification with a linear-chain conditional random field.

Every word gets a posterior over languages from forward-backward over its chain; a document's language is the one
with the highest mean posterior, which is its score. Words score through prefixes, suffixes, letter n-grams, the
whole word, and the lexicons that hold it; transitions between neighbouring words are learned. Training chains join
spans of different documents, so that switches of language within a chain occur and their weights are learned too.

Fitted on a bounded sample of labelled rows: about `documents_per_language` documents of each language, chosen by a
hash of their id, and of each `spans_per_document` spans of `span_words` words spread over its whole text. Half of
the spans give the lexicons, the other half the weights, so lexicon features are not trained on their own words. The
sample is fitted on the driver, its size is the product of these parameters and the number of languages. Prediction
maps over all documents and all their words; words run in chains of at most `CHAIN_WORDS`. A run of more than
`RUN_LETTERS` letters is cut into pieces, so that every letter of a script without spaces counts. Features of words that
a task meets for the first time are hashed in arrays, up to `WORDS_AT_ONCE` words together.

Defined cases: a null text or one without a letter is `und` with score 0, and so is every text if nothing is
labelled. Rows without a language teach nothing. Ties go to the language first in code point order. Repeated rows
get equal answers. Very long texts are labelled whole, in a call of their own. An empty table gives an empty result.
Columns of the input stay; the new ones have the names the caller gives.
"""

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count, islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from gaugeline.llm.common import fresh_name, remainder, table, uniform
from gaugeline.plans.joins import broadcast_if_small

UNKNOWN = "und"
DOCUMENTS_PER_LANGUAGE, SPANS_PER_DOCUMENT, SPAN_WORDS = 1000, 6, 10
SPANS_PER_CHAIN, CHAIN_WORDS, RUN_LETTERS = 3, 256, 24
FAMILIAR, SUPPORTED = 0.75, 0.5
FEATURES = 1 << 17
ROUNDS, STEP, RIDGE = 60, 0.15, 2e-5
CACHED_WORDS, CHARACTERS_PER_CALL, WORDS_AT_ONCE = 300_000, 2 << 20, 10_000
AFFIX = 4
_RUN = re.compile(r"[^\W\d_]+")
#: CRC-32 of every byte after a zero state: one step of the sum is a look-up and a shift.
_CRC = np.array([zlib.crc32(bytes([b ^ 0xFF])) ^ zlib.crc32(b"\xff") for b in range(256)], np.uint32)


def words_of(text: str | None) -> list[str]:
    """Runs of letters; a run above RUN_LETTERS is cut into pieces, which follow each other in the chain like words."""
    runs = _RUN.findall(text.lower()) if text else []
    if max(map(len, runs), default=0) <= RUN_LETTERS:
        return runs
    return [r[i : i + RUN_LETTERS] for r in runs for i in range(0, len(r), RUN_LETTERS)]


def features(word: str, lexicon: dict[str, tuple[int, ...]]) -> list[int]:
    """Hashed features of a word: affixes up to AFFIX letters, n-grams of 2 and 3 letters, the word, and its lexicons."""
    edged = f"^{word}$"
    names = [f"w{word}"]
    names += [f"p{word[:n]}" for n in range(1, min(AFFIX, len(word)) + 1)]
    names += [f"s{word[-n:]}" for n in range(1, min(AFFIX, len(word)) + 1)]
    names += [f"2{edged[i : i + 2]}" for i in range(len(edged) - 1)]
    names += [f"3{edged[i : i + 3]}" for i in range(len(edged) - 2)]
    names += [f"l{label}" for label in lexicon.get(word, ())]
    return [zlib.crc32(name.encode()) % FEATURES for name in names]


class _Hashes:
    """CRC-32 of many strings at once, letter by letter; `letters` are code points, a string is known by its places there."""

    def __init__(self, letters: np.ndarray):
        parts = [letters, letters >> 6, letters >> 12, letters >> 18]
        self.more = np.searchsorted([0x80, 0x800, 0x10000], letters, side="right")
        first = [parts[0], 0xC0 | parts[1], 0xE0 | parts[2], 0xF0 | parts[3]]
        self.bytes = [np.choose(self.more, first)]
        self.bytes += [0x80 | (0x3F & np.choose(np.maximum(self.more - n, 0), parts)) for n in (1, 2, 3) if (self.more >= n).any()]

    def begun(self, name: str, strings: int) -> np.ndarray:
        """The states of so many strings that begin with `name`."""
        return np.full(strings, zlib.crc32(name.encode()) ^ 0xFFFFFFFF, np.uint32)

    def then(self, states: np.ndarray, places: np.ndarray) -> np.ndarray:
        """The states after one more letter each, its UTF-8 bytes in order."""
        states = _CRC[(states ^ self.bytes[0][places]) & 0xFF] ^ (states >> 8)
        for n, trail in enumerate(self.bytes[1:], 1):
            at = np.flatnonzero(self.more[places] >= n)
            states[at] = _CRC[(states[at] ^ trail[places[at]]) & 0xFF] ^ (states[at] >> 8)
        return states


def features_of(words: list[str], lexicon: dict[str, tuple[int, ...]]) -> tuple[np.ndarray, np.ndarray]:
    """The `features` of all words end to end in the same order, and their number for each word, hashed in arrays."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    letters = np.frombuffer("".join(f"^{w}$" for w in words).encode("utf-32-le"), np.uint32)
    hashes = _Hashes(letters)
    begins = np.cumsum(sizes + 2) - sizes - 1  # of the word, after its edge
    ends, affixes = begins + sizes, np.minimum(sizes, AFFIX)
    known = [(i, labels) for i, labels in enumerate(map(lexicon.get, words)) if labels]
    counts = 2 + 2 * affixes + 2 * sizes
    for i, labels in known:
        counts[i] += len(labels)
    starts = np.cumsum(counts) - counts
    flat = np.empty(int(counts.sum()), np.uint32)
    word = zlib.crc32(b"w")
    flat[starts] = np.fromiter((zlib.crc32(w.encode(), word) for w in words), np.uint32, len(words))
    prefix = hashes.begun("p", len(words))
    for n in range(1, AFFIX + 1):
        at = np.flatnonzero(sizes >= n)
        prefix[at] = hashes.then(prefix[at], begins[at] + n - 1)
        suffix = hashes.begun("s", len(at))
        for back in range(n, 0, -1):
            suffix = hashes.then(suffix, ends[at] - back)
        flat[starts[at] + n], flat[starts[at] + affixes[at] + n] = ~prefix[at], ~suffix
    owner = np.repeat(np.arange(len(words)), sizes + 2)
    place = np.arange(len(letters)) - (begins - 1)[owner]
    target = (starts + 1 + 2 * affixes)[owner] + place
    for n in (2, 3):
        at = np.flatnonzero(place <= sizes[owner] + 2 - n)
        grams = hashes.begun(str(n), len(at))
        for k in range(n):
            grams = hashes.then(grams, at + k)
        flat[target[at]] = ~grams
        target += sizes[owner] + 1
    for i, labels in known:
        end = starts[i] + counts[i]
        flat[end - len(labels) : end] = [zlib.crc32(f"l{label}".encode()) for label in labels]
    return (flat % FEATURES).astype(np.int64), counts


def _runs(words: list[str]) -> Iterator[list[str]]:
    return (words[at : at + WORDS_AT_ONCE] for at in range(0, len(words), WORDS_AT_ONCE))


def feature_sums(flat: np.ndarray, sizes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Sum of the weights of each row's features; the rows lie end to end in `flat`, none is empty."""
    return np.add.reduceat(weights[flat], np.cumsum(sizes) - sizes, axis=0).astype(np.float32)


def forward_backward(scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray, start: np.ndarray, pairs: bool = True):
    """Posteriors of all words, and expected transitions and first labels, of chains laid end to end in `scores`.

    The words are taken place by place: those first in their chains, then the second ones. Without `pairs` the expected
    transitions, which only fitting needs, stay zero.
    """
    move, first = np.exp(transitions), np.exp(start)
    order = np.argsort(-lengths, kind="stable")
    begins = (np.cumsum(lengths) - lengths)[order]
    sorted_lengths = lengths[order]
    active = np.searchsorted(-sorted_lengths, -np.arange(int(sorted_lengths[0])), side="left")
    at = np.concatenate([begins[:n] + t for t, n in enumerate(active)])
    scores = scores[at]
    emit = np.exp(scores - scores.max(axis=1, keepdims=True))
    forward, backward = np.empty_like(emit), np.ones_like(emit)
    places = np.cumsum(active) - active
    for t, (n, place) in enumerate(zip(active, places, strict=True)):
        reach = emit[place : place + n] * (first if t == 0 else forward[places[t - 1] : places[t - 1] + n] @ move)
        forward[place : place + n] = reach / reach.sum(axis=1, keepdims=True)
    expected = np.zeros_like(move)
    for t in range(len(active) - 2, -1, -1):
        n = active[t + 1]
        now, after = slice(places[t], places[t] + n), slice(places[t + 1], places[t + 1] + n)
        message = emit[after] * backward[after]
        if pairs:
            joint = forward[now][:, :, None] * move[None] * message[:, None, :]
            expected += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        back = message @ move.T
        backward[now] = back / back.sum(axis=1, keepdims=True)
    found = forward * backward
    posterior = np.empty_like(found)
    posterior[at] = found / found.sum(axis=1, keepdims=True)
    return posterior, expected, posterior[begins].sum(axis=0)


@dataclass
class Field:
    """A fitted field: languages, weights by feature, transitions, first labels, and lexicons by word."""

    labels: list[str]
    weights: np.ndarray
    transitions: np.ndarray
    start: np.ndarray
    lexicon: dict[str, tuple[int, ...]]


def fit(spans: list[tuple[str, list[str]]], rounds: int = ROUNDS) -> Field | None:
    """Fit a field to labelled spans in an order without meaning. Even spans give lexicons, odd ones weights."""
    labels = sorted({label for label, words in spans if words})
    if not labels:
        return None
    number = {label: i for i, label in enumerate(labels)}
    counts: dict[str, np.ndarray] = {}
    for label, words in spans[::2]:
        for w in words:
            counts.setdefault(w, np.zeros(len(labels)))[number[label]] += 1
    lexicon = {w: tuple(np.flatnonzero(c >= 0.3 * c.sum()).tolist()) for w, c in counts.items() if c.sum() >= 2}
    odd = [s for s in spans[1::2] if s[1]] or [s for s in spans if s[1]]
    index: dict[str, int] = {}
    ids, truth, lengths = [], [], []
    for at in range(0, len(odd), SPANS_PER_CHAIN):
        chain = odd[at : at + SPANS_PER_CHAIN]
        ids += [index.setdefault(w, len(index)) for _, words in chain for w in words]
        truth += [number[label] for label, words in chain for _ in words]
        lengths.append(sum(len(words) for _, words in chain))
    ids, truth, lengths = np.array(ids), np.array(truth), np.array(lengths)
    runs = [features_of(run, lexicon) for run in _runs(list(index))]
    flat, sizes = np.concatenate([r[0] for r in runs]), np.concatenate([r[1] for r in runs])
    owner = np.repeat(np.arange(len(index)), sizes)
    starts = np.cumsum(sizes) - sizes
    k, n = len(labels), len(ids)
    begins = np.cumsum(lengths) - lengths
    inner = np.ones(n, bool)
    inner[begins] = False
    seen_pairs = np.zeros((k, k))
    np.add.at(seen_pairs, (truth[:-1][inner[1:]], truth[1:][inner[1:]]), 1)
    seen_first = np.bincount(truth[begins], minlength=k).astype(float)
    one_hot = np.eye(k)[truth]
    params = [np.zeros((FEATURES, k)), np.zeros((k, k)), np.zeros(k)]
    mean, square = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, rounds + 1):
        weights, transitions, start = params
        emissions = np.add.reduceat(weights[flat], starts, axis=0)
        posterior, pairs, firsts = forward_backward(emissions[ids], lengths, transitions, start)
        off = one_hot - posterior
        by_word = np.stack([np.bincount(ids, off[:, j], len(index)) for j in range(k)], axis=1)
        by_feature = np.stack([np.bincount(flat, by_word[owner, j], FEATURES) for j in range(k)], axis=1)
        slopes = [by_feature / n, (seen_pairs - pairs) / n, (seen_first - firsts) / n]
        for i, slope in enumerate(slopes):
            slope = slope - RIDGE * params[i]
            mean[i] = 0.9 * mean[i] + 0.1 * slope
            square[i] = 0.98 * square[i] + 0.02 * slope**2
            params[i] = params[i] + STEP * (mean[i] / (1 - 0.9**step)) / (np.sqrt(square[i] / (1 - 0.98**step)) + 1e-6)
    return Field(labels, params[0].astype(np.float32), params[1], params[2], lexicon)


class Labeller:
    """Posteriors of whole texts under a field. Scores of words are kept, up to a bound, from call to call."""

    def __init__(self, field: Field):
        self.field = field
        self.taught = field.weights.any(axis=1)
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = defaultdict(count().__next__)
        self.scores = np.zeros((0, len(self.field.labels)), np.float32)
        self.letters, self.familiar = np.zeros(0, bool), np.zeros(0, bool)

    def word_ids(self, words: list[str]) -> np.ndarray:
        if len(self.index) > CACHED_WORDS:
            self.forget()
        known = len(self.index)
        index = self.index
        ids = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
        fresh = list(islice(index, known, None))
        if fresh:
            for run in _runs(fresh):
                flat, sizes = features_of(run, self.field.lexicon)
                self.scores = np.concatenate([self.scores, feature_sums(flat, sizes, self.field.weights)])
                known = feature_sums(flat, sizes, self.taught[:, None].astype(np.float32))[:, 0] / sizes
                self.familiar = np.concatenate([self.familiar, known >= FAMILIAR])
            self.letters = np.concatenate([self.letters, [w.isalpha() or any(map(str.isalpha, w)) for w in fresh]])
        return ids

    def posteriors(self, texts: list[str | None]) -> tuple[list[list[str]], list[np.ndarray], list[np.ndarray]]:
        """Words of each text that have a letter, their posteriors, and whether most of their features were learned."""
        found = [words_of(t) for t in texts]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        ids = self.word_ids([w for words in found for w in words])
        keep = self.letters[ids] if len(ids) else np.zeros(0, bool)
        owner = np.repeat(np.arange(len(found)), sizes)[keep]
        ids = ids[keep]
        if not keep.all():
            found = [[w for w in words if any(c.isalpha() for c in w)] for words in found]
        counts = np.bincount(owner, minlength=len(found))
        if not len(ids):
            return found, [np.zeros((0, len(self.field.labels)))] * len(found), [np.zeros(0, bool)] * len(found)
        whole, rest = counts // CHAIN_WORDS, counts % CHAIN_WORDS
        chains = [x for w, r in zip(whole.tolist(), rest.tolist(), strict=True) for x in [CHAIN_WORDS] * w + [r] * (r > 0)]
        posterior, _, _ = forward_backward(
            self.scores[ids].astype(np.float64), np.array(chains), self.field.transitions, self.field.start, pairs=False
        )
        ends = np.cumsum(counts)[:-1]
        return found, np.split(posterior, ends), np.split(self.familiar[ids], ends)

    def documents(self, texts: list[str | None]) -> tuple[list[str], list[float], list[float]]:
        """Language and score of each text, and the share of its words that look like any learned language."""
        names, scores, shares = [], [], []
        for part in _parts(texts):
            for p, familiar in zip(*self.posteriors(part)[1:], strict=True):
                shares.append(float(familiar.mean()) if len(p) else 0.0)
                if not len(p):
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                mean = p.mean(axis=0)
                best = int(mean.argmax())
                names.append(self.field.labels[best])
                scores.append(min(1.0, float(mean[best])))
        return names, scores, shares


def _parts(texts: list[str | None]) -> Iterator[list[str | None]]:
    """Runs of texts with a bounded number of characters; a longer text is a run of its own."""
    part, size = [], 0
    for text in texts:
        if part and size + len(text or "") > CHARACTERS_PER_CALL:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text or "")
    if part:
        yield part


def _spans(words: int, spans: int):
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for label, text, key in zip(batch["label"], batch["text"], batch["key"], strict=True):
                found = words_of(text)
                starts = {i * max(0, len(found) - words) // max(1, spans - 1) for i in range(spans)} if found else ()
                for at in sorted(starts):
                    rows.append((label, zlib.crc32(f"{key}:{at}".encode()), f"{key}:{at}", found[at : at + words]))
            yield pd.DataFrame(rows, columns=["label", "place", "name", "words"])

    return cut


def learn(
    labelled: DataFrame,
    text: str = "text",
    label: str = "lang",
    key: str = "doc_id",
    documents_per_language: int = DOCUMENTS_PER_LANGUAGE,
    spans_per_document: int = SPANS_PER_DOCUMENT,
    span_words: int = SPAN_WORDS,
) -> Field | None:
    """Fit a field to a bounded sample of `labelled`; None if there is no labelled word."""
    rows = labelled.select(F.col(label).alias("label"), F.col(key).cast("string").alias("key"), F.col(text).alias("text"))
    rows = rows.filter("label is not null and text is not null")
    sizes = rows.groupBy("label").count()
    drawn = uniform(F.col("key"), seed="language") * F.col("count") < documents_per_language
    sample = rows.join(broadcast_if_small(sizes), "label").filter(drawn).drop("count").dropDuplicates(["label", "key"])
    spans = sample.mapInPandas(_spans(span_words, spans_per_document), "label string, place bigint, name string, words array<string>")
    found = sorted((r["place"], r["name"], r["label"], list(r["words"])) for r in spans.collect())
    return fit([(label, words) for _, _, label, words in found])


def with_language(
    docs: DataFrame, field: Field | None, text: str = "text", language: str = "lang_pred", score: str = "score", support: str | None = None
) -> DataFrame:
    """`docs` with the predicted language and its score, and with the share of familiar words if that is named."""
    if field is None:
        return docs.withColumns({language: F.lit(UNKNOWN), score: F.lit(0.0), **({support: F.lit(0.0)} if support else {})})
    state: list[Labeller] = []

    def predict(texts: pa.Array) -> pa.Array:
        if not state:
            state.append(Labeller(field))
        names, scores, shares = state[0].documents(texts.to_pylist())
        columns = [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(shares, pa.float64())]
        return pa.StructArray.from_arrays(columns, ["language", "score", "support"])

    found = F.arrow_udf(predict, "struct<language:string,score:double,support:double>")(F.col(text))
    name = fresh_name(docs, "_found")
    new = {language: F.col(f"{name}.language"), score: F.col(f"{name}.score"), **({support: F.col(f"{name}.support")} if support else {})}
    return docs.withColumn(name, found).withColumns(new).drop(name)


def op1_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    field = learn(docs.filter(remainder("doc_id") != 0))
    held = docs.select("doc_id", (remainder("doc_id") == 0).alias("held_out"), "text")
    return with_language(held, field).drop("text")


def known_language(docs: DataFrame, at_least: float = SUPPORTED) -> DataFrame:
    """`docs` without those that have no letter, or fewer than `at_least` of their words in any learned language.

    A word is familiar if three quarters of its affixes, n-grams and lexicons occurred in the sample, in whatever language:
    text that switches between languages stays, however many there are, and letters without order go.
    """
    field = learn(docs.filter(remainder("doc_id") != 0))
    language, score, support = (fresh_name(docs, c) for c in ("_language", "_score", "_support"))
    found = with_language(docs, field, language=language, score=score, support=support)
    return found.filter((F.col(language) != UNKNOWN) & (F.col(support) >= at_least)).drop(language, score, support)
