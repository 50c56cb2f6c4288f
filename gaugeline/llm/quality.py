"""Quality of documents by attention-based multiple-instance learning.

A document is a bag of passages of `PASSAGE_WORDS` words; only the document has a label. Every passage is described by
how often each class of byte follows each other one, by its share of bytes of each class, and by how its words repeat.
It is encoded by one layer, h = tanh(W x + b). Gated attention weighs the passages of a document,
a ~ exp(w . (tanh(V h) * sigmoid(U h))), and the score is the sigmoid of a line over the weighted mean of the h. All of
these weights are learned together from labels of documents alone; nothing tells which passage made a document bad.

The model is fitted to a bounded sample: `DOCUMENTS_PER_CLASS` documents of each class, drawn by a hash of the id, and of
each at most `PASSAGES_PER_DOCUMENT` passages, spread evenly. Classes count as often as they are among all labelled
documents. Scoring reads whole texts, all passages of them.

Defined cases: a text that is null or has no word is one passage without words. Texts above 4 MB are cut between words
into parts, where passages begin anew; a passage ends with a word, however long that is. Labels that are null or neither 0 nor 1 are left out, and of an id with
both labels, each counts. Rows without an id are scored, never learned from. Repeated rows get the same score and are one
in the sample. Without labels of both classes every score is 0.5 or, with one class, that class. An empty table gives an
empty result. Other columns stay.
"""

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gaugeline.llm.common import fresh_name, remainder, table
from gaugeline.llm.tokens import NOT_SPACE, batches_of, mixed, words_of
from gaugeline.plans.joins import broadcast_if_small

PASSAGE_WORDS = 64
DOCUMENTS_PER_CLASS, PASSAGES_PER_DOCUMENT = 1500, 16
ENCODED, GATES = 32, 16
EPOCHS, BATCH, RATE, DECAY, SEED = 20, 64, 0.01, 1e-4, 7
AT_LEAST = 0.7
PART_PASSAGES, PART_BYTES = 4096, 4 << 20
_GAP = re.compile(rb"[\x20\x09-\x0D]")

# Classes of bytes.
CLASSES = ("\n\r", " \t\x0b\x0c", "0123456789", ".", ",;:", "!?", "'\"()[]{}", "|", "#$%&*@^~_=+<>/\\`", "-")


def _classes() -> np.ndarray:
    found = np.full(256, len(CLASSES) + 3, np.uint8)  # other controls
    for i, some in enumerate(CLASSES):
        found[list(some.encode())] = i
    found[ord("a") : ord("z") + 1] = len(CLASSES)
    found[ord("A") : ord("Z") + 1] = len(CLASSES) + 1
    found[0x80:] = len(CLASSES) + 2
    return found


CLASS = _classes()
N = len(CLASSES) + 4
FEATURES = N * N + N + 5


# ---- passages ------------------------------------------------------------------------------------------------------


def _parts(texts: Sequence[bytes]) -> Iterator[tuple[int, bytes]]:
    """(number of the text, part): long texts are cut between words."""
    for i, text in enumerate(texts):
        begin = 0
        while len(text) - begin > PART_BYTES and (gap := _GAP.search(text, begin + PART_BYTES)):
            yield i, text[begin : gap.start()]
            begin = gap.start()
        yield i, text[begin:]


def passages(texts: Sequence[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(number of the text, features) of all passages, in order and in parts; what has no word is one passage."""
    numbers, parts = zip(*_parts(texts), strict=True) if texts else ((), ())
    for first, part in batches_of(parts):
        number = np.array(numbers[first : first + len(part)])
        buffer = b"\n".join([*part, b""])
        data = np.frombuffer(buffer, np.uint8)
        words = words_of(part, NOT_SPACE)
        begins = np.cumsum([0, *[len(t) + 1 for t in part]])[:-1]
        count = np.bincount(words.owner, minlength=len(part))
        place = np.arange(len(words.owner)) - np.repeat(np.cumsum(count) - count, count)
        empty = np.flatnonzero(count == 0)
        # A passage reaches from its first word to the next passage or the end of the text.
        starts = np.flatnonzero(place % PASSAGE_WORDS == 0)
        at = np.concatenate([words.begins[starts], begins[empty]])
        owner = np.concatenate([words.owner[starts], empty])
        word = np.concatenate([starts, np.full(len(empty), -1)])
        order = np.lexsort((at, owner))
        at, owner, word = at[order], owner[order], word[order]
        ends = np.append(at[1:], len(data))
        last = np.append(owner[1:] != owner[:-1], True)
        ends[last] = (begins + [len(t) for t in part])[owner[last]]
        sizes = np.where(word < 0, 0, np.minimum(PASSAGE_WORDS, count[owner] - place[word] if len(place) else 0))
        for i in range(0, len(at), PART_PASSAGES):
            some = slice(i, i + PART_PASSAGES)
            yield number[owner[some]], _features(data, at[some], ends[some], words, word[some], sizes[some])


def _features(data, begins, ends, words, first, sizes) -> np.ndarray:
    n = len(begins)
    kind = CLASS[data[begins[0] : ends[-1]]].astype(np.int32)
    lengths = ends - begins
    inside = np.repeat(np.arange(n), lengths)
    at = np.arange(len(inside)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(begins - begins[0], lengths)
    own = kind[at]
    found = np.zeros((n, FEATURES), np.float32)
    found[:, N * N : N * N + N] = np.bincount(inside * N + own, minlength=n * N).reshape(n, N)
    pairs = np.flatnonzero(inside[1:] == inside[:-1])
    found[:, : N * N] = np.bincount(inside[pairs] * (N * N) + own[pairs] * N + own[pairs + 1], minlength=n * N * N).reshape(n, N * N)
    found[:, : N * N + N] = np.sqrt(found[:, : N * N + N] / np.maximum(lengths, 1)[:, None])

    total = int(sizes.sum())
    passage = np.repeat(np.arange(n), sizes)
    word = np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(first, sizes)
    hashes, long = words.hashes[word], (words.ends - words.begins)[word].astype(float)
    some = np.maximum(sizes, 1)

    def share(weights) -> np.ndarray:
        return np.bincount(passage[: len(weights)], weights, n) / some

    again = np.append(False, (hashes[1:] == hashes[:-1]) & (passage[1:] == passage[:-1]))[:total]
    second = np.zeros(total, bool)
    second[2:] = (hashes[2:] == hashes[:-2]) & (passage[2:] == passage[:-2])
    distinct = np.unique(mixed(hashes + passage.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)[1]
    mean = share(np.minimum(long, 40.0))
    found[:, N * N + N] = share(again)
    found[:, N * N + N + 1] = share(second)
    found[:, N * N + N + 2] = np.bincount(passage[distinct], minlength=n) / some
    found[:, N * N + N + 3] = mean / 8
    found[:, N * N + N + 4] = np.log1p(sizes) / np.log1p(PASSAGE_WORDS)
    return found


# ---- the model -----------------------------------------------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


@dataclass
class Model:
    """Weights, in single precision: standardisation, encoder, gates, and the line over the weighted passage."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def encode(self, x: np.ndarray) -> np.ndarray:
        w = self.weights
        return np.tanh((x - self.mean) * self.scale @ w["W"] + w["b"])

    def attention(self, h: np.ndarray) -> np.ndarray:
        """Logits of the attention."""
        w = self.weights
        return np.tanh(h @ w["V"]) * _sigmoid(h @ w["U"]) @ w["w"]

    def bags(self, owner: np.ndarray, h: np.ndarray, logits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(score, attention of each passage) of documents whose passages are in order; every document has one."""
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        which = np.cumsum(np.diff(owner, prepend=owner[:1]) != 0)
        top = np.maximum.reduceat(logits, first)
        share = np.exp(logits - top[which])
        share /= np.add.reduceat(share, first)[which]
        bag = np.add.reduceat(share[:, None] * h, first)
        return _sigmoid(bag @ self.weights["c"] + self.weights["d"]), share

    def documents(self, texts: Sequence[bytes]) -> list[tuple[float, int, int, float]]:
        """(score, passages, place of the passage with the most attention, its attention) of every text."""
        parts = [(owner, h, self.attention(h)) for owner, h in ((o, self.encode(x)) for o, x in passages(texts))]
        if not parts:
            return []
        owner, h, logits = map(np.concatenate, zip(*parts, strict=True))
        score, share = self.bags(owner, h, logits)
        begins = np.flatnonzero(np.diff(owner, prepend=-1))
        found = []
        for s, b, e in zip(score.tolist(), begins, np.append(begins[1:], len(owner)), strict=True):
            best = int(share[b:e].argmax())
            found.append((s, int(e - b), best, float(share[b + best])))
        return found


def fit(bags: Sequence[np.ndarray], labels: np.ndarray, weights: np.ndarray) -> Model:
    """Learn from bags of passage features; `weights` say how much a bag counts. Adam over batches of bags."""
    rng = np.random.default_rng(SEED)
    every = np.concatenate(bags)
    mean, deviation = every.mean(axis=0), every.std(axis=0)
    scale = (1 / np.maximum(deviation, 0.02)).astype(np.float32)

    def start(*shape: int) -> np.ndarray:
        return rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)

    w = {
        "W": start(every.shape[1], ENCODED), "b": np.zeros(ENCODED, np.float32), "V": start(ENCODED, GATES), "U": start(ENCODED, GATES),
        "w": start(GATES), "c": start(ENCODED), "d": np.zeros((), np.float32),
    }
    model = Model(mean.astype(np.float32), scale, w)
    steps = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in w.items()}
    weights = weights / weights.mean()
    t = 0
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS) + RATE / 50
        order = rng.permutation(len(bags))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            t += 1
            for k, g in _gradient(model, [bags[i] for i in some], labels[some], weights[some]).items():
                g = g + DECAY * w[k]
                m, v = steps[k]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w[k] -= (rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    return model


def _gradient(model: Model, bags: list[np.ndarray], labels: np.ndarray, weights: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean weighted cross entropy of the bags' scores."""
    w = model.weights
    owner = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    x = (np.concatenate(bags) - model.mean) * model.scale
    h = np.tanh(x @ w["W"] + w["b"])
    tanh, gate = np.tanh(h @ w["V"]), _sigmoid(h @ w["U"])
    score, share = model.bags(owner, h, tanh * gate @ w["w"])
    bag = np.add.reduceat(share[:, None] * h, first)
    error = (weights * (score - labels) / len(bags)).astype(np.float32)

    to_bag = error[owner][:, None] * w["c"]  # what a change of the weighted passage does
    from_share = (to_bag * (h - bag[owner])).sum(axis=1) * share
    to_tanh = from_share[:, None] * w["w"] * gate * (1 - tanh**2)
    to_gate = from_share[:, None] * w["w"] * tanh * gate * (1 - gate)
    to_h = (share[:, None] * to_bag + to_tanh @ w["V"].T + to_gate @ w["U"].T) * (1 - h**2)
    return {
        "W": x.T @ to_h, "b": to_h.sum(axis=0), "V": h.T @ to_tanh, "U": h.T @ to_gate, "w": (from_share[:, None] * tanh * gate).sum(axis=0),
        "c": bag.T @ error, "d": error.sum(),
    }


# ---- on tables -----------------------------------------------------------------------------------------------------


def _bytes(texts: pa.Array) -> list[bytes]:
    return [t or b"" for t in texts.cast(pa.large_binary()).to_pylist()]


def _described(per_document: int):
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, labels, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist(), _bytes(batch.column(2))
            for i, label, text in zip(ids, labels, texts, strict=True):
                x = np.concatenate([f for _, f in passages([text])])
                if len(x) > per_document:
                    x = x[np.arange(per_document) * len(x) // per_document]
                row = [pa.array([i], pa.int64()), pa.array([label], pa.int32()), pa.array([x.tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(row, ["id", "label", "bag"])

    return describe


def learn(
    docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality",
    documents_per_class: int = DOCUMENTS_PER_CLASS, passages_per_document: int = PASSAGES_PER_DOCUMENT,
) -> Model | float:
    """Fit a model to a bounded sample of the labelled documents; a constant score if there are not both classes."""
    rows = labels.select(F.col(key).cast("bigint").alias("id"), F.col(label).cast("int").alias("label"))
    rows = rows.filter("id is not null and label in (0, 1)").distinct()
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return float(next(iter(sizes))) if sizes else 0.5
    drawn = [
        rows.filter(F.col("label") == c).orderBy(F.xxhash64(F.lit("quality"), "id"), "id").limit(documents_per_class) for c in (0, 1)
    ]
    texts = docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("text")).filter("id is not null")
    sample = texts.join(broadcast_if_small(drawn[0].unionByName(drawn[1])), "id").select("id", "label", "text")
    found = sample.mapInArrow(_described(passages_per_document), "id bigint, label int, bag binary")
    found = found.groupBy("id", "label").agg(F.min("bag").alias("bag"))
    bags = sorted((r["id"], r["label"], bytes(r["bag"])) for r in found.collect())
    seen = {c: sum(b[1] == c for b in bags) for c in (0, 1)}
    if not all(seen.values()):
        return float(max(seen, key=seen.get)) if any(seen.values()) else 0.5
    share = np.array([sizes[c] / seen[c] for _, c, _ in bags])
    arrays = [np.frombuffer(b, np.float32).reshape(-1, FEATURES) for _, _, b in bags]
    return fit(arrays, np.array([c for _, c, _ in bags], float), share)


_FIELDS = {"score": pa.float64(), "passages": pa.int32(), "top_passage": pa.int32(), "top_weight": pa.float64()}


def with_quality(docs: DataFrame, model: Model | float, text: str = "text", name: str = "found") -> DataFrame:
    """`docs` with a struct: score, number of passages, and the place and attention of the one that counts most."""

    def score(texts: pa.Array) -> pa.Array:
        if isinstance(model, Model):
            rows = model.documents(_bytes(texts))
        else:
            rows = [(model, 1, 0, 1.0)] * len(texts)
        columns = zip(*rows, strict=True) if rows else [[]] * len(_FIELDS)
        return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, _FIELDS.values(), strict=True)], list(_FIELDS))

    kind = "struct<score:double,passages:int,top_passage:int,top_weight:double>"
    return docs.withColumn(name, F.arrow_udf(score, kind)(F.col(text)))


def op12_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")

    def held(key: Column) -> Column:
        return remainder(key, 4) == 2

    learned = labels.filter(~held(F.col("doc_id")))
    model = learn(docs.filter(~held(F.col("doc_id"))), learned)
    found = with_quality(docs.select("doc_id", "text"), model)
    score = F.col("found.score")
    rest = ("found.passages", "found.top_passage", "found.top_weight")
    return found.select("doc_id", held(F.col("doc_id")).alias("held_out"), score, (score >= AT_LEAST).cast("int").alias("predicted"), *rest)
