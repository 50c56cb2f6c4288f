"""The quality classifier: features by definition, gradients by differences, held-out accuracy, awkward documents."""

import os
import re
import sys
import zlib

sys.path.insert(0, os.path.dirname(__file__))

import numpy as np  # noqa: E402
import pytest  # noqa: E402
from awkward import LONG, documents, empty  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from gaugeline.llm import quality  # noqa: E402

FOLDER = "/root/testdata/sf0.01"


def plain_passages(text: bytes):
    """(bytes, words) of the passages of a text."""
    words = list(re.finditer(rb"[^\x20\x09-\x0D]+", text))
    if not words:
        return [(text, [])]
    starts = list(range(0, len(words), quality.PASSAGE_WORDS))
    ends = [words[i].start() for i in starts[1:]] + [len(text)]
    return [
        (text[words[i].start() : e], [w.group() for w in words[i : i + quality.PASSAGE_WORDS]]) for i, e in zip(starts, ends, strict=True)
    ]


def plain_features(passage: bytes, words: list[bytes]):
    n, kinds = quality.N, [int(quality.CLASS[b]) for b in passage]
    x = np.zeros(quality.FEATURES)
    for a, b in zip(kinds, kinds[1:]):
        x[a * n + b] += 1
    for a in kinds:
        x[n * n + a] += 1
    x = np.sqrt(x / max(len(passage), 1))
    many = max(len(words), 1)
    x[n * n + n :] = [
        sum(a == b for a, b in zip(words, words[1:])) / many,
        sum(a == b for a, b in zip(words, words[2:])) / many,
        len(set(words)) / many,
        sum(min(len(w), 40) for w in words) / many / 8,
        np.log1p(len(words)) / np.log1p(quality.PASSAGE_WORDS),
    ]
    return x


def test_features_equal_definition(monkeypatch):
    monkeypatch.setattr(quality, "PART_PASSAGES", 3)
    texts = [b"", b"  one two two two\n| 5 % \xc3\xa9 ", LONG[:9000].encode(), b" \n\t", b"x", b"A! " * 200, b"", b"end"]
    got = list(quality.passages(texts))
    owner, x = np.concatenate([o for o, _ in got]), np.concatenate([f for _, f in got])
    want = [(i, *p) for i, t in enumerate(texts) for p in plain_passages(t)]
    assert owner.tolist() == [i for i, _, _ in want]
    for features, (_, passage, words) in zip(x, want, strict=True):
        if words:
            assert np.allclose(features, plain_features(passage, words), atol=1e-6)


def test_long_texts_lose_no_word(monkeypatch):
    monkeypatch.setattr(quality, "PART_BYTES", 500)
    text = LONG[:20_000].encode()
    parts = [p for _, p in quality._parts([text])]
    assert b"".join(parts) == text and max(map(len, parts)) < 600
    assert sum(len(p.split()) for p in parts) == len(text.split())


def _toy(rng, n=120):
    """Bags of normal passages; a bad bag has one passage of another kind."""
    bags, labels = [], []
    for i in range(n):
        x = rng.normal(0, 1, (int(rng.integers(1, 9)), quality.FEATURES)).astype(np.float32)
        if i % 2:
            x[rng.integers(len(x)), :10] += 4
        bags.append(x)
        labels.append(1.0 - i % 2)
    return bags, np.array(labels)


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    bags, labels = _toy(rng, 6)
    model = quality.fit(bags, labels, np.ones(6))
    model.weights = {k: (rng.normal(0, 0.3, v.shape)).astype(np.float64) for k, v in model.weights.items()}
    model.mean, model.scale = model.mean.astype(float), model.scale.astype(float)
    weights = rng.random(6) + 0.5
    owner = np.repeat(np.arange(6), [len(b) for b in bags])

    def loss():
        h = model.encode(np.concatenate(bags).astype(float))
        p, _ = model.bags(owner, h, model.attention(h))
        return -(weights * (labels * np.log(p) + (1 - labels) * np.log(1 - p))).mean()

    found = quality._gradient(model, [b.astype(float) for b in bags], labels, weights)
    for name, w in model.weights.items():
        at = tuple(rng.integers(s) for s in w.shape)
        old = w[at].copy()
        ends = []
        for step in (1e-5, -1e-5):
            w[at] = old + step
            ends.append(loss())
        w[at] = old
        assert found[name][at] == pytest.approx((ends[0] - ends[1]) / 2e-5, rel=1e-3, abs=1e-6), name


def test_attention_finds_the_passage_that_decides():
    rng = np.random.default_rng(1)
    bags, labels = _toy(rng, 400)
    model = quality.fit(bags, labels, np.ones(400))
    more, truth = _toy(np.random.default_rng(2), 200)
    owner = np.repeat(np.arange(200), [len(b) for b in more])
    h = model.encode(np.concatenate(more))
    score, share = model.bags(owner, h, model.attention(h))
    assert ((score > 0.5) == (truth == 1)).mean() > 0.9
    planted = [int(b[:, :10].sum(axis=1).argmax()) for b in more]
    top = [int(share[owner == i].argmax()) for i in range(200)]
    bad = [i for i in range(200) if truth[i] == 0 and len(more[i]) > 1]
    assert np.mean([top[i] == planted[i] for i in bad]) > 0.8
    assert np.allclose(np.bincount(owner, share), 1)


def test_held_out_accuracy(spark):
    got = {r["doc_id"]: r for r in quality.op12_quality(spark, FOLDER).collect()}
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").collect()
    held = [(got[r["doc_id"]], r["quality"]) for r in labels if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert len(got) == 1000 and len(held) > 80
    assert all(r["held_out"] for r, _ in held) and all(r["predicted"] == (r["score"] >= 0.7) for r in got.values())
    assert np.mean([r["predicted"] == q for r, q in held]) >= 0.97


def test_held_out_labels_are_never_read(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    path = f"{spark.conf.get('spark.checkpoint.dir')}/turned"
    docs.write.parquet(f"{path}/documents.parquet")
    turned.write.parquet(f"{path}/labels.parquet")
    scores = [{r["doc_id"]: r["score"] for r in quality.op12_quality(spark, f).collect()} for f in (FOLDER, path)]
    assert max(abs(scores[0][i] - scores[1][i]) for i in scores[0]) < 1e-6


def test_awkward_documents(spark):
    labels = spark.createDataFrame(
        [(0, 1, 0), (0, 1, 0), (1, 1, 0), (2, 1, 1), (4, 0, 0), (5, 0, 0), (6, 0, 1), (6, 1, 1), (7, None, 0), (None, 1, 0), (9, 5, 0), (99, 0, 0)],
        "doc_id bigint, quality int, toxic int",
    )
    docs = documents(spark)
    model = quality.learn(docs, labels)
    got = quality.with_quality(docs, model, name="quality_").collect()
    assert len(got) == docs.count()
    assert all(0 <= r["quality_"]["score"] <= 1 and r["quality_"]["passages"] >= 1 for r in got)
    same = {}
    for r in got:
        assert same.setdefault(r["text"] or "", r["quality_"]["score"]) == pytest.approx(r["quality_"]["score"])
    assert quality.learn(docs, labels.filter("quality = 1")) == 1.0
    assert quality.learn(docs, labels.filter("doc_id = 99")) == 0.0
    assert quality.learn(empty(spark), labels.limit(0)) == quality.learn(empty(spark), labels) == 0.5
    assert quality.with_quality(empty(spark), 0.5).collect() == []
    assert [r["found"]["score"] for r in quality.with_quality(docs, 0.5).collect()] == [0.5] * docs.count()
