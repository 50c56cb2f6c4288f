"""The stages of the pipeline one by one, and all of them on the smallest tables."""

import os
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(__file__))

from awkward import documents, empty  # noqa: E402
from test_operators import plain_components, plain_simhash  # noqa: E402

import corpus_pipeline  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


def test_stages_on_the_smallest_tables(spark, folder):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        kept[name] = docs.collect()
        assert docs.columns == columns or name == "shards"
    assert len(kept["language"]) == 200
    rows = sorted(kept["language"], key=lambda r: r["doc_id"])
    first = plain_components([plain_simhash(r["text"]) for r in rows])
    assert {r["doc_id"] for r in kept["near_duplicates"]} == {rows[i]["doc_id"] for i in first}
    assert len(kept["near_duplicates"]) == len(set(first))
    items = [r["text"] for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    clean = {r["doc_id"] for r in kept["near_duplicates"] if not any(x in r["text"] for x in items)}
    assert {r["doc_id"] for r in kept["decontaminate"]} == clean
    copies = Counter(r["doc_id"] for r in kept["mix"])
    assert set(copies) <= clean and max(copies.values()) <= 2
    assert Counter(r["doc_id"] for r in kept["shards"]) == copies
    texts = {r["doc_id"]: r["text"] for r in kept["mix"]}
    together = {}
    for r in kept["shards"]:
        assert together.setdefault(texts[r["doc_id"]], r["shard"]) == r["shard"]
    assert len({(r["shard"], r["slot"]) for r in kept["shards"]}) == len(kept["shards"])


def test_stages_on_awkward_documents(spark):
    for df in (documents(spark, extra=False), empty(spark)):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, df, FOLDER).collect()
