"""Copies of heavily leaked items: every copy that reaches half of the item's score is found."""

import os
import sys

import numpy as np

sys.path.insert(0, os.path.dirname(__file__))

from test_operators import plain_alignment  # noqa: E402

from gaugeline.llm import decontamination  # noqa: E402


def test_edits_of_items_leaked_hundreds_of_times(spark):
    rng = np.random.default_rng(11)
    items = [[f"i{k}w{i}" for i in range(n)] for k, n in enumerate((3, 4, 9, 15, 18, 20, 30, 45))]
    rows = [(len(items) * j + k, " ".join(w)) for j in range(300) for k, w in enumerate(items)]
    for k, own in enumerate(items):
        for every in (3, 4):
            for begin in range(every):
                w = list(own)
                w[begin::every] = [f"edit{x}" for x in rng.integers(0, 1 << 30, len(w[begin::every]))]
                rows.append((len(rows), " ".join(["before", *w, "after"])))
        rows.append((len(rows), " ".join(x for w in own for x in (w, "inserted"))))
        rows.append((len(rows), " ".join(own[: len(own) // 2])))
        rows.append((len(rows), " ".join(own[: -(-len(own) // 2)])))
        for _ in range(10):
            rows.append((len(rows), " ".join(w for w in own if rng.random() < 0.6)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    listed = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in decontamination.find_copies(docs, listed).collect()}
    want = {}
    for doc_id, text in rows[300 * len(items) :]:
        for k, own in enumerate(items):
            if set(own) & set(text.split()) and (score := plain_alignment(own, text.split())) >= len(own):
                want[doc_id, k] = score
    assert {k: v for k, v in got.items() if k[0] >= 300 * len(items)} == want
    assert len(got) - len(want) == 300 * len(items)
