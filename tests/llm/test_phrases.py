"""Collocations against counting by definition."""

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(__file__))

import numpy as np  # noqa: E402
import pytest  # noqa: E402
from awkward import ROWS, documents, empty  # noqa: E402

from gaugeline.llm import phrases  # noqa: E402
from gaugeline.llm.common import LOWER, UPPER  # noqa: E402


def plain_collocations(rows, at_least, covered=80, top=2000):
    counts, totals = Counter(), Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(str.maketrans(UPPER, LOWER))):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, 5):
                counts.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    candidates = {(lang, p): a for (lang, p), a in counts.items() if len(p) > 1 and a >= at_least}
    found = []
    for (lang, p), a in candidates.items():
        cuts = [(2_000_000 * a // (counts[lang, p[:c]] + counts[lang, p[c:]]), c) for c in range(1, len(p))]
        score, c = min(cuts)
        inside = False
        for (other, q), b in candidates.items():
            runs = [q[i : i + len(p)] for i in range(len(q) - len(p) + 1)] if other == lang and len(q) > len(p) else []
            inside |= p in runs and 100 * b >= covered * a
        if not inside:
            found.append((lang, -score, -a, " ".join(p).encode(), counts[lang, p[:c]], counts[lang, p[c:]], totals[lang]))
    ranked, seen = [], Counter()
    for lang, score, a, phrase, left, right, n in sorted(found):
        seen[lang] += 1
        if seen[lang] <= top:
            ranked.append((lang, seen[lang], phrase.decode(), -a, left, right, n, -score))
    return ranked


MORE = [
    (20, "New York, new york. New York City! new york city; the city of New\tYork", "en", "a"),
    (21, "a a a a a a a a a a", "en", "a"),
    (22, "é è ö. É è ö: é  è ö\r\né è ö", "fr", "a"),
    (23, "é è ö é è ö", None, "a"),
    (24, "é è ö é è ö", "und", "a"),
]


@pytest.mark.parametrize("options", [{}, {"range_bytes": 4000, "task_entries": 50}])
def test_collocations_equal_definition(spark, options, monkeypatch):
    if options:
        monkeypatch.setattr(phrases, "PART_BYTES", 97)
        monkeypatch.setattr(phrases, "CONTAINER_ENTRIES", 8)
    rows = [r for r in ROWS if r[0] not in (7, 8)] + MORE
    for at_least in (1, 2, 3):
        got = phrases.collocations(documents(spark, rows), at_least=at_least, **options).drop("cut").collect()
        assert sorted(map(tuple, got)) == plain_collocations(rows, at_least)


def test_long_texts_equal_definition(spark, monkeypatch):
    rng = np.random.default_rng(3)
    words = np.array(["one", "two", "three", "four", "Five", "x" * 3000, "six.", "seven"])
    rows = [(i, " ".join(rng.choice(words, 3000)), "en", "a") for i in range(3)]
    monkeypatch.setattr(phrases, "PART_BYTES", 1000)
    got = phrases.collocations(documents(spark, rows), at_least=30).drop("cut").collect()
    assert sorted(map(tuple, got)) == plain_collocations(rows, 30)


def test_the_limit_is_per_language(spark):
    got = phrases.collocations(documents(spark, ROWS[:7] + MORE), at_least=1, top=4).drop("cut").collect()
    assert sorted(map(tuple, got)) == plain_collocations(ROWS[:7] + MORE, 1, top=4)


def test_empty(spark):
    assert phrases.collocations(empty(spark)).collect() == []
    assert phrases.collocations(documents(spark, [(1, None, None, None)])).collect() == []


def test_trie_counts_and_spills_in_order():
    rng = np.random.default_rng(0)
    trie, plain, runs = phrases.HatTrie(), Counter(), Counter()
    seed = phrases.language_seed("en")
    for _ in range(40):
        # One hot prefix, so that its subtree bursts down to the digits of the last word.
        words = np.stack([np.where(rng.random(3000) < 0.7, 7, rng.integers(0, 50, 3000)), rng.integers(0, 1 << 62, 3000) % 30_011], 1)
        words = words.astype(np.uint64)
        plain.update(map(tuple, words.tolist()))
        trie.add(*phrases.summed(phrases.identities(words, seed), words, np.ones(len(words), np.int64)))
        for ids, words, counts in trie.spill(20_000):
            assert (np.diff(ids.astype(object)) >= 0).all()
            runs.update(dict(zip(map(tuple, words.tolist()), counts.tolist())))
        assert trie.sizes.sum() <= 20_000
    for _, words, counts in trie.spill():
        runs.update(dict(zip(map(tuple, words.tolist()), counts.tolist())))
    assert runs == plain and trie.sizes.sum() == 0


def test_a_filter_hides_no_frequent_run(spark):
    found = phrases.frequent_runs(documents(spark, MORE), at_least=2)
    known = phrases.Filter(phrases._filter_of(found[0].filter("run is not null")))
    runs = np.array([r["run"] for r in found[0].filter("run is not null").collect()], np.int64).view(np.uint64)
    assert len(runs) and known.known(runs).all()
    assert not known.known(np.arange(1, 1000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).all()
