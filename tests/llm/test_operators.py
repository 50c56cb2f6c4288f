"""Each operator against a plain version, and on awkward documents."""

import hashlib
import heapq
import math
import os
import re
import sys
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))

from awkward import LONG, PASSAGE, ROWS, by_id, documents, empty  # noqa: E402

from gaugeline.llm import (  # noqa: E402
    chunking, decontamination, language, language_model, mixing, sharding, simhash, suffixes, urls, warc,
)
from gaugeline.llm.eliasfano import Monotone, Trie  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


# ---- language ------------------------------------------------------------------------------------------------------


def test_language_of_held_out_documents(spark):
    rows = language.op1_language(spark, FOLDER).join(spark.read.parquet(f"{FOLDER}/documents.parquet"), "doc_id").collect()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1
    held = [r["lang"] == r["lang_pred"] for r in rows if r["held_out"]]
    assert len(rows) == 200 and sum(held) >= 0.95 * len(held)


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(1)
    scores, move, start = rng.normal(size=(4, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    weight = np.zeros((4, 3))
    for path in np.ndindex(3, 3, 3, 3):
        total = start[path[0]] + sum(scores[t, y] for t, y in enumerate(path)) + sum(move[a, b] for a, b in zip(path, path[1:]))
        for t, y in enumerate(path):
            weight[t, y] += math.exp(total)
    both = np.concatenate([scores, scores[:2]])
    posterior, _, _ = language.forward_backward(both, np.array([4, 2]), move, start)
    assert np.allclose(posterior[:4], weight / weight.sum(axis=1, keepdims=True))


def test_code_switched_words():
    spans = []
    for i in range(120):
        spans.append(("en", "the of and that with which there these".split()[i % 3 : i % 3 + 5]))
        spans.append(("de", "der die und nicht mit dieser eine werden".split()[i % 3 : i % 3 + 5]))
    spans = [spans[i] for i in np.random.default_rng(2).permutation(len(spans))]
    field = language.fit(spans, 30)
    found, posterior, _ = language.Labeller(field).posteriors(["the of and that der die und nicht"])
    assert [field.labels[i] for i in posterior[0].argmax(axis=1)] == ["en"] * 4 + ["de"] * 4


def test_language_of_awkward_documents(spark):
    df = documents(spark)
    rows = language.with_language(df, language.learn(df)).collect()
    assert len(rows) == len(ROWS) and set(df.columns) < set(rows[0].asDict())
    for r in rows:
        none = not any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == none and (r["score"] == 0) == none
    blank = language.with_language(df, language.learn(df.withColumn("lang", F.lit(None).cast("string"))))
    assert {r["lang_pred"] for r in blank.collect()} == {"und"}
    assert language.known_language(empty(spark)).count() == 0
    assert language.known_language(df).columns == df.columns


def test_long_runs_count_whole():
    first, second = "a" * 14 + "bcdefghijk" + "z" * 14, "a" * 14 + "kjihgfedcb" + "z" * 14
    pieces = language.words_of(f"one {first} two")
    assert pieces == ["one", first[:24], first[24:], "two"]
    sets = [{f for w in language.words_of(x) for f in language.features(w, {})} for x in (first, second)]
    assert len(sets[0] ^ sets[1]) > 20


def test_features_of_many_words_equal_those_of_each():
    rng = np.random.default_rng(3)
    letters = list("abcxyz^$\x7f\x80éßñя\u07ff\u0800中한ไ\uffff\U00010000\U0001f600\U0010ffff")
    found = ["".join(rng.choice(letters, n)) for n in rng.integers(1, 25, 400)] + ["a", "é", "中", "\U0001f600", "abcd", "abcde"]
    lexicon = {w: tuple(range(i % 4)) for i, w in enumerate(found[::2])}
    for part in (found, ["abc"], ["\U0001f600"]):
        flat, sizes = language.features_of(part, lexicon)
        plain = [language.features(w, lexicon) for w in part]
        assert sizes.tolist() == [len(x) for x in plain] and flat.tolist() == [f for x in plain for f in x]
    assert [x.tolist() for x in language.features_of([], lexicon)] == [[], []]


def test_words_are_scored_together_not_one_by_one(monkeypatch):
    spans = [("en", "the of and that with".split()), ("de", "der die und nicht größe".split())] * 40
    field = language.fit(spans, 20)
    texts = ["the größe of \U00010400 x² and 中文 that", None, "", "der " * 600 + "и die", "the of"]
    plain = [language.features(w, field.lexicon) for t in texts for w in language.words_of(t)]
    scores = np.array([field.weights[f].sum(axis=0, dtype=np.float64) for f in plain])
    monkeypatch.setattr(language, "features", lambda *_: pytest.fail("a call for each word"))
    labeller = language.Labeller(field)
    ids = labeller.word_ids([w for t in texts for w in language.words_of(t)])
    assert np.allclose(labeller.scores[ids], scores, atol=1e-4)
    found, posterior, _ = labeller.posteriors(texts)
    assert [len(p) for p in posterior] == [len(x) for x in found] == [8, 0, 0, 602, 2]
    alone = [language.Labeller(field).posteriors([t])[1][0] for t in texts]
    assert all(np.allclose(a, b) for a, b in zip(posterior, alone, strict=True))


def test_posteriors_without_pairs_are_the_same():
    rng = np.random.default_rng(4)
    lengths = np.array([3, 7, 1, 7, 2])
    given = rng.normal(size=(20, 3)), lengths, rng.normal(size=(3, 3)), rng.normal(size=3)
    whole, pairs, _ = language.forward_backward(*given)
    plain, none, _ = language.forward_backward(*given, pairs=False)
    assert np.array_equal(whole, plain) and math.isclose(pairs.sum(), (lengths - 1).sum()) and not none.any()


def test_letters_without_order_go_and_switched_text_stays(spark):
    rng = np.random.default_rng(0)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang", "source")
    starts = {r["lang"]: " ".join(r["text"].split()[:15]) for r in docs.filter("length(text) > 400").collect()}
    switched = " ".join(starts.values())
    junk = " ".join("".join(rng.choice(list("bcdfghjklmnpqrstvwxz"), 5)) for _ in range(80))
    more = [(10_000_000, "zzqx qxzz vvkk jjq xqz", None, "x"), (10_000_001, junk, None, "x"), (10_000_002, switched, None, "x")]
    kept = {r["doc_id"] for r in language.known_language(docs.unionByName(spark.createDataFrame(more, docs.schema))).collect()}
    assert kept == {r["doc_id"] for r in docs.collect()} | {10_000_002}


# ---- simhash -------------------------------------------------------------------------------------------------------


def plain_simhash(text):
    w = words(lower(text))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values):
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in range(i + 1, len(values)):
            if (values[i] ^ values[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def test_simhash_equals_brute_force(spark, docs):
    got = by_id(simhash.op2_simhash(spark, FOLDER).collect())
    rows = sorted(docs.collect(), key=lambda r: r["doc_id"])
    values = [plain_simhash(r["text"]) for r in rows]
    for r, value, first in zip(rows, values, plain_components(values)):
        assert got[r["doc_id"]]["fingerprint"] == f"{value:016x}"
        assert got[r["doc_id"]]["component_id"] == rows[first]["doc_id"]


def test_near_fingerprints_are_linked(spark):
    rng = np.random.default_rng(3)
    values = []
    for _ in range(60):
        base = int(rng.integers(0, 1 << 63)) * 2 + int(rng.integers(0, 2))
        values.append(base)
        for flips in (1, 2, 3, 4, 3):
            changed = base
            for bit in rng.choice(64, flips, replace=False):
                changed ^= 1 << int(bit)
            values.append(changed)
    values = sorted(set(values))
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    got = simhash.linked_fingerprints(spark.createDataFrame([(v,) for v in signed], "fp bigint"))
    pairs = {tuple(sorted((r["a"] & (1 << 64) - 1, r["b"] & (1 << 64) - 1))) for r in got.collect()}
    assert pairs == {(a, b) for i, a in enumerate(values) for b in values[i + 1 :] if (a ^ b).bit_count() <= 3}


def test_simhash_of_awkward_documents(spark):
    df = documents(spark)
    kept = simhash.keep_one(df)
    rows = kept.collect()
    assert kept.columns == df.columns
    counts = Counter(plain_simhash(r["text"]) for r in rows)
    assert max(counts.values()) == 1
    assert {0, 2, 3} <= {r["doc_id"] for r in rows} and not {1, 4, 5} & {r["doc_id"] for r in rows}
    assert simhash.keep_one(empty(spark)).count() == 0


# ---- urls ----------------------------------------------------------------------------------------------------------


def plain_verdict(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = lower(host)
    fits = [(len(h + p), h.count("."), h + p, v) for v, h, p in rules if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


@pytest.mark.parametrize("rows_per_slice", [200_000, 3])
def test_urls_equal_plain_rules(spark, rows_per_slice):
    rules = [*urls.RULES, ("block", "b.a.com", "/x"), ("allow", "b.a.com", "/x/y"), ("block", "a.com", ""), ("allow", "com", "/\U0010ffff"), ("block", "b.a.com", "/x/yz")]
    given = [None, "", "no url", "://", "http://", "x://COM/fr/", "x://com/fr/1?q", "x://com/fr/1?q", "x://acom/fr/", "http://a.com:80/x"]
    given += [f"http://{h}{p}" for h in ("a.com", "b.a.com", "c.b.a.com", "org", "example.org.", "..", "example.org") for p in ("", "/", "/x", "/x/y", "/x/yz", "/x/z#f", "/es/", "/en/1", "/en/12?/de/", "/de/\U0010ffff", "/\U0010ffffa")]
    pages = spark.createDataFrame(list(enumerate(given)), "page_id bigint, url string").withColumns({"suffix": F.lit(1), "rule": F.lit(2)})
    got = urls.filter_urls(pages, urls.rule_table(spark, rules), rows_per_slice=rows_per_slice).collect()
    assert len(got) == len(given)
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == plain_verdict(r["url"], rules), r["url"]


def test_urls_of_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id bigint, url string")
    none = spark.createDataFrame([], "verdict string, host string, path string")
    assert [r["verdict"] for r in urls.filter_urls(pages, none, default="block").collect()] == ["block"]
    assert urls.filter_urls(pages.limit(0), urls.rule_table(spark)).count() == 0


# ---- decontamination -----------------------------------------------------------------------------------------------


def plain_alignment(a, b):
    best, above = 0, [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            row.append(max(0, above[j] + (2 if x == y else -1), above[j + 1] - 1, row[j] - 1))
        best, above = max(best, *row), row
    return best


def test_alignment_equals_plain_table():
    rng = np.random.default_rng(5)
    for _ in range(50):
        a, b = rng.integers(0, 4, 9), rng.integers(0, 4, 14)
        assert decontamination.align(a, b)[0] == plain_alignment(a.tolist(), b.tolist())


def test_copies_equal_brute_force(spark, docs):
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    plain = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    found = {(r["doc_id"], r["item_id"]): r for r in decontamination.find_copies(docs, items).collect()}
    want = {}
    for item in items.collect():
        own = plain(item["text"])
        for doc in docs.collect():
            w = plain(doc["text"])
            if len(set(own) & set(w)) * 4 < len(set(own)):
                continue
            score = plain_alignment(own, w)
            if score >= len(own):
                want[doc["doc_id"], item["item_id"]] = score
    assert want and {k: r["score"] for k, r in found.items()} == want


def test_edited_copies_and_clean_documents(spark, docs):
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    texts = [r["text"] for r in items.orderBy("item_id").collect()]
    rows = []
    for i, text in enumerate(texts):
        w = text.split()
        w[3::9] = ["changed"] * len(w[3::9])
        del w[7]
        rows.append((1000 + i, f"some words before {' '.join(w)} and after", "en", "a"))
    rows += [(5000, texts[0].upper(), "en", "a"), (5001, " ".join(texts[1].split()[:4]), "en", "a"), *ROWS]
    df = documents(spark, rows)
    hit = {(r["doc_id"], r["item_id"]) for r in decontamination.find_copies(df, items).collect()}
    assert {(1000 + i, i) for i in range(len(texts))} | {(5000, 0)} <= hit
    assert not {5001, *[r[0] for r in ROWS]} & {d for d, _ in hit}
    kept = decontamination.without_copies(df, items)
    assert kept.columns == df.columns and kept.count() == len(ROWS) + 1
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "two words"), (None, "x" * 50 + " y z")], "item_id bigint, text string")
    assert decontamination.without_copies(df, odd).count() == len(rows)
    assert decontamination.find_copies(df, items.limit(0)).count() == 0
    assert decontamination.find_copies(empty(spark), items).count() == 0


# ---- chunk fingerprints --------------------------------------------------------------------------------------------


def plain_boundaries(data):
    ends, start, n = [], 0, len(data)
    h, hashes = 0, []
    for b in data:
        h = (h * 2 + int(chunking.GEAR[b])) % (1 << 32)
        hashes.append(h)
    while start < n:
        for end in range(start + 1, n + 1):
            size, h = end - start, hashes[end - 1]
            bits = chunking.RARE_BITS if size < chunking.NORMAL else chunking.FREQUENT_BITS
            if end == n or size == chunking.LARGEST or size >= chunking.SMALLEST and h >> (32 - bits) == 0:
                break
        ends.append(end)
        start = end
    return ends


def test_boundaries_equal_a_rolling_hash():
    rng = np.random.default_rng(6)
    for n in (0, 1, 31, 32, 33, 200, 5000):
        data = rng.integers(0, 256, n, dtype=np.uint8).tobytes()
        assert chunking.boundaries(data) == plain_boundaries(data)
    assert chunking.boundaries(b"a" * 3000) == plain_boundaries(b"a" * 3000)


def plain_likeness(a, b):
    """The share of the distinct chunks' bytes of `a` that `b` has, from the chunks themselves."""
    a, b = ({x[i:j] for i, j in zip([0, *ends], ends)} for x in (a, b) for ends in [chunking.boundaries(x)])
    return sum(map(len, a & b)) / sum(map(len, a)) if a else float(not b)


def check_edits(rows, got):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for i, (doc_id, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        cut = len(text) // 2
        changed = (text[: len(text) - cut] + after[:cut]).encode()
        want = (len(text), hashlib.sha256(changed).hexdigest(), chunking.as_text(chunking.chunk_set(text.encode())), chunking.as_text(chunking.chunk_set(changed)))
        r = got[doc_id]
        assert (r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"]) == want
        likeness = (plain_likeness(text.encode(), changed), plain_likeness(text.encode(), after.encode()))
        assert (r["near_edited"], r["near_next"]) == pytest.approx(likeness)


@pytest.mark.parametrize("block_documents", [5_000, 7])
def test_chunk_fingerprints_equal_plain_edits(docs, block_documents):
    got = by_id(chunking.fingerprint_documents(docs, block_documents).collect())
    check_edits([(r["doc_id"], r["text"]) for r in docs.collect()], got)


def test_chunk_fingerprints_of_awkward_documents(spark):
    rows = [r for i, r in enumerate(ROWS) if i != 2]
    got = chunking.fingerprint_documents(documents(spark, rows), 3).collect()
    assert len(got) == len(rows)
    check_edits([r[:2] for r in rows], by_id(got))
    assert by_id(got)[0]["near_next"] == 1
    repeated = chunking.fingerprint_documents(documents(spark), 2).collect()
    assert len(repeated) == len(ROWS)
    hot = chunking.with_next(documents(spark, [(i % 2 * 5, f"text {i} " * 9, "en", "a") for i in range(60)]).select("doc_id", "text"), 4)
    sizes = hot.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.count_if("is_next").alias("sent")).collect()
    assert sum(r["n"] - r["sent"] for r in sizes) == 60 and max(r["n"] for r in sizes) < 25
    assert [r["sent"] for r in sizes] == [1] * len(sizes)
    one = chunking.fingerprint_documents(documents(spark, ROWS[:1])).first()
    assert one["near_next"] == 1
    assert chunking.fingerprint_documents(empty(spark)).count() == 0


# ---- repeated bytes ------------------------------------------------------------------------------------------------


def plain_removal(rows):
    first, out = {}, {}
    for doc_id, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - 49 if doc_id is not None else 0):
            w = data[i : i + 50]
            first[w] = min(first.get(w, doc_id), doc_id)
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - 49 if doc_id is not None else 0):
            if first[data[i : i + 50]] < doc_id:
                gone[i : i + 50] = b"\1" * 50
        kept = bytes(x for x, g in zip(data, gone) if not g)
        out[doc_id] = (len(data), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    return out


def check_removal(rows, got):
    want = plain_removal(rows)
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want[r["doc_id"]], r["doc_id"]


@pytest.mark.parametrize("size, hot", [(12 << 20, 20_000), (40_000, 2)])
def test_removal_equals_brute_force(docs, size, hot):
    check_removal([(r["doc_id"], r["text"]) for r in docs.collect()], suffixes.remove_repeats(docs, size, size, hot).collect())


def test_removal_from_awkward_documents(spark, monkeypatch):
    rows = [r for i, r in enumerate(ROWS) if r[0] not in (7, 8)]
    rows += [(20, PASSAGE * 3, "en", "a"), (21, "q" + PASSAGE[3:] + PASSAGE[:60], "en", "a"), (22, PASSAGE[:49], "en", "a"), (23, PASSAGE[:50], "en", "a")]
    monkeypatch.setattr(suffixes, "PIECE_BYTES", 64)
    monkeypatch.setattr(suffixes, "BLOCK_BYTES", 100)
    for hot in (20_000, 1):
        got = suffixes.remove_repeats(documents(spark, rows), 300, 300, hot).collect()
        check_removal([r[:2] for r in rows], got)
    long = [r for r in ROWS if r[0] in (7, 8)]
    got = by_id(suffixes.remove_repeats(documents(spark, long)).collect())
    assert got[7]["n_removed"] == 0 and got[8]["n_removed"] == len(LONG)
    assert suffixes.remove_repeats(empty(spark)).count() == 0


def test_equal_windows_equal_grouping():
    rng = np.random.default_rng(8)
    base = rng.integers(97, 99, 400, dtype=np.uint8).tobytes()
    pieces, offsets = [], []
    for _ in range(40):
        at, n = int(rng.integers(0, 300)), int(rng.integers(50, 90))
        pieces.append(base[at : at + n])
        offsets.append(-at)  # an anchor at the same place of the base
    piece, place, classes = suffixes.equal_windows(pieces, np.array(offsets))
    found = {}
    for p, j, c in zip(piece.tolist(), place.tolist(), classes.tolist()):
        found.setdefault(c, set()).add((pieces[p][j : j + 50], (j - offsets[p]) % suffixes.PERIOD))
    assert all(len(x) == 1 for x in found.values())
    assert len(found) == len({next(iter(x)) for x in found.values()})


def windows_in_order(pieces, offsets):
    """The 50 bytes of all windows by their class, and whether windows share a class exactly if they are equal."""
    piece, place, classes = suffixes.equal_windows(pieces, np.array(offsets))
    seen = {}
    for p, j, c in zip(piece.tolist(), place.tolist(), classes.tolist()):
        seen.setdefault(c, set()).add(pieces[p][j : j + 50])
    once = all(len(x) == 1 for x in seen.values()) and len(seen) == len({next(iter(x)) for x in seen.values()})
    return [min(seen[c]) for c in sorted(seen)], once


def test_suffixes_of_all_residues_are_in_byte_order(monkeypatch):
    """Equal and nearly equal windows at any place from their anchors; without the cover's steps the order is wrong."""
    rng = np.random.default_rng(9)
    base = rng.integers(97, 99, 40, dtype=np.uint8).tobytes() * 6 + rng.integers(97, 99, 200, dtype=np.uint8).tobytes()
    at = rng.integers(0, len(base) - 120, 60).tolist()
    pieces = [base[i : i + 50 + int(n)] for i, n in zip(at, rng.integers(0, 60, 60))]
    offsets = rng.integers(0, 40, 60)
    order, once = windows_in_order(pieces, offsets)
    assert once and order == sorted(order)
    monkeypatch.setattr(suffixes, "_STEPS", np.zeros_like(suffixes._STEPS))
    order, once = windows_in_order(pieces, offsets)
    assert not once or order != sorted(order)


@pytest.mark.parametrize("cover", [(0,), (0, 1), (5,), (0, 1, 3)])
def test_a_set_that_covers_nothing_is_refused(cover):
    with pytest.raises(ValueError):
        suffixes.cover_steps(13, cover)


# ---- language model ------------------------------------------------------------------------------------------------


def test_monotone_sequence():
    rng = np.random.default_rng(9)
    for n, top in ((0, 1), (1, 5), (5000, 3000), (9000, 1 << 40), (4096, 1 << 63)):
        values = np.sort(rng.integers(0, top, n).astype(np.uint64))
        m = Monotone(values)
        for b in range(-(-n // 4096)):
            assert (m.block(b) == values[b * 4096 : (b + 1) * 4096]).all()
        wanted = np.sort(np.concatenate([values[::3], rng.integers(0, top, 50).astype(np.uint64)]))
        place, equal = m.successors(wanted)
        assert (place == np.searchsorted(values, wanted)).all() and (equal == np.isin(wanted, values)).all()


def test_trie_finds_all_pairs():
    rng = np.random.default_rng(10)
    pairs = sorted({(int(a), int(b)) for a, b in rng.integers(0, 1 << 62, (3000, 2)) // (1 << 55)})
    context, word = (np.array(c, np.uint64) for c in zip(*pairs))
    codes = rng.integers(1, 255, len(pairs)).astype(np.uint8)
    known = dict(zip(pairs, codes.tolist()))
    asked = rng.integers(0, 130, (5000, 2)).astype(np.uint64)
    got = Trie(context, word, codes).find(asked[:, 0].copy(), asked[:, 1].copy())
    assert got.tolist() == [known.get((int(a), int(b)), 0) for a, b in asked]


def check_scores(rows, got, prior=language_model.PRIOR):
    tokens = [(i, [w.encode() for w in words(lower(t))] + [None]) for i, t in rows]
    train = [(i, t) for i, t in tokens if zlib.crc32(("" if i is None else str(i)).encode()) % 5 != 1 or i is None]
    one = Counter(w for _, t in train for w in t)
    two = Counter(p for _, t in train for p in zip([b" "] + t[:-1], t))
    one_of = one | {b" ": len(train)}
    n, norm = sum(one.values()), sum(one.values()) + 0.5 * (len(one) + 1)
    assert len(got) == len(tokens)
    for i, t in tokens:
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(t), sum(one[w] > 0 for w in t), n)
        assert math.isclose(r["base_score"], sum(math.log10((one[w] + 0.5) / norm) for w in t), rel_tol=1e-9, abs_tol=1e-9)
        score = sum(math.log10((two[p] + prior * (one[p[1]] + 0.5) / norm) / (one_of.get(p[0], 0) + prior)) for p in zip([b" "] + t[:-1], t))
        assert abs(r["score"] - score) <= 0.02 * len(t) + 1e-6


@pytest.mark.parametrize("size", [12 << 20, 50_000])
def test_scores_equal_counting(docs, size):
    held = language_model.remainder("doc_id") == 1
    got = by_id(language_model.score_documents(docs, held, size, size).collect())
    check_scores([(r["doc_id"], r["text"]) for r in docs.collect()], got)
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 1) for i, r in got.items())


def test_scores_of_awkward_documents(spark):
    rows = [r for i, r in enumerate(ROWS) if i != 2]
    held = language_model.remainder("doc_id") == 1
    check_scores([r[:2] for r in rows], by_id(language_model.score_documents(documents(spark, rows), held, 30_000, 9_000).collect()))
    none = language_model.score_documents(documents(spark, rows[:3]), F.lit(True)).collect()
    assert len(none) == 3 and all(r["train_tokens"] == 0 and r["n_known"] == 0 for r in none)
    assert language_model.score_documents(empty(spark), held).count() == 0


# ---- mixing --------------------------------------------------------------------------------------------------------


def plain_targets(sizes, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, free, left = {}, set(names), 1.5 * sum(sizes.values())
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = 2 * sizes[s]
            left -= target[s]
        free -= over


def test_mix_reaches_targets(spark, docs):
    got = mixing.op8_source_mix(spark, FOLDER).collect()
    again = mixing.mix_sources(docs.repartition(7, "text"), block_rows=128).collect()
    assert sorted((r["doc_id"], r["copies"]) for r in got) == sorted((r["doc_id"], r["copies"]) for r in again)
    sizes, largest = Counter(), Counter()
    for r in docs.collect():
        n = len(words(r["text"]))
        sizes[r["source"]] += n
        largest[r["source"]] = max(largest[r["source"]], n)
    target = plain_targets(sizes)
    taken = Counter()
    for r in got:
        taken[r["source"]] += r["taken"]
        assert math.isclose(r["target"], target[r["source"]], rel_tol=1e-9) and r["source_size"] == sizes[r["source"]]
        assert r["taken"] in (0, r["size"], 2 * r["size"])
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in sizes)


def test_mix_in_many_levels(spark):
    rows = [(i, "w " * (1 + i * 7 % 50), "en", "abc"[i % 3] if i % 2 else "a") for i in range(900)]
    sizes = mixing.document_sizes(documents(spark, rows)).cache()
    got = mixing.mix_documents(sizes, mixing.source_targets(sizes), block_rows=4).collect()
    taken, target = Counter(), {}
    for r in got:
        taken[r["source"]] += r["copies"] * r["size"]
        target[r["source"]] = r["target"]
    assert len(got) == 900 and all(abs(taken[s] - target[s]) <= 50 for s in target)
    due = {s: target[s] / sum(r["size"] for r in got if r["source"] == s) for s in target}
    assert all(math.floor(due[r["source"]] - 1e-9) <= r["copies"] <= math.ceil(due[r["source"]]) for r in got)


def test_mix_of_awkward_documents(spark):
    df = documents(spark)
    got = mixing.mix_sources(df).collect()
    assert len(got) == len(ROWS) and {r["source"] for r in got} == {r[3] for r in ROWS}
    assert all(r["copies"] == 0 for r in got if r["size"] == 0)
    rows = mixing.copied_documents(df)
    assert rows.columns == df.columns
    words, most = Counter(), {}
    for r in rows.collect():
        words[r["source"]] += len((r["text"] or "").split())
    for r in got:
        most[r["source"]] = max(most.get(r["source"], 0), r["size"])
    assert all(abs(words[r["source"]] - r["target"]) <= most[r["source"]] for r in got)
    repeated = mixing.mix_sources(documents(spark, [(1, "a b", "en", "s")] * 500)).collect()
    assert len(repeated) == 500 and sum(r["copies"] for r in repeated) == 750
    assert mixing.mix_sources(empty(spark)).count() == 0


def test_rows_that_differ_elsewhere_get_copies_of_their_own(spark):
    df = documents(spark, [(i, "a b c", "en", "s") for i in range(4)]).withColumn("variant", F.explode(F.array(F.lit("x"), F.lit("y"))))
    df = df.withColumn("tags", F.create_map(F.lit("k"), F.col("variant")))
    rows = mixing.copied_documents(df).collect()
    copies = Counter((r["doc_id"], r["variant"], r["tags"]["k"]) for r in rows)
    assert set(copies) == {(i, v, v) for i in range(4) for v in "xy"} and set(copies.values()) <= {1, 2} and len(rows) == 12


# ---- warc ----------------------------------------------------------------------------------------------------------


def test_members_and_offsets(spark, folder):
    pages = [(1, "http://a/\r\nx", "same"), (2, None, "same"), (3, "u", None), (4, "u", ""), (None, "u", "same"), (5, "u", "é" * 90_000), (6, "u", "\r\n\r\nContent-Length: 3"), (6, "u", "twice"), (6, "u", "twice")]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string").withColumn("digest", F.lit(0))
    raw, members = f"file://{folder}/raw", f"file://{folder}/members"
    archives = warc.normalise_archives(warc.write_archives(df.coalesce(2), raw, archive_bytes=100_000), raw, members)
    rows = warc.read_archives(archives, members).collect()
    kinds = Counter((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in rows)
    want = [(1, 4, "revisit", 2), (2, 4, "response", None), (None, 4, "revisit", 2), (3, 0, "revisit", 4), (4, 0, "response", None)]
    want += [(5, 180_000, "response", None), (6, 21, "response", None), (6, 5, "response", None), (6, 5, "response", None)]
    assert kinds == Counter(want)
    for a in archives.collect():
        with open(f"{folder}/members/{a['archive']}", "rb") as f, open(f"{folder}/members/{a['archive']}.index") as index:
            data, lines = f.read(), [x.split("\t") for x in index]
        assert len(lines) == a["records"] and sum(int(x[2]) for x in lines) == len(data) == a["bytes"]
        for _, offset, length in lines:
            assert data[int(offset) : int(offset) + 2] == b"\x1f\x8b"
            assert zlib.decompress(data[int(offset) : int(offset) + int(length)], 31).startswith(b"WARC/1.1")
    small = warc.with_record_types(df, min_bytes=5).collect()
    assert all(r["response_id"] is None for r in small if r["html"] in ("same", "", None))
    nothing = warc.write_archives(df.limit(0), raw)
    assert warc.read_archives(warc.normalise_archives(nothing, raw, members), members).count() == 0


def test_inflate_handles_one_and_many_members(folder):
    import gzip
    import io

    data = os.urandom(300_000) + b"a" * 3_000_000
    many = gzip.compress(data[:1000]) + gzip.compress(b"") + gzip.compress(data[1000:])
    for packed in (gzip.compress(data), many):
        pieces = list(warc.inflate(io.BytesIO(packed), 10_000))
        assert b"".join(pieces) == data and max(map(len, pieces)) <= 10_000


# ---- sharding ------------------------------------------------------------------------------------------------------


def test_schedule_is_longest_first():
    rng = np.random.default_rng(11)
    items = [(int(w), f"{i}") for i, w in enumerate(rng.integers(1, 1000, 200))]
    loads = [0] * 5
    for w, name in sorted(items, key=lambda x: (-x[0], x[1])):
        heap = [(load, s) for s, load in enumerate(loads)]
        heapq.heapify(heap)
        loads[heap[0][1]] += w
    got = Counter()
    for name, shard in sharding.schedule(items, 5):
        got[shard] += dict((n, w) for w, n in items)[name]
    assert [got[s] for s in range(5)] == loads


def check_shards(texts, rows):
    assert len(rows) == len(texts)
    together = {}
    for r in rows:
        data = (texts[r["doc_id"]] or "").encode()
        assert r["size"] == len(data) + 1 and r["text_crc32"] == zlib.crc32(data)
        assert together.setdefault(data, r["shard"]) == r["shard"]
    for s in {r["shard"] for r in rows}:
        slots = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert slots == list(range(len(slots)))


def test_shards_of_documents(spark, docs):
    rows = sharding.op10_shards(spark, FOLDER).collect()
    check_shards({r["doc_id"]: r["text"] for r in docs.collect()}, rows)
    load = Counter()
    for r in rows:
        load[r["shard"]] += r["size"]
    assert len(load) == 8 and max(load.values()) - min(load.values()) <= max(r["size"] for r in rows)


def test_packs_and_slots(spark):
    groups = spark.createDataFrame([(f"g{i}", 1 + i * 37 % 101) for i in range(3000)] + [("big", 40_000)], "item string, weight bigint")
    rows = sharding.assign_groups(groups, 4, pack_groups=100, pack_bins=5, last_items=60).join(groups, "item").collect()
    load = Counter()
    for r in rows:
        load[r["shard"]] += r["weight"]
    assert len(rows) == 3001 and max(load.values()) < 1.02 * sum(load.values()) / 4


def test_shards_of_awkward_documents(spark):
    rows = [r for i, r in enumerate(ROWS) if i != 2]
    check_shards({r[0]: r[1] for r in rows}, sharding.shard_documents(documents(spark, rows)).collect())
    slots = sharding.with_slots(sharding.shard_documents(documents(spark)).drop("slot"), rows_per_part=1).collect()
    assert len({(r["shard"], r["slot"]) for r in slots}) == len(ROWS)
    assert sharding.shard_documents(empty(spark)).count() == 0
