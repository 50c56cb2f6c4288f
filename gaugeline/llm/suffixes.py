"""Removal of repeated byte strings with blockwise suffix sorting.

Every byte that a string of `LENGTH` bytes covers goes if the string also starts in a document with a smaller
doc_id. Sorting the suffixes of a whole corpus is not needed for that: only strings that two documents share have to
meet.

- Each window of `LENGTH` bytes is owned by its anchor, the least-hashed string of `GRAM` bytes in it (the first of
  equals). Equal windows have equal anchors at equal places, so an anchor is a bucket of suffixes that can be sorted
  by itself. Neighbouring windows of one anchor form a run; a text has about one for every sixteen bytes.
- Documents are dealt into groups. Groups list their distinct anchors, shards of the anchor space say which of them
  two documents hold.
- For those anchors alone, groups send the bytes of the runs. A run whose bytes occur in a smaller document of the
  group is covered as a whole and stays; so a passage that many documents share is sent once a group. Anchors with
  more than `HOT_RUNS` runs are cut into single windows, which go to the shard of their own hash.
- A shard merges runs with equal bytes, then sorts the suffixes of the anchors that still have several different
  runs, a block of buckets at a time. Suffixes are sorted by their first `PERIOD` bytes; longer ties are resolved by
  ranks of a difference cover sample over four periods, computed before: for any two residues there is a step of
  less than a period that takes both suffixes into the sample, where their ranks compare them. Neighbours in the
  sorted order are compared byte by byte, and equal ones get the smallest doc_id that has them.

Defined cases: a null text is empty. Texts under `LENGTH` bytes lose nothing. A null doc_id has no place in the
order: its text removes nothing and keeps everything. Rows with one doc_id do not remove from each other. A string
that occurs twice in the smallest document stays there both times. An empty table gives an empty result.
"""

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from gaugeline.llm.common import table
from gaugeline.llm.tokens import from_planes, joined_planes, mixed, planes, prefix_sums, span_hashes

LENGTH, GRAM = 50, 20
STEPS = LENGTH - GRAM  # steps from the first to the last place of an anchor in a window
GROUP_BYTES = SHARD_BYTES = 4 << 20
PIECE_BYTES, PLACE_BITS = 256 << 10, 24
HOT_RUNS = 4_000
BLOCK_BYTES = 256 << 10
#: A difference cover: every difference modulo the period is one of two of its members.
PERIOD, COVER = 13, (0, 1, 3, 9)


def cover_steps(period: int, cover: tuple[int, ...]) -> np.ndarray:
    """For two residues the least step that takes both into the cover; an error if the set is no difference cover."""
    steps = np.empty((period, period), np.int64)
    for r, s in np.ndindex(period, period):
        both = [d for d in range(period) if (r + d) % period in cover and (s + d) % period in cover]
        if not both:
            raise ValueError(f"{cover} does not cover the difference {abs(r - s)} modulo {period}")
        steps[r, s] = both[0]
    return steps


_STEPS = cover_steps(PERIOD, COVER)
ANCHORS = "shard int, group int, anchors binary, runs binary"
FLAGS = "group int, shard int, flags binary"
RUNS = "shard int, group int, ids binary, rows binary, starts binary, counts binary, offsets binary, data binary, covered boolean"
MARKS = "group int, rows binary, starts binary, counts binary"
RESULT = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in ("n_bytes", "n_removed", "n_spans")], ("kept_sha256", pa.string())])


@dataclass
class Runs:
    """Windows in a row with one anchor: text, first window, windows, place of the anchor from the first window, anchor."""

    row: np.ndarray
    start: np.ndarray
    count: np.ndarray
    offset: np.ndarray
    anchor: np.ndarray


def _pieces(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, texts, begins, places in the text) of joined texts; long texts are cut so that pieces share LENGTH - 1 bytes."""
    parts, size = [], 0
    for row, text in enumerate(texts):
        for at in range(0, max(1, len(text) - LENGTH + 1), PIECE_BYTES):
            part = text[at : at + PIECE_BYTES + LENGTH - 1]
            if len(part) < LENGTH:
                continue
            if parts and size + len(part) > PIECE_BYTES:
                yield _joined(parts)
                parts, size = [], 0
            parts.append((part, row, at))
            size += len(part)
    if parts:
        yield _joined(parts)


def _joined(parts: list[tuple[bytes, int, int]]):
    sizes = np.array([len(p) for p, _, _ in parts])
    data = np.frombuffer(b"".join(p for p, _, _ in parts), np.uint8)
    return data, np.array([r for _, r, _ in parts]), np.append(0, np.cumsum(sizes)), np.array([a for _, _, a in parts])


def runs_of(texts: list[bytes]) -> Runs:
    found = []
    for data, rows, begins, places in _pieces(texts):
        sums = prefix_sums(data)
        at = np.arange(len(data) - GRAM + 1)
        hashes = span_hashes(sums, at, at + GRAM)
        least = hashes & ~np.uint64((1 << PLACE_BITS) - 1) | at.astype(np.uint64)
        for step in (1, 2, 4, 8):
            least = np.minimum(least[:-step], least[step:])
        least = np.minimum(least[: len(data) - LENGTH + 1], least[STEPS - 15 :][: len(data) - LENGTH + 1])
        valid = np.ones(len(least), bool)
        for end in begins[1:-1].tolist():
            valid[max(0, end - LENGTH + 1) : end] = False
        window = np.flatnonzero(valid)
        anchor = (least[window] & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
        first = np.flatnonzero((np.diff(anchor, prepend=-1) != 0) | (np.diff(window, prepend=-2) != 1))
        start, place = window[first], anchor[first]
        part = np.searchsorted(begins, start, side="right") - 1
        count = np.diff(first, append=len(window))
        # The least hashes are small numbers; mixed again, they spread evenly over the shards.
        anchors = mixed(hashes[place])
        found.append((rows[part], start - begins[part] + places[part], count, place - start, anchors))
    if not found:
        none = np.zeros(0, np.int64)
        return Runs(none, none, none, none, none.astype(np.uint64))
    return Runs(*[np.concatenate(c) for c in zip(*found, strict=True)])


def _shard(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int32)


class Group:
    """The texts of a group in an order that does not depend on how they arrived."""

    def __init__(self, rows: pa.Table):
        ids = rows.column("doc_id").to_pylist()
        texts = [t or b"" for t in rows.column("text").cast(pa.large_binary()).to_pylist()]
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, texts[i]))
        self.ids, self.texts = [ids[i] for i in order], [texts[i] for i in order]

    def runs(self) -> tuple[Runs, np.ndarray, np.ndarray]:
        """Runs of the texts with an id, their distinct anchors, and the anchor of each run among these."""
        runs = runs_of([t if i is not None else b"" for i, t in zip(self.ids, self.texts, strict=True)])
        anchors, place = np.unique(runs.anchor, return_inverse=True)
        return runs, anchors, place

    def id_array(self) -> np.ndarray:
        return np.array([0 if i is None else i for i in self.ids], np.int64)


def _table(rows: list[tuple], ddl: str) -> pa.Table:
    types = {"int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}
    fields = [f.split() for f in ddl.split(", ")]
    columns = zip(*rows, strict=True) if rows else [[]] * len(fields)
    return pa.table([pa.array(c, types[t]) for c, (_, t) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def _lister(shards: int):
    def anchors(rows: pa.Table) -> pa.Table:
        """Distinct anchors with their runs; the highest bit tells that two documents of the group hold the anchor."""
        number, group = rows.column("group")[0].as_py(), Group(rows)
        runs, found, place = group.runs()
        ids = group.id_array()[runs.row]
        low, high = np.full(len(found), np.iinfo(np.int64).max), np.full(len(found), np.iinfo(np.int64).min)
        np.minimum.at(low, place, ids)
        np.maximum.at(high, place, ids)
        count = np.bincount(place, minlength=len(found)).astype(np.uint32) | ((low < high).astype(np.uint32) << np.uint32(31))
        held, at = np.unique(_shard(found, shards), return_index=True)
        lists = zip(held.tolist(), np.split(found, at[1:]), np.split(count, at[1:]), strict=True) if len(held) else ()
        return _table([(s, number, planes(a, np.uint64), planes(c, np.uint32)) for s, a, c in lists], ANCHORS)

    return anchors


def _flag_anchors(hot_runs: int):
    def flag(rows: pa.Table) -> pa.Table:
        """For every list: 0 for anchors of one document, 1 for shared ones, 2 for shared ones with many runs."""
        lists = rows.to_pylist()
        keys = joined_planes([r["anchors"] for r in lists], np.uint64)
        runs = joined_planes([r["runs"] for r in lists], np.uint32)
        unique, place = np.unique(keys, return_inverse=True)
        shared = np.bincount(place, minlength=len(unique)) > 1
        shared |= np.bincount(place, runs >> np.uint32(31), len(unique)) > 0
        many = np.bincount(place, runs & np.uint32(0x7FFFFFFF), len(unique)) > hot_runs
        flags = (shared.astype(np.uint8) + (shared & many))[place]
        ends = np.cumsum([len(r["anchors"]) // 8 for r in lists])
        return _table([(r["group"], r["shard"], f.tobytes()) for r, f in zip(lists, np.split(flags, ends[:-1]), strict=True)], FLAGS)

    return flag


def _sender(shards: int):
    def send(rows: pa.Table, flags: pa.Table) -> pa.Table:
        if not len(rows):
            return _table([], RUNS)
        number, group = rows.column("group")[0].as_py(), Group(rows)
        runs, _, place = group.runs()
        lists = sorted(flags.select(["shard", "flags"]).to_pylist(), key=lambda r: r["shard"])
        flag = np.frombuffer(b"".join(r["flags"] for r in lists), np.uint8)[place]
        entries = []  # digest, id, row, start, count, offset, anchor, bytes
        for i in np.flatnonzero(flag).tolist():
            row, start, count = int(runs.row[i]), int(runs.start[i]), int(runs.count[i])
            text, offset, doc = group.texts[row], int(runs.offset[i]), group.ids[row]
            if flag[i] == 1:
                data = text[start : start + count + LENGTH - 1]
                entries.append((xxhash.xxh64_intdigest(data, offset), doc, row, start, count, offset, int(runs.anchor[i]), data))
                continue
            for k in range(count):
                data = text[start + k : start + k + LENGTH]
                digest = xxhash.xxh64_intdigest(data)
                entries.append((digest, doc, row, start + k, 1, offset - k, digest, data))
        smallest: dict[int, int] = {}
        for digest, doc, *_ in entries:
            smallest[digest] = min(doc, smallest.get(digest, doc))
        covered = [e for e in entries if e[1] > smallest[e[0]]]
        sent = [e for e in entries if e[1] == smallest[e[0]]]
        out = [(number % shards, number, *_packed(covered)[:-1], b"", True)] if covered else []
        shard = _shard(np.array([e[6] for e in sent], np.uint64), shards)
        order = np.argsort(shard, kind="stable")
        held, at = np.unique(shard[order], return_index=True)
        for s, part in zip(held.tolist(), np.split(order, at[1:])):
            out.append((s, number, *_packed([sent[i] for i in part.tolist()]), False))
        return _table(out, RUNS)

    return send


def _packed(entries: list[tuple]) -> tuple[bytes, ...]:
    _, ids, *numbers, _, data = zip(*entries, strict=True)
    return planes(ids, np.int64), *[planes(c, np.uint32) for c in numbers], b"".join(data)


def _words(text: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The PERIOD bytes at each place as two big-endian numbers. `text` ends in enough zeros."""
    first, second = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)
    for i in range(8):
        first = first << np.uint64(8) | text[at + i]
    for i in range(8, PERIOD):
        second = second << np.uint64(8) | text[at + i]
    return first, second


def _ranks(keys: list[np.ndarray]) -> np.ndarray:
    """Ranks from 1 of rows of keys, the first key being the most significant; equal rows have equal ranks."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new) + 1
    return rank


def _in_order(first: np.ndarray, second: np.ndarray, residue: np.ndarray, window: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The order of the windows as suffixes, from their first PERIOD bytes and the ranks of the sample.

    Windows with equal first bytes and equal residues are sorted by one rank. A window's place among those of another
    residue is found by binary search over the ranks at the step that the two residues share.
    """
    own = rank[window + _STEPS[residue, residue]]
    order = np.lexsort((own, residue, second, first))
    new = np.ones(len(order), bool)
    new[1:] = (first[order][1:] != first[order][:-1]) | (second[order][1:] != second[order][:-1])
    tie, begin = np.cumsum(new) - 1, np.flatnonzero(new)
    kind = residue[order]
    turns = np.zeros(len(begin), np.int64)
    np.add.at(turns, tie[1:], (kind[1:] != kind[:-1]) & ~new[1:])
    mixed_ties = np.flatnonzero(turns[tie] > 0)  # positions in `order`, whole ties
    if not len(mixed_ties):
        return order
    tied, at = tie[mixed_ties], window[order[mixed_ties]]
    kind, room = kind[mixed_ties], int(rank.max()) + 1
    members = [np.flatnonzero(kind == r) for r in range(PERIOD)]
    place = np.zeros(len(mixed_ties), np.int64)
    for r, rows in enumerate(members):
        for s, others in enumerate(members):
            if not len(rows) or not len(others):
                continue
            if r == s:  # sorted already: the place in one's own run
                place[rows] += np.arange(len(rows)) - np.searchsorted(tied[rows], tied[rows])
                continue
            step = _STEPS[r, s]
            keys = np.sort(tied[others] * room + rank[at[others] + step])
            smaller = np.searchsorted(keys, tied[rows] * room + rank[at[rows] + step], "right" if s < r else "left")
            place[rows] += smaller - np.searchsorted(keys, tied[rows] * room)
    order[mixed_ties] = order[mixed_ties][np.lexsort((place, tied))]
    return order


def equal_windows(pieces: list[bytes], offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, place, class) of all windows of `pieces`; equal windows have equal classes.

    `offsets` are the places of the anchor in the pieces. Windows are sorted as suffixes; see the module.
    """
    sizes = np.array([len(p) for p in pieces])
    begins = np.cumsum(sizes) - sizes
    text = np.frombuffer(b"".join(pieces) + bytes(LENGTH + PERIOD), np.uint8)
    total = int(sizes.sum())
    piece = np.repeat(np.arange(len(pieces), dtype=np.int32), sizes)
    place = np.arange(total, dtype=np.int32) - begins.astype(np.int32)[piece]
    residue = ((place - offsets.astype(np.int32)[piece]) % PERIOD).astype(np.int8)
    left = sizes.astype(np.int32)[piece] - place  # bytes to the end of the piece

    def limited(at: np.ndarray) -> list[np.ndarray]:
        first, second = _words(text, at)
        room = np.minimum(left[at], PERIOD)
        for number, low, high in ((first, 0, 8), (second, 8, PERIOD)):
            cut = np.clip(high - np.maximum(room, low), 0, high - low).astype(np.uint64) * np.uint64(8)
            number[:] = np.where(cut >= 64, 0, number >> np.minimum(cut, 63) << np.minimum(cut, 63))
        return [first, second, room]

    sample = np.flatnonzero(np.isin(residue, COVER))
    rank = np.zeros(total + 1, np.int64)
    rank[sample] = _ranks(limited(sample))
    span = PERIOD
    while span < LENGTH:
        ahead = np.where(left[sample] > span, np.minimum(sample + span, total), total)
        rank[sample] = _ranks([rank[sample], rank[ahead]])
        span *= 2
    window = np.flatnonzero(left >= LENGTH)
    first, second = _words(text, window)
    order = _in_order(first, second, residue[window], window, rank)
    ordered = window[order]
    same = (first[order][1:] == first[order][:-1]) & (second[order][1:] == second[order][:-1])
    near = np.flatnonzero(same)
    for at in range(0, len(near), 1 << 14):
        part = near[at : at + (1 << 14)]
        bytes_of = lambda p: text[p[:, None] + np.arange(LENGTH)]
        same[part] = (bytes_of(ordered[part]) == bytes_of(ordered[part + 1])).all(axis=1)
    classes = np.empty(len(window), np.int64)
    classes[order] = np.cumsum(np.append(True, ~same)) - 1 if len(window) else 0
    return piece[window], place[window], classes


def covered_windows(pieces: list[bytes], offsets: np.ndarray, anchors: np.ndarray, ids: np.ndarray) -> dict[int, list[tuple[int, int]]]:
    """For distinct pieces with the smallest doc_id that has each: runs (first, count) of windows that a smaller one has."""
    order = np.argsort(anchors, kind="stable")
    _, counts = np.unique(anchors, return_counts=True)
    found: dict[int, list[tuple[int, int]]] = {}
    block, size = [], 0
    for bucket in np.split(order, np.cumsum(counts)[:-1]):
        if len(bucket) > 1:
            block += bucket.tolist()
            size += sum(len(pieces[i]) for i in bucket.tolist())
        if size >= BLOCK_BYTES:
            _cover_block(block, pieces, offsets, ids, found)
            block, size = [], 0
    if block:
        _cover_block(block, pieces, offsets, ids, found)
    return found


def _cover_block(block: list[int], pieces: list[bytes], offsets: np.ndarray, ids: np.ndarray, found: dict) -> None:
    numbers = np.array(block)
    piece, place, classes = equal_windows([pieces[i] for i in block], offsets[numbers])
    smallest = np.full(int(classes.max()) + 1, np.iinfo(np.int64).max)
    np.minimum.at(smallest, classes, ids[numbers[piece]])
    hit = np.flatnonzero(ids[numbers[piece]] > smallest[classes])
    if not len(hit):
        return
    piece, place = piece[hit], place[hit]
    first = np.flatnonzero((np.diff(piece, prepend=-1) != 0) | (np.diff(place, prepend=-2) != 1))
    for at, n in zip(first.tolist(), np.diff(first, append=len(hit)).tolist(), strict=True):
        found.setdefault(block[int(piece[at])], []).append((int(place[at]), n))


def _sort_runs(rows: pa.Table) -> pa.Table:
    """Marks (row, first window, windows) of every group, from the runs that met in a shard."""
    out: list[tuple] = []
    digests: dict[tuple[int, bytes], int] = {}  # offset and bytes to the number of the piece
    anchor_of: dict[bytes, int] = {}
    pieces, offsets, anchors, smallest = [], [], [], []
    entries = []  # group, id, row, start, count, piece
    for r in rows.to_pylist():
        columns = [from_planes(r[c], np.int64 if c == "ids" else np.uint32).tolist() for c in ("ids", "rows", "starts", "counts", "offsets")]
        if r["covered"]:
            out.append((r["group"], r["rows"], r["starts"], r["counts"]))
            continue
        at = 0
        for doc, row, start, count, offset in zip(*columns, strict=True):
            data = r["data"][at : at + count + LENGTH - 1]
            at += len(data)
            piece = digests.setdefault((offset, data), len(pieces))
            if piece == len(pieces):
                pieces.append(data)
                offsets.append(offset)
                anchors.append(anchor_of.setdefault(data[offset : offset + GRAM], len(anchor_of)))
                smallest.append(doc)
            elif doc < smallest[piece]:
                smallest[piece] = doc
            entries.append((r["group"], doc, row, start, count, piece))
    marks: dict[int, list[tuple[int, int, int]]] = {}
    parts = covered_windows(pieces, np.array(offsets, np.int64), np.array(anchors, np.int64), np.array(smallest, np.int64)) if pieces else {}
    for group, doc, row, start, count, piece in entries:
        if doc > smallest[piece]:
            marks.setdefault(group, []).append((row, start, count))
        else:
            for first, n in parts.get(piece, ()):
                marks.setdefault(group, []).append((row, start + first, n))
    for group, found in marks.items():
        out.append((group, *[planes(c, np.uint32) for c in zip(*found, strict=True)]))
    return _table(out, MARKS)


def _remove(rows: pa.Table, marks: pa.Table) -> pa.Table:
    if not len(rows):
        return RESULT.empty_table()
    group = Group(rows)
    sizes = np.array([len(t) for t in group.texts])
    begins = np.append(0, np.cumsum(sizes))
    change = np.zeros(int(begins[-1]) + 1, np.int32)
    for r in marks.to_pylist():
        row, start, count = (from_planes(r[c], np.uint32).astype(np.int64) for c in ("rows", "starts", "counts"))
        np.add.at(change, begins[row] + start, 1)
        np.add.at(change, begins[row] + start + count + LENGTH - 1, -1)
    gone = np.cumsum(change)[:-1] > 0
    result = []
    for i, (doc, text) in enumerate(zip(group.ids, group.texts, strict=True)):
        part = gone[begins[i] : begins[i + 1]]
        removed = int(part.sum())
        spans = int(np.count_nonzero(part[1:] & ~part[:-1]) + part[:1].sum()) if removed else 0
        kept = np.frombuffer(text, np.uint8)[~part].tobytes() if removed else text
        result.append((doc, len(text), removed, spans, hashlib.sha256(kept).hexdigest()))
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*result, strict=True), RESULT, strict=True)], schema=RESULT)


def remove_repeats(docs: DataFrame, group_bytes: int = GROUP_BYTES, shard_bytes: int = SHARD_BYTES, hot_runs: int = HOT_RUNS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of `docs` (doc_id, text)."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups, shards = 1 + size // group_bytes, 1 + size // shard_bytes
    number = F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)).cast("int")
    dealt = docs.select("doc_id", "text", number.alias("group"))
    anchors = dealt.groupBy("group").applyInArrow(_lister(shards), ANCHORS)
    flags = anchors.groupBy("shard").applyInArrow(_flag_anchors(hot_runs), FLAGS)
    runs = dealt.groupBy("group").cogroup(flags.groupBy("group")).applyInArrow(_sender(shards), RUNS)
    marks = runs.groupBy("shard").applyInArrow(_sort_runs, MARKS)
    ddl = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    return dealt.groupBy("group").cogroup(marks.groupBy("group")).applyInArrow(_remove, ddl)


def op6_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(table(spark, folder, "documents").select("doc_id", "text"))



#: Bytes as hex digits; strings meet by their md5. Runs of covered bytes are islands of starts at most 50 apart.
SQL = """
    WITH docs AS (
      SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n
      FROM documents),
    starts AS (SELECT r, doc_id, i, md5_number(substr(h, 2 * i + 1, 100)) AS w
      FROM (SELECT r, doc_id, h, unnest(range(0, n - 49)) AS i FROM docs)),
    smallest AS (SELECT w, min(doc_id) AS m FROM starts GROUP BY w HAVING min(doc_id) < max(doc_id)),
    hit AS (SELECT r, i FROM starts JOIN smallest USING (w) WHERE doc_id > m),
    cut AS (SELECT r, i, coalesce(i > lag(i) OVER (PARTITION BY r ORDER BY i) + 50, true) AS new FROM hit),
    numbered AS (SELECT r, i, sum(CAST(new AS INTEGER)) OVER (PARTITION BY r ORDER BY i) AS island FROM cut),
    spans AS (SELECT r, island, min(i) AS b, max(i) + 50 AS e FROM numbered GROUP BY r, island),
    parts AS (SELECT r, b, e, coalesce(lag(e) OVER (PARTITION BY r ORDER BY b), 0) AS after FROM spans),
    kept AS (
      SELECT r, count(*) AS n_spans, sum(e - b) AS n_removed, max(e) AS last,
        string_agg(substr(h, 2 * after + 1, 2 * (b - after)), '' ORDER BY b) AS h
      FROM parts JOIN docs USING (r) GROUP BY r)
    SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
      coalesce(n_spans, 0) AS n_spans,
      sha256(unhex(CASE WHEN last IS NULL THEN docs.h ELSE kept.h || substr(docs.h, 2 * last + 1) END)) AS kept_sha256
    FROM docs LEFT JOIN kept USING (r)"""
