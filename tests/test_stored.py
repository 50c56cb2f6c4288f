"""The stored table: versions, ranges, concurrent writers, ids."""

import threading

import pytest
from pyspark.sql import functions as F

from gaugeline.plans.scratch import claim, path_exists
from gaugeline.sources import stored
from gaugeline.sources.stored import Overtaken, StoredTable

SCHEMA = "id bigint, value double"
LOG = f"{SCHEMA}, op string, seq bigint"


@pytest.fixture
def table(spark, folder):
    schema = spark.createDataFrame([], SCHEMA).schema
    made = StoredTable.create(spark, f"{folder}/t", schema, ids_per_range=10)
    made.load(spark.createDataFrame([(i, float(i)) for i in range(1, 41)], SCHEMA))
    return made


def log(table, *rows):
    return table.spark.createDataFrame(rows, LOG)


def content(table, version=None):
    return dict(table.read(version).collect())


def folders(table, version=None):
    return {(r["range"], r["write"]) for r in table.manifest(version).collect()}


def test_changes_rewrite_touched_ranges_and_keep_old_versions(table):
    before, began = folders(table), table.latest()
    reader = table.read()
    done = table.apply(log(table, (3, 33.0, "U", 0), (15, None, "D", 0), (99, 1.0, "U", 0), (55, 5.0, "I", 0)))
    after = folders(table)
    assert {r for r, _ in before - after} == {0, 1} and {r for r, _ in after - before} == {0, 1, 5}
    assert done.version == began + 1 == table.latest()
    assert done.updated.collect() == [(3, 33.0)] and done.not_found.collect() == [(99, 0)]
    old = {i: float(i) for i in range(1, 41)}
    assert dict(reader.collect()) == content(table, began) == old
    assert content(table) == {i: v for i, v in old.items() if i != 15} | {3: 33.0, 55: 5.0}
    assert table.row(3).collect() == [(3, 33.0)] and table.row(15).collect() == table.row(1000).collect() == []
    assert table.row(15, began).collect() == [(15, 15.0)]


def test_only_the_range_of_an_id_is_opened(table):
    assert all("range=2" in f for f in table.row(25).inputFiles()) and len(table.row(25).inputFiles()) == 1


def test_update_and_delete(table):
    done = table.update(table.spark.createDataFrame([(7, 70.0), (8, 80.0), (70, 1.0)], SCHEMA))
    assert sorted(done.updated.collect()) == [(7, 70.0), (8, 80.0)] and [r["id"] for r in done.not_found.collect()] == [70]
    done = table.delete(table.spark.createDataFrame([(7,), (71,), (None,)], "id bigint"))
    assert [r["id"] for r in done.not_found.collect()] == [71]
    assert 7 not in content(table) and content(table)[8] == 80.0


def test_a_range_can_be_emptied_and_filled(table):
    table.delete(table.spark.range(1, 41))
    assert content(table) == {} and folders(table) == set()
    table.apply(log(table, (5, 1.0, "I", 0)))
    assert content(table) == {5: 1.0}


def test_an_overtaken_writer_takes_over_other_ranges(table, monkeypatch):
    """Another commit lands between the reading and the publishing of a first attempt."""
    other, commit, calls = StoredTable(table.spark, table.path, ids_per_range=10), StoredTable._commit, []

    def slow(self, manifest, version):
        if self is table and not calls:
            calls.append(other.update(other.spark.createDataFrame([(35, 350.0)], SCHEMA)).version)
        return commit(self, manifest, version)

    monkeypatch.setattr(StoredTable, "_commit", slow)
    stores, store = [], StoredTable._store
    monkeypatch.setattr(StoredTable, "_store", lambda self, rows: (stores.append(self), store(self, rows))[1])
    done = table.update(table.spark.createDataFrame([(5, 50.0)], SCHEMA))
    assert calls == [done.version - 1] and stores.count(table) == 1  # nothing was computed again
    assert content(table)[5] == 50.0 and content(table)[35] == 350.0


def test_an_overtaken_writer_of_the_same_range_starts_again(table, monkeypatch):
    other, commit, calls = StoredTable(table.spark, table.path, ids_per_range=10), StoredTable._commit, []

    def slow(self, manifest, version):
        if self is table and not calls:
            calls.append(other.apply(log(other, (5, None, "D", 0), (6, 60.0, "U", 0))).version)
        return commit(self, manifest, version)

    monkeypatch.setattr(StoredTable, "_commit", slow)
    done = table.update(table.spark.createDataFrame([(5, 50.0), (4, 40.0)], SCHEMA))
    assert [r["id"] for r in done.not_found.collect()] == [5] and done.updated.collect() == [(4, 40.0)]
    assert content(table)[4] == 40.0 and content(table)[6] == 60.0 and 5 not in content(table)


def test_a_writer_gives_up(table, monkeypatch):
    monkeypatch.setattr(stored, "ATTEMPTS", 2)
    monkeypatch.setattr(StoredTable, "_commit", lambda self, manifest, version: False)
    with pytest.raises(Overtaken):
        table.update(table.spark.createDataFrame([(5, 50.0)], SCHEMA))


def test_two_concurrent_appends_get_disjoint_ids(table):
    errors = []

    def append(n):
        try:
            rows = table.spark.range(100, 100 + n, 1, 3).select(F.col("id").cast("double").alias("value"))
            StoredTable(table.spark, table.path, ids_per_range=10).append(rows)
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=append, args=(n,)) for n in (13, 25, 7)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors
    rows = table.read().collect()
    assert sorted(r["id"] for r in rows) == list(range(1, 40 + 45 + 1))
    assert len(rows) == 85


def test_a_reservation_that_was_overtaken_is_made_again(table, monkeypatch):
    others = []

    def overtaken(*args):
        if not others:
            others.append(None)
            others[0] = StoredTable(table.spark, table.path).reserve(5)
        return claim(*args)

    monkeypatch.setattr(stored, "claim", overtaken)
    mine = table.reserve(3)
    spans = sorted([(mine, 3), (others[0], 5)])
    assert spans[0][0] >= 40 and spans[0][0] + spans[0][1] <= spans[1][0]


def test_inserted_ids_are_not_given_again(table):
    table.apply(log(table, (500, 1.0, "I", 0)))
    table.append(table.spark.createDataFrame([(7.0,)], "value double"))
    assert content(table)[501] == 7.0


def test_appends_read_and_rewrite_nothing_until_compacted(table):
    before = folders(table)
    for i in range(3):
        table.append(table.spark.createDataFrame([(float(i),)], "value double"))
    assert before <= folders(table) and len(folders(table)) == len(before) + 3
    rows = content(table)
    assert rows[41] == 0.0 and rows[43] == 2.0
    table.compact(folders=3)
    assert content(table) == rows and len(folders(table)) == len(before)


def test_expired_versions_leave_their_folders(table):
    for i in range(3):
        table.update(table.spark.createDataFrame([(1, float(i))], SCHEMA))
    rows, gone = content(table), folders(table, 1) - folders(table)
    table.expire(keep=1)
    assert content(table) == rows
    assert not path_exists(table.spark, f"{table.path}/versions/1")
    assert gone and all(w in {x for _, x in folders(table)} or not path_exists(table.spark, f"{table.path}/data/write={w}") for _, w in gone)


def test_many_folders_are_read_through_a_join(table, monkeypatch):
    table.delete(table.spark.createDataFrame([(2,)], "id bigint"))
    want = content(table)
    monkeypatch.setattr(stored, "LISTED_FOLDERS", 1)
    assert content(table) == want


def test_folders_of_writes_that_were_replaced_are_not_listed(table, monkeypatch):
    first = {w for _, w in folders(table)}
    table.update(table.spark.createDataFrame([(i, -float(i)) for i in range(1, 41)], SCHEMA))
    monkeypatch.setattr(stored, "LISTED_FOLDERS", 1)
    assert content(table) == {i: -float(i) for i in range(1, 41)}
    assert not any(f"write={w}/" in f for f in table.read().inputFiles() for w in first)


def test_one_claim_wins(spark, folder):
    for name in ("a", "b"):
        spark.range(1).write.parquet(f"{folder}/{name}")
    assert claim(spark, f"{folder}/a", f"{folder}/x/1") and not claim(spark, f"{folder}/b", f"{folder}/x/1")
    assert not path_exists(spark, f"{folder}/b") and spark.read.parquet(f"{folder}/x/1").count() == 1
