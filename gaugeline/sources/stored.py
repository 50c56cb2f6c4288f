"""A table that is changed by id while others read it: Parquet folders, and a small manifest for every version.

    {path}/data/write=W/range=K/    rows of one write whose ids lie in the K-th range of `ids_per_range`
    {path}/versions/N/              manifest of version N: which (range, write) folders it consists of
    {path}/ids/N/                   the N-th reservation of ids: the highest id given away so far
    {path}/empty/                   no rows, for the schema

Nothing is ever changed in place. A batch of changes reads and writes only the ranges that hold its ids; an append adds
folders and reads nothing. A version appears by a rename that succeeds for one writer only, so a reader sees a whole
version or none of it, and keeps the one it began with. A writer that was overtaken takes over the newer manifest where
its own ranges are untouched, and computes its changes again where they are not. Ids are reserved in blocks before the
rows are written: appends never look for the highest id, and two of them never get the same one. Ids of an append that
failed are not given again, as with a database's sequence.

The renames need a file system on which they are atomic, such as HDFS or a local disk.
"""

import uuid
from collections.abc import Callable
from functools import reduce
from typing import NamedTuple, TypeVar

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from gaugeline.operators.changes import DELETE, INSERT, UPDATE, apply_changes, assign_ids
from gaugeline.plans.joins import broadcast_if_small
from gaugeline.plans.scratch import claim, materialize, path_exists, remove_path, subfolders

IDS_PER_RANGE = 1_000_000
LISTED_FOLDERS = 1_000
LISTED_WRITES = 1_000
ATTEMPTS = 20
KEPT_RESERVATIONS = 100
T_ = TypeVar("T_")
MANIFEST = "range bigint, write string, rows bigint"


class Overtaken(RuntimeError):
    """Other writers were faster in every attempt."""


class Committed(NamedTuple):
    """What a batch of changes did: the version it made, rows as its updates left them, and (id, seq) that found no row."""

    version: int
    updated: DataFrame
    not_found: DataFrame


class StoredTable:
    def __init__(self, spark: SparkSession, path: str, key: str = "id", ids_per_range: int = IDS_PER_RANGE):
        self.spark, self.path, self.key, self.ids_per_range = spark, path, key, ids_per_range

    # ---- versions ----

    @classmethod
    def create(cls, spark: SparkSession, path: str, schema: T.StructType, **options) -> "StoredTable":
        """An empty table, unless there is one."""
        table = cls(spark, path, **options)
        if not path_exists(spark, f"{path}/versions/0"):
            table._write(spark.createDataFrame([], schema), "empty", overwrite=True)
            table._commit(spark.createDataFrame([], MANIFEST), 0)
        return table

    def latest(self) -> int:
        """Number of the newest version."""
        return self._newest("versions")

    def _newest(self, kind: str) -> int:
        return max((int(n) for n in subfolders(self.spark, f"{self.path}/{kind}")), default=-1)

    def manifest(self, version: int | None = None) -> DataFrame:
        version = self.latest() if version is None else version
        return self.spark.read.schema(MANIFEST).parquet(f"{self.path}/versions/{version}")

    def _write(self, df: DataFrame, place: str, overwrite: bool = False) -> str:
        df.write.mode("overwrite" if overwrite else "errorifexists").parquet(f"{self.path}/{place}")
        return f"{self.path}/{place}"

    def _commit(self, manifest: DataFrame, version: int) -> bool:
        """Publish a manifest as a version; False if there is one already."""
        staging = self._write(manifest.coalesce(1), f"staging/{uuid.uuid4().hex}")
        return claim(self.spark, staging, f"{self.path}/versions/{version}")

    # ---- reading ----

    @property
    def schema(self) -> T.StructType:
        return self.spark.read.parquet(f"{self.path}/empty").schema

    def _range(self) -> Column:
        return F.floor(F.col(self.key) / F.lit(self.ids_per_range)).cast("bigint").alias("range")

    def _rows(self, entries: DataFrame) -> DataFrame:
        """Rows of the folders in a manifest. A few are opened by name; of many, only the writes they belong to are listed,
        not those of other versions, and Spark prunes the rest by a join."""
        schema = self.schema
        listed = T.StructType([*schema.fields, T.StructField("write", T.StringType()), T.StructField("range", T.LongType())])
        root = f"{self.path}/data"
        few = entries.select("write", "range").limit(LISTED_FOLDERS + 1).collect()
        if not few:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(listed).option("basePath", root)
        if len(few) <= LISTED_FOLDERS:
            rows = reader.parquet(*[f"{root}/write={e['write']}/range={e['range']}" for e in few])
        else:
            writes = [e["write"] for e in entries.select("write").distinct().limit(LISTED_WRITES + 1).collect()]
            places = [f"{root}/write={w}" for w in writes] if len(writes) <= LISTED_WRITES else [root]
            rows = reader.parquet(*places).join(broadcast_if_small(entries.select("write", "range")), ["write", "range"], "left_semi")
        return rows.select(*schema.fieldNames())

    def read(self, version: int | None = None) -> DataFrame:
        """All rows of a version, by default the newest; later changes do not touch what was read."""
        return self._rows(self.manifest(version))

    def row(self, key: int, version: int | None = None) -> DataFrame:
        """The row with an id, or none. Only the folders of its range are opened."""
        at = key // self.ids_per_range
        return self._rows(self.manifest(version).filter(F.col("range") == at)).filter(F.col(self.key) == key)

    # ---- writing ----

    def _store(self, rows: DataFrame) -> tuple[str, DataFrame]:
        """Write rows as folders by range, and list them."""
        write = uuid.uuid4().hex
        place = f"{self.path}/data/write={write}"
        dealt = rows.withColumn("range", self._range()).repartition("range").sortWithinPartitions("range", self.key)
        dealt.write.partitionBy("range").parquet(place)
        if not any(name.startswith("range=") for name in subfolders(self.spark, place)):
            return write, self.spark.createDataFrame([], MANIFEST)
        there = self.spark.read.schema("range bigint").option("basePath", place).parquet(place)
        return write, there.groupBy("range").agg(F.lit(write).alias("write"), F.count("*").alias("rows"))

    def _publish(self, begun: int, change: Callable[[DataFrame], DataFrame], still_valid: Callable[[int], bool]) -> int | None:
        """Commit a change of the manifest on top of the newest version, as long as what it relies on is as it was."""
        for _ in range(ATTEMPTS):
            newest = self.latest()
            if newest != begun and not still_valid(newest):
                return None
            if self._commit(change(self.manifest(newest)), newest + 1):
                return newest + 1
        raise Overtaken(f"{self.path}: no version written in {ATTEMPTS} attempts")

    def reserve(self, count: int, after: int = 0) -> int:
        """Reserve `count` ids above all reserved ones and above `after`; return the one before them."""
        for _ in range(ATTEMPTS):
            last = self._newest("ids")
            before = 0
            if last >= 0:
                before = self.spark.read.schema("last bigint").parquet(f"{self.path}/ids/{last}").first()["last"]
            if not count and after <= before:
                return before
            before = max(before, after)
            mine = self.spark.createDataFrame([(before + count,)], "last bigint")
            staging = self._write(mine.coalesce(1), f"staging/{uuid.uuid4().hex}")
            if claim(self.spark, staging, f"{self.path}/ids/{last + 1}"):
                remove_path(self.spark, f"{self.path}/ids/{last + 1 - KEPT_RESERVATIONS}")
                return before
        raise Overtaken(f"{self.path}: no ids reserved in {ATTEMPTS} attempts")

    def append(self, rows: DataFrame) -> int:
        """Add rows under new ids, and return the version they are in. No row of the table is read."""
        columns = [c for c in self.schema.fieldNames() if c != self.key]
        return self._add(assign_ids(rows.select(*columns), self.reserve, self.key))

    def load(self, rows: DataFrame) -> int:
        """Add rows that bring ids which the table does not hold; later appends go on after the highest."""
        rows = materialize(rows.select(*self.schema.fieldNames()), "stored-rows")
        self.reserve(0, rows.agg(F.max(self.key)).first()[0] or 0)
        return self._add(rows)

    def _add(self, rows: DataFrame) -> int:
        _, added = self._store(rows.select(*self.schema.fieldNames()))
        return self._publish(-1, lambda manifest: manifest.unionByName(added), lambda _: True)

    def _rewrite(self, touched: DataFrame, make: Callable[[DataFrame], tuple[DataFrame, T_]]) -> tuple[int, T_]:
        """Replace the rows of some ranges by what `make` makes of them; again, if others changed these ranges meanwhile."""

        def within(version: int) -> DataFrame:
            return self.manifest(version).join(broadcast_if_small(touched), "range", "left_semi")

        for _ in range(ATTEMPTS):
            begun = self.latest()
            relied = materialize(within(begun), "stored-relied")
            rows, result = make(self._rows(relied))
            write, written = self._store(rows)

            def still_valid(newest: int) -> bool:
                return within(newest).exceptAll(relied).isEmpty() and relied.exceptAll(within(newest)).isEmpty()

            def change(manifest: DataFrame) -> DataFrame:
                return manifest.join(broadcast_if_small(touched), "range", "left_anti").unionByName(written)

            version = self._publish(begun, change, still_valid)
            if version is not None:
                return version, result
            remove_path(self.spark, f"{self.path}/data/write={write}")
        raise Overtaken(f"{self.path}: overtaken in {ATTEMPTS} attempts")

    def apply(self, changes: DataFrame) -> Committed:
        """Apply a batch of inserts, updates and deletes (the columns of the table, op and seq) as one new version.

        See `apply_changes` for what a batch of several changes of one id means. Rows without an id are left out.
        """
        columns = self.schema.fieldNames()
        changes = materialize(changes.select(*columns, "op", "seq").filter(F.col(self.key).isNotNull()), "stored-changes")
        self.reserve(0, changes.filter(F.col("op") == INSERT).agg(F.max(self.key)).first()[0] or 0)
        touched = materialize(changes.select(self._range()).distinct(), "stored-ranges")

        def make(base: DataFrame) -> tuple[DataFrame, tuple[DataFrame, DataFrame]]:
            done = apply_changes(base, changes, self.key)
            found = materialize(done.updated, "stored-updated"), materialize(done.not_found, "stored-missing")
            return done.snapshot, found

        version, (updated, missing) = self._rewrite(touched, make)
        return Committed(version, updated, missing)

    def compact(self, folders: int = 16) -> int:
        """Write every range that lies in `folders` folders or more as one; return the newest version."""
        many = self.manifest().groupBy("range").count().filter(F.col("count") >= folders).select("range")
        many = materialize(many, "stored-ranges")
        return self.latest() if many.isEmpty() else self._rewrite(many, lambda rows: (rows, None))[0]

    def update(self, rows: DataFrame) -> Committed:
        """Replace whole rows by id; the result has the new rows, and the ids that are not there."""
        return self.apply(rows.withColumns({"op": F.lit(UPDATE), "seq": F.lit(0).cast("bigint")}))

    def delete(self, keys: DataFrame) -> Committed:
        """Remove rows by id; the result has the ids that are not there."""
        rest = {f.name: F.lit(None).cast(f.dataType) for f in self.schema.fields if f.name != self.key}
        return self.apply(keys.select(self.key).withColumns({**rest, "op": F.lit(DELETE), "seq": F.lit(0).cast("bigint")}))

    def expire(self, keep: int = 10) -> None:
        """Forget all but the newest `keep` versions and remove the folders that only they had.

        Call it when no reader is on a version that goes and no write is under way.
        """
        versions = sorted(int(n) for n in subfolders(self.spark, f"{self.path}/versions"))
        for old in versions[:-keep]:
            remove_path(self.spark, f"{self.path}/versions/{old}")
        kept = reduce(DataFrame.unionByName, [self.manifest(v) for v in versions[-keep:]])
        needed = {r["write"] for r in kept.select("write").distinct().collect()}
        for name in subfolders(self.spark, f"{self.path}/data"):
            if name.startswith("write=") and name.partition("=")[2] not in needed:
                remove_path(self.spark, f"{self.path}/data/{name}")
