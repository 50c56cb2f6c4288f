"""Written intermediate tables in the folder all executors share."""

import tempfile
import uuid

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; a temporary one only in local mode, where every task sees it."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor reaches")
    folder = tempfile.mkdtemp(prefix="gaugeline-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/gaugeline/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once as Parquet and go on from the files: the lineage ends there, a lost executor loses nothing,
    and later readers prune columns and push filters down."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few rows of the driver as a table. They go as Arrow: a plain list is unpickled by Python workers, which start for
    that and stay beside those of the real work. Arrow would move local times, so these stay a list."""
    if "timestamp" in schema:
        return spark.createDataFrame(rows, schema)
    names = StructType.fromDDL(schema).names
    columns = zip(*rows) if rows else [()] * len(names)
    return spark.createDataFrame(pa.table([pa.array(c) for c in columns], names=names), schema)


SMALL_ROWS = 1_000_000


def spread_work(df: DataFrame, rows: int) -> DataFrame:
    """Spread a small table of rows that are costly to process over all cores; a large one already is."""
    if rows > SMALL_ROWS:
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def _path(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, where = _path(spark, path)
    return fs.exists(where)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in `path`; none if it does not exist."""
    fs, where = _path(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(where)) if fs.exists(where) else []


def running_query(spark: SparkSession) -> str | None:
    """Id of the streaming query whose micro-batch runs in this thread. It is the checkpoint's: a restart keeps it, a
    new checkpoint has another one."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


def remove_path(spark: SparkSession, path: str) -> None:
    fs, where = _path(spark, path)
    fs.delete(where, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, whole or not at all: written aside and renamed over what is there."""
    fs, target = _path(spark, path)
    aside = _path(spark, f"{path.rpartition('/')[0]}/_{uuid.uuid4().hex}")[1]
    out = fs.create(aside, True)
    out.write(text.encode())
    out.close()
    fs.delete(target, False)
    fs.rename(aside, target)


def publish(df: DataFrame, path: str, staging: str) -> None:
    """Write `df` so that `path` either holds all of it or does not exist; an existing `path` is left alone.

    A repeated micro-batch therefore changes nothing that a reader may have seen.
    """
    spark = df.sparkSession
    if path_exists(spark, path):
        return
    df.write.mode("overwrite").parquet(staging)
    fs, target = _path(spark, path)
    fs.mkdirs(target.getParent())
    if not fs.rename(_path(spark, staging)[1], target):
        raise RuntimeError(f"cannot publish {path}")


def claim(spark: SparkSession, staging: str, target: str, keep: bool = False) -> bool:
    """Rename the folder `staging` to `target` unless that exists: of all who try, one succeeds and hears True.

    The folder of one who lost is removed, unless it is to be kept for another try. On a file system whose rename is not conditional a late folder may end up within the first one; the mark left in
    each tells which it is, and only the winner's lies at the top.
    """
    mark = f"_claimed-{uuid.uuid4().hex}"
    fs, source = _path(spark, staging)
    fs.create(_path(spark, f"{staging}/{mark}")[1], False).close()
    _, place = _path(spark, target)
    if not fs.exists(place):
        fs.mkdirs(place.getParent())
        rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
        options = spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = getattr(rename, "NONE")
        files = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), spark._jsc.hadoopConfiguration())
        try:
            files.rename(source, place, options)
        except Py4JJavaError:
            if not fs.exists(place):  # not lost to another: a failure
                raise
    won = path_exists(spark, f"{target}/{mark}")
    if not won:
        if not keep:
            remove_path(spark, staging)
        remove_path(spark, f"{target}/{source.getName()}")
    return won
