"""Helpers that several operators share: text conventions, tables of a folder, and numbers drawn from hashes."""

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gaugeline.plans.scratch import shared_dir

#: A word is a run of characters that are neither a space nor one of the five controls from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(column: str | Column) -> Column:
    """Lower-case A-Z only; other letters stay as they are."""
    return F.translate(column, UPPER, LOWER)


def word_count(column: str | Column) -> Column:
    return F.coalesce(F.regexp_count(column, F.lit(WORD)), F.lit(0)).cast("bigint")


def remainder(doc_id: str | Column, modulus: int = 5) -> Column:
    """crc32 of the id as text, modulo `modulus`; of the empty text for a null id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")), F.lit(0)) % modulus


def uniform(*columns: str | Column, seed: str) -> Column:
    """A number in [0, 1) that depends on nothing but the values and the seed."""
    hashed = F.xxhash64(F.lit(seed), *columns)
    return (hashed.bitwiseAND(F.lit((1 << 53) - 1))).cast("double") / F.lit(float(1 << 53))


def fresh_name(df: DataFrame, stem: str) -> str:
    """A column name that `df` does not have, whatever columns its user added."""
    taken, name = {c.lower() for c in df.columns}, stem
    while name.lower() in taken:
        name += "_"
    return name


def new_folder(spark: SparkSession, label: str) -> str:
    """A new path in the folder that all executors share."""
    return f"{shared_dir(spark)}/llm/{label}-{uuid.uuid4().hex}"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
