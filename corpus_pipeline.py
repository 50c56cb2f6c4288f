"""A training corpus from `documents`: language, near-duplicates, test items, source weights, shards.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before kept. All but the last return the
columns of documents; in the runs each result is written as Parquet and read again. The stages are in gaugeline.llm:

- language: a conditional random field, fitted on a bounded sample of labelled rows, drops texts without a letter
  and texts fewer than half of whose words look like any learned language.
- near_duplicates: one document of each group of near copies stays, the one with the smallest doc_id; documents are linked
  if their SimHash fingerprints of three-word shingles differ in 3 bits or fewer, and groups are components of links.
- decontaminate: documents that hold a copy of a benchmark item go.
- mix: rows are repeated or left out by dependent rounding so that sources reach their target words.
- shards: rows get a shard of nearly equal bytes and a gapless slot; equal texts share a shard.
"""

from pyspark.sql import DataFrame, SparkSession

from gaugeline.llm.common import new_folder, table
from gaugeline.llm.decontamination import without_copies
from gaugeline.llm.language import known_language
from gaugeline.llm.mixing import copied_documents
from gaugeline.llm.sharding import shard_documents
from gaugeline.llm.simhash import keep_one


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return known_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_copies(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return copied_documents(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shard_documents(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("shards", shards),
]

#: The first, second and fourth stage cannot be stated in SQL; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
