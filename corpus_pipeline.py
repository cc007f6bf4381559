"""Corpus pipeline: quality rules, near-dedup, decontamination, mixing, sharding.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns the next stage's documents. All but the last return the columns that
they got; the last adds ``shard``. ``run`` applies them to ``documents`` and
writes each stage's result as a Parquet table in the session's shared folder, so
a lost executor repeats one stage's tasks at most. Once a stage's result is written, what
the stage wrote for itself and the result before it are deleted: two copies of the documents at most
lie there at a time. The rows that ``run`` returns read the last copy.

Nulls, empty texts, ties, repeated rows, extra columns and empty tables are
handled as the stages' operators say: texts with fewer than 50 words go in the
first stage; of a near-copy component the document with the least id stays; a
document with any benchmark window goes; the mix repeats whole documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stationwise.llm import decontaminate, mix, repetition, shards, simhash
from stationwise.llm.common import Scratch, ship, stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return repetition.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return simhash.drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix.mix(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shards.assign(docs, shards.shard_map(docs))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: SQL has no XXH64 and no tree search, so near_dedup cannot be restated; the tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        with Scratch(spark) as own:
            made = stage(spark, docs, sf_dir)
        with Scratch(spark) as table:
            docs = stored(made, f"pipeline-{name}")
        own.free()
        if before:
            before.free()
        before = table
    return STAGES[-1][1](spark, docs, sf_dir)
