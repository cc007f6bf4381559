"""Registered queries and the pipeline over the smallest tables."""

from __future__ import annotations

import os
import re

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from stationwise.llm import common, mix, queries, repetition, simhash

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_runs_and_agrees_with_sql(spark, name):
    got = queries.QUERIES[name](spark, SF).toPandas()
    assert len(got) and {"doc_id", "conv_id"} & set(got.columns)
    if name in queries.ORACLE_SQL:
        db = duckdb.connect()
        for table in ("documents", "benchmark", "conversations"):
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
        want = db.execute(queries.ORACLE_SQL[name]).df()
        columns = sorted(got.columns)
        assert columns == sorted(want.columns)
        rows = [sorted(map(repr, x[columns].convert_dtypes().astype(object).itertuples(index=False, name=None))) for x in (got, want)]
        assert rows[0] == rows[1]


def test_held_out_accuracy(spark):
    got = queries.QUERIES["op10_nbsvm"](spark, SF.replace("0.001", "0.01"))
    labels = spark.read.parquet(SF.replace("0.001", "0.01") + "/labels.parquet")
    rows = got.join(labels, "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) / len(rows) >= 0.95


def test_pipeline_equals_brute_force(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_dedup", "decontamination", "mixing", "sharding"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [r for r in docs.collect() if _kept(r["text"])]
    prints = np.array([simhash.fingerprint((r["text"] or "").encode()) for r in rows], np.uint64)
    linked = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= simhash.MAX_BITS
    ids = np.array([r["doc_id"] for r in rows])
    label = ids.copy()
    while (new := np.array([label[x].min() for x in linked])).tolist() != label.tolist():
        label = new
    rows = [r for r, x in zip(rows, label, strict=True) if r["doc_id"] == x]
    items = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", r["text"].lower()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    windows = {tuple(w[i : i + 10]) for w in items for i in range(max(1, len(w) - 9))}
    clean = []
    for r in rows:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in r["text"]))
        if not any(tuple(words[i : i + n]) in windows for n in {len(w) for w in windows} for i in range(len(words) - n + 1)):
            clean.append(r)
    mixed = mix.mix_plan(spark.createDataFrame(clean, docs.schema)).collect()
    want = sorted(r["doc_id"] for r in mixed for _ in range(r["copies"]))
    here = common.shared_dir(spark)
    before = set(os.listdir(here))
    got = corpus_pipeline.run(spark, SF)
    assert {x.split("-")[1] for x in set(os.listdir(here)) - before if x.startswith("pipeline-")} == {"mixing"}
    assert got.columns == [*docs.columns, "shard"]
    assert sorted(r["doc_id"] for r in got.collect()) == want


def _kept(text):
    words, _, symbols, _, repeat, shares, lines = repetition.measure((text or "").encode())
    if words < 50 or 2 * repeat > words:
        return False
    return lines <= repetition.LINE_LIMIT and symbols <= repetition.SYMBOL_LIMIT * words and all(s <= x for s, x in zip(shares, repetition.NGRAM_LIMITS.values(), strict=True))


def test_pipeline_on_empty_tables(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF}/benchmark.parquet").limit(0).write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline_with_nulls_repeats_and_clashing_columns(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    some = docs.limit(60).selectExpr("*", "'mine' AS shard", "n_chars AS size", "lang AS fp")
    more = some.limit(9).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "text", "CAST(NULL AS STRING) AS lang", "CAST(NULL AS STRING) AS source", "n_chars", "shard", "size", "fp")
    empty = some.limit(4).selectExpr("doc_id", "CAST(NULL AS STRING) AS text", "lang", "source", "n_chars", "shard", "size", "fp")
    some.unionByName(some).unionByName(more).unionByName(more).unionByName(empty).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.columns[: len(some.columns)] == some.columns and got.columns[len(some.columns) :] == ["shard_"]
    rows = got.collect()
    assert rows and {r["shard"] for r in rows} == {"mine"} and all(r["text"] for r in rows)
    kept = {r["doc_id"] for r in rows}
    assert kept <= {r["doc_id"] for r in some.collect()} | {None}
