"""Quality classifier: naive Bayes support vectors (log-count ratios, then a linear hinge-loss model).

Features are n-gram indicators: words and word pairs, and singles, pairs and triples
of word shapes (case, digits, punctuation, "same word again"), hashed into ``BUCKETS``. The fit takes a
bounded, hash-ordered sample of at most ``SAMPLE_ROWS`` labelled rows, each whole, outside
the held-out third; their class counts give each bucket's log-count ratio,
which scales its indicator; dual coordinate descent then fits the hinge loss,
classes weighted to equal sums, on rows scaled to length one. A slope fitted
on the sample turns margins into probabilities; the sign of the margin decides.

Only the sample's feature numbers meet in one task (bounded by ``SAMPLE_ROWS``
and ``SAMPLE_FEATURES``); the model is one vector of ``BUCKETS`` floats, broadcast.
Every document is scored whole, where it lies, without a shuffle.

Edge cases: null and empty texts have no features and score by the bias alone;
an id labelled both ways, or with a null label or id, is not learned from; without labels of both
classes every score is 0.5; equal texts score alike. Extra columns pass through.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append_columns, chunks, crc32_of, cut, free_names, stored

BITS = 18
BUCKETS = 1 << BITS
#: Labelled rows that the model is fitted on at most, and features that they have together at most. Rows are taken whole, in hash order.
SAMPLE_ROWS = 6_000
SAMPLE_FEATURES = 16_000_000
EPOCHS = 8
COST = 1.0
ALPHA = 1.0
#: Most words whose hashes and shapes a task remembers.
MEMORY = 150_000

_CLASS = bytes(65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 else 48 if 48 <= b <= 57 else 117 if b >= 128 else b for b in range(256))
_RUN = re.compile(rb"(.)\1+", re.DOTALL)


class _Words(dict):
    """(hash of the word, hash of its shape), remembered up to a bound."""

    def __missing__(self, word: bytes) -> tuple[int, int]:
        import xxhash

        if len(self) >= MEMORY:
            self.clear()
        shape = _RUN.sub(rb"\1", word.translate(_CLASS))
        self[word] = pair = (xxhash.xxh64_intdigest(word.lower()), xxhash.xxh64_intdigest(shape, 1))
        return pair


def _bucket(x: np.ndarray, kind: int) -> np.ndarray:
    x = (x ^ np.uint64(kind)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(64 - BITS)).astype(np.int32)


def features(text: bytes | None, known: _Words) -> np.ndarray:
    """Sorted distinct buckets of a text's n-grams."""
    words = (text or b"").split()
    if not words:
        return np.empty(0, np.int32)
    w, s = np.array([known[x] for x in words], np.uint64).T
    again = np.concatenate(([False], w[1:] == w[:-1]))
    s = np.where(again, np.uint64(0x5851F42D4C957F2D), s)
    three = np.uint64(3)
    parts = [_bucket(w, 1), _bucket(w[:-1] * three + w[1:], 2), _bucket(s, 3), _bucket(s[:-1] * three + s[1:], 4), _bucket((s[:-2] * three + s[1:-1]) * three + s[2:], 5)]
    return np.unique(np.concatenate(parts))


def descend(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, cost: float = COST, epochs: int = EPOCHS, seed: int = 5) -> tuple[np.ndarray, float]:
    """Weights and bias of the hinge loss over ratio-scaled indicators, by dual coordinate descent."""
    w, bias, rng = np.zeros(len(ratio)), 0.0, np.random.default_rng(seed)
    alpha = np.zeros(len(rows))
    scaled = []
    for x in rows:
        v = ratio[x]
        norm = np.sqrt((v * v).sum()) or 1.0
        scaled.append(v / norm)
    square = np.array([float(v @ v) + 1.0 for v in scaled])
    bound = cost * len(y) / (2.0 * np.where(y > 0, max((y > 0).sum(), 1), max((y < 0).sum(), 1)))
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            gap = y[i] * (w[rows[i]] @ scaled[i] + bias) - 1.0
            new = min(max(alpha[i] - gap / square[i], 0.0), bound[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[rows[i]] += step * scaled[i]
                bias += step
                alpha[i] = new
    return w, bias


def margin(x: np.ndarray, model: dict) -> float:
    if not len(x):
        return model["bias"]
    norm = np.sqrt(model["squares"][x].sum()) or 1.0
    return float(model["weights"][x].sum() / norm) + model["bias"]


def _fit(rows: list[np.ndarray], y: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float]:
    """(ratio, weights, bias, slope)"""
    p, q = np.full(BUCKETS, ALPHA), np.full(BUCKETS, ALPHA)
    for x, label in zip(rows, y, strict=True):
        (p if label > 0 else q)[x] += 1
    ratio = np.log((p / p.sum()) / (q / q.sum()))
    w, bias = descend(rows, y, ratio)
    model = {"weights": w * ratio, "squares": ratio * ratio, "bias": bias}
    margins = np.array([margin(x, model) for x in rows]) * y
    loss = [(np.logaddexp(0.0, -k * margins).mean(), k) for k in (0.5, 1.0, 2.0, 4.0, 8.0)]
    return ratio, w, bias, min(loss)[1]


def train(docs: DataFrame, labels: DataFrame, held_out, sample_rows: int = SAMPLE_ROWS, sample_features: int = SAMPLE_FEATURES, text: str = "text") -> dict:
    """The model, from the ``quality`` labels of rows for which ``held_out`` (a condition on ``doc_id``) is not true."""
    spark = docs.sparkSession
    one = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out).groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("quality").alias("q2"))
    sample = one.where("q = q2").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    pairs = cut(sample.select(F.col("doc_id").alias("l_id"), "q"))  # at most sample_rows rows
    taken = docs.select("doc_id", F.col(text).cast("binary").alias("text")).join(F.broadcast(pairs), F.col("doc_id") == F.col("l_id")).select("doc_id", "text", "q")

    def featured(batches):
        known = _Words()
        for batch in batches:
            at = 0
            for texts in chunks(batch.column(1)):
                found = [features(t, known) for t in texts]
                n = len(texts)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, n), batch.column(2).slice(at, n).cast(pa.int32()), pa.array([x.astype("<i4").tobytes() for x in found], pa.binary())], names=["doc_id", "q", "x"])
                at += n

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "x"])
        y = np.where(rows["q"].to_numpy() == 1, 1.0, -1.0)
        ratio, w, bias, slope = _fit([np.frombuffer(x, "<i4") for x in rows["x"]], y) if len(set(y)) == 2 else (np.zeros(BUCKETS), np.zeros(BUCKETS), 0.0, 1.0)
        return pd.DataFrame({"ratio": [ratio.astype("<f4").tobytes()], "w": [w.astype("<f4").tobytes()], "bias": [bias], "slope": [slope]})

    # rows equal in id and features are learned from once; of the others those first in hash order, whole, as far as the bounds go
    rows = taken.mapInArrow(featured, "doc_id long, q int, x binary").withColumn("h", F.xxhash64("doc_id", "x")).dropDuplicates(["h"])
    rows = stored(rows, "nbsvm-rows")
    sizes = rows.select("h", (F.length("x") / 4).cast("long").alias("n")).orderBy("h").limit(sample_rows).collect()
    upto = np.cumsum([r["n"] for r in sizes])
    k = max(1, int(np.searchsorted(upto, sample_features, "right")))
    bounded = rows.where(F.col("h") <= (sizes[min(k, len(sizes)) - 1]["h"] if sizes else 0)).drop("h")
    got = bounded.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(fit, "ratio binary, w binary, bias double, slope double").first()
    if got is None:
        return {"weights": np.zeros(BUCKETS), "squares": np.zeros(BUCKETS), "bias": 0.0, "slope": 1.0}
    ratio, w = np.frombuffer(got["ratio"], "<f4").astype(float), np.frombuffer(got["w"], "<f4").astype(float)
    return {"weights": ratio * w, "squares": ratio * ratio, "bias": float(got["bias"]), "slope": float(got["slope"])}


def score(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: label 1 likelier)."""
    name = free_names(docs, "score")[0]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m, known = shared.value, _Words()
        return lambda texts: [[float(1.0 / (1.0 + np.exp(-np.clip(m["slope"] * margin(features(t, known), m), -500, 500)))) for t in texts]]

    return append_columns(docs, text, [T.StructField(name, T.DoubleType())], make)


def op10_nbsvm(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    held_out = F.pmod(crc32_of(F.col("doc_id")), F.lit(3)) == 1
    model = train(docs, labels, held_out)
    return score(docs, model).select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
