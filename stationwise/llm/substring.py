"""Substring dedup by seed and extend: exact repeats of ``WINDOW`` or more consecutive words.

1. Winnowing: each window's anchor is the least-hashed ``GRAM``-word gram in it, so
   equal windows have equal anchors. Anchors are counted (map-side combined);
   one that occurs once cannot lie in a repeat, and documents with none but
   such are done. Texts that occur more than once are repeats as a whole; one
   of them stands for all, also where rows are equal in id and text.
2. Seeds: the other documents meet their repeated anchors again (a join on the
   text's digest). Each seed is extended both ways over the windows that it
   anchors: its reach. Reaches are compared by hash: equal reaches are repeats
   as a whole and are counted, not paired.
3. Where a seed's reaches differ, the seed is extended window by window: the windows of
   its distinct reaches are counted by (anchor, window) hash, which finds the exact
   ends of each repeat. Adjoining repeated windows make up the maximal repeats.

So extension is by counting: a match is not compared with each partner, it ends where the
count of equal windows does. No step pairs the members of a group: hot anchors, reaches and windows are counts,
joined back on their keys with plain joins that Spark can split. Hashes of reaches and windows are
64 bits beside the anchor's 64.

Edge cases: null and empty texts have no words; texts shorter than a window lose nothing;
rows equal in text lose everything if they are as long as a window; extra columns
pass through ``remove_repeats``, which writes bytes that are not UTF-8 as U+FFFD where it
rewrites a text; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append_columns, chunks, free_names, stored

WINDOW = 35
GRAM = 10
#: Most words whose hashes a task remembers.
MEMORY = 100_000
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


class _Hashes(dict):
    """XXH64 of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= MEMORY:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


class _Ranges:
    """Hash of any range of words, from prefix sums modulo 2**64."""

    def __init__(self, words: list[bytes], hashes: _Hashes):
        n = len(words)
        codes = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
        powers, inverse = np.full(n + 1, _BASE, np.uint64), np.full(n + 1, _INVERSE, np.uint64)
        powers[0] = inverse[0] = 1
        powers, self.inverse = np.cumprod(powers), np.cumprod(inverse)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(codes * powers[:n])))

    def __call__(self, starts, ends) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.inverse[starts])


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that the least hash favours no word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def anchors(words: list[bytes], hashes: _Hashes, window: int = WINDOW, gram: int = GRAM):
    """(range hasher, anchor hash, first window, last window) of the runs of windows that share an anchor; None for a short text."""
    if len(words) < window:
        return None
    ranges, n = _Ranges(words, hashes), len(words) - window + 1
    starts = np.arange(len(words) - gram + 1)
    grams = ranges(starts, starts + gram)
    wide = window - gram + 1
    at = np.concatenate([np.lib.stride_tricks.sliding_window_view(grams[lo : min(lo + 65_536, n) + wide - 1], wide).argmin(axis=1) + np.arange(lo, min(lo + 65_536, n)) for lo in range(0, n, 65_536)])
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    last = np.concatenate((first[1:], [n])) - 1
    return ranges, grams[at[first]], at[first], first, last


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


@dataclass
class Repeats:
    """``texts``: doc_id, key (digest of the text), n_words, sha256 of the words. ``copies``: key, rows with that text, first_id.
    ``spans``: key, word ranges to remove, for texts that occur once. ``bodies``: key and text of the documents with seeds."""

    texts: DataFrame
    copies: DataFrame
    spans: DataFrame
    bodies: DataFrame
    window: int


def _key(text) -> F.Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def _named(df: DataFrame, prefix: str, *columns: str) -> DataFrame:
    return df.select(*(F.col(c).alias(prefix + c) for c in columns))


def find_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> Repeats:
    """The repeats of ``docs`` (doc_id, text)."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), _key(F.col("text")).alias("key"))

    def first_pass():
        hashes = _Hashes()

        def work(texts):
            out: list[list] = [[], [], []]
            for text in texts:
                words = text.split()
                runs = anchors(words, hashes, window, gram)
                out[0].append(len(words))
                out[1].append(_digest(words))
                out[2].append(runs[1].view(np.int64).tolist() if runs else [])
            return out

        return work

    fields = [T.StructField("n_words", T.LongType()), T.StructField("sha256", T.StringType()), T.StructField("anchors", T.ArrayType(T.LongType()))]
    texts = stored(append_columns(docs, "text", fields, first_pass).drop("text"), "repeats-texts")
    named = texts.groupBy("key", "doc_id").agg(F.count("*").alias("n"))
    same = F.coalesce(F.min_by("n", "doc_id"), F.sum("n")).alias("same")
    copies = stored(named.groupBy("key").agg(F.sum("n").alias("copies"), F.min("doc_id").alias("first_id"), same), "repeats-copies")
    first = texts.select("doc_id", "key", "anchors").join(_named(copies, "c_", "key", "first_id", "same"), (F.col("key") == F.col("c_key")) & F.col("doc_id").eqNullSafe(F.col("c_first_id")))
    equal = not copies.where("same > 1").isEmpty()
    first = _one_each(first, "c_same", equal, "key", "anchors")
    each = stored(first.select("key", F.explode("anchors").alias("a")), "repeats-anchors")
    # counts are stored before they are joined: the join then deals both sides itself, and a hot key can be split
    seeds = stored(each.groupBy("a").count().where("count > 1").select(F.col("a").alias("seed")), "repeats-seeds")
    wanted = each.join(seeds, F.col("a") == F.col("seed"), "left_semi").groupBy("key").agg(F.collect_set("a").alias("seeds")).join(copies, "key")
    wanted = wanted.select(F.col("key").alias("w_key"), F.col("first_id").alias("w_id"), F.col("same").alias("w_same"), "seeds")
    found = docs.join(wanted, (F.col("key") == F.col("w_key")) & F.col("doc_id").eqNullSafe(F.col("w_id")))
    bodies = stored(_one_each(found, "w_same", equal, "key", "text", "seeds"), "repeats-bodies")
    spans = _spans(bodies, window, gram)
    return Repeats(texts.drop("anchors"), copies, spans, bodies, window)


def _one_each(rows: DataFrame, same: str, equal: bool, *columns: str) -> DataFrame:
    """``columns`` of ``rows``, of those with a ``same`` above 1 (rows equal in id and text) one for each key.

    Such rows are first merged within each task, so that of a hot text only one row for a task is shuffled.
    """
    if not equal:
        return rows.select(*columns)

    def merge(batches):
        seen: set[bytes] = set()
        for batch in batches:
            keep = []
            for i, key in enumerate(batch.column(0).to_pylist()):
                if key not in seen:
                    if len(seen) >= MEMORY:
                        seen.clear()
                    seen.add(key)
                    keep.append(i)
            yield batch.take(pa.array(keep, pa.int64()))

    many = rows.where(F.col(same) > 1).select(*columns)
    return rows.where(F.col(same) == 1).select(*columns).unionByName(many.mapInArrow(merge, many.schema).dropDuplicates(["key"]))


def _spans(bodies: DataFrame, window: int, gram: int) -> DataFrame:
    """(key, spans): repeated word ranges of each text."""
    schema = "key binary, begin int, n int, a long, reach long, windows array<bigint>"

    def reaches(batches):
        hashes = _Hashes()
        for batch in batches:
            at = 0
            for texts in chunks(batch.column(1)):
                rows: list[tuple] = []
                for key, text, seeds in zip(batch.column(0).slice(at, len(texts)).to_pylist(), texts, batch.column(2).slice(at, len(texts)), strict=True):
                    runs = anchors(text.split(), hashes, window, gram)
                    if not runs:
                        continue
                    ranges, hashed, places, first, last = runs
                    wanted = np.isin(hashed.view(np.int64), seeds.values.to_numpy(zero_copy_only=False))
                    hashed, places, first, last = hashed[wanted], places[wanted], first[wanted], last[wanted]
                    reach = mixed(ranges(first, last + window) + (places - first).astype(np.uint64) * np.uint64(0x100000001B3) + (last - first).astype(np.uint64))
                    for a, r, lo, hi in zip(hashed.view(np.int64).tolist(), reach.view(np.int64).tolist(), first.tolist(), last.tolist(), strict=True):
                        starts = np.arange(lo, hi + 1)
                        rows.append((key, lo, hi - lo + 1, a, r, ranges(starts, starts + window).view(np.int64).tolist()))
                at += len(texts)
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(list(zip(*rows, strict=True)) or [()] * 6, (pa.binary(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64())), strict=True)], names=["key", "begin", "n", "a", "reach", "windows"])

    found = stored(bodies.select("key", "text", "seeds").mapInArrow(reaches, schema), "repeats-reaches")
    same = found.groupBy("a", "reach").agg(F.count("*").alias("times"), F.min(F.struct("key", "begin")).alias("one"))
    same = stored(same, "repeats-same")
    kinds = stored(same.groupBy("a").agg(F.count("*").alias("kinds")).where("kinds > 1").select(F.col("a").alias("k_a"), F.lit(True).alias("differs")), "repeats-kinds")
    judged = same.join(kinds, F.col("a") == F.col("k_a"), "left").where("times > 1 OR differs").select(F.col("a").alias("j_a"), F.col("reach").alias("j_reach"), "times", "one", F.coalesce("differs", F.lit(False)).alias("differs"))
    marked = stored(found.join(judged, (F.col("a") == F.col("j_a")) & (F.col("reach") == F.col("j_reach"))).select("key", "begin", "n", "a", "times", (F.col("differs") & ((F.col("times") == 1) | ((F.col("one.key") == F.col("key")) & (F.col("one.begin") == F.col("begin"))))).alias("opened"), F.when(F.col("differs"), F.col("windows")).alias("windows")), "repeats-marked")
    whole = marked.where("times > 1").select("key", "begin", (F.col("begin") + F.col("n") + (window - 1)).alias("end"))
    opened = marked.where("opened").select("key", "begin", "a", "times", F.posexplode("windows").alias("i", "w"))
    twice = stored(opened.groupBy("a", "w").count().where("count > 1").select(F.col("a").alias("t_a"), F.col("w").alias("t_w")), "repeats-twice")
    start = F.col("begin") + F.col("i")
    ends = opened.where("times = 1").join(twice, (F.col("a") == F.col("t_a")) & (F.col("w") == F.col("t_w")), "left_semi").select("key", start.alias("begin"), (start + window).alias("end"))
    return whole.unionByName(ends).groupBy("key").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))


def _kept(words: list[bytes], spans) -> list[bytes]:
    gone = np.zeros(len(words) + 1, np.int64)
    for s in spans or ():
        gone[s["begin"]] += 1
        gone[min(s["end"], len(words))] -= 1
    return [w for w, g in zip(words, (np.cumsum(gone[:-1]) > 0).tolist(), strict=True) if not g]


def _cut_texts(df: DataFrame, fields: list[T.StructField], result) -> DataFrame:
    """``df`` (with ``text`` and ``spans`` somewhere in it) with ``fields`` from the kept words of each row."""
    at = df.columns.index("text"), df.columns.index("spans")
    schema, kinds = T.StructType([*df.schema.fields, *fields]), {"bigint": pa.int64(), "string": pa.string()}

    def run(batches):
        for batch in batches:
            done = 0
            for texts in chunks(batch.column(at[0])):
                part = batch.slice(done, len(texts))
                rows = [result(words, _kept(words, spans)) for words, spans in zip(((t or b"").split() for t in texts), part.column(at[1]).to_pylist(), strict=True)]
                made = [pa.array([r[i] for r in rows], kinds[f.dataType.simpleString()]) for i, f in enumerate(fields)]
                yield pa.RecordBatch.from_arrays([*part.columns, *made], names=schema.names)
                done += len(texts)

    return df.mapInArrow(run, schema)


def removal_digest(found: Repeats) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every document; only texts with repeats are read again."""
    fields = [T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType())]
    hit = found.bodies.select("key", "text").join(_named(found.spans, "s_", "key", "spans"), F.col("key") == F.col("s_key")).select("key", "text", F.col("s_spans").alias("spans"))
    done = _cut_texts(hit, fields, lambda words, kept: (len(words) - len(kept), _digest(kept))).select(F.col("key").alias("d_key"), "n_removed", "kept_sha256")
    by_text = stored(found.copies.join(done.dropDuplicates(["d_key"]), F.col("key") == F.col("d_key"), "left").select(F.col("key").alias("t_key"), "copies", "n_removed", "kept_sha256"), "repeats-done")
    gone = (F.col("copies") > 1) & (F.col("n_words") >= found.window)
    return found.texts.join(by_text, F.col("key") == F.col("t_key")).select(
        "doc_id",
        "n_words",
        F.when(gone, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(gone, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256"),
    )


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``docs`` with the text of a document that holds repeats replaced by its kept words, one space apart; other rows unchanged."""
    found = find_repeats(docs, window, gram)
    key, k2, kept, spans = free_names(docs, "repeat_key", "repeat_key2", "repeat_kept", "spans")
    plan = found.copies.join(_named(found.spans, "s_", "key", "spans"), F.col("key") == F.col("s_key"), "left").where("copies > 1 OR s_key IS NOT NULL")
    plan = plan.select(F.col("key").alias(k2), F.col("copies").alias(key), F.col("s_spans").alias("spans"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), "text").join(plan, _key(F.col("text")) == F.col(k2), "left")
    gone = F.col(key).isNotNull() & (F.col(key) > 1)
    all_words = F.array(F.struct(F.lit(0).alias("begin"), F.lit(1 << 30).alias("end")))
    return _replaced(rows.select("row", "text", F.when(gone, all_words).otherwise(F.col("spans")).alias("spans")), docs, window)


def _replaced(rows: DataFrame, docs: DataFrame, window: int) -> DataFrame:
    def result(words, kept):
        return (b" ".join(kept).decode("utf-8", "replace"),) if len(words) >= window and len(kept) < len(words) else (None,)

    made = _cut_texts(rows, [T.StructField("kept_text", T.StringType())], result)
    return made.select(*(F.coalesce("kept_text", "row.text").alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns))


def op8_substring(spark, sf_dir: str) -> DataFrame:
    return removal_digest(find_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")))


OP8_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
g AS (SELECT r, i, md5(array_to_string(w[i : i + 34], ' ')) AS s FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY s) AS k FROM g) WHERE k > 1),
gone AS (SELECT r, list(DISTINCT p) AS ps, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 35)) AS p FROM rep) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(list_filter(w, lambda x, i : ps IS NULL OR NOT list_contains(ps, i)), ' ')) AS kept_sha256
FROM d LEFT JOIN gone USING (r)
"""
