"""Benchmark decontamination: one Aho-Corasick automaton over the benchmark's word windows.

Text is normalised byte for byte (A-Z lower-cased, every ASCII byte that is
neither letter nor digit becomes a space), so a word keeps its place and a match
maps straight back to the original text. The automaton's letters are word
numbers: a benchmark word has a number, any other word is 0. Every text is
scanned once, whole.

One automaton holds all windows if they take at most ``block_bytes`` (measured before
they are collected), and the documents, which are not shuffled, are scanned once. An
automaton needs about ``AUTOMATON_BYTES`` of a Python worker's memory for each byte of
windows, so the default takes some 450 MB. The windows of a larger benchmark
are dealt over several blocks: for each, the text column is scanned for (digest of the text, items,
word ranges) of texts with hits, the only rows that are kept, once for equal texts; they
meet the documents again in one join. No step writes a document or its text.

Edge cases: a null or empty text has no words and is never hit; a null or empty
item has no window; an item without an id makes hits but has no id to report;
repeated items count once. Extra columns pass through; a result column whose
name is taken gets a trailing ``_``.
"""

from __future__ import annotations

import math
import uuid
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append_columns, chunks, free_names, stored

WINDOW = 10
#: Most bytes of windows and item ids in one automaton.
BLOCK_BYTES = 32 << 20
#: Bytes of memory that an automaton and its windows take for each byte of windows: 13 measured over 8 MB.
AUTOMATON_BYTES = 14

#: Byte for byte: A-Z to a-z; 0-9, a-z and the bytes of non-ASCII characters stay; the rest to space.
NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(NORMAL).split()


def item_windows(benchmark: DataFrame, window: int = WINDOW, item: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct (item, words) windows of the benchmark: ``window`` consecutive words, or a shorter item whole."""

    def run(batches):
        for batch in batches:
            ids, at = batch.column(0).to_pylist(), 0
            for texts in chunks(batch.column(1)):
                for name, body in zip(ids[at : at + len(texts)], texts, strict=True):
                    words = words_of(body)
                    seen = list({b" ".join(words[i : i + window]) for i in range(max(1, len(words) - window + 1))}) if words else []
                    for lo in range(0, len(seen), 10_000):
                        part = seen[lo : lo + 10_000]
                        yield pa.RecordBatch.from_arrays([pa.array([name] * len(part), pa.string()), pa.array(part, pa.binary())], names=["item", "words"])
                at += len(texts)

    rows = benchmark.select(F.col(item).cast("string"), F.col(text).cast("binary"))
    return rows.mapInArrow(run, "item string, words binary").distinct()


#: The automaton that this Python worker built last: (block's name, vocabulary, automaton).
_built: tuple = ("", {}, None)


def _automaton(name: str, block) -> tuple:
    global _built
    if _built[0] != name:
        import ahocorasick

        vocabulary: dict[bytes, int] = {}
        owners: dict[tuple, list] = {}
        for item, words in block.value:
            key = tuple(vocabulary.setdefault(w, len(vocabulary) + 1) for w in words.split(b" "))
            owners.setdefault(key, []).append(item)
        automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for key, items in owners.items():
            automaton.add_word(key, (len(key), [x for x in items if x is not None]))
        automaton.make_automaton()
        _built = (name, vocabulary, automaton)
    return _built[1:]


def _merged(ranges) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _places(text: bytes, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word ranges as character ranges of the original text."""
    raw = np.frombuffer(text, np.uint8)
    inside = np.frombuffer(text.translate(NORMAL), np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    before = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
    return [(int(before[edges[2 * a]]), int(before[edges[2 * b - 1]])) for a, b in ranges]


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``items`` (distinct ids) and ``spans`` (start and end character of each hit passage)."""
    spark = docs.sparkSession
    windows = item_windows(benchmark, window).select("*", F.xxhash64("words", "item").alias("h"))
    total = windows.agg(F.sum(F.length("words") + F.coalesce(F.length("item"), F.lit(0)) + 16)).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    count, held, items, spans = free_names(docs, "n_words", "n_hit", "items", "spans")
    ranges_type = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    fields = [T.StructField(count, T.LongType()), T.StructField(held, T.LongType()), T.StructField(items, T.ArrayType(T.StringType())), T.StructField(spans, ranges_type)]
    if blocks == 1:
        scan = _scanner(spark, windows)

        def make():
            find = scan()
            return lambda texts: _columns((body, words, *find(words)) for body, words in ((b, words_of(b)) for b in texts))

        return append_columns(docs, text, fields, make)

    met, met_key = free_names(docs, "benchmark_hits", "benchmark_hits_key")
    windows = stored(windows, "benchmark-windows")
    parts = [_hits(docs, text, _scanner(spark, windows.where(F.pmod("h", F.lit(blocks)) == b))) for b in range(blocks)]
    hits = stored(reduce(DataFrame.unionByName, parts).distinct(), "benchmark-hits")
    by_text = hits.groupBy("key").agg(F.collect_list(F.struct("items", "starts", "ends")).alias(met)).withColumnRenamed("key", met_key)
    rows = docs.join(by_text, _text_key(F.col(text)) == F.col(met_key), "left").select(*(F.col(f"`{c}`") for c in docs.columns), met)

    def unite():
        def work(texts, found):
            each = ([x for x in f or ()] for f in found)
            return _columns((body, words_of(body), [r for x in f for r in zip(x["starts"], x["ends"], strict=True)], {i for x in f for i in x["items"]}) for body, f in zip(texts, each, strict=True))

        return work

    return append_columns(rows, text, fields, unite, beside=[met]).drop(met)


def _text_key(text) -> F.Column:
    return F.md5(text.cast("binary"))


def _scanner(spark, windows: DataFrame):
    """A function for tasks: it gives (word ranges, items) of a text's words, by one automaton over ``windows``."""
    block, name = spark.sparkContext.broadcast([(r[0], bytes(r[1])) for r in windows.select("item", "words").collect()]), uuid.uuid4().hex

    def scan():
        vocabulary, automaton = _automaton(name, block)
        get = vocabulary.get

        def find(words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
            ranges, owners = [], set()
            if vocabulary and words:
                for end, (n, ids) in automaton.iter(tuple([get(w, 0) for w in words])):
                    ranges.append((end + 1 - n, end + 1))
                    owners.update(ids)
            return _merged(ranges), owners

        return find

    return scan


def _hits(docs: DataFrame, text: str, scan) -> DataFrame:
    """(key, items, starts, ends) of the texts with hits: digest of the text, item ids and word ranges."""

    def run(batches):
        find = scan()
        for batch in batches:
            at = 0
            for texts in chunks(batch.column(1)):
                rows = []
                for key, body in zip(batch.column(0).slice(at, len(texts)).to_pylist(), texts, strict=True):
                    ranges, owners = find(words_of(body))
                    if ranges:
                        rows.append((key, sorted(owners), [a for a, _ in ranges], [z for _, z in ranges]))
                at += len(texts)
                kinds = (pa.string(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["key", "items", "starts", "ends"])

    bodies = docs.select(_text_key(F.col(text)).alias("key"), F.col(text).cast("binary").alias("body"))
    return bodies.mapInArrow(run, "key string, items array<string>, starts array<int>, ends array<int>")


def _columns(found) -> list[list]:
    """Result columns of (text, its words, word ranges, items)."""
    out: list[list] = [[], [], [], []]
    for body, words, ranges, owners in found:
        ranges = _merged(ranges)
        out[0].append(len(words))
        out[1].append(sum(z - a for a, z in ranges))
        out[2].append(sorted(owners))
        out[3].append([{"start": a, "end": z} for a, z in (_places(body, ranges) if ranges else [])])
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents that hold no benchmark window, with their own columns."""
    held = free_names(docs, "n_words", "n_hit")[1]
    return find_contamination(docs, benchmark, window).where(F.col(held) == 0).select(*docs.columns)


def op1_decontaminate(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return find_contamination(docs, benchmark).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


#: Items have few distinct window lengths: 10, and the word counts of shorter items.
OP1_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS s
       FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT r, n, i, array_to_string(w[i : i + n - 1], ' ') AS s
       FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
m AS (SELECT r, i, dw.n, item FROM dw JOIN bw ON dw.n = bw.n AND dw.s = bw.s),
hits AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + n)) AS p FROM m) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM m WHERE item IS NOT NULL) GROUP BY r)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN its USING (r)
"""
