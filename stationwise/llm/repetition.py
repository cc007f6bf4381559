"""Quality rules on repetition: how much of a text lies inside repeated n-grams and lines.

For each n-gram length the words' numbers are combined by a rolling polynomial
hash (numpy, 64 bits); a window is repeated if its hash occurs more than once in
the text, and the characters of every word that a repeated window covers are
counted, the first occurrence included. Lines are compared whole. The 3-word
count of the base rules ranks pairs instead of hashing, so it is exact.

A document is kept if the base rules hold and no share of characters is above
its limit. Documents are not shuffled; work is one batch of texts at a time.

Edge cases: null and empty texts have no words and fail the base rules; equal
texts get equal results. Extra columns pass through; a result column whose name
is taken gets a trailing ``_``.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append_columns, free_names

MIN_WORDS = 50
MAX_REPEAT_WORDS = 0.5
SYMBOLS = b"#*$%&|<>"
#: Greatest share of word characters inside repeated n-grams, by n: the longer what repeats, the less of it. At 5 words half,
#: as the base rule has it for words; a short text that ends with its own headline stays. And inside the later copies of repeated lines.
NGRAM_LIMITS = {5: 0.50, 6: 0.46, 7: 0.42, 8: 0.38, 9: 0.34, 10: 0.30}
LINE_LIMIT = 0.30
#: Greatest number of symbols for each word (a published rule for web text).
SYMBOL_LIMIT = 0.10
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _chars(words: list[bytes]) -> np.ndarray:
    """Code points of each word: its bytes less the continuation bytes."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    raw = np.frombuffer(b"".join(words), np.uint8)
    before = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
    ends = np.cumsum(sizes)
    return before[ends] - before[ends - sizes]


def _covered(codes: np.ndarray, n: int) -> np.ndarray:
    """Which words lie in a window (``codes`` has one number for each window of ``n`` words) that occurs more than once."""
    order = np.argsort(codes, kind="stable")
    ranked = codes[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(codes), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    step = np.zeros(len(codes) + n, np.int32)
    at = np.flatnonzero(twice)
    step[at] += 1
    step[at + n] -= 1
    return np.cumsum(step[:-1]) > 0


def _exact_triples(ids: np.ndarray) -> np.ndarray:
    pairs = np.unique(ids[:-1] * np.int64(len(ids)) + ids[1:], return_inverse=True)[1]
    return pairs[:-1] * np.int64(len(ids)) + ids[2:]


def measure(text: bytes | None) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, share of characters by n, share in repeated lines)."""
    text = text or b""
    words = text.split()
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    if not words:
        return 0, 0, symbols, 0, 0, [0.0] * len(NGRAM_LIMITS), 0.0
    chars = _chars(words)
    total = int(chars.sum())
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    repeat = int(_covered(_exact_triples(ids), 3).sum()) if len(ids) >= 3 and len(numbers) < len(ids) else 0
    shares = []
    for n in NGRAM_LIMITS:
        if not repeat or len(ids) <= n:  # a repeated longer window would repeat its first three words
            shares.append(0.0)
            continue
        codes = np.zeros(len(ids) - n + 1, np.uint64)
        for j in range(n):
            codes = codes * _BASE + ids[j : len(ids) - n + 1 + j].astype(np.uint64) + np.uint64(1)
        shares.append(float(chars[_covered(codes, n)].sum() / total))
    seen: dict[bytes, int] = {}
    dup_lines = dup_chars = 0
    if b"\n" in text:
        for line in text.split(b"\n"):
            if line and not line.isspace():
                if line in seen:
                    dup_lines += 1
                    dup_chars += seen[line]
                else:
                    seen[line] = sum(len(w.decode("utf-8", "replace")) for w in line.split())
    return len(words), total, symbols, dup_lines, repeat, shares, dup_chars / total


def score_repetition(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the base measures, ``ngram_shares``, ``dup_line_share``, ``base_failed`` and ``kept``."""
    names = free_names(docs, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "ngram_shares", "dup_line_share", "base_failed", "kept")
    kinds = [T.LongType()] * 5 + [T.ArrayType(T.DoubleType()), T.DoubleType()]

    def make():
        return lambda texts: [list(x) for x in zip(*map(measure, texts), strict=True)] if texts else [[] for _ in kinds]

    rows = append_columns(docs, text, [T.StructField(n, k) for n, k in zip(names, kinds, strict=False)], make)
    words, _, symbols, _, repeat, shares, lines, failed, kept = names
    below = [F.col(shares)[i] <= limit for i, limit in enumerate(NGRAM_LIMITS.values())]
    verdict = (F.col(lines) <= LINE_LIMIT) & (F.col(symbols) <= SYMBOL_LIMIT * F.col(words))
    for x in below:
        verdict = verdict & x
    base = (F.col(words) < MIN_WORDS) | (100 * F.col(repeat) > int(100 * MAX_REPEAT_WORDS) * F.col(words))
    return rows.withColumn(failed, base).withColumn(kept, ~F.col(failed) & verdict)


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, with their own columns."""
    scored = score_repetition(docs)
    return scored.where(F.col(scored.columns[-1])).select(*docs.columns)


def op9_repetition(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return score_repetition(docs).drop("text", "ngram_shares", "dup_line_share")


OP9_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
p AS (SELECT r, i, w[i] AS x, length(w[i]) AS c FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
g AS (SELECT r, n, i, array_to_string(w[i : i + n - 1], ' ') AS s
      FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (VALUES (3), (5), (6), (7), (8), (9), (10)) v(n) WHERE len(w) >= n)),
rep AS (SELECT r, n, i FROM (SELECT r, n, i, count(*) OVER (PARTITION BY r, n, s) AS k FROM g) WHERE k > 1),
cov AS (SELECT DISTINCT r, n, unnest(range(i, i + n)) AS i FROM rep),
sh AS (SELECT r, count(*) FILTER (n = 3) AS n_repeat_words, coalesce(sum(c) FILTER (n = 5), 0) AS c5, coalesce(sum(c) FILTER (n = 6), 0) AS c6, coalesce(sum(c) FILTER (n = 7), 0) AS c7,
       coalesce(sum(c) FILTER (n = 8), 0) AS c8, coalesce(sum(c) FILTER (n = 9), 0) AS c9, coalesce(sum(c) FILTER (n = 10), 0) AS c10 FROM cov JOIN p USING (r, i) GROUP BY r),
tot AS (SELECT r, count(*) AS n_words, sum(c) AS word_chars FROM p GROUP BY r),
ln AS (SELECT r, l, count(*) AS k, length(regexp_replace(l, '[\x20\x09-\x0D]', '', 'g')) AS c FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d)
       WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r, l),
dl AS (SELECT r, sum(k - 1) AS n_dup_lines, sum((k - 1) * c) AS dup_chars FROM ln GROUP BY r),
f AS (SELECT doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
      CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
      CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, coalesce(dup_chars, 0) AS dup_chars, coalesce(c5, 0) AS c5, coalesce(c6, 0) AS c6, coalesce(c7, 0) AS c7,
      coalesce(c8, 0) AS c8, coalesce(c9, 0) AS c9, coalesce(c10, 0) AS c10
      FROM d LEFT JOIN tot USING (r) LEFT JOIN sh USING (r) LEFT JOIN dl USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND n_symbols <= 0.10::DOUBLE * n_words AND dup_chars::DOUBLE / word_chars <= 0.30::DOUBLE AND c5::DOUBLE / word_chars <= 0.50::DOUBLE
       AND c6::DOUBLE / word_chars <= 0.46::DOUBLE AND c7::DOUBLE / word_chars <= 0.42::DOUBLE AND c8::DOUBLE / word_chars <= 0.38::DOUBLE
       AND c9::DOUBLE / word_chars <= 0.34::DOUBLE AND c10::DOUBLE / word_chars <= 0.30::DOUBLE AS kept FROM b
"""
