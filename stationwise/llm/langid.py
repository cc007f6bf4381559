"""Language identification by cross-parsing entropy.

A suffix automaton holds every substring of a language's training text. Along a document it
yields the longest match from each place on where a phrase begins; a phrase is such a match, or
one byte that the training text does not have. The fewer phrases a language needs,
the better it describes the document: phrases x log2(training bytes) / bytes
estimates the cross entropy, and the least one wins (equal: the first language by code point). The
score is the lead over the second: 1 - least / second; 1 if there is one language.

Text is lower-cased runs of letters (and marks), one space between them, as UTF-8. Automata are
tables over the bytes that occur in training, a dead end leading to where the byte leads
from the root, marked as a phrase's end; so numpy walks all languages over many stretches at once. A document
is parsed in stretches of ``STRETCH`` bytes, a phrase ending with its stretch.

The model is fitted on a bounded sample: of each language the distinct texts of least hash that fit
into ``TRAIN_BYTES`` together, whole (less where many languages share ``TRAIN_TOTAL``); a language with longer texts only
has the shortest of its sample. Languages are taken to be few, as each has an automaton.
Only the sample's texts are broadcast; each Python worker builds the automata once. Every document is parsed whole, where it lies, without a shuffle.

Edge cases: null texts and texts without a letter are ``und``, score 0, as is everything if no row
is labelled; a null label or a row without a letter is not learned from; a null id is held out never; equal
texts have equal results; bytes that are not UTF-8 are no letters. Extra columns pass through; a result column whose
name is taken gets a trailing ``_``.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append_columns, crc32_of, free_names

#: Bytes of normalised training text of a language, and of all languages together.
TRAIN_BYTES = 1 << 16
TRAIN_TOTAL = 1 << 19
#: Rows of a language among which the training text is chosen.
SAMPLE_ROWS = 200
STRETCH = 512
UNDETERMINED = "und"


def normal(text: bytes | None) -> bytes:
    """Lower-cased words of letters and marks, one space between; empty without a letter."""
    import regex

    lowered = (text or b"").decode("utf-8", "replace").lower()
    words = regex.findall(r"[\p{L}\p{M}]+", lowered)
    joined = " ".join(words)
    return joined.encode() if words and regex.search(r"\p{L}", joined) else b""


def suffix_automaton(text: bytes) -> list[dict[int, int]]:
    """Transitions of the states, state 0 being the root; every path from it spells a substring."""
    moves: list[dict[int, int]] = [{}]
    link, longest = [-1], [0]
    last = 0
    for c in text:
        new = len(moves)
        moves.append({})
        longest.append(longest[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = new
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if longest[q] == longest[p] + 1:
                link[new] = q
            else:
                twin = len(moves)
                moves.append(moves[q].copy())
                longest.append(longest[p] + 1)
                link.append(link[q])
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return moves


class Languages:
    """Automata of all languages in one table: an entry is the next state's row, its complement if a phrase ends there."""

    def __init__(self, texts: list[tuple[str, bytes]]):
        self.names = [n for n, _ in texts]
        used = sorted(set().union(*(t for _, t in texts)) - {0}) if texts else []
        self.width = len(used) + 1  # the last column: any other byte
        self.column = np.full(256, len(used), np.int32)
        self.column[used] = np.arange(len(used), dtype=np.int32)
        self.bits = np.array([math.log2(max(2, len(t))) for _, t in texts])
        parts, self.roots, at = [], [], 0
        for _, text in texts:
            moves = suffix_automaton(text)
            lost = len(moves)  # within a phrase of one unknown byte
            begin = np.full(self.width, lost, np.int64)
            for c, s in moves[0].items():
                if c:
                    begin[self.column[c]] = s
            begin = (begin + at) * self.width
            rows = np.tile(~begin, (lost + 1, 1))
            rows[0] = begin
            state = np.fromiter((s for s, m in enumerate(moves) for c in m if c and s), np.int64)
            byte = np.fromiter((c for s, m in enumerate(moves) for c in m if c and s), np.int64)
            to = np.fromiter((n for s, m in enumerate(moves) for c, n in m.items() if c and s), np.int64)
            rows[state, self.column[byte]] = (to + at) * self.width
            parts.append(rows.astype(np.int32))
            self.roots.append(at * self.width)
            at += lost + 1
        self.table = np.concatenate(parts).ravel() if parts else np.zeros(0, np.int32)

    def phrases(self, texts: list[bytes]) -> np.ndarray:
        """Phrases of each text (normalised) by each language: languages x texts."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        symbols = self.column[np.frombuffer(b"".join(texts), np.uint8)]
        per = -(-sizes // STRETCH)
        owner = np.repeat(np.arange(len(texts)), per)
        k = (np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)) * STRETCH
        begin, length = (np.cumsum(sizes) - sizes)[owner] + k, np.minimum(STRETCH, sizes[owner] - k)
        order = np.argsort(-length, kind="stable")
        owner, begin, length = owner[order], begin[order], length[order]
        state = np.repeat(np.array(self.roots, np.int32)[:, None], len(owner), axis=1)
        ended = np.ones_like(state)  # the last phrase ends with its stretch
        alive = np.searchsorted(-length, -np.arange(length[0] if len(length) else 0))
        for j, n in enumerate(alive):
            to = self.table.take(state[:, :n] + symbols[begin[:n] + j])
            mark = to >> 31
            ended[:, :n] -= mark
            state[:, :n] = to ^ mark
        return np.array([np.bincount(owner, row, len(texts)) for row in ended])

    def rank(self, texts: list[bytes | None]) -> list[tuple[str, float]]:
        """(language, score) of each text."""
        texts = [normal(t) for t in texts]
        out = [(UNDETERMINED, 0.0)] * len(texts)
        at = [i for i, t in enumerate(texts) if t and self.names]
        if at:
            entropy = self.phrases([texts[i] for i in at]) * self.bits[:, None] / np.array([len(texts[i]) for i in at])
            best = entropy.argmin(axis=0)
            least = np.partition(entropy, min(1, len(entropy) - 1), axis=0)
            score = 1 - least[0] / least[1] if len(entropy) > 1 else np.ones(len(at))
            for i, b, s in zip(at, best.tolist(), score.tolist(), strict=True):
                out[i] = self.names[b], s
        return out


def held_out(doc_id, folds: int = 4, fold: int = 2) -> F.Column:
    return F.coalesce(F.pmod(crc32_of(doc_id), F.lit(folds)) == fold, F.lit(False))


def training_texts(docs: DataFrame, text: str = "text", lang: str = "lang") -> list[tuple[str, bytes]]:
    """(language, normalised text) of the bounded sample, languages by code point; rows are set apart by a zero byte."""
    size = F.octet_length("text")
    rows = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    rows = rows.withColumn("h", F.xxhash64("text")).withColumn("long", size > TRAIN_BYTES)
    # distinct texts of each language tell below which hash some four times the sample lies, so that no task ranks more
    counts = rows.groupBy("lang").agg(F.approx_count_distinct(F.when(~F.col("long"), F.col("h"))).alias("short"), F.approx_count_distinct("h").alias("all")).collect()
    if not counts:
        return []

    def of(values):
        return F.element_at(F.create_map(*(F.lit(x) for pair in values for x in pair)), F.col("lang"))

    rate = of([(r["lang"], 4.0 * SAMPLE_ROWS / (r["short"] or r["all"])) for r in counts])
    wanted = of([(r["lang"], r["short"] == 0) for r in counts]) == F.col("long")
    few = rows.where(wanted & (F.col("h") / 2.0**64 + 0.5 < rate)).groupBy("lang", "long", "h", "text").agg(F.count(F.lit(1)).alias("n_rows"))
    order = [F.when(F.col("long"), size), "h", "text"]
    ranked = few.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("n") <= SAMPLE_ROWS)
    upto = F.sum(size).over(Window.partitionBy("lang").orderBy("n"))
    picked = ranked.withColumn("upto", upto).where((F.col("upto") <= TRAIN_BYTES) | (F.col("n") == 1)).select("lang", "n", "text")
    found: dict[str, list[bytes]] = {}
    for r in picked.orderBy("lang", "n").collect():
        found.setdefault(r["lang"], []).append(normal(r["text"].encode()))
    share = TRAIN_TOTAL // max(1, len(found))
    out = []
    for name in sorted(found):
        held: list[bytes] = []
        for t in found[name]:
            if not held or sum(map(len, held)) + len(t) <= share:
                held.append(t)
        out.append((name, b"\0".join(held)))
    return [(n, t) for n, t in out if t]


#: The automata that this Python worker built last: (model's name, automata).
_built: tuple = ("", None)


def _languages(name: str, texts) -> Languages:
    global _built
    if _built[0] != name:
        _built = (name, Languages(texts.value))
    return _built[1]


def identify(docs: DataFrame, training: list[tuple[str, bytes]], text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``."""
    names = free_names(docs, "lang_pred", "score")
    texts, model = docs.sparkSession.sparkContext.broadcast(training), uuid.uuid4().hex

    def make():
        languages = _languages(model, texts)
        return lambda bodies: [list(x) for x in zip(*languages.rank(bodies), strict=True)]

    return append_columns(docs, text, [T.StructField(n, k) for n, k in zip(names, (T.StringType(), T.DoubleType()), strict=True)], make)


def op13_language(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang").withColumn("held_out", held_out(F.col("doc_id")))
    training = training_texts(docs.where(~F.col("held_out")))
    return identify(docs.drop("lang"), training).select("doc_id", "held_out", "lang_pred", "score")
