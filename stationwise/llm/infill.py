"""Fill-in-middle transformation by a sparse index of multibyte characters.

A text is cut at ends of units: a token (white space and the word behind it, or white space at
the end), a code point, or a byte, the cut then moving back to the begin of its character. Of a text only its
exceptions are recorded: where characters of several bytes begin, and how many bytes
they have in excess before them. ``searchsorted`` over these turns a byte place into a code
point and back; a text of ASCII alone, and every stretch between exceptions, is arithmetic.

Cuts and form are drawn from SHA-256 of seed and id. psm is prefix, suffix, middle; spm is suffix,
prefix, middle; each part behind its mark. A text that is empty or holds a mark stays plain, so that the parts
can be told apart again: no mark overlaps another, hence each is found first at its own place.

Documents are not shuffled; work is some 1 MB of text at a time.

Edge cases: a null text is empty; a null id is drawn for as if its decimal were empty; equal ids
and texts give equal results; of bytes that are not UTF-8 all but continuation bytes begin a character, and they come
out as they came in. Extra columns pass through; a result column whose name is taken gets a trailing ``_``.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append_columns, free_names

SEED = 42
#: Texts of a hundred that are transformed, and of these those of form spm.
RATE = 50
SPM = 80
PREFIX, SUFFIX, MIDDLE = MARKS = (b"<P>", b"<S>", b"<M>")
_MARK = re.compile(b"|".join(MARKS))
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


class Exceptions:
    """Multibyte characters of a text: first byte and number of each, and the bytes in excess up to its end."""

    def __init__(self, text: bytes):
        self.size = len(text)
        self.at = self.number = np.zeros(0, np.int64)
        self.excess = np.zeros(1, np.int64)
        if text.isascii():
            return
        tail = (np.frombuffer(text, np.uint8) & 0xC0) == 0x80
        tail[0] = False  # the first byte begins a character, whatever it is
        edges = np.flatnonzero(np.diff(np.append(tail, False)))  # a character's first byte, and its last, in turn
        self.at = edges[::2]
        self.excess = np.append(0, np.cumsum(edges[1::2] - self.at))
        self.number = self.at - self.excess[:-1]

    def __len__(self) -> int:
        """Code points."""
        return int(self.size - self.excess[-1])

    def points(self, places):
        """Code points before byte places at which characters begin."""
        return places - self.excess[np.searchsorted(self.at, places)]

    def places(self, points):
        """Byte places before code points."""
        return points + self.excess[np.searchsorted(self.number, points)]

    def begins(self, places):
        """Byte places moved back to the begin of their character."""
        before = np.searchsorted(self.at, places, "right")
        at, end = np.append(-1, self.at), np.append(-1, self.at + np.diff(self.excess))
        return np.where(places <= end[before], at[before], places)


def token_ends(text: bytes) -> np.ndarray:
    """Byte places at which tokens end."""
    if not text:
        return np.zeros(0, np.int64)
    space = _SPACE[np.frombuffer(text, np.uint8)]
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    return np.append(ends, len(text))


def cut_text(text: bytes, draws: list[int], unit: str = "token", rate: int = RATE, spm: int = SPM) -> tuple[int, str, bytes, int | None, int | None]:
    """(units, form, output, code points of the prefix, of the middle) of a text by four drawn numbers."""
    index = Exceptions(text)
    ends = token_ends(text) if unit == "token" else None
    n = len(ends) if ends is not None else len(index) if unit == "point" else len(text)
    if not text or _MARK.search(text) or draws[2] % 100 >= rate:
        return n, "plain", text, None, None
    cuts = np.array(sorted((draws[0] % (n + 1), draws[1] % (n + 1))), np.int64)
    places = np.append(0, ends)[cuts] if ends is not None else index.places(cuts) if unit == "point" else index.begins(cuts)
    a, b = (int(x) for x in places)
    before, until = (int(x) for x in index.points(places))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if draws[3] % 100 < spm:
        return n, "spm", SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle, before, until - before
    return n, "psm", PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle, before, until - before


def restored_text(output: bytes, form: str) -> bytes:
    """The text of an output."""
    if form == "plain":
        return output
    between, middle = output[3:].split(MIDDLE, 1)
    one, other = between.split(PREFIX if form == "spm" else SUFFIX, 1)
    return other + middle + one if form == "spm" else one + middle + other


def draws_of(doc_id, seed: int = SEED) -> F.Column:
    """Four unsigned 32-bit numbers of an id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return F.array(*(F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)))


def fill_in_middle(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", unit: str = "token", seed: int = SEED, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """``docs`` with ``n_units``, ``form``, ``output``, ``prefix_chars`` and ``middle_chars`` (code points; null where plain)."""
    if unit not in ("token", "point", "byte"):
        raise ValueError("unit must be 'token', 'point' or 'byte'")
    units, form, output, prefix, middle, draws = free_names(docs, "n_units", "form", "output", "prefix_chars", "middle_chars", "draws")
    fields = [T.StructField(units, T.LongType()), T.StructField(form, T.StringType()), T.StructField(output, T.BinaryType()), T.StructField(prefix, T.LongType()), T.StructField(middle, T.LongType())]

    def make():
        return lambda texts, drawn: [list(x) for x in zip(*(cut_text(t or b"", d, unit, rate, spm) for t, d in zip(texts, drawn, strict=True)), strict=True)]

    made = append_columns(docs.withColumn(draws, draws_of(F.col(doc_id), seed)), text, fields, make, beside=[draws]).drop(draws)
    return made.withColumn(output, F.col(f"`{output}`").cast("string"))


def restore(made: DataFrame, output: str = "output", form: str = "form") -> DataFrame:
    """``made`` with ``restored``, the text rebuilt from output and form alone."""
    (restored,) = free_names(made, "restored")

    def make():
        return lambda texts, forms: [[restored_text(t, f) for t, f in zip(texts, forms, strict=True)]]

    done = append_columns(made, output, [T.StructField(restored, T.BinaryType())], make, beside=[form])
    return done.withColumn(restored, F.col(f"`{restored}`").cast("string"))


def op12_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    made = restore(fill_in_middle(docs).drop("text"))
    return made.select(
        "doc_id",
        F.col("n_units").alias("n"),
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"),
    )


OP12_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
h AS (SELECT *, len(w) AS n, ('0x' || x[1:8])::BIGINT AS h1, ('0x' || x[9:16])::BIGINT AS h2, ('0x' || x[17:24])::BIGINT AS h3, ('0x' || x[25:32])::BIGINT AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
      CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, array_to_string(w[1:a], '') AS pre, array_to_string(w[a+1:b], '') AS mid, array_to_string(w[b+1:n], '') AS suf FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256 FROM p
"""
