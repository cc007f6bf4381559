"""Token shards in training order: a keyed Feistel permutation gives each sequence its global slot.

1. Texts are tokenised by a public byte-pair vocabulary (its path is a
   parameter), ended by ``END`` and cut into sequences of ``LENGTH`` tokens,
   the last one padded. A first pass keeps only the index: a narrow row for each
   sequence, numbered within its partition. Partition sizes, summed up, make
   the numbers global and gapless.
2. A Feistel network over the smallest even number of bits that holds all
   numbers, walked until it lands below their count, is a permutation of them:
   the training order, a function of key and count alone.
3. Slot ranges of ``PER_SHARD`` are shards. A second pass tokenises again, which costs less than
   a stored copy of all tokens, and deals records by shard. Each shard is one task and one file of
   records of ``2 * LENGTH + 1`` bytes: little-endian 16-bit tokens and a line end. Record i
   of shard s is slot ``s * PER_SHARD + i`` at byte ``i * stride``, so a reader seeks to any
   step and resumes there. Spark's own text writer commits the files on any file system it knows.

The two passes must see the same rows in the same partitions, as scans of a
written table do (retried tasks included); store anything else first. A task
of the second pass whose count differs from the index stops the job.

The pattern's look-ahead matters only where two white spaces meet. Texts without such a place, found by one
search of a linear-time engine over a batch, are cut by the pattern without it, which that kind of engine can run too; tokens stay arrays.

Edge cases: a null text or one without tokens has no sequence; equal texts get
sequences of their own; an empty table writes no shard; extra columns are not stored. Ids are
integers. Bytes that are not UTF-8 are tokenised as U+FFFD, which is what a reader gets back.
"""

from __future__ import annotations

import base64
import uuid
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, shared_dir, stored

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Pre-token pattern of the vocabulary (fixed value).
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The same pre-tokens for a text in which no two white spaces meet, without look-ahead.
NO_RUNS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s"""
#: Two white spaces in UTF-8 bytes: the 25 characters that ``\s`` means.
RUN = r"(?:[\t-\r ]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80){2}"
END = 50256
LENGTH = 512
PER_SHARD = 16_384
KEY = 20_240_607
ROUNDS = 6


@lru_cache(maxsize=2)
def tokenizer(path: str, pattern: str = PATTERN):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    if max(ranks.values(), default=0) > 0xFFFF:
        raise ValueError("a record holds 16-bit tokens")
    # no text gets the special token; without any, encode_to_numpy would search for the empty string
    return tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={"<|endoftext|>": END})


def encoder(vocabulary: str):
    """Function from a list of texts (bytes) to their token arrays; None for a null or empty text."""
    kinds = [tokenizer(vocabulary, p).encode_to_numpy for p in (NO_RUNS, PATTERN)]

    def encode(texts: list[bytes | None]) -> list[np.ndarray | None]:
        runs = pc.match_substring_regex(pa.array(texts, pa.large_binary()), RUN).to_pylist()
        return [kinds[run](text.decode("utf-8", "replace"), disallowed_special=()) if text else None for text, run in zip(texts, runs, strict=True)]

    return encode


def permute(numbers: np.ndarray, count: int, key: int = KEY, rounds: int = ROUNDS) -> np.ndarray:
    """Slots of the ``numbers`` (all below ``count``): a bijection of 0..count-1."""
    half = np.uint64(max(1, -(-max(count - 1, 1).bit_length() // 2)))
    low = np.uint64((1 << int(half)) - 1)

    def once(x):
        left, right = x >> half, x & low
        for r in range(rounds):
            z = right + np.uint64((key * 0x9E3779B97F4A7C15 + (r + 1) * 0xD1B54A32D192ED03) & 0xFFFFFFFFFFFFFFFF)
            z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((z ^ (z >> np.uint64(31))) & low)
        return (left << half) | right

    out = once(numbers.astype(np.uint64))
    while (beyond := out >= np.uint64(count)).any():
        out[beyond] = once(out[beyond])
    return out.astype(np.int64)


@dataclass
class TokenShards:
    """``sequences``: doc_id, piece, n_tokens, slot, shard, record. ``path``: folder of the shard files. ``count``: sequences."""

    sequences: DataFrame
    path: str
    count: int
    length: int
    per_shard: int

    @property
    def stride(self) -> int:
        return 2 * self.length + 1


def _tokens(docs: DataFrame, vocabulary: str, batch_rows, schema: str) -> DataFrame:
    """``batch_rows(part, place, rows)`` for batches of (id, tokens without the end) of documents that have any; it returns arrays and the next place."""

    def run(batches):
        encode, part, place = encoder(vocabulary), TaskContext.get().partitionId(), 0
        for batch in batches:
            at = 0
            for texts in chunks(batch.column(1)):
                rows = [(doc, tokens) for doc, tokens in zip(batch.column(0).slice(at, len(texts)).to_pylist(), encode(texts), strict=True) if tokens is not None]
                at += len(texts)
                made, place = batch_rows(part, place, rows)
                yield made
        batch_rows(part, place, None)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(run, schema)


def sequence_index(docs: DataFrame, vocabulary: str = VOCABULARY, length: int = LENGTH) -> DataFrame:
    """(doc_id, piece, n_tokens, part, place): the sequences, numbered within their partition."""

    def batch_rows(part, place, rows):
        if rows is None:
            return None
        ids, pieces, sizes = [], [], []
        for doc, tokens in rows:
            held = len(tokens) + 1
            n = -(-held // length)
            ids += [doc] * n
            pieces += range(n)
            sizes += [length] * (n - 1) + [held - (n - 1) * length]
        n = len(ids)
        arrays = [pa.array(ids, pa.int64()), pa.array(pieces, pa.int32()), pa.array(sizes, pa.int32()), pa.array([part] * n, pa.int32()), pa.array(range(place, place + n), pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "piece", "n_tokens", "part", "place"]), place + n

    return _tokens(docs, vocabulary, batch_rows, "doc_id long, piece int, n_tokens int, part int, place long")


def _records(docs: DataFrame, vocabulary: str, length: int, per_shard: int, key: int, starts, count: int) -> DataFrame:
    """(shard, slot, tokens) of every sequence; ``starts`` broadcasts {part: (first number, sequences)}."""

    def batch_rows(part, place, rows):
        first, expected = starts.value.get(part, (0, 0))
        bodies = []
        for _, tokens in rows or ():
            padded = np.full(-(-(len(tokens) + 1) // length) * length, END, "<u2")
            padded[: len(tokens)] = tokens
            bodies += [row.tobytes() for row in padded.reshape(-1, length)]
        n = len(bodies)
        if place + n > expected or rows is None and place != expected:
            raise RuntimeError(f"partition {part} has other rows than in the first pass: {place + n} sequences, not {expected}")
        slots = permute(first + place + np.arange(n), count, key)
        arrays = [pa.array((slots // per_shard).astype(np.int32)), pa.array(slots), pa.array(bodies, pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, names=["shard", "slot", "tokens"]), place + n

    return _tokens(docs, vocabulary, batch_rows, "shard int, slot long, tokens binary")


def write_shards(docs: DataFrame, path: str | None = None, vocabulary: str = VOCABULARY, length: int = LENGTH, per_shard: int = PER_SHARD, key: int = KEY) -> TokenShards:
    """Write the shards of ``docs`` (doc_id, text) to ``path`` (default: a new folder in the shared folder)."""
    spark = docs.sparkSession
    path = path or f"{shared_dir(spark).rstrip('/')}/token-shards-{uuid.uuid4().hex}"
    index = stored(sequence_index(docs, vocabulary, length), "token-index")
    sizes = index.groupBy("part").count().collect()  # a pair of numbers for each task of the first pass
    starts, count = {}, 0
    for part, n in sorted((r[0], r[1]) for r in sizes):
        starts[part], count = (count, n), count + n
    shared = spark.sparkContext.broadcast(starts)
    if count:
        records = _records(docs, vocabulary, length, per_shard, key, shared, count)
        by_range = records.repartitionById(-(-count // per_shard), F.col("shard")).sortWithinPartitions("slot")
        by_range.select(F.col("tokens").cast("string").alias("value")).write.mode("overwrite").text(path)

    def place(batches):
        for batch in batches:
            parts, places = batch.column(3).to_pylist(), batch.column(4).to_numpy(zero_copy_only=False)
            numbers = np.array([shared.value[p][0] for p in parts], np.int64) + places
            slots = permute(numbers, count, key)
            made = [pa.array(slots), pa.array((slots // per_shard).astype(np.int32)), pa.array((slots % per_shard).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *made], names=["doc_id", "piece", "n_tokens", "slot", "shard", "record"])

    listed = index.mapInArrow(place, "doc_id long, piece int, n_tokens int, slot long, shard int, record int")
    return TokenShards(listed, path, count, length, per_shard)


def op5_token_shards(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    made = write_shards(docs)
    return made.sequences.withColumn("offset", F.col("record").cast("long") * made.stride)
