"""Conversation prefix trie from vertical bitmaps.

Every turn is a key (MD5 of role and text) at a position. Conversations are dealt to shards
of about ``SHARD_TURNS`` turns; a shard indexes (position, turn) to the bitset of its
conversations, bit i being its i-th smallest id. Going depth first, the bitset of a node less
that of the conversations that end there is taken apart: the lowest bit names a turn, the
intersection with that turn's postings is a child, and what it holds is struck out. Popcounts,
lowest bits and end lists come from the bitsets.

A node is known by its path, an MD5 chained over the turns. Nodes that one shard alone has are
finished there, their subtrees too, since members of a descendant are members of the node. Nodes of several
shards form the top of the trie: their counts are added up by path, and subtree sums rise
through them by pointer doubling, in as many rounds as their depth has binary digits. No row
but a shard's own bitsets is gathered: end lists of shared nodes are sorted by range and hashed as a stream of pieces.

Edge cases: a null role or text is empty; rows without a conversation id belong to no
conversation; turns of equal number are ordered by their keys, equal turns count as often as
they stand there; a turn without a number comes first; an empty table has no node, not even the
root. Other columns are not looked at. A conversation lies whole in one shard (16 bytes
for a turn, and one posting for each of its own turns), and SHA-256 of a node's end list is one task's stream, however many end there.
"""

from __future__ import annotations

import hashlib
import math

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, crc32_of, cut, stored

SHARD_TURNS = 16_384
#: Conversations of a group borrow their first turns from the group's first one: at most ``BORROWED - 1``.
GROUP = 20
BORROWED = 4
#: Characters of an end list that are joined at a time.
PIECE = 1 << 20
ROOT = hashlib.md5(b"").digest()

NODE = "path binary, parent binary, key binary, depth long, conv_id long, parent_conv_id long, n_convs long, words long, n_children long, n_leaves long, saved_tokens long, ends array<long>"


def turn_key(role, text) -> F.Column:
    """MD5 of a turn; the role's length keeps (role, text) pairs apart."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, key, words): turns of each conversation, numbered from 1."""
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        turn_key(F.col("role"), F.col("text")).alias("key"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("words"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "key")
    return rows.select("conv_id", F.row_number().over(order).alias("pos"), "key", "words")


def rebuilt_turns(turns: DataFrame, group: int = GROUP, borrowed: int = BORROWED) -> DataFrame:
    """The turns, of which the first crc32(id) % ``borrowed`` are those of the first conversation of the id's group.

    Positions keep the order but may leave gaps; a conversation left without turns has one row, its ``pos`` null.
    """
    h = F.pmod(crc32_of(F.col("conv_id")), F.lit(borrowed))
    own = turns.where(F.col("pos") > h)
    heads = turns.where((F.col("pos") < borrowed) & (F.col("conv_id") % group == 0)).withColumnRenamed("conv_id", "head")
    convs = turns.where("pos = 1").select("conv_id", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % group).alias("first"))
    taken = convs.join(heads, (F.col("first") == F.col("head")) & (F.col("pos") <= F.col("h")), "left")
    return taken.select(*turns.columns).unionByName(own)


def shard_nodes(table: pa.Table) -> pa.Table:
    """The trie of one shard's conversations: rows (conv_id, pos, key, words) in any order."""
    table = table.sort_by([("conv_id", "ascending"), ("pos", "ascending")])
    ids: list[int] = []
    turns: list[list[int]] = []
    numbers: dict[bytes, int] = {}
    words: list[int] = []
    for conv, pos, key, n in zip(*(table.column(c).to_pylist() for c in ("conv_id", "pos", "key", "words")), strict=True):
        if not ids or ids[-1] != conv:
            ids.append(conv)
            turns.append([])
        if pos is not None:
            t = numbers.setdefault(key, len(numbers))
            if t == len(words):
                words.append(n)
            turns[-1].append(t)
    keys = list(numbers)
    postings: dict[tuple[int, int], int] = {}
    ended: dict[int, int] = {}
    for i, sequence in enumerate(turns):
        bit = 1 << i
        for d, t in enumerate(sequence):
            postings[d, t] = postings.get((d, t), 0) | bit
        ended[len(sequence)] = ended.get(len(sequence), 0) | bit

    path, parent, turn, depth, first, count, children, ends = ([] for _ in range(8))
    open_nodes = [((1 << len(ids)) - 1, -1, -1, 0)]
    while open_nodes:
        members, up, t, d = open_nodes.pop()
        here = len(path)
        path.append(hashlib.md5(path[up] + keys[t]).digest() if d else ROOT)
        parent.append(up)
        turn.append(t)
        depth.append(d)
        first.append((members & -members).bit_length() - 1)
        count.append(members.bit_count())
        rest = ended.get(d, 0) & members
        ends.append([ids[i] for i in _bits(rest)] or None)
        rest ^= members
        k = 0
        while rest:
            t = turns[(rest & -rest).bit_length() - 1][d]
            child = rest & postings[d, t]
            rest ^= child
            open_nodes.append((child, here, t, d + 1))
            k += 1
        children.append(k)
    leaves = [int(not k) for k in children]
    size = [words[t] if t >= 0 else 0 for t in turn]
    saved = [(n - 1) * w for n, w in zip(count, size, strict=True)]
    for i in range(len(path) - 1, 0, -1):  # a parent comes before its children
        leaves[parent[i]] += leaves[i]
        saved[parent[i]] += saved[i]
    inner = [p >= 0 for p in parent]
    columns = [
        path,
        [path[p] if x else None for p, x in zip(parent, inner, strict=True)],
        [keys[t] if x else None for t, x in zip(turn, inner, strict=True)],
        depth,
        [ids[i] for i in first],
        [ids[first[p]] if x else None for p, x in zip(parent, inner, strict=True)],
        count,
        size,
        children,
        leaves,
        saved,
        ends,
    ]
    kinds = [pa.binary()] * 3 + [pa.int64()] * 8 + [pa.list_(pa.int64())]
    names = [x.split()[0] for x in NODE.split(", ")]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _bits(bitset: int):
    while bitset:
        low = bitset & -bitset
        yield low.bit_length() - 1
        bitset ^= low


def _risen(top: DataFrame) -> DataFrame:
    """(path, n_leaves, saved_tokens) summed over the subtrees of ``top`` (path, parent, depth, n_leaves, saved_tokens)."""
    now, reach = top.withColumnRenamed("parent", "up"), 1
    deepest = top.agg(F.max("depth")).first()[0] or 0
    while reach <= deepest:
        # each node has the sums of its next ``reach`` levels and knows the ancestor that many levels up
        given = now.where(F.col("up").isNotNull()).groupBy(F.col("up").alias("path")).agg(F.sum("n_leaves").alias("more"), F.sum("saved_tokens").alias("more_saved"))
        above = now.select(F.col("path").alias("up"), F.col("up").alias("next"))
        far = now.where(F.col("depth") >= 2 * reach).join(above, "up").drop("up").withColumnRenamed("next", "up")
        near = now.where(F.col("depth") < 2 * reach).withColumn("up", F.lit(None).cast("binary"))
        both = far.unionByName(near).join(given, "path", "left")
        now = cut(both.select("path", "up", "depth", *((F.col(c) + F.coalesce(x, F.lit(0))).alias(c) for c, x in (("n_leaves", "more"), ("saved_tokens", "more_saved")))))
        reach *= 2
    return now.select("path", "n_leaves", "saved_tokens")


def _pieces(batches):
    """(path, first, piece) of rows (path, conv_id) in order: ids joined by commas, about ``PIECE`` characters at a time."""
    path, ids, size = None, [], 0

    def made():
        return pa.RecordBatch.from_pydict({"path": pa.array([path], pa.binary()), "first": pa.array([ids[0]], pa.int64()), "piece": [",".join(map(str, ids))]})

    for batch in batches:
        for p, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if ids and (p != path or size > PIECE):
                yield made()
                ids, size = [], 0
            path = p
            ids.append(c)
            size += len(str(c)) + 1
    if ids:
        yield made()


def _digests(batches):
    """(path, digest) of rows (path, first, piece) in order."""
    path, state = None, None
    for batch in batches:
        done: list[tuple[bytes, str]] = []
        for p, piece in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if p != path:
                if state:
                    done.append((path, state.hexdigest()))
                path, state = p, hashlib.sha256()
            else:
                state.update(b",")
            state.update(piece.encode())
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.binary()), pa.array([x[1] for x in done], pa.string())], names=["path", "digest"])
    if state:
        yield pa.RecordBatch.from_arrays([pa.array([path], pa.binary()), pa.array([state.hexdigest()], pa.string())], names=["path", "digest"])


def prefix_trie(turns: DataFrame, shard_turns: int = SHARD_TURNS, together: F.Column | None = None) -> DataFrame:
    """Nodes of the conversations' turns (conv_id, pos, key, words).

    Conversations of equal ``together`` (a column, by default the id) lie in one shard: where they are known to share
    prefixes, fewer nodes are split. The result is the same. Returns path, parent (path), key (of the last turn; ``turn_texts`` names it), depth, conv_id (smallest member),
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256.
    """
    turns = stored(turns, "trie-turns")
    shards = max(1, math.ceil(turns.count() / shard_turns))
    dealt = turns.withColumn("shard", F.pmod(F.xxhash64(F.col("conv_id") if together is None else together), F.lit(shards)))
    nodes = dealt.groupBy("shard").applyInArrow(shard_nodes, NODE)
    nodes = stored(nodes.withColumn("shards", F.count(F.lit(1)).over(Window.partitionBy("path"))), "trie-nodes")
    alone, several = nodes.where("shards = 1"), nodes.where("shards > 1")

    # what does not follow from the path is added up; the rest are grouping keys, so the aggregate stays a hash aggregate
    top = several.groupBy("path", "parent", "key", "depth", "words").agg(F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"))
    below = alone.groupBy(F.col("parent").alias("path")).agg(F.count(F.lit(1)).alias("k"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    inside = top.groupBy(F.col("parent").alias("path")).agg(F.count(F.lit(1)).alias("k_top"))
    top = top.join(below, "path", "left").join(inside, "path", "left")
    children = F.coalesce("k", F.lit(0)) + F.coalesce("k_top", F.lit(0))
    top = top.select(
        "path",
        "parent",
        "key",
        "depth",
        "conv_id",
        "n_convs",
        children.alias("n_children"),
        F.when(children == 0, 1).otherwise(F.coalesce("n_leaves", F.lit(0))).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("words") + F.coalesce("saved_tokens", F.lit(0))).alias("saved_tokens"),
    )
    top = cut(top)
    sums = _risen(top.select("path", "parent", "depth", "n_leaves", "saved_tokens"))

    ends = several.where(F.col("ends").isNotNull()).select("path", F.explode("ends").alias("conv_id"))
    ranged = ends.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    pieces = ranged.mapInArrow(_pieces, "path binary, first long, piece string")
    digests = pieces.repartition("path").sortWithinPartitions("path", "first").mapInArrow(_digests, "path binary, digest string")

    empty = hashlib.sha256(b"").hexdigest()
    joined = top.drop("n_leaves", "saved_tokens").join(sums, "path").join(digests, "path", "left")
    joined = joined.withColumn("ends_sha256", F.coalesce("digest", F.lit(empty))).drop("digest").withColumn("local", F.lit(None).cast("long"))
    own = F.sha2(F.coalesce(F.array_join(F.col("ends").cast("array<string>"), ","), F.lit("")), 256)
    whole = alone.withColumn("ends_sha256", own).withColumnRenamed("parent_conv_id", "local").select(*joined.columns).unionByName(joined)
    parents = top.select(F.col("path").alias("parent"), F.col("conv_id").alias("shared"))
    return whole.join(parents, "parent", "left").select(
        "path", "parent", "key", "depth", "conv_id", F.coalesce("shared", "local").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


def turn_texts(conversations: DataFrame) -> DataFrame:
    """(key, role, text) of the distinct turns, for the nodes' ``key``."""
    role, text = (F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text"))
    return conversations.where(F.col("conv_id").isNotNull()).select(turn_key(F.col("role"), F.col("text")).alias("key"), role, text).distinct()


def op11_prefix_trie(spark, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    nodes = prefix_trie(rebuilt_turns(stored(ordered_turns(conversations), "trie-ordered")), together=F.col("conv_id") - F.col("conv_id") % GROUP)
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


#: CRC-32 bit by bit over the decimal digits; nodes are prefixes of lists of turn hashes, and each adds to all of its ancestors.
OP11_SQL = r"""
WITH t AS (SELECT conv_id, md5(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
      len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w, turn FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn ASC NULLS FIRST, k) AS pos FROM t),
steps AS (SELECT DISTINCT conv_id, flatten([[1000 + ascii(x), 0, 0, 0, 0, 0, 0, 0, 0] FOR x IN string_split(CAST(conv_id AS VARCHAR), '')]) AS s FROM o),
c AS (SELECT conv_id, conv_id - conv_id % 20 AS b, xor(list_reduce(list_prepend(4294967295::BIGINT, [CAST(x AS BIGINT) FOR x IN s]),
      lambda a, y: CASE WHEN y > 0 THEN xor(a, y - 1000) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384::BIGINT) ELSE a // 2 END), 4294967295::BIGINT) % 4 AS h FROM steps),
r AS (SELECT c.conv_id, pos, k, w FROM c JOIN o ON o.conv_id = c.b AND pos <= h UNION ALL SELECT o.conv_id, pos, k, w FROM o JOIN c USING (conv_id) WHERE pos > h),
s AS (SELECT c.conv_id, coalesce(list(k ORDER BY pos) FILTER (k IS NOT NULL), []) AS ks, coalesce(list(w ORDER BY pos) FILTER (k IS NOT NULL), []) AS ws FROM c LEFT JOIN r USING (conv_id) GROUP BY c.conv_id),
m AS (SELECT conv_id, len(ks) AS n, d, array_to_string(ks[1:d], '') AS p, array_to_string(ks[1:d-1], '') AS up, CASE WHEN d > 0 THEN ws[d] ELSE 0 END AS w FROM (SELECT *, unnest(range(0, len(ks) + 1)) AS d FROM s)),
v AS (SELECT p, d, any_value(up) AS up, any_value(w) AS w, min(conv_id) AS conv_id, count(*) AS n_convs,
      sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256 FROM m GROUP BY p, d),
kids AS (SELECT up, d - 1 AS d, count(*) AS n_children FROM v WHERE d > 0 GROUP BY up, d),
f AS (SELECT v.*, coalesce(n_children, 0) AS n_children FROM v LEFT JOIN kids ON kids.up = v.p AND kids.d = v.d),
sums AS (SELECT substr(p, 1, 32 * a) AS p, a AS d, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * w) AS saved_tokens FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM f) GROUP BY substr(p, 1, 32 * a), a)
SELECT f.conv_id, CAST(f.d AS BIGINT) AS depth, q.conv_id AS parent_conv_id, CAST(f.n_convs AS BIGINT) AS n_convs, CAST(f.n_children AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, f.ends_sha256
FROM f JOIN sums USING (p, d) LEFT JOIN f q ON q.p = f.up AND q.d = f.d - 1
"""
