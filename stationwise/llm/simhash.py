"""SimHash near-duplicates: sharded vantage-point trees over 64-bit fingerprints.

1. Fingerprints are made in Arrow batches (words, shingles, XXH64, majority of
   each bit) and kept with the ids: 16 bytes a document.
2. Equal fingerprints are merged first (map-side combined), so a group of
   exact copies is one point, however large.
3. A vantage-point tree over a bounded sample divides the space into shards by
   Hamming distance: a node holds a vantage point and a radius; nearer points
   go left. Every point has one home shard and is sent as a query to each
   later shard that its ball of ``max_bits`` overlaps (triangle bounds; the
   partner of a pair is found from the earlier side), so no pair is lost.
4. Each shard builds its own vantage-point tree in numpy and prunes with the
   same bounds; leaves are compared whole. A shard that many queries reach is
   worked on in blocks of queries, each beside all of its members, so a task's
   rows stay bounded however many balls overlap. A block returns a spanning forest
   of its links, not the links: at most one edge for each point it received.
5. Components come from rounds of large-star and small-star over the edges
   (joins and map-side combined minima), checkpointed until they stand still.

Edge cases: null, empty and white-space texts have fingerprint 0 and are linked
like any other; a document without an id belongs to its component but lends it
no id (a component without any id has a null one); repeated rows are one point;
an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append_columns, cut, free_names

SHINGLE = 4
MAX_BITS = 4
#: Points that a shard is meant to hold, and points from which the dividing tree is fitted at most.
SHARD_POINTS = 30_000
SAMPLE_POINTS = 40_000
#: Queries that a block is meant to hold.
BLOCK_QUERIES = 500_000
LEAF = 128
#: Shingles whose bits are counted at a time.
BLOCK = 1 << 16


def fingerprint(text: bytes | None, width: int = SHINGLE) -> int:
    """64-bit SimHash of a UTF-8 text: a bit is set if more than half of the shingles' hashes have it."""
    import xxhash

    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(joined, 42)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    n = len(words) - width + 1
    starts = np.concatenate(([0], gaps[: n - 1] + 1)).tolist()
    ends = np.concatenate((gaps[width - 1 :], [len(joined)])).tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for lo in range(0, n, BLOCK):
        hashes = np.array([digest(joined[a:z], 42) for a, z in zip(starts[lo : lo + BLOCK], ends[lo : lo + BLOCK], strict=True)], dtype=">u8")
        ones += np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n).view(">u8")[0])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, text: str = "text", width: int = SHINGLE) -> DataFrame:
    """``docs`` with ``fp``: the fingerprint as a signed long."""
    name = free_names(docs, "fp")[0]
    return append_columns(docs, text, [T.StructField(name, T.LongType())], lambda: lambda texts: [[_signed(fingerprint(t, width)) for t in texts]])


def _distance(a, b) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int16)


def fit_tree(sample: np.ndarray, leaves: int, seed: int = 7) -> list[tuple]:
    """Nodes (vantage point, radius, left, right) in a list; a child below 0 is shard ``-1 - child``. The largest part is divided next."""
    rng = np.random.default_rng(seed)
    nodes: list[list] = []
    parts: list[tuple] = [(sample, None)]  # (points, slot in the parent: (node, side))
    stuck: list[tuple] = []
    while parts and len(parts) + len(stuck) < leaves:
        parts.sort(key=lambda p: len(p[0]))
        points, parent = parts.pop()
        best = None
        for v in rng.choice(points, size=min(5, len(points)), replace=False) if len(points) > 1 else []:
            d = _distance(points, v)
            radius = int(np.median(d))
            radius = radius if (d <= radius).mean() < 0.9 else radius - 1
            left = d <= radius
            if 0 < left.sum() < len(points):
                cost = (d <= radius + MAX_BITS).sum() + (d > radius - MAX_BITS).sum() + abs(int(2 * left.sum()) - len(points))
                if best is None or cost < best[0]:
                    best = (cost, v, radius, left)
        if best is None:
            stuck.append((points, parent))
            continue
        _, v, radius, left = best
        nodes.append([int(v), radius, None, None])
        if parent:
            nodes[parent[0]][2 + parent[1]] = len(nodes) - 1
        parts += [(points[left], (len(nodes) - 1, 0)), (points[~left], (len(nodes) - 1, 1))]
    for shard, (_, parent) in enumerate([*parts, *stuck]):
        if parent:
            nodes[parent[0]][2 + parent[1]] = -1 - shard
    return [tuple(n) for n in nodes]


def route(points: np.ndarray, nodes: list[tuple], max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the point, shard, whether it is the point's home) for every shard that a point's ball overlaps."""
    out: list[tuple] = []
    stack = [(0 if nodes else -1, np.arange(len(points)), np.ones(len(points), bool))]
    while stack:
        at, who, home = stack.pop()
        if not len(who):
            continue
        if at < 0:
            out.append((who, np.full(len(who), -1 - at, np.int32), home))
            continue
        v, radius, left, right = nodes[at]
        d = _distance(points[who], np.uint64(v))
        for child, near, inside in ((left, d - max_bits <= radius, d <= radius), (right, d + max_bits > radius, d > radius)):
            stack.append((child, who[near], home[near] & inside[near]))
    who, shard, home = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, int), np.zeros(0, np.int32), np.zeros(0, bool))
    own = np.empty(len(points), np.int32)
    own[who[home]] = shard[home]
    later = home | (shard > own[who])
    return who[later], shard[later], home[later]


class _Forest:
    """Union of points by links found a row at a time."""

    def __init__(self, n: int):
        self.root = list(range(n))

    def find(self, x: int) -> int:
        root = self.root
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    def union(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.root[max(a, b)] = min(a, b)


def shard_links(members: np.ndarray, queries: np.ndarray, max_bits: int = MAX_BITS, leaf: int = LEAF, seed: int = 7, inner: bool = True) -> list[tuple[int, int]]:
    """Spanning forest, as edges (point, root), of the links of members with the queries and, if ``inner``, with each other.

    Points are numbered members first. Links of queries with each other belong
    to other shards. Distances of a leaf are taken in blocks of bounded size.
    """
    points = np.concatenate((members, queries))
    n, forest, rng = len(members), _Forest(len(points)), np.random.default_rng(seed)
    stack = [(np.arange(n), np.arange(0 if inner else n, len(points)))]
    while stack:
        own, ask = stack.pop()
        if not len(own) or not len(ask):
            continue
        halves = None
        if len(own) > leaf:
            for v in points[rng.choice(own, size=3)]:
                d_own = _distance(points[own], v)
                radius = int(np.median(d_own))
                if (d_own <= radius).all():
                    radius -= 1
                left = d_own <= radius
                if left.any() and (halves is None or abs(2 * left.sum() - len(own)) < halves[0]):
                    halves = (abs(int(2 * left.sum()) - len(own)), v, radius, left)
        if halves:
            _, v, radius, left = halves
            d = _distance(points[ask], v)
            stack += [(own[left], ask[d - max_bits <= radius]), (own[~left], ask[d + max_bits > radius])]
            continue
        step = max(1, (1 << 20) // len(own))
        mine = points[own]
        for lo in range(0, len(ask), step):
            rows, columns = np.nonzero(np.bitwise_count(points[ask[lo : lo + step], None] ^ mine[None, :]) <= max_bits)
            if not len(rows):
                continue
            a, b = ask[lo : lo + step][rows], own[columns]
            once = a > b  # a member pair is seen from both sides; queries have the larger numbers
            roots = np.fromiter(map(forest.find, own.tolist()), np.int64, len(own))
            met = np.unique(a[once] * len(points) + roots[columns[once]])  # each row meets a root once, however many of its points
            for x, y in zip((met // len(points)).tolist(), (met % len(points)).tolist(), strict=True):
                forest.union(x, y)
    return [(i, r) for i in range(len(points)) if (r := forest.find(i)) != i]


def query_blocks(sample: np.ndarray, nodes: list[tuple], n: int, max_bits: int = MAX_BITS, block_queries: int = BLOCK_QUERIES) -> np.ndarray:
    """Blocks of each shard: the queries that ``n`` points will send there, judged by the sample's, over ``block_queries``."""
    sent = np.zeros(len(nodes) + 1)
    for lo in range(0, len(sample), 2_000):
        _, shard, home = route(sample[lo : lo + 2_000], nodes, max_bits)
        sent += np.bincount(shard[~home], minlength=len(sent))
    return np.maximum(1, np.ceil(sent * n / max(len(sample), 1) / block_queries)).astype(np.int64)


def near_links(points: DataFrame, max_bits: int = MAX_BITS, shard_points: int = SHARD_POINTS, sample_points: int = SAMPLE_POINTS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """Edges (u, v) that join exactly the fingerprints of ``points`` (a column ``fp`` of distinct longs) linked at ``max_bits`` or fewer."""
    spark, n = points.sparkSession, points.count()
    sample = points.orderBy(F.xxhash64("fp"), "fp").limit(sample_points).collect() if n > shard_points else []
    fitted = np.array([r[0] for r in sample], np.int64).view(np.uint64)
    nodes = fit_tree(fitted, -(-n // shard_points)) if len(sample) else []
    tree = spark.sparkContext.broadcast((nodes, query_blocks(fitted, nodes, n, max_bits, block_queries)))

    def send(batches):
        nodes, blocks = tree.value
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for lo in range(0, len(own), 2_000):
                part = own[lo : lo + 2_000]
                who, shard, home = route(part, nodes, max_bits)
                fp, of = part[who], blocks[shard]
                # a query goes to one block of a shard, a member to all of them
                block = (fp * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % of
                for k in range(int(of.max(initial=1))):
                    at = np.where(home, of > k, block == k)
                    yield pa.RecordBatch.from_arrays([pa.array(shard[at], pa.int32()), pa.array(np.full(at.sum(), k, np.int32)), pa.array(fp[at].view(np.int64)), pa.array(home[at])], names=["shard", "block", "fp", "home"])

    def link(rows: pd.DataFrame) -> pd.DataFrame:
        fps, home = rows["fp"].to_numpy(), rows["home"].to_numpy()
        ordered = np.concatenate((fps[home], fps[~home]))
        first = len(rows) > 0 and rows["block"].iloc[0] == 0
        edges = shard_links(ordered[: home.sum()].view(np.uint64), ordered[home.sum() :].view(np.uint64), max_bits, inner=first)
        pairs = np.array(edges, np.int64).reshape(-1, 2)
        return pd.DataFrame({"u": ordered[pairs[:, 0]], "v": ordered[pairs[:, 1]]})

    sent = points.select("fp").mapInArrow(send, "shard int, block int, fp long, home boolean")
    return sent.groupBy("shard", "block").applyInPandas(link, "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v) but the roots; ``root`` is the component's least node. Large-star and small-star rounds."""

    def lower(pairs: DataFrame, both: bool) -> DataFrame:
        seen = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))) if both else pairs
        # stored before it is joined: the join then deals both sides itself, and a hub's rows can be split
        least = cut(seen.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        joined = seen.join(least, "u")
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v"), (F.col("v") > F.col("u")).alias("upper"))
        kept = moved.where("upper") if both else moved.select("u", "v").unionByName(least.select("u", F.col("m").alias("v")))
        return kept.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    edges = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = None
    while True:
        edges = cut(lower(lower(edges, True), False))
        # every node hangs on one node that hangs on none: a star forest
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if not now[0] or tuple(now) == mark:
            return edges.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
        mark = tuple(now)


def clusters(fps: DataFrame, max_bits: int = MAX_BITS, shard_points: int = SHARD_POINTS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """(fp, root) for the fingerprints that have a link to another one; ``fps`` has a column ``fp``."""
    points = cut(fps.select("fp").distinct())
    nodes = components(near_links(points, max_bits, shard_points, block_queries=block_queries))
    # the least node of each component is the root of the rest
    return nodes.unionByName(nodes.select(F.col("root").alias("node"), "root").distinct()).select(F.col("node").alias("fp"), "root")


def label(docs: DataFrame, width: int = SHINGLE, max_bits: int = MAX_BITS, shard_points: int = SHARD_POINTS) -> DataFrame:
    """(doc_id, fp, component_id) for rows of (doc_id, text)."""
    rows = cut(fingerprints(docs.select("doc_id", "text"), "text", width).select("doc_id", "fp"))
    linked = cut(clusters(rows, max_bits, shard_points))
    by_fp = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    rooted = cut(by_fp.join(linked, "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    ids = cut(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")))
    named = cut(rooted.join(ids, "root").select("fp", "component_id"))
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def drop_near_copies(docs: DataFrame, width: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each component, the one with the least id (of equal ids the text with the least hash), with its own columns.

    Rows are named by id and a 64-bit hash of the text; only the names of the
    dropped ones meet the documents again. Rows that share both leave one row, the least by their other columns as JSON.
    """
    name, h = free_names(docs, "simhash_id", "simhash_h")
    keyed = docs.select("doc_id", F.col("text"), F.xxhash64("text").alias("h"))
    rows = cut(fingerprints(keyed, "text", width).select("doc_id", "h", "fp"))
    linked = cut(clusters(rows, max_bits))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("h"))
    by_fp = cut(rows.groupBy("fp").agg(F.min(order).alias("best")))
    rooted = by_fp.join(linked, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    best = rooted.groupBy("root").agg(F.min("best").alias("best"))
    kept = cut(best.select(F.col("best.doc_id").alias(name), F.col("best.h").alias(h)))
    marked = docs.join(kept, F.col("doc_id").eqNullSafe(F.col(name)) & (F.xxhash64("text") == F.col(h)), "left_semi")
    many = rows.groupBy("doc_id", "h").count().where("count > 1")
    if many.isEmpty():
        return marked
    many = many.select(F.col("doc_id").alias(name), F.col("h").alias(h))
    on = F.col("doc_id").eqNullSafe(F.col(name)) & (F.xxhash64("text") == F.col(h))
    # a rank limit applies before the shuffle too, however many rows are equal
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    place = F.row_number().over(Window.partitionBy("doc_id", "text").orderBy(F.to_json(F.struct(F.lit(0).alias("_"), *others))))
    again = marked.join(many, on, "left_semi").withColumn(name, place).where(F.col(name) == 1).drop(name)
    return marked.join(many, on, "left_anti").unionByName(again)


def op4_simhash(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return label(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
