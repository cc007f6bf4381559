"""Sharding by fixed virtual slots and a versioned slot-to-shard map.

A record's slot is a hash of its id and text modulo ``SLOTS`` and never changes.
A small table maps every slot to a shard, one set of rows for each version:
version 0 deals the slots round, ``rebalance`` writes a next version from the
bytes that each slot holds, and ``grow`` one in which a new shard takes slots only into itself.
Records move only when their slot does.

Main path: DataFrame and SQL expressions. Records are shuffled only where row
numbers are asked for; the map has ``SLOTS`` rows, whatever the input, and so
is joined by broadcast and handled in one task.

Law of the query: ``bytes``. Rebalancing keeps, in every shard, its largest
slots up to ``KEEP`` of the mean, frees the rest (the smallest ones), and
deals the freed slots, largest first, each to the shard with fewest bytes.

Edge cases: null text has size 1 and CRC 0; rows without an id are spread by
their text; rows equal in id and text share a slot; empty tables give no rows.
A slot larger than the mean cannot be split and bounds the balance.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, free_names

SLOTS = 4096
SHARDS = 16
KEEP = 0.97
#: Most places that one array holds while a repeated row is written out.
RUN = 65_536


def slot_of(doc_id, text_crc32, slots: int = SLOTS) -> F.Column:
    return F.pmod(F.xxhash64(doc_id, text_crc32), F.lit(slots)).cast("int")


def size_of(text) -> F.Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def crc_of(text) -> F.Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def first_map(spark: SparkSession, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """Version 0: the slots dealt round."""
    return spark.range(slots).select(F.lit(0).alias("version"), F.col("id").cast("int").alias("slot"), (F.col("id") % shards).cast("int").alias("shard"))


def slot_bytes(slots_and_sizes: DataFrame) -> DataFrame:
    """(slot, bytes, rows) for rows of (slot, size): a map-side combined sum."""
    return slots_and_sizes.groupBy("slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))


def latest(versions: DataFrame) -> DataFrame:
    """The rows of the newest version of a map."""
    return versions.withColumn("newest", F.max("version").over(Window.partitionBy(F.lit(0)))).where("version = newest").drop("newest")


def _dealt(freed: DataFrame, loads: DataFrame) -> DataFrame:
    """(slot, shard): freed slots, largest first, each to the shard with fewest bytes (ties: the lowest shard).

    ``freed`` (slot, bytes) and ``loads`` (shard, load) are bounded by the map's size.
    """
    items = freed.select(F.struct("bytes", (-F.col("slot")).alias("slot")).alias("item")).unionByName(loads.select(F.struct("shard", "load").alias("held")), allowMissingColumns=True)
    both = items.agg(F.sort_array(F.collect_list("item"), asc=False).alias("queue"), F.sort_array(F.collect_list("held")).alias("start"))

    def step(state, item):
        best = F.array_position(state["loads"], F.array_min(state["loads"])).cast("int")
        fuller = F.transform(state["loads"], lambda x, i: F.when(i + 1 == best, x + item["bytes"]).otherwise(x))
        return F.struct(fuller.alias("loads"), best.alias("best"), F.concat(state["to"], F.array(best)).alias("to"))

    init = F.struct(F.transform("start", lambda s: s["load"].cast("long")).alias("loads"), F.lit(1).alias("best"), F.array().cast("array<int>").alias("to"))
    dealt = both.select("queue", "start", F.aggregate("queue", init, step)["to"].alias("to"))
    pairs = dealt.select("start", F.explode(F.arrays_zip("queue", "to")).alias("x"))
    return pairs.select((-F.col("x.queue.slot")).alias("slot"), F.element_at("start", F.col("x.to"))["shard"].alias("shard"))


def rebalance(current: DataFrame, by_slot: DataFrame, keep: float = KEEP) -> DataFrame:
    """The next version: shards above ``keep`` of the mean give up their smallest slots, which fill the lightest shards."""
    loaded = current.join(F.broadcast(by_slot), "slot", "left").select("version", "slot", "shard", F.coalesce("bytes", F.lit(0)).alias("bytes"))
    running = Window.partitionBy("shard").orderBy(F.desc("bytes"), "slot").rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.partitionBy(F.lit(0))
    mean = F.sum("bytes").over(everything) / F.size(F.collect_set("shard").over(everything))
    marked = cut(loaded.withColumn("stays", F.sum("bytes").over(running) <= F.lit(keep) * mean))
    loads = marked.groupBy("shard").agg(F.sum(F.when(F.col("stays"), F.col("bytes")).otherwise(0)).alias("load"))
    moved = _dealt(marked.where("NOT stays").select("slot", "bytes"), loads).withColumnRenamed("shard", "to_shard")
    return marked.join(F.broadcast(moved), "slot", "left").select((F.col("version") + 1).alias("version"), "slot", F.coalesce("to_shard", "shard").cast("int").alias("shard"))


def grow(current: DataFrame, by_slot: DataFrame, new_shard: int) -> DataFrame:
    """The next version with one more shard: each shard hands it slots of about its fair share; no other slot moves."""
    loaded = current.join(F.broadcast(by_slot), "slot", "left").select("version", "slot", "shard", F.coalesce("bytes", F.lit(0)).alias("bytes"))
    own = Window.partitionBy("shard")
    running = own.orderBy(F.xxhash64("slot"), "slot").rowsBetween(Window.unboundedPreceding, 0)
    n = F.size(F.collect_set("shard").over(Window.partitionBy(F.lit(0))))
    gives = F.sum("bytes").over(running) <= F.sum("bytes").over(own) / (n + 1)
    return loaded.withColumn("gives", gives).select((F.col("version") + 1).alias("version"), "slot", F.when(F.col("gives"), F.lit(new_shard)).otherwise(F.col("shard")).cast("int").alias("shard"))


def shard_map(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, keep: float = KEEP) -> DataFrame:
    """Versions 0 (dealt round) and 1 (rebalanced by the bytes of ``docs``)."""
    rows = docs.select(slot_of(F.col("doc_id"), crc_of(F.col("text")), slots).alias("slot"), size_of(F.col("text")).alias("size"))
    by_slot = cut(slot_bytes(rows))
    start = first_map(docs.sparkSession, shards, slots)
    return cut(start.unionByName(rebalance(start, by_slot, keep)))


def assign(docs: DataFrame, versions: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``docs`` with ``shard`` from the newest version; records stay in place (broadcast of the map)."""
    shard, slot = free_names(docs, "shard", "shard_slot")
    newest = latest(versions).select(F.col("slot").alias(slot), F.col("shard").alias(shard))
    keyed = docs.withColumn(slot, slot_of(F.col("doc_id"), crc_of(F.col("text")), slots))
    return keyed.join(F.broadcast(newest), slot).select(*docs.columns, shard)


def numbered(records: DataFrame, versions: DataFrame) -> DataFrame:
    """Rows of (doc_id, size, text_crc32, vslot) with ``shard`` and ``slot``, the row's place in its shard, gapless from 0.

    Equal rows are counted first, so a row repeated without end is one row until
    it is written out; places run within virtual slots, which start where the
    slots before them in the shard end.
    """
    counted = cut(records.groupBy("vslot", "doc_id", "size", "text_crc32").count())
    newest = latest(versions).select(F.col("slot").alias("vslot"), "shard")
    starts = counted.groupBy("vslot").agg(F.sum("count").alias("n")).join(F.broadcast(newest), "vslot")
    before = Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select("vslot", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("skip", F.coalesce(F.sum("count").over(inside), F.lit(0))).join(F.broadcast(starts), "vslot")
    place, end = F.col("start") + F.col("skip"), F.col("start") + F.col("skip") + F.col("count")
    # written out in runs of a bounded length, so no array grows with the count
    runs = placed.withColumn("run", F.explode(F.sequence(place, end - 1, F.lit(RUN).cast("long"))))
    return runs.withColumn("slot", F.explode(F.sequence("run", F.least(F.col("run") + RUN, end) - 1))).drop("start", "skip", "count", "run")


def op7_shards(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    records = docs.select("doc_id", size_of(F.col("text")).alias("size"), crc_of(F.col("text")).alias("text_crc32"))
    records = cut(records.withColumn("vslot", slot_of(F.col("doc_id"), F.col("text_crc32"))))
    by_slot = cut(slot_bytes(records.select(F.col("vslot").alias("slot"), "size")))
    start = first_map(spark)
    versions = cut(start.unionByName(rebalance(start, by_slot)))
    return numbered(records, versions).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), F.col("vslot").alias("virtual_slot")
    )
