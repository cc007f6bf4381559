"""Mixing sources to target weights by whole-document repetition.

Words are summed per source (map-side combined, so a source with a third of all
rows costs a task one buffer row). Each source's target is its weight times one
common level, at most ``max_epochs`` times its size; what a capped source leaves
is shared again by weight until no target is above its cap. A source's rate is
target over size; a document is emitted floor(rate) times plus one more time
with the rate's fraction as probability, drawn from a keyed MD5 of its id and
text, so reruns and retried tasks decide alike.

Only JVM expressions are used. The level is found from sums over the table of
sources: three numbers reach the driver in a round, whatever the count of sources (each round at
least halves either the words still to be shared or the weight of the sources below their caps, so rounds
grow with the logarithms of both), and the rank that gives a source its weight comes from a range partitioning
with per-partition offsets. The rates are joined by broadcast if the table of
sources is measured to be small, else by a join salted on both sides.

Edge cases: null text has size 0; the null source is a source, last in order;
a source of size 0 has target 0 and rate 0, so its documents (which hold no word)
are not emitted; rows equal in id and text are drawn alike; a table without words
has targets 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, cut, free_names

WEIGHTS = (5.0, 2.0, 1.0)
TOTAL = 1.5
MAX_EPOCHS = 2.0
SEED = "mix-1"
#: Sources whose rates are broadcast; more are joined by a salted shuffle.
BROADCAST_SOURCES = 50_000
SALTS = 16


def size_of(text) -> F.Column:
    """Words of a text, as a long; null has 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _ranked(sources: DataFrame) -> DataFrame:
    """``sources`` with ``place``, the 0-based rank by code point, null last, over any number of sources."""
    parts = cut(sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()))
    counts = {r[0]: r[1] for r in parts.groupBy("part").count().collect()}
    offsets, at = {}, 0
    for part in sorted(counts):
        offsets[part], at = at, at + counts[part]
    first = F.create_map(*(F.lit(x) for kv in offsets.items() for x in kv))[F.col("part")] if offsets else F.lit(0)
    within = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    return parts.withColumn("place", first + within - 1).drop("part")


def source_targets(sized: DataFrame, weights=WEIGHTS, total: float = TOTAL, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target, rate) for rows of (source, size)."""
    sources = cut(_ranked(sized.groupBy("source").agg(F.sum("size").alias("source_size"))))
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.pmod("place", F.lit(len(weights))) + 1).cast("int"))
    sources = sources.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * F.lit(float(max_epochs))).alias("cap"))
    want = (sources.agg(F.sum("source_size")).first()[0] or 0) * float(total)
    level, n_open = None, -1
    while True:  # Newton steps from below on a concave, piecewise linear sum; ends when no further source is capped
        free = F.lit(True) if level is None else F.col("cap") >= F.col("weight") * F.lit(level)
        given, open_weight, n = sources.agg(F.sum(F.when(~free, F.col("cap"))), F.sum(F.when(free, F.col("weight"))), F.count(F.when(free, 1))).first()
        if not n or n == n_open:
            break
        level, n_open = (want - (given or 0.0)) / open_weight, n
    target = F.least("cap", F.col("weight") * F.lit(level or 0.0))
    return sources.select("source", "source_size", target.alias("target"), F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0).alias("rate"))


def draw(doc_id, text, seed: str = SEED) -> F.Column:
    """Uniform in [0, 1) from 52 bits of a keyed MD5 of id and text."""
    key = F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("-")), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def mix_plan(docs: DataFrame, weights=WEIGHTS, total: float = TOTAL, max_epochs: float = MAX_EPOCHS, seed: str = SEED, broadcast_sources: int = BROADCAST_SOURCES) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``copies`` (how often the mix takes the document)."""
    size, source_size, target, copies, key, salt, rate, u = free_names(docs, "size", "source_size", "target", "copies", "mix_key", "mix_salt", "mix_rate", "mix_u")
    sized = docs.select(F.col("source"), size_of(F.col("text")).alias("size"))
    rates = cut(source_targets(sized, weights, total, max_epochs)).select(F.col("source").alias(key), F.col("source_size").alias(source_size), F.col("target").alias(target), F.col("rate").alias(rate))
    rows = docs.withColumn(size, size_of(F.col("text"))).withColumn(u, draw(F.col("doc_id"), F.col("text"), seed))
    n, n_bytes = rates.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(key)), F.lit(0))).first()
    if n <= broadcast_sources and n_bytes <= 256 * broadcast_sources:
        joined = rows.join(F.broadcast(rates), F.col("source").eqNullSafe(F.col(key)))
    else:
        rows = rows.withColumn(salt, F.floor(F.col(u) * SALTS).cast("int"))
        salted = rates.withColumn("salt_side", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = rows.join(salted, F.col("source").eqNullSafe(F.col(key)) & (F.col(salt) == F.col("salt_side"))).drop(salt, "salt_side")
    whole = F.floor(rate)
    taken = (whole + F.when(F.col(u) < F.col(rate) - whole, 1).otherwise(0)).cast("int")
    return joined.withColumn(copies, taken).drop(key, rate, u)


def mix(docs: DataFrame, **options) -> DataFrame:
    """Every document ``copies`` times, with its own columns."""
    plan = mix_plan(docs, **options)
    copies = plan.columns[-1]
    copy = free_names(plan, "mix_copy")[0]
    return plan.where(F.col(copies) > 0).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*docs.columns)


def op2_mix(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return mix_plan(docs).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


#: The common level over sources sorted by the level at which each is capped: the first source whose share is not above its cap sets it.
OP2_SQL = r"""
WITH d AS (SELECT doc_id, text, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT source, source_size, 2.0::DOUBLE * source_size AS cap,
      CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM s),
o AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS given,
      sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight FROM r),
l AS (SELECT coalesce(max(((SELECT sum(source_size) FROM s) * 1.5::DOUBLE - given) / open_weight)
      FILTER (((SELECT sum(source_size) FROM s) * 1.5::DOUBLE - given) / open_weight <= cap / weight), 0) AS level FROM o),
t AS (SELECT source, source_size, least(cap, weight * level) AS target FROM r, l),
u AS (SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
      CAST(('0x' || substr(md5(concat('mix-1:', coalesce(CAST(doc_id AS VARCHAR), '-'), ':', md5(coalesce(text, '')))), 1, 13)) AS BIGINT) / 4503599627370496.0::DOUBLE AS x
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST(size * (floor(rate) + CASE WHEN x < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM u
"""
