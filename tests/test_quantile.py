import math
import random

import pytest
from pyspark.sql import functions as F

from stationwise.operators import exact_percentile


def data(seed, n=20000):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        r = rnd.random()
        key = "hot" if r < 0.35 else (None if r < 0.4 else f"g{rnd.randrange(12)}")
        v = None if rnd.random() < 0.02 else float(rnd.choice([rnd.randrange(50), rnd.lognormvariate(10, 2)]))
        out.append((key, v))
    out += [("tiny", 3.0), ("even", 1.0), ("even", 2.0), ("even", 3.0), ("even", 4.0), ("nulls", None)]
    return out


def brute_disc(vals, p):
    vals = sorted(v for v in vals if v is not None)
    if not vals:
        return None
    return vals[max(1, math.ceil(p * len(vals))) - 1]


def test_disc_matches_sort(spark):
    rows = data(11)
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r[0]: r[1] for r in exact_percentile(df, ["k"], "v", 0.5, False, "m").collect()}
    groups = {}
    for k, v in rows:
        groups.setdefault(k, []).append(v)
    want = {k: brute_disc(vs, 0.5) for k, vs in groups.items() if brute_disc(vs, 0.5) is not None}
    assert got == want
    assert got["even"] == 2.0


def test_interpolated_matches_spark_median(spark):
    df = spark.createDataFrame(data(5), "k string, v double")
    got = {r[0]: r[1] for r in exact_percentile(df, ["k"], "v", 0.5, True, "m").collect()}
    want = {r[0]: r[1] for r in df.groupBy("k").agg(F.median("v")).collect() if r[1] is not None}
    assert got == want
    assert got["even"] == 2.5


def test_other_percentiles(spark):
    rows = data(3, 5000)
    df = spark.createDataFrame(rows, "k string, v double")
    for p in (0.1, 0.9):
        got = {r[0]: r[1] for r in exact_percentile(df, ["k"], "v", p, True, "m").collect()}
        want = {r[0]: r[1] for r in df.groupBy("k").agg(F.percentile("v", p)).collect() if r[1] is not None}
        assert got == want


def test_two_keys_with_nulls(spark):
    keys = [("x", None), ("x", None), (None, "y"), (None, None)] * 5
    rows = [(a, b, float(v)) for v, (a, b) in enumerate(keys)]
    df = spark.createDataFrame(rows, "a string, b string, v double")
    got = {(r[0], r[1]): r[2] for r in exact_percentile(df, ["a", "b"], "v", 0.5).collect()}
    groups = {}
    for a, b, v in rows:
        groups.setdefault((a, b), []).append(v)
    assert got == {k: brute_disc(vs, 0.5) for k, vs in groups.items()}


@pytest.mark.parametrize("repeated", [0.4, 0.0])
def test_no_window_ranks_more_than_a_small_share(spark, monkeypatch, repeated):
    """A third way to read the plan: the rows that the later windows get, counted from the data."""
    import stationwise.operators.quantile as q

    n = 200_000
    v = F.when(F.rand(3) < repeated, F.lit(500.0)).otherwise(F.round(F.exp(F.randn(5) + 6), 3))
    df = spark.range(n).select(F.lit("one").alias("k"), v.alias("v")).cache()
    ranked, picked = [], q._picked

    def counted(counts, keys, order):
        ranked.append(counts.count())
        return picked(counts, keys, order)

    monkeypatch.setattr(q, "_picked", counted)
    got = exact_percentile(df, ["k"], "v", 0.5, True, "m").first()["m"]
    assert got == df.agg(F.median("v")).first()[0]
    assert len(ranked) == 2 and max(ranked) < 0.05 * n
    df.unpersist()


def test_a_million_distinct_values_close_together(spark, monkeypatch):
    """Values within one part in a thousand million of each other share a bin; the slices still part them."""
    import stationwise.operators.quantile as q

    n = 1_000_001
    df = spark.range(n).select(F.lit("one").alias("k"), (F.lit(1e6) + F.pmod(F.col("id") * 7919, F.lit(n)) / 1e9).alias("v"))
    bins = df.select(q._bin(F.col("v")).alias("b")).groupBy("b").count()
    assert bins.count() <= 9  # a bin is some 85 wide here: all values lie in one or in neighbours
    ranked, picked = [], q._picked

    def counted(counts, keys, order):
        ranked.append(counts.count())
        return picked(counts, keys, order)

    monkeypatch.setattr(q, "_picked", counted)
    got = exact_percentile(df, ["k"], "v", 0.5, False, "m").first()["m"]
    assert got == 1e6 + 500_000 / 1e9
    assert ranked[1] < 10  # of a million distinct values, those of one slice


def test_bins_never_fall(spark):
    import stationwise.operators.quantile as q

    rng = random.Random(8)
    values = sorted({0.0, -0.0, 5e-324, -5e-324, 1.7e308, -1.7e308, float("inf"), float("-inf"), *(rng.uniform(-1, 1) * 10.0 ** rng.randrange(-300, 300) for _ in range(2000))})
    got = [r[0] for r in spark.createDataFrame([(v,) for v in [*values, float("nan")]], "v double").coalesce(1).select(q._bin(F.col("v"))).collect()]
    assert got == sorted(got)
    assert got[-1] > got[-2] and got[0] < got[1]


def test_extremes(spark):
    inf = float("inf")
    rows = spark.createDataFrame([(v,) for v in (-inf, -1e300, -1.0, 0.0, 1e-300, 1e300, inf)], "v double")
    assert [exact_percentile(rows, [], "v", p, False, "m").first()[0] for p in (0.01, 0.2, 0.5, 0.6, 1.0)] == [-inf, -1e300, 0.0, 1e-300, inf]


def test_no_keys_and_edges(spark):
    rows = spark.createDataFrame([(v,) for v in (-5.0, -5.0, 0.0, 2.0, 1e12, -1e12, None)], "v double")
    assert exact_percentile(rows, [], "v", 0.5, True, "m").collect() == [(-2.5,)]
    assert exact_percentile(rows.limit(0), [], "v", 0.5, True, "m").collect() == [(None,)]
    assert exact_percentile(rows, [], "v", 1.0, False, "m").first()[0] == 1e12
