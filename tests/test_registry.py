import os

import duckdb
import pytest

import __spark_entry__ as ent
from conftest import SF_SMALL
from stationwise.plans.oracle import ORACLE_SQL
from stationwise.plans.queries import QUERIES
from stationwise.sources import fixtures as fx

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def test_entry_runs(spark):
    df = ent.entry(spark)
    assert df.count() > 0
    assert "avg_land_value" in df.columns


def test_every_query_has_reference_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(ent.queries()) and set(ORACLE_SQL) <= set(ent.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    return con


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def f(v):
        return f"{v:.9g}" if isinstance(v, float) else repr(v)

    return sorted("|".join(f(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_reference_sql(spark, duck, name):
    df = ent.queries()[name](spark, SF_SMALL)
    res = duck.execute(ent.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert canon(df.collect(), df.columns) == canon(res.fetchall(), dcols)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_building_a_query_runs_no_job(spark, monkeypatch, name):
    """The only jobs are Spark's own reads of the Parquet footers, one for each table read."""
    reads, table = [], fx.table
    monkeypatch.setattr(fx, "table", lambda *a: reads.append(a) or table(*a))
    scheduler = spark.sparkContext._jsc.sc().dagScheduler()
    before = scheduler.numTotalJobs()
    QUERIES[name](spark, SF_SMALL)
    assert scheduler.numTotalJobs() - before <= len(reads)
