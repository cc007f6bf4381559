import os

import pytest
from pyspark.sql import functions as F

from stationwise.operators import gold_health_at, station_filter
from stationwise.sources import (
    centroid_table,
    read_delimited,
    read_parquet_checked,
    read_partitioned,
    write_parquet,
    write_partitioned,
    write_single_file,
)


def test_delimited_all_text_and_null_tokens(spark, tmp_path):
    p = tmp_path / "roll.csv"
    p.write_text("PID,CURRENT_LAND_VALUE,NOTE\n1,100,n/a\n2,NA,x\n3,,NULL\n")
    df = read_delimited(spark, str(p))
    assert dict(df.dtypes) == {"PID": "string", "CURRENT_LAND_VALUE": "string", "NOTE": "string"}
    assert [tuple(r) for r in df.collect()] == [("1", "100", None), ("2", None, "x"), ("3", None, None)]


def test_missing_parquet_raises(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_parquet_checked(spark, str(tmp_path / "nope"))


def test_partitioned_round_trip_keeps_text_keys(spark, tmp_path):
    out = str(tmp_path / "silver")
    rows = [("007", 1.0), ("10", 2.0), ("< 500m", 3.0), ("> 5km", 4.0), ("500m - 1km", 5.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    write_partitioned(df, out, "k")
    back = read_partitioned(spark, out, "k")
    assert dict(back.dtypes)["k"] == "string"
    assert sorted((r.k, r.v) for r in back.collect()) == sorted(rows)
    # one directory per value
    assert len([d for d in os.listdir(out) if d.startswith("k=")]) == 5


def test_bronze_write_replaces(spark, tmp_path):
    out = str(tmp_path / "bronze.parquet")
    write_parquet(spark.range(5), out)
    write_parquet(spark.range(3), out)
    assert read_parquet_checked(spark, out).count() == 3


def test_single_file_keeps_order(spark, tmp_path):
    out = str(tmp_path / "gold")
    df = spark.range(0, 1000, numPartitions=8).withColumn("v", (F.col("id") * 7919) % 1000).orderBy(F.col("v").desc())
    write_single_file(df, out)
    files = [f for f in os.listdir(out) if f.endswith(".parquet")]
    assert len(files) == 1
    import pyarrow.parquet as pq

    got = pq.read_table(os.path.join(out, files[0])).column("v").to_pylist()
    assert got == sorted(got, reverse=True)


def test_station_filter_case_and_null(spark):
    df = spark.createDataFrame([("Main Station",), ("main station",), (None,)], "stop_name string")
    assert [r[0] for r in station_filter(df).collect()] == ["Main Station"]


def test_centroid_literal(spark):
    df = centroid_table(spark)
    assert df.count() == 30
    assert df.where("neighbourhood_code = '26'").first().neighbourhood_lat == 49.2827


def test_gold_health_missing_and_present(spark, tmp_path):
    r = gold_health_at(spark, str(tmp_path / "none")).first()
    assert (r.status, r.gold_data_available, r.neighbourhood_count) == ("degraded", False, None)
    out = str(tmp_path / "ov")
    write_single_file(spark.createDataFrame([("1",), ("2",)], "neighbourhood_code string"), out)
    r = gold_health_at(spark, out).first()
    assert (r.status, r.gold_data_available, r.neighbourhood_count) == ("healthy", True, 2)


def test_partitioned_write_splits_a_hot_value(spark, tmp_path):
    out = str(tmp_path / "hot")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        df = spark.range(200_000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'cold' ELSE 'hot' END AS k", "id * 2 AS v")
        write_partitioned(df, out, "k")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    hot_files = [f for f in os.listdir(os.path.join(out, "k=hot")) if f.endswith(".parquet")]
    assert len(hot_files) > 1
    assert read_parquet_checked(spark, out).count() == 200_000


def _as_pandas_reads(path, **options):
    import pandas as pd

    frame = pd.read_csv(path, dtype=str, **options)
    return sorted(map(repr, frame.astype(object).where(frame.notna(), None).itertuples(index=False, name=None)))


QUOTED = 'PID,NOTE,V\n1,"say ""hi"", ok",20\n2,"a, b",NA\n3,back\\slash\\,30\n4,"ends with \\",40\n5,short\n6,"",50\n7,#N/A,NULL\n8,nan,n/a\n9,-nan,<NA>\n'


def test_quotes_short_rows_and_null_tokens_as_pandas(spark, tmp_path):
    p = tmp_path / "roll.csv"
    p.write_text(QUOTED)
    assert sorted(map(repr, map(tuple, read_delimited(spark, str(p)).collect()))) == _as_pandas_reads(p)


def test_quoted_line_break(spark, tmp_path):
    p = tmp_path / "roll.csv"
    p.write_text('PID,NOTE,V\n1,"two\nlines",20\n2,"x ""y""\n, z",3\n')
    got = read_delimited(spark, str(p), multi_line=True)
    assert sorted(map(repr, map(tuple, got.collect()))) == _as_pandas_reads(p)
    with pytest.raises(Exception, match="multi_line"):
        read_delimited(spark, str(p)).select("PID").collect()
    p.write_text('PID,NOTE\n1,"last\ncolumn"\n')
    with pytest.raises(Exception, match="multi_line"):
        read_delimited(spark, str(p)).select("PID").collect()


@pytest.mark.parametrize("columns", [["PID"], ["V"], ["PID", "V"]])
@pytest.mark.parametrize("multi_line", [False, True])
def test_too_many_fields_raise(spark, tmp_path, columns, multi_line):
    p = tmp_path / "roll.csv"
    p.write_text("PID,V\n1,2\n3,4,5\n")
    with pytest.raises(Exception, match="more than 2 fields"):
        read_delimited(spark, str(p), multi_line=multi_line).select(*columns).collect()


@pytest.mark.parametrize("columns", [["PID"], ["V"], ["PID", "V"]])
def test_files_with_other_headers_raise(spark, tmp_path, columns):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("PID,V\n10,1\n")
    (tmp_path / "in" / "b.csv").write_text("V,PID\n20,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_delimited(spark, str(tmp_path / "in")).select(*columns).collect()


def test_gold_health_empty_folder_and_zero_rows(spark, tmp_path):
    from stationwise.operators.serving import GoldDataMissing, stored_gold

    (tmp_path / "none").mkdir()
    assert gold_health_at(spark, str(tmp_path / "none")).first()["status"] == "degraded"
    write_parquet(spark.range(0), str(tmp_path / "zero"))
    zero = gold_health_at(spark, str(tmp_path / "zero")).first()
    assert (zero["status"], zero["gold_data_available"], zero["neighbourhood_count"]) == ("healthy", True, 0)
    assert stored_gold(spark, str(tmp_path / "zero")).count() == 0
    for missing in ("none", "absent"):
        with pytest.raises(GoldDataMissing):
            stored_gold(spark, str(tmp_path / missing))


WIDE = ["1,2,,x", "1,2,", "1,2,,", '1,"a,b",', '"1","say ""x"", y",z', "1,2,3,4,5", ',,"q"', '1,2,"', '"a""",b,c']


@pytest.mark.parametrize("record", WIDE[:-2] + WIDE[-1:])
@pytest.mark.parametrize("multi_line", [False, True])
def test_every_wide_row_raises_as_in_pandas(spark, tmp_path, record, multi_line):
    import pandas as pd

    for before in (["3,4"], ["3,4", "5,6", "7"]):
        p = tmp_path / f"roll{len(before)}.csv"
        p.write_text("\n".join(["A,B", *before, record, "8,9"]) + "\n")
        with pytest.raises(pd.errors.ParserError):
            pd.read_csv(p, dtype=str)
        with pytest.raises(Exception, match="more than 2 fields"):
            read_delimited(spark, str(p), multi_line=multi_line).select("B" if len(before) > 1 else "A").collect()


def test_rows_that_are_not_wide(spark, tmp_path):
    p = tmp_path / "roll.csv"
    p.write_text('A,B\n1\n"x,y","a "",b"" c"\nq"",r\n2,in "the" field\n"",\n"a,""b"\n')
    for multi_line in (False, True):
        assert sorted(map(repr, map(tuple, read_delimited(spark, str(p), multi_line=multi_line).collect()))) == _as_pandas_reads(p)


def test_field_count(spark):
    from stationwise.sources.files import field_count

    cases = {"": 1, "a": 1, "a,b": 2, "a,": 2, ',"x,y",': 3, '"a "",b"" c",d': 2, 'a"",b,"x,y"': 3, '"",""': 2, '"a\n,b",c': 2}
    df = spark.createDataFrame([(k,) for k in cases], "r string")
    assert {r[0]: int(r[1]) for r in df.select("r", field_count(F.col("r"))).collect()} == cases
    two = spark.createDataFrame([('a||"b||c"||d',)], "r string")
    assert two.select(field_count(F.col("r"), "||")).first()[0] == 3


@pytest.mark.parametrize("split", ["100", "1000"])
def test_quoted_line_breaks_over_many_ranges(spark, tmp_path, split):
    """Files of several byte ranges: fields over several ranges, doubled quotes and line ends at their edges."""
    import random

    rng = random.Random(int(split))
    (tmp_path / "in").mkdir()
    paths = []
    for f in range(3):
        lines = ["PID,NOTE,V"]
        for i in range(30):
            note = "".join(rng.choice(['"', "\n", ",", "a", "ü", " ", "\r\n"]) for _ in range(rng.choice([0, 1, 3, 9, 200])))
            lines.append(f'{f}-{i},"' + note.replace('"', '""') + f'",{i}' if rng.random() < 0.7 else f'{f}-{i},plain "text",{i}')
            if rng.random() < 0.1:
                lines.append("")
        paths.append(tmp_path / "in" / f"{f}.csv")
        paths[-1].write_bytes(("\r\n" if f == 1 else "\n").join([*lines, ""] if f else lines).encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        df = read_delimited(spark, str(tmp_path / "in"), multi_line=True)
        assert df.rdd.getNumPartitions() > 6
        got = sorted(map(repr, map(tuple, df.collect())))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = sorted(x for p in paths for x in _as_pandas_reads(p))
    assert got == want


def test_multi_line_errors(spark, tmp_path):
    p = tmp_path / "roll.csv"
    p.write_text('A,B\n1,"never\nends\n2,3\n')
    with pytest.raises(Exception, match="does not end"):
        read_delimited(spark, str(p), multi_line=True)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text('A,B\n1,"x\ny"\n')
    (tmp_path / "in" / "b.csv").write_text("B,A\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_delimited(spark, str(tmp_path / "in"), multi_line=True).collect()
