"""File sources and sinks for the bronze, silver and gold layers.

Paths are plain strings, so the same code runs on a local disk, HDFS or
an object store; nothing here lists or deletes files by hand.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from stationwise.constants import NULL_TOKENS
from stationwise.functions.typing import null_tokens
from stationwise.sources.records import whole_records


# ----------------------------------------------------------------- sources


def read_delimited(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    tokens: Sequence[str] = NULL_TOKENS,
    multi_line: bool = False,
) -> DataFrame:
    """Delimited text with a header row in every file; every column read as text.

    No schema inference (that would be a second full pass and gives
    types that change with the data); typing is the cleaning step's job.
    Missing-value tokens (``NA``, ``n/a``, ``NULL``, empty, ...) become null.

    Quoted fields may hold the separator and doubled quotes. Short rows are
    padded with nulls. A row with more fields than the header, empty ones
    included, a file whose header differs, and, unless ``multi_line`` is set, a quoted line break
    are errors when rows are read, whatever columns a query uses. With ``multi_line``
    quoted line breaks are part of the field; files are still read by many tasks
    (see ``sources.records``), at the price of a pass that looks for the records' begins when
    the DataFrame is made.
    """
    options = {"header": True, "sep": sep, "quote": '"', "escape": '"', "enforceSchema": False, "multiLine": multi_line, "columnPruning": False}
    names = spark.read.options(**options | {"inferSchema": False}).csv(path).columns
    bad = "_bad_record"
    schema = StructType([StructField(c, StringType()) for c in [*names, bad]])
    parsing = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad, "unescapedQuoteHandling": "RAISE_ERROR"}
    if multi_line:
        texts = options | parsing | {"header": False}
        parsed = F.from_csv("record", schema.simpleString()[7:-1].replace(":", " "), {k: str(v).lower() if isinstance(v, bool) else v for k, v in texts.items()})
        df = whole_records(spark, path, sep).select(parsed.alias("r")).select("r.*")
    else:
        df = spark.read.options(**options, **parsing).schema(schema).csv(path)
    record = F.col(bad)
    quotes = F.length(record) - F.length(F.replace(record, F.lit('"'), F.lit("")))
    trouble = (
        F.when((quotes % 2 == 1) & F.lit(not multi_line), F.lit("a quoted field does not end on its line (read with multi_line=True): "))
        .when(field_count(record, sep) > len(names), F.lit(f"more than {len(names)} fields: "))
    )

    def checked(c: str) -> Column:
        return F.when(trouble.isNotNull(), F.raise_error(F.concat(trouble, record)).cast("string")).otherwise(null_tokens(F.col(f"`{c}`"), tuple(tokens)))

    return df.select(*(checked(c).alias(c) for c in names))


def field_count(record: Column, sep: str = ",") -> Column:
    """Fields of a record: its separators outside of quoted fields, and one.

    A quoted field begins at a field's begin; its doubled quotes end one span of text
    without quotes and begin the next, so spans are taken away one after the other.
    """
    quoted = rf'(^|{re.escape(sep)}|\G(?<="))"[^"]*+"'
    bare = F.regexp_replace(record, quoted, "$1")
    return (F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit("")))) / len(sep) + 1


def read_parquet_checked(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Parquet reader that raises ``FileNotFoundError`` for a missing path or one without a data file.

    ``schema`` fixes the column types, including partition columns, so a
    partition value such as ``007`` is not re-typed as the integer 7.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as exc:
        if (exc.getCondition() or "") in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise FileNotFoundError(f"no data at {path}") from exc
        raise


def read_partitioned(spark: SparkSession, path: str, partition_column: str, schema: StructType | None = None) -> DataFrame:
    """Read a partitioned Parquet table with the partition column typed as text."""
    if schema is None:
        probe = read_parquet_checked(spark, path)
        fields = [f if f.name != partition_column else f.__class__(f.name, StringType(), True) for f in probe.schema.fields]
        schema = StructType(fields)
    return read_parquet_checked(spark, path, schema)


# ------------------------------------------------------------------- sinks


def write_parquet(df: DataFrame, path: str, compression: str = "snappy") -> None:
    """Replace a Parquet table (bronze sink)."""
    df.write.mode("overwrite").option("compression", compression).parquet(path)


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_column: str,
    max_records_per_file: int = 5_000_000,
    mode: str = "overwrite",
) -> None:
    """Write a table partitioned by ``partition_column`` (replace by default).

    The ``rebalance`` hint shuffles rows by the partition value, so each
    task writes few directories, and lets adaptive execution split a
    value that holds a large share of the rows into tasks of the advisory
    size (and merge tiny ones): the number of files per value follows the
    data. ``maxRecordsPerFile`` caps file size inside a task.
    """
    balanced = df.hint("rebalance", partition_column)
    (
        balanced.write.mode(mode)
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(partition_column)
        .parquet(path)
    )


def write_single_file(df: DataFrame, path: str) -> None:
    """Replace a small table as one file, keeping the row order of ``df``.

    ``coalesce(1)`` merges the already ordered partitions without another
    shuffle, so a sort above it survives into the file. Meant for gold
    tables whose size is bounded by the number of codes x buckets.
    """
    df.coalesce(1).write.mode("overwrite").parquet(path)
