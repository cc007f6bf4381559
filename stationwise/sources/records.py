"""Records of delimited files with quoted line breaks, read by many tasks.

Spark deals a file out in byte ranges and gives each line to one range. Whether a line
begins a record depends on all text before it, but only by one bit: inside a quoted
field, or not. A first pass finds for each range how it ends if it begins outside, and if
it begins inside; those functions, composed along the file, tell how every range
begins. The second pass then joins lines into records range by range. A record that
goes over the end of a range is put together from its pieces, two of a range at most.

What is known of the ranges is held by the driver: nine bytes each, so some
7 MB for 100 TB of files.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

QUOTE = '"'


def ends_inside(line: str, inside: bool, sep: str) -> bool:
    """Whether a line's end lies in a quoted field. A quote opens one at a field's begin only."""
    at = 0
    while True:
        if not inside:
            if not line.startswith(QUOTE, at):
                at = line.find(sep + QUOTE, at)
                if at < 0:
                    return False
                at += len(sep)
            at += 1
        at = line.find(QUOTE, at)
        if at < 0:
            return True
        inside = line.startswith(QUOTE, at + 1)  # a doubled quote is text
        if inside:
            at += 2
            continue
        at = line.find(sep, at + 1)
        if at < 0:
            return False
        at += len(sep)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    place = F.col("_metadata")
    return spark.read.text(path, lineSep="\n").select(place["file_path"].alias("file"), place["file_block_start"].alias("start"), "value")


def _ranges(batches) -> Iterator[tuple[str, int, pa.Array]]:
    """(file, start of the range, lines): rows of one range after another."""
    for batch in batches:
        files, starts = batch.column(0), batch.column(1).to_numpy()
        edges = [0, *np.flatnonzero(np.diff(starts)) + 1, batch.num_rows] if batch.num_rows else [0]
        if len(pc.unique(files)) > 1:  # files of equal starts
            names = files.to_pylist()
            edges = sorted({*edges, *(i for i in range(1, len(names)) if names[i] != names[i - 1])})
        for a, b in zip(edges, edges[1:], strict=False):
            yield files[int(a)].as_py(), int(starts[a]), batch.column(2).slice(a, b - a)


def _range_ends(sep: str):
    """Task: for each range whether it ends inside a quoted field, if it begins outside and if inside."""

    def run(batches):
        found: dict[tuple[str, int], list[bool]] = {}
        for file, start, lines in _ranges(batches):
            ends = found.setdefault((file, start), [False, True])
            for line in lines.filter(pc.match_substring(lines, QUOTE)).to_pylist():
                ends[:] = (ends_inside(line, x, sep) for x in ends)
        rows = [(f, s, *e) for (f, s), e in found.items()]
        columns = zip(*rows, strict=True) if rows else [[]] * 4
        kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_()]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["file", "start", "outside", "inside"])

    return run


def range_states(spark: SparkSession, path: str, sep: str = ",") -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """By file: starts of its ranges in order, and whether each begins inside a quoted field."""
    ends = _lines(spark, path).mapInArrow(_range_ends(sep), "file string, start long, outside boolean, inside boolean")
    out: dict[str, tuple[list[int], list[bool]]] = {}
    state = False
    for r in ends.orderBy("file", "start").toLocalIterator():
        if r["file"] not in out:
            if state:
                raise ValueError(f"a quoted field does not end in {list(out)[-1]}")
            out[r["file"]] = ([], [])
        starts, inside = out[r["file"]]
        starts.append(r["start"])
        inside.append(state)
        state = r["inside"] if state else r["outside"]
    if state:
        raise ValueError(f"a quoted field does not end in {list(out)[-1]}")
    return {f: (np.array(s, np.int64), np.array(i, bool)) for f, (s, i) in out.items()}


PIECE = "file string, start long, piece int, open boolean, begins boolean, record string"


def _records(states, sep: str, header: list[str] | None):
    """Task: whole records (``open`` false) and the pieces of records that go over the end of a range."""

    def run(batches):
        import csv

        made: list[tuple] = []
        at, inside, begins, held, first = None, False, True, [], False

        def give(is_open: bool) -> None:
            nonlocal first
            text = "\n".join(held)
            if not is_open and text.endswith("\r"):
                text = text[:-1]
            whole = begins and not is_open
            if first and begins and not is_open:
                first = False
                if header is not None and next(csv.reader([text.removeprefix("﻿")], delimiter=sep), []) != header:
                    raise ValueError(f"the header of {at[0]} differs: {text}")
                return
            if not whole:
                made.append((*at, 0 if not begins else 1, True, begins, text))
            elif text.strip():
                made.append((*at, 0, False, True, text))

        def batch_of(rows):
            kinds = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.string()]
            columns = zip(*rows, strict=True) if rows else [[]] * 6
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in PIECE.split(", ")])

        for file, start, lines in _ranges(batches):
            if (file, start) != at:
                if held:
                    give(is_open=True)
                at, held = (file, start), []
                starts, how = states.value[file]
                i = int(np.searchsorted(starts, start))
                if i == len(starts) or starts[i] != start:
                    raise ValueError("the files or the session's split size changed since the DataFrame was made")
                inside = bool(how[i])
                begins, first = not inside, start == 0
            quoted = pc.match_substring(lines, QUOTE).to_pylist()
            for line, has in zip(lines.to_pylist(), quoted, strict=True):
                held.append(line)
                if has:
                    inside = ends_inside(line, inside, sep)
                if not inside:
                    give(is_open=False)
                    held, begins = [], True
            yield batch_of(made)
            made.clear()
        if held:
            give(is_open=True)
        yield batch_of(made)

    return run


def whole_records(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """(record) of every file but its header, quoted line breaks included; blank records are left out.

    Lines end with ``\\n`` or ``\\r\\n``; inside a quoted field both stay as they are.
    A file that ends inside a quoted field is an error.
    """
    states = spark.sparkContext.broadcast(range_states(spark, path, sep))
    first = spark.read.options(header=False, sep=sep, quote=QUOTE, escape=QUOTE, multiLine=True).csv(path).first()
    header = [x or "" for x in first] if first else None
    rows = _lines(spark, path).mapInArrow(_records(states, sep, header), PIECE)
    # the piece that begins a record opens a group; heads of the ranges behind it follow until the next one
    pieces = rows.where("open")
    order = Window.partitionBy("file").orderBy("start", "piece")
    grouped = pieces.withColumn("k", F.sum(F.col("begins").cast("long")).over(order)).groupBy("file", "k")
    joined = grouped.agg(F.array_sort(F.collect_list(F.struct("start", "piece", "record"))).alias("parts"))
    over = joined.select(F.array_join(F.transform("parts", lambda x: x["record"]), "\n").alias("record"))
    return rows.where("NOT open").select("record").unionByName(over.where(F.trim("record") != ""))
