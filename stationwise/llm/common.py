"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words of white-space separated text, as a Java and DuckDB pattern. ``bytes.split()`` finds the same words in UTF-8.
WORD = r"[^\x20\x09-\x0D]+"
#: Text bytes that one Python step works on at a time.
CHUNK_BYTES = 1 << 20


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share: the session's ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a temporary folder of its own; a
    cluster without it is an error.
    """
    sc = spark.sparkContext
    known = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not known:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        known = tempfile.mkdtemp(prefix="stationwise-llm-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(known)
    return known


class Scratch:
    """The tables and checkpoints that operators write for themselves while it is open; ``free`` deletes them.

    Results of operators read such tables lazily: write a result out before freeing what it was made with.
    Scratches may be nested; each knows what was written while it was the innermost one.
    """

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self.paths: list[str] = []

    def __enter__(self) -> Scratch:
        _open.append(self)
        return self

    def __exit__(self, *_) -> None:
        _open.remove(self)

    def free(self) -> None:
        """Delete what was written; a path that is gone already is no error."""
        jvm, conf = self._spark._jvm, self._spark._jsparkSession.sessionState().newHadoopConf()
        for path in self.paths:
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(conf).delete(at, True)
        self.paths.clear()


_open: list[Scratch] = []


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows are kept in the shared folder, the lineage ends there."""
    shared_dir(df.sparkSession)
    kept = df.checkpoint()
    if _open:
        _open[-1].paths.append(kept._jdf.queryExecution().logical().rdd().getCheckpointFile().get())
    return kept


def stored(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back (wide or re-read tables)."""
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if _open:
        _open[-1].paths.append(path)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened by ``_`` until no column of ``df`` has it (case-insensitively)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[list[bytes | None]]:
    """The texts of a binary or string column in order, some ``limit`` bytes at a time (one longer text alone)."""
    column = column.cast(pa.large_binary())
    sizes = pa.compute.fill_null(pa.compute.binary_length(column), 0).to_pylist()
    begin = held = 0
    for i, n in enumerate(sizes):
        if held and held + n > limit:
            yield column.slice(begin, i - begin).to_pylist()
            begin, held = i, 0
        held += n
    if begin < len(sizes):
        yield column.slice(begin).to_pylist()


def append_columns(df: DataFrame, text: str, fields: list[T.StructField], make: Callable[[], Callable[..., list]], beside: Sequence[str] = ()) -> DataFrame:
    """``df`` with columns computed from its text column in Arrow batches; every other column passes through.

    ``make()`` runs once per task and returns a function from a list of UTF-8
    texts, and a list of values for each column ``beside``, to one list of values for each field.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kinds = [to_arrow_type(f.dataType) for f in fields]
    schema = T.StructType([*df.schema.fields, *fields])
    at, near = df.columns.index(text), [df.columns.index(c) for c in beside]
    names = schema.names

    def run(batches):
        work = make()
        for batch in batches:
            done = 0
            for texts in chunks(batch.column(at)):
                others = (batch.column(i).slice(done, len(texts)).to_pylist() for i in near)
                made = [pa.array(v, type=k) for v, k in zip(work(texts, *others), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.slice(done, len(texts)).columns, *made], names=names)
                done += len(texts)

    return df.mapInArrow(run, schema)


def crc32_of(col) -> F.Column:
    """Unsigned CRC-32 of a column's text (UTF-8)."""
    return F.crc32(col.cast("string"))


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the package to Python workers (as ``--py-files`` does), unless they find it by PYTHONPATH or the working folder."""
    home = Path(__file__).resolve().parents[2]
    known = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    sc = spark.sparkContext
    if any(p and Path(p).resolve() == home for p in known) or sc.applicationId in _shipped:
        return
    target = Path(tempfile.mkdtemp(prefix="stationwise-code-")) / "stationwise.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted((home / "stationwise").rglob("*.py")):
            z.write(p, p.relative_to(home))
    sc.addPyFile(str(target))
    _shipped.add(sc.applicationId)
