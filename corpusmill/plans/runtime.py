"""Session helpers: the package's code on the executors, the shared folder, written intermediates."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Gives the executors this package, once per application; plans that run Python call it before they are built."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    if root.is_dir():
        archive = Path(tempfile.mkdtemp()) / f"{root.name}.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def plain(a: pa.Array) -> list:
    """to_pylist() in whole columns: several times faster for lists and structs."""
    if pa.types.is_list(a.type):
        flat, at, out = plain(a.flatten()), 0, []
        for n in pc.list_value_length(a).to_pylist():
            out.append(None if n is None else flat[at : at + n])
            at += n or 0
        return out
    if pa.types.is_struct(a.type):
        names = [f.name for f in a.type]
        rows = [dict(zip(names, r)) for r in zip(*(plain(f) for f in a.flatten()))]
        return rows if not a.null_count else [r if there else None for r, there in zip(rows, a.is_valid().to_pylist())]
    return a.to_numpy(zero_copy_only=False).tolist() if pa.types.is_string(a.type) or not a.null_count else a.to_pylist()


def pieces(columns: tuple[pa.Array, ...], one: Callable, kind: pa.DataType, most: int = 1 << 19) -> Iterator[pa.Array]:
    """one(row) of all rows, as arrays that end with the row that brings their input to so many bytes."""
    lo, held, n = 0, 0, len(columns[0])
    for i in range(n):
        held += sum(c.slice(i, 1).nbytes for c in columns)
        if held >= most or i == n - 1:
            yield pa.array([one(*row) for row in zip(*(plain(c.slice(lo, i + 1 - lo)) for c in columns))], kind)
            lo, held = i + 1, 0


def by_pieces(spark: SparkSession, one: Callable, kind: str):
    """An Arrow function of a row's columns that gives its results back as it goes: a worker holds the batch and the results of about half a MB of it, not those of all 10,000 rows as Python objects."""
    ship_code(spark)
    arrow = to_arrow_type(DataType.fromDDL(kind))

    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for batch in batches:
            yield from pieces(batch if isinstance(batch, tuple) else (batch,), one, arrow)
        pa.default_memory_pool().release_unused()

    return F.arrow_udf(run, kind)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Only where the setting is absent and the master runs inside this machine (tests) is a folder beside the warehouse
    used; a cluster without the setting is an error, since a machine-local folder would lose rows there.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return os.path.join(spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:"), "_shared")


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet to the shared folder and returns the reread table: lineage is cut, lost executors cost no rerun."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/corpusmill/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes the files of tables that ``written`` made and that no later plan reads; others are left alone."""
    for df in tables:
        if path := getattr(df, "written_path", None):
            spark = df.sparkSession
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
