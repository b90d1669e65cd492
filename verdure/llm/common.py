"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession

from verdure.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows and bytes that go between the JVM and a Python worker at once.
BATCH_ROWS, BATCH_BYTES = 2_000, "8m"


def bounded_batches(spark: SparkSession) -> SparkSession:
    """Small Arrow batches: whole texts are large, and both sides of a batch hold it outside the heap."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder, seen by all executors, for files that tasks write themselves."""
    base = shared_dir(spark)
    return f"{base if '://' in base or base.startswith('file:') else 'file://' + base}/{label}-{uuid.uuid4().hex}"


def file_system(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a folder or file that all executors reach, and the path in it."""
    if uri.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(uri)


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)],
        schema=schema,
    )


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of all batches, one after the other."""
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def fresh(columns: list[str], name: str) -> str:
    """A column name that is not among ``columns``."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def quoted(columns: list[str]) -> list[str]:
    """Column names as references, whatever signs they hold."""
    return ["`" + c.replace("`", "``") + "`" for c in columns]
