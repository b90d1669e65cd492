"""Session settings and the written tables that cut lineage between rounds."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cpus: int | str = 8, app: str = "verdure", **extra: str) -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # recording a Python call site per Column costs more than planning a small step
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def configure(spark: SparkSession) -> SparkSession:
    """Settings the operators rely on, applied to a session made elsewhere.

    Dates and day bounds are in UTC.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster a
    folder of one machine would lose the tables together with that machine.
    """
    named = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="verdure-")
    spark.sparkContext.setCheckpointDir(made)
    return made


_open: list[list[str]] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name; within ``cleaned`` the folder goes when the run ends."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if _open:
        _open[-1].append(path)
    return path


@contextmanager
def cleaned(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end of a run, the intermediate tables that it has written.

    Whatever reads them has to be written or collected by then.
    """
    _open.append([])
    try:
        yield
    finally:
        for path in _open.pop():
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and go on from the table.

    Iterative operators use this between rounds: the plan stays short, a lost
    executor costs a re-read instead of a replay of every earlier round, and the
    table's real size is known to the broadcast threshold of the next join.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, label: str, make: Callable[[], DataFrame]) -> DataFrame:
    """Write what ``make`` returns and go on from the table; the tables written on the way to it are deleted."""
    path = scratch_path(spark, label)
    with cleaned(spark):
        df = make()
        df.write.parquet(path)
        schema = df.schema
    return spark.read.schema(schema).parquet(path)
