"""JSON outputs keyed by area and day.

Two layouts are offered. ``BY_DAY`` keeps one folder per day with the area as a column:
it stays at a few files per day however many areas there are, and is the default.
``REF_KEYS`` and ``NDVI_KEYS`` keep one folder per area and day, one object per key.
Either way a rerun of a key replaces that key and leaves all others, and explicit nulls
are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from verdure.session import materialize

REF_SCHEMA = (
    "aoi_id string, date date, status string, bbox array<double>, item_datetime timestamp_ntz, "
    "cloud_cover double, stac_url string, collection string, item_id string, "
    "b04_asset string, b08_asset string"
)
NDVI_SCHEMA = (
    "aoi_id string, date date, status string, mean_ndvi double, cloud_cover double, "
    "item_datetime timestamp_ntz"
)
KEY = ["aoi_id", "date"]
BY_DAY = ["date"]
REF_KEYS = ["aoi_id", "date"]
NDVI_KEYS = ["date", "aoi_id"]
# microseconds survive the round trip
JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
}


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).options(**JSON_OPTIONS).json(path)


def append_keyed(df: DataFrame, path: str, layout: list[str] = BY_DAY) -> None:
    """Add rows whose keys are not there yet.

    The rebalance hint brings the rows of a folder together into files of even size,
    also when one day holds a large share of them.
    """
    even = df.hint("rebalance", *layout)
    even.write.mode("append").partitionBy(*layout).options(**JSON_OPTIONS).json(path)


def replace_keyed(df: DataFrame, path: str, schema: str, layout: list[str] = BY_DAY) -> None:
    """Write rows, replacing earlier rows of the same keys and no others.

    Only folders that ``df`` touches are rewritten. With the day layout the other
    areas of such a day are carried over.
    """
    spark = df.sparkSession
    out = materialize(df, "fresh")
    if set(layout) != set(KEY):
        touched = out.select(*layout).distinct()
        earlier = read_keyed(spark, path, schema).join(touched, layout, "left_semi")
        kept = earlier.join(out.select(*KEY), KEY, "left_anti")
        out = materialize(out.unionByName(kept), "merged")
    writer = out.hint("rebalance", *layout).write.mode("overwrite").partitionBy(*layout)
    writer.option("partitionOverwriteMode", "dynamic").options(**JSON_OPTIONS).json(path)


def append_refs(refs: DataFrame, path: str, layout: list[str] = BY_DAY) -> None:
    """Append scene references; callers pass only pairs that have none yet."""
    append_keyed(refs, path, layout)


def replace_refs(refs: DataFrame, path: str, layout: list[str] = BY_DAY) -> None:
    replace_keyed(refs, path, REF_SCHEMA, layout)


def write_ndvi(records: DataFrame, path: str, layout: list[str] = BY_DAY) -> None:
    """Write results; a result for the same area and day is replaced."""
    replace_keyed(records, path, NDVI_SCHEMA, layout)


def read_keyed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows below ``path``, or none when nothing was written yet.

    An unreadable record has null fields except for its key; its null ``status`` is
    then treated like a missing scene.
    """
    try:
        read = spark.read.schema(schema).option("mode", "PERMISSIVE").options(**JSON_OPTIONS).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    names = T.StructType.fromDDL(schema).fieldNames()
    return read.select(*names)


def read_refs(spark: SparkSession, path: str) -> DataFrame:
    return read_keyed(spark, path, REF_SCHEMA)


def read_ndvi(spark: SparkSession, path: str) -> DataFrame:
    return read_keyed(spark, path, NDVI_SCHEMA)


def written_keys(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Distinct (aoi_id, date) written below ``path``."""
    return read_keyed(spark, path, schema).select(*KEY).distinct()
