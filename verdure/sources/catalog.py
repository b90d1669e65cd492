"""A scene catalog laid out for searches by day, box and cloud.

Scenes lie in folders per month; within a month files follow the Z-order of the footprints' middles, so a file covers a
compact piece of the Earth. A small index beside them has the bounds, days and least cloud of every file. A search reads
the index, opens only the files that can hold a match and tests their rows; what it opens follows the answer, not the
catalog.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verdure.operators import selection
from verdure.sources.scenes import SCENE_SCHEMA

#: Scenes per file, and bits of a middle's coordinate on the curve.
FILE_SCENES = 20_000
CURVE_BITS = 16

Box = tuple[float, float, float, float]


def curve_place(x: Column, y: Column) -> Column:
    """Place of a point in degrees on the Z-order curve: the bits of both coordinates in turn."""

    def cell(v: Column, low: float, span: float) -> Column:
        top = (1 << CURVE_BITS) - 1
        return F.least(F.greatest(F.floor((v - low) / span * (1 << CURVE_BITS)), F.lit(0)), F.lit(top)).cast("long")

    def spread(v: Column) -> Column:
        # doubling the gaps between the bits, halves first
        for shift in (8, 4, 2, 1):
            mask = sum(1 << i for i in range(2 * CURVE_BITS) if not i // shift % 2)
            v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
        return v

    return spread(cell(x, -180.0, 360.0)).bitwiseOR(F.shiftleft(spread(cell(y, -90.0, 180.0)), 1))


def write_catalog(scenes: DataFrame, path: str, file_scenes: int = FILE_SCENES) -> None:
    """Write ``scenes`` as a catalog; what lies at ``path`` is replaced.

    Scenes without a time or footprint lie in files of their own (no search finds them, a scan does).
    """
    spark = scenes.sparkSession
    month = F.date_format("dt", "yyyy-MM")
    middle = curve_place((F.col("xmin") + F.col("xmax")) / 2, (F.col("ymin") + F.col("ymax")) / 2)
    placed = scenes.withColumns({"month": month, "place": middle})
    count = scenes.count()
    # a tie-break lets a crowded place be cut as well
    ranged = placed.repartitionByRange(max(1, -(-count // file_scenes)), "month", "place", "dt", "item_id")
    sorted_rows = ranged.sortWithinPartitions("month", "place", "dt", "item_id").drop("place")
    sorted_rows.write.mode("overwrite").partitionBy("month").parquet(f"{path}/scenes")
    # file names as Spark gives them: they open the files again, wherever the store is
    written = _scan(spark, path).withColumn("file", F.col("_metadata.file_path"))
    bounds = [F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"), F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax")]
    index = written.groupBy("file").agg(*bounds, F.min("dt").alias("first"), F.max("dt").alias("last"), F.min("cloud_cover").alias("least_cloud"), F.count("*").alias("n"))
    index.write.mode("overwrite").parquet(f"{path}/index")


def _scan(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCENE_SCHEMA).parquet(f"{path}/scenes")


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """All scenes of a catalog."""
    return _scan(spark, path).select(*spark.createDataFrame([], SCENE_SCHEMA).columns)


def _touching(box: Box) -> Column:
    xmin, ymin, xmax, ymax = box
    return (F.col("xmin") <= xmax) & (F.col("xmax") >= xmin) & (F.col("ymin") <= ymax) & (F.col("ymax") >= ymin)


def _within(first: dt.date, last: dt.date, low: str, high: str) -> Column:
    start, end = (F.lit(d).cast("timestamp_ntz") for d in (first, last + dt.timedelta(days=1)))
    return (F.col(high) >= start) & (F.col(low) < end)


def matching_files(spark: SparkSession, path: str, box: Box, first: dt.date, last: dt.date, max_cloud: float = selection.MAX_CLOUD) -> list[str]:
    """The files that can hold a scene touching ``box`` from ``first`` to ``last`` below the cloud limit.

    One row per file comes to the driver, which a scan of the folder would list as well.
    """
    index = spark.read.parquet(f"{path}/index")
    held = index.where(_touching(box) & _within(first, last, "first", "last") & (F.col("least_cloud") < max_cloud))
    return sorted(r[0] for r in held.select("file").collect())


def search(spark: SparkSession, path: str, box: Box, first: dt.date, last: dt.date, max_cloud: float = selection.MAX_CLOUD) -> DataFrame:
    """Scenes touching ``box`` (touching counts) from ``first`` to ``last`` with less cloud than ``max_cloud``."""
    files = matching_files(spark, path, box, first, last, max_cloud)
    found = spark.read.schema(SCENE_SCHEMA).parquet(*files) if files else spark.createDataFrame([], SCENE_SCHEMA)
    return found.where(_touching(box) & _within(first, last, "dt", "dt") & (F.col("cloud_cover") < max_cloud))
