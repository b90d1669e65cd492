"""The daily stages on Structured Streaming.

A day is decided once: a scene that arrives after the watermark has passed its day
does not change the choice, just as a written reference is never revisited in batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from verdure.functions.assets import NIR_ASSETS, RED_ASSETS, pick_asset
from verdure.operators import selection
from verdure.session import materialize
from verdure.sources import keyed
from verdure.sources.scenes import SCENE_SCHEMA

LATENESS = "1 day"


def read_scene_stream(
    spark: SparkSession, path: str, files_per_trigger: int | None = None
) -> DataFrame:
    """Scene table folder as a stream; new Parquet files are new scenes."""
    reader = spark.readStream.schema(SCENE_SCHEMA)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def best_of_closed_days(timed: DataFrame, aois: DataFrame) -> DataFrame:
    """(aoi_id, day, s): the best scene per area and closed day of eligible scenes with a watermark on ``dt``.

    First the best scene of each footprint, then that of each area: scenes of one footprint touch the same areas, so
    no other can win, and areas meet one scene per footprint and day instead of all.
    """
    carried = F.struct("item_id", "collection", "dt", "cloud_cover", "assets")
    footprint = ["xmin", "ymin", "xmax", "ymax", F.window("dt", "1 day").alias("day")]
    leaders = timed.groupBy(*footprint).agg(F.min_by(carried, selection.scene_order()).alias("s"))
    cloud = F.coalesce("s.cloud_cover", F.lit(selection.MISSING_CLOUD))
    order = F.struct(cloud.alias("cloud"), F.col("s.dt"), F.col("s.item_id"))
    return selection.intersecting(aois, leaders).groupBy("aoi_id", "day").agg(F.min_by("s", order).alias("s"))


def stream_best_scenes(
    scenes: DataFrame,
    aois: DataFrame,
    max_cloud: float = selection.MAX_CLOUD,
    lateness: str = LATENESS,
) -> DataFrame:
    """Best scene per area and closed day from a scene stream (append mode).

    The state is one candidate per footprint and open day; areas meet these once their day has closed. Days without a
    scene give no row; their ``no_items`` references come from the batch stage. The last days stay open until
    ``close_refs``.
    """
    instants = scenes.withColumn("dt", F.col("dt").cast("timestamp"))
    timed = selection.eligible_scenes(instants, max_cloud).withWatermark("dt", lateness)
    return (
        best_of_closed_days(timed, aois)
        .select("aoi_id", F.to_date("day.start").alias("date"), "s.*")
        .withColumn("dt", F.col("dt").cast("timestamp_ntz"))
    )


def append_refs(
    best: DataFrame, aois: DataFrame, path: str, checkpoint: str, catalog_url: str | None = None
) -> StreamingQuery:
    """Write the chosen scenes of closed days as ``ok`` references and stop when caught up.

    The folder is only added to, so another stream may follow it: a batch replayed after a failure writes the keys
    that are not there yet.
    """

    def write(batch: DataFrame, _: int) -> None:
        _add_refs(batch, aois, path, catalog_url)

    return _start(best, write, checkpoint)


def close_refs(
    scenes: DataFrame,
    aois: DataFrame,
    path: str,
    max_cloud: float = selection.MAX_CLOUD,
    lateness: str = LATENESS,
    catalog_url: str | None = None,
) -> None:
    """End of input: decide the days that the stream left open, from the scene table it has read.

    Only scenes of days that the watermark had not passed are read; what is written already stays.
    """
    passed = selection.eligible_scenes(scenes, max_cloud)
    mark = passed.select(F.date_trunc("DAY", F.max("dt") - F.expr(f"interval {lateness}")).cast("timestamp_ntz")).scalar()
    best = selection.best_scenes(aois, scenes.where(F.col("dt") >= mark), max_cloud)
    _add_refs(best, aois, path, catalog_url)


def _add_refs(best: DataFrame, aois: DataFrame, path: str, catalog_url: str | None) -> None:
    written = keyed.written_keys(best.sparkSession, path, keyed.REF_SCHEMA)
    due = best.join(written, keyed.KEY, "left_anti").join(aois.select("aoi_id", "bbox"), "aoi_id")
    keyed.append_refs(materialize(due.select(*_ref_columns(catalog_url)), "stream-refs"), path)


def _ref_columns(catalog_url: str | None) -> list[Column | str]:
    return [
        "aoi_id",
        "date",
        F.lit("ok").alias("status"),
        "bbox",
        F.col("dt").alias("item_datetime"),
        "cloud_cover",
        F.lit(catalog_url).cast("string").alias("stac_url"),
        "collection",
        "item_id",
        pick_asset(F.col("assets"), RED_ASSETS).alias("b04_asset"),
        pick_asset(F.col("assets"), NIR_ASSETS).alias("b08_asset"),
    ]


def read_ref_stream(spark: SparkSession, path: str) -> DataFrame:
    """Reference folder as a stream."""
    return spark.readStream.schema(keyed.REF_SCHEMA).options(**keyed.JSON_OPTIONS).json(path)


def append_ndvi(
    refs: DataFrame,
    compute: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
) -> StreamingQuery:
    """Compute and write the records of newly arrived references.

    ``compute`` is the batch stage from references to records. A replayed batch
    replaces the keys it wrote before.
    """

    def write(batch: DataFrame, _: int) -> None:
        keyed.write_ndvi(compute(batch), path)

    return _start(refs, write, checkpoint)


def _start(
    df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    return (
        df.writeStream.foreachBatch(write)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
