"""Scene catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCENE_SCHEMA = (
    "item_id string, collection string, dt timestamp_ntz, cloud_cover double, proj_epsg int, "
    "xmin double, ymin double, xmax double, ymax double, "
    "assets map<string, struct<href: string, proj_epsg: int, scale: double, offset: double, "
    "nodata: double>>"
)

_ASSET = (
    "struct<href: string, `proj:epsg`: int, "
    "`raster:bands`: array<struct<scale: double, offset: double, nodata: double>>>"
)
_ITEM_SCHEMA = (
    "id string, collection string, bbox array<double>, "
    "properties struct<datetime: string, `eo:cloud_cover`: double, `proj:epsg`: int>, "
    f"assets map<string, {_ASSET}>"
)


def read_scene_items(spark: SparkSession, path: str) -> DataFrame:
    """Scene table from line-delimited catalog items."""
    raw = spark.read.schema(_ITEM_SCHEMA).option("mode", "FAILFAST").json(path)
    assets = F.transform_values(
        "assets",
        lambda _, a: F.struct(
            a["href"].alias("href"),
            a["proj:epsg"].alias("proj_epsg"),
            F.get(a["raster:bands"], F.lit(0))["scale"].alias("scale"),
            F.get(a["raster:bands"], F.lit(0))["offset"].alias("offset"),
            F.get(a["raster:bands"], F.lit(0))["nodata"].alias("nodata"),
        ),
    )
    return raw.select(
        F.col("id").alias("item_id"),
        "collection",
        F.to_utc_timestamp(F.col("properties.datetime"), F.current_timezone()).cast("timestamp_ntz").alias("dt"),
        F.col("properties")["eo:cloud_cover"].alias("cloud_cover"),
        F.col("properties")["proj:epsg"].alias("proj_epsg"),
        *(F.col("bbox")[i].alias(n) for i, n in enumerate(("xmin", "ymin", "xmax", "ymax"))),
        assets.alias("assets"),
    )


def read_scenes(spark: SparkSession, path: str) -> DataFrame:
    """Scene table kept as Parquet (optionally partitioned by ``date``)."""
    return spark.read.schema(SCENE_SCHEMA).parquet(path)


def find_scenes(scenes: DataFrame, keys: DataFrame) -> DataFrame:
    """Scenes by (collection, item_id)."""
    return keys.join(scenes, ["collection", "item_id"])
