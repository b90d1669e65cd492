"""Fields, scenes and pixels derived from the given tables, as FIXTURES.md defines them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from verdure.operators import aoi
from verdure.operators.neighbors import nearest_distance
from verdure.operators.selection import aoi_days, scene_refs
from verdure.plans.daily import AreaSettings
from verdure.session import configure, materialize, scratch_path
from verdure.sources.raster import read_strips, to_strips, write_strips

AS_OF = dt.date(2024, 1, 30)
MASK_DAY = dt.date(2024, 1, 15)
COLLECTION = "sentinel-2-l2a"
CATALOG = "https://catalog.example/v1"
GRID_X0, GRID_Y0, GRID_RES, GRID_SIZE = 4.5, 52.0, 0.02, 128
FEATURES_PER_FILE = 1_000  # most features of a written FeatureCollection file
CATALOG_FILE = 500  # scenes per catalog file
SEARCH_BOX, SEARCH_DAYS = (5.25, 50.05, 5.85, 50.35), (dt.date(2024, 1, 5), dt.date(2024, 1, 9))
COARSE = 32  # fine cells per side of a coarse cell


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = [F.get("embedding", F.lit(i)).cast("double") for i in range(5)]
    shaped = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("ord"),
        F.concat(F.lit("F"), F.col("vec_id").cast("string")).alias("field_id"),
        F.when(
            F.col("label").isNull() | (F.col("label") != 9),
            F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("vec_id") % 30).cast("int")),
        ).alias("planting_date"),
        (6 + 4 * e[0]).alias("cx"),
        (50.5 + 4 * e[1]).alias("cy"),
        (0.01 + 0.1 * F.abs(e[2])).alias("hw"),
        (0.01 + 0.1 * F.abs(e[3])).alias("hh"),
        (0.02 * e[4]).alias("sk"),
    )
    ring = F.expr(
        "array(array(cx - hw, cy - hh), array(cx + hw, cy - hh), array(cx + hw + sk, cy + hh), "
        "array(cx - hw + sk, cy + hh), array(cx - hw, cy - hh))"
    )
    return shaped.select("ord", "field_id", "planting_date", F.array(F.array(ring)).alias("geom"))


def scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int") % 4
    kind = F.col("event_type")

    def named(*names: str) -> F.Column:
        order = ("view", "click", "signup", "purchase")
        chosen = F.lit(None).cast("string")
        for event, name in zip(order, names, strict=True):
            chosen = F.when(kind == event, name).otherwise(chosen)
        return chosen

    def asset(epsg: F.Column) -> F.Column:
        return F.struct(
            F.lit(None).cast("string").alias("href"),
            epsg.cast("int").alias("proj_epsg"),
            F.lit(0.0001).alias("scale"),
            F.lit(0.0).alias("offset"),
            F.lit(-9999.0).alias("nodata"),
        )

    red = named("B04", "B04_10m", "red", "b04")
    nir = named("B08", "B08_10m", "nir", "b08")
    no_epsg = F.lit(None).cast("int")
    two_bands = F.create_map(
        F.coalesce(red, F.lit("B04")), asset(F.when(k == 1, 32631)), F.coalesce(nir, F.lit("B08")), asset(F.when(k == 2, 32633))
    )
    x0 = 4.5 + (F.col("user_id") % 15) * 0.2
    y0 = 49.0 + (F.floor(F.col("user_id") / 15) % 10) * 0.3
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("S2_"), F.col("event_id").cast("string")).alias("item_id"),
        F.lit(COLLECTION).alias("collection"),
        F.col("ts").cast("timestamp_ntz").alias("dt"),
        F.when(kind != "error", F.round(F.col("value") % 100, 2)).alias("cloud_cover"),
        F.when(k == 0, 32632).alias("proj_epsg"),
        x0.alias("xmin"),
        y0.alias("ymin"),
        (x0 + 1.0).alias("xmax"),
        (y0 + 0.7).alias("ymax"),
        F.when(kind == "error", F.create_map(F.lit("B02"), asset(no_epsg)))
        .otherwise(two_bands)
        .alias("assets"),
    )


def rasters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which raster and grid hold a scene's pixels."""
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("S2_"), F.col("event_id").cast("string")).alias("item_id"),
        (F.col("event_id") % 4).cast("string").alias("raster_id"),
        (F.col("event_id") % 4).cast("string").alias("grid_id"),
        F.lit("red").alias("red_band"),
        F.lit("nir").alias("nir_band"),
    )


#: UTM grids: number, west and north edge in metres; 128 cells of 2 km a side.
UTM_GRIDS = ((32631, 580000.0), (32632, 150000.0), (32633, -260000.0))
UTM_Y0, UTM_RES = 5800000.0, 2000.0


def utm_rasters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``rasters``, every scene on the grid of its own zone; scenes without a zone have none."""
    k = F.get_json_object("props", "$.k").cast("int") % 4
    zone = F.when(k == 0, 32632).when(k == 1, 32631).when(k == 2, 32633)
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("S2_"), F.col("event_id").cast("string")).alias("item_id"),
        (F.col("event_id") % 4).cast("string").alias("raster_id"),
        zone.cast("string").alias("grid_id"),
        F.lit("red").alias("red_band"),
        F.lit("nir").alias("nir_band"),
    ).where("grid_id is not null")


def utm_grids(spark: SparkSession) -> DataFrame:
    """One grid per zone."""
    zones = F.explode(F.array(*[F.struct(F.lit(z).alias("epsg"), F.lit(x).alias("x0")) for z, x in UTM_GRIDS]))
    return spark.range(1).select(zones.alias("z")).select(
        F.col("z.epsg").cast("string").alias("grid_id"),
        "z.epsg",
        "z.x0",
        F.lit(UTM_Y0).alias("y0"),
        F.lit(UTM_RES).alias("xres"),
        F.lit(UTM_RES).alias("yres"),
        F.lit(GRID_SIZE).alias("width"),
        F.lit(GRID_SIZE).alias("height"),
    )


def grids(spark: SparkSession, sf_dir: str, coarse: int = 1) -> DataFrame:
    """The degree grid of every raster; ``coarse`` cells per side make one."""
    items = table(spark, sf_dir, "lineitem").select(
        (F.col("l_suppkey") % 4).cast("string").alias("grid_id")
    )
    return items.distinct().select(
        "grid_id",
        F.lit(4326).alias("epsg"),
        F.lit(GRID_X0).alias("x0"),
        F.lit(GRID_Y0).alias("y0"),
        F.lit(GRID_RES * coarse).alias("xres"),
        F.lit(GRID_RES * coarse).alias("yres"),
        F.lit(GRID_SIZE // coarse).alias("width"),
        F.lit(GRID_SIZE // coarse).alias("height"),
    )


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long pixels (item_id, row, col, order, line, copy, band, raw)."""
    missing = F.col("l_quantity") == 1
    wide = table(spark, sf_dir, "lineitem").select(
        (F.col("l_suppkey") % 4).cast("string").alias("item_id"),
        (F.col("l_orderkey") % GRID_SIZE).alias("row"),
        (F.col("l_partkey") % GRID_SIZE).alias("col"),
        F.col("l_orderkey").alias("obs_order"),
        F.col("l_linenumber").alias("obs_line"),
        F.when(missing, -9999.0).otherwise(F.round(F.col("l_tax") * 10000)).alias("red_raw"),
        F.when(missing, -9999.0).otherwise(F.round(F.col("l_discount") * 10000)).alias("nir_raw"),
    )
    # an order line may come twice; every row is an observation of its own
    same = Window.partitionBy("item_id", "row", "col", "obs_order", "obs_line").orderBy("red_raw", "nir_raw")
    return wide.withColumn("obs_copy", F.row_number().over(same)).selectExpr(
        "item_id",
        "row",
        "col",
        "obs_order",
        "obs_line",
        "obs_copy",
        "stack(2, 'red', red_raw, 'nir', nir_raw) as (band, raw)",
    )


OBSERVATION = ["obs_order", "obs_line", "obs_copy"]

#: Other grids of the same place: cells of twice the size, and cells that share no edge with the fine ones.
HALF_GRID = (GRID_X0, GRID_Y0, 2 * GRID_RES, 2 * GRID_RES, GRID_SIZE // 2, GRID_SIZE // 2)
UNEVEN_GRID = (4.513, 51.991, 0.05, 0.03, 50, 80)
FINE_GRID = (GRID_X0, GRID_Y0, GRID_RES, GRID_RES, GRID_SIZE, GRID_SIZE)


def grid_struct(grid: tuple[float, float, float, float, int, int]) -> Column:
    names = ("x0", "y0", "xres", "yres", "width", "height")
    return F.struct(*[F.lit(v).alias(n) for n, v in zip(names, grid, strict=True)])


def brightest(spark: SparkSession, sf_dir: str, band: str, size: int = 1) -> DataFrame:
    """Strips with the highest raw value of a band per cell, ``size`` fine cells a side."""
    cell = {"row": F.floor(F.col("row") / size), "col": F.floor(F.col("col") / size)}
    kept = pixels(spark, sf_dir).where(F.col("band") == band).withColumns(cell)
    return to_strips(kept.groupBy("item_id", "band", "row", "col").agg(F.max("raw").alias("raw")), GRID_SIZE)


def moved_from(strips: DataFrame, source: tuple, target: tuple) -> DataFrame:
    """Every raster band of ``strips`` with the grid it is on and the grid it goes to."""
    grids_of = (grid_struct(source).alias("source"), grid_struct(target).alias("target"))
    return strips.select("item_id", "band").distinct().select("item_id", "band", *grids_of)


def values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels with the constants of their rescaling."""
    return (
        pixels(spark, sf_dir)
        .withColumn("nodata", F.lit(-9999.0))
        .withColumn("scale", F.lit(0.0001))
        .withColumn("offset", F.lit(0.0))
    )


class Stage:
    """Outputs of one stage that later queries read, written once per session and input."""

    _written: dict[tuple[str, str, str, str], DataFrame] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = configure(spark), sf_dir

    def _listing(self) -> str:
        """Changes when a file of the input does."""
        context = self.spark.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(self.sf_dir)
        files = folder.getFileSystem(context._jsc.hadoopConfiguration()).listStatus(folder)
        return ",".join(sorted(f"{f.getPath().getName()}:{f.getLen()}:{f.getModificationTime()}" for f in files))

    def _keep(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.sf_dir, self._listing(), name)
        if key not in self._written:
            self._written[key] = build()
        return self._written[key]

    def _once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        return self._keep(name, lambda: materialize(build(), name))

    def points(self) -> DataFrame:
        return self._once("points", lambda: aoi.field_points(fields(self.spark, self.sf_dir)))

    def nearest(self) -> DataFrame:
        return self._once("nearest", lambda: nearest_distance(self.points()))

    def eps(self) -> DataFrame:
        return self._once("eps", lambda: aoi.estimate_eps(self.nearest()))

    def eps_value(self) -> float:
        return self.eps().first()[0]

    def clusters(self) -> DataFrame:
        return self._once(
            "clusters", lambda: aoi.cluster_fields(self.points(), 2, eps=self.eps_value())
        )

    def aois(self) -> DataFrame:
        padding = AreaSettings().padding
        return self._once("aois", lambda: aoi.aoi_boxes(self.points(), self.clusters(), padding))

    def tagged(self) -> DataFrame:
        return self._once(
            "tagged",
            lambda: aoi.tag_fields(fields(self.spark, self.sf_dir), self.clusters(), self.aois()),
        )

    def strips(self, width: int = GRID_SIZE, shift: int = 0) -> DataFrame:
        """All observations as a strip table in folders per band and scene."""

        def write_and_read() -> DataFrame:
            path = scratch_path(self.spark, "strips")
            write_strips(to_strips(pixels(self.spark, self.sf_dir), width, OBSERVATION, shift), path)
            return read_strips(self.spark, path)

        return self._keep(f"strips-{width}-{shift}", write_and_read)

    def pairs(self) -> DataFrame:
        return aoi_days(self.aois(), self.tagged(), AS_OF)

    def refs(self) -> DataFrame:
        return self._once(
            "refs",
            lambda: scene_refs(self.pairs(), scenes(self.spark, self.sf_dir), catalog_url=CATALOG),
        )
