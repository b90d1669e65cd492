"""One query per operator, over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verdure.functions import geometry, keys, projection, raster
from verdure.functions.assets import NIR_ASSETS, RED_ASSETS, find_asset, pick_epsg
from verdure.operators import aoi, dissolve, incremental, mask, ndvi, neighbors, resample, selection
from verdure.plans import daily
from verdure.session import materialize, scratch_path
from verdure.sources import catalog, collection
from verdure.sources import fields as field_files
from verdure.sources import keyed
from verdure.sources import raster as raster_files
from verdure.sources import scenes as scene_files
from verdure.streaming import daily as stream
from verdure.streaming import days as stream_days
from verdure.workload import bindings as b
from verdure.workload.bindings import Stage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def day(column: str = "date") -> Column:
    return F.date_format(column, "yyyy-MM-dd").alias(column)


def moment(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(column)


def rounded(column: str, digits: int) -> Column:
    return F.round(column, digits).alias(column)


def box_columns(box: Column, digits: int) -> list[Column]:
    return [F.round(box[n], digits).alias(n) for n in ("xmin", "ymin", "xmax", "ymax")]


def vertices(geom: Column) -> Column:
    """Vertices of the first ring without the closing one."""
    ring = geom[0][0]
    return F.slice(ring, F.lit(1), F.size(ring) - 1)


# --- fields: scan, sink, coordinate systems ---------------------------------------


@query
def fields_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields with properties of their own, written as several files and read back."""
    path = scratch_path(spark, "fields")
    crop = F.concat(F.lit("crop "), (F.col("ord") % 7).cast("string"))
    own = b.fields(spark, sf_dir).withColumns({"crop": crop, "yield": F.col("ord") / 4})
    field_files.write_feature_lines(own.repartition(4, "ord"), path)
    read = field_files.read_feature_lines(spark, path)
    again = scratch_path(spark, "fields")
    field_files.write_feature_lines(read, again)
    read = field_files.read_feature_lines(spark, again)
    return read.select(
        "ord",
        "field_id",
        F.date_format(F.to_date("planting_date"), "yyyy-MM-dd").alias("planting_date"),
        F.get_json_object("properties", "$.crop").alias("crop"),
        F.get_json_object("properties", "$.yield").cast("double").alias("yield"),
        F.size(F.flatten(F.flatten("geom"))).cast("long").alias("n_vertices"),
        *box_columns(geometry.bounds(F.col("geom")), 9),
    )


@query
def fields_scan_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields as FeatureCollection files, cut into pieces and put together by the structural index."""
    path = scratch_path(spark, "collections")
    shaped = b.fields(spark, sf_dir)
    texts = shaped.select("ord", field_files.feature_text(shaped).alias("t"))
    # at most FEATURES_PER_FILE features meet in a row, and each row is a file
    lists = texts.groupBy(F.floor(F.col("ord") / b.FEATURES_PER_FILE).alias("part")).agg(F.array_sort(F.collect_list(F.struct("ord", "t"))).alias("l"))
    whole = F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join(F.col("l.t"), ",\n"), F.lit("]}"))
    lists.select(F.lpad(F.col("part").cast("string"), 12, "0").alias("part"), whole.alias("value")).write.partitionBy("part").text(path)
    return collection.read_collection_split(spark, path).select(
        "ord", "field_id", F.date_format(F.to_date("planting_date"), "yyyy-MM-dd").alias("planting_date"), *box_columns(geometry.bounds(F.col("geom")), 9)
    )


@query
def fields_feature_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    shaped = b.fields(spark, sf_dir)
    text = shaped.select(field_files.feature_text(shaped).alias("t"))

    def member(path: str) -> Column:
        return F.get_json_object("t", path)

    return text.select(
        member("$.type").alias("type"),
        member("$.id").cast("long").alias("ord"),
        member("$.properties.field_id").alias("field_id"),
        member("$.properties.planting_date").alias("planting_date"),
        member("$.geometry.type").alias("geometry_type"),
        *(
            F.round(member(f"$.geometry.coordinates[0][{k}][{i}]").cast("double"), 9).alias(f"{axis}{k}")
            for k in range(5)
            for i, axis in enumerate(("lon", "lat"))
        ),
    )


@query
def crs_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    which = F.col("ord") % 3
    labelled = (
        b.fields(spark, sf_dir)
        .withColumn(
            "crs",
            F.when(which == 1, "urn:ogc:def:crs:OGC:1.3:CRS84").when(which == 2, "EPSG:3035"),
        )
        .withColumn(
            "geom",
            F.when(which == 2, geometry.project_metres(F.col("geom"))).otherwise(F.col("geom")),
        )
    )
    degrees = geometry.normalize_crs(F.col("geom"), F.col("crs"))
    return labelled.select("ord", "crs", F.posexplode(vertices(degrees)).alias("k", "p")).select(
        "ord",
        "crs",
        F.col("k").cast("long").alias("k"),
        F.round(F.col("p")[0], 8).alias("lon"),
        F.round(F.col("p")[1], 8).alias("lat"),
    )


@query
def crs_systems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vertices in each of the parametrised systems in turn, and back in degrees."""
    numbers = F.array(*[F.lit(n) for n in projection.SYSTEMS])
    labelled = b.fields(spark, sf_dir).withColumn("epsg", F.get(numbers, (F.col("ord") % len(projection.SYSTEMS)).cast("int")))
    metres = geometry.map_vertices(F.col("geom"), lambda x, y: projection.from_lonlat(x, y, F.col("epsg")))
    named = labelled.withColumn("crs", F.concat(F.lit("urn:ogc:def:crs:EPSG::"), F.col("epsg").cast("string"))).withColumn("metres", metres)
    pairs = F.arrays_zip(vertices(F.col("metres")).alias("m"), vertices(geometry.normalize_crs(F.col("metres"), F.col("crs"))).alias("d"))
    return named.select("ord", "epsg", F.posexplode(pairs).alias("k", "p")).select(
        "ord",
        "epsg",
        F.col("k").cast("long").alias("k"),
        F.round(F.col("p.m")[0], 3).alias("x"),
        F.round(F.col("p.m")[1], 3).alias("y"),
        F.round(F.col("p.d")[0], 8).alias("lon"),
        F.round(F.col("p.d")[1], 8).alias("lat"),
    )


@query
def project_laea(spark: SparkSession, sf_dir: str) -> DataFrame:
    metres = geometry.project_metres(F.col("geom"))
    return (
        b.fields(spark, sf_dir)
        .select("ord", F.posexplode(vertices(metres)).alias("k", "p"))
        .select(
            "ord",
            F.col("k").cast("long").alias("k"),
            F.round(F.col("p")[0], 3).alias("x"),
            F.round(F.col("p")[1], 3).alias("y"),
        )
    )


@query
def unproject_laea(spark: SparkSession, sf_dir: str) -> DataFrame:
    metres = project_laea(spark, sf_dir)
    return metres.withColumn("p", projection.laea_inverse(F.col("x"), F.col("y"))).select(
        "ord", "k", F.round(F.col("p")[0], 8).alias("lon"), F.round(F.col("p")[1], 8).alias("lat")
    )


@query
def centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aoi.field_points(b.fields(spark, sf_dir)).select("ord", "x", "y")


# --- clustering and areas ----------------------------------------------------------


@query
def nn_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = materialize(aoi.field_points(b.fields(spark, sf_dir)), "points")
    return neighbors.nearest_distance(points).select("ord", rounded("nn_dist", 6))


@query
def eps_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aoi.estimate_eps(Stage(spark, sf_dir).nearest()).select(rounded("eps", 6))


@query
def eps_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = Stage(spark, sf_dir)
    return neighbors.radius_pairs(s.points(), s.eps_value()).select("a", "b", rounded("dist", 6))


@query
def dbscan_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = Stage(spark, sf_dir)
    return aoi.cluster_fields(s.points(), 2, eps=s.eps_value())


@query
def dbscan_min5(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = Stage(spark, sf_dir)
    return aoi.cluster_fields(s.points(), 5, eps=s.eps_value())


@query
def dbscan_all_noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aoi.cluster_fields(Stage(spark, sf_dir).points(), 2, eps=1.0)


@query
def aois(spark: SparkSession, sf_dir: str) -> DataFrame:
    boxes, _ = daily.infer_areas(b.fields(spark, sf_dir))
    return boxes.select("aoi_id", *lonlat_box())


def lonlat_box(digits: int = 8) -> list[Column]:
    names = ("minlon", "minlat", "maxlon", "maxlat")
    return [F.round(F.col("bbox")[i], digits).alias(n) for i, n in enumerate(names)]


@query
def fields_with_aoi(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = Stage(spark, sf_dir)
    tagged = aoi.tag_fields(b.fields(spark, sf_dir), s.clusters(), s.aois())
    return tagged.select("ord", "field_id", day("planting_date"), "aoi_id")


@query
def aoi_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "aois")
    field_files.write_aois(Stage(spark, sf_dir).aois(), path)
    return field_files.read_aois(spark, path).select("aoi_id", *lonlat_box())


# --- days and scenes ---------------------------------------------------------------


@query
def day_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.day_range(b.fields(spark, sf_dir), b.AS_OF).select(day())


@query
def aoi_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Stage(spark, sf_dir).pairs().select("aoi_id", day())


@query
def scenes_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scenes of a box and a few days, from the files of the laid-out catalog that can hold them."""
    path = scratch_path(spark, "catalog")
    catalog.write_catalog(b.scenes(spark, sf_dir), path, b.CATALOG_FILE)
    found = catalog.search(spark, path, b.SEARCH_BOX, *b.SEARCH_DAYS)
    return found.select("item_id", moment("dt"), "cloud_cover", *(rounded(c, 9) for c in ("xmin", "ymin", "xmax", "ymax")))


@query
def scenes_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "items")
    stamp = F.date_format("dt", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    asset = F.transform_values(
        "assets",
        lambda _, a: F.struct(
            a["href"].alias("href"),
            a["proj_epsg"].alias("proj:epsg"),
            F.array(F.struct(a["scale"], a["offset"], a["nodata"])).alias("raster:bands"),
        ),
    )
    items = b.scenes(spark, sf_dir).select(
        F.col("item_id").alias("id"),
        "collection",
        F.array("xmin", "ymin", "xmax", "ymax").alias("bbox"),
        F.struct(
            stamp.alias("datetime"),
            F.col("cloud_cover").alias("eo:cloud_cover"),
            F.col("proj_epsg").alias("proj:epsg"),
        ).alias("properties"),
        asset.alias("assets"),
    )
    items.write.json(path)
    return scene_files.read_scene_items(spark, path).select(
        "item_id",
        "collection",
        moment("dt"),
        "cloud_cover",
        F.col("proj_epsg").cast("long").alias("proj_epsg"),
        *(rounded(c, 6) for c in ("xmin", "ymin", "xmax", "ymax")),
        F.concat_ws(",", F.array_sort(F.map_keys("assets"))).alias("asset_keys"),
    )


@query
def scene_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = selection.scene_candidates(Stage(spark, sf_dir).aois(), b.scenes(spark, sf_dir))
    return found.select("aoi_id", "item_id", day())


@query
def best_scene(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = selection.best_scenes(Stage(spark, sf_dir).aois(), b.scenes(spark, sf_dir))
    return best.select("aoi_id", day(), "item_id", moment("dt"), "cloud_cover")


@query
def scene_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = selection.top_scenes(Stage(spark, sf_dir).aois(), b.scenes(spark, sf_dir), 3)
    return best.select("aoi_id", day(), F.col("rank").cast("long").alias("rank"), "item_id")


@query
def scene_topk_closed_second(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates of days that end at 23:59:59 sharp, counted per area and day."""
    areas, items = Stage(spark, sf_dir).aois(), b.scenes(spark, sf_dir)
    found = selection.scene_candidates(areas, items, closed_second=True)
    return found.groupBy("aoi_id", day()).agg(F.count(F.lit(1)).alias("n"))


def _ref_columns() -> list[Column | str]:
    return [
        "aoi_id",
        day(),
        "status",
        *lonlat_box(),
        moment("item_datetime"),
        "cloud_cover",
        "stac_url",
        "collection",
        "item_id",
        "b04_asset",
        "b08_asset",
    ]


@query
def scene_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = Stage(spark, sf_dir)
    refs = daily.select_scenes(
        s.aois(), s.tagged(), b.scenes(spark, sf_dir), as_of=b.AS_OF, catalog_url=b.CATALOG
    )
    return refs.select(*_ref_columns())


@query
def ref_scene_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = (
        Stage(spark, sf_dir).refs().where("status = 'ok'")
        .select("aoi_id", "date", "collection", "item_id")
    )
    return scene_files.find_scenes(b.scenes(spark, sf_dir), wanted).select(
        "aoi_id", day(), "item_id", moment("dt"), "cloud_cover", F.col("proj_epsg").cast("long")
    )


@query
def refs_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "refs")
    refs = Stage(spark, sf_dir).refs()
    keyed.append_refs(refs.where(_third()), path)
    known = keyed.written_keys(spark, path, keyed.REF_SCHEMA)
    keyed.append_refs(incremental.missing_pairs(refs, known), path)
    return keyed.read_refs(spark, path).select(*_ref_columns())


@query
def pick_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.scenes(spark, sf_dir).select(
        "item_id",
        find_asset(F.col("assets"), RED_ASSETS).alias("b04_asset"),
        find_asset(F.col("assets"), NIR_ASSETS).alias("b08_asset"),
    )


@query
def pick_epsg_of_scene(spark: SparkSession, sf_dir: str) -> DataFrame:
    assets = F.col("assets")
    epsg = pick_epsg(
        F.col("proj_epsg"), assets, find_asset(assets, RED_ASSETS), find_asset(assets, NIR_ASSETS)
    )
    return b.scenes(spark, sf_dir).select("item_id", epsg.cast("long").alias("epsg"))


QUERIES["pick_epsg"] = QUERIES.pop("pick_epsg_of_scene")


# --- incremental runs --------------------------------------------------------------


def _turn(modulus: int) -> Column:
    """(area number + day of month) modulo ``modulus``, to stand for earlier outputs."""
    number = F.regexp_extract("aoi_id", r"(\d+)$", 1).cast("int")
    return (number + F.dayofmonth("date")) % modulus


def _third() -> Column:
    return _turn(3) == 0


@query
def incremental_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = Stage(spark, sf_dir).pairs()
    return incremental.missing_days(pairs, pairs.where(_third())).select(day())


@query
def incremental_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = Stage(spark, sf_dir)
    existing = s.refs().where(_third())
    refs = daily.select_scenes(
        s.aois(), s.tagged(), b.scenes(spark, sf_dir), existing, as_of=b.AS_OF, match_bbox=True
    )
    return refs.select("aoi_id", day(), "status", "item_id")


@query
def incremental_ndvi(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = Stage(spark, sf_dir)
    work = ndvi.work_set(s.tagged(), s.pairs())
    results = s.pairs().where(_third())
    refs = s.refs().where(_turn(5) != 0)
    return incremental.pending_ndvi(work, results, refs).select("aoi_id", day())


# --- pixels ------------------------------------------------------------------------


@query
def pixel_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    strips = Stage(spark, sf_dir).strips()
    found = raster_files.scan_pixels(strips, ["red"], rows=(10, 90), cols=(20, 100))
    return found.where("raw is not null").select(
        "item_id", "band", "row", "col", F.col("layer").cast("long").alias("layer"), "raw"
    )


@query
def pixel_rescale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ndvi.rescaled(b.values(spark, sf_dir)).select(
        "item_id", "row", "col", "obs_order", F.col("obs_line").cast("long").alias("obs_line"),
        "band", rounded("value", 6),
    )


@query
def pixel_world_coords(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = b.pixels(spark, sf_dir).where("band = 'red'").select("item_id", "row", "col").distinct()
    x = raster.pixel_x(F.lit(b.GRID_X0), F.lit(b.GRID_RES), F.col("col"))
    y = raster.pixel_y(F.lit(b.GRID_Y0), F.lit(b.GRID_RES), F.col("row"))
    return cells.select(
        "item_id", "row", "col", F.round(x, 6).alias("x"), F.round(y, 6).alias("y")
    )


@query
def ndvi_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = ndvi.align_bands(
        ndvi.rescaled(b.values(spark, sf_dir)), ["item_id", "row", "col", *b.OBSERVATION]
    )
    return ndvi.with_ndvi(aligned).select(
        "item_id", "row", "col", "obs_order", F.col("obs_line").cast("long").alias("obs_line"),
        rounded("red", 6), rounded("nir", 6), rounded("ndvi", 9),
    )


# --- masks -------------------------------------------------------------------------


@query
def eligible_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mask.eligible_fields(Stage(spark, sf_dir).tagged(), F.lit(b.MASK_DAY))
    return found.select("ord", "field_id", "aoi_id", day("planting_date"))


@query
def eligible_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mask.eligible_bounds(Stage(spark, sf_dir).tagged(), F.lit(b.MASK_DAY))
    return found.select("aoi_id", *(rounded(c, 9) for c in ("xmin", "ymin", "xmax", "ymax")))


def _area_grids(s: Stage) -> DataFrame:
    """Every area looks at all four rasters."""
    rasters = F.array(*(F.lit(str(i)) for i in range(4)))
    return s.aois().select("aoi_id", F.explode(rasters).alias("grid_id"))


@query
def union_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = Stage(spark, sf_dir)
    planted = mask.eligible_fields(s.tagged(), F.lit(b.MASK_DAY))
    grids = b.grids(spark, sf_dir)
    spans = mask.field_spans(mask.fields_on_grids(planted, _area_grids(s), grids))
    return mask.merge_spans(mask.dated_runs(spans), ["aoi_id", "grid_id", "row"])


@query
def union_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area and bounds of the dissolved geometry of every area's planted fields."""
    planted = mask.eligible_fields(Stage(spark, sf_dir).tagged(), F.lit(b.MASK_DAY))
    found = dissolve.union_figures(planted)
    return found.select("aoi_id", rounded("area", 9), *(rounded(c, 8) for c in ("xmin", "ymin", "xmax", "ymax")))


def _masked_counts(
    spark: SparkSession, sf_dir: str, coarse: int, whole_if_tiny: bool = True
) -> DataFrame:
    s = Stage(spark, sf_dir)
    seen = b.pixels(spark, sf_dir).where("band = 'red'").withColumns(
        {"row": F.floor(F.col("row") / coarse), "col": F.floor(F.col("col") / coarse)}
    )
    runs = mask.area_mask(
        s.tagged(), _area_grids(s), b.grids(spark, sf_dir, coarse), whole_if_tiny
    )
    visits = _area_grids(s).select(
        "aoi_id", "grid_id", F.lit(b.MASK_DAY).alias("date"), F.col("grid_id").alias("item_id")
    )
    inside = mask.masked_pixels(seen, mask.mask_on(runs, visits))
    return inside.groupBy("aoi_id", "item_id", "row", "col").agg(F.count(F.lit(1)).alias("n"))


@query
def pixel_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _masked_counts(spark, sf_dir, 1)


@query
def pixel_mask_tiny(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _masked_counts(spark, sf_dir, b.COARSE)


@query
def pixel_mask_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The coarse grid again, without the rule for tiny windows."""
    return _masked_counts(spark, sf_dir, b.COARSE, whole_if_tiny=False)


@query
def pixel_mask_utm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns covered by planted fields on the grids of three UTM zones."""
    s = Stage(spark, sf_dir)
    zones = F.array(*(F.lit(str(z)) for z, _ in b.UTM_GRIDS))
    looked = s.aois().select("aoi_id", F.explode(zones).alias("grid_id"))
    runs = mask.area_mask(s.tagged(), looked, b.utm_grids(spark), whole_if_tiny=False)
    planted = runs.where(F.col("from_date") <= F.lit(b.MASK_DAY))
    return mask.merge_spans(planted, ["aoi_id", "grid_id", "row"])


# --- daily index -------------------------------------------------------------------


def _records(spark: SparkSession, sf_dir: str, pixels: DataFrame | None = None) -> DataFrame:
    s = Stage(spark, sf_dir)
    return daily.daily_ndvi(
        s.tagged(),
        s.pairs(),
        s.refs(),
        b.scenes(spark, sf_dir),
        b.rasters(spark, sf_dir),
        b.grids(spark, sf_dir),
        b.pixels(spark, sf_dir) if pixels is None else pixels,
        observation=b.OBSERVATION,
        match_epsg=False,
    )


def _record_columns() -> list[Column | str]:
    return [
        "aoi_id",
        day(),
        "status",
        rounded("mean_ndvi", 9),
        "cloud_cover",
        moment("item_datetime"),
    ]


@query
def ndvi_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = Stage(spark, sf_dir)
    work = ndvi.work_set(s.tagged(), s.pairs())
    some = s.refs().where(_turn(5) != 0)
    resolved = ndvi.resolved_refs(work, some, b.scenes(spark, sf_dir))
    return resolved.select("aoi_id", day(), "status", F.col("epsg").cast("long").alias("epsg"))


@query
def ndvi_by_aoi_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir).select(*_record_columns())


@query
def ndvi_utm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily index with every scene on the grid of its own UTM zone."""
    s = Stage(spark, sf_dir)
    records = daily.daily_ndvi(
        s.tagged(),
        s.pairs(),
        s.refs(),
        b.scenes(spark, sf_dir),
        b.utm_rasters(spark, sf_dir),
        b.utm_grids(spark),
        b.pixels(spark, sf_dir),
        observation=b.OBSERVATION,
        whole_if_tiny=False,
    )
    return records.select(*_record_columns())


@query
def ndvi_from_strips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same stage from a dense strip table of all observations."""
    strips = Stage(spark, sf_dir).strips()
    return _records(spark, sf_dir, strips).select(*_record_columns())


@query
def ndvi_strip_widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """And from strips of other widths and starts, which must not matter."""
    widths = (("300", 300, 0), ("512", 512, 0), ("1024", 1024, 0), ("100 from 37", 100, 37))
    out = [
        _records(spark, sf_dir, Stage(spark, sf_dir).strips(width, shift)).select(
            F.lit(name).alias("strips"), *_record_columns()
        )
        for name, width, shift in widths
    ]
    return reduce(DataFrame.unionByName, out)


@query
def ndvi_mixed_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily index of scenes whose near-infrared band has cells of twice the size."""
    red = b.brightest(spark, sf_dir, "red")
    nir = materialize(b.brightest(spark, sf_dir, "nir", 2), "coarse-band")
    fine = resample.nearest(nir, b.moved_from(nir, b.HALF_GRID, b.FINE_GRID))
    return _records(spark, sf_dir, red.unionByName(fine)).select(*_record_columns())


@query
def raster_resample_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area means of a band on a grid of half the resolution and on one whose cells cut those of the band."""
    strips = materialize(b.brightest(spark, sf_dir, "nir"), "fine-band")
    out = []
    for name, grid in (("half", b.HALF_GRID), ("uneven", b.UNEVEN_GRID)):
        moved = resample.area_mean(strips, b.moved_from(strips, b.FINE_GRID, grid), nodata=-9999.0)
        cells = raster_files.scan_pixels(moved, ["nir"]).where("raw is not null")
        out.append(cells.select(F.lit(name).alias("grid"), "item_id", "row", "col", F.round("raw", 6).alias("value")))
    return reduce(DataFrame.unionByName, out)


@query
def ndvi_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "series")
    records = materialize(_records(spark, sf_dir), "records")
    # a stale first version of some keys must be replaced, all others must stay
    keyed.write_ndvi(records.where(_third()).withColumn("status", F.lit("stale")), path)
    keyed.write_ndvi(records.where(_turn(3) == 1), path)
    keyed.write_ndvi(records.where(_third()), path)
    keyed.write_ndvi(records.where(_turn(3) == 2), path)
    return keyed.read_ndvi(spark, path).select(*_record_columns())


@query
def stage_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = Stage(spark, sf_dir)
    layout = daily.Layout("unused")
    records = _records(spark, sf_dir)
    first = daily.first_result(records, layout.calculation, "processed")
    return daily.stage_manifest(s.aois(), layout, "processed").withColumn(
        "first_result", first.scalar()
    )


# --- addresses ---------------------------------------------------------------------


@query
def uri_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = F.concat(
        F.lit("s3://"), "lang", F.lit("/"), "source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".json")
    )
    return b.table(spark, sf_dir, "documents").select(
        "doc_id", keys.split_uri(uri).alias("u")
    ).select("doc_id", "u.bucket", "u.key")


@query
def partition_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = Stage(spark, sf_dir).pairs().select("aoi_id", day())
    return pairs.select(
        "aoi_id",
        "date",
        keys.reference_path("ingest//", F.col("aoi_id"), F.col("date")).alias("ref_path"),
        keys.ndvi_path("calculation", F.col("aoi_id"), F.col("date")).alias("ndvi_path"),
    )


# --- streaming ---------------------------------------------------------------------


@query
def stream_scene_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs = _streamed_refs(spark, sf_dir)
    return keyed.read_refs(spark, refs).select(
        "aoi_id", day(), "status", "item_id", "cloud_cover", "stac_url"
    )


def _streamed_refs(spark: SparkSession, sf_dir: str) -> str:
    source, target, state = (scratch_path(spark, n) for n in ("feed", "refs", "state"))
    b.scenes(spark, sf_dir).repartitionByRange(4, "dt").sortWithinPartitions("dt").write.parquet(source)
    areas = Stage(spark, sf_dir).aois()
    best = stream.stream_best_scenes(stream.read_scene_stream(spark, source), areas)
    stream.append_refs(best, areas, target, state, b.CATALOG).awaitTermination()
    stream.close_refs(b.scenes(spark, sf_dir), areas, target, catalog_url=b.CATALOG)
    return target


@query
def stream_scene_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All references, ``ok`` and ``no_items``, from the scene stream alone."""
    source, target, state = (scratch_path(spark, n) for n in ("feed", "refs", "state"))
    b.scenes(spark, sf_dir).repartitionByRange(4, "dt").sortWithinPartitions("dt").write.parquet(source)
    stream_days.end_of_input(spark, source, b.AS_OF)
    areas = materialize(stream_days.area_spans(Stage(spark, sf_dir).pairs()), "spans")
    refs = stream_days.stream_days(stream.read_scene_stream(spark, source), areas, catalog_url=b.CATALOG)
    stream_days.write_days(refs, target, state).awaitTermination()
    return keyed.read_refs(spark, target).select(*_ref_columns())


@query
def stream_ndvi(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = Stage(spark, sf_dir)
    series, state = scratch_path(spark, "series"), scratch_path(spark, "state")

    def compute(refs: DataFrame) -> DataFrame:
        return daily.daily_ndvi(
            s.tagged(),
            refs.select("aoi_id", "date"),
            refs,
            b.scenes(spark, sf_dir),
            b.rasters(spark, sf_dir),
            b.grids(spark, sf_dir),
            b.pixels(spark, sf_dir),
            observation=b.OBSERVATION,
            match_epsg=False,
        )

    refs = scratch_path(spark, "refs")
    keyed.append_refs(s.refs().where(F.dayofmonth("date") <= 10), refs)
    feed = stream.read_ref_stream(spark, refs)
    stream.append_ndvi(feed, compute, series, state).awaitTermination()
    keyed.append_refs(s.refs().where(F.dayofmonth("date") > 10), refs)
    stream.append_ndvi(feed, compute, series, state).awaitTermination()
    return keyed.read_ndvi(spark, series).select(*_record_columns())
