"""The three stages end to end: areas, scene references, daily index.

Every stage takes and gives DataFrames; all areas and days go through one set of
jobs. ``run_*`` add the reading and writing of the stage outputs below one root.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdure.functions.keys import ndvi_path, prefix_path
from verdure.operators import aoi, incremental, mask, ndvi, selection
from verdure.session import cleaned, materialize
from verdure.sources import fields as field_files
from verdure.sources import keyed


@dataclass(frozen=True)
class Layout:
    """Folders of the stage outputs below ``root``."""

    root: str
    derived: str = "derived/"
    ingest: str = "ingest/"
    calculation: str = "calculation/"

    def _under(self, prefix: str) -> str:
        return f"{self.root.rstrip('/')}/{prefix_path(prefix)}"

    @property
    def aois(self) -> str:
        return self._under(self.derived) + "aois.json"

    @property
    def tagged_fields(self) -> str:
        return self._under(self.derived) + "fields_with_aoi.geojson"

    @property
    def refs(self) -> str:
        return self._under(self.ingest).rstrip("/")

    @property
    def series(self) -> str:
        return self._under(self.calculation) + "aoi_timeseries"


@dataclass(frozen=True)
class AreaSettings:
    min_samples: int = 2
    eps_quantile: float = 0.90
    padding: float = 2000.0


def infer_areas(
    fields: DataFrame, settings: AreaSettings = AreaSettings()
) -> tuple[DataFrame, DataFrame]:
    """(aoi_id, cluster, bbox) and the fields with their ``aoi_id``."""
    points = materialize(aoi.field_points(fields), "field-points")
    clusters = materialize(
        aoi.cluster_fields(points, settings.min_samples, settings.eps_quantile), "clusters"
    )
    aois = materialize(aoi.aoi_boxes(points, clusters, settings.padding), "aois")
    return aois, aoi.tag_fields(fields, clusters, aois)


def stage_manifest(aois: DataFrame, layout: Layout, bucket: str) -> DataFrame:
    """One row naming the outputs of the first stage and the number of areas."""
    return aois.agg(F.count(F.lit(1)).alias("aois_count")).select(
        F.lit(bucket).alias("processed_bucket"),
        F.lit(prefix_path(layout.derived)).alias("derived_out_prefix"),
        F.lit(prefix_path(layout.ingest)).alias("ingest_out_prefix"),
        F.lit(prefix_path(layout.calculation)).alias("calc_out_prefix"),
        F.lit(f"s3://{bucket}/{prefix_path(layout.derived)}aois.json").alias("aois_json_s3"),
        F.lit(f"s3://{bucket}/{prefix_path(layout.derived)}fields_with_aoi.geojson").alias(
            "fields_with_aoi_s3"
        ),
        "aois_count",
    )


def first_result(records: DataFrame, prefix: str, bucket: str) -> DataFrame:
    """Address of the result of the first area in id order; no row without results."""
    day = F.date_format("date", "yyyy-MM-dd")
    address = F.concat(F.lit(f"s3://{bucket}/"), ndvi_path(prefix, F.col("aoi_id"), day))
    return records.orderBy("aoi_id", "date").limit(1).select(address.alias("uri"))


def select_scenes(
    aois: DataFrame,
    fields: DataFrame,
    scenes: DataFrame,
    existing: DataFrame | None = None,
    as_of: dt.date | None = None,
    max_cloud: float = selection.MAX_CLOUD,
    refresh_missing: bool = False,
    match_bbox: bool = False,
    catalog_url: str | None = None,
) -> DataFrame:
    """References for every (area, day) that has none among ``existing`` yet."""
    pairs = selection.aoi_days(aois, fields, as_of)
    if existing is not None:
        kept = incremental.refreshable(existing) if refresh_missing else existing
        pairs = incremental.missing_pairs(pairs, kept, match_bbox)
        scenes = selection.scenes_of_days(scenes, pairs)
    return selection.scene_refs(pairs, scenes, max_cloud, catalog_url)


def daily_ndvi(
    fields: DataFrame,
    pairs: DataFrame,
    refs: DataFrame,
    scenes: DataFrame,
    rasters: DataFrame,
    grids: DataFrame,
    pixels: DataFrame,
    results: DataFrame | None = None,
    observation: list[str] | None = None,
    match_epsg: bool = True,
    whole_if_tiny: bool = True,
) -> DataFrame:
    """One record per (area, day) of ``pairs`` with planted fields and a reference.

    The coordinate system chosen for a scene has to be that of its grid, which the mask is made on;
    ``match_epsg=False`` trusts the grids. ``whole_if_tiny`` is that of ``mask.area_mask``.

    ``results`` are earlier records to skip. ``pixels`` is either a strip table (item_id,
    band, row, col0, values) or the long table (item_id, band, row, col, raw), for which
    ``observation`` names further columns that tell several observations of a cell apart.
    """
    selection.require_columns(fields, "planting_date", "aoi_id")
    work = ndvi.work_set(fields, pairs)
    if results is not None:
        work = incremental.pending_ndvi(work, results, refs)
    else:
        work = work.join(refs.select("aoi_id", "date"), ["aoi_id", "date"], "left_semi")
    resolved = materialize(ndvi.resolved_refs(work, refs, scenes), "resolved")
    visits = ndvi.visits_of(resolved, rasters)
    visits = materialize(ndvi.on_their_grids(visits, grids) if match_epsg else visits, "visits")
    runs = mask.area_mask(fields, visits, grids, whole_if_tiny)
    pixels = ndvi.visited_bands(pixels, visits)
    if "values" in pixels.columns:
        means = ndvi.area_means_of_strips(pixels, runs, visits)
    else:
        means = ndvi.area_means(pixels, runs, visits, observation)
    return ndvi.ndvi_records(resolved, means)


def run_areas(
    spark: SparkSession,
    fields_path: str,
    layout: Layout,
    settings: AreaSettings = AreaSettings(),
    lines: bool = False,
) -> None:
    """Field files to area list and tagged fields; ``lines`` reads line-delimited features."""
    with cleaned(spark):
        read = field_files.read_feature_lines if lines else field_files.read_feature_collection
        fields = materialize(read(spark, fields_path), "fields")
        field_files.require_property(fields, "planting_date")
        aois, tagged = infer_areas(fields, settings)
        field_files.write_aois(aois, layout.aois)
        field_files.write_feature_lines(tagged.drop("crs"), layout.tagged_fields)


TAGGED_PROPERTIES = "field_id string, planting_date string, aoi_id string"


def run_scenes(
    spark: SparkSession,
    scenes: DataFrame,
    layout: Layout,
    as_of: dt.date | None = None,
    max_cloud: float = selection.MAX_CLOUD,
    refresh_missing: bool = False,
    catalog_url: str | None = None,
) -> None:
    """Write the references that are still missing; what is there stays as it is."""
    with cleaned(spark):
        aois = field_files.read_aois(spark, layout.aois)
        fields = field_files.read_feature_lines(spark, layout.tagged_fields, TAGGED_PROPERTIES)
        field_files.require_property(fields, "planting_date")
        existing = keyed.read_refs(spark, layout.refs)
        refs = select_scenes(
            aois, fields, scenes, existing, as_of, max_cloud, refresh_missing, catalog_url=catalog_url
        )
        if refresh_missing:
            keyed.replace_refs(refs, layout.refs)
        else:
            keyed.append_refs(materialize(refs, "refs"), layout.refs)


def run_ndvi(
    spark: SparkSession,
    scenes: DataFrame,
    rasters: DataFrame,
    grids: DataFrame,
    pixels: DataFrame,
    layout: Layout,
    day: dt.date | None = None,
    match_epsg: bool = True,
) -> None:
    """Write the records that are still missing, for one day or for all referenced days."""
    with cleaned(spark):
        fields = field_files.read_feature_lines(spark, layout.tagged_fields, TAGGED_PROPERTIES)
        refs = keyed.read_refs(spark, layout.refs)
        if day is not None:
            refs = refs.where(F.col("date") == F.lit(day))
        results = keyed.written_keys(spark, layout.series, keyed.NDVI_SCHEMA)
        records = daily_ndvi(
            fields,
            refs.select("aoi_id", "date"),
            refs,
            scenes,
            rasters,
            grids,
            pixels,
            results,
            match_epsg=match_epsg,
        )
        keyed.write_ndvi(records, layout.series)
