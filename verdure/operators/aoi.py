"""Areas of interest: clusters of fields with a padded box in degrees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdure.functions import geometry
from verdure.operators.clustering import dbscan
from verdure.operators.neighbors import nearest_distance
from verdure.operators.ranking import exact_quantile
from verdure.operators.skew import salted_lookup
from verdure.session import materialize

MIN_EPS = 1000.0


def field_points(fields: DataFrame, decimals: int = 3) -> DataFrame:
    """(ord, x, y, metre box) of each field; centroids are rounded to the millimetre."""
    metres = geometry.project_metres(F.col("geom"))
    shaped = fields.select("ord", metres.alias("m"))
    return shaped.select(
        "ord",
        geometry.centroid(F.col("m")).alias("c"),
        geometry.bounds(F.col("m")).alias("box"),
    ).select(
        "ord",
        F.round("c.x", decimals).alias("x"),
        F.round("c.y", decimals).alias("y"),
        "box",
    )


def estimate_eps(nn: DataFrame, quantile: float = 0.90, floor: float = MIN_EPS) -> DataFrame:
    """One row ``eps``: a quantile of the nearest-neighbour distances, at least ``floor``."""
    return exact_quantile(nn, "nn_dist", quantile).select(
        F.greatest(F.col("quantile"), F.lit(floor)).alias("eps")
    )


def cluster_fields(
    points: DataFrame, min_samples: int = 2, quantile: float = 0.90, eps: float | None = None
) -> DataFrame:
    """(ord, label, cluster) with the neighbour radius taken from the data unless given."""
    if eps is None:
        eps = estimate_eps(nearest_distance(points), quantile).first()[0]
    return dbscan(points, eps, min_samples)


def aoi_label(number: Column) -> Column:
    """AOI_01, AOI_02, ...; from 100 on the number simply grows longer."""
    return F.format_string("AOI_%02d", number)


def aoi_boxes(points: DataFrame, clusters: DataFrame, padding: float = 2000.0) -> DataFrame:
    """(aoi_id, cluster, bbox): degrees box around all vertices of a cluster plus padding.

    Cluster numbers run from 0 without gaps, so areas are numbered one above them.
    """
    spans = (
        points.join(clusters, "ord")
        .groupBy("cluster")
        .agg(
            F.min("box.xmin").alias("xmin"),
            F.min("box.ymin").alias("ymin"),
            F.max("box.xmax").alias("xmax"),
            F.max("box.ymax").alias("ymax"),
        )
    )
    box = F.struct("xmin", "ymin", "xmax", "ymax")
    return spans.select(
        aoi_label(F.col("cluster") + 1).alias("aoi_id"),
        "cluster",
        geometry.padded_lonlat_box(box, padding).alias("bbox"),
    )


def tag_fields(fields: DataFrame, clusters: DataFrame, aois: DataFrame) -> DataFrame:
    """Fields with their ``aoi_id``; the cluster number itself is not kept."""
    tagged = fields.join(clusters.select("ord", "cluster"), "ord")
    return salted_lookup(tagged, aois.select("cluster", "aoi_id"), ["cluster"]).drop("cluster")
