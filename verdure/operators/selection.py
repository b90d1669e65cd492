"""Days, scene candidates and the best scene per area and day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdure.functions.assets import NIR_ASSETS, RED_ASSETS, pick_asset

MAX_CLOUD = 30.0
MISSING_CLOUD = 999.0
CELL_DEGREES = 1.0  # about the footprint of one scene: few cells per scene and per area
LAST_SECOND = 86399


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"input must contain {missing}; it has {df.columns}")
    return df


def as_of_day(as_of: dt.date | None) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of).cast("date")


def day_range(fields: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """(date): every day from the earliest planting date to ``as_of``, both included.

    Nothing when no field has a planting date or the first one lies ahead.
    """
    require_columns(fields, "planting_date")
    first = fields.agg(F.min(F.to_date("planting_date")).alias("first"))
    last = as_of_day(as_of)
    days = F.when(F.col("first") <= last, F.sequence("first", last, F.expr("interval 1 day")))
    return first.select(F.explode(days).alias("date"))


def aoi_days(aois: DataFrame, fields: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """(aoi_id, bbox, date) for every area and day.

    The first day is a scalar subquery, so each area row spreads its own days and
    no product of two tables is formed.
    """
    require_columns(fields, "planting_date")
    first = fields.select(F.min(F.to_date("planting_date"))).scalar()
    dated = aois.withColumn("first", first)
    last = as_of_day(as_of)
    days = F.when(F.col("first") <= last, F.sequence("first", last, F.expr("interval 1 day")))
    return dated.select("aoi_id", "bbox", F.explode(days).alias("date"))


def eligible_scenes(
    scenes: DataFrame, max_cloud: float = MAX_CLOUD, closed_second: bool = False
) -> DataFrame:
    """Scenes below the cloud limit with the UTC ``date`` they lie in.

    A scene without a cloud value does not pass. ``closed_second`` ends a day at 23:59:59 sharp, as a catalog asked
    for closed intervals in whole seconds does; scenes of the fraction of a second after it then pass for no day.
    """
    passed = scenes.where(F.col("cloud_cover") < max_cloud).withColumn("date", F.to_date("dt"))
    if not closed_second:
        return passed.where(F.col("dt").isNotNull())
    seconds = F.hour("dt") * 3600 + F.minute("dt") * 60 + F.date_part(F.lit("SECOND"), "dt")
    return passed.where(seconds <= LAST_SECOND)


def scenes_of_days(scenes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Scenes of the days of ``pairs``.

    The first and last day are scalar subqueries and reach the scan as bounds on ``dt``; the days between them that
    no pair asks for fall to a semi join.
    """
    first = pairs.select(F.min("date").cast("timestamp_ntz")).scalar()
    after = pairs.select(F.date_add(F.max("date"), 1).cast("timestamp_ntz")).scalar()
    bounded = scenes.where((F.col("dt") >= first) & (F.col("dt") < after)).withColumn("_day", F.to_date("dt"))
    days = pairs.select(F.col("date").alias("_day")).distinct()
    return bounded.join(days, "_day", "left_semi").drop("_day")


def _cells(xmin: Column, ymin: Column, xmax: Column, ymax: Column, size: float) -> Column:
    def steps(lo: Column, hi: Column) -> Column:
        return F.sequence(F.floor(lo / size), F.floor(hi / size))

    return F.flatten(
        F.transform(
            steps(xmin, xmax),
            lambda i: F.transform(
                steps(ymin, ymax), lambda j: F.struct(i.alias("i"), j.alias("j"))
            ),
        )
    )


def intersecting(
    aois: DataFrame, footprints: DataFrame, size: float = CELL_DEGREES, by: tuple[str, ...] = ()
) -> DataFrame:
    """Rows of ``footprints`` (xmin, ymin, xmax, ymax, ...) per area whose box they touch.

    Both sides are spread over grid cells and joined on the cell; a pair that shares
    several cells is kept only in the cell of its common lower-left corner, so no
    duplicate removal is needed afterwards. ``by`` names columns of both sides that must be equal as well, such as the day.
    """
    left = aois.select(
        "aoi_id",
        *by,
        *(F.col("bbox")[i].alias(n) for i, n in enumerate(("axmin", "aymin", "axmax", "aymax"))),
    )
    left = left.withColumn(
        "cell", F.explode(_cells(*(F.col(c) for c in ("axmin", "aymin", "axmax", "aymax")), size))
    )
    right = footprints.withColumn(
        "cell", F.explode(_cells(*(F.col(c) for c in ("xmin", "ymin", "xmax", "ymax")), size))
    )
    touches = (
        (F.col("axmin") <= F.col("xmax"))
        & (F.col("axmax") >= F.col("xmin"))
        & (F.col("aymin") <= F.col("ymax"))
        & (F.col("aymax") >= F.col("ymin"))
    )
    corner = F.struct(
        F.floor(F.greatest("axmin", "xmin") / size).alias("i"),
        F.floor(F.greatest("aymin", "ymin") / size).alias("j"),
    )
    return (
        left.join(right, [*by, "cell"])
        .where(touches & (F.col("cell") == corner))
        .drop("cell", "axmin", "aymin", "axmax", "aymax")
    )


def scene_candidates(
    aois: DataFrame, scenes: DataFrame, max_cloud: float = MAX_CLOUD, closed_second: bool = False
) -> DataFrame:
    """Every (area, scene) pair that passes the cloud, day and box conditions."""
    return intersecting(aois, eligible_scenes(scenes, max_cloud, closed_second))


def scene_order() -> Column:
    """Ascending choice order: cloud, then time, then id; a missing time sorts first."""
    return F.struct(
        F.coalesce("cloud_cover", F.lit(MISSING_CLOUD)).alias("cloud"),
        F.col("dt"),
        F.col("item_id"),
    )


def best_scenes(
    aois: DataFrame, scenes: DataFrame, max_cloud: float = MAX_CLOUD, closed_second: bool = False
) -> DataFrame:
    """The least cloudy scene per (aoi_id, date); ties go to the earlier one.

    Scenes of one day with the same footprint are reduced to their best one before
    the spatial join: they touch the same areas, so no other can win. ``aois`` may have a ``date``: then areas
    meet scenes of that day only, on day and cell, and no other pair is chosen for.
    """
    passed = eligible_scenes(scenes, max_cloud, closed_second)
    carried = F.struct(*passed.columns)
    footprint = ["date", "xmin", "ymin", "xmax", "ymax"]
    leaders = passed.groupBy(*footprint).agg(F.min_by(carried, scene_order()).alias("s"))
    by = ("date",) if "date" in aois.columns else ()
    paired = intersecting(aois, leaders.select("s", *footprint), by=by)
    order = F.struct(
        F.coalesce("s.cloud_cover", F.lit(MISSING_CLOUD)).alias("cloud"), F.col("s.dt"), F.col("s.item_id")
    )
    return (
        paired.groupBy("aoi_id", "date").agg(F.min_by("s", order).alias("s")).select("aoi_id", "s.*")
    )


def top_scenes(aois: DataFrame, scenes: DataFrame, k: int, max_cloud: float = MAX_CLOUD) -> DataFrame:
    """The ``k`` best scenes per (aoi_id, date) with their ``rank``.

    Scenes of one day with the same footprint are reduced to their best ``k`` before the spatial join: they touch the
    same areas, so no other can be among an area's best. What is left is cut to ``k`` per pair before it is shuffled.
    """

    def best(rows: DataFrame, *keys: str) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(F.coalesce("cloud_cover", F.lit(MISSING_CLOUD)), "dt", "item_id")
        return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    leaders = best(eligible_scenes(scenes, max_cloud), "date", "xmin", "ymin", "xmax", "ymax").drop("rank")
    return best(intersecting(aois, leaders), "aoi_id", "date")


def scene_refs(
    pairs: DataFrame,
    scenes: DataFrame,
    max_cloud: float = MAX_CLOUD,
    catalog_url: str | None = None,
) -> DataFrame:
    """One reference per (aoi_id, bbox, date) of ``pairs``: ``ok`` or ``no_items``.

    The bands are looked up in the chosen scene only, so a scene that lacks one fails
    the query only when it would be used.
    """
    best = best_scenes(pairs, scenes, max_cloud).select(
        "aoi_id",
        "date",
        F.col("dt").alias("item_datetime"),
        "cloud_cover",
        "collection",
        "item_id",
        pick_asset(F.col("assets"), RED_ASSETS).alias("b04_asset"),
        pick_asset(F.col("assets"), NIR_ASSETS).alias("b08_asset"),
    )
    found = F.col("item_id").isNotNull()
    return pairs.join(best, ["aoi_id", "date"], "left").select(
        "aoi_id",
        "date",
        F.when(found, "ok").otherwise("no_items").alias("status"),
        "bbox",
        "item_datetime",
        "cloud_cover",
        F.when(found, F.lit(catalog_url)).alias("stac_url"),
        "collection",
        "item_id",
        "b04_asset",
        "b08_asset",
    )
