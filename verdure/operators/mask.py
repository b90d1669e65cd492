"""Field polygons as runs of pixel columns, and the pixels they cover.

A pixel belongs to a field when its centre does (even-odd rule over all rings of the
field, edges half-open). Instead of testing pixels against polygons, each field is cut
into column spans per pixel row, and pixels meet spans in an equi-join on row and
column strip.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdure.functions import geometry, projection
from verdure.operators.skew import salted_lookup
from verdure.session import materialize

STRIP = 512  # columns per join strip
FOREVER = "9999-12-31"
GRID = ["epsg", "x0", "y0", "xres", "yres", "width", "height"]


def eligible_fields(fields: DataFrame, day: Column) -> DataFrame:
    """Fields of a known area planted on or before ``day``; unknown dates are left out."""
    return fields.where(F.col("aoi_id").isNotNull() & (F.to_date("planting_date") <= day))


def eligible_bounds(fields: DataFrame, day: Column) -> DataFrame:
    """(aoi_id, xmin, ymin, xmax, ymax): degrees box of the eligible fields of each area."""
    boxed = eligible_fields(fields, day).select(
        "aoi_id", geometry.bounds(F.col("geom")).alias("b")
    )
    return boxed.groupBy("aoi_id").agg(
        F.min("b.xmin").alias("xmin"),
        F.min("b.ymin").alias("ymin"),
        F.max("b.xmax").alias("xmax"),
        F.max("b.ymax").alias("ymax"),
    )


def fields_on_grids(fields: DataFrame, aoi_grids: DataFrame, grids: DataFrame) -> DataFrame:
    """Every field next to each grid its area is looked at on."""
    wanted = aoi_grids.select("aoi_id", "grid_id").distinct().join(
        grids.select("grid_id", *GRID), "grid_id"
    )
    return salted_lookup(fields, wanted, ["aoi_id"], by=["ord"])


def field_spans(placed: DataFrame) -> DataFrame:
    """Column spans (row, lo, hi) of each field of ``placed`` on its grid.

    One row in, its spans out: the rows of a field, the crossings of a row and their
    pairing are all worked out on the field's own edge array, without a shuffle.
    """
    keep = [c for c in placed.columns if c not in {"geom", *GRID}]
    in_grid = geometry.map_vertices(
        F.col("geom"), lambda x, y: projection.from_lonlat(x, y, F.col("epsg"))
    )
    shaped = placed.withColumn("shape", in_grid).select(
        *keep, *GRID, geometry.edges(F.col("shape")).alias("es"), geometry.bounds(F.col("shape")).alias("b")
    )
    top = F.greatest(F.ceil((F.col("y0") - F.col("b.ymax")) / F.col("yres") - 0.5), F.lit(0))
    bottom = F.least(
        F.floor((F.col("y0") - F.col("b.ymin")) / F.col("yres") - 0.5), F.col("height") - 1
    )
    rows = shaped.select(
        *keep, *GRID, "es", F.explode(F.when(top <= bottom, F.sequence(top, bottom))).alias("row")
    )
    y = F.col("y0") - (F.col("row") + 0.5) * F.col("yres")
    crossed = F.filter(
        "es", lambda e: (F.least(e["y1"], e["y2"]) <= y) & (y < F.greatest(e["y1"], e["y2"]))
    )
    at = F.transform(
        crossed,
        lambda e: e["x1"] + (y - e["y1"]) * (e["x2"] - e["x1"]) / (e["y2"] - e["y1"]),
    )
    cuts = rows.select(*keep, *GRID, "row", F.array_sort(at).alias("xs"))

    def column_at_or_after(x: Column) -> Column:
        return F.ceil((x - F.col("x0")) / F.col("xres") - 0.5)

    def span(i: Column) -> Column:
        return F.struct(
            F.greatest(column_at_or_after(F.get("xs", i * 2)), F.lit(0)).alias("lo"),
            F.least(column_at_or_after(F.get("xs", i * 2 + 1)) - 1, F.col("width") - 1).alias("hi"),
        )

    pairs = F.floor(F.size("xs") / 2).cast("int")
    spans = F.when(pairs > 0, F.transform(F.sequence(F.lit(0), pairs - 1), span))
    return (
        cuts.select(*keep, "row", F.explode(spans).alias("s"))
        .select(*keep, "row", F.col("s.lo").alias("lo"), F.col("s.hi").alias("hi"))
        .where("lo <= hi")
    )


def merge_spans(spans: DataFrame, keys: list[str]) -> DataFrame:
    """Disjoint, non-touching spans (lo, hi) covering the same columns per ``keys``.

    Spans with the same start are folded before the shuffle, which leaves at most one
    per column; overlapping and copied fields therefore cannot fill one window.
    """
    starts = spans.groupBy(*keys, "lo").agg(F.max("hi").alias("hi"))
    order = Window.partitionBy(*keys).orderBy("lo")
    reached = F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(reached.isNull() | (F.col("lo") > reached + 1), 1).otherwise(0)
    islands = starts.withColumn("_new", fresh).withColumn(
        "_island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0))
    )
    return islands.groupBy(*keys, "_island").agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi")
    ).drop("_island")


def dated_runs(spans: DataFrame) -> DataFrame:
    """Disjoint runs (aoi_id, grid_id, row, strip, lo, hi, from_date) of covered columns.

    ``from_date`` is the earliest planting date among the fields covering the run, so
    one table serves every day: the union of the fields eligible on a day is the runs
    with ``from_date`` up to that day. A sweep over span ends: a row's strip is cut at the
    ends of its spans into at most as many pieces as the strip has columns, each piece takes
    its least date and equal neighbours are joined. Columns never become rows.
    """
    keys = ["aoi_id", "grid_id", "row", "strip"]
    dated = spans.where(F.col("planting_date").isNotNull())
    parts = dated.withColumn("strip", F.explode(F.sequence(F.floor(F.col("lo") / STRIP), F.floor(F.col("hi") / STRIP))))
    inside = parts.select(
        *keys,
        F.greatest("lo", F.col("strip") * STRIP).alias("lo"),
        F.least("hi", (F.col("strip") + 1) * STRIP - 1).alias("hi"),
        F.to_date("planting_date").alias("planted"),
    )
    # copies and spans with a common start are folded first: at most one per column and date is left
    folded = materialize(inside.groupBy(*keys, "lo", "planted").agg(F.max("hi").alias("hi")), "spans")
    ends = folded.select(*keys, F.explode(F.array(F.col("lo"), F.col("hi") + 1)).alias("at")).distinct()
    along = Window.partitionBy(*keys).orderBy("at")
    pieces = ends.withColumn("next", F.lead("at").over(along)).where("next is not null")
    covering = folded.withColumnsRenamed({"lo": "from", "hi": "to"})
    met = pieces.join(covering, keys).where("from <= at and next - 1 <= to")
    least = met.groupBy(*keys, "at", "next").agg(F.min("planted").alias("from_date"))
    goes_on = (F.lag("next").over(along) == F.col("at")) & (F.lag("from_date").over(along) == F.col("from_date"))
    marked = least.withColumn("_new", F.when(goes_on, 0).otherwise(1))
    run = F.sum("_new").over(along.rowsBetween(Window.unboundedPreceding, 0))
    return (
        marked.withColumn("_run", run)
        .groupBy(*keys, "from_date", "_run")
        .agg(F.min("at").alias("lo"), (F.max("next") - 1).alias("hi"))
        .select(*keys, "lo", "hi", "from_date")
    )


def grid_window(b: Column) -> Column:
    """struct(row_lo, row_hi, col_lo, col_hi): a grid-CRS box snapped outward, clipped."""
    x0, y0, xres, yres = (F.col(c) for c in ("x0", "y0", "xres", "yres"))
    return F.struct(
        F.greatest(F.floor((y0 - b["ymax"]) / yres), F.lit(0)).alias("row_lo"),
        F.least(F.ceil((y0 - b["ymin"]) / yres) - 1, F.col("height") - 1).alias("row_hi"),
        F.greatest(F.floor((b["xmin"] - x0) / xres), F.lit(0)).alias("col_lo"),
        F.least(F.ceil((b["xmax"] - x0) / xres) - 1, F.col("width") - 1).alias("col_hi"),
    )


def _corners(epsg: Column) -> Column:
    corners = F.expr("array(array(array(array(xmin, ymin), array(xmin, ymax), array(xmax, ymin), array(xmax, ymax))))")
    in_grid = geometry.map_vertices(corners, lambda x, y: projection.from_lonlat(x, y, epsg))
    return geometry.bounds(in_grid)


def window_versions(fields: DataFrame, aoi_grids: DataFrame, grids: DataFrame) -> DataFrame:
    """The raster window of each area over time, one row per planting date it has.

    (aoi_id, grid_id, from_date, until_date, row_lo, row_hi, col_lo, col_hi, tiny); a
    version holds from ``from_date`` up to, not including, ``until_date``. ``tiny`` marks
    windows of fewer than two rows or columns.
    """
    boxed = fields.where(
        F.col("aoi_id").isNotNull() & F.col("planting_date").isNotNull()
    ).select(
        "aoi_id", F.to_date("planting_date").alias("from_date"), geometry.bounds(F.col("geom")).alias("b")
    )
    daily = boxed.groupBy("aoi_id", "from_date").agg(
        F.min("b.xmin").alias("xmin"),
        F.min("b.ymin").alias("ymin"),
        F.max("b.xmax").alias("xmax"),
        F.max("b.ymax").alias("ymax"),
    )
    # at most one row per calendar day and area reaches these windows
    order = Window.partitionBy("aoi_id").orderBy("from_date")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    grown = daily.select(
        "aoi_id",
        "from_date",
        F.lead("from_date").over(order).alias("until_date"),
        F.min("xmin").over(so_far).alias("xmin"),
        F.min("ymin").over(so_far).alias("ymin"),
        F.max("xmax").over(so_far).alias("xmax"),
        F.max("ymax").over(so_far).alias("ymax"),
    )
    on_grid = grown.join(aoi_grids.select("aoi_id", "grid_id").distinct(), "aoi_id").join(
        grids.select("grid_id", *GRID), "grid_id"
    )
    windows = on_grid.withColumn("b", _corners(F.col("epsg"))).select(
        "aoi_id",
        "grid_id",
        "from_date",
        F.coalesce("until_date", F.lit(FOREVER).cast("date")).alias("until_date"),
        grid_window(F.col("b")).alias("w"),
    ).select("aoi_id", "grid_id", "from_date", "until_date", "w.*")
    tiny = (F.col("row_hi") - F.col("row_lo") < 1) | (F.col("col_hi") - F.col("col_lo") < 1)
    return windows.withColumn("tiny", tiny)


def area_mask(
    fields: DataFrame, aoi_grids: DataFrame, grids: DataFrame, whole_if_tiny: bool = True
) -> DataFrame:
    """Pixel runs of each area on its grids, valid from ``from_date`` to before ``until_date``.

    (aoi_id, grid_id, row, strip, lo, hi, from_date, until_date). With ``whole_if_tiny`` all pixels of an area's
    window count as long as it has fewer than two rows or columns, since a mask of so few pixels mostly misses
    their centres; later, and always without it, only covered pixels do.
    """
    runs = dated_runs(field_spans(fields_on_grids(fields, aoi_grids, grids)))
    if not whole_if_tiny:
        return runs.withColumn("until_date", F.lit(FOREVER).cast("date"))
    versions = materialize(window_versions(fields, aoi_grids, grids), "windows")
    # windows only grow, so the days with a tiny one come first
    masked_from = versions.where("not tiny").groupBy("aoi_id", "grid_id").agg(
        F.min("from_date").alias("masked_from")
    )
    masked = salted_lookup(runs, masked_from, ["aoi_id", "grid_id"]).select(
        "aoi_id",
        "grid_id",
        "row",
        "strip",
        "lo",
        "hi",
        F.greatest("from_date", "masked_from").alias("from_date"),
        F.lit(FOREVER).cast("date").alias("until_date"),
    )
    whole = (
        versions.where("tiny and row_lo <= row_hi and col_lo <= col_hi")
        .withColumn("row", F.explode(F.sequence("row_lo", "row_hi")))
        .withColumn(
            "strip",
            F.explode(F.sequence(F.floor(F.col("col_lo") / STRIP), F.floor(F.col("col_hi") / STRIP))),
        )
        .select(
            "aoi_id",
            "grid_id",
            "row",
            "strip",
            F.greatest("col_lo", F.col("strip") * STRIP).alias("lo"),
            F.least("col_hi", (F.col("strip") + 1) * STRIP - 1).alias("hi"),
            "from_date",
            "until_date",
        )
    )
    return masked.unionByName(whole)


def mask_on(mask: DataFrame, visits: DataFrame) -> DataFrame:
    """Runs to read for each visit (aoi_id, date, item_id, grid_id, ...) of an area.

    Further columns of ``visits`` ride along.
    """
    met = salted_lookup(mask, visits, ["aoi_id", "grid_id"])
    valid = (F.col("from_date") <= F.col("date")) & (F.col("date") < F.col("until_date"))
    return met.where(valid).drop("grid_id", "from_date", "until_date")


def masked_pixels(pixels: DataFrame, runs: DataFrame) -> DataFrame:
    """Pixels (item_id, row, col, ...) inside the runs, with the columns of the run.

    The join keys are item, row and column strip: even a scene that holds a third of
    all pixels is spread over its rows and strips.
    """
    keyed = pixels.withColumn("strip", F.floor(F.col("col") / STRIP))
    inside = F.col("col").between(F.col("lo"), F.col("hi"))
    return keyed.join(runs, ["item_id", "row", "strip"]).where(inside).drop("lo", "hi")
