"""Bands of different resolution on one grid, by affine maps of cell indices.

Source and target are north-up grids in one coordinate system. Along either axis a target cell ``c`` covers the source
cells from ``ratio * c + shift`` to ``ratio * (c + 1) + shift``, so strips are cut and stretched as arrays and columns
never become rows. Shares of a cell below ``TOUCH`` are rounding.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdure.operators.mask import STRIP

TOUCH = 1e-9
KEYS = ["item_id", "band"]


def _axis(name: str) -> tuple[Column, Column, Column]:
    """Ratio, shift and number of target cells of ``x`` or ``y`` over the structs ``source`` and ``target``."""
    source, target = F.col("source"), F.col("target")
    if name == "x":
        return target["xres"] / source["xres"], (target["x0"] - source["x0"]) / source["xres"], target["width"]
    return target["yres"] / source["yres"], (source["y0"] - target["y0"]) / source["yres"], target["height"]


def _range(first: Column, last: Column) -> Column:
    """Whole numbers from ``first`` to ``last``; none where these are the wrong way round."""
    first, last = first.cast("long"), last.cast("long")
    return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))


def _target_range(lo: Column, hi: Column, axis: tuple[Column, Column, Column]) -> Column:
    """Target cells that may have to do with the source cells ``lo`` to ``hi``, a few too many."""
    ratio, shift, count = axis
    first, last = F.floor((lo - shift) / ratio) - 1, F.floor((hi + 1 - shift) / ratio) + 1
    return _range(F.greatest(first, F.lit(0)), F.least(last, count - 1))


def _holder(c: Column, axis: tuple[Column, Column, Column]) -> Column:
    """The source cell in which the centre of target cell ``c`` lies; on an edge the later one."""
    return F.floor(F.round(axis[0] * (c + 0.5) + axis[1], 9))


def _share(c: Column, lo: Column, hi: Column, axis: tuple[Column, Column, Column]) -> Column:
    """Length of target cell ``c`` within the source cells ``lo`` to ``hi``, in source cells."""
    length = F.least(axis[0] * (c + 1) + axis[1], hi + 1.0) - F.greatest(axis[0] * c + axis[1], lo + 0.0)
    return F.when(length > TOUCH, length).otherwise(0.0)


def _met(strips: DataFrame, placed: DataFrame) -> DataFrame:
    filled = strips.where(F.size("values") > 0)
    return filled.join(placed.select(*KEYS, "source", "target"), KEYS).withColumn("end", F.col("col0") + F.size("values") - 1)


def nearest(strips: DataFrame, placed: DataFrame) -> DataFrame:
    """``strips`` on their target grids; every cell has the value of the source cell under its centre.

    ``placed`` has one row per raster band: item_id, band and structs ``source`` and ``target`` (x0, y0, xres, yres,
    width, height). Bands that it does not name are left out. A strip becomes strips without a shuffle of its cells;
    layers stay, and cells outside the source have no strip.
    """
    x, y = _axis("x"), _axis("y")

    def under(lo: Column, hi: Column, axis: tuple[Column, Column, Column]) -> Column:
        return F.filter(_target_range(lo, hi, axis), lambda c: _holder(c, axis).between(lo, hi))

    rows = _met(strips, placed).withColumn("to", F.explode(under(F.col("row"), F.col("row"), y)))
    cut = rows.withColumn("cols", under(F.col("col0"), F.col("end"), x)).where(F.size("cols") > 0)
    # a step of its own: within one select the names row and col0 would mean the new ones inside the function
    moved = cut.withColumn("moved", F.transform("cols", lambda c: F.get("values", (_holder(c, x) - F.col("col0")).cast("int"))))
    return moved.select(*KEYS, F.col("to").alias("row"), F.get("cols", F.lit(0)).alias("col0"), "layer", F.col("moved").alias("values"))


def area_mean(strips: DataFrame, placed: DataFrame, nodata: float | None = None) -> DataFrame:
    """``strips`` on their target grids; every cell has the mean of what it covers, weighted by area.

    Null, NaN and ``nodata`` cells do not count; a cell that covers no other is null. ``placed`` is that of ``nearest``.
    Each strip is summed along its row first; only these sums, in blocks of columns, are shuffled to meet the
    other rows under their target row. Layers are averaged each by itself.
    """
    x, y = _axis("x"), _axis("y")
    lo, hi = F.col("col0"), F.col("end")

    def valid(v: Column) -> Column:
        known = v.isNotNull() & ~F.isnan(v)
        return known if nodata is None else known & (v != nodata)

    def pair(total: Column, weight: Column) -> Column:
        return F.struct(total.alias("total"), weight.alias("weight"))

    def along(c: Column) -> Column:
        inside = _range(F.greatest(lo, F.floor(x[0] * c + x[1])), F.least(hi, F.ceil(x[0] * (c + 1) + x[1]) - 1))

        def add(acc: Column, i: Column) -> Column:
            value, share = F.get("values", (i - lo).cast("int")), _share(c, i, i, x)
            return F.when(valid(value), pair(acc["total"] + share * value, acc["weight"] + share)).otherwise(acc)

        return F.aggregate(inside, pair(F.lit(0.0), F.lit(0.0)), add)

    summed = (
        _met(strips, placed)
        .withColumn("cols", F.filter(_target_range(lo, hi, x), lambda c: _share(c, lo, hi, x) > 0))
        .where(F.size("cols") > 0)
        .withColumn("sums", F.transform("cols", along))
        .withColumn("first", F.get("cols", F.lit(0)))
    )
    row = F.col("row")
    to_rows = F.transform(_target_range(row, row, y), lambda r: F.struct(r.alias("row"), _share(r, row, row, y).alias("share")))
    crossed = summed.withColumn("to", F.explode(F.filter(to_rows, lambda r: r["share"] > 0)))
    last = F.col("first") + F.size("cols") - 1
    crossed = crossed.withColumn("block", F.explode(F.sequence(F.floor(F.col("first") / STRIP), F.floor(last / STRIP))))
    start = F.col("block") * STRIP
    wide = F.least(start + STRIP, x[2].cast("long")) - 1

    def weighed(c: Column) -> Column:
        got = F.get("sums", (c - F.col("first")).cast("int"))
        here = c.between(F.col("first"), last)
        return pair(*(F.when(here, got[n] * F.col("to")["share"]).otherwise(0.0) for n in ("total", "weight")))

    pieces = crossed.select(
        *KEYS, F.col("to.row").alias("row"), start.alias("col0"), "layer", F.transform(_range(start, wide), weighed).alias("piece")
    )

    def both(a: Column, b: Column) -> Column:
        return pair(a["total"] + b["total"], a["weight"] + b["weight"])

    grouped = pieces.groupBy(*KEYS, "row", "col0", "layer").agg(F.collect_list("piece").alias("pieces"))
    folded = F.aggregate(F.slice("pieces", 2, F.size("pieces")), F.get("pieces", F.lit(0)), lambda acc, p: F.zip_with(acc, p, both))
    values = F.transform(folded, lambda s: F.when(s["weight"] > 0, s["total"] / s["weight"]))
    return grouped.select(*KEYS, "row", "col0", "layer", values.alias("values"))
