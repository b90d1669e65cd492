"""Strips moved to other grids, against loops over cells."""

import math
import random

import pytest
from pyspark.sql import functions as F

from verdure.operators import resample
from verdure.sources import raster as raster_files

GRID = "struct<x0:double,y0:double,xres:double,yres:double,width:int,height:int>"
SOURCE = (10.0, 50.0, 0.5, 0.25, 23, 17)
TARGETS = {
    "twice as fine": (10.0, 50.0, 0.25, 0.125, 46, 34),
    "half": (10.0, 50.0, 1.0, 0.5, 12, 9),
    "uneven and shifted": (9.8, 50.1, 0.7, 0.3, 19, 16),
    "same": SOURCE,
    "elsewhere": (100.0, 50.0, 1.0, 1.0, 5, 5),
}
NODATA = -9999.0


def cells(seed):
    rng = random.Random(seed)
    every = [(r, c) for r in range(SOURCE[5]) for c in range(SOURCE[4])]
    return {p: rng.choice([NODATA, math.nan, *[float(rng.randint(0, 99)) for _ in range(6)]]) for p in rng.sample(every, 300)}


def placed(spark, target):
    return spark.createDataFrame([("i", "b", SOURCE, target)], f"item_id string, band string, source {GRID}, target {GRID}")


def strips_of(spark, values, width, shift):
    rows = [(i, b, r, c, v) for (r, c), v in values.items() for i, b in (("i", "b"), ("i", "other"))]
    pixels = spark.createDataFrame(rows, "item_id string, band string, row long, col long, raw double")
    return raster_files.to_strips(pixels, width, shift=shift)


def held(strips):
    """Values by cell; a cell that several strips hold may have one value only."""
    flat = strips.select("row", "col0", F.posexplode("values").alias("i", "v")).collect()
    out = {}
    for r in flat:
        if r["v"] is not None:
            assert (r["row"], r["col0"] + r["i"]) not in out
            out[r["row"], r["col0"] + r["i"]] = r["v"]
    return out


def overlap(a, b, c, d):
    return max(0.0, min(b, d) - max(a, c))


def same(a, b):
    return a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-9 or math.isnan(a[k]) and math.isnan(b[k]) for k in a)


@pytest.mark.parametrize("name", TARGETS)
@pytest.mark.parametrize("width, shift", [(7, 0), (64, 3)])
def test_resampling_equals_loops_over_cells(spark, name, width, shift):
    x0, y0, xres, yres, n, m = TARGETS[name]
    sx, sy, sxr, syr, _, _ = SOURCE
    values = cells(len(name) + width)
    strips = strips_of(spark, values, width, shift)
    near, mean = {}, {}
    for r in range(m):
        for c in range(n):
            at = (math.floor(round((sy - (y0 - (r + 0.5) * yres)) / syr, 9)), math.floor(round((x0 + (c + 0.5) * xres - sx) / sxr, 9)))
            if at in values:
                near[r, c] = values[at]
            total = weight = 0.0
            for (i, j), v in values.items():
                if v == NODATA or math.isnan(v):
                    continue
                w = overlap(x0 + c * xres, x0 + (c + 1) * xres, sx + j * sxr, sx + (j + 1) * sxr)
                w *= overlap(r * yres - y0, (r + 1) * yres - y0, i * syr - sy, (i + 1) * syr - sy)
                if w > 1e-9:
                    total, weight = total + w * v, weight + w
            if weight:
                mean[r, c] = total / weight
    assert same(held(resample.nearest(strips, placed(spark, TARGETS[name]))), near)
    assert same(held(resample.area_mean(strips, placed(spark, TARGETS[name]), NODATA)), mean)


def test_layers_stay_and_nothing_gives_nothing(spark):
    rows = [("i", "b", 0, 0, 1, [2.0, 4.0]), ("i", "b", 0, 0, 0, [1.0, None]), ("i", "b", 1, 0, 0, [])]
    strips = spark.createDataFrame(rows, raster_files.STRIP_SCHEMA)
    target = (10.0, 50.0, 1.0, 0.25, 5, 5)
    got = {r["layer"]: r["values"][0] for r in resample.area_mean(strips, placed(spark, target)).collect()}
    assert got == {0: 1.0, 1: 3.0}
    for move in (resample.nearest, resample.area_mean):
        assert move(strips.limit(0), placed(spark, target)).count() == 0
        assert move(strips, placed(spark, target).limit(0)).count() == 0


def test_wide_rows_cross_blocks(spark):
    wide = (0.0, 0.0, 1.0, 1.0, 3000, 1)
    strips = spark.range(1).selectExpr("'i' item_id", "'b' band", "0L row", "0L col0", "0 layer", "transform(sequence(0, 2999), x -> double(x)) values")
    there = spark.createDataFrame([("i", "b", wide, (0.0, 0.0, 2.0, 1.0, 1500, 1))], f"item_id string, band string, source {GRID}, target {GRID}")
    assert held(resample.area_mean(strips, there)) == {(0, c): 2 * c + 0.5 for c in range(1500)}
    plan = resample.nearest(strips, there)._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert "hashpartitioning(row" not in plan
