import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from verdure.functions import geometry, projection
from verdure.operators import mask, ndvi
from verdure.sources import raster as raster_files

D = dt.date
FIELD = f"ord long, aoi_id string, planting_date date, geom {geometry.GEOM_TYPE}"
GRID = "grid_id string, epsg int, x0 double, y0 double, xres double, yres double, width int, height int"


def grid(spark, **over):
    base = dict(grid_id="G", epsg=4326, x0=0.0, y0=10.0, xres=0.25, yres=0.25, width=40, height=40)
    return spark.createDataFrame([tuple({**base, **over}.values())], GRID)


def areas_on(spark, *names):
    return spark.createDataFrame([(n, "G") for n in names], "aoi_id string, grid_id string")


def ring(*points):
    return [[float(x), float(y)] for x, y in (*points, points[0])]


def inside(rings, x, y):
    """Even-odd test with half-open edges."""
    hits = 0
    for r in rings:
        for (x1, y1), (x2, y2) in zip(r, r[1:]):
            if min(y1, y2) <= y < max(y1, y2) and x1 + (y - y1) * (x2 - x1) / (y2 - y1) <= x:
                hits += 1
    return hits % 2 == 1


def brute_cells(geoms, g):
    cells = set()
    for geom in geoms:
        rings = [r for poly in geom for r in poly]
        for row in range(g["height"]):
            for col in range(g["width"]):
                x, y = g["x0"] + (col + 0.5) * g["xres"], g["y0"] - (row + 0.5) * g["yres"]
                if inside(rings, x, y):
                    cells.add((row, col))
    return cells


def cells_of(runs):
    rows = runs.select("row", F.explode(F.sequence("lo", "hi")).alias("col")).collect()
    assert len(rows) == len(set(rows)), "a cell is covered twice"
    return {(r["row"], r["col"]) for r in rows}


def random_geoms(n, seed):
    gen = np.random.default_rng(seed)
    geoms = []
    for _ in range(n):
        cx, cy = gen.uniform(-0.5, 10.5, 2)
        angles = np.sort(gen.uniform(0, 2 * np.pi, 9))
        radius = gen.uniform(0.3, 2.0, 9)
        shell = ring(*zip(cx + radius * np.cos(angles), cy + radius * np.sin(angles)))
        hole = ring((cx - 0.2, cy - 0.2), (cx + 0.2, cy - 0.2), (cx, cy + 0.2))
        geoms.append([[shell, hole]])
    geoms.append([[ring((1, 1), (2, 1), (2, 2), (1, 2))], [ring((5, 5), (6, 5), (6, 6), (5, 6))]])
    return geoms


def test_union_of_fields_equals_even_odd_per_field(spark):
    geoms = random_geoms(25, 1)
    rows = [(i, "A", D(2024, 1, 1 + i % 5), g) for i, g in enumerate(geoms)]
    fields, grids = spark.createDataFrame(rows, FIELD), grid(spark)
    shape = grids.first().asDict()
    placed = mask.fields_on_grids(fields, areas_on(spark, "A"), grids)
    spans = mask.field_spans(placed)
    assert cells_of(mask.merge_spans(spans, ["aoi_id", "grid_id", "row"])) == brute_cells(geoms, shape)
    runs = mask.area_mask(fields, areas_on(spark, "A"), grids)
    for day in (1, 3, 5):
        on = F.lit(D(2024, 1, day)).between(F.col("from_date"), F.date_sub("until_date", 1))
        want = brute_cells([g for i, g in enumerate(geoms) if 1 + i % 5 <= day], shape)
        assert cells_of(runs.where(on)) == want


def test_copied_fields_count_each_pixel_once(spark):
    square = [[ring((1, 1), (3, 1), (3, 3), (1, 3))]]
    fields = spark.createDataFrame([(i, "A", D(2024, 1, 1), square) for i in range(60)], FIELD)
    runs = mask.area_mask(fields, areas_on(spark, "A"), grid(spark))
    assert len(cells_of(runs)) == 64


def test_columns_never_become_rows(spark):
    wide = [[ring((0, 0), (10, 0), (10, 10), (0, 10))]]
    fields = spark.createDataFrame([(i, "A", D(2024, 1, 1 + i), wide) for i in range(3)], FIELD)
    spans = mask.field_spans(mask.fields_on_grids(fields, areas_on(spark, "A"), grid(spark)))
    runs = mask.dated_runs(spans)
    assert runs.count() == 40 and {r["from_date"] for r in runs.collect()} == {D(2024, 1, 1)}
    assert "sequence(lo" not in runs._jdf.queryExecution().toString()


def test_runs_are_cut_at_strips(spark):
    wide = [[ring((0, 9), (300, 9), (300, 10), (0, 10))]]
    fields = spark.createDataFrame([(0, "A", D(2024, 1, 1), wide)], FIELD)
    runs = mask.area_mask(fields, areas_on(spark, "A"), grid(spark, width=1100)).collect()
    assert len(runs) == 4 * 3
    assert all(r["lo"] // mask.STRIP == r["hi"] // mask.STRIP == r["strip"] for r in runs)


def test_tiny_window_keeps_every_pixel_until_it_grows(spark):
    sliver = [[ring((1.01, 5.01), (1.02, 5.01), (1.02, 5.9), (1.01, 5.9))]]
    block = [[ring((1, 5), (3, 5), (3, 7), (1, 7))]]
    rows = [(0, "A", D(2024, 1, 1), sliver), (1, "A", D(2024, 1, 10), block), (2, "A", None, block)]
    fields = spark.createDataFrame(rows, FIELD)
    runs = mask.area_mask(fields, areas_on(spark, "A"), grid(spark))
    early = runs.where("from_date <= '2024-01-05' and until_date > '2024-01-05'")
    assert cells_of(early) == {(r, 4) for r in range(16, 20)}
    strict = mask.area_mask(fields, areas_on(spark, "A"), grid(spark), whole_if_tiny=False)
    assert cells_of(strict.where("from_date <= '2024-01-05'")) == brute_cells([sliver], grid(spark).first().asDict())
    late = runs.where("from_date <= '2024-01-10' and until_date > '2024-01-10'")
    assert cells_of(late) == brute_cells([sliver, block], grid(spark).first().asDict())


def test_field_outside_the_grid_gives_nothing(spark):
    away = [[ring((100, 50), (101, 50), (101, 51), (100, 51))]]
    fields = spark.createDataFrame([(0, "A", D(2024, 1, 1), away)], FIELD)
    assert mask.area_mask(fields, areas_on(spark, "A"), grid(spark)).count() == 0


def test_mask_on_a_metre_grid(spark):
    """Fields in degrees are taken into the scene's own system first."""
    corners = [(7.001, 50.001), (7.009, 50.002), (7.008, 50.008), (7.002, 50.007)]
    fields = spark.createDataFrame([(0, "A", D(2024, 1, 1), [[ring(*corners)]])], FIELD)
    metres = spark.createDataFrame(corners, "lon double, lat double").select(
        projection.utm_forward(F.col("lon"), F.col("lat"), F.lit(32632)).alias("p")
    )
    shape = ring(*(tuple(r["p"]) for r in metres.collect()))
    x0 = 20.0 * np.floor(min(p[0] for p in shape) / 20) - 40
    y0 = 20.0 * np.ceil(max(p[1] for p in shape) / 20) + 60
    grids = grid(spark, epsg=32632, x0=float(x0), y0=float(y0), xres=20.0, yres=20.0, width=60, height=60)
    runs = mask.area_mask(fields, areas_on(spark, "A"), grids)
    want = brute_cells([[[shape]]], grids.first().asDict())
    assert len(want) > 500 and cells_of(runs) == want


def visits(spark, *days):
    spec = "struct<band: string, scale: double, offset: double, nodata: double>"
    rows = [("A", d, "i", "G", ("r", 1.0, 0.0, -9.0), ("n", 1.0, 0.0, -9.0)) for d in days]
    return spark.createDataFrame(
        rows, f"aoi_id string, date date, item_id string, grid_id string, red {spec}, nir {spec}"
    )


def test_area_mean_skips_bad_pixels(spark):
    block = [[ring((0, 9), (1, 9), (1, 10), (0, 10))]]
    fields = spark.createDataFrame([(0, "A", D(2024, 1, 1), block)], FIELD)
    runs = mask.area_mask(fields, areas_on(spark, "A"), grid(spark))
    nan = float("nan")
    values = [(0, 0, 1.0, 3.0), (0, 1, 0.0, 0.0), (1, 1, -9.0, 5.0), (2, 2, nan, 1.0), (3, 3, 1.0, 1.0), (9, 9, 0.0, 1.0)]
    rows = [("i", b, r, c, v) for r, c, red, nir in values for b, v in (("r", red), ("n", nir), ("other", 7.0))]
    pixels = spark.createDataFrame(rows, "item_id string, band string, row long, col long, raw double")
    got = ndvi.area_means(pixels, runs, visits(spark, D(2024, 1, 1), D(2024, 1, 2))).collect()
    assert sorted((r["date"], r["mean_ndvi"]) for r in got) == [(D(2024, 1, 1), 0.25), (D(2024, 1, 2), 0.25)]
    empty = pixels.where("row = 1")
    assert [r["mean_ndvi"] for r in ndvi.area_means(empty, runs, visits(spark, D(2024, 1, 1))).collect()] == [None]


def test_strips_and_long_pixels_give_the_same_mean(spark):
    gen = np.random.default_rng(11)
    fields = spark.createDataFrame(
        [(i, "A", D(2024, 1, 1 + i % 2), g) for i, g in enumerate(random_geoms(6, 4))], FIELD
    )
    runs = mask.area_mask(fields, areas_on(spark, "A"), grid(spark))
    rows = [
        ("i", b, r, c, float(v))
        for b in ("r", "n", "unused")
        for r in range(40)
        for c, v in enumerate(gen.integers(-1, 9, 40))
        if v >= 0 and (r + c) % 7
    ]
    pixels = spark.createDataFrame(rows, "item_id string, band string, row long, col long, raw double")
    days = visits(spark, D(2024, 1, 1), D(2024, 1, 2))
    wanted = ndvi.visited_bands(pixels, days)
    assert {r["band"] for r in wanted.select("band").distinct().collect()} == {"r", "n"}
    long = dict(ndvi.area_means(wanted, runs, days).select("date", "mean_ndvi").collect())
    for width, shift in ((8, 0), (40, 0), (mask.STRIP, 0), (13, 5), (1024, -3)):
        strips = raster_files.to_strips(pixels, width, shift=shift)
        got = dict(ndvi.area_means_of_strips(strips, runs, days).select("date", "mean_ndvi").collect())
        assert got.keys() == long.keys() and all(abs(got[d] - long[d]) < 1e-12 for d in got)
    # bands cut in different ways
    apart = raster_files.to_strips(pixels.where("band = 'r'"), 13).unionByName(raster_files.to_strips(pixels.where("band = 'n'"), 9, shift=2))
    got = dict(ndvi.area_means_of_strips(apart, runs, days).select("date", "mean_ndvi").collect())
    assert all(abs(got[d] - long[d]) < 1e-12 for d in long)


@pytest.mark.parametrize("width, shift", [(300, 0), (512, 0), (1024, 0), (2048, 0), (700, 100)])
def test_strips_across_the_borders_of_join_strips(spark, width, shift):
    block = [[ring((0, 9), (300, 9), (300, 10), (0, 10))]]
    fields = spark.createDataFrame([(0, "A", D(2024, 1, 1), block)], FIELD)
    runs = mask.area_mask(fields, areas_on(spark, "A"), grid(spark, width=1200))
    cells = spark.range(1200).selectExpr("'i' as item_id", "id as col", "explode(array(0L, 1L)) as row")
    pixels = cells.selectExpr("item_id", "row", "col", "stack(2, 'r', 1d, 'n', if(col < 600, 3d, 1d)) as (band, raw)")
    strips = raster_files.to_strips(pixels, width, shift=shift)
    got = ndvi.area_means_of_strips(strips, runs, visits(spark, D(2024, 1, 1))).first()
    assert abs(got["mean_ndvi"] - 0.25) < 1e-12


def test_every_observation_counts_and_doubles_fail(spark):
    block = [[ring((0, 9), (1, 9), (1, 10), (0, 10))]]
    fields = spark.createDataFrame([(0, "A", D(2024, 1, 1), block)], FIELD)
    runs = mask.area_mask(fields, areas_on(spark, "A"), grid(spark))
    values = [(0, 0, 1, 1.0, 3.0), (0, 0, 2, 1.0, 1.0), (0, 0, 3, 3.0, 1.0), (1, 1, 1, 1.0, 3.0)]
    rows = [("i", b, r, c, o, v) for r, c, o, red, nir in values for b, v in (("r", red), ("n", nir))]
    pixels = spark.createDataFrame(rows, "item_id string, band string, row long, col long, obs int, raw double")
    strips = raster_files.to_strips(pixels, observation=["obs"])
    got = ndvi.area_means_of_strips(strips, runs, visits(spark, D(2024, 1, 1))).first()
    assert abs(got["mean_ndvi"] - (0.5 + 0 - 0.5 + 0.5) / 4) < 1e-12
    with pytest.raises(Exception, match="(?i)duplicate"):
        raster_files.to_strips(pixels).collect()
    doubled = strips.unionByName(strips)
    with pytest.raises(Exception, match="(?i)duplicate"):
        ndvi.area_means_of_strips(doubled, runs, visits(spark, D(2024, 1, 1))).collect()


def test_a_run_opens_only_the_folders_it_visits(spark, tmp_path):
    pixels = spark.range(40).selectExpr("concat('i', id % 20) as item_id", "0L as row", "id as col", "stack(3, 'r', 1d, 'n', 2d, 'x', 3d) as (band, raw)")
    raster_files.write_strips(raster_files.to_strips(pixels), str(tmp_path / "s"))
    strips = raster_files.read_strips(spark, str(tmp_path / "s"))
    day = visits(spark, D(2024, 1, 1)).withColumn("item_id", F.lit("i3"))
    wanted = ndvi.visited_bands(strips, day)
    assert {(r["item_id"], r["band"]) for r in wanted.collect()} == {("i3", "r"), ("i3", "n")}
    wanted.write.format("noop").mode("overwrite").save()
    assert "dynamicpruning" in wanted._jdf.queryExecution().toString().lower()


def test_strips_hold_and_slice_pixels(spark, tmp_path):
    gen = np.random.default_rng(5)
    cells = {(int(r), int(c)): float(v) for r, c, v in zip(gen.integers(0, 9, 80), gen.integers(0, 70, 80), gen.random(80))}
    rows = [("i", b, r, c, v) for (r, c), v in cells.items() for b in ("r", "n")]
    pixels = spark.createDataFrame(rows, "item_id string, band string, row long, col long, raw double")
    raster_files.write_strips(raster_files.to_strips(pixels, 16), str(tmp_path / "s"))
    strips = raster_files.read_strips(spark, str(tmp_path / "s"))
    found = raster_files.scan_pixels(strips, ["n"], rows=(2, 6), cols=(10, 40)).where("raw is not null")
    want = {(r, c, v) for (r, c), v in cells.items() if 2 <= r <= 6 and 10 <= c <= 40}
    assert {(r["row"], r["col"], r["raw"]) for r in found.collect()} == want
    assert {r["band"] for r in found.collect()} == {"n"}
    plan = found._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "band" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_packing_looks_no_column_up_in_a_map(spark):
    rows = [("i", "r", r, c, v) for r, cols in ((0, (-9, 0, 3)), (1, (15, 16)), (2, (40,))) for c, v in zip(cols, (1.0, None, 2.0))]
    pixels = spark.createDataFrame(rows, "item_id string, band string, row long, col long, raw double")
    for width, shift in ((1, 0), (16, 0), (7, 3), (64, -5)):
        strips = raster_files.to_strips(pixels, width, shift=shift)
        want = {}
        for _, _, r, c, v in rows:
            first = (c - shift) // width * width + shift
            want.setdefault((r, first), [None] * width)[c - first] = v
        assert {(s["row"], s["col0"]): s["values"] for s in strips.collect()} == want
    nowhere = spark.createDataFrame([("i", "r", 0, None, 1.0), ("i", "r", 0, 2, 3.0)], pixels.schema)
    assert {(s["col0"], str(s["values"])) for s in raster_files.to_strips(nowhere, 4).collect()} == {(None, "None"), (0, "[None, None, 3.0, None]")}
    # a lookup in a map goes through all its keys: a strip of n cells took n * width steps
    assert "element_at(by_col" not in strips._jdf.queryExecution().analyzed().toString()
