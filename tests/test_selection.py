import datetime as dt

import pytest
from pyspark.sql import functions as F

from verdure.operators import incremental, selection
from verdure.sources.scenes import SCENE_SCHEMA, read_scene_items

D = dt.date


def fields(spark, *dates):
    rows = [(i, d) for i, d in enumerate(dates)]
    return spark.createDataFrame(rows, "ord long, planting_date date")


def areas(spark, **boxes):
    return spark.createDataFrame(list(boxes.items()), "aoi_id string, bbox array<double>")


def scene(item, when, cloud, box=(0.0, 0.0, 1.0, 1.0), epsg=None, assets=("B04", "B08")):
    blank = (None, None, None, None, None)
    return (item, "c", when and dt.datetime.fromisoformat(when), cloud, epsg, *box, dict.fromkeys(assets, blank))


def scenes(spark, *rows):
    return spark.createDataFrame(list(rows), SCENE_SCHEMA)


def test_day_range_limits(spark):
    def days(*dates):
        got = selection.day_range(fields(spark, *dates), D(2024, 3, 2)).collect()
        return [r["date"] for r in got]

    assert days(D(2024, 2, 28), None, D(2024, 3, 1)) == [
        D(2024, 2, 28), D(2024, 2, 29), D(2024, 3, 1), D(2024, 3, 2)
    ]
    assert days(D(2024, 3, 2)) == [D(2024, 3, 2)]
    assert days(D(2024, 3, 3)) == []
    assert days(None) == []
    assert days() == []


def test_area_days_without_areas_or_dates(spark):
    some, none = areas(spark, AOI_01=[0.0, 0.0, 1.0, 1.0]), areas(spark, x=[0.0]).limit(0)
    planted = fields(spark, D(2024, 3, 1))
    assert selection.aoi_days(some, planted, D(2024, 3, 2)).count() == 2
    assert selection.aoi_days(none, planted, D(2024, 3, 2)).count() == 0
    assert selection.aoi_days(some, fields(spark, None), D(2024, 3, 2)).count() == 0


def test_planting_date_is_required_and_may_carry_a_time(spark):
    with pytest.raises(ValueError, match="planting_date"):
        selection.day_range(spark.range(1), D(2024, 1, 1))
    text = spark.createDataFrame([("2024-01-01T00:00:00",), ("2024-01-02",)], "planting_date string")
    assert selection.day_range(text, D(2024, 1, 2)).count() == 2


def test_cloud_and_day_limits(spark):
    df = scenes(
        spark,
        scene("at limit", "2024-01-01T10:00:00", 30.0),
        scene("below", "2024-01-01T10:00:00", 29.99),
        scene("unknown", "2024-01-01T10:00:00", None),
        scene("last second", "2024-01-01T23:59:59", 1.0),
        scene("too late", "2024-01-01T23:59:59.500000", 1.0),
        scene("midnight", "2024-01-02T00:00:00", 1.0),
    )
    got = {r["item_id"]: r["date"] for r in selection.eligible_scenes(df).collect()}
    inside = {"below": D(2024, 1, 1), "last second": D(2024, 1, 1), "midnight": D(2024, 1, 2)}
    assert got == {**inside, "too late": D(2024, 1, 1)}
    sharp = selection.eligible_scenes(df, closed_second=True).collect()
    assert {r["item_id"]: r["date"] for r in sharp} == inside


def test_touching_boxes_meet_once_across_many_cells(spark):
    aois = areas(spark, wide=[-3.5, -2.5, 4.5, 3.5], corner=[1.0, 1.0, 2.0, 2.0], apart=[1.01, 0.0, 2.0, 0.5])
    df = scenes(spark, scene("s", "2024-01-01T10:00:00", 1.0), scene("far", "2024-01-01T10:00:00", 1.0, (50.0, 50.0, 51.0, 51.0)))
    got = sorted(r["aoi_id"] for r in selection.scene_candidates(aois, df).collect())
    assert got == ["corner", "wide"]


def test_best_scene_ties_and_missing_time(spark):
    aois = areas(spark, A=[0.0, 0.0, 1.0, 1.0])
    shifted = (0.5, 0.5, 1.5, 1.5)
    df = scenes(
        spark,
        scene("b", "2024-01-01T11:00:00", 5.0),
        scene("a", "2024-01-01T11:00:00", 5.0, shifted),
        scene("late", "2024-01-01T12:00:00", 5.0),
        scene("early", "2024-01-02T09:00:00", 5.0, shifted),
        scene("x", "2024-01-02T10:00:00", 5.0),
    )
    got = {r["date"]: r["item_id"] for r in selection.best_scenes(aois, df).collect()}
    assert got == {D(2024, 1, 1): "a", D(2024, 1, 2): "early"}


def test_refs_fail_only_when_a_chosen_scene_lacks_a_band(spark):
    aois = areas(spark, A=[0.0, 0.0, 1.0, 1.0])
    pairs = selection.aoi_days(aois, fields(spark, D(2024, 1, 1)), D(2024, 1, 2))
    good = scene("good", "2024-01-01T10:00:00", 1.0)
    bad = scene("bad", "2024-01-01T10:00:00", 2.0, assets=("B02",))
    refs = selection.scene_refs(pairs, scenes(spark, good, bad)).orderBy("date").collect()
    assert [(r["status"], r["item_id"], r["b04_asset"]) for r in refs] == [
        ("ok", "good", "B04"), ("no_items", None, None)
    ]
    with pytest.raises(Exception, match="missing asset"):
        selection.scene_refs(pairs, scenes(spark, bad)).collect()


def test_all_candidates_are_ranked(spark):
    aois = areas(spark, A=[0.0, 0.0, 1.0, 1.0])
    df = scenes(spark, *(scene(f"s{i:02d}", "2024-01-01T10:00:00", 29.0 - i / 4) for i in range(80)))
    best = selection.top_scenes(aois, df, 2).orderBy("rank").collect()
    assert [r["item_id"] for r in best] == ["s79", "s78"]


def test_ranking_meets_areas_with_the_best_of_each_footprint_only(spark):
    aois = areas(spark, A=[0.0, 0.0, 1.0, 1.0], B=[0.9, 0.9, 3.0, 3.0])
    boxes = ((0.0, 0.0, 1.0, 1.0), (0.5, 0.5, 1.5, 1.5), (2.0, 2.0, 3.0, 3.0))
    # few clouds, so that ties are common; every third scene comes twice
    rows = [scene(f"s{i:02d}", f"2024-01-{1 + i % 2:02d}T10:00:00", float(i * 7 % 5), boxes[i % 3]) for i in range(60)]
    df = scenes(spark, *rows, *rows[::3])
    ranked = selection.top_scenes(aois, df, 3)
    want = []
    every = selection.scene_candidates(aois, df).select("aoi_id", "date", "cloud_cover", "dt", "item_id").collect()
    for key in {(r["aoi_id"], r["date"]) for r in every}:
        group = sorted(r[2:] for r in every if r[:2] == key)[:3]
        want += [(*key, n, r[2]) for n, r in enumerate(group, 1)]
    assert sorted(map(tuple, ranked.select("aoi_id", "date", "rank", "item_id").collect())) == sorted(want)
    lines = ranked._jdf.queryExecution().analyzed().toString().split("\n")
    below = lines[next(i for i, line in enumerate(lines) if "Join Inner" in line) :]
    assert any("row_number()" in line for line in below)


def test_choice_per_pair_reads_only_its_days(spark, tmp_path):
    """A pending old day and a new one: scenes of the days between are not chosen from."""
    aois = areas(spark, A=[0.0, 0.0, 1.0, 1.0], B=[0.5, 0.5, 2.0, 2.0])
    df = scenes(spark, *(scene(f"s{d}-{k}", f"2024-01-{d:02d}T10:00:00", float(k)) for d in range(1, 21) for k in (2, 1)))
    pairs = selection.aoi_days(aois, fields(spark, D(2024, 1, 1)), D(2024, 1, 20))
    pending = pairs.where("date = '2024-01-20' or (aoi_id = 'A' and date = '2024-01-02')")
    near = selection.scenes_of_days(df, pending)
    assert {r["item_id"].split("-")[0] for r in near.collect()} == {"s2", "s20"}
    refs = selection.scene_refs(pending, near).collect()
    assert {(r["aoi_id"], r["date"].day, r["item_id"]) for r in refs} == {("A", 2, "s2-1"), ("A", 20, "s20-1"), ("B", 20, "s20-1")}
    plan = selection.best_scenes(pending, near)._jdf.queryExecution().toString()
    assert any("date" in line and "cell" in line for line in plan.split("\n") if "Join Inner" in line)


def test_incremental_keys(spark):
    pairs = spark.createDataFrame(
        [(a, [0.0, float(n)], D(2024, 1, d)) for n, a in enumerate("AB") for d in (1, 2)],
        "aoi_id string, bbox array<double>, date date",
    )
    there = pairs.where("date = '2024-01-01' or aoi_id = 'A'")
    assert [r["date"] for r in incremental.missing_days(pairs, there).collect()] == [D(2024, 1, 2)]
    assert incremental.missing_days(pairs, pairs).count() == 0
    moved = there.withColumn("bbox", F.array(F.lit(9.0), F.lit(9.0)))
    assert incremental.missing_pairs(pairs, moved).count() == 1
    assert incremental.missing_pairs(pairs, moved, match_bbox=True).count() == 4
    results, refs = pairs.where("aoi_id = 'A'"), pairs.where("date = '2024-01-02'")
    assert [tuple(r) for r in incremental.pending_ndvi(pairs.drop("bbox"), results, refs).collect()] == [
        ("B", D(2024, 1, 2))
    ]


def test_catalog_items(spark, tmp_path):
    path = tmp_path / "items.jsonl"
    path.write_text(
        '{"id":"i1","collection":"c","bbox":[1,2,3,4],"properties":{"datetime":"2024-05-01T10:20:30.123456Z",'
        '"eo:cloud_cover":3.5,"proj:epsg":32632},"assets":{"B04":{"href":"x","proj:epsg":1,'
        '"raster:bands":[{"scale":0.1,"offset":-1,"nodata":0}]},"visual":{"href":"y"}}}\n'
        '{"id":"i2","collection":"c","bbox":[1,2,3,4],"properties":{"datetime":"2024-05-01T10:20:30Z"},"assets":{}}\n'
    )
    first, second = read_scene_items(spark, str(path)).orderBy("item_id").collect()
    assert first["dt"] == dt.datetime(2024, 5, 1, 10, 20, 30, 123456)
    assert first["assets"]["B04"].asDict() == {
        "href": "x", "proj_epsg": 1, "scale": 0.1, "offset": -1.0, "nodata": 0.0
    }
    assert first["assets"]["visual"]["scale"] is None
    assert second["cloud_cover"] is None and second["proj_epsg"] is None
