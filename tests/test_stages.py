import datetime as dt
import json
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from verdure.functions import geometry, projection
from verdure.operators import ndvi, selection
from verdure.plans import daily
from verdure.sources import fields as field_files
from verdure.sources import keyed
from verdure.sources.scenes import SCENE_SCHEMA
from verdure.streaming import daily as stream
from tests.layouts import BASE, FIELDS
from tests.test_clustering import brute_dbscan, distances

D = dt.date
@pytest.fixture(scope="module")
def layout(spark, sample_fields, tmp_path_factory):
    """The sample field file run through the first stage."""
    made = daily.Layout(str(tmp_path_factory.mktemp("lake")))
    daily.run_areas(spark, sample_fields, made)
    return made


def scenes(spark):
    """One scene per day over the first area; days 3 and 5 are cloudy, day 4 has no CRS."""
    asset = (None, None, 0.1, 0.0, -1.0)
    rows = [
        (f"s{d}", "c", dt.datetime(2026, 1, d, 10), 90.0 if d in (3, 5) else float(d), None if d == 4 else 32632,
         BASE[0] - 0.5, BASE[1] - 0.5, BASE[0] + 0.5, BASE[1] + 0.5, {"B04": asset, "B08": asset})
        for d in range(1, 7)
    ]
    return spark.createDataFrame(rows, SCENE_SCHEMA)


def raster_tables(spark):
    ids = scenes(spark).select("item_id")
    rasters = ids.select("item_id", F.col("item_id").alias("raster_id"), F.lit("G").alias("grid_id"))
    grids = spark.createDataFrame(
        [("G", 4326, BASE[0] - 0.5, BASE[1] + 0.5, 0.01, 0.01, 100, 100)],
        "grid_id string, epsg int, x0 double, y0 double, xres double, yres double, width int, height int",
    )
    cells = spark.range(100).select(F.col("id").alias("row")).withColumn("col", F.explode(F.sequence(F.lit(0), F.lit(99))))
    pixels = cells.withColumn("item_id", F.explode(F.array(*(F.lit(f"s{d}") for d in range(1, 7))))).selectExpr(
        "item_id", "row", "cast(col as long) col",
        "stack(2, 'B04', 1.0d, 'B08', if(row < 50, 3.0d, -1.0d)) as (band, raw)",
    )
    return rasters, grids, pixels


def in_metres(spark, path):
    """Projected corners of every field; the projection itself is tested on published points."""
    fields = field_files.read_feature_collection(spark, path)
    rows = fields.select("field_id", geometry.project_metres(F.col("geom")).alias("g")).collect()
    return {r["field_id"]: np.asarray(r["g"][0][0]) for r in rows}


def centre(ring):
    (x, y), (u, v) = ring[:-1].T, ring[1:].T
    cross = x * v - u * y
    return np.asarray([((x + u) * cross).sum(), ((y + v) * cross).sum()]) / (3 * cross.sum())


def members(rings):
    """The ids of every area's fields, by brute force: clusters first, then what is left alone, in the order of the file."""
    centres = np.asarray([centre(r) for r in rings.values()])
    apart = distances(centres)
    np.fill_diagonal(apart, np.inf)
    label = brute_dbscan(centres, max(1000.0, float(np.quantile(apart.min(axis=1), 0.9))), 2)
    for i in np.flatnonzero(label == -1):
        label[i] = label.max() + 1
    return {f"AOI_{n + 1:02}": [name for name, own in zip(rings, label, strict=True) if own == n] for n in range(label.max() + 1)}


def test_sample_areas(spark, layout, sample_fields):
    found = {r["aoi_id"]: r["bbox"] for r in field_files.read_aois(spark, layout.aois).collect()}
    tagged = field_files.read_feature_lines(spark, layout.tagged_fields, daily.TAGGED_PROPERTIES)
    got = {}
    for r in tagged.orderBy("ord").collect():
        got.setdefault(r["aoi_id"], []).append(r["field_id"])
    rings = in_metres(spark, sample_fields)
    assert got == members(rings) and len(got) > 4
    for area, names in got.items():
        corners = np.concatenate([rings[n] for n in names])
        (x0, y0), (x1, y1) = corners.min(axis=0) - 2000, corners.max(axis=0) + 2000
        box = spark.createDataFrame([(float(x), float(y)) for x in (x0, x1) for y in (y0, y1)], "x double, y double")
        points = np.asarray([r["p"] for r in box.select(projection.laea_inverse(F.col("x"), F.col("y")).alias("p")).collect()])
        assert found[area] == pytest.approx([*points.min(axis=0), *points.max(axis=0)], abs=1e-6)


def test_sample_distances(spark, sample_fields):
    from verdure.operators import aoi, neighbors

    fields = field_files.read_feature_collection(spark, sample_fields)
    nn = neighbors.nearest_distance(aoi.field_points(fields)).orderBy("ord")
    centres = np.asarray([centre(r) for r in in_metres(spark, sample_fields).values()])
    apart = np.linalg.norm(centres[:, None] - centres[None], axis=2)
    np.fill_diagonal(apart, np.inf)
    assert [r["nn_dist"] for r in nn.collect()] == pytest.approx(apart.min(axis=1).tolist(), abs=2e-3)
    assert aoi.estimate_eps(nn).first()[0] == pytest.approx(float(np.quantile(apart.min(axis=1), 0.9)), abs=2e-3)


def test_features_are_valid_geojson_lines(spark, layout):
    lines = [json.loads(r["value"]) for r in spark.read.text(layout.tagged_fields).collect()]
    assert len(lines) == len(FIELDS)
    assert {x["type"] for x in lines} == {"Feature"} and {x["geometry"]["type"] for x in lines} == {"Polygon"}
    assert {x["properties"]["planting_date"] for x in lines} == {planted for *_, planted in FIELDS}


def test_dates_become_iso_text_and_extra_columns_ride_along(spark):
    df = spark.sql(
        "select 0L ord, 'F' field_id, timestamp_ntz'2026-01-02 03:04:05' planting_date, 'wheat' crop, "
        "array(array(array(array(0d,0d),array(1d,0d),array(1d,1d),array(0d,0d)))) geom"
    )
    feature = json.loads(df.select(field_files.feature_text(df)).first()[0])
    assert feature["properties"] == {"field_id": "F", "planting_date": "2026-01-02T03:04:05", "crop": "wheat"}


def feature(i, properties, x=0.0, **more):
    square = [[[x, 0], [x + 1, 0], [x + 1, 1], [x, 0]]]
    return {"type": "Feature", "properties": properties, "geometry": {"type": "Polygon", "coordinates": square}, **more}


def test_all_properties_come_through(spark, tmp_path):
    own = [{"field_id": "a", "crop": "wheat", "yield": 2.5, "tags": ["x", 1], "planting_date": "2026-01-01"}, {"field_id": "b", "owner": None}]
    path = tmp_path / "in.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": [feature(i, p, 10.0 * i) for i, p in enumerate(own)]}))
    fields = field_files.read_feature_collection(spark, str(path)).withColumn("aoi_id", F.lit("AOI_01"))
    field_files.write_feature_lines(fields.drop("crs"), str(tmp_path / "out"))
    lines = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "out")).collect()]
    got = {x["id"]: x["properties"] for x in lines}
    assert got == {0: {**own[0], "aoi_id": "AOI_01"}, 1: {**own[1], "aoi_id": "AOI_01"}}
    again = field_files.read_feature_lines(spark, str(tmp_path / "out"), daily.TAGGED_PROPERTIES)
    assert [(r["ord"], r["field_id"], r["aoi_id"]) for r in again.orderBy("ord").collect()] == [(0, "a", "AOI_01"), (1, "b", "AOI_01")]


def test_files_of_a_folder_are_numbered_on(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    for k, n in enumerate((3, 0, 2)):
        features = [feature(i, {"field_id": f"{k}{i}", "planting_date": "2026-01-01"}) for i in range(n)]
        (folder / f"f{k}.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    got = field_files.read_feature_collection(spark, str(folder)).orderBy("ord").collect()
    assert [(r["ord"], r["field_id"]) for r in got] == [(0, "00"), (1, "01"), (2, "02"), (3, "20"), (4, "21")]


@pytest.mark.parametrize("ids", [[None] * 4, ["x", "y", "x", None], [1, 1, 2, 3], ["7", 3, "5", 9]])
def test_lines_with_any_ids(spark, tmp_path, ids):
    rows = [feature(i, {"field_id": f"f{i}", "planting_date": "2026-01-01"}, 0.1 * i, **({"id": x} if x is not None else {})) for i, x in enumerate(ids)]
    (tmp_path / "lines.json").write_text("\n".join(map(json.dumps, rows)))
    fields = field_files.read_feature_lines(spark, str(tmp_path / "lines.json"))
    got = {r["field_id"]: r["ord"] for r in fields.collect()}
    if ids == ["7", 3, "5", 9]:
        assert got == {"f0": 7, "f1": 3, "f2": 5, "f3": 9}
    else:
        assert sorted(got.values()) == [0, 1, 2, 3]
    assert daily.infer_areas(fields)[1].count() == 4


def test_a_file_without_planting_dates_is_refused(spark, tmp_path):
    (tmp_path / "lines.json").write_text(json.dumps(feature(0, {"field_id": "a", "crop": "x"})))
    with pytest.raises(ValueError, match="planting_date"):
        daily.run_areas(spark, str(tmp_path / "lines.json"), daily.Layout(str(tmp_path / "lake")), lines=True)


def test_runs_leave_no_intermediate_tables(spark, sample_fields, tmp_path):
    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = set(shared.iterdir())
    made = daily.Layout(str(tmp_path / "lake"))
    daily.run_areas(spark, sample_fields, made)
    daily.run_scenes(spark, scenes(spark), made, as_of=D(2026, 1, 2), catalog_url="https://c")
    rasters, grids, pixels = raster_tables(spark)
    daily.run_ndvi(spark, scenes(spark), rasters, grids, pixels, made, match_epsg=False)
    assert set(shared.iterdir()) == before
    refs = keyed.read_refs(spark, made.refs)
    assert {r["stac_url"] for r in refs.where("status = 'ok'").collect()} == {"https://c"}
    assert refs.where("status <> 'ok' and stac_url is not null").count() == 0


def test_area_array_file(spark, tmp_path):
    path = tmp_path / "aois.json"
    path.write_text(json.dumps([{"aoi_id": "AOI_01", "bbox": [1, 2, 3, 4]}, {"aoi_id": "AOI_02", "bbox": [0, 0, 1, 1]}], indent=2))
    assert field_files.read_aoi_array(spark, str(path)).count() == 2


def test_mixed_geometries_and_broken_file(spark, tmp_path):
    square = [[[0, 0], [1, 0], [1, 1], [0, 0]]]
    features = [
        {"type": "Feature", "properties": {"field_id": "a", "planting_date": None}, "geometry": {"type": "Polygon", "coordinates": square}},
        {"type": "Feature", "properties": {"field_id": "b"}, "geometry": {"type": "MultiPolygon", "coordinates": [square, square]}},
    ]
    path = tmp_path / "mixed.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    got = field_files.read_feature_collection(spark, str(path)).orderBy("ord").collect()
    assert [(r["ord"], r["field_id"], len(r["geom"]), r["crs"]) for r in got] == [(0, "a", 1, None), (1, "b", 2, None)]
    (tmp_path / "broken.geojson").write_text('{"features": [')
    with pytest.raises(Exception, match="(?i)malformed"):
        field_files.read_feature_collection(spark, str(tmp_path / "broken.geojson")).collect()


def test_three_stages_and_reruns(spark, layout, sample_fields):
    rasters, grids, pixels = raster_tables(spark)

    def run(day):
        daily.run_scenes(spark, scenes(spark), layout, as_of=day)
        daily.run_ndvi(spark, scenes(spark), rasters, grids, pixels, layout, match_epsg=False)

    def stored(path):
        return {str(p): p.stat().st_mtime_ns for p in Path(path).rglob("part-*")}

    planted = {name: int(day[-2:]) for name, *_, day in FIELDS}
    areas = members(in_metres(spark, sample_fields))
    first_day = {a: min(planted[n] for n in names) for a, names in areas.items()}
    north, south = (next(a for a, names in areas.items() if all(n.startswith(w) for n in names)) for w in ("north", "south"))
    far = next(a for a, names in areas.items() if all(n.startswith("far") for n in names) and first_day[a] == 1)
    met = sum(any(not n.startswith("far") for n in names) for names in areas.values())

    def due(last):
        return sum(max(0, last - d + 1) for d in first_day.values())

    run(D(2026, 1, 4))
    refs = keyed.read_refs(spark, layout.refs)
    assert refs.count() == len(areas) * 4 and refs.where("status = 'ok'").count() == met * 3
    records = {(r["aoi_id"], r["date"].day): r for r in keyed.read_ndvi(spark, layout.series).collect()}
    assert len(records) == due(4)
    first = records[north, 1]
    assert first["status"] == "ok" and first["cloud_cover"] == 1.0 and first["mean_ndvi"] is not None
    assert records[north, 3]["status"] == "no_satellite_item"
    assert records[north, 4]["status"] == "missing_crs" and records[north, 4]["cloud_cover"] is None
    assert records[far, 1]["status"] == "no_satellite_item"
    # south of row 50 there is nodata in the second band: no mean, still ok
    assert records[south, 2]["status"] == "ok" and records[south, 2]["mean_ndvi"] is None
    before = stored(layout.refs)
    run(D(2026, 1, 4))
    assert stored(layout.refs) == before and keyed.read_ndvi(spark, layout.series).count() == due(4)
    run(D(2026, 1, 6))
    assert keyed.read_refs(spark, layout.refs).count() == len(areas) * 6
    assert keyed.read_ndvi(spark, layout.series).count() == due(6)
    # a day without a scene is looked up again only on request
    better = scenes(spark).withColumn("cloud_cover", F.lit(1.0))
    daily.run_scenes(spark, better, layout, as_of=D(2026, 1, 6))
    assert keyed.read_refs(spark, layout.refs).where("status = 'ok'").count() == met * 4
    daily.run_scenes(spark, better, layout, as_of=D(2026, 1, 6), refresh_missing=True)
    after = keyed.read_refs(spark, layout.refs)
    assert after.count() == len(areas) * 6 and after.where("status = 'ok'").count() == met * 6


def test_a_scene_on_a_grid_of_another_system_fails(spark, layout):
    rasters, grids, pixels = raster_tables(spark)
    tagged = field_files.read_feature_lines(spark, layout.tagged_fields, daily.TAGGED_PROPERTIES)
    refs = daily.select_scenes(field_files.read_aois(spark, layout.aois), tagged, scenes(spark), as_of=D(2026, 1, 1))
    pairs = refs.select("aoi_id", "date")
    with pytest.raises(Exception, match="EPSG 32632 on grid G in 4326"):
        daily.daily_ndvi(tagged, pairs, refs, scenes(spark), rasters, grids, pixels)


def records_of(spark, *rows):
    return spark.createDataFrame(list(rows), keyed.NDVI_SCHEMA)


@pytest.mark.parametrize("layout_keys", [keyed.BY_DAY, keyed.NDVI_KEYS, keyed.REF_KEYS])
def test_results_replace_only_their_own_keys(spark, tmp_path, layout_keys):
    path = str(tmp_path / "series")
    stamp = dt.datetime(2026, 1, 1, 10, 0, 0, 123456)
    assert keyed.read_ndvi(spark, path).count() == 0
    old = [(a, D(2026, 1, d), "ok", 0.1, 1.0, stamp) for a in "AB" for d in (1, 2)]
    keyed.write_ndvi(records_of(spark, *old), path, layout_keys)
    new = [("A", D(2026, 1, 1), "no_satellite_item", None, None, None), ("C", D(2026, 1, 3), "ok", 0.2, 2.0, stamp)]
    keyed.write_ndvi(records_of(spark, *new), path, layout_keys)
    want = {*old[1:], *new}
    assert {tuple(r) for r in keyed.read_ndvi(spark, path).collect()} == want
    lines = [r["value"] for r in spark.read.text(path).collect()]
    assert len(lines) == 5 and sum('"mean_ndvi":null' in x for x in lines) == 1
    folders = {p.parent.relative_to(path).as_posix() for p in Path(path).rglob("part-*")}
    if layout_keys == keyed.NDVI_KEYS:
        assert "date=2026-01-01/aoi_id=A" in folders and len(folders) == 5
    if layout_keys == keyed.REF_KEYS:
        assert "aoi_id=A/date=2026-01-01" in folders


def test_unreadable_reference_counts_as_missing(spark, tmp_path):
    folder = tmp_path / "refs" / "date=2026-01-01"
    folder.mkdir(parents=True)
    (folder / "part-0.json").write_text('{"aoi_id":"A","status":\n{"aoi_id":"B","status":"no_items"}\n')
    refs = keyed.read_refs(spark, str(tmp_path / "refs"))
    work = spark.createDataFrame([(a, D(2026, 1, 1)) for a in "AB"], "aoi_id string, date date")
    got = ndvi.resolved_refs(work, refs, scenes(spark)).collect()
    assert {(r["aoi_id"], r["status"]) for r in got} == {("A", "no_satellite_item"), ("B", "no_satellite_item")}


def test_reference_to_an_unknown_scene_fails(spark):
    work = spark.createDataFrame([("A", D(2026, 1, 1))], "aoi_id string, date date")
    refs = work.selectExpr(
        "*", "'ok' status", "array(0d) bbox", "timestamp_ntz'2026-01-01 10:00:00' item_datetime", "1d cloud_cover",
        "null stac_url", "'c' collection", "'gone' item_id", "'B04' b04_asset", "'B08' b08_asset",
    )
    with pytest.raises(Exception, match="unknown scene gone"):
        ndvi.resolved_refs(work, refs, scenes(spark)).collect()


def test_required_columns(spark):
    with pytest.raises(ValueError, match="aoi_id"):
        daily.daily_ndvi(spark.sql("select current_date() planting_date"), *[None] * 6)


def test_manifest_and_first_result(spark, layout):
    row = daily.stage_manifest(field_files.read_aois(spark, layout.aois), layout, "bucket").first()
    assert row["aois_count"] == 7 and row["aois_json_s3"] == "s3://bucket/derived/aois.json"
    none = records_of(spark, ("A", D(2026, 1, 1), "ok", 0.1, None, None)).limit(0)
    assert daily.first_result(none, "calculation", "b").count() == 0


def test_streamed_choice_equals_batch_on_closed_days(spark, layout, tmp_path):
    areas = field_files.read_aois(spark, layout.aois)
    source, refs, state = (str(tmp_path / n) for n in ("feed", "refs", "state"))
    feed = scenes(spark)
    for d in range(1, 7):
        feed.where(F.dayofmonth("dt") == d).coalesce(1).write.mode("append").parquet(source)
        best = stream.stream_best_scenes(stream.read_scene_stream(spark, source, 1), areas)
        stream.append_refs(best, areas, refs, state).awaitTermination()
    # a better scene for a day long closed arrives late and changes nothing
    late = feed.where("item_id = 's2'").withColumn("item_id", F.lit("late")).withColumn("cloud_cover", F.lit(0.0))
    late.coalesce(1).write.mode("append").parquet(source)
    best = stream.stream_best_scenes(stream.read_scene_stream(spark, source, 1), areas)
    stream.append_refs(best, areas, refs, state).awaitTermination()
    pairs = selection.aoi_days(areas, spark.sql("select date'2026-01-01' planting_date"), D(2026, 1, 6))
    whole = selection.scene_refs(pairs, feed).where("status = 'ok'")
    batch = whole.where("date <= '2026-01-04'")
    columns = ["aoi_id", "date", "status", "bbox", "item_datetime", "cloud_cover", "item_id", "b04_asset", "b08_asset"]
    got = sorted(keyed.read_refs(spark, refs).select(*columns).collect())
    assert got == sorted(batch.select(*columns).collect()) and len(got) == 2 * 3
    # the end of the input closes the days that were still open, once
    for _ in range(2):
        stream.close_refs(feed, areas, refs)
        got = sorted(keyed.read_refs(spark, refs).select(*columns).collect())
        assert got == sorted(whole.select(*columns).collect()) and len(got) == 2 * 4


def test_streamed_scenes_meet_areas_once_per_footprint_and_day(spark, tmp_path):
    scenes(spark).write.parquet(f"{tmp_path}/feed")
    areas = spark.createDataFrame([("A", [0.0, 0.0, 1.0, 1.0])], "aoi_id string, bbox array<double>")
    best = stream.stream_best_scenes(stream.read_scene_stream(spark, f"{tmp_path}/feed"), areas)
    lines = best._jdf.queryExecution().analyzed().toString().split("\n")
    below = lines[next(i for i, line in enumerate(lines) if "Join Inner" in line) :]
    assert any("min_by" in line and "xmin" in line for line in below)


def test_streamed_index_equals_batch_and_survives_a_replay(spark, layout, tmp_path):
    rasters, grids, pixels = raster_tables(spark)
    tagged = field_files.read_feature_lines(spark, layout.tagged_fields, daily.TAGGED_PROPERTIES)
    areas = field_files.read_aois(spark, layout.aois)
    refs = daily.select_scenes(areas, tagged, scenes(spark), as_of=D(2026, 1, 4))

    def compute(batch):
        return daily.daily_ndvi(
            tagged, batch.select("aoi_id", "date"), batch, scenes(spark), rasters, grids, pixels, match_epsg=False
        )

    where, series = str(tmp_path / "refs"), str(tmp_path / "series")
    keyed.append_refs(refs, where)
    for state in ("first", "replayed"):
        feed = stream.read_ref_stream(spark, where)
        stream.append_ndvi(feed, compute, series, str(tmp_path / state)).awaitTermination()
        want = sorted(map(str, compute(refs).collect()))
        assert sorted(map(str, keyed.read_ndvi(spark, series).collect())) == want and len(want) > areas.count()
