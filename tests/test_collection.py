"""The splittable reader of FeatureCollections against the reader of whole files."""

import json
import random

import pytest

from verdure.sources import collection, fields


def feature(rng, i):
    names = ["plain", 'quote " inside', "brace } { in text", "back\\slash \\", "[list] ]", "né}e", '\\" }', "tab\t}", ""]
    x, y = rng.uniform(5, 9), rng.uniform(48, 52)
    ring = [[x, y], [x + 0.1, y], [x, y + 0.1], [x, y]]
    properties = {"field_id": f"F{i}", "planting_date": "2026-02-03", "note": rng.choice(names), "more": rng.choice([None, {"a": {"b": ["}", {"c": 1}]}}, [], [{"x": "{"}]])}
    geometry = rng.choice([{"type": "Polygon", "coordinates": [ring]}, {"type": "MultiPolygon", "coordinates": [[ring], [ring]]}])
    return {"type": "Feature", "properties": properties, "geometry": geometry} | ({"id": str(i)} if rng.random() < 0.5 else {})


CRS = {"type": "name", "properties": {"name": "EPSG:4326"}}


def written(folder, rng, count, indent, crs_at):
    head = {"type": "FeatureCollection"} | ({"crs": CRS} if crs_at == "head" else {})
    tail = {"crs": CRS, "note": "the } end"} if crs_at == "tail" else {}
    text = json.dumps(head | {"name": 'odd "}" name', "features": [feature(rng, i) for i in range(count)]} | tail, indent=indent, ensure_ascii=rng.random() < 0.5)
    folder.mkdir(exist_ok=True)
    (folder / f"part-{rng.randrange(10**9)}.geojson").write_text(text, encoding="utf-8")


def rows(df):
    return sorted((r["ord"], r["field_id"], r["planting_date"], json.dumps(json.loads(r["properties"]), sort_keys=True), r["crs"], str(r["geom"])) for r in df.collect())


@pytest.mark.parametrize("split", [97, 1000, 10**6])
@pytest.mark.parametrize("indent, crs_at", [(None, "head"), (2, "tail"), (None, None)])
def test_split_reader_equals_the_whole_file_reader(spark, tmp_path, split, indent, crs_at):
    rng = random.Random(split)
    for count in (40, 1, 0, 7):
        written(tmp_path / "c", rng, count, indent, crs_at)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    want = rows(fields.read_feature_collection(spark, str(tmp_path / "c")))
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        pieces = collection._pieces(spark, str(tmp_path / "c"))
        ranges = pieces.select("file", "start").distinct().count()
        got = rows(collection.read_collection_split(spark, str(tmp_path / "c")))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(got) == 48 and got == want
    assert ranges > 20 if split < 1000 else ranges >= 4


def test_folder_without_features(spark, tmp_path):
    written(tmp_path / "c", random.Random(1), 0, None, "head")
    assert collection.read_collection_split(spark, str(tmp_path / "c")).count() == 0
