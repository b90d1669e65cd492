import math

import pytest
from pyspark.sql import functions as F

from verdure.functions import assets, geometry, keys, projection, raster


def one(df):
    return df.first()[0]


def test_laea_matches_the_published_check_point(spark):
    p = one(spark.range(1).select(projection.laea_forward(F.lit(5.0), F.lit(50.0))))
    assert p == pytest.approx([3962799.451, 2999718.853], abs=1e-3)


def test_projections_invert(spark):
    places = spark.sql(
        "select lon, lat from (select explode(array(-8.0d, 1.5d, 10.0d, 24.7d)) lon) "
        "cross join (select explode(array(36.1d, 52.0d, 68.9d)) lat)"
    )
    lon, lat = F.col("lon"), F.col("lat")
    for epsg in (3035, 4326, *projection.SYSTEMS):
        code = F.lit(epsg)
        there = places.withColumn("p", projection.from_lonlat(lon, lat, code))
        back = there.withColumn("q", projection.to_lonlat(F.col("p")[0], F.col("p")[1], code))
        for r in back.collect():
            assert r["q"] == pytest.approx([r["lon"], r["lat"]], abs=1e-8)


#: Published worked examples: system, degrees, coordinates.
EXAMPLES = [
    (projection.Conformal("conic", -99, 28 + 23 / 60, 30 + 17 / 60, 27 + 50 / 60, 2000000, 0, 20925832.16, 1 / 294.97870), (-96, 28.5), (2963503.91, 254759.80)),
    (projection.Conformal("mercator", 110, 0, 0, 0, 3900000, 900000, 6377397.155, 1 / 299.15281, 0.997), (120, -3), (5009726.58, 569150.82)),
    (projection.Conformal("polar", 70, -71, 0, 0, 6000000, 6000000, flattening=1 / 298.257223563), (120, -75), (7255380.79, 7053389.56)),
    (projection.SYSTEMS[3857], (-100 - 20 / 60, 24 + 22 / 60 + 54.433 / 3600), (-11169055.58, 2800000.00)),
    (projection.SYSTEMS[2154], (3, 46.5), (700000, 6600000)),
    (projection.SYSTEMS[3413], (-45, 90), (0, 0)),
    (projection.SYSTEMS[3031], (20, -90), (0, 0)),
]


@pytest.mark.parametrize("system, place, point", EXAMPLES)
def test_conformal_systems_match_published_points(spark, system, place, point):
    there = spark.range(1).select(system.forward(F.lit(float(place[0])), F.lit(float(place[1]))).alias("p"))
    assert one(there) == pytest.approx(list(point), abs=6e-3)
    back = one(there.select(system.inverse(F.col("p")[0], F.col("p")[1])))
    assert back[1] == pytest.approx(place[1], abs=1e-8)
    assert abs(place[1]) == 90 or back[0] == pytest.approx(place[0], abs=1e-8)


def test_systems_invert_around_the_globe(spark):
    places = spark.createDataFrame([(float(lon), float(lat)) for lon in range(-180, 180, 23) for lat in (-84, -60, -1, 0, 33, 70, 84)], "lon double, lat double")
    for number, system in projection.SYSTEMS.items():
        there = places.withColumn("p", system.forward(F.col("lon"), F.col("lat")))
        for r in there.withColumn("q", system.inverse(F.col("p")[0], F.col("p")[1])).collect():
            assert r["q"][1] == pytest.approx(r["lat"], abs=1e-8), number
            assert math.cos(math.radians(r["q"][0] - r["lon"])) == pytest.approx(1, abs=1e-15), number


def test_utm_follows_the_meridian_arc_and_inverts(spark):
    rows = [(z, 6 * z - 183.0 + d, lat) for z in (1, 32, 60) for d in (-2.5, 0.0, 2.9) for lat in (-60.0, 0.5, 47.0)]
    df = spark.createDataFrame(rows, "zone int, lon double, lat double").withColumn(
        "epsg", F.when(F.col("lat") < 0, 32700).otherwise(32600) + F.col("zone")
    )
    there = df.withColumn("p", projection.from_lonlat(F.col("lon"), F.col("lat"), F.col("epsg")))
    back = there.withColumn("q", projection.to_lonlat(F.col("p")[0], F.col("p")[1], F.col("epsg")))

    def arc(lat, n=20000):
        """Meridian arc by the midpoint rule."""
        e2, total, h = projection.E2, 0.0, math.radians(lat) / n
        for i in range(n):
            s = math.sin((i + 0.5) * h)
            total += projection.SEMI_MAJOR * (1 - e2) / (1 - e2 * s * s) ** 1.5 * h
        return total

    for r in back.collect():
        assert r["q"] == pytest.approx([r["lon"], r["lat"]], abs=1e-8)
        if r["lon"] == 6 * r["zone"] - 183.0:
            north = 0.9996 * arc(r["lat"]) + (1e7 if r["lat"] < 0 else 0)
            assert r["p"] == pytest.approx([500000.0, north], abs=2e-3)


def test_unknown_crs_fails(spark):
    with pytest.raises(Exception, match="unsupported"):
        spark.range(1).select(projection.from_lonlat(F.lit(1.0), F.lit(1.0), F.lit(27700))).collect()
    with pytest.raises(Exception, match="unsupported"):
        spark.range(1).select(projection.crs_epsg(F.lit("local grid"))).collect()


def test_crs_names(spark):
    names = [None, "urn:ogc:def:crs:OGC:1.3:CRS84", "EPSG:4326", "urn:ogc:def:crs:EPSG::3035", "epsg:32632"]
    df = spark.createDataFrame([(n,) for n in names], "c string")
    got = [r[0] for r in df.select(projection.crs_epsg(F.col("c"))).collect()]
    assert got == [4326, 4326, 4326, 3035, 32632]


SQUARE = [[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 4.0], [0.0, 0.0]]
HOLE = [[1.0, 1.0], [1.0, 2.0], [2.0, 2.0], [2.0, 1.0], [1.0, 1.0]]


def shapes(spark, *geoms):
    return spark.createDataFrame([(i, g) for i, g in enumerate(geoms)], f"i int, geom {geometry.GEOM_TYPE}")


def test_centroid_with_hole_many_parts_and_no_area(spark):
    far = [[x + 1e6, y + 3e6] for x, y in SQUARE]
    line = [[0.0, 0.0], [2.0, 0.0], [0.0, 0.0]]
    point = [[7.0, 8.0], [7.0, 8.0]]
    df = shapes(
        spark, [[SQUARE]], [[SQUARE, HOLE]], [[SQUARE, HOLE[::-1]]], [[SQUARE[::-1], HOLE]],
        [[SQUARE], [far]], [[line]], [[point]],
    )
    rows = df.select("i", geometry.centroid(F.col("geom")).alias("c")).orderBy("i").collect()
    got = [(r["c"]["x"], r["c"]["y"]) for r in rows]
    holed = (32 - 1.5) / 15
    want = [(2, 2), (holed, holed), (holed, holed), (holed, holed), (500002, 1500002), (1, 0), (7, 8)]
    for g, w in zip(got, want, strict=True):
        assert g == pytest.approx(w, abs=1e-6)


def test_geojson_polygon_and_multipolygon_survive(spark):
    df = shapes(spark, [[SQUARE, HOLE]], [[SQUARE], [HOLE]])
    text = df.withColumn("t", geometry.to_geojson(F.col("geom")))
    kinds = [F.get_json_object("t", p) for p in ("$.type", "$.coordinates")]
    back = text.withColumn("back", geometry.from_geojson(*kinds))
    assert back.where("back = geom").count() == 2
    assert [r[0] for r in text.orderBy("i").select(F.get_json_object("t", "$.type")).collect()] == [
        "Polygon",
        "MultiPolygon",
    ]


ASSET = "map<string, struct<href: string, proj_epsg: int, scale: double, offset: double, nodata: double>>"


def scene_assets(spark, *maps):
    blank = (None, None, None, None, None)
    rows = [(i, {k: (None, v, None, None, None) if v else blank for k, v in m.items()}) for i, m in enumerate(maps)]
    return spark.createDataFrame(rows, f"i int, assets {ASSET}")


def test_asset_order_exact_before_case(spark):
    df = scene_assets(
        spark, {"red": None, "B04": None}, {"b04": None, "red": None}, {"RED": None, "b04_10M": None}, {"B02": None}
    )
    got = [
        r[0]
        for r in df.orderBy("i").select(assets.find_asset(F.col("assets"), assets.RED_ASSETS)).collect()
    ]
    # an exact later candidate beats an earlier one in another case
    assert got == ["B04", "red", "b04_10M", None]


def test_missing_asset_fails_and_names_the_keys(spark):
    df = scene_assets(spark, {"B02": None, "B03": None})
    with pytest.raises(Exception, match="available: B02, B03"):
        df.select(assets.pick_asset(F.col("assets"), assets.RED_ASSETS)).collect()


def test_epsg_prefers_item_then_red_then_nir(spark):
    df = scene_assets(spark, {"r": 1, "n": 2}, {"r": 1, "n": 2}, {"r": None, "n": 2}, {"r": None, "n": None}, {"n": 2})
    item = F.when(F.col("i") == 0, 9)
    epsg = assets.pick_epsg(item, F.col("assets"), F.lit("r"), F.lit("n"))
    assert [r[0] for r in df.orderBy("i").select(epsg).collect()] == [9, 1, 2, None, 2]


def test_split_uri(spark):
    uris = ["s3://my-bucket/path/to/file.txt", "s3://bucket/some/deep/path/file.geojson", "gs://b/k", "s3://b/", None]
    df = spark.createDataFrame([(u,) for u in uris], "u string")
    got = [tuple(r[0]) if r[0] else None for r in df.select(keys.split_uri(F.col("u"))).collect()]
    assert got == [
        ("my-bucket", "path/to/file.txt"),
        ("bucket", "some/deep/path/file.geojson"),
        ("b", "k"),
        ("b", ""),
        None,
    ]
    with pytest.raises(Exception, match="no key"):
        spark.range(1).select(keys.split_uri(F.lit("s3://only-bucket"))).collect()


def test_paths_have_one_slash(spark):
    row = spark.range(1).select(
        keys.reference_path("ingest//", F.lit("AOI_01"), F.lit("2026-01-01")),
        keys.ndvi_path("calculation", F.lit("AOI_01"), F.lit("2026-01-01")),
    ).first()
    assert row[0] == "ingest/aoi_id=AOI_01/date=2026-01-01/s2_refs.json"
    assert row[1] == "calculation/aoi_timeseries/date=2026-01-01/aoi_id=AOI_01/ndvi.json"


def test_pixel_values(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(0, 5.0), (1, -9999.0), (2, nan), (3, None)], "i int, raw double")
    value = raster.rescale(F.col("raw"), F.lit(-9999.0), F.lit(0.1), F.lit(1.0))
    assert [r[0] for r in df.orderBy("i").select(value).collect()] == [1.5, None, None, None]
    bands = spark.createDataFrame(
        [(0, 0.1, 0.3), (1, 0.0, 0.0), (2, -0.2, 0.2), (3, None, 0.2)], "i int, red double, nir double"
    )
    got = [r[0] for r in bands.orderBy("i").select(raster.ndvi(F.col("red"), F.col("nir"))).collect()]
    assert got[0] == pytest.approx(0.5) and got[1:] == [None, None, None]
    groups = spark.createDataFrame(
        [("a", 1.0), ("a", nan), ("a", None), ("b", inf), ("b", 1.0), ("c", None), ("d", nan)], "g string, v double"
    )
    means = dict(groups.groupBy("g").agg(raster.mean_present(F.col("v"))).collect())
    assert means == {"a": 1.0, "b": None, "c": None, "d": None}
