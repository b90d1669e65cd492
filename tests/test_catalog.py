"""Searches of the laid-out scene catalog: same scenes as a scan, few files opened."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from verdure.sources import catalog
from verdure.sources.scenes import SCENE_SCHEMA


@pytest.fixture(scope="module")
def table(spark):
    rng, rows = random.Random(9), []
    for i in range(6000):
        # a third of all scenes over one place
        x, y = (10.0, 50.0) if i % 3 == 0 else (rng.uniform(-179, 178), rng.uniform(-80, 79))
        when = dt.datetime(2026, 1, 1) + dt.timedelta(minutes=rng.randrange(60 * 24 * 60))
        rows.append((f"s{i}", "c", when, rng.choice([None, 5.0, 29.9, 30.0, 90.0]), None, x, y, x + 1, y + 1, None))
    rows += [("no-time", "c", None, 1.0, None, 10.0, 50.0, 11.0, 51.0, None), ("no-box", "c", dt.datetime(2026, 1, 2), 1.0, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCENE_SCHEMA)


@pytest.fixture(scope="module")
def where(spark, table, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("catalog"))
    catalog.write_catalog(table, path, file_scenes=100)
    return path


@pytest.mark.parametrize("box", [(10.2, 50.2, 10.3, 50.3), (-20.0, -30.0, -5.0, 10.0), (11.0, 51.0, 12.0, 52.0), (-180.0, -90.0, 180.0, 90.0), (0.0, 89.0, 1.0, 89.5)])
@pytest.mark.parametrize("days", [(dt.date(2026, 1, 10), dt.date(2026, 1, 10)), (dt.date(2026, 1, 30), dt.date(2026, 2, 3))])
def test_search_equals_scan(spark, table, where, box, days):
    got = {r.item_id for r in catalog.search(spark, where, box, *days).collect()}
    want = set()
    for r in table.collect():
        if r.dt and r.xmin is not None and r.cloud_cover is not None and r.cloud_cover < 30 and days[0] <= r.dt.date() <= days[1]:
            if r.xmin <= box[2] and r.xmax >= box[0] and r.ymin <= box[3] and r.ymax >= box[1]:
                want.add(r.item_id)
    assert got == want


def test_a_small_box_opens_few_files(spark, where):
    all_files = spark.read.parquet(f"{where}/index").count()
    few = catalog.matching_files(spark, where, (-100.0, 20.0, -99.0, 21.0), dt.date(2026, 1, 10), dt.date(2026, 1, 10))
    assert all_files >= 60 and len(few) <= all_files // 10
    assert len(catalog.search(spark, where, (-100.0, 20.0, -99.0, 21.0), dt.date(2026, 1, 10), dt.date(2026, 1, 10)).inputFiles()) == len(few)
    assert catalog.matching_files(spark, where, (-100.0, 20.0, -99.0, 21.0), dt.date(2027, 1, 1), dt.date(2027, 1, 2)) == []


def test_all_scenes_stay_in_the_catalog(spark, table, where):
    assert sorted(map(str, catalog.read_catalog(spark, where).collect())) == sorted(map(str, table.collect()))
    assert spark.read.parquet(f"{where}/index").agg(F.sum("n")).first()[0] == table.count()


def test_curve_interleaves_bits(spark):
    def place(cx, cy):
        x, y = (cx + 0.5) / 65536 * 360 - 180, (cy + 0.5) / 65536 * 180 - 90
        return spark.range(1).select(catalog.curve_place(F.lit(x), F.lit(y))).first()[0]

    for cx, cy in ((0, 0), (1, 0), (0, 1), (3, 5), (65535, 65535), (0b1010110011110001, 0b0110101000011101)):
        assert place(cx, cy) == sum(((cx >> i & 1) << (2 * i)) | ((cy >> i & 1) << (2 * i + 1)) for i in range(16))


def test_empty_catalog(spark, table, tmp_path):
    catalog.write_catalog(table.limit(0), str(tmp_path))
    assert catalog.search(spark, str(tmp_path), (-180.0, -90.0, 180.0, 90.0), dt.date(2026, 1, 1), dt.date(2026, 1, 9)).count() == 0
