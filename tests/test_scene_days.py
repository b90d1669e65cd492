"""References from event-time timers, against the batch stage."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from verdure.operators import selection
from verdure.sources import keyed
from verdure.sources.scenes import SCENE_SCHEMA
from verdure.streaming import days
from verdure.streaming.daily import read_scene_stream

FIRST, LAST = dt.date(2026, 3, 1), dt.date(2026, 3, 12)


@pytest.fixture
def areas(spark):
    rows = [("AOI_01", [0.0, 0.0, 1.0, 1.0]), ("AOI_02", [0.5, 0.5, 3.0, 3.0]), ("AOI_03", [50.0, 50.0, 51.0, 51.0])]
    return spark.createDataFrame([(a, box, FIRST, LAST) for a, box in rows], "aoi_id string, bbox array<double>, first_day date, last_day date")


def scenes(spark, rows):
    asset = ("x", 32631, None, None, None)
    made = [(f"s{i:03}", "c", when, cloud, None, x, y, x + 1.0, y + 1.0, {"B04": asset, "B08": asset}) for i, (when, cloud, x, y) in enumerate(rows)]
    return spark.createDataFrame(made, SCENE_SCHEMA)


def some(seed, count=150):
    rng = random.Random(seed)
    start = dt.datetime(2026, 2, 27)
    # few different clouds and times, so that ties are common
    return [
        (start + dt.timedelta(hours=rng.randrange(16 * 8) * 3), rng.choice([None, 0.0, 5.0, 29.9, 30.0, 80.0]), rng.choice([-3.0, 0.2, 2.0]), rng.choice([0.0, 2.0]))
        for _ in range(count)
    ]


def streamed(spark, source, areas, folder):
    refs = days.stream_days(read_scene_stream(spark, source), areas, catalog_url="u")
    days.write_days(refs, f"{folder}/refs", f"{folder}/state").awaitTermination()
    return keyed.read_refs(spark, f"{folder}/refs")


def rows_of(refs):
    return sorted(str(tuple(r)) for r in refs.collect())


def in_batch(areas, table):
    pairs = areas.select("aoi_id", "bbox", F.explode(F.sequence("first_day", "last_day")).alias("date"))
    return selection.scene_refs(pairs, table, catalog_url="u")


def test_stream_gives_all_references_of_the_batch_stage(spark, areas, tmp_path):
    table = scenes(spark, some(1))
    table.repartition(5).write.parquet(f"{tmp_path}/feed")
    days.end_of_input(spark, f"{tmp_path}/feed", LAST)
    before = spark.conf.get(days.PROVIDER, None)
    got = streamed(spark, f"{tmp_path}/feed", areas, tmp_path)
    assert rows_of(got) == rows_of(in_batch(areas, table)) and got.count() == 36
    assert got.where("aoi_id = 'AOI_03' and status = 'no_items'").count() == 12
    assert spark.conf.get(days.PROVIDER, None) == before


def test_days_close_over_several_runs_and_late_scenes_change_nothing(spark, areas, tmp_path):
    table, feed = scenes(spark, some(2)), f"{tmp_path}/feed"
    half = F.col("dt") < F.lit(dt.datetime(2026, 3, 6))
    table.where(half).write.parquet(feed)
    first = streamed(spark, feed, areas, tmp_path)
    closed = first.agg(F.max("date")).first()[0]
    assert FIRST <= closed < dt.date(2026, 3, 6)
    kept = rows_of(first)
    table.where(~half).write.mode("append").parquet(feed)
    late = scenes(spark, [(dt.datetime(2026, 3, 1, 12), 0.0, 0.2, 0.0)]).withColumn("item_id", F.lit("a-late-one"))
    late.write.mode("append").parquet(feed)
    days.end_of_input(spark, feed, LAST)
    got = streamed(spark, feed, areas, tmp_path)
    assert set(kept) <= set(rows_of(got))
    assert rows_of(got) == rows_of(in_batch(areas, table))


def test_no_scene_at_all(spark, areas, tmp_path):
    scenes(spark, []).write.parquet(f"{tmp_path}/feed")
    days.end_of_input(spark, f"{tmp_path}/feed", LAST)
    got = streamed(spark, f"{tmp_path}/feed", areas, tmp_path)
    assert got.count() == 36 and got.where("status = 'no_items' and item_id is null and stac_url is null").count() == 36


def test_an_area_gets_one_scene_per_closed_day(spark, areas, tmp_path):
    scenes(spark, some(3)).write.parquet(f"{tmp_path}/feed")
    refs = days.stream_days(read_scene_stream(spark, f"{tmp_path}/feed"), areas, catalog_url="u")
    lines = refs._jdf.queryExecution().analyzed().toString().split("\n")
    below = lines[next(i for i, line in enumerate(lines) if "TransformWithState" in line) :]
    assert sum("min_by" in line for line in below) == 2
