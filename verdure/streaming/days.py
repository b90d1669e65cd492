"""Scene choice for every area and day on event-time timers.

A day's best scenes reach the areas when it has closed, one per area. Each area holds, as keyed state, the best scene of
its undecided days and the next day to decide. A timer stands at the end of that day: once the watermark passes it, all days that have ended are decided in order, ``ok`` with the scene held
or ``no_items`` without one, their state is dropped and the timer moves on. The areas come in as initial state, so an area
that no scene ever touches is decided too, and the stream alone gives the references of all areas and days: no batch stage
completes it and no micro-batch reads an earlier output. What was written is exactly what the file sink has committed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from verdure.functions.assets import NIR_ASSETS, RED_ASSETS, pick_asset
from verdure.operators import selection
from verdure.sources import keyed
from verdure.sources.scenes import SCENE_SCHEMA
from verdure.streaming.daily import LATENESS, best_of_closed_days

DAY_MS = 86_400_000
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_HELD = ["cloud", "micros", "item_id", "rest"]
_OUT = "aoi_id string, day int, cloud double, micros long, item_id string, rest string"
_REST = "struct<collection:string,assets:{}>"


class AreaDays(StatefulProcessor):
    """Best scene per open day of one area, and the days it has decided."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # one list per area, read and put back whole: a call to the state store costs more than the few open days
        self.held = handle.getListState("held", "day int, cloud double, micros long, item_id string, rest string")
        self.span = handle.getValueState("span", "next int, last int")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self._begin(int(initialState["first_day"].iloc[0]), int(initialState["last_day"].iloc[0]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        best, found = self._open(), False
        for frame in rows:
            if not self.span.exists():  # an area that came after the start
                self._begin(int(frame["first_day"].iloc[0]), int(frame["last_day"].iloc[0]))
            upcoming, last = self.span.get()
            for row in frame[["day", *_HELD]].itertuples(index=False):
                # a day is decided once: scenes of decided days come too late
                if upcoming <= row.day <= last:
                    scene = (float(row.cloud), int(row.micros), row.item_id, row.rest)
                    day = int(row.day)
                    if day not in best or scene[:3] < best[day][:3]:
                        best[day], found = scene, True
        if found:
            self._keep(best)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        upcoming, last = self.span.get()
        ended = min(timerValues.getCurrentWatermarkInMs() // DAY_MS, last + 1)
        best = self._open()
        decided = [(key[0], day, *best.pop(day, (None, None, None, None))) for day in range(upcoming, ended)]
        if any(d[-1] is not None for d in decided):
            self._keep(best)
        self._begin(max(upcoming, ended), last)
        if decided:
            yield pd.DataFrame(decided, columns=["aoi_id", "day", *_HELD]).astype({"micros": "Int64", "cloud": "Float64"})

    def _open(self) -> dict[int, tuple]:
        return {row[0]: tuple(row[1:]) for row in self.held.get()} if self.held.exists() else {}

    def _keep(self, best: dict[int, tuple]) -> None:
        if best:
            self.held.put([(day, *scene) for day, scene in best.items()])
        else:
            self.held.clear()

    def _begin(self, day: int, last: int) -> None:
        self.span.update((day, last))
        if day <= last:
            self.handle.registerTimer((day + 1) * DAY_MS)

    def close(self) -> None:
        pass


def stream_days(
    scenes: DataFrame,
    areas: DataFrame,
    max_cloud: float = selection.MAX_CLOUD,
    lateness: str = LATENESS,
    catalog_url: str | None = None,
) -> DataFrame:
    """References of every closed (area, day) of ``areas`` (aoi_id, bbox, first_day, last_day), from a scene stream.

    ``areas`` have days of their own each, as ``area_spans`` gives them. A day closes when a scene below the cloud limit
    more than ``lateness`` past its end has come, wherever it lies; ``end_of_input`` closes the last ones.
    """
    instants = scenes.withColumn("dt", F.col("dt").cast("timestamp")).withWatermark("dt", lateness)
    spans = areas.select("aoi_id", F.unix_date("first_day").alias("first_day"), F.unix_date("last_day").alias("last_day"))
    pairs = best_of_closed_days(selection.eligible_scenes(instants, max_cloud), areas).join(spans, "aoi_id")
    rows = pairs.select(
        "aoi_id",
        F.window_time("day").alias("dt"),
        "first_day",
        "last_day",
        F.unix_date(F.to_date("day.start")).alias("day"),
        F.col("s.cloud_cover").alias("cloud"),
        F.unix_micros("s.dt").alias("micros"),
        F.col("s.item_id").alias("item_id"),
        F.to_json(F.struct("s.collection", "s.assets")).alias("rest"),
    )
    decided = rows.groupBy("aoi_id").transformWithStateInPandas(
        AreaDays(), _OUT, "append", "eventtime", initialState=spans.groupBy("aoi_id")
    )
    return _references(decided, areas, catalog_url)


def _references(decided: DataFrame, areas: DataFrame, catalog_url: str | None) -> DataFrame:
    assets = next(f.dataType.simpleString() for f in SparkSession.active().createDataFrame([], SCENE_SCHEMA).schema if f.name == "assets")
    scene = F.from_json("rest", _REST.format(assets))
    found = F.col("rest").isNotNull()
    told = decided.withColumn("scene", scene).withColumn("assets", F.col("scene.assets"))
    return told.join(areas.select("aoi_id", "bbox"), "aoi_id").select(
        "aoi_id",
        F.date_from_unix_date("day").alias("date"),
        F.when(found, "ok").otherwise("no_items").alias("status"),
        "bbox",
        F.timestamp_micros("micros").cast("timestamp_ntz").alias("item_datetime"),
        F.col("cloud").alias("cloud_cover"),
        F.when(found, F.lit(catalog_url).cast("string")).alias("stac_url"),
        F.col("scene.collection").alias("collection"),
        "item_id",
        F.when(found, pick_asset(F.col("assets"), RED_ASSETS)).alias("b04_asset"),
        F.when(found, pick_asset(F.col("assets"), NIR_ASSETS)).alias("b08_asset"),
    )


def area_spans(pairs: DataFrame) -> DataFrame:
    """(aoi_id, bbox, first_day, last_day) of the (aoi_id, bbox, date) rows to decide."""
    return pairs.groupBy("aoi_id").agg(F.first("bbox").alias("bbox"), F.min("date").alias("first_day"), F.max("date").alias("last_day"))


def end_of_input(spark: SparkSession, path: str, last_day: dt.date, lateness: str = LATENESS) -> None:
    """Tell the stream that reads ``path`` that no scene up to ``last_day`` will come: a row without a scene past its end."""
    after = F.lit(last_day).cast("timestamp_ntz") + F.expr(f"interval {lateness}") + F.expr("interval 1 day 1 second")
    names = spark.createDataFrame([], SCENE_SCHEMA).schema
    # filters may run before the watermark: the row passes all of them, and its footprint meets no area on Earth
    given = {"dt": after, "cloud_cover": F.lit(float("-inf")), **dict.fromkeys(("xmin", "ymin", "xmax", "ymax"), F.lit(1e6))}
    row = spark.range(1).select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in names])
    row.write.mode("append").parquet(path)


def write_days(references: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write the references of a stream into day folders, each once, and stop when caught up."""
    spark = references.sparkSession
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        writer = references.writeStream.format("json").outputMode("append").partitionBy(*keyed.BY_DAY).options(**keyed.JSON_OPTIONS)
        return writer.option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)
