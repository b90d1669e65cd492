"""Raster bands as row strips: (item_id, band, row, col0, layer, values).

A strip holds the cells of one row from ``col0`` on and may be of any width and start. Cells seen several times
have one strip per ``layer``; the layers of a cell are the same observations in all bands.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from verdure.operators.mask import STRIP

STRIP_SCHEMA = "item_id string, band string, row long, col0 long, layer int, values array<double>"


def read_strips(spark: SparkSession, path: str) -> DataFrame:
    """Strip table; a broken file fails the query rather than reading as nodata."""
    strips = spark.read.schema(STRIP_SCHEMA).option("mode", "FAILFAST").parquet(path)
    return strips.withColumn("layer", F.coalesce("layer", F.lit(0)))


def write_strips(strips: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Keep strips in a folder per band and scene, so a run opens only those it visits."""
    strips.write.mode(mode).partitionBy("band", "item_id").parquet(path)


def to_strips(
    pixels: DataFrame, width: int = STRIP, observation: list[str] | None = None, shift: int = 0
) -> DataFrame:
    """Gather long pixels (item_id, band, row, col, raw) into strips of ``width`` columns, the first border at ``shift``.

    ``observation`` names the columns that tell several observations of a cell apart; they become layers in that
    order. Without it a cell that comes twice fails the query. A cell without a value is null.
    """
    cell = ["item_id", "row", "col"]
    if observation:
        order = Window.partitionBy(*cell).orderBy(*observation)
        pixels = pixels.withColumn("layer", (F.dense_rank().over(order) - 1).cast("int"))
    else:
        pixels = pixels.withColumn("layer", F.lit(0))
    # the cells there are, in order, each after the empty ones before it: no look into the map for every column;
    # a map also tells a cell that comes twice. Without a column there are no values
    by_col = F.map_from_entries(F.collect_list(F.struct("col", "raw")))
    cells = (
        pixels.withColumn("col0", F.floor((F.col("col") - shift) / width) * width + shift)
        .groupBy("item_id", "band", "row", "col0", "layer")
        .agg(F.when(F.col("col0").isNotNull(), F.array_sort(F.map_entries(by_col))).alias("cells"))
    )
    last = F.col("col0") + width - 1

    def empty(n: Column) -> Column:
        return F.array_repeat(F.lit(None), n.cast("int"))

    def after_gap(cell: Column, i: Column) -> Column:
        before = F.coalesce(F.get("cells", i - 1)["key"], F.col("col0") - 1)
        return F.concat(empty(cell["key"] - before - 1), F.array(cell["value"]))

    rest = empty(last - F.element_at("cells", -1)["key"])
    values = F.concat(F.flatten(F.transform("cells", after_gap)), rest)
    return cells.select("item_id", "band", "row", "col0", "layer", values.alias("values"))


def scan_pixels(
    strips: DataFrame,
    bands: Sequence[str],
    rows: tuple[int, int] | None = None,
    cols: tuple[int, int] | None = None,
) -> DataFrame:
    """Long pixels of some bands, limited to an inclusive window of rows and columns.

    Bands and rows are pruned in the scan; of a strip only the wanted slice is
    unpacked.
    """
    wanted = strips.where(F.col("band").isin(*bands))
    if rows is not None:
        wanted = wanted.where(F.col("row").between(*rows))
    first: Column = F.col("col0")
    values: Column = F.col("values")
    if cols is not None:
        end = F.col("col0") + F.size("values") - 1
        wanted = wanted.where((F.col("col0") <= cols[1]) & (end >= cols[0]))
        first = F.greatest(F.col("col0"), F.lit(cols[0]))
        count = F.least(end, F.lit(cols[1])) - first + 1
        values = F.slice(
            "values", (first - F.col("col0") + 1).cast("int"), count.cast("int")
        )
    return wanted.select(
        "item_id", "band", "row", "layer", first.alias("first"), F.posexplode(values).alias("i", "raw")
    ).select("item_id", "band", "row", (F.col("first") + F.col("i")).alias("col"), "layer", "raw")
