"""FeatureCollection files read by many tasks.

The file is cut at every closing brace, wherever byte ranges begin, so any number of tasks read it. A structural index
then tells which cuts end a feature: per byte range, how many quotes and brackets lie in it for either state it may begin
in, combined over the ranges of a file in order, and from there range by range. A feature is the text between two such
cuts, put together from its pieces; what stands before the first and after the last holds the members of the collection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from verdure.session import materialize
from verdure.sources.fields import _FEATURE, PROPERTIES, _colons, _fields

_RANGE = ["file", "start"]
#: Outside of strings: brackets of each kind, and escapes taken out first.
_ESCAPED = r"\\."


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, no, text): the text between closing braces, in order within each byte range."""
    reader = spark.read.option("lineSep", "}").text(path)
    return reader.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("no"),
        F.col("value").alias("text"),
    )


def _net(bare: Column, opening: str, closing: str) -> Column:
    def count(sign: str) -> Column:
        return F.char_length(bare) - F.char_length(F.replace(bare, F.lit(sign), F.lit("")))

    return count(opening) - count(closing)


def _measured(pieces: DataFrame) -> DataFrame:
    """Pieces with the parity of their quotes, and their brackets if they begin outside (``o``) or inside (``i``) a string."""
    plain = F.regexp_replace("text", _ESCAPED, "")
    parts = F.split("plain", '"', -1)

    def kept(first: int) -> Column:
        # every other part between quotes lies outside of strings
        return F.array_join(F.filter(parts, lambda _, k: k % 2 == first), " ")

    bare = pieces.withColumn("plain", plain).withColumns({"bare_o": kept(0), "bare_i": kept(1), "quotes": (F.size(parts) + 1) % 2})
    counts = {f"{kind}_{state}": _net(F.col(f"bare_{state}"), *signs) for state in "oi" for kind, signs in (("braces", "{}"), ("brackets", "[]"))}
    # the brace that ends the piece counts where it stands outside of a string
    for state, ends_in in (("o", F.col("quotes")), ("i", 1 - F.col("quotes"))):
        counts[f"braces_{state}"] = counts[f"braces_{state}"] - (1 - ends_in)
    return bare.withColumns(counts).drop("plain", "bare_o", "bare_i")


def _indexed(measured: DataFrame) -> DataFrame:
    """Pieces with ``quoted`` (whether they begin inside a string) and the depth of braces and brackets after them."""
    per_range = Window.partitionBy(*_RANGE).orderBy("no")
    before = per_range.rowsBetween(Window.unboundedPreceding, -1)
    # first as if every range began outside of a string, with both outcomes at hand
    odd = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2
    marked = measured.withColumn("odd", odd)

    def of(state: Column, kind: str) -> Column:
        return F.when(state == 0, F.col(f"{kind}_o")).otherwise(F.col(f"{kind}_i"))

    totals = marked.groupBy(*_RANGE).agg(
        (F.sum("quotes") % 2).alias("parity"),
        *[F.sum(of(F.col("odd"), kind)).alias(f"{kind}_o") for kind in ("braces", "brackets")],
        *[F.sum(of(1 - F.col("odd"), kind)).alias(f"{kind}_i") for kind in ("braces", "brackets")],
    )
    # one row per byte range
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    entered = totals.withColumn("state", (F.coalesce(F.sum("parity").over(earlier), F.lit(0)) % 2).cast("int"))
    entered = entered.select("file", "start", "state", *[of(F.col("state"), kind).alias(kind) for kind in ("braces", "brackets")])
    depth = {kind: F.coalesce(F.sum(kind).over(earlier), F.lit(0)) for kind in ("braces", "brackets")}
    entered = materialize(entered.select("file", "start", "state", *[c.alias(f"{k}_before") for k, c in depth.items()]), "json-ranges")
    placed = marked.join(entered, _RANGE).withColumn("quoted", (F.col("odd") + F.col("state")) % 2)
    upto = per_range.rowsBetween(Window.unboundedPreceding, 0)
    return placed.select(
        "file", "start", "no", "text", "quotes", "quoted",
        *[(F.col(f"{kind}_before") + F.sum(of(F.col("quoted"), kind)).over(upto)).alias(kind) for kind in ("braces", "brackets")],
    )


def _features(pieces: DataFrame) -> DataFrame:
    """(file, number, text, whole): each feature's text with what stands before it, numbered per file; ``whole`` is false for the rest."""
    indexed = _indexed(_measured(pieces))
    # a feature ends at a brace outside of strings that leaves the collection's own brace and one bracket open
    ends = ((F.col("quotes") + F.col("quoted")) % 2 == 0) & (F.col("braces") == 1) & (F.col("brackets") == 1)
    marked = materialize(indexed.withColumn("ends", ends.cast("int")), "json-index")
    per_range = Window.partitionBy(*_RANGE).orderBy("no").rowsBetween(Window.unboundedPreceding, -1)
    counts = marked.groupBy(*_RANGE).agg(F.sum("ends").alias("n"))
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *_RANGE, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    numbered = marked.join(offsets, _RANGE).withColumn("number", F.col("before") + F.coalesce(F.sum("ends").over(per_range), F.lit(0)))
    # what stands after the last brace of a file has none: counting one has brought the depth below 0
    closed = F.when(F.col("braces") < 0, F.col("text")).otherwise(F.concat("text", F.lit("}")))
    return numbered.groupBy("file", "number").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "no", closed.alias("t")))), lambda x: x["t"]), "").alias("text"),
        (F.max("ends") > 0).alias("whole"),
    )


def read_collection_split(spark: SparkSession, path: str, properties: str = PROPERTIES) -> DataFrame:
    """As ``fields.read_feature_collection``, with every file read by as many tasks as it has byte ranges.

    A file is one object whose ``features`` are its only list of objects; other members may stand before or after it.
    """
    found = materialize(_features(_pieces(spark, path)), "json-features")
    schema = f"struct<crs: struct<type: string, properties: struct<name: string>>, features: array<struct<{_colons(_FEATURE)}>>>"
    options = {"mode": "FAILFAST"}
    # the first feature's text begins with the collection's head: closed, it is a collection of one
    first = F.from_json(F.concat("text", F.lit("]}")), schema, options)
    head = found.where("number = 0 and whole").select("file", first.alias("c"))
    rest = found.where("number > 0 and whole").select("file", "number", F.from_json(F.concat(F.lit('{"features":['), F.regexp_replace("text", r"^[\s,]+", ""), F.lit("]}")), schema, options).alias("c"))
    tail_text = F.concat(F.lit('{"features":['), "text")
    tails = found.where("not whole and number > 0").select("file", F.from_json(tail_text, schema, options)["crs"].alias("tail_crs"))
    kept = found.groupBy("file").agg(F.count_if("whole").alias("n"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    # one row per file
    files = kept.select("file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    files = files.join(head.select("file", F.col("c.crs").alias("head_crs")), "file", "left").join(tails, "file", "left")
    files = materialize(files.select("file", "before", F.coalesce("head_crs", "tail_crs").alias("crs")), "json-files")
    rows = head.withColumn("number", F.lit(0).cast("long")).unionByName(rest).select("file", "number", F.col("c.features")[0].alias("f"))
    joined = rows.join(files, "file").withColumn("ord", F.col("before") + F.col("number"))
    return _fields(joined, properties, F.col("crs.properties.name"))
