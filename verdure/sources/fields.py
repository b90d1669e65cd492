"""Field polygons and areas as GeoJSON and JSON files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdure.functions import geometry
from verdure.operators.ranking import global_rank
from verdure.sources.keyed import write_json

PROPERTIES = "field_id string, planting_date string"
AOI_SCHEMA = "aoi_id string, bbox array<double>"
RESERVED = {"ord", "crs", "geom", "properties"}
_MEMBERS = "map<string, variant>"
_FEATURE = "type string, id string, properties string, geometry struct<type: string, coordinates: string>"


def _fields(features: DataFrame, properties: str, crs: Column) -> DataFrame:
    """Rows of ``f`` with the asked properties as columns and all of them as JSON text."""
    geom = geometry.from_geojson(F.col("f.geometry.type"), F.col("f.geometry.coordinates"))
    asked = [
        F.get_json_object("f.properties", f"$['{p.name}']").cast(p.dataType).alias(p.name)
        for p in T.StructType.fromDDL(properties)
    ]
    rows = features.select(
        F.col("ord").cast("long").alias("ord"), *asked, F.col("f.properties").alias("properties"), crs.alias("crs"), geom.alias("geom")
    )
    return rows.withColumn("geom", geometry.normalize_crs(F.col("geom"), F.col("crs")))


def read_feature_collection(
    spark: SparkSession, path: str, properties: str = PROPERTIES
) -> DataFrame:
    """One row per feature of GeoJSON FeatureCollection files, in degrees.

    The properties named by ``properties`` become columns; ``properties`` keeps all of them as JSON text. ``ord``
    is the position, counted on through the files of a folder in the order of their paths. A file is one JSON
    document and is parsed by one task; large field sets belong in line-delimited GeoJSON or Parquet.
    """
    schema = f"crs struct<type: string, properties: struct<name: string>>, features array<struct<{_colons(_FEATURE)}>>"
    raw = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)
    raw = raw.select("crs", "features", F.col("_metadata.file_path").alias("file"))
    # one row per file
    counts = raw.groupBy("file").agg(F.sum(F.coalesce(F.size("features"), F.lit(0))).alias("n"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    features = raw.join(before, "file").select("crs", "before", F.posexplode("features").alias("pos", "f"))
    return _fields(features.withColumn("ord", F.col("before") + F.col("pos")), properties, F.col("crs.properties.name"))


def _colons(ddl: str) -> str:
    """Top-level fields of a DDL text in the notation of a struct."""
    return ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in T.StructType.fromDDL(ddl))


def read_feature_lines(
    spark: SparkSession, path: str, properties: str = PROPERTIES, crs: str | None = None
) -> DataFrame:
    """One row per line of line-delimited GeoJSON.

    ``ord`` is the feature ``id`` where every feature has a whole number of its own; otherwise rows are numbered by
    file, id and content.
    """
    raw = spark.read.schema(_FEATURE).option("mode", "FAILFAST").json(path)
    rows = raw.select(F.struct("*").alias("f"), F.col("_metadata.file_path").alias("file"))
    whole = F.col("f.id").try_cast("long")
    told = rows.agg(F.count(F.lit(1)), F.count(whole), F.count_distinct(whole)).first()
    if told[0] == told[1] == told[2]:
        return _fields(rows.withColumn("ord", whole), properties, F.lit(crs).cast("string"))
    named = rows.select(
        "f",
        "file",
        F.col("f.id").alias("id"),
        F.to_json(F.struct("f.properties", "f.geometry")).alias("text"),
    )
    numbered = global_rank(named.fillna("", ["id"]), ["file", "id", "text"], "n").withColumn("ord", F.col("n") - 1)
    return _fields(numbered, properties, F.lit(crs).cast("string"))


def require_property(fields: DataFrame, *names: str) -> DataFrame:
    """Fail when no feature of a file that has some carries a property at all."""
    held = F.map_keys(F.from_json(F.coalesce("properties", F.lit("{}")), _MEMBERS))
    found = fields.select(*[F.max(F.array_contains(held, n)).alias(n) for n in names]).first()
    missing = [n for n in names if found[n] is False]
    if missing:
        raise ValueError(f"no feature has the property {missing}")
    return fields


def feature_text(fields: DataFrame) -> Column:
    """GeoJSON text of one feature; date and time columns are written as ISO seconds."""

    def member(field: T.StructField) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            column = F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss")
        return column.alias(field.name)

    members = [member(f) for f in fields.schema.fields if f.name not in RESERVED]
    properties = F.to_json(F.struct(*members), {"ignoreNullFields": "false"})
    if "properties" in fields.columns:
        properties = F.to_json(_merged(fields, properties), {"ignoreNullFields": "false"})
    return F.format_string(
        '{"type":"Feature","id":%d,"properties":%s,"geometry":%s}',
        F.col("ord"),
        properties,
        geometry.to_geojson(F.col("geom")),
    )


def _merged(fields: DataFrame, members: Column) -> Column:
    """All properties a feature came with, under the values of the columns; no null is made up for an absent one."""
    came = F.from_json(F.coalesce("properties", F.lit("{}")), _MEMBERS)
    now = F.from_json(members, _MEMBERS)
    names = [f.name for f in fields.schema.fields if f.name not in RESERVED]
    empty = F.filter(F.array(*[F.when(F.col(n).isNull(), F.lit(n)) for n in names]), lambda n: n.isNotNull())
    told = F.map_filter(now, lambda k, _: ~F.array_contains(empty, k) | F.map_contains_key(came, k))
    return F.map_concat(F.map_filter(came, lambda k, _: ~k.isin(*names)), told)


def write_feature_lines(fields: DataFrame, path: str, mode: str = "overwrite") -> None:
    fields.select(feature_text(fields).alias("value")).write.mode(mode).text(path)


def read_aois(spark: SparkSession, path: str) -> DataFrame:
    """(aoi_id, bbox) from JSON lines, as ``write_aois`` leaves them."""
    return spark.read.schema(AOI_SCHEMA).option("mode", "FAILFAST").json(path)


def read_aoi_array(spark: SparkSession, path: str) -> DataFrame:
    """(aoi_id, bbox) from a file holding one JSON array."""
    return (
        spark.read.schema(AOI_SCHEMA).option("multiLine", True).option("mode", "FAILFAST").json(path)
    )


def write_aois(aois: DataFrame, path: str, mode: str = "overwrite") -> None:
    write_json(aois.select("aoi_id", "bbox"), path, mode)
