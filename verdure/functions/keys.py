"""Object addresses and partition paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_uri(uri: Column) -> Column:
    """struct(bucket, key) of ``s3://bucket/key``; a URI without a key fails the query.

    The first five characters are skipped without a look, the bucket ends at the
    next slash and the key keeps all further slashes.
    """
    rest = F.substring(uri, 6, 2147483647)
    cut = F.instr(rest, "/")
    message = F.concat(F.lit("no key in URI: "), uri)
    return F.when(
        cut > 0,
        F.struct(
            F.left(rest, cut - 1).alias("bucket"),
            F.substr(rest, cut + 1).alias("key"),
        ),
    ).when(uri.isNotNull(), F.raise_error(message).cast("struct<bucket:string,key:string>"))


def prefix_path(prefix: str) -> str:
    """Prefix with exactly one trailing slash."""
    return prefix.rstrip("/") + "/"


def reference_path(prefix: str, aoi_id: Column, date: Column) -> Column:
    """Path of one scene reference: by area, then by day."""
    return F.concat(
        F.lit(prefix_path(prefix) + "aoi_id="), aoi_id, F.lit("/date="), date, F.lit("/s2_refs.json")
    )


def ndvi_path(prefix: str, aoi_id: Column, date: Column) -> Column:
    """Path of one result: by day, then by area."""
    return F.concat(
        F.lit(prefix_path(prefix) + "aoi_timeseries/date="),
        date,
        F.lit("/aoi_id="),
        aoi_id,
        F.lit("/ndvi.json"),
    )
