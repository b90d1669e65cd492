"""Lookups that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 16


def salted_lookup(
    rows: DataFrame,
    table: DataFrame,
    keys: list[str],
    how: str = "inner",
    by: list[str] | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Join ``rows`` to a smaller ``table`` of few rows per key.

    A hot key of ``rows`` is spread over ``salts`` reducers by the hash of the columns
    ``by`` (all by default), which must tell the rows of one key apart; ``table`` is repeated once
    per salt, so every row meets all its matches exactly once. ``how`` may be inner,
    left, left_semi or left_anti. A ``table`` that Spark will send to all tasks has no reducers
    to spread and is not repeated: the copies would all pass through the driver.
    """
    if sent_along(table):
        return rows.join(table, keys, how)
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*(by or rows.columns)), F.lit(salts)).cast("int"))
    spread = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(spread, [*keys, "_salt"], how).drop("_salt")


def sent_along(table: DataFrame) -> bool:
    """Whether Spark, by its own estimate, broadcasts ``table`` to a join."""
    limit = table.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= limit


ROWS_PER_SALT = 50_000


def measured_salts(rows: DataFrame, keys: list[str], per_salt: int = ROWS_PER_SALT) -> int:
    """How many salts the fullest key of ``rows`` needs; 1 where none is crowded, so nothing is repeated."""
    fullest = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    return max(1, -(-fullest // per_salt))
