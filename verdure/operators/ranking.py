"""Global numbering without a single-partition sort, and exact quantiles without any sort."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdure.session import materialize


def running_total(df: DataFrame, order: list[str], weight: Column, out: str) -> DataFrame:
    """Add ``out``: the sum of ``weight`` over all rows up to and including this one.

    Rows are range-partitioned on the (unique) ``order`` columns and summed within
    each range; only one total per range is combined across ranges. The ranges are
    written before use because sampled range bounds need not repeat on a re-run.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(
        df.withColumn("_w", weight.cast("long"))
        .repartitionByRange(ranges, *order)
        .withColumn("_range", F.spark_partition_id()),
        "ranged",
    )
    totals = ranged.groupBy("_range").agg(F.sum("_w").alias("_t"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_range", F.coalesce(F.sum("_t").over(earlier), F.lit(0)).alias("_before"))
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    # offsets has one row per range, never more than the shuffle partition count.
    return (
        ranged.join(F.broadcast(offsets), "_range")
        .withColumn(out, F.col("_before") + F.sum("_w").over(within))
        .drop("_range", "_w", "_before")
    )


def global_rank(df: DataFrame, order: list[str], out: str) -> DataFrame:
    """Number rows 1..n in the order of the unique ``order`` columns."""
    return running_total(df, order, F.lit(1), out)


def order_key(value: Column) -> Column:
    """A long that orders as the finite doubles do: exponent and fraction of the number, negated below zero; 0 and -0 are one."""
    size = F.abs(value)
    guess = F.floor(F.log2(size))
    # a logarithm may round to the next whole number
    power = guess + F.when(F.pow(F.lit(2.0), guess) > size, -1).otherwise(0) + F.when(F.pow(F.lit(2.0), guess + 1) <= size, 1).otherwise(0)
    fraction = (size / F.pow(F.lit(2.0), power) - 1) * F.lit(2.0**52)
    normal = (power + 1023) * F.lit(2**52) + fraction.cast("long")
    # below the smallest normal number the fraction alone tells
    key = F.when(size >= 2.0**-1022, normal).otherwise((size * F.lit(2.0**537) * F.lit(2.0**537)).cast("long"))
    return F.when(value < 0, -key).otherwise(key)


#: Bits right of the digit of each pass; a digit has twelve bits, so a pass gives at most 4096 counts.
RADIX_SHIFTS = (52, 40, 28, 16, 4, 0)


def exact_quantile(df: DataFrame, column: str, q: float) -> DataFrame:
    """One row ``quantile``: the linearly interpolated quantile of the non-null finite values.

    Radix selection: each pass counts the values that share the known front of the wanted key by their next bits, which
    combines before the shuffle, and takes the bucket with the wanted rank; at most six passes over the values, no sort and
    no shuffle of them. Empty input gives null.
    """
    value = F.col(column).cast("double")
    keys = df.where(F.col(column).isNotNull()).select(value.alias("v"), order_key(value).alias("key"))
    keys = materialize(keys, "quantile-keys")
    ends = keys.agg(F.count("*").alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi")).first()
    position = (ends["n"] - 1) * q if ends["n"] else 0.0
    low, share = math.floor(position), position - math.floor(position)
    rank, front, inside = low, 0, keys
    for shift in RADIX_SHIFTS if ends["n"] else ():
        if ends["lo"] >> shift == ends["hi"] >> shift:
            front = ends["lo"] >> shift
            continue
        digit = F.shiftright("key", shift)
        for row in inside.groupBy(digit.alias("digit")).agg(F.count("*").alias("n")).orderBy("digit").collect():
            if rank < row["n"]:
                front = row["digit"]
                break
            rank -= row["n"]
        inside = keys.where(digit == F.lit(front))
    # the wanted value, how many lie up to it, and the next larger one
    upto = F.col("key") <= F.lit(front)
    found = keys.agg(F.max(F.when(upto, F.col("v"))).alias("lo"), F.count_if(upto).alias("n"), F.min(F.when(~upto, F.col("v"))).alias("above"))
    higher = F.when(F.col("n") > low + 1, F.col("lo")).otherwise(F.coalesce("above", "lo"))
    return found.select((F.col("lo") + (higher - F.col("lo")) * F.lit(share)).alias("quantile"))
