"""Exact medians and quantiles that do not gather a group in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STEPS_PER_E = 64


def _bucket(value):
    """Order-preserving coarse bucket: signed logarithmic, at most ~90,000 in all.

    Never null for the values it is used on. The coalesce tells the planner so; it
    then adds no null filter on one side only, and the counts are shuffled once.
    """
    return F.coalesce(F.floor(F.signum(value) * F.log1p(F.abs(value)) * STEPS_PER_E).try_cast("int"), F.lit(0))


def grouped_median(df: DataFrame, keys: list[str], value: str, alias: str = "median") -> DataFrame:
    """Exact median of a numeric column per key; rows with a null key or value are left out."""
    return grouped_quantile(df, keys, value, 0.5, alias)


def grouped_quantile(df: DataFrame, keys: list[str], value: str, part: float, alias: str = "quantile") -> DataFrame:
    """Exact quantile of a numeric column per key, interpolated between the two values around its place.

    Rows with a null key or value are left out. Rows collapse to (key, value, count) before anything is ordered. A hot
    group then splits over value buckets, each about 1.6 % of the value wide: the bucket counts tell which one or two
    buckets hold the middle ranks, and only the distinct values of those are ordered. What one task sees of a group is
    its bucket list or the distinct values of one bucket, never its rows.
    """
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*keys, value]])
    counted = (
        df.where(present)
        .groupBy(*keys, F.col(value).alias("v"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("bucket", _bucket(F.col("v")))
    )

    by_bucket = Window.partitionBy(*keys).orderBy("bucket")
    whole = Window.partitionBy(*keys)
    # Places count from 1; the quantile lies between the values of the two whole places around it.
    place = F.lit(part) * (F.col("total") - 1) + 1
    low, high = F.floor(place), F.ceil(place)
    upto, before = F.col("upto"), F.col("upto") - F.col("n")
    holds = lambda rank: (before < rank) & (rank <= upto)

    targets = (
        counted.groupBy(*keys, "bucket")
        .agg(F.sum("n").alias("n"))
        .withColumn("upto", F.sum("n").over(by_bucket.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .withColumn("total", F.sum("n").over(whole))
        .withColumn("low", low)
        .withColumn("high", high)
        .where(holds(F.col("low")) | holds(F.col("high")))
        .select(*keys, "bucket", before.alias("skipped"), "low", "high", (place - low).alias("way"))
    )

    by_value = Window.partitionBy(*keys, "bucket").orderBy("v")
    middle = (
        counted.join(targets, [*keys, "bucket"])
        .withColumn(
            "upto",
            F.col("skipped") + F.sum("n").over(by_value.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        )
        .where(holds(F.col("low")) | holds(F.col("high")))
    )
    low_value, high_value = F.min("v").cast("double"), F.max("v").cast("double")
    if part == 0.5:
        return middle.groupBy(*keys).agg(((low_value + high_value) / 2).alias(alias))
    return middle.groupBy(*keys).agg((low_value + (high_value - low_value) * F.max("way")).alias(alias))


def quantile(df: DataFrame, value: str, part: float) -> Column:
    """The quantile of a whole frame's column, as a value for other expressions; null if there is none.

    At most one row for each bucket, 90,000 however many rows there are, comes together in one task.
    """
    return grouped_quantile(df, [], value, part, "quantile").select("quantile").scalar()
