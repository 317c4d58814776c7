"""Joins whose frequent keys are dealt over many tasks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of one key that one task takes.
KEY_ROWS = 1_000_000


def spread_left_join(rows: DataFrame, lookup: DataFrame, keys: list[str], by: str, key_rows: int = KEY_ROWS) -> DataFrame:
    """A left join with a table that has one row per key, whatever share of the rows one key has.

    Keys with more than ``key_rows`` rows are found by a count, combined on the map side. Their rows are dealt over as
    many parts by a hash of column ``by``, and their lookup row is repeated for each part. There are at most (all rows
    / ``key_rows``) such keys, so their table is small.
    """
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    counts = rows.where(known).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > key_rows)
    parts = F.broadcast(counts.select(*keys, F.ceil(F.col("_n") / key_rows).cast("int").alias("_parts")))
    dealt = rows.join(parts, keys, "left").withColumn("_part", F.pmod(F.xxhash64(by), F.coalesce("_parts", F.lit(1))).cast("int"))
    copies = lookup.join(parts, keys, "left").withColumn(
        "_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))
    )
    return dealt.drop("_parts").join(copies.drop("_parts"), [*keys, "_part"], "left").drop("_part")
