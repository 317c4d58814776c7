"""Row numbers and ranks over a whole frame without bringing it into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.session import stage

IN_PART = (1 << 33) - 1


def numbered(df: DataFrame, *order: Column, name: str = "row_no", total: str | None = None) -> DataFrame:
    """Rows numbered from 1 in the given order, which should leave no ties; ``total`` adds the number of rows.

    The rows are range-sorted and written once with their place in their part. The parts' sizes, one row each, give
    what comes before a part.
    """
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_nth", F.monotonically_increasing_id().bitwiseAND(IN_PART) + 1)
    )
    rows = stage(placed, "numbered")
    parts = Window.partitionBy().orderBy("_part")
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    starts = sizes.select(
        "_part",
        (F.sum("_size").over(parts) - F.col("_size")).alias("_before"),
        *([F.sum("_size").over(Window.partitionBy()).alias(total)] if total else []),
    )
    # One row for each part of the sort: never more than there are shuffle partitions.
    return rows.join(F.broadcast(starts), "_part").withColumn(name, F.col("_before") + F.col("_nth")).drop("_part", "_nth", "_before")


def ranked(df: DataFrame, value: str, *then: Column, name: str = "rank") -> DataFrame:
    """Rank by a column, greatest first, nulls last; equal values share the first number of theirs.

    ``then`` orders rows of equal value, so many equal ones are spread over tasks. Only values that repeat meet a join.
    """
    rows = numbered(df, F.desc_nulls_last(value), *then, name=name)
    ties = rows.groupBy(F.col(value).alias("_value")).agg(F.min(name).alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    shared = rows.join(ties.drop("_n"), F.col(value).eqNullSafe(F.col("_value")), "left")
    return shared.withColumn(name, F.coalesce("_first", name)).drop("_value", "_first")
