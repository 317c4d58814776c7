"""Small reshaping of single-row results."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def side_by_side(*single_rows: DataFrame) -> DataFrame:
    """Single-row frames with different columns as one row.

    A union and a maximum per column, so no join is planned; a frame without a
    row leaves its columns null.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), single_rows)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def metric_rows(one_row: DataFrame, names, value_type: str) -> DataFrame:
    """One wide row to (position, metric, value) rows in the given order."""
    cells = [
        F.struct(
            F.lit(i).cast("bigint").alias("position"), F.lit(n).alias("metric"), F.col(n).cast(value_type).alias("value")
        )
        for i, n in enumerate(names, 1)
    ]
    return one_row.select(F.inline(F.array(*cells)))
