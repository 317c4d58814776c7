"""Conditions that stop a computation from within its own plan, without an action before it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _unknown(data_type: T.DataType) -> Column:
    """A value of the type that the planner cannot know."""
    number = F.monotonically_increasing_id()
    day = F.date_from_unix_date(number.cast("int"))
    by_type = {T.BooleanType: number > 0, T.DateType: day, T.TimestampType: day.cast("timestamp"), T.TimestampNTZType: day.cast("timestamp_ntz")}
    return by_type.get(type(data_type), number.cast(data_type))


def stop_if(df: DataFrame, found: DataFrame, broken: Column, message: Column) -> DataFrame:
    """The same rows, or an error with the message when they are computed and the condition holds.

    ``found`` is one row, an aggregate without keys, which no plan can leave out. A filter raises the error or takes
    the row away. What would be its columns are values that the planner does not know, so no later filter can rule
    them out beforehand. Columns are numbers, texts, dates, times and booleans.
    """
    error = F.raise_error(message).cast("boolean")
    passed = found.where(F.when(broken, error).otherwise(F.lit(False))).limit(1)
    return df.unionByName(passed.select(*[_unknown(f.dataType).alias(f.name) for f in df.schema.fields]))
