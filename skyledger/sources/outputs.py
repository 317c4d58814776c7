"""Writing results as CSV, JSON and text, and reading them back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger import constants as K
from skyledger.plans.cleaning import in_report_order
from skyledger.session import overlapping


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; values keep their surrounding spaces."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


def write_clean_outputs(rows: DataFrame, flights: DataFrame, bookings: DataFrame, report: DataFrame, folder: str) -> None:
    """The clean rows in report order, both model tables, and the cleaning report."""
    write_csv(in_report_order(rows).drop("src_row", "cabin_rank"), f"{folder}/clean")
    write_csv(flights, f"{folder}/flights")
    write_csv(bookings, f"{folder}/bookings")
    write_report_json(report, f"{folder}/cleaning_report")


def write_report_json(report: DataFrame, path: str) -> None:
    """One JSON object with a field per counter."""
    wide = report.groupBy().pivot("metric", list(K.REPORT_COUNTERS)).agg(F.first("value"))
    wide.write.mode("overwrite").json(path)


def read_report_json(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.LongType()) for c in K.REPORT_COUNTERS])
    return spark.read.schema(schema).json(path)


def write_tables(tables: dict[str, DataFrame], folder: str) -> None:
    """Each result to its own CSV folder."""
    overlapping(lambda item: write_csv(item[1], f"{folder}/{item[0]}"), tables.items())


def read_cells(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """(row_no, column_name, text, number) of a written result, a row per cell with a value, in file order.

    For results, which are small: the rows are numbered in one task.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    place = ("_file", "_block", "_row")
    numbered = (
        read_csv(spark, path, schema)
        .select(
            "*",
            F.col("_metadata.file_name").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_row"),
        )
        .withColumn("row_no", F.row_number().over(Window.orderBy(*place)).cast("bigint"))
    )
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("value")) for c in columns]
    number = F.col("value").try_cast("double")
    return (
        numbered.select("row_no", F.inline(F.array(*cells)))
        .where(F.col("value").isNotNull())
        .select("row_no", "column_name", F.when(number.isNull(), F.col("value")).alias("text"), number.alias("number"))
    )


def write_insights(insights: DataFrame, path: str) -> None:
    """A heading and a text list in insight order (at most eight lines, so one file)."""
    heading = F.when(F.col("first"), F.array(F.lit(K.INSIGHTS_HEADING), F.lit(""))).otherwise(F.array().cast("array<string>"))
    lines = (
        insights.coalesce(1)
        .sortWithinPartitions("insight_no")
        .withColumn("first", F.col("insight_no") == 1)
        .select(F.explode(F.concat(heading, F.array(F.concat(F.lit("- "), F.col("text"))))).alias("value"))
    )
    lines.write.mode("overwrite").text(path)
