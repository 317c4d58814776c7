"""Report tables: which result goes on which sheet, in which order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators.rows import metric_rows
from skyledger.sources import outputs

HEADLINES = (
    "total_flights",
    "total_passengers",
    "total_revenue",
    "avg_fare",
    "on_time_rate",
    "avg_delay_minutes",
    "cancellation_rate",
    "cancelled_flights",
)

# Sheet -> tables in order.
SHEETS = {
    "Executive Summary": ("headline_kpis", "insights", "cleaning_report"),
    "Airline Performance": ("airline_performance", "delay_by_time_of_day", "monthly_trends"),
    "Route Analysis": (
        "high_demand_poor_performance", "top_delayed_routes", "route_performance", "route_airline_breakdown",
    ),
    "Airport Analysis": ("airport_performance", "airport_seasonality", "delay_by_hour"),
    "Passenger Analysis": ("monthly_passengers", "cabin_class_summary"),
    "Revenue Analysis": ("airline_revenue", "top_revenue_routes", "cabin_revenue"),
}


def headline_rows(executive_kpis: DataFrame) -> DataFrame:
    return metric_rows(executive_kpis, HEADLINES, "double")


def cabin_revenue(cabin_class_summary: DataFrame) -> DataFrame:
    return cabin_class_summary.select("cabin_class", "revenue", "revenue_share", "avg_ticket_price")


def report_tables(results: dict[str, DataFrame], insights: DataFrame, cleaning: DataFrame) -> dict[str, dict[str, DataFrame]]:
    """Sheet -> table name -> result."""
    extra = {
        "headline_kpis": headline_rows(results["executive_kpis"]),
        "insights": insights,
        "cleaning_report": cleaning,
        "cabin_revenue": cabin_revenue(results["cabin_class_summary"]),
    }
    available = {**results, **extra}
    return {sheet: {name: available[name] for name in names} for sheet, names in SHEETS.items()}


def sheet_path(folder: str, sheet: str, table: str) -> str:
    return f"{folder}/sheet={sheet.replace(' ', '_')}/table={table}"


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """(sheet, position, table_name, rows) of a written report, counted from its files."""
    placed = [
        (sheet, position, name) for sheet, names in SHEETS.items() for position, name in enumerate(names, 1)
    ]
    counted = None
    for sheet, position, name in placed:
        one = (
            spark.read.option("header", True)
            .csv(sheet_path(folder, sheet, name))
            .agg(F.count(F.lit(1)).alias("rows"))
            .select(
                F.lit(sheet).alias("sheet"), F.lit(position).cast("bigint").alias("position"), F.lit(name).alias("table_name"), "rows"
            )
        )
        counted = one if counted is None else counted.unionByName(one)
    return counted


def read_cells(spark: SparkSession, folder: str, tables: dict[str, dict[str, DataFrame]]) -> DataFrame:
    """(sheet, table_name, row_no, column_name, text, number): every value of a written report."""
    found = [
        outputs.read_cells(spark, sheet_path(folder, sheet, name), table.columns).select(
            F.lit(sheet).alias("sheet"), F.lit(name).alias("table_name"), "*"
        )
        for sheet, named in tables.items()
        for name, table in named.items()
    ]
    return reduce(DataFrame.unionByName, found)
