"""The whole job: raw feed to clean tables, KPI tables, insights and report."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.plans import insights as I
from skyledger.plans import kpis, metrics, model, quality, reports
from skyledger.plans.cleaning import Cleaned, clean
from skyledger.session import overlapping, stage, stage_all
from skyledger.sources import outputs
from skyledger.sources.feed import MALFORMED, malformed, read_feed


@dataclass(frozen=True)
class PipelineResult:
    cleaned: Cleaned
    flights: DataFrame
    bookings: DataFrame
    sales: DataFrame
    results: dict[str, DataFrame]
    insights: DataFrame
    checks: DataFrame


def run_sql(spark: SparkSession, sql: str, params: dict | None = None, **tables: DataFrame) -> DataFrame:
    """Parameterised SQL over named DataFrames: ``{name}`` for tables, ``:name`` for values."""
    return spark.sql(sql, args=params or {}, **tables)


def checked(rows: DataFrame) -> DataFrame:
    """The same rows, or an error at once that names every broken assumption."""
    quality.raise_if_any(quality.all_checks(rows))
    return rows


def run(spark: SparkSession, raw_path: str, folder: str, strict: bool = True, **params: dict) -> PipelineResult:
    """Read a raw CSV, write every output below ``folder``.

    Checks of the clean rows, the constraints of the stored tables and the reconciliation always run and are
    written to ``checks``; ``strict`` stops at what they find. The model is written beside the one that is there and
    takes its place when the constraints hold, so a run that stops leaves the old model to its readers.

    Large tables are written once each: prepared rows, clean rows and the two model
    tables. Sales, which four KPI queries and the panels share, are columns of the clean
    rows if the rows of each flight agree; only if some don't are bookings and flights joined.
    """
    raw, seen = read_feed(spark, raw_path, strict=strict), None
    if not strict:
        raw, seen = malformed(raw)
    cleaned = clean(raw)
    rows, found = quality.written_with_checks(cleaned.rows, "clean")
    found = found.withColumn("stage", F.lit("clean"))
    if seen:
        lines = [(i, f"{kind}_rows", int(seen.get[f"{kind}_rows"]), "feed") for i, kind in enumerate(MALFORMED, 1)]
        found = found.unionByName(spark.createDataFrame(lines, found.schema))
    checks = stage(found, "checks")
    if strict:
        quality.raise_if_any(checks)
    flights, bookings = model.write_candidate(model.split_flights(rows), model.split_bookings(rows), f"{folder}/model")
    stored = {
        "not_null": quality.flight_constraints(flights),
        "keys": quality.keys_as_checks(quality.primary_key_violations(flights, bookings)),
    }
    constraints = stage_all({name: df.withColumn("stage", F.lit(name)) for name, df in stored.items()})
    if strict:
        for found in constraints.values():
            quality.raise_if_any(found)
    model.release(spark, f"{folder}/model")
    if checks.where("metric = 'inconsistent_flights' AND value > 0").isEmpty():
        sales = model.sales_of_rows(rows, "is_cancelled")
    else:
        sales = stage(model.enrich_bookings(bookings, flights, "is_cancelled"), "sales")

    results = stage_all(kpis.run_all(flights, sales, **params))
    compared = stage_all(
        {
            "headline": quality.reconcile_headline(metrics.executive_metrics(flights, bookings), results["executive_kpis"]),
            "by_airline": quality.reconcile_by_airline(
                metrics.flight_metrics(flights, "airline"), results["airline_performance"]
            ),
        }
    )
    if strict:
        quality.raise_if_apart(*compared.values())
    apart = [
        df.agg(F.count_if(~F.col("agrees")).alias("value")).select(
            F.lit(0).alias("position"), F.lit(f"{name}_apart").alias("metric"), "value", F.lit("reconciled").alias("stage")
        )
        for name, df in compared.items()
    ]
    checks = stage(reduce(DataFrame.unionByName, [checks, *constraints.values(), *apart]), "checks")
    insights = stage(I.all_insights(results), "insights")
    report = stage(cleaned.report, "report")

    outputs.write_clean_outputs(rows, flights, bookings, report, f"{folder}/processed")
    outputs.write_tables(results, f"{folder}/kpis")
    outputs.write_insights(insights, f"{folder}/insights")
    outputs.write_csv(checks, f"{folder}/checks")
    write_report(results, insights, report, f"{folder}/report")
    return PipelineResult(cleaned, flights, bookings, sales, results, insights, checks)


def write_report(results: dict[str, DataFrame], insights: DataFrame, cleaning: DataFrame, folder: str) -> None:
    placed = [
        (reports.sheet_path(folder, sheet, name), table)
        for sheet, tables in reports.report_tables(results, insights, cleaning).items()
        for name, table in tables.items()
    ]
    overlapping(lambda item: outputs.write_csv(item[1], item[0]), placed)
