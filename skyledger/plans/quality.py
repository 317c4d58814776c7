"""Checks on clean rows and model tables, each a small table of violation counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from skyledger import constants as K
from skyledger.operators.guards import stop_if
from skyledger.operators.rows import metric_rows, side_by_side
from skyledger.plans.model import NOT_NULL_FLIGHT
from skyledger.session import stage

SHARED_ATTRIBUTES = ("airline", "origin", "destination", "is_cancelled", "delay_minutes")


BROKEN = "clean rows break"


class DataQualityError(ValueError):
    """Clean data breaks an assumption of the analysis."""


def _count(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def required_nulls(rows: DataFrame) -> DataFrame:
    """(position, metric = column, value = nulls) for the required columns, in one pass."""
    counts = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in K.REQUIRED_COLUMNS])
    return metric_rows(counts, K.REQUIRED_COLUMNS, "bigint")


def duplicate_keys(rows: DataFrame) -> DataFrame:
    """(flight_id, cabin_class, copies) that occur more than once."""
    return (
        rows.groupBy("flight_id", "cabin_class")
        .agg(F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > 1)
    )


def unknown_cabins(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count_if(~_known()).alias("unknown_cabins"))


def out_of_range(rows: DataFrame) -> DataFrame:
    """A missing value is out of range too."""
    return rows.agg(
        F.count_if(~F.coalesce(F.col("passengers") >= 0, F.lit(False))).alias("bad_passengers"),
        F.count_if(~F.coalesce(F.col("ticket_price") > 0, F.lit(False))).alias("bad_prices"),
    )


def operated_without_delay(rows: DataFrame) -> DataFrame:
    return rows.agg(
        _count((F.col("is_cancelled") == 0) & F.col("delay_minutes").isNull()).alias("operated_without_delay")
    )


def cancelled_with_passengers(rows: DataFrame) -> DataFrame:
    empty = F.coalesce(F.col("passengers") == 0, F.lit(False))
    return rows.agg(_count((F.col("is_cancelled") != 0) & ~empty).alias("cancelled_with_passengers"))


def _fingerprints(*columns: str) -> list[Column]:
    """Two independent 64-bit hashes of values, in which null is a value of its own."""
    marked = [part for c in columns for part in (F.col(c).isNull(), F.col(c))]
    return [F.xxhash64(F.lit("first"), *marked), F.xxhash64(F.lit("second"), *marked)]


def _ends(name: str, *columns: str) -> list[Column]:
    """Least and greatest of both fingerprints: numbers of fixed width, which a hash aggregate can hold."""
    return [f(h).alias(f"{name}_{end}_{i}") for i, h in enumerate(_fingerprints(*columns)) for end, f in (("low", F.min), ("high", F.max))]


def _differ(name: str) -> Column:
    """Rows that differ would have to agree by chance in both fingerprints to be missed."""
    return reduce(lambda a, b: a | b, [F.col(f"{name}_low_{i}") != F.col(f"{name}_high_{i}") for i in (0, 1)])


def inconsistent_flights(rows: DataFrame) -> DataFrame:
    """Flights whose attributes differ between their rows, counted per attribute.

    Fingerprints decide it, so nothing distinct is gathered and no text is compared or sorted.
    """
    per_flight = (
        rows.where(F.col("flight_id").isNotNull())
        .groupBy("flight_id")
        .agg(*[end for c in SHARED_ATTRIBUTES for end in _ends(c, c)])
    )
    counts = per_flight.agg(*[F.count_if(_differ(c)).alias(c) for c in SHARED_ATTRIBUTES])
    return metric_rows(counts, SHARED_ATTRIBUTES, "bigint")


ALL_CHECKS = (
    "required_nulls",
    "duplicate_keys",
    "unknown_cabins",
    "out_of_range",
    "operated_without_delay",
    "cancelled_with_passengers",
    "inconsistent_flights",
)


def _known() -> Column:
    return F.coalesce(F.col("cabin_class").isin(*K.CABINS), F.lit(False))


def row_counters() -> dict[str, Column]:
    """The checks that a row breaks by itself, as counters over any rows."""
    nulls = reduce(lambda a, b: a + b, [F.col(c).isNull().cast("bigint") for c in K.REQUIRED_COLUMNS])
    out = ~F.coalesce(F.col("passengers") >= 0, F.lit(False)) | ~F.coalesce(F.col("ticket_price") > 0, F.lit(False))
    sold = ~F.coalesce(F.col("passengers") == 0, F.lit(False))
    return {
        "required_nulls": F.coalesce(F.sum(nulls), F.lit(0)),
        "unknown_cabins": F.count_if(~_known()),
        "out_of_range": F.count_if(out),
        "operated_without_delay": _count((F.col("is_cancelled") == 0) & F.col("delay_minutes").isNull()),
        "cancelled_with_passengers": _count((F.col("is_cancelled") != 0) & sold),
    }


def _by_flight(rows: DataFrame, **more: Column) -> DataFrame:
    """One row: repeated keys and inconsistent flights, with what else is counted on the way.

    One aggregate by flight, of counters and fingerprints only, which hashes. The known cabins are counted side by
    side in it; rows of other cabins, mostly none, are grouped by themselves.
    """
    per_cabin = [F.count_if(F.col("cabin_class") == cabin).alias(f"cabin_{i}") for i, cabin in enumerate(K.CABINS)]
    per_flight = rows.groupBy("flight_id").agg(*per_cabin, *_ends("all", *SHARED_ATTRIBUTES), *[c.alias(n) for n, c in more.items()])
    repeated = [F.count_if(F.col(f"cabin_{i}") > 1) for i in range(len(K.CABINS))]
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    one = per_flight.agg(
        reduce(lambda a, b: a + b, repeated).alias("repeated_known"),
        F.count_if(F.col("flight_id").isNotNull() & _differ("all")).alias("inconsistent_flights"),
        *[total(n).alias(n) for n in more],
    )
    other = duplicate_keys(rows.where(~_known())).agg(F.count(F.lit(1)).alias("repeated_other"))
    return side_by_side(one, other).withColumn("duplicate_keys", F.col("repeated_known") + F.col("repeated_other"))


def all_checks(rows: DataFrame) -> DataFrame:
    """Every check in one result, (position, metric = check, value = violations)."""
    return metric_rows(_by_flight(rows, **row_counters()), ALL_CHECKS, "bigint")


def written_with_checks(rows: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """Write the rows and count what they break on the way; (stored rows, checks as ``all_checks`` gives them).

    The counters are observed in the tasks that write, above all shuffles, and Spark takes them from the one attempt
    of a task that it accepts: tasks that fail or run twice don't count twice. Only repeated keys and inconsistent
    flights need rows to meet; they read the few columns they need of the stored rows.
    """
    seen = Observation(f"{label}_checks")
    stored = stage(rows.observe(seen, *[c.alias(n) for n, c in row_counters().items()]), label)
    counted = {name: int(seen.get.get(name) or 0) for name in row_counters()}
    found = _by_flight(stored).withColumns({name: F.lit(value) for name, value in counted.items()})
    return stored, metric_rows(found, ALL_CHECKS, "bigint")


def guarded(rows: DataFrame) -> DataFrame:
    """The same rows, or an error when they are computed that names a check they break; no action of its own.

    A row that breaks a check by itself stops its task at once; the checks between rows are a guard in the plan.
    """
    sold = ~F.coalesce(F.col("passengers") == 0, F.lit(False))
    in_range = F.coalesce(F.col("passengers") >= 0, F.lit(False)) & F.coalesce(F.col("ticket_price") > 0, F.lit(False))
    broken = (
        F.when(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in K.REQUIRED_COLUMNS]), "required_nulls")
        .when(~_known(), "unknown_cabins")
        .when(~in_range, "out_of_range")
        .when((F.col("is_cancelled") == 0) & F.col("delay_minutes").isNull(), "operated_without_delay")
        .when((F.col("is_cancelled") != 0) & sold, "cancelled_with_passengers")
    )
    error = F.raise_error(F.concat(F.lit(f"{BROKEN}: "), broken)).cast("boolean")
    alone = rows.where(F.when(broken.isNotNull(), error).otherwise(F.lit(True)))
    both = ("duplicate_keys", "inconsistent_flights")
    names = F.concat_ws(", ", *[F.when(F.col(c) > 0, F.lit(c)) for c in both])
    return stop_if(alone, _by_flight(rows), names != "", F.concat(F.lit(f"{BROKEN}: "), names))


def keys_as_checks(violations: DataFrame) -> DataFrame:
    """Primary key violations as rows like those of the other checks."""
    names = ("duplicate_keys", "null_keys")
    position = {"flights": 0, "bookings": len(names)}
    start = F.when(F.col("table_name") == "flights", position["flights"]).otherwise(position["bookings"])
    rows = F.array(
        *[F.struct((start + i).alias("position"), F.lit(n).alias("kind"), F.col(n).alias("value")) for i, n in enumerate(names)]
    )
    found = violations.select("table_name", F.inline(rows))
    return found.select("position", F.concat_ws("_", "table_name", "kind").alias("metric"), "value")


def raise_if_any(checks: DataFrame) -> None:
    """Fail loudly; only the handful of non-zero check rows reach the driver."""
    broken = checks.where(F.col("value") > 0).orderBy("position").collect()
    if broken:
        raise DataQualityError("; ".join(f"{r['metric']}: {r['value']}" for r in broken))


# --- constraints of the stored tables ---------------------------------------


def primary_key_violations(flights: DataFrame, bookings: DataFrame) -> DataFrame:
    """(table_name, duplicate_keys, null_keys)."""

    def one(df: DataFrame, name: str, keys: list[str]) -> DataFrame:
        null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        return (
            df.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("n"))
            .agg(
                F.count_if((F.col("n") > 1) & ~null_key).alias("duplicate_keys"),
                F.coalesce(F.sum(F.when(null_key, F.col("n"))), F.lit(0)).alias("null_keys"),
            )
            .select(F.lit(name).alias("table_name"), "duplicate_keys", "null_keys")
        )

    return one(flights, "flights", ["flight_id"]).unionByName(one(bookings, "bookings", ["flight_id", "cabin_class"]))


def orphan_bookings(flights: DataFrame, bookings: DataFrame) -> DataFrame:
    """Bookings without a flight."""
    return bookings.join(flights.select("flight_id"), "flight_id", "left_anti")


def flight_constraints(flights: DataFrame) -> DataFrame:
    """NOT NULL of every required column and the 0/1 rule, as (position, metric, value)."""
    names = [*NOT_NULL_FLIGHT, "is_cancelled_not_0_or_1"]
    counts = flights.agg(
        *[F.count_if(F.col(c).isNull()).alias(c) for c in NOT_NULL_FLIGHT],
        _count(~F.col("is_cancelled").isin(0, 1)).alias("is_cancelled_not_0_or_1"),
    )
    return metric_rows(counts, names, "bigint")


# --- reconciliation -----------------------------------------------------------

# Headline measure -> largest accepted difference between the two computations.
TOLERANCES = {
    "total_flights": 0.0,
    "total_passengers": 0.0,
    "on_time_rate": 1e-4,
    "cancellation_rate": 1e-4,
    "avg_delay_minutes": 0.01,
    "total_revenue": 1.0,
}
AIRLINE_TOLERANCE = 1e-4


def reconcile_headline(metrics: DataFrame, kpis: DataFrame) -> DataFrame:
    """Six headline measures from the metric layer and from the KPI query, side by side."""
    ours = metric_rows(metrics, TOLERANCES, "double").withColumnRenamed("value", "metric_value")
    theirs = metric_rows(kpis, TOLERANCES, "double").select("metric", F.col("value").alias("kpi_value"))
    limit = reduce(
        lambda acc, item: acc.when(F.col("metric") == item[0], F.lit(item[1])), TOLERANCES.items(), F.when(F.lit(False), 0.0)
    )
    gap = F.abs(F.col("metric_value") - F.col("kpi_value"))
    return ours.join(theirs, "metric").select(
        "position",
        "metric",
        "metric_value",
        "kpi_value",
        limit.alias("tolerance"),
        F.coalesce(gap <= limit, F.lit(False)).alias("agrees"),
    )


def reconcile_by_airline(metrics: DataFrame, scorecard: DataFrame) -> DataFrame:
    """Per-airline on-time rates of both computations; an airline that one side lacks does not agree."""
    return (
        metrics.select("airline", F.col("on_time_rate").alias("metric_rate"))
        .join(scorecard.select("airline", F.col("on_time_rate").alias("kpi_rate")), "airline", "full")
        .withColumn("agrees", F.coalesce(F.abs(F.col("metric_rate") - F.col("kpi_rate")) < AIRLINE_TOLERANCE, F.lit(False)))
    )


def raise_if_apart(*comparisons: DataFrame) -> None:
    for comparison in comparisons:
        apart = comparison.where(~F.col("agrees")).collect()
        if apart:
            raise DataQualityError("; ".join(str(r.asDict()) for r in apart))
