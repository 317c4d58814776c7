"""Findings derived from the KPI results.

Each finding is a one-row table of typed measures; ``all_insights`` adds a
sentence to each and stacks them in a fixed order. The inputs are KPI results,
so every frame here is small by construction.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.numeric import ratio, rounded
from skyledger.functions.text import month_date
from skyledger.operators.rows import side_by_side

FACTOR_PLACES = 6
RATE = "decimal(10,4)"
MINUTES = "decimal(18,2)"


def _row(*columns: str) -> Column:
    return F.struct(*columns)


def _mean(value: Column, weight: Column) -> Column:
    """Weighted mean, summed in decimals so the order of rows cannot show."""
    return rounded(ratio(F.sum(value * weight), F.sum(weight)), FACTOR_PLACES)


def airline_extremes(airline_performance: DataFrame) -> DataFrame:
    """Least and most punctual airline; names break ties."""
    order = _row("on_time_rate", "airline")
    rated = airline_performance.where(F.col("on_time_rate").isNotNull())
    one = rated.agg(
        F.min_by(_row("airline", "delay_rate", "avg_delay_minutes"), order).alias("worst"),
        F.max_by(_row("airline", "delay_rate"), order).alias("best"),
    )
    return one.select(
        F.col("worst.airline").alias("worst_airline"),
        F.col("worst.delay_rate").alias("worst_delay_rate"),
        F.col("worst.avg_delay_minutes").alias("worst_avg_delay"),
        F.col("best.airline").alias("best_airline"),
        F.col("best.delay_rate").alias("best_delay_rate"),
    )


def _highest(column: str, pick: Column) -> Column:
    """The row with the highest value; the first name wins a tie."""
    return F.min_by(pick, F.struct((-F.col(column)).alias("v"), F.col("airport")))


def disruption(airport_performance: DataFrame) -> DataFrame:
    """Most and least disrupted airport against the departure-weighted network rate."""
    pick = _row("airport", "disruption_rate")
    calm = F.max_by(pick, F.struct((-F.col("disruption_rate")).alias("v"), F.col("airport")))
    one = airport_performance.agg(
        _highest("disruption_rate", pick).alias("top"),
        calm.alias("calm"),
        _mean(F.col("disruption_rate").cast(RATE), F.col("departures")).alias("network_disruption_rate"),
    )
    return one.select(
        F.col("top.airport").alias("most_disrupted"),
        F.col("top.disruption_rate").alias("most_rate"),
        F.col("calm.airport").alias("least_disrupted"),
        F.col("calm.disruption_rate").alias("least_rate"),
        "network_disruption_rate",
        rounded(ratio(F.col("top.disruption_rate"), F.col("network_disruption_rate")), 4).alias("times_network"),
    )


def cancellation(airport_performance: DataFrame, executive_kpis: DataFrame) -> DataFrame:
    top = airport_performance.agg(_highest("cancellation_rate", _row("airport", "cancellation_rate")).alias("top"))
    return side_by_side(
        top.select(F.col("top.airport").alias("airport"), F.col("top.cancellation_rate").alias("cancellation_rate")),
        executive_kpis.select(F.col("cancellation_rate").alias("network_cancellation_rate")),
    )


def revenue_concentration(top_revenue_routes: DataFrame) -> DataFrame:
    order = F.struct((-F.col("revenue")).alias("v"), F.col("route"))
    one = top_revenue_routes.agg(
        F.min_by(_row("route", "revenue", "revenue_share"), order).alias("lead"),
        F.sum(F.col("revenue_share").cast(RATE)).cast("double").alias("top_routes_share"),
    )
    return one.select(
        F.col("lead.route").alias("route"),
        F.col("lead.revenue").alias("revenue"),
        F.col("lead.revenue_share").alias("revenue_share"),
        "top_routes_share",
    )


def risky_routes(high_demand_poor_performance: DataFrame, executive_kpis: DataFrame, named: int = 3) -> DataFrame:
    """How many busy routes run late and the biggest of them; no row when there are none."""
    order = [F.desc("passengers"), F.asc("route")]
    one = high_demand_poor_performance.agg(F.count(F.lit(1)).alias("routes"))
    biggest = (
        high_demand_poor_performance.orderBy(*order)
        .limit(named)
        .agg(
            F.array_sort(
                F.collect_list(F.struct((-F.col("passengers")).alias("v"), "route", "passengers", "on_time_rate"))
            ).alias("top")
        )
    )
    network = executive_kpis.select(F.col("on_time_rate").alias("network_on_time_rate"))
    return (
        side_by_side(one, network, biggest)
        .where(F.col("routes") > 0)
        .select("routes", "network_on_time_rate", F.array_join("top.route", ", ").alias("biggest"), "top")
    )


def daypart(delay_by_hour: DataFrame) -> DataFrame:
    """Flight-weighted delay and punctuality before 09:00 and from 18:00."""
    early, late = F.col("departure_hour") < 9, F.col("departure_hour") >= 18

    def mean(hours: Column, column: str, kind: str) -> Column:
        return _mean(F.when(hours, F.col(column).cast(kind)), F.when(hours, F.col("flights")))

    return delay_by_hour.agg(
        mean(early, "avg_delay_minutes", MINUTES).alias("morning_delay"),
        mean(early, "on_time_rate", RATE).alias("morning_on_time_rate"),
        mean(late, "avg_delay_minutes", MINUTES).alias("evening_delay"),
        mean(late, "on_time_rate", RATE).alias("evening_on_time_rate"),
    )


def months(monthly_trends: DataFrame) -> DataFrame:
    name = F.date_format(month_date(F.col("month")), "MMMM").alias("name")
    rated = F.struct(F.col("on_time_rate").isNull(), "on_time_rate", "month")
    best = F.struct(F.col("on_time_rate").isNotNull(), "on_time_rate", "month")
    busy = F.struct("passengers", "month")
    one = monthly_trends.withColumn("name", name).agg(
        F.min_by(_row("month", "name", "on_time_rate"), rated).alias("worst"),
        F.max_by(_row("month", "name", "on_time_rate"), best).alias("best"),
        F.max_by(_row("month", "name", "passengers"), busy).alias("peak"),
    )
    return one.select(
        F.col("worst.month").alias("worst_month"),
        F.col("worst.name").alias("worst_month_name"),
        F.col("worst.on_time_rate").alias("worst_on_time_rate"),
        F.col("best.month").alias("best_month"),
        F.col("best.name").alias("best_month_name"),
        F.col("best.on_time_rate").alias("best_on_time_rate"),
        F.col("peak.month").alias("peak_month"),
        F.col("peak.name").alias("peak_month_name"),
        F.col("peak.passengers").alias("peak_passengers"),
    )


def business(cabin_class_summary: DataFrame) -> DataFrame:
    of = lambda cabin, column: F.max(F.when(F.col("cabin_class") == cabin, F.col(column)))
    return cabin_class_summary.agg(
        of("Business", "passenger_share").alias("passenger_share"),
        of("Business", "revenue_share").alias("revenue_share"),
        of("Business", "avg_ticket_price").alias("business_fare"),
        of("Economy", "avg_ticket_price").alias("economy_fare"),
    )


def _percent(value: Column) -> Column:
    """One decimal, rounded on a decimal first so the text does not depend on binary noise."""
    return F.format_string("%.1f%%", rounded(value * 100, 1))


def _percent_of(column: str) -> Column:
    return _percent(F.col(column))


def _said(one: DataFrame, number: int, kind: str, pattern: str, *parts: Column) -> DataFrame:
    return one.select(
        F.lit(number).cast("bigint").alias("insight_no"), F.lit(kind).alias("kind"), F.format_string(pattern, *parts).alias("text")
    )


def all_insights(r: dict[str, DataFrame]) -> DataFrame:
    """Eight findings, (insight_no, kind, text); the fifth is left out when no route is at risk."""
    top_names = F.array_join(
        F.transform(
            "top",
            lambda t: F.format_string("%s with %,d passengers at %s on time", t.route, t.passengers, _percent(t.on_time_rate)),
        ),
        "; ",
    )
    parts = [
        _said(
            airline_extremes(r["airline_performance"]), 1, "airline_extremes",
            "Least punctual airline: %s, late on %s of operated flights with %.1f min average delay. Most punctual: %s, late on %s.",
            F.col("worst_airline"), _percent_of("worst_delay_rate"), rounded(F.col("worst_avg_delay"), 1), F.col("best_airline"), _percent_of("best_delay_rate"),
        ),
        _said(
            disruption(r["airport_performance"]), 2, "disruption",
            "Most disrupted airport: %s at %s of departures, %.1f times the network's %s. Least disrupted: %s at %s.",
            F.col("most_disrupted"), _percent_of("most_rate"), rounded(F.col("times_network"), 1), _percent_of("network_disruption_rate"),
            F.col("least_disrupted"), _percent_of("least_rate"),
        ),
        _said(
            cancellation(r["airport_performance"], r["executive_kpis"]), 3, "cancellation",
            "Most cancellations: %s at %s of departures; network %s.",
            F.col("airport"), _percent_of("cancellation_rate"), _percent_of("network_cancellation_rate"),
        ),
        _said(
            revenue_concentration(r["top_revenue_routes"]), 4, "revenue_concentration",
            "Leading route by revenue: %s with $%,.1fM or %s of the total; the leading routes together hold %s.",
            F.col("route"), rounded(F.col("revenue") / 1e6, 1), _percent_of("revenue_share"), _percent_of("top_routes_share"),
        ),
        _said(
            risky_routes(r["high_demand_poor_performance"], r["executive_kpis"]), 5, "risky_routes",
            "Busy routes below the network's %s on-time rate: %d. Largest: %s.",
            _percent_of("network_on_time_rate"), F.col("routes"), top_names,
        ),
        _said(
            daypart(r["delay_by_hour"]), 6, "daypart",
            "Departures before 09:00 average %.1f min delay (%s on time); from 18:00 it is %.1f min (%s on time).",
            rounded(F.col("morning_delay"), 1), _percent_of("morning_on_time_rate"), rounded(F.col("evening_delay"), 1), _percent_of("evening_on_time_rate"),
        ),
        _said(
            months(r["monthly_trends"]), 7, "months",
            "Punctuality was lowest in %s (%s) and highest in %s (%s). Passengers peaked in %s with %,d.",
            F.col("worst_month_name"), _percent_of("worst_on_time_rate"), F.col("best_month_name"), _percent_of("best_on_time_rate"),
            F.col("peak_month_name"), F.col("peak_passengers"),
        ),
        _said(
            business(r["cabin_class_summary"]), 8, "business",
            "Business carries %s of passengers and %s of revenue; its average fare is $%,.0f, Economy's $%,.0f.",
            _percent_of("passenger_share"), _percent_of("revenue_share"), rounded(F.col("business_fare"), 0), rounded(F.col("economy_fare"), 0),
        ),
    ]
    return reduce(DataFrame.unionByName, parts).orderBy("insight_no")
