"""Metrics recomputed on any slice, and the panels built on them.

Flights and sales may be cells of a cube or rows of the model: rows count as cells of one.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger import constants as K
from skyledger.functions.numeric import ratio
from skyledger.functions.text import cabin_rank, month_date
from skyledger.operators.guards import stop_if
from skyledger.operators.medians import quantile
from skyledger.operators.rows import side_by_side
from skyledger.plans.cube import Cube, flight_cells
from skyledger.plans.kpis import whole


def _with_keys(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Rows whose grouping keys are all known."""
    return reduce(lambda d, k: d.where(F.col(k).isNotNull()), keys, df)


def _mean(part: str, of: str) -> Column:
    return ratio(F.sum(part), F.sum(of))


def _flight_measures() -> list[Column]:
    return [
        F.sum("flights").alias("flights"),
        _mean("on_time", "operated").alias("on_time_rate"),
        _mean("delay", "delay_known").alias("avg_delay_minutes"),
        _mean("cancelled", "cancelled_known").alias("cancellation_rate"),
        _mean("disrupted", "flights").alias("disruption_rate"),
        F.sum("passengers").alias("passengers"),
        F.sum("revenue").cast("double").alias("revenue"),
    ]


def flight_metrics(flights: DataFrame, *keys: str) -> DataFrame:
    """Unrounded operational metrics by any keys; one row, null when empty, without keys."""
    cells = flight_cells(flights)
    return _with_keys(cells, keys).groupBy(*keys).agg(*_flight_measures()) if keys else cells.agg(*_flight_measures())


def _sold(bookings: DataFrame, *keys: str) -> DataFrame:
    """Passengers and exact money per key."""
    return (
        _with_keys(bookings, keys)
        .groupBy(*keys)
        .agg(F.sum("passengers").alias("passengers"), F.sum("revenue").alias("money"))
    )


def _sales_columns() -> list[Column]:
    return [
        F.col("passengers"),
        F.col("money").cast("double").alias("revenue"),
        F.when(F.col("passengers") > 0, ratio(F.col("money"), F.col("passengers"))).alias("avg_ticket_price"),
    ]


def booking_metrics(bookings: DataFrame, *keys: str) -> DataFrame:
    return _sold(bookings, *keys).select(*keys, *_sales_columns())


def executive_metrics(flights: DataFrame, bookings: DataFrame) -> DataFrame:
    """Seven headline values; operations from flights, money from bookings."""
    ops = flight_metrics(flights).select(
        F.coalesce("flights", F.lit(0)).alias("total_flights"), "on_time_rate", "avg_delay_minutes", "cancellation_rate"
    )
    sold = bookings.agg(
        F.coalesce(F.sum("passengers"), F.lit(0)).alias("total_passengers"),
        F.coalesce(F.sum("revenue").cast("double"), F.lit(0.0)).alias("total_revenue"),
    ).withColumn("avg_fare", ratio(F.col("total_revenue"), F.col("total_passengers")))
    return side_by_side(ops, sold)


# --- slices -----------------------------------------------------------------------


@dataclass(frozen=True)
class Slice:
    """A selection; an empty list selects everything. Months are inclusive ``YYYY-MM`` bounds."""

    first_month: str | None = None
    last_month: str | None = None
    airlines: tuple[str, ...] = ()
    origins: tuple[str, ...] = ()
    destinations: tuple[str, ...] = ()
    cabins: tuple[str, ...] = ()

    def of_flights(self) -> Column:
        conditions = [F.lit(True)]
        if self.first_month is not None:
            conditions.append(F.col("month") >= self.first_month)
        if self.last_month is not None:
            conditions.append(F.col("month") <= self.last_month)
        for column, wanted in (("airline", self.airlines), ("origin", self.origins), ("destination", self.destinations)):
            if wanted:
                conditions.append(F.col(column).isin(*wanted))
        return reduce(lambda a, b: a & b, conditions)

    def of_bookings(self) -> Column:
        chosen = self.of_flights()
        return chosen & F.col("cabin_class").isin(*self.cabins) if self.cabins else chosen

    def apply(self, flights: DataFrame, enriched: DataFrame) -> tuple[DataFrame, DataFrame]:
        return flights.where(self.of_flights()), enriched.where(self.of_bookings())

    def chosen(self, flights: DataFrame, enriched: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The selection with a guard in its plan: whatever is computed from it stops if either table is empty.

        Months are folders of a stored cube, so the guard reads no more than the selection itself.
        """
        some = self.apply(flights, enriched)
        return tuple(guarded(df, *some) for df in some)

    def of(self, cube: Cube) -> Cube:
        return Cube(*self.chosen(cube.flights, cube.sales))


EMPTY = "no flights match the selection"


class EmptySlice(ValueError):
    """No flights match the selection."""


def require_rows(flights: DataFrame, bookings: DataFrame) -> None:
    if flights.isEmpty() or bookings.isEmpty():
        raise EmptySlice(EMPTY)


def guarded(df: DataFrame, *needed: DataFrame) -> DataFrame:
    """The same rows, or an error when they are computed and one of the ``needed`` frames has none."""
    counts = [n.limit(1).agg(F.count(F.lit(1)).alias("rows")) for n in needed]
    return reduce(lambda d, c: stop_if(d, c, F.col("rows") == 0, F.lit(EMPTY)), counts, df)


def slice_vs_network(flights: DataFrame, enriched: DataFrame, chosen: Slice) -> DataFrame:
    """Slice and network values with their distance: percentage points for rates, minutes for delay.

    Both sides come out of one conditional aggregate per table.
    """
    sold = lambda c: F.when(chosen.of_bookings(), F.col(c))
    here = lambda c: F.sum(F.when(chosen.of_flights(), F.col(c)))
    cells = flight_cells(flights)
    rates = {
        "on_time_rate": ("on_time", "operated"),
        "cancellation_rate": ("cancelled", "cancelled_known"),
        "avg_delay_minutes": ("delay", "delay_known"),
    }
    ops = cells.agg(
        F.coalesce(here("flights"), F.lit(0)).alias("flights"),
        F.coalesce(F.sum("flights"), F.lit(0)).alias("network_flights"),
        *[
            f.alias(label)
            for name, (part, of) in rates.items()
            for f, label in ((ratio(here(part), here(of)), name), (_mean(part, of), f"network_{name}"))
        ],
    )
    money = enriched.agg(
        *[
            F.coalesce(F.sum(value).cast(kind), F.lit(0).cast(kind)).alias(name)
            for c, kind in (("passengers", "bigint"), ("revenue", "double"))
            for value, name in ((sold(c), c), (F.col(c), f"network_{c}"))
        ]
    )
    points = lambda c: ((F.col(c) - F.col(f"network_{c}")) * 100).alias(f"{c}_pp")
    return side_by_side(ops, money).select(
        "*",
        points("on_time_rate"),
        points("cancellation_rate"),
        (F.col("avg_delay_minutes") - F.col("network_avg_delay_minutes")).alias("avg_delay_delta"),
    )


def filter_values(flights: DataFrame) -> DataFrame:
    """(field, value): the values a selection can offer, in one pass."""
    fields = ("airline", "origin", "destination", "month")
    # Collapse to the few existing combinations before unpivoting.
    seen = flights.groupBy(*fields).agg(F.lit(1))
    cells = [F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields]
    return seen.select(F.inline(F.array(*cells))).where(F.col("value").isNotNull()).distinct().orderBy("field", "value")


def _month_text(one_year: Column) -> Column:
    day = month_date(F.col("month"))
    return F.when(one_year, F.date_format(day, "MMM")).otherwise(F.date_format(day, "MMM yyyy")).alias("month_label")


def _in_one_year() -> Column:
    year = F.left("month", F.lit(4))
    return F.min(year).over(whole()) == F.max(year).over(whole())


def month_labels(flights: DataFrame) -> DataFrame:
    """``Mar`` when the data covers one year, else ``Mar 2025``."""
    months = flights.where(F.col("month").isNotNull()).select("month").distinct()
    return months.select("month", _month_text(_in_one_year()))


# --- panels -------------------------------------------------------------------------


def _labelled(by_month: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Labels of the whole network where a slice is shown, else those of the months at hand, without a second read."""
    if labels is not None:
        return by_month.join(labels, "month")
    return by_month.select("*", _month_text(_in_one_year()))


def monthly_flights(flights: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    return _labelled(flight_metrics(flights, "month"), labels).orderBy("month")


def monthly_passengers(enriched: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    return _labelled(booking_metrics(enriched, "month"), labels).orderBy("month")


def airline_on_time(flights: DataFrame) -> DataFrame:
    return flight_metrics(flights, "airline").orderBy(F.desc_nulls_last("on_time_rate"), "airline")


def airport_delay(flights: DataFrame) -> DataFrame:
    return flight_metrics(flights, "origin").orderBy(F.desc_nulls_last("avg_delay_minutes"), "origin")


def airline_delay(flights: DataFrame) -> DataFrame:
    return flight_metrics(flights, "airline").orderBy(F.desc_nulls_last("avg_delay_minutes"), "airline")


def delayed_routes(flights: DataFrame, floor: int = 20, top: int = 10) -> DataFrame:
    """Most delayed routes among those with enough flights: the lower quartile, but at least ``floor``."""
    routes = flight_metrics(flights, "route")
    quartile = F.floor(quantile(routes.select("flights"), "flights", 0.25)).cast("bigint")
    return (
        routes.withColumn("min_flights", F.greatest(F.lit(floor).cast("bigint"), quartile))
        .where(F.col("flights") >= F.col("min_flights"))
        .orderBy(F.desc_nulls_last("avg_delay_minutes"), "route")
        .limit(top)
    )


def cancellations(flights: DataFrame) -> DataFrame:
    return (
        _with_keys(flight_cells(flights), ("origin",))
        .groupBy("origin")
        .agg(
            F.sum("flights").alias("flights"),
            F.when(F.sum("cancelled_known") > 0, F.sum("cancelled")).alias("cancelled"),
            _mean("cancelled", "cancelled_known").alias("cancellation_rate"),
        )
        .orderBy(F.desc_nulls_last("cancellation_rate"), "origin")
    )


def delay_distribution(flights: DataFrame) -> DataFrame:
    """Flights per category over the fixed list of categories; absent ones show zero."""
    of = lambda label: F.sum(F.when(F.col("delay_category") == label, F.col("flights")))
    counts = flight_cells(flights).agg(*[F.coalesce(of(label), F.lit(0)).alias(label) for label in K.DELAY_CATEGORIES])
    cells = [
        F.struct(F.lit(i).cast("bigint").alias("position"), F.lit(label).alias("delay_category"), F.col(f"`{label}`").alias("flights"))
        for i, label in enumerate(K.DELAY_CATEGORIES, 1)
    ]
    return counts.select(F.inline(F.array(*cells))).withColumn(
        "share", ratio(F.col("flights"), F.sum("flights").over(whole()))
    )


def hour_profile(flights: DataFrame) -> DataFrame:
    return flight_metrics(flights, "departure_hour").orderBy("departure_hour")


def demand_vs_punctuality(flights: DataFrame, floor: int = 20, at_least: int = 4) -> DataFrame:
    """Busy routes (upper quartile of passengers) that run below the slice's on-time rate.

    Empty when fewer than ``at_least`` routes have ``floor`` flights. The slice's
    rate counts every flight, also of routes below the floor. The three values of
    the whole slice are scalars, so no window holds all routes.
    """
    cells = flight_cells(flights)
    overall = cells.agg(_mean("on_time", "operated").alias("rate")).scalar()
    eligible = flight_metrics(cells, "route").where(F.col("flights") >= floor)
    listed = eligible.agg(F.count(F.lit(1)).alias("n")).scalar()
    late = F.coalesce(F.col("on_time_rate") < F.col("slice_on_time_rate"), F.lit(False))
    return (
        eligible.where(listed >= at_least)
        .withColumn("slice_on_time_rate", overall)
        .withColumn("busy_from", quantile(eligible.select("passengers"), "passengers", 0.75))
        .select(
            "route",
            "flights",
            "passengers",
            "on_time_rate",
            "avg_delay_minutes",
            "cancellation_rate",
            "slice_on_time_rate",
            "busy_from",
            ((F.col("passengers") >= F.col("busy_from")) & late).alias("flagged"),
        )
        .orderBy(F.desc("flagged"), F.desc("passengers"), "route")
    )


def cabin_mix(enriched: DataFrame) -> DataFrame:
    """Cabins in their fixed order, with the business share of all revenue."""
    business = F.sum(F.when(F.col("cabin_class") == "Business", F.col("money")).otherwise(0)).over(whole())
    total = F.greatest(F.sum("money").over(whole()), F.lit(1))
    return (
        _sold(enriched, "cabin_class")
        .select(
            "cabin_class",
            *_sales_columns(),
            ratio(business, total).alias("business_share"),
            cabin_rank(F.col("cabin_class")).cast("bigint").alias("cabin_rank"),
        )
        .where(F.col("cabin_rank").isNotNull())
        .orderBy("cabin_rank")
    )


def top_routes_by_passengers(enriched: DataFrame, top: int = 15) -> DataFrame:
    return booking_metrics(enriched, "route").orderBy(F.desc("passengers"), "route").limit(top)


def airline_revenue(enriched: DataFrame) -> DataFrame:
    return booking_metrics(enriched, "airline").orderBy(F.desc("revenue"), "airline")


def fare_by_airline_and_cabin(enriched: DataFrame) -> DataFrame:
    return booking_metrics(enriched, "airline", "cabin_class").orderBy("airline", cabin_rank(F.col("cabin_class")))


def monthly_cabins(enriched: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    return _labelled(booking_metrics(enriched, "month", "cabin_class"), labels).orderBy("month", "cabin_class")


def top_routes_by_revenue(enriched: DataFrame, top: int = 15) -> DataFrame:
    """Shares are of the whole slice, rows without a route included."""
    by_route = enriched.groupBy("route").agg(F.sum("passengers").alias("passengers"), F.sum("revenue").alias("money"))
    share = ratio(F.col("money"), enriched.agg(F.sum("revenue").alias("money")).scalar())
    return (
        by_route.select("route", *_sales_columns(), share.alias("revenue_share"))
        .where(F.col("route").isNotNull())
        .orderBy(F.desc("revenue"), "route")
        .limit(top)
    )
