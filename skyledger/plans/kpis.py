"""The fifteen named KPI queries over the model tables.

Every query first aggregates rows by a low-cardinality key. Ranks, shares and
lags are windows over that small result, never over rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from skyledger import constants as K
from skyledger.functions.numeric import money, rate, ratio
from skyledger.operators.ranks import numbered, ranked


def whole(*order: Column) -> WindowSpec:
    """A window over all rows of an already aggregated frame."""
    return Window.partitionBy().orderBy(*order) if order else Window.partitionBy()


def severe() -> Column:
    return F.col("delay_minutes") >= K.SEVERE_MINUTES


def disrupted() -> Column:
    """Cancelled or severely late, as 1/0, over every departure."""
    return F.when((F.col("is_cancelled") == 1) | severe(), 1).otherwise(0)


def severe_when_operated() -> Column:
    """Severely late as 1/0; null, so not counted, for cancelled rows."""
    return F.when(severe(), 1).when(F.col("is_cancelled") == 0, 0)


def flight_count() -> Column:
    return F.count(F.lit(1)).alias("flights")


def on_time() -> Column:
    return rate(F.avg("is_on_time")).alias("on_time_rate")


def delay() -> Column:
    return money(F.avg("delay_minutes")).alias("avg_delay_minutes")


def cancellation() -> Column:
    return rate(F.avg("is_cancelled")).alias("cancellation_rate")


def passengers() -> Column:
    return F.sum("passengers").alias("passengers")


def revenue() -> Column:
    """Exact decimal sum, shown as double."""
    return F.sum("revenue").cast("double").alias("revenue")


def fare(part: str = "revenue", whole: str = "passengers") -> Column:
    return money(ratio(F.col(part), F.col(whole)))


def share(column: str) -> Column:
    return rate(ratio(F.col(column), F.sum(column).over(whole())))


def _sums_and_counts() -> list[Column]:
    """The parts of the three means, for aggregates that are summed up again."""
    averaged = ("delay_minutes", "is_on_time", "is_cancelled")
    return [f(c).alias(f"{c}_{part}") for c in averaged for part, f in (("sum", F.sum), ("n", F.count))]


def _ranked(*order: Column) -> Column:
    return F.rank().over(whole(*order)).cast("bigint")


def with_flights(bookings: DataFrame, flights: DataFrame, *columns: str) -> DataFrame:
    """Bookings with flight attributes; bookings that already carry them need no join."""
    if set(columns) <= set(bookings.columns):
        return bookings
    return bookings.join(flights.select("flight_id", *columns), "flight_id")


# --- network and airlines -----------------------------------------------------


def executive_kpis(flights: DataFrame, bookings: DataFrame) -> DataFrame:
    sums = flights.agg(
        F.count(F.lit(1)).alias("total_flights"),
        F.sum("is_cancelled").alias("cancelled_flights"),
        cancellation(),
        on_time(),
        delay(),
        F.sum("passengers").alias("total_passengers"),
        F.sum("revenue").alias("money"),
        F.min("flight_date").alias("first"),
        F.max("flight_date").alias("last"),
    )
    return sums.select(
        "total_flights",
        "cancelled_flights",
        "cancellation_rate",
        "on_time_rate",
        "avg_delay_minutes",
        "total_passengers",
        F.col("money").cast("double").alias("total_revenue"),
        fare("money", "total_passengers").alias("avg_fare"),
        F.date_format("first", "yyyy-MM-dd").alias("period_start"),
        F.date_format("last", "yyyy-MM-dd").alias("period_end"),
    )


def airline_performance(flights: DataFrame, bookings: DataFrame) -> DataFrame:
    by_airline = flights.groupBy("airline").agg(
        flight_count(),
        F.avg("is_on_time").alias("punctuality"),
        delay(),
        rate(F.avg(severe_when_operated())).alias("severe_delay_rate"),
        cancellation(),
        passengers(),
        revenue(),
    )
    return by_airline.select(
        "airline",
        "flights",
        rate(F.col("punctuality")).alias("on_time_rate"),
        rate(1 - F.col("punctuality")).alias("delay_rate"),
        "avg_delay_minutes",
        "severe_delay_rate",
        "cancellation_rate",
        "passengers",
        "revenue",
        _ranked(F.desc_nulls_last("punctuality")).alias("on_time_rank"),
    ).orderBy(F.desc_nulls_last("on_time_rate"), "airline")


def monthly_trends(flights: DataFrame, bookings: DataFrame) -> DataFrame:
    return (
        flights.groupBy("month")
        .agg(flight_count(), on_time(), delay(), cancellation(), passengers(), revenue())
        .orderBy("month")
    )


def delay_by_time_of_day(flights: DataFrame, bookings: DataFrame) -> DataFrame:
    return (
        flights.groupBy("time_of_day")
        .agg(flight_count(), on_time(), delay(), F.min("departure_hour").alias("first_hour"))
        .orderBy("first_hour")
        .drop("first_hour")
    )


# --- airports -------------------------------------------------------------------


def airport_performance(flights: DataFrame, bookings: DataFrame) -> DataFrame:
    """Departures and arrivals of each airport; an airport needs both to be listed.

    Flights are read once, into (origin, destination) sums; each sum then counts
    at both of its ends.
    """
    legs = flights.groupBy("origin", "destination").agg(
        flight_count(),
        F.sum("passengers").alias("passengers"),
        F.sum(disrupted()).alias("disrupted"),
        *_sums_and_counts(),
    )
    end = lambda column, departing: F.struct(F.col(column).alias("airport"), F.lit(departing).alias("departing"))
    ends = legs.select("*", F.inline(F.array(end("origin", True), end("destination", False))))
    out = lambda c: F.sum(F.when(F.col("departing"), F.col(c)))
    into = lambda c: F.sum(F.when(~F.col("departing"), F.col(c)))
    mean = lambda c: ratio(out(f"{c}_sum"), out(f"{c}_n"))
    return (
        ends.groupBy("airport")
        .agg(
            out("flights").alias("departures"),
            money(mean("delay_minutes")).alias("avg_delay_minutes"),
            rate(mean("is_on_time")).alias("on_time_rate"),
            rate(mean("is_cancelled")).alias("cancellation_rate"),
            rate(ratio(out("disrupted"), out("flights"))).alias("disruption_rate"),
            out("passengers").alias("departing_passengers"),
            into("flights").alias("arrivals"),
            into("passengers").alias("arriving_passengers"),
        )
        .where(F.col("airport").isNotNull() & (F.col("departures") > 0) & (F.col("arrivals") > 0))
        .withColumn("total_passengers", F.col("departing_passengers") + F.col("arriving_passengers"))
        .withColumn("disruption_rank", _ranked(F.desc_nulls_last("disruption_rate")))
        .orderBy(F.desc_nulls_last("disruption_rate"), "airport")
    )


def delay_by_hour(flights: DataFrame, bookings: DataFrame) -> DataFrame:
    return (
        flights.groupBy("departure_hour").agg(flight_count(), delay(), on_time(), cancellation()).orderBy("departure_hour")
    )


def airport_seasonality(flights: DataFrame, bookings: DataFrame) -> DataFrame:
    month_no = F.substring("month", 6, 2).cast("int")
    seasons = {"winter": K.WINTER_MONTHS, "summer": K.SUMMER_MONTHS, "shoulder": K.SHOULDER_MONTHS}
    return (
        flights.groupBy(F.col("origin").alias("airport"))
        .agg(
            *[
                rate(F.avg(F.when(month_no.isin(*months), F.col("is_on_time")))).alias(f"{season}_on_time_rate")
                for season, months in seasons.items()
            ]
        )
        .orderBy(F.asc_nulls_first("winter_on_time_rate"), "airport")
    )


# --- passengers and revenue -----------------------------------------------------


def _booking_sums(bookings: DataFrame, *keys: str, **more: Column) -> DataFrame:
    return bookings.groupBy(*keys).agg(
        passengers(), F.sum("revenue").alias("money"), *[c.alias(name) for name, c in more.items()]
    )


def _of_cabin(cabin: str, column: str) -> Column:
    return F.sum(F.when(F.col("cabin_class") == cabin, F.col(column)).otherwise(0))


def cabin_class_summary(flights: DataFrame, bookings: DataFrame) -> DataFrame:
    operated = with_flights(bookings, flights, "is_cancelled").where(F.col("is_cancelled") == 0)
    sums = _booking_sums(operated, "cabin_class")
    return sums.select(
        "cabin_class",
        "passengers",
        share("passengers").alias("passenger_share"),
        F.col("money").cast("double").alias("revenue"),
        share("money").alias("revenue_share"),
        fare("money").alias("avg_ticket_price"),
    ).orderBy(F.asc_nulls_first("avg_ticket_price"), "cabin_class")


def airline_revenue(flights: DataFrame, bookings: DataFrame) -> DataFrame:
    sums = _booking_sums(
        with_flights(bookings, flights, "airline"), "airline", business=_of_cabin("Business", "revenue")
    )
    return sums.select(
        "airline",
        "passengers",
        F.col("money").cast("double").alias("revenue"),
        share("money").alias("revenue_share"),
        fare("money").alias("avg_ticket_price"),
        rate(ratio(F.col("business"), F.col("money"))).alias("business_revenue_share"),
    ).orderBy(F.desc("revenue"), "airline")


def monthly_passengers(flights: DataFrame, bookings: DataFrame) -> DataFrame:
    names = {c: c.lower().replace(" ", "_") for c in K.CABINS}
    sums = _booking_sums(
        with_flights(bookings, flights, "month"),
        "month",
        **{name: _of_cabin(cabin, "passengers") for cabin, name in names.items()},
    )
    before = F.lag("passengers").over(whole("month"))
    return sums.select(
        "month",
        "passengers",
        *names.values(),
        F.col("money").cast("double").alias("revenue"),
        fare("money").alias("avg_ticket_price"),
        rate(ratio(F.col("passengers"), before) - 1).alias("passenger_mom_change"),
    ).orderBy("month")


def top_revenue_routes(flights: DataFrame, bookings: DataFrame, top: int = 10) -> DataFrame:
    """Shares are of all revenue; flights are counted once whatever cabins they sell."""
    per_flight = _booking_sums(with_flights(bookings, flights, "route"), "flight_id", "route")
    sums = per_flight.groupBy("route").agg(passengers(), F.sum("money").alias("money"), flight_count())
    return (
        sums.select(
            "route",
            "passengers",
            F.col("money").cast("double").alias("revenue"),
            share("money").alias("revenue_share"),
            fare("money").alias("avg_ticket_price"),
            fare("money", "flights").alias("revenue_per_flight"),
        )
        .orderBy(F.desc("revenue"), "route")
        .limit(top)
    )


# --- routes -----------------------------------------------------------------------


def route_performance(flights: DataFrame, bookings: DataFrame) -> DataFrame:
    """Airlines per route come from a (route, airline) pre-aggregate, not a distinct count of rows.

    Routes are ranked after a range sort, so no task holds all of them.
    """
    per_airline = flights.groupBy("route", "origin", "destination", "airline").agg(
        F.max("distance_miles").alias("distance_miles"),
        flight_count(),
        passengers(),
        F.sum("revenue").alias("money"),
        *_sums_and_counts(),
    )
    mean = lambda c: ratio(F.sum(f"{c}_sum"), F.sum(f"{c}_n"))
    per_route = per_airline.groupBy("route", "origin", "destination").agg(
        F.max("distance_miles").alias("distance_miles"),
        F.sum("flights").alias("flights"),
        F.count("airline").alias("airlines"),
        passengers(),
        F.sum("money").cast("double").alias("revenue"),
        money(mean("delay_minutes")).alias("avg_delay_minutes"),
        rate(mean("is_on_time")).alias("on_time_rate"),
        rate(mean("is_cancelled")).alias("cancellation_rate"),
    )
    by_revenue = ranked(per_route, "revenue", F.asc("route"), name="revenue_rank")
    return ranked(by_revenue, "passengers", F.asc("route"), name="passenger_rank").orderBy(F.desc("revenue"), "route")


def top_delayed_routes(flights: DataFrame, bookings: DataFrame, min_flights: int = 100, top: int = 10) -> DataFrame:
    return (
        flights.groupBy("route")
        .agg(flight_count(), delay(), on_time(), cancellation())
        .where(F.col("flights") >= min_flights)
        .orderBy(F.desc_nulls_last("avg_delay_minutes"), "route")
        .limit(top)
    )


def high_demand_poor_performance(flights: DataFrame, bookings: DataFrame) -> DataFrame:
    """Routes in the top passenger quartile that run below the network's on-time rate.

    Routes are numbered after a range sort and written; the network rate is summed
    up from them, so flights are read once.
    """
    routes = flights.groupBy("route").agg(
        passengers(),
        F.sum("revenue").alias("money"),
        F.avg("is_on_time").alias("punctuality"),
        F.sum("is_on_time").alias("on_time_flights"),
        F.count("is_on_time").alias("operated"),
        delay(),
        cancellation(),
    )
    placed = numbered(routes, F.desc("passengers"), F.asc("route"), total="routes")
    network = placed.agg(ratio(F.sum("on_time_flights"), F.sum("operated")).alias("rate")).scalar()
    # The first of four parts is one longer where the routes don't divide evenly.
    first_quarter = F.ceil(F.col("routes") / 4)
    return (
        placed.withColumn("network", network)
        .where((F.col("row_no") <= first_quarter) & (F.col("punctuality") < F.col("network")))
        .select(
            "route",
            "passengers",
            F.col("money").cast("double").alias("revenue"),
            rate(F.col("punctuality")).alias("on_time_rate"),
            rate(F.col("network")).alias("network_on_time_rate"),
            rate(F.col("punctuality") - F.col("network")).alias("on_time_gap"),
            "avg_delay_minutes",
            "cancellation_rate",
        )
        .orderBy(F.desc("passengers"), "route")
    )


def route_airline_breakdown(flights: DataFrame, bookings: DataFrame) -> DataFrame:
    """Carriers of each route that more than one airline flies.

    Carriers of a route are counted on the (route, airline) aggregate, so flights
    are read once and no semi-join against them is needed.
    """
    pairs = flights.where(F.col("route").isNotNull()).groupBy("route", "airline").agg(flight_count(), passengers(), on_time(), delay())
    carriers = F.count("airline").over(Window.partitionBy("route"))
    return (
        pairs.withColumn("carriers", carriers)
        .where(F.col("carriers") > 1)
        .drop("carriers")
        .orderBy("route", F.desc_nulls_last("on_time_rate"), "airline")
    )


KPI_QUERIES: dict[str, Callable[..., DataFrame]] = {
    f.__name__: f
    for f in (
        executive_kpis,
        airline_performance,
        monthly_trends,
        delay_by_time_of_day,
        airport_performance,
        delay_by_hour,
        airport_seasonality,
        cabin_class_summary,
        airline_revenue,
        monthly_passengers,
        top_revenue_routes,
        route_performance,
        top_delayed_routes,
        high_demand_poor_performance,
        route_airline_breakdown,
    )
}

# The queries over bookings; all others read flights only.
BOOKING_QUERIES = frozenset(
    f.__name__ for f in (cabin_class_summary, airline_revenue, monthly_passengers, top_revenue_routes)
)


def run_all(flights: DataFrame, bookings: DataFrame, **params: dict) -> dict[str, DataFrame]:
    """Every named query as a lazy DataFrame; ``params`` maps a query name to its arguments."""
    return {name: query(flights, bookings, **params.get(name, {})) for name, query in KPI_QUERIES.items()}
