"""Flights, bookings and a messy raw feed derived from order tables.

A customer's orders of one day are one flight; their lines, grouped by return flag, are the cabins. Every order
with lines takes part.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger import constants as K
from skyledger.functions.numeric import floored_at_zero, money
from skyledger.functions.text import clock_text, delay_category, iso_date, month_text, time_of_day, weekday
from skyledger.session import stage

CABIN_BY_FLAG = {"N": "Economy", "R": "Premium Economy", "A": "Business"}
CENTS = "decimal(18,2)"
FLEET = ("Commuter", "Short haul", "Medium haul", "Long haul")


# The columns read of each source; a given schema spares a job that reads file footers.
SOURCES = {
    "nation": "n_nationkey int, n_name string",
    "customer": "c_custkey long, c_nationkey int, c_mktsegment string",
    "supplier": "s_suppkey long, s_nationkey int",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_returnflag string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SOURCES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _cabin_parts(prefix: str) -> list[str]:
    return [f"{prefix}_{rank}" for rank in range(len(CABIN_BY_FLAG))]


def _cabin_sums(lineitem: DataFrame) -> DataFrame:
    """One row per order with the sums of each cabin side by side.

    Pivoting by conditional sums keeps this one map-side combined shuffle on
    the order key, whatever share of the lines one order holds.
    """
    sums = [F.min("l_suppkey").alias("suppkey")]
    for rank, flag in enumerate(CABIN_BY_FLAG):
        own = F.col("l_returnflag") == flag
        sums += [
            F.sum(F.when(own, F.col("l_quantity"))).alias(f"seats_{rank}"),
            F.sum(F.when(own, F.col("cents"))).alias(f"cents_{rank}"),
        ]
    return (
        lineitem.withColumn("cents", F.rint(F.col("l_extendedprice") * 100).cast("bigint"))
        .groupBy(F.col("l_orderkey").alias("order_id"))
        .agg(*sums)
    )


def _by_customer_and_day(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """All orders of a customer and day as one flight, named and marked pending by the lowest order key.

    Whole cents sum exactly and fast in a long; decimals are made once per flight.
    """
    placed = orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("custkey"),
        F.to_date("o_orderdate").alias("flight_date"),
        (F.col("o_orderstatus") == "P").alias("pending"),
    )
    merged = (
        placed.join(_cabin_sums(lineitem), "order_id")
        .groupBy("custkey", "flight_date")
        .agg(
            F.min("order_id").alias("flight_id"),
            F.min_by("pending", "order_id").alias("pending"),
            F.min("suppkey").alias("suppkey"),
            *[F.sum(c).alias(c) for c in _cabin_parts("seats") + _cabin_parts("cents")],
        )
    )
    amounts = [
        (F.col(cents) * F.lit(Decimal("0.01"))).cast(CENTS).alias(amount)
        for cents, amount in zip(_cabin_parts("cents"), _cabin_parts("amount"))
    ]
    return merged.select("custkey", "flight_date", "flight_id", "pending", "suppkey", *_cabin_parts("seats"), *amounts)


def departures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per flight with its cabins still side by side.

    A customer and supplier of one nation make a flight that lands where it took off: the model keeps it,
    cleaning drops its rows from the feed as invalid.
    """
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("custkey"), F.col("c_nationkey").alias("from_key"), F.col("c_mktsegment").alias("airline")
    )
    supplier = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("suppkey"), F.col("s_nationkey").alias("to_key")
    )
    joined = (
        _by_customer_and_day(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"))
        .join(customer, "custkey")
        .join(supplier, "suppkey")
        .join(nation.toDF("from_key", "origin"), "from_key")
        .join(nation.toDF("to_key", "destination"), "to_key")
    )
    h = (F.col("flight_id") * 7919 + F.col("custkey") * 104729) % 1000003
    cancelled = (F.col("pending") & (F.col("h") % 4 == 0)).cast("int")
    variance = (
        (F.col("h") % 120) - 60 + 6 * (F.col("from_key") % 5) + F.when(F.col("h") % 50 == 0, 150).otherwise(0)
    ).cast("double")
    operated = F.col("is_cancelled") == 0
    return (
        joined.withColumn("h", h)
        .withColumn("is_cancelled", cancelled)
        .withColumn("sched", 360 + (F.col("h") * 31) % 960)
        .withColumn("departure_variance", F.when(operated, variance))
        .withColumn("distance_miles", (100 + 90 * F.abs(F.col("from_key") - F.col("to_key"))).cast("int"))
    )


# What flights, bookings and the feed need of a departure.
DEPARTURE = (
    "custkey", "suppkey", "flight_date", "flight_id", "airline", "origin", "destination", "is_cancelled", "sched",
    "departure_variance", "distance_miles", *_cabin_parts("seats"), *_cabin_parts("amount"),
)


def staged_departures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Departures written once, for a job that makes several tables of them: lines and orders meet once, not for each."""
    return stage(departures(spark, sf_dir).select(*DEPARTURE), "departures")


def _aircraft() -> Column:
    """A supplier flies one class of aircraft."""
    return F.element_at(F.array(*map(F.lit, FLEET)), (F.col("suppkey") % len(FLEET) + 1).cast("int"))


def _across_cabins(prefix: str) -> Column:
    return sum((F.coalesce(F.col(f"{prefix}_{i}"), F.lit(0)) for i in range(1, 3)), F.coalesce(F.col(f"{prefix}_0"), F.lit(0)))


def _when_operated(value: Column) -> Column:
    return F.when(F.col("is_cancelled") == 0, value).otherwise(F.lit(0))


def _flight_columns() -> list[Column]:
    variance = F.col("departure_variance")
    delay = floored_at_zero(variance)
    hour = F.floor(F.col("sched") / 60).cast("int")
    return [
        F.col("flight_id"),
        F.concat(F.lit("F"), F.col("custkey").cast("string")).alias("flight_number"),
        F.col("flight_date"),
        month_text(F.col("flight_date")).alias("month"),
        weekday(F.col("flight_date")).alias("day_of_week"),
        F.col("airline"),
        F.col("origin"),
        F.col("destination"),
        F.concat_ws("-", "origin", "destination").alias("route"),
        _aircraft().alias("aircraft"),
        clock_text(F.col("sched")).alias("scheduled_departure"),
        F.when(F.col("is_cancelled") == 0, clock_text(F.col("sched") + variance)).alias("actual_departure"),
        hour.alias("departure_hour"),
        time_of_day(hour).alias("time_of_day"),
        variance.alias("departure_variance"),
        delay.alias("delay_minutes"),
        delay_category(delay, F.col("is_cancelled")).alias("delay_category"),
        F.col("is_cancelled"),
        F.when(F.col("is_cancelled") == 0, (variance < K.ON_TIME_MINUTES).cast("int")).alias("is_on_time"),
        F.col("distance_miles"),
    ]


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flights_of(departures(spark, sf_dir))


def flights_of(base: DataFrame) -> DataFrame:
    return base.select(
        *_flight_columns(),
        _when_operated(_across_cabins("seats").cast("bigint")).alias("passengers"),
        _when_operated(_across_cabins("amount")).cast(CENTS).alias("revenue"),
    )


def _by_cabin(base: DataFrame, *keep: Column) -> DataFrame:
    """Turn the side-by-side cabins into rows, one per cabin that exists."""
    cells = ", ".join(
        f"'{cabin}', {i}L, seats_{i}, amount_{i}" for i, cabin in enumerate(CABIN_BY_FLAG.values())
    )
    cabins = F.expr(f"stack({len(CABIN_BY_FLAG)}, {cells})").alias("cabin_class", "cabin_no", "seats", "amount")
    return (
        base.select(*keep, cabins)
        .where(F.col("seats").isNotNull())
        .withColumn("passengers", _when_operated(F.col("seats").cast("bigint")))
        .withColumn("ticket_price", money(F.col("amount").cast("double") / F.col("seats")))
        .withColumn("revenue", _when_operated(F.col("amount")).cast(CENTS))
    )


def bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bookings_of(departures(spark, sf_dir))


def bookings_of(base: DataFrame) -> DataFrame:
    keep = [F.col("flight_id"), F.col("is_cancelled")]
    return _by_cabin(base, *keep).select(
        "flight_id", "cabin_class", "passengers", "ticket_price", "revenue"
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bookings that carry their flight's attributes, in one pass over the orders.

    Equal to joining ``bookings`` with ``flights``, without computing both.
    """
    return sales_of(departures(spark, sf_dir))


def sales_of(base: DataFrame) -> DataFrame:
    return _by_cabin(base, *_flight_columns()).select(
        "flight_id", "cabin_class", "passengers", "ticket_price", "revenue",
        "airline", "route", "origin", "destination", "month", "is_cancelled",
    )


def dirty_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw feed: source headers, all text, defects placed by fixed rules.

    ``src_row`` is the file order.
    """
    return feed_of(departures(spark, sf_dir))


def feed_of(departed: DataFrame) -> DataFrame:
    # What the cabins of a flight share is computed once, before they become rows.
    shared = [
        "flight_id", "flight_number", "flight_date", "airline", "origin", "destination", "aircraft",
        "scheduled_departure", "actual_departure", "departure_variance", "is_cancelled", "distance_miles",
    ]
    flights = departed.select(*_flight_columns(), *_cabin_parts("seats"), *_cabin_parts("amount"))
    base = _by_cabin(flights, *map(F.col, shared)).withColumn("k", F.col("flight_id") * 3 + F.col("cabin_no"))
    k, flight = F.col("k"), F.col("flight_id")
    cancelled = F.col("is_cancelled") == 1
    blank = F.lit("")
    lower_if = lambda hit, c: F.when(hit, F.lower(c)).otherwise(c)
    flag = lambda yes, no: F.when(cancelled, yes).otherwise(no)
    no_times = (k % 401 == 7) | (flight % 499 == 3)
    airline = F.initcap("airline")
    origin = lower_if(k % 50 == 8, F.col("origin"))
    fare = F.concat(F.floor("ticket_price").cast("bigint").cast("string"), F.lit(".50"))
    rows = base.select(
        F.when(k % 50 == 11, F.lower("flight_number")).otherwise(F.col("flight_number")).alias("Flight"),
        F.when(k % 33 == 5, F.date_format("flight_date", "MM/dd/yyyy"))
        .otherwise(iso_date(F.col("flight_date")))
        .alias("Date"),
        F.when(k % 99 == 0, F.upper(airline))
        .when(k % 99 == 1, F.lower(airline))
        .when(k % 99 == 2, F.concat(F.lit(" "), airline, F.lit("  ")))
        .otherwise(airline)
        .alias("Airline"),
        origin.alias("Origin"),
        F.when(flight % 997 == 1, F.col("origin"))
        .otherwise(lower_if(k % 50 == 9, F.col("destination")))
        .alias("Destination"),
        F.col("aircraft").alias("Aircraft"),
        F.col("scheduled_departure").alias("Scheduled Departure"),
        F.when(cancelled | (k % 200 == 6) | no_times, blank).otherwise(F.col("actual_departure")).alias("Actual Departure"),
        F.when(cancelled | (k % 67 == 5) | no_times, blank)
        .otherwise(F.col("departure_variance").cast("int").cast("string"))
        .alias("Delay (min)"),
        F.when(flight % 997 == 2, "maybe")
        .when(k % 17 == 0, flag("Y", "N"))
        .when(k % 17 == 1, flag("1", "0"))
        .when(k % 17 == 2, flag("TRUE", "FALSE"))
        .when(k % 17 == 3, flag("yes", "no"))
        .otherwise(flag("Yes", "No"))
        .alias("Cancelled"),
        F.when(k % 100 == 4, blank).otherwise(F.col("distance_miles").cast("string")).alias("Distance (mi)"),
        F.when(k % 41 == 0, F.upper("cabin_class")).otherwise(F.col("cabin_class")).alias("Cabin Class"),
        F.when(k % 125 == 3, blank).otherwise(F.col("passengers").cast("string")).alias("Passengers"),
        F.when(k % 100 == 1, blank)
        .when(k % 500 == 2, F.concat(F.lit("-"), fare))
        .when(k % 20 == 0, F.concat(F.lit("$"), fare))
        .otherwise(fare)
        .alias("Ticket Price"),
        k.alias("k"),
    )
    # A row and its planned copies come out of one pass over the feed.
    once, twice = k % 83 == 7, k % 211 == 9
    listed = lambda *numbers: F.array(*map(F.lit, numbers))
    copies = (
        F.when(once & twice, listed(0, 1, 2)).when(once, listed(0, 1)).when(twice, listed(0, 2)).otherwise(listed(0))
    )
    return (
        rows.withColumn("copy", F.explode(copies))
        .withColumn("Airline", F.when(F.col("copy") == 2, F.upper("Airline")).otherwise(F.col("Airline")))
        .withColumn("src_row", k * 4 + F.col("copy"))
        .select(*K.SOURCE_COLUMNS, "src_row")
    )
