"""Route distances, calendar expansion and cabin seats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger import constants as K


def great_circle_miles(lat_1: Column, lon_1: Column, lat_2: Column, lon_2: Column) -> Column:
    """Haversine distance of two points in degrees, in whole miles."""
    half = lambda a, b: F.sin((F.radians(b) - F.radians(a)) / 2)
    h = half(lat_1, lat_2) ** 2 + F.cos(F.radians(lat_1)) * F.cos(F.radians(lat_2)) * half(lon_1, lon_2) ** 2
    return F.rint(2 * K.EARTH_RADIUS_MILES * F.asin(F.sqrt(h))).cast("int")


def route_distances(flights: DataFrame, airports: DataFrame) -> DataFrame:
    """Distance of every route flown; ``airports`` has (airport, lat, lon)."""
    routes = flights.select("origin", "destination").distinct()
    end = lambda name: airports.select(
        F.col("airport").alias(name), F.col("lat").alias(f"{name}_lat"), F.col("lon").alias(f"{name}_lon")
    )
    return (
        routes.join(end("origin"), "origin")
        .join(end("destination"), "destination")
        .select(
            "origin",
            "destination",
            great_circle_miles(
                F.col("origin_lat"), F.col("origin_lon"), F.col("destination_lat"), F.col("destination_lon")
            ).alias("miles"),
        )
    )


def expand_calendar(services: DataFrame, first: Column, last: Column) -> DataFrame:
    """Every service on every date between two dates, both included."""
    return services.withColumn("flight_date", F.explode(F.sequence(first, last)))


def _within(first: str, last: str) -> Column:
    return F.col("flight_date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))


def airline_calendar(flights: DataFrame, first: str = K.FIRST_PLAUSIBLE_DATE, last: str = K.LAST_PLAUSIBLE_DATE) -> DataFrame:
    """Flights of each airline on each date of its period, zero where it did not fly.

    Only dates from ``first`` to ``last`` count, so one wrong year does not stretch an airline's period over
    thousands of years; ``outside_period`` counts what that leaves out.
    """
    daily = (
        flights.where(F.col("airline").isNotNull() & _within(first, last))
        .groupBy("airline", "flight_date")
        .agg(F.count(F.lit(1)).alias("flights"))
    )
    period = daily.groupBy("airline").agg(F.min("flight_date").alias("first"), F.max("flight_date").alias("last"))
    spine = expand_calendar(period, F.col("first"), F.col("last")).select("airline", "flight_date")
    return spine.join(daily, ["airline", "flight_date"], "left").withColumn(
        "flights", F.coalesce("flights", F.lit(0))
    )


def outside_period(
    flights: DataFrame, first: str = K.FIRST_PLAUSIBLE_DATE, last: str = K.LAST_PLAUSIBLE_DATE
) -> DataFrame:
    """(airline, flights) whose date is missing or not in the period."""
    within = F.coalesce(_within(first, last), F.lit(False))
    return flights.where(~within).groupBy("airline").agg(F.count(F.lit(1)).alias("flights"))


def cabin_fanout(flights: DataFrame, seats: DataFrame) -> DataFrame:
    """One row per flight and cabin of its aircraft, by a table (aircraft, cabin_class, seats)."""
    return flights.select("flight_id", "aircraft").join(seats, "aircraft")


def most_seated(flights: DataFrame, bookings: DataFrame) -> DataFrame:
    """(aircraft, cabin_class, seats): the most passengers of one flight, where no seat table is known."""
    flown = flights.select("flight_id", "aircraft").join(bookings, "flight_id")
    return flown.groupBy("aircraft", "cabin_class").agg(F.max("passengers").alias("seats"))
