"""KPI queries, metrics, panels and insights on hand-made tables."""

from decimal import Decimal

import pytest

from skyledger.plans import geo, insights, kpis, metrics, model

FLIGHT = {
    "flight_id": "1", "month": "2025-01", "airline": "Blue", "origin": "AAA", "destination": "BBB", "route": "AAA-BBB",
    "departure_hour": 8, "time_of_day": "Morning", "delay_minutes": 0.0, "delay_category": "On time (<15)", "is_cancelled": 0,
    "is_on_time": 1, "distance_miles": 100, "passengers": 10, "revenue": Decimal("100.00"), "aircraft": "E175",
}
KINDS = (
    "flight_id string, month string, airline string, origin string, destination string, route string, departure_hour int, "
    "time_of_day string, delay_minutes double, delay_category string, is_cancelled int, is_on_time int, distance_miles int, "
    "passengers long, revenue decimal(18,2), aircraft string"
)
CANCELLED = {"is_cancelled": 1, "is_on_time": None, "delay_minutes": None, "delay_category": "Cancelled", "passengers": 0, "revenue": Decimal("0.00")}


@pytest.fixture
def flights_of(spark):
    def build(*rows):
        numbered = [{**FLIGHT, "flight_id": str(i), **r} for i, r in enumerate(rows)]
        return spark.createDataFrame([tuple(r.values()) for r in numbered], KINDS)

    return build


@pytest.fixture
def bookings_of(spark):
    kinds = "flight_id string, cabin_class string, passengers long, ticket_price decimal(18,2), revenue decimal(18,2)"

    def build(*rows):
        return spark.createDataFrame([(f, c, p, Decimal(1), Decimal(r)) for f, c, p, r in rows], kinds)

    return build


def rows(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


def test_rates_are_over_operated_flights_and_division_by_zero_is_null(flights_of):
    flights = flights_of(CANCELLED, CANCELLED)
    row = kpis.executive_kpis(flights.withColumn("flight_date", flights.month.cast("date")), None).first()
    assert (row["total_flights"], row["cancellation_rate"], row["on_time_rate"], row["avg_fare"]) == (2, 1.0, None, None)


def test_severe_and_disruption_rates_have_different_denominators(flights_of):
    flights = flights_of(
        CANCELLED, {"delay_minutes": 60.0, "is_on_time": 0}, {"delay_minutes": 59.0, "is_on_time": 0}, {"origin": "BBB", "destination": "AAA"}
    )
    assert rows(kpis.airline_performance(flights, None), "severe_delay_rate") == [(0.3333,)]
    found = {r["airport"]: r["disruption_rate"] for r in kpis.airport_performance(flights, None).collect()}
    assert found == {"AAA": 0.6667, "BBB": 0.0}


def test_airport_needs_departures_and_arrivals(flights_of):
    flights = flights_of({"origin": "AAA", "destination": "BBB"}, {"origin": "BBB", "destination": "CCC"}, {"origin": None, "destination": "BBB"})
    assert rows(kpis.airport_performance(flights, None), "airport", "departures", "arrivals") == [("BBB", 1, 2)]


def test_rank_leaves_gaps_on_ties(flights_of):
    flights = flights_of({"airline": "A"}, {"airline": "B"}, {"airline": "C", "is_on_time": 0, "delay_minutes": 20.0})
    assert rows(kpis.airline_performance(flights, None), "airline", "on_time_rank") == [("A", 1), ("B", 1), ("C", 3)]


def test_route_ranks_and_distinct_airlines(flights_of):
    flights = flights_of({"airline": "A"}, {"airline": "B"}, {"airline": "B"}, {"route": "X-Y", "origin": "X", "destination": "Y", "passengers": 99})
    found = rows(kpis.route_performance(flights, None), "route", "airlines", "flights", "revenue_rank", "passenger_rank")
    assert found == [("AAA-BBB", 2, 3, 1, 2), ("X-Y", 1, 1, 2, 1)]


def test_breakdown_lists_only_shared_routes(flights_of):
    flights = flights_of({"airline": "A"}, {"airline": "B"}, {"route": "X-Y"}, {"route": None, "airline": "A"}, {"route": None, "airline": "B"})
    assert rows(kpis.route_airline_breakdown(flights, None), "route", "airline") == [("AAA-BBB", "A"), ("AAA-BBB", "B")]


def test_delayed_routes_floor(flights_of):
    flights = flights_of({}, {}, {"route": "X-Y", "delay_minutes": 90.0})
    assert rows(kpis.top_delayed_routes(flights, None, min_flights=2), "route") == [("AAA-BBB",)]


def test_seasonality_puts_unknown_winter_first(flights_of):
    flights = flights_of({"origin": "AAA"}, {"origin": "ZZZ", "month": "2025-07"})
    found = rows(kpis.airport_seasonality(flights, None), "airport", "winter_on_time_rate", "summer_on_time_rate")
    assert found == [("ZZZ", None, 1.0), ("AAA", 1.0, None)]


def test_high_demand_quartile_below_network(flights_of):
    late = {"is_on_time": 0, "delay_minutes": 20.0}
    flights = flights_of(*[{"route": f"R{i}", "passengers": 100 - i, **(late if i == 0 else {})} for i in range(8)])
    assert rows(kpis.high_demand_poor_performance(flights, None), "route", "on_time_gap") == [("R0", -0.875)]


def test_booking_queries_join_flights_or_use_what_is_there(flights_of, bookings_of):
    flights = flights_of({}, {"month": "2025-02"}, CANCELLED)
    bookings = bookings_of(("0", "Economy", 10, 100), ("0", "Business", 2, 300), ("1", "Economy", 24, 100), ("2", "Economy", 0, 0))
    sales = model.enrich_bookings(bookings, flights, "is_cancelled")
    for query in (kpis.cabin_class_summary, kpis.airline_revenue, kpis.monthly_passengers, kpis.top_revenue_routes):
        assert sorted(map(str, query(flights, bookings).collect())) == sorted(map(str, query(flights, sales).collect()))
    assert rows(kpis.cabin_class_summary(flights, bookings), "cabin_class", "revenue_share") == [("Economy", 0.4), ("Business", 0.6)]
    assert rows(kpis.monthly_passengers(flights, bookings), "month", "economy", "passenger_mom_change") == [("2025-01", 10, None), ("2025-02", 24, 1.0)]
    assert rows(kpis.top_revenue_routes(flights, bookings), "revenue_per_flight") == [(166.67,)]
    assert rows(kpis.airline_revenue(flights, bookings), "business_revenue_share") == [(0.6,)]


# --- metrics and panels -----------------------------------------------------------------


def test_metrics_of_nothing(flights_of, bookings_of):
    flights, bookings = flights_of({}).limit(0), bookings_of(("0", "Economy", 1, 1)).limit(0)
    assert set(metrics.flight_metrics(flights).first()) == {None}
    row = metrics.executive_metrics(flights, bookings).first()
    assert (row["total_flights"], row["total_passengers"], row["avg_fare"]) == (0, 0, None)
    with pytest.raises(metrics.EmptySlice):
        metrics.require_rows(flights, bookings)


def test_missing_keys_are_left_out(flights_of):
    assert rows(metrics.flight_metrics(flights_of({}, {"airline": None}), "airline"), "airline", "flights") == [("Blue", 1)]


def test_slice_of_everything_is_the_network(flights_of, bookings_of):
    flights = flights_of({}, {"airline": "Red", "is_on_time": 0, "delay_minutes": 70.0}, CANCELLED)
    sales = model.enrich_bookings(bookings_of(("0", "Economy", 10, 100), ("1", "Business", 5, 50)), flights)
    row = metrics.slice_vs_network(flights, sales, metrics.Slice()).first()
    assert row["on_time_rate_pp"] == row["cancellation_rate_pp"] == row["avg_delay_delta"] == 0
    assert (row["flights"], row["revenue"]) == (row["network_flights"], row["network_revenue"]) == (3, 150.0)


def test_cabins_select_bookings_only(flights_of, bookings_of):
    flights = flights_of({}, {"airline": "Red"}, {"month": "2025-03"})
    sales = model.enrich_bookings(bookings_of(("0", "Economy", 10, 100), ("0", "Business", 5, 50), ("2", "Business", 5, 50)), flights)
    chosen = metrics.Slice(last_month="2025-02", airlines=("Blue",), cabins=("Business",))
    some_flights, some_sales = chosen.apply(flights, sales)
    assert (some_flights.count(), some_sales.count()) == (1, 1)
    row = metrics.slice_vs_network(flights, sales, chosen).first()
    assert (row["flights"], row["passengers"], row["network_passengers"]) == (1, 5, 20)


def test_month_labels_depend_on_the_years(flights_of):
    one = metrics.month_labels(flights_of({}, {"month": "2025-07"}))
    two = metrics.month_labels(flights_of({}, {"month": "2024-07"}))
    assert sorted(rows(one, "month_label")) == [("Jan",), ("Jul",)]
    assert sorted(rows(two, "month_label")) == [("Jan 2025",), ("Jul 2024",)]


def test_filter_values(flights_of):
    found = rows(metrics.filter_values(flights_of({}, {"airline": None, "month": "2025-02"})), "field", "value")
    assert found == [("airline", "Blue"), ("destination", "BBB"), ("month", "2025-01"), ("month", "2025-02"), ("origin", "AAA")]


def test_delay_distribution_shows_absent_categories(flights_of):
    found = rows(metrics.delay_distribution(flights_of({}, {}, {}, CANCELLED)), "delay_category", "flights", "share")
    assert found[0] == ("On time (<15)", 3, 0.75) and found[1] == ("15-29", 0, 0.0) and found[6] == ("Cancelled", 1, 0.25)
    assert len(found) == 7


def test_adaptive_floor_of_delayed_routes(flights_of):
    flights = flights_of(*[{"route": "A"}] * 25, *[{"route": "B", "delay_minutes": 30.0}] * 21, *[{"route": "C", "delay_minutes": 99.0}] * 19)
    assert rows(metrics.delayed_routes(flights), "route", "min_flights") == [("B", 20), ("A", 20)]


def test_demand_panel_needs_four_routes_and_uses_the_upper_quartile(flights_of):
    late = {"is_on_time": 0, "delay_minutes": 20.0}
    routes = [{"route": f"R{i}", "passengers": i, **(late if i == 4 else {})} for i in range(1, 5) for _ in range(20)]
    found = rows(metrics.demand_vs_punctuality(flights_of(*routes)), "route", "busy_from", "flagged")
    assert found[0] == ("R4", 65.0, True) and [f[2] for f in found[1:]] == [False] * 3
    assert metrics.demand_vs_punctuality(flights_of(*routes[:60])).count() == 0


def test_cabin_mix_order_and_business_share(flights_of, bookings_of):
    flights = flights_of({})
    sales = model.enrich_bookings(bookings_of(("0", "Business", 1, 75), ("0", "Economy", 0, 25), ("0", "Crew", 1, 0)), flights)
    assert rows(metrics.cabin_mix(sales), "cabin_class", "business_share", "avg_ticket_price") == [("Economy", 0.75, None), ("Business", 0.75, 75.0)]


# --- insights ---------------------------------------------------------------------------


def all_results(flights, bookings):
    dated = flights.withColumn("flight_date", flights.month.cast("date"))
    return kpis.run_all(dated, bookings, top_delayed_routes={"min_flights": 1})


def test_insights_leave_out_risky_routes_when_there_are_none(flights_of, bookings_of):
    flights = flights_of({}, {"origin": "BBB", "destination": "AAA", "route": "BBB-AAA", "departure_hour": 19})
    bookings = bookings_of(("0", "Economy", 10, 100), ("1", "Business", 10, 100))
    found = rows(insights.all_insights(all_results(flights, bookings)), "insight_no", "kind")
    assert [n for n, _ in found] == [1, 2, 3, 4, 6, 7, 8]


def test_insights_name_the_biggest_risky_routes(flights_of, bookings_of):
    late = {"is_on_time": 0, "delay_minutes": 20.0}
    flights = flights_of(
        *[{"route": f"R{i}", "passengers": 1000 - i, "departure_hour": 19, **late} for i in range(4)],
        *[{"route": f"S{i}", "passengers": 1, "origin": "BBB", "destination": "AAA"} for i in range(12)],
    )
    results = all_results(flights, bookings_of(("0", "Economy", 10, 100)))
    row = insights.risky_routes(results["high_demand_poor_performance"], results["executive_kpis"]).first()
    assert (row["routes"], row["biggest"], row["network_on_time_rate"]) == (4, "R0, R1, R2", 0.75)
    text = dict(rows(insights.all_insights(results), "insight_no", "text"))
    assert "R0 with 1,000 passengers at 0.0% on time; R1" in text[5]
    assert text[6].startswith("Departures before 09:00 average 0.0 min") and "20.0 min (0.0% on time)" in text[6]


def test_extremes_break_ties_by_name(flights_of, bookings_of):
    flights = flights_of({"airline": "A"}, {"airline": "B"}, {"airline": "C"})
    row = insights.airline_extremes(kpis.airline_performance(flights, None)).first()
    assert (row["worst_airline"], row["best_airline"]) == ("A", "C")


# --- geography and calendar -------------------------------------------------------------


def test_great_circle(spark):
    from pyspark.sql import functions as F

    one = spark.range(1).select(geo.great_circle_miles(F.lit(40.64), F.lit(-73.78), F.lit(33.94), F.lit(-118.41)).alias("d")).first()
    assert 2470 <= one["d"] <= 2480


def test_calendar_has_every_day(flights_of):
    from pyspark.sql import functions as F

    flights = flights_of({"month": "2025-01"}, {"month": "2025-02"}).withColumn("flight_date", F.to_date(F.concat("month", F.lit("-01"))))
    found = geo.airline_calendar(flights)
    assert (found.count(), found.agg(F.sum("flights")).first()[0]) == (32, 2)


def test_fanout_follows_the_aircraft(spark, flights_of):
    seats = spark.createDataFrame([("E175", "Economy", 64), ("E175", "Business", 12), ("A320", "Economy", 126)], "aircraft string, cabin_class string, seats int")
    found = rows(geo.cabin_fanout(flights_of({}, {"aircraft": "A320"}, {"aircraft": "??"}), seats), "flight_id", "cabin_class", "seats")
    assert sorted(found) == [("0", "Business", 12), ("0", "Economy", 64), ("1", "Economy", 126)]
