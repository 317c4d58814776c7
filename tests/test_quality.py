from decimal import Decimal

import pytest

from skyledger.plans import model, quality

ROW = {
    "flight_id": "A_20250101", "flight_date": "2025-01-01", "airline": "Blue", "origin": "AAA", "destination": "BBB",
    "cabin_class": "Economy", "cabin_rank": 0, "passengers": 10, "ticket_price": Decimal("9.50"), "distance_miles": 100,
    "is_cancelled": 0, "delay_minutes": 5.0, "revenue": Decimal("95.00"), "src_row": 0,
}
KINDS = (
    "flight_id string, flight_date string, airline string, origin string, destination string, cabin_class string, cabin_rank int, "
    "passengers long, ticket_price decimal(18,2), distance_miles int, is_cancelled int, delay_minutes double, revenue decimal(18,2), src_row long"
)


@pytest.fixture
def rows_of(spark):
    return lambda *rows: spark.createDataFrame([tuple({**ROW, **r}.values()) for r in rows], KINDS)


def found(df):
    return {r["metric"]: r["value"] for r in df.collect() if r["value"]}


def test_clean_rows_pass(rows_of):
    rows = rows_of({}, {"cabin_class": "Business", "cabin_rank": 2})
    assert found(quality.all_checks(rows)) == {}
    quality.raise_if_any(quality.all_checks(rows))


@pytest.mark.parametrize(
    "change, check",
    [
        ({"airline": None}, "required_nulls"),
        ({"cabin_class": "Crew"}, "unknown_cabins"),
        ({"passengers": -1}, "out_of_range"),
        ({"ticket_price": Decimal("0.00")}, "out_of_range"),
        ({"delay_minutes": None}, "operated_without_delay"),
        ({"is_cancelled": 1}, "cancelled_with_passengers"),
    ],
)
def test_each_row_check_fires(rows_of, change, check):
    rows = rows_of({"flight_id": "B"}, {**change})
    assert found(quality.all_checks(rows)) == {check: 1}
    with pytest.raises(quality.DataQualityError, match=check):
        quality.raise_if_any(quality.all_checks(rows))


def test_single_checks_count_the_same(rows_of):
    rows = rows_of({}, {"flight_id": "B", "cabin_class": None, "passengers": None, "is_cancelled": 1, "delay_minutes": None})
    assert found(quality.required_nulls(rows)) == {"cabin_class": 1, "passengers": 1}
    assert quality.unknown_cabins(rows).first()[0] == 1
    assert tuple(quality.out_of_range(rows).first()) == (1, 0)
    assert quality.operated_without_delay(rows).first()[0] == 0
    assert quality.cancelled_with_passengers(rows).first()[0] == 1


def test_duplicate_keys(rows_of):
    rows = rows_of({}, {}, {"cabin_class": "Business"})
    assert [tuple(r) for r in quality.duplicate_keys(rows).collect()] == [("A_20250101", "Economy", 2)]
    assert found(quality.all_checks(rows))["duplicate_keys"] == 1


def test_null_counts_as_a_differing_value(rows_of):
    rows = rows_of({"delay_minutes": None}, {"cabin_class": "Business"}, {"flight_id": "B"}, {"flight_id": "B", "origin": "ZZZ", "cabin_class": "Business"})
    assert found(quality.inconsistent_flights(rows)) == {"delay_minutes": 1, "origin": 1}
    assert found(quality.all_checks(rows))["inconsistent_flights"] == 2


def test_all_null_attribute_is_consistent(rows_of):
    rows = rows_of({"delay_minutes": None}, {"delay_minutes": None, "cabin_class": "Business"})
    assert found(quality.inconsistent_flights(rows)) == {}


def test_primary_keys_and_orphans(spark, rows_of):
    flights = spark.createDataFrame([("A",), ("A",), ("B",), (None,)], "flight_id string")
    bookings = model.split_bookings(rows_of({"flight_id": "A"}, {"flight_id": "A"}, {"flight_id": "X"}))
    keys = {r["table_name"]: (r["duplicate_keys"], r["null_keys"]) for r in quality.primary_key_violations(flights, bookings).collect()}
    assert keys == {"flights": (1, 1), "bookings": (1, 0)}
    assert [r["flight_id"] for r in quality.orphan_bookings(flights, bookings).collect()] == ["X"]


def test_reconciliation_reports_and_raises(spark):
    ours = spark.createDataFrame([(10, 100, 0.5, 0.1, 12.0, 1000.0)], list(quality.TOLERANCES))
    near = spark.createDataFrame([(10, 100, 0.50005, 0.1, 12.01, 1000.9)], list(quality.TOLERANCES))
    far = spark.createDataFrame([(10, 101, 0.5, 0.1, 12.0, 1000.0)], list(quality.TOLERANCES))
    quality.raise_if_apart(quality.reconcile_headline(ours, near))
    with pytest.raises(quality.DataQualityError, match="total_passengers"):
        quality.raise_if_apart(quality.reconcile_headline(ours, far))
    left = spark.createDataFrame([("A", 0.5), ("B", 0.6)], "airline string, on_time_rate double")
    right = spark.createDataFrame([("A", 0.7), ("C", 0.6)], "airline string, on_time_rate double")
    agrees = {r["airline"]: r["agrees"] for r in quality.reconcile_by_airline(left, right).collect()}
    assert agrees == {"A": False, "B": False, "C": False}
