"""The cube of measures: merging, storing by month, slicing with its guard."""

import re
from decimal import Decimal

import pytest
from test_analytics import CANCELLED, bookings_of, flights_of, rows  # noqa: F401
from test_plans import plan

from skyledger import catalog
from skyledger.operators import medians, ranks
from skyledger.plans import metrics, model
from skyledger.plans.cube import Cube
from skyledger.session import fresh_path

SF = "/root/testdata/sf0.001"


@pytest.fixture
def tables(flights_of, bookings_of):  # noqa: F811
    flights = flights_of(
        {}, {}, {"airline": "Red", "is_on_time": 0, "delay_minutes": 70.5, "delay_category": "60-119"}, CANCELLED, {"month": "2025-03"},
        {"month": None, "airline": None}, {"route": None, "delay_minutes": None, "is_on_time": None},
    )
    return flights, model.enrich_bookings(bookings_of(("0", "Economy", 10, 100), ("2", "Business", 5, 50), ("4", "Crew", 1, 7)), flights)


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def shown(flights, sales):
    yield from (metrics.flight_metrics(flights, *keys) for keys in ((), ("airline",), ("month", "route"), ("departure_hour",)))
    yield from (metrics.booking_metrics(sales, *keys) for keys in (("cabin_class",), ("airline", "cabin_class")))
    yield metrics.executive_metrics(flights, sales)
    yield metrics.cancellations(flights)
    yield metrics.delay_distribution(flights)
    yield metrics.top_routes_by_revenue(sales)
    yield metrics.slice_vs_network(flights, sales, metrics.Slice(airlines=("Blue",), cabins=("Economy",)))


def test_cells_show_what_rows_show(tables):
    cube = Cube.of(*tables)
    for of_rows, of_cells in zip(shown(*tables), shown(cube.flights, cube.sales)):
        assert same(of_rows.select(*of_cells.columns), of_cells)


def test_cubes_of_parts_add_up(tables):
    flights, sales = tables
    whole = Cube.of(flights, sales)
    odd = "int(flight_id) % 2 = 1"
    parts = [Cube.of(flights.where(c), sales.where(c)) for c in (odd, f"NOT {odd}")]
    merged = parts[0].merged(parts[1])
    assert merged.flights.schema == whole.flights.schema and merged.sales.schema == whole.sales.schema
    assert same(merged.flights, whole.flights) and same(merged.sales, whole.sales)


def test_stored_months_are_replaced_one_by_one(spark, tables, flights_of, bookings_of):  # noqa: F811
    folder = fresh_path(spark, "cube")
    whole = Cube.of(*tables)
    whole.write(folder)
    stored = Cube.read(spark, folder)
    assert same(stored.flights, whole.flights) and same(stored.sales, whole.sales)
    new = flights_of({"month": "2025-03", "airline": "New"}, {"month": "2025-03", "airline": "New"})
    Cube.of(new, model.enrich_bookings(bookings_of(("0", "Economy", 3, 9)), new)).write(folder, only_its_months=True)
    stored = Cube.read(spark, folder)
    assert rows(stored.flights.where("month = '2025-03'"), "airline", "flights") == [("New", 2)]
    assert rows(stored.sales.where("month = '2025-03'"), "passengers", "revenue") == [(3, Decimal("9.00"))]
    assert same(stored.flights.where("month <> '2025-03'"), whole.flights.where("month <> '2025-03'"))
    assert stored.flights.where("month IS NULL").count() == 1


def test_months_of_a_slice_are_folders_read(spark, tables):
    folder = fresh_path(spark, "cube")
    Cube.of(*tables).write(folder)
    chosen = metrics.Slice(first_month="2025-02").of(Cube.read(spark, folder))
    text = plan(metrics.monthly_flights(chosen.flights))
    filters = re.findall(r"FileScan parquet .*?PartitionFilters: \[([^\]]*)\]", text)
    assert len(filters) == text.count("FileScan parquet") == 3
    assert all(">= 2025-02" in f for f in filters)


def test_cached_cells_are_read_from_memory(tables):
    cube = Cube.of(*tables).cached()
    try:
        text = plan(metrics.airline_delay(cube.flights))
        assert "InMemoryTableScan" in text
    finally:
        assert not cube.released().flights.is_cached


@pytest.mark.parametrize("kind", ["rows", "cells"])
def test_an_empty_selection_stops_whatever_is_computed(tables, kind):
    cube = Cube.of(*tables)
    pair = tables if kind == "rows" else (cube.flights, cube.sales)
    for nothing in (metrics.Slice(airlines=("None",)), metrics.Slice(cabins=("None",))):
        flights, sales = nothing.chosen(*pair)
        for panel in (flights.where("month > '2026'"), metrics.airline_delay(flights), metrics.flight_metrics(flights), metrics.cabin_mix(sales), flights, sales):
            with pytest.raises(Exception, match=metrics.EMPTY):
                panel.collect()
    flights, sales = metrics.Slice(airlines=("Blue",)).chosen(*pair)
    assert flights.count() == pair[0].where("airline = 'Blue'").count()
    assert sales.columns == pair[1].columns and sales.schema == pair[1].schema


@pytest.mark.parametrize("name", [n for n in catalog.QUERIES if n.endswith("_on_slice") or n.startswith("slice_")])
def test_registered_slices_are_guarded(spark, name, monkeypatch):
    monkeypatch.setattr(catalog, "SLICE", metrics.Slice(airlines=("nobody",)))
    with pytest.raises(Exception, match=metrics.EMPTY):
        catalog.QUERIES[name](spark, SF).collect()


def test_quantiles_lie_between_the_values_around(spark):
    for values, part, wanted in (([1, 2, 3, 4], 0.25, 1.75), ([5], 0.75, 5.0), ([1, 1, 1, 9], 0.75, 3.0), ([], 0.5, None), ([None, -4, 2], 0.5, -1.0)):
        df = spark.createDataFrame([(v,) for v in values], "x long")
        assert spark.range(1).select(medians.quantile(df, "x", part)).first()[0] == wanted


def test_ranks_share_places_and_numbers_count_on(spark):
    df = spark.createDataFrame([(v, i) for i, v in enumerate([3, None, 1, 3, 3, 2, None, 1])], "v int, i int").repartition(3)
    ranked = ranks.ranked(df, "v", df.i.asc()).orderBy("i")
    assert [r["rank"] for r in ranked.collect()] == [1, 7, 5, 1, 1, 4, 7, 5]
    numbered = ranks.numbered(df, df.i.desc(), total="n").orderBy("row_no").collect()
    assert [(r.row_no, r.i, r.n) for r in numbered] == [(k + 1, 7 - k, 8) for k in range(8)]
    assert ranks.numbered(df.where("false"), df.i.desc(), total="n").collect() == []
