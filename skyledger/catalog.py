"""Registered queries: each takes (spark, sf_dir) and returns a lazy DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger import constants as K
from skyledger.functions import text as X
from skyledger.operators.rows import metric_rows
from skyledger.plans import cleaning as C
from skyledger.plans import geo, insights, kpis, metrics, model, pipeline, quality, reports
from skyledger.plans.cube import Cube
from skyledger.session import fresh_path, stage, stage_all
from skyledger.sources import bridge, feed, outputs

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# The registered slice: two years, two airlines, two cabins.
SLICE = metrics.Slice(
    first_month="1996-01", last_month="1997-12", airlines=("BUILDING", "MACHINERY"), cabins=("Economy", "Business")
)


def portable(df: DataFrame) -> DataFrame:
    """Dates as ISO text and money as double, so results compare across engines."""
    shown = {
        T.DateType: lambda c: F.date_format(c, "yyyy-MM-dd").alias(c),
        T.DecimalType: lambda c: F.col(c).cast("double").alias(c),
    }
    return df.select(*[shown.get(type(f.dataType), F.col)(f.name) for f in df.schema.fields])


def register(name: str | None = None):
    def add(query: Query) -> Query:
        QUERIES[name or query.__name__] = lambda spark, sf: portable(query(spark, sf))
        return query

    return add


def _chain(df: DataFrame, *steps) -> DataFrame:
    return reduce(lambda d, step: d.transform(step), steps, df)


# --- sources and sinks ------------------------------------------------------------


@register()
def dirty_feed(spark, sf):
    return bridge.dirty_feed(spark, sf)


@register()
def src_csv_all_text(spark, sf):
    path = fresh_path(spark, "raw")
    outputs.write_csv(bridge.dirty_feed(spark, sf).drop("src_row"), path)
    return feed.read_feed(spark, path).drop("src_row")


@register()
def src_rename(spark, sf):
    return feed.rename(bridge.dirty_feed(spark, sf))


@register()
def src_scan_flights(spark, sf):
    return bridge.flights(spark, sf)


@register()
def src_param_sql(spark, sf):
    return pipeline.run_sql(
        spark,
        "SELECT airline, count(*) AS flights, sum(passengers) AS passengers FROM {flights} "
        "WHERE month BETWEEN :first AND :last GROUP BY airline",
        {"first": "1996-01", "last": "1997-12"},
        flights=bridge.flights(spark, sf),
    )


@register()
def src_bookings_enriched(spark, sf):
    departed = bridge.staged_departures(spark, sf)
    return model.enrich_bookings(bridge.bookings_of(departed), bridge.flights_of(departed))


@register()
def src_bookings_enriched_in_buckets(spark, sf):
    departed = bridge.staged_departures(spark, sf)
    flights, bookings = model.co_located(bridge.flights_of(departed), bridge.bookings_of(departed))
    return model.enrich_bookings(bookings, flights)


@register()
def src_csv_malformed(spark, sf):
    """Counts of malformed rows of a feed whose lines were cut short or carried on, as a read that goes on finds them."""
    path = fresh_path(spark, "raw")
    names = [f"`{c}`" for c in K.SOURCE_COLUMNS]
    rows = bridge.dirty_feed(spark, sf)
    line = F.concat_ws(",", *[F.coalesce(F.col(n), F.lit("")) for n in names])
    few = F.concat_ws(",", *[F.coalesce(F.col(n), F.lit("")) for n in names[:3]])
    lines = rows.select(F.when(F.col("src_row") % 97 == 5, few).when(F.col("src_row") % 89 == 3, F.concat(line, F.lit(",more"))).otherwise(line))
    # One column whose name is the header line; nothing is quoted.
    plain = {"header": True, "sep": "\x01", "quote": "\0", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    lines.toDF(",".join(K.SOURCE_COLUMNS)).write.options(**plain).csv(path)
    raw = feed.read_feed(spark, path, strict=False)
    return raw.groupBy("problem").agg(F.count(F.lit(1)).alias("rows"), F.count("Airline").alias("airlines"), F.count("`Ticket Price`").alias("prices"))


def _text_id(df: DataFrame) -> DataFrame:
    return df.withColumn("flight_id", F.col("flight_id").cast("string"))


def _stored_model(spark, sf, departed: DataFrame | None = None):
    folder = fresh_path(spark, "model")
    departed = bridge.staged_departures(spark, sf) if departed is None else departed
    flights, bookings = _text_id(bridge.flights_of(departed)), _text_id(bridge.bookings_of(departed))
    model.write_model(flights, bookings.withColumn("ticket_price", F.col("ticket_price").cast(model.CENTS)), folder)
    return model.read_model(spark, folder)


@register()
def sink_star_model(spark, sf):
    flights, _ = _stored_model(spark, sf)
    return flights


@register()
def sink_csv_roundtrip(spark, sf):
    path = fresh_path(spark, "bookings")
    outputs.write_csv(_text_id(bridge.bookings(spark, sf)), path)
    return outputs.read_csv(spark, path, model.schema(model.BOOKING_LAYOUT))


@register()
def sink_json_report(spark, sf):
    path = fresh_path(spark, "report")
    outputs.write_report_json(_cleaned(spark, sf).report, path)
    return metric_rows(outputs.read_report_json(spark, path), K.REPORT_COUNTERS, "bigint")


def _results(flights, bookings):
    return kpis.run_all(flights, bookings)


@register()
def sink_kpi_tables(spark, sf):
    """Every value of every result as it stands in the files, with its place in the result's order."""
    folder = fresh_path(spark, "kpis")
    results = _results(*_stored_model(spark, sf))
    outputs.write_tables(results, folder)
    found = [
        outputs.read_cells(spark, f"{folder}/{name}", table.columns).select(F.lit(name).alias("table_name"), "*")
        for name, table in results.items()
    ]
    return reduce(DataFrame.unionByName, found)


@register()
def sink_insights_text(spark, sf):
    path = fresh_path(spark, "insights")
    outputs.write_insights(insights.all_insights(stage_all(_results(*_stored_model(spark, sf)))), path)
    return spark.read.text(path)


def _written_report(spark, sf):
    """The report's tables and the folder they were written to."""
    folder = fresh_path(spark, "report")
    departed = bridge.staged_departures(spark, sf)
    small = stage_all(_results(*_stored_model(spark, sf, departed)))
    tables = small, insights.all_insights(small), C.clean(bridge.feed_of(departed)).report
    pipeline.write_report(*tables, folder)
    return reports.report_tables(*tables), folder


@register()
def mart_report_index(spark, sf):
    return reports.read_index(spark, _written_report(spark, sf)[1])


@register()
def mart_report_cells(spark, sf):
    tables, folder = _written_report(spark, sf)
    return reports.read_cells(spark, folder, tables)


# --- cleaning steps ---------------------------------------------------------------


def _stripped(spark, sf):
    return _chain(bridge.dirty_feed(spark, sf), feed.rename, C.strip_text)


def _standard(spark, sf):
    return _stripped(spark, sf).transform(C.standardise_case)


def _typed(spark, sf):
    return _standard(spark, sf).transform(C.parse_types)


def _first(spark, sf):
    return _stripped(spark, sf).transform(C.keep_first)


def _repaired(spark, sf):
    return _chain(_first(spark, sf), C.flag_invalid, C.repair_times)


def _cleaned(spark, sf) -> C.Cleaned:
    return C.clean(bridge.dirty_feed(spark, sf))


@register()
def clean_strip_empty(spark, sf):
    return _stripped(spark, sf)


@register()
def clean_exact_dedup(spark, sf):
    return _stripped(spark, sf).transform(C.drop_exact_copies)


@register()
def clean_case_standardise(spark, sf):
    return _standard(spark, sf).select("src_row", "airline", "origin", "destination", "flight_number", "cabin_class")


@register()
def clean_mixed_dates(spark, sf):
    return _typed(spark, sf).select("src_row", "flight_date")


@register()
def clean_flag_map(spark, sf):
    return _typed(spark, sf).select("src_row", "is_cancelled")


@register()
def clean_currency(spark, sf):
    return _typed(spark, sf).select("src_row", "ticket_price", F.col("had_symbol").cast("int").alias("had_symbol"))


@register()
def clean_numeric_coerce(spark, sf):
    return _typed(spark, sf).select("src_row", "departure_variance", "distance_miles", "passengers")


@register()
def clean_key_dedup(spark, sf):
    return _first(spark, sf).select(*C.ROW_KEY, "src_row", "airline", "raw_rows", "distinct_rows", "symbol_rows")


@register()
def clean_invalid_price(spark, sf):
    return _first(spark, sf).transform(C.flag_invalid).select(
        "src_row", "ticket_price", F.col("price_invalid").cast("int").alias("price_invalid")
    )


@register()
def clean_invalid_rows(spark, sf):
    return (
        _first(spark, sf).transform(C.flag_invalid).where("is_usable")
        .select("src_row", "origin", "destination", "is_cancelled")
    )


@register()
def clean_hhmm_minutes(spark, sf):
    return _stripped(spark, sf).select(
        "src_row",
        X.clock_minutes(F.col("scheduled_departure")).alias("scheduled_minutes"),
        X.clock_minutes(F.col("actual_departure")).alias("actual_minutes"),
    )


@register()
def clean_delay_from_times(spark, sf):
    return _repaired(spark, sf).where("is_usable").select(
        "src_row", "departure_variance", F.col("delay_derived").cast("int").alias("delay_derived")
    )


@register()
def clean_rebuild_actual(spark, sf):
    return _repaired(spark, sf).where("is_usable").select(
        "src_row", "actual_departure", F.col("actual_rebuilt").cast("int").alias("actual_rebuilt")
    )


@register()
def clean_sibling_borrow(spark, sf):
    c = _cleaned(spark, sf)
    return C.borrow_delay(c.prepared, c.donors).select("src_row", *C.FLIGHT_KEY, "is_cancelled", "departure_variance")


@register()
def clean_drop_unrecoverable(spark, sf):
    return _cleaned(spark, sf).settled.select("src_row", *C.ROW_KEY)


@register()
def clean_cancelled_nulls(spark, sf):
    return _cleaned(spark, sf).settled.select("src_row", "is_cancelled", "departure_variance", "actual_departure")


def _imputed(spark, sf, measure: str) -> DataFrame:
    settled = _cleaned(spark, sf).settled
    medians = C.typical_values(settled, (measure,))
    return C.impute(settled, medians, (measure,)).select(
        "src_row", measure, F.col(f"{measure}_missing").cast("int").alias("was_missing")
    )


@register()
def impute_distance_median(spark, sf):
    return _imputed(spark, sf, "distance_miles")


@register()
def impute_passengers_median(spark, sf):
    return _imputed(spark, sf, "passengers")


@register()
def impute_price_median(spark, sf):
    return _imputed(spark, sf, "ticket_price")


def _derived(step, *columns: str) -> Query:
    return lambda spark, sf: _cleaned(spark, sf).settled.transform(step).select("src_row", *columns)


for _name, _query in {
    "derive_keys": _derived(C.derive_keys, "flight_id", "month", "day_of_week", "route"),
    "derive_time_of_day": _derived(C.derive_delay, "departure_hour", "time_of_day"),
    "derive_delay_floor": _derived(C.derive_delay, "departure_variance", "delay_minutes"),
    "derive_on_time": _derived(C.derive_delay, "is_cancelled", "is_on_time"),
    "derive_delay_category": _derived(C.derive_delay, "delay_minutes", "delay_category"),
    "derive_cabin_order": _derived(
        lambda rows: C.in_report_order(rows.transform(C.derive_keys)),
        "flight_date", "scheduled_departure", "flight_number", "cabin_class", "cabin_rank",
    ),
}.items():
    register(_name)(_query)


@register()
def derive_revenue(spark, sf):
    return _cleaned(spark, sf).rows.select("src_row", "passengers", "ticket_price", "revenue")


@register()
def clean_pipeline(spark, sf):
    return _cleaned(spark, sf).rows


@register()
def clean_report(spark, sf):
    return _cleaned(spark, sf).report


# --- model and checks ---------------------------------------------------------------


@register()
def model_flights(spark, sf):
    return model.first_rows(_cleaned(spark, sf).rows)


@register()
def model_flight_totals(spark, sf):
    return model.flight_totals(_cleaned(spark, sf).rows)


@register()
def model_bookings(spark, sf):
    return model.split_bookings(_cleaned(spark, sf).rows)


def _before_and_after(check) -> Query:
    """A check on the feed as delivered and on the clean rows."""

    def both(spark, sf):
        cleaned = _cleaned(spark, sf)
        found = [
            check(rows).select(F.lit(label).alias("stage"), "*")
            for label, rows in (("delivered", cleaned.delivered), ("clean", cleaned.rows))
        ]
        return found[0].unionByName(found[1])

    return both


for _name, _check in {
    "check_required_nulls": quality.required_nulls,
    "check_unique_key": quality.duplicate_keys,
    "check_domain": quality.unknown_cabins,
    "check_ranges": quality.out_of_range,
    "check_operated_delay": quality.operated_without_delay,
    "check_cancelled_zero": quality.cancelled_with_passengers,
    "check_consistent_attrs": quality.inconsistent_flights,
    "check_all": quality.all_checks,
    "check_all_while_writing": lambda rows: quality.written_with_checks(rows, "checked")[1],
}.items():
    register(_name)(_before_and_after(_check))


@register()
def check_pk(spark, sf):
    rows = _cleaned(spark, sf).rows
    return quality.primary_key_violations(model.split_flights(rows), model.split_bookings(rows))


@register()
def check_fk_orphans(spark, sf):
    """Delivered bookings whose flight did not survive cleaning."""
    cleaned = _cleaned(spark, sf)
    return quality.orphan_bookings(model.split_flights(cleaned.rows), model.split_bookings(cleaned.delivered))


@register()
def check_orphans_in_buckets(spark, sf):
    """The same orphans from tables that are stored in the same buckets: no shuffle in the check."""
    cleaned = _cleaned(spark, sf)
    flights, delivered = model.split_flights(cleaned.rows), model.split_bookings(cleaned.delivered)
    return quality.orphan_bookings(*model.co_located(flights, delivered))


@register()
def check_check01(spark, sf):
    return quality.flight_constraints(model.split_flights(_cleaned(spark, sf).rows))


@register()
def reconcile_headline(spark, sf):
    flights = bridge.flights(spark, sf)
    return quality.reconcile_headline(
        metrics.executive_metrics(flights, bridge.bookings(spark, sf)), kpis.executive_kpis(flights, None)
    )


@register()
def reconcile_by_airline(spark, sf):
    flights = bridge.flights(spark, sf)
    return quality.reconcile_by_airline(
        metrics.flight_metrics(flights, "airline"), kpis.airline_performance(flights, None)
    )


# --- named queries --------------------------------------------------------------------


def _result(spark, sf, name: str) -> DataFrame:
    """A named query on the one table it reads; sales carry what booking queries need of a flight."""
    if name in kpis.BOOKING_QUERIES:
        return kpis.KPI_QUERIES[name](None, bridge.sales(spark, sf))
    return kpis.KPI_QUERIES[name](bridge.flights(spark, sf), None)


def _kpi(name: str) -> Query:
    return lambda spark, sf: _result(spark, sf, name)


for _name in kpis.KPI_QUERIES:
    register(_name)(_kpi(_name))


@register()
def top_delayed_routes_from_20(spark, sf):
    """The same query with its floor as a parameter."""
    return kpis.KPI_QUERIES["top_delayed_routes"](bridge.flights(spark, sf), None, min_flights=20)


# --- metric layer and panels ------------------------------------------------------------


def _new_cube(spark, sf) -> Cube:
    return Cube.of(bridge.flights(spark, sf), bridge.sales(spark, sf))


_CUBES: dict[tuple[str, str], Cube] = {}


def _cube(spark, sf) -> Cube:
    """The stored cube of these tables: built by the first panel of a session, read by all of them."""
    key = spark.sparkContext.applicationId, sf
    if key not in _CUBES:
        folder = fresh_path(spark, "cube")
        departed = bridge.staged_departures(spark, sf)
        Cube.of(bridge.flights_of(departed), bridge.sales_of(departed)).write(folder)
        _CUBES[key] = Cube.read(spark, folder)
    return _CUBES[key]


@register()
def cube_flights(spark, sf):
    return _new_cube(spark, sf).flights


@register()
def cube_sales(spark, sf):
    return _new_cube(spark, sf).sales


@register()
def cube_by_month_folders(spark, sf):
    """A cube stored without the last year, whose months are then written once more with all of that year's rows."""
    flights, sales = bridge.flights(spark, sf), bridge.sales(spark, sf)
    folder = fresh_path(spark, "cube")
    early, late = metrics.Slice(last_month="1997-12"), metrics.Slice(first_month="1997-07")
    Cube.of(*early.apply(flights, sales)).write(folder)
    Cube.of(*late.apply(flights, sales)).write(folder, only_its_months=True)
    return metrics.monthly_flights(Cube.read(spark, folder).flights)


def _on_flights(build, *args) -> Query:
    return lambda spark, sf: build(_cube(spark, sf).flights, *args)


def _on_bookings(build, *args) -> Query:
    return lambda spark, sf: build(_cube(spark, sf).sales, *args)


for _name, _query in {
    "metric_flights_global": _on_flights(metrics.flight_metrics),
    "metric_flights_by_airline": _on_flights(metrics.flight_metrics, "airline"),
    "metric_flights_by_month": _on_flights(metrics.flight_metrics, "month"),
    "metric_bookings_by_cabin": _on_bookings(metrics.booking_metrics, "cabin_class"),
    "month_labels": _on_flights(metrics.month_labels),
    "filter_values": _on_flights(metrics.filter_values),
    "panel_airline_on_time": _on_flights(metrics.airline_on_time),
    "panel_airport_delay": _on_flights(metrics.airport_delay),
    "panel_airline_delay": _on_flights(metrics.airline_delay),
    "panel_delayed_routes_adaptive": _on_flights(metrics.delayed_routes),
    "panel_cancellations": _on_flights(metrics.cancellations),
    "panel_delay_distribution": _on_flights(metrics.delay_distribution),
    "panel_hour_profile": _on_flights(metrics.hour_profile),
    "panel_demand_vs_punctuality": _on_flights(metrics.demand_vs_punctuality),
    "panel_cabin_mix": _on_bookings(metrics.cabin_mix),
    "panel_top_routes_passengers": _on_bookings(metrics.top_routes_by_passengers),
    "panel_airline_revenue": _on_bookings(metrics.airline_revenue),
    "panel_fare_airline_cabin": _on_bookings(metrics.fare_by_airline_and_cabin),
    "panel_top_routes_revenue": _on_bookings(metrics.top_routes_by_revenue),
    "panel_monthly_flights": _on_flights(metrics.monthly_flights),
    "panel_monthly_passengers": _on_bookings(metrics.monthly_passengers),
    "panel_monthly_cabin": _on_bookings(metrics.monthly_cabins),
}.items():
    register(_name)(_query)


@register()
def metric_executive(spark, sf):
    cube = _cube(spark, sf)
    return metrics.executive_metrics(cube.flights, cube.sales)


@register()
def slice_filter(spark, sf):
    """The chosen sales themselves, so rows and not cells."""
    _, chosen = SLICE.chosen(bridge.flights(spark, sf), bridge.sales(spark, sf))
    return chosen.drop("is_cancelled")


@register()
def slice_flights(spark, sf):
    chosen, _ = SLICE.chosen(bridge.flights(spark, sf), bridge.sales(spark, sf))
    return chosen


@register()
def slice_vs_network(spark, sf):
    cube = _cube(spark, sf)
    return metrics.slice_vs_network(*[metrics.guarded(c, *SLICE.apply(cube.flights, cube.sales)) for c in (cube.flights, cube.sales)], SLICE)


def _on_slice(build) -> Query:
    """A panel on the chosen cells, with the month labels of the whole network."""

    def sliced(spark, sf):
        cube = _cube(spark, sf)
        chosen = SLICE.of(cube)
        return build(chosen.flights, chosen.sales, metrics.month_labels(cube.flights))

    return sliced


for _name, _query in {
    "panel_airline_delay_on_slice": _on_slice(lambda flights, sales, labels: metrics.airline_delay(flights)),
    "panel_fare_airline_cabin_on_slice": _on_slice(lambda flights, sales, labels: metrics.fare_by_airline_and_cabin(sales)),
    "panel_monthly_passengers_on_slice": _on_slice(lambda flights, sales, labels: metrics.monthly_passengers(sales, labels)),
    "panel_delayed_routes_on_slice": _on_slice(lambda flights, sales, labels: metrics.delayed_routes(flights)),
    "panel_top_routes_revenue_on_slice": _on_slice(lambda flights, sales, labels: metrics.top_routes_by_revenue(sales)),
}.items():
    register(_name)(_query)


# --- insights and report tables -------------------------------------------------------------


def _insight(build, *names: str, drop: tuple[str, ...] = ()) -> Query:
    """A finding from named results; where it takes several, their flights are built once and written."""

    def found(spark, sf):
        if len(names) == 1:
            return build(_result(spark, sf, *names)).drop(*drop)
        flights = stage(bridge.flights(spark, sf), "flights")
        return build(*[kpis.KPI_QUERIES[n](flights, None) for n in names]).drop(*drop)

    return found


for _name, _query in {
    "insight_airline_extremes": _insight(insights.airline_extremes, "airline_performance"),
    "insight_disruption": _insight(insights.disruption, "airport_performance"),
    "insight_cancellation": _insight(insights.cancellation, "airport_performance", "executive_kpis"),
    "insight_revenue_concentration": _insight(insights.revenue_concentration, "top_revenue_routes"),
    "insight_risky_routes": _insight(
        insights.risky_routes, "high_demand_poor_performance", "executive_kpis", drop=("top",)
    ),
    "insight_daypart": _insight(insights.daypart, "delay_by_hour"),
    "insight_months": _insight(insights.months, "monthly_trends"),
    "insight_business": _insight(insights.business, "cabin_class_summary"),
    "report_headline_rows": _insight(reports.headline_rows, "executive_kpis"),
    "report_cabin_revenue": _insight(reports.cabin_revenue, "cabin_class_summary"),
}.items():
    register(_name)(_query)


@register()
def insights_all(spark, sf):
    return insights.all_insights(stage_all(_results(*_stored_model(spark, sf))))


# --- geography and calendar ---------------------------------------------------------------


def _airports(spark, sf):
    key = F.col("n_nationkey")
    return bridge.table(spark, sf, "nation").select(
        F.col("n_name").alias("airport"), (key * 5 - 60).cast("double").alias("lat"), (key * 13 - 170).cast("double").alias("lon")
    )


@register()
def route_distance_matrix(spark, sf):
    return geo.route_distances(bridge.flights(spark, sf), _airports(spark, sf))


@register()
def calendar_spine(spark, sf):
    return geo.airline_calendar(bridge.flights(spark, sf))


@register()
def calendar_of_period(spark, sf):
    """The calendar of a given period, in which a flight of a wrong year has no part."""
    flights = bridge.flights(spark, sf)
    wrong = flights.where("month = '1996-02'").withColumn("flight_date", F.lit("9025-01-01").cast("date"))
    return geo.airline_calendar(flights.unionByName(wrong), "1995-06-01", "1997-05-31")


@register()
def check_calendar_dates(spark, sf):
    """Flights outside of a period, by airline, as they would be missing in its calendar."""
    return geo.outside_period(bridge.flights(spark, sf), "1995-06-01", "1997-05-31")


@register()
def cabin_fanout(spark, sf):
    flights = bridge.flights(spark, sf)
    seats = geo.most_seated(flights, bridge.bookings(spark, sf).select("flight_id", "cabin_class", "passengers"))
    return geo.cabin_fanout(flights, seats).select("flight_id", "aircraft", "cabin_class", "seats")
