"""DuckDB SQL for each registered query, written against the source tables.

The common table expressions below state the bridge and cleaning rules a second
time, in SQL, so a query and its oracle share no code.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {}


def rnd(value: str, places: int) -> str:
    return f"CAST(ROUND(CAST({value} AS DECIMAL(28,8)), {places}) AS DOUBLE)"


def div(part: str, whole: str) -> str:
    return f"(CAST({part} AS DOUBLE) / NULLIF(CAST({whole} AS DOUBLE), 0))"


def num(column: str) -> str:
    return f"TRY_CAST({column} AS DOUBLE)"


def minutes(column: str) -> str:
    return f"({num(f"split_part({column}, ':', 1)")} * 60 + {num(f"split_part({column}, ':', 2)")})"


def hhmm(value: str) -> str:
    m = f"(((CAST({value} AS BIGINT) % 1440) + 1440) % 1440)"
    return f"(lpad(CAST({m} // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST({m} % 60 AS VARCHAR), 2, '0'))"


def title(column: str) -> str:
    return (
        f"array_to_string(list_transform(string_split(lower({column}), ' '), "
        "lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), ' ')"
    )


HEADERS = {
    "Flight": "flight_number", "Date": "flight_date", "Airline": "airline", "Origin": "origin",
    "Destination": "destination", "Aircraft": "aircraft", "Scheduled Departure": "scheduled_departure",
    "Actual Departure": "actual_departure", "Delay (min)": "departure_variance", "Cancelled": "is_cancelled",
    "Distance (mi)": "distance_miles", "Cabin Class": "cabin_class", "Passengers": "passengers",
    "Ticket Price": "ticket_price",
}
NAMES = ", ".join(HEADERS.values())

DAYPART = "CASE WHEN {h} <= 11 THEN 'Morning' WHEN {h} <= 16 THEN 'Afternoon' WHEN {h} <= 20 THEN 'Evening' WHEN {h} <= 23 THEN 'Night' END"
CATEGORY = (
    "CASE WHEN is_cancelled = 1 THEN 'Cancelled' WHEN {d} <= 14 THEN 'On time (<15)' WHEN {d} <= 29 THEN '15-29' "
    "WHEN {d} <= 59 THEN '30-59' WHEN {d} <= 119 THEN '60-119' WHEN {d} <= 179 THEN '120-179' WHEN {d} > 179 THEN '180+' END"
)

BRIDGE = {
    "placed": """
        SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS flight_date, min(o_orderkey) OVER day AS flight_id,
               first_value(o_orderstatus) OVER (day ORDER BY o_orderkey) AS status
        FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem) WINDOW day AS (PARTITION BY o_custkey, CAST(o_orderdate AS DATE))""",
    "sold_lines": "SELECT p.flight_id, l.* FROM lineitem l JOIN placed p ON p.o_orderkey = l.l_orderkey",
    "flight_supplier": "SELECT flight_id, min(l_suppkey) AS suppkey FROM sold_lines GROUP BY flight_id",
    "flight_cabins": """
        SELECT flight_id,
               CASE l_returnflag WHEN 'N' THEN 'Economy' WHEN 'R' THEN 'Premium Economy' ELSE 'Business' END AS cabin_class,
               CASE l_returnflag WHEN 'N' THEN 0 WHEN 'R' THEN 1 ELSE 2 END AS cabin_no,
               sum(l_quantity) AS seats, sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS amount
        FROM sold_lines GROUP BY ALL""",
    "legs": """
        SELECT f.flight_id, f.flight_date, 'F' || f.o_custkey AS flight_number, c.c_mktsegment AS airline,
               a.n_name AS origin, b.n_name AS destination, c.c_nationkey AS from_key, s.s_nationkey AS to_key, suppkey,
               (f.flight_id * 7919 + f.o_custkey * 104729) % 1000003 AS h, f.status
        FROM (SELECT * FROM placed WHERE o_orderkey = flight_id) f
        JOIN flight_supplier USING (flight_id)
        JOIN customer c ON c.c_custkey = f.o_custkey
        JOIN supplier s ON s.s_suppkey = suppkey
        JOIN nation a ON a.n_nationkey = c.c_nationkey
        JOIN nation b ON b.n_nationkey = s.s_nationkey""",
    "timed": """
        SELECT *, CASE WHEN status = 'P' AND h % 4 = 0 THEN 1 ELSE 0 END AS is_cancelled,
               360 + (h * 31) % 960 AS sched, 100 + 90 * abs(from_key - to_key) AS distance_miles,
               CAST(h % 120 - 60 + 6 * (from_key % 5) + CASE WHEN h % 50 = 0 THEN 150 ELSE 0 END AS DOUBLE) AS planned
        FROM legs""",
    "operations": f"""
        SELECT flight_id, flight_number, flight_date, strftime(flight_date, '%Y-%m') AS month,
               dayname(flight_date) AS day_of_week, airline, origin, destination, origin || '-' || destination AS route,
               CASE suppkey % 4 WHEN 0 THEN 'Commuter' WHEN 1 THEN 'Short haul' WHEN 2 THEN 'Medium haul'
                    ELSE 'Long haul' END AS aircraft,
               {hhmm('sched')} AS scheduled_departure,
               CASE WHEN is_cancelled = 0 THEN {hhmm('sched + planned')} END AS actual_departure,
               sched // 60 AS departure_hour, {DAYPART.format(h='(sched // 60)')} AS time_of_day,
               CASE WHEN is_cancelled = 0 THEN planned END AS departure_variance,
               CASE WHEN is_cancelled = 0 THEN CASE WHEN planned < 0 THEN 0 ELSE planned END END AS delay_minutes,
               {CATEGORY.format(d='planned')} AS delay_category, is_cancelled,
               CASE WHEN is_cancelled = 0 THEN CASE WHEN planned < 15 THEN 1 ELSE 0 END END AS is_on_time, distance_miles
        FROM timed""",
    "bookings": f"""
        SELECT flight_id, cabin_class, cabin_no, CASE WHEN is_cancelled = 0 THEN CAST(seats AS BIGINT) ELSE 0 END AS passengers,
               {rnd('CAST(amount AS DOUBLE) / seats', 2)} AS ticket_price,
               CASE WHEN is_cancelled = 0 THEN CAST(amount AS DECIMAL(18,2)) ELSE 0 END AS revenue
        FROM flight_cabins JOIN operations USING (flight_id)""",
    "flights": """
        SELECT o.*, t.passengers, t.revenue FROM operations o
        JOIN (SELECT flight_id, CAST(sum(passengers) AS BIGINT) AS passengers, CAST(sum(revenue) AS DECIMAL(18,2)) AS revenue
              FROM bookings GROUP BY flight_id) t USING (flight_id)""",
    "enriched": """
        SELECT b.flight_id, b.cabin_class, b.passengers, b.ticket_price, b.revenue, f.airline, f.route, f.origin, f.destination, f.month
        FROM bookings b JOIN flights f USING (flight_id)""",
}

FEED = {
    "sold": """
        SELECT o.*, b.cabin_class, b.cabin_no, b.passengers, CAST(CAST(floor(b.ticket_price) AS BIGINT) AS VARCHAR) || '.50' AS fare,
               upper(substr(airline, 1, 1)) || lower(substr(airline, 2)) AS carrier, flight_id * 3 + cabin_no AS k
        FROM operations o JOIN bookings b USING (flight_id)""",
    "written": """
        SELECT CASE WHEN k % 50 = 11 THEN lower(flight_number) ELSE flight_number END AS "Flight",
               CASE WHEN k % 33 = 5 THEN strftime(flight_date, '%m/%d/%Y') ELSE strftime(flight_date, '%Y-%m-%d') END AS "Date",
               CASE k % 99 WHEN 0 THEN upper(carrier) WHEN 1 THEN lower(carrier) WHEN 2 THEN ' ' || carrier || '  ' ELSE carrier END AS "Airline",
               CASE WHEN k % 50 = 8 THEN lower(origin) ELSE origin END AS "Origin",
               CASE WHEN flight_id % 997 = 1 THEN origin WHEN k % 50 = 9 THEN lower(destination) ELSE destination END AS "Destination",
               aircraft AS "Aircraft", scheduled_departure AS "Scheduled Departure",
               CASE WHEN is_cancelled = 1 OR k % 200 = 6 OR k % 401 = 7 OR flight_id % 499 = 3 THEN '' ELSE actual_departure END AS "Actual Departure",
               CASE WHEN is_cancelled = 1 OR k % 67 = 5 OR k % 401 = 7 OR flight_id % 499 = 3 THEN ''
                    ELSE CAST(CAST(departure_variance AS INT) AS VARCHAR) END AS "Delay (min)",
               CASE WHEN flight_id % 997 = 2 THEN 'maybe'
                    ELSE CASE k % 17 WHEN 0 THEN ['N', 'Y'] WHEN 1 THEN ['0', '1'] WHEN 2 THEN ['FALSE', 'TRUE']
                                     WHEN 3 THEN ['no', 'yes'] ELSE ['No', 'Yes'] END[is_cancelled + 1] END AS "Cancelled",
               CASE WHEN k % 100 = 4 THEN '' ELSE CAST(distance_miles AS VARCHAR) END AS "Distance (mi)",
               CASE WHEN k % 41 = 0 THEN upper(cabin_class) ELSE cabin_class END AS "Cabin Class",
               CASE WHEN k % 125 = 3 THEN '' ELSE CAST(passengers AS VARCHAR) END AS "Passengers",
               CASE WHEN k % 100 = 1 THEN '' WHEN k % 500 = 2 THEN '-' || fare WHEN k % 20 = 0 THEN '$' || fare ELSE fare END AS "Ticket Price", k
        FROM sold""",
    "feed": """
        SELECT * EXCLUDE (k), 4 * k AS src_row FROM written
        UNION ALL SELECT * EXCLUDE (k), 4 * k + 1 FROM written WHERE k % 83 = 7
        UNION ALL SELECT * EXCLUDE (k) REPLACE (upper("Airline") AS "Airline"), 4 * k + 2 FROM written WHERE k % 211 = 9""",
}

CLEAN = {
    "renamed": "SELECT " + ", ".join(f'"{h}" AS {n}' for h, n in HEADERS.items()) + ", src_row FROM feed",
    "stripped": "SELECT " + ", ".join(f"NULLIF(trim({n}), '') AS {n}" for n in HEADERS.values()) + ", src_row FROM renamed",
    "standard": f"""
        SELECT * REPLACE (upper(flight_number) AS flight_number, upper(origin) AS origin, upper(destination) AS destination,
                          {title('airline')} AS airline, {title('cabin_class')} AS cabin_class)
        FROM stripped""",
    "typed": f"""
        SELECT * REPLACE (CAST(coalesce(try_strptime(flight_date, '%Y-%m-%d'), try_strptime(flight_date, '%m/%d/%Y')) AS DATE) AS flight_date,
                          CASE WHEN lower(is_cancelled) IN ('yes', 'y', '1', 'true') THEN 1
                               WHEN lower(is_cancelled) IN ('no', 'n', '0', 'false') THEN 0 END AS is_cancelled,
                          {num("replace(ticket_price, '$', '')")} AS ticket_price, {num('departure_variance')} AS departure_variance,
                          {num('distance_miles')} AS distance_miles, {num('passengers')} AS passengers),
               CASE WHEN contains(ticket_price, '$') THEN 1 ELSE 0 END AS had_symbol
        FROM standard""",
    # Copies that are equal on all stripped columns: the first one counts.
    "numbered": f"""
        SELECT t.*, row_number() OVER (PARTITION BY {', '.join('s.' + n for n in HEADERS.values())} ORDER BY t.src_row) AS copy_no
        FROM typed t JOIN stripped s USING (src_row)""",
    "keyed": """
        SELECT *, row_number() OVER key_order AS key_no, count(*) OVER whole_key AS raw_rows,
               count(*) FILTER (WHERE copy_no = 1) OVER whole_key AS distinct_rows,
               CAST(sum(had_symbol) FILTER (WHERE copy_no = 1) OVER whole_key AS BIGINT) AS symbol_rows
        FROM numbered
        WINDOW whole_key AS (PARTITION BY flight_number, flight_date, cabin_class),
               key_order AS (PARTITION BY flight_number, flight_date, cabin_class ORDER BY src_row)""",
    "first_rows": """
        SELECT * REPLACE (CASE WHEN ticket_price > 0 THEN ticket_price END AS ticket_price),
               CASE WHEN ticket_price <= 0 THEN 1 ELSE 0 END AS price_invalid,
               (origin IS NULL OR destination IS NULL OR origin <> destination) AND is_cancelled IS NOT NULL AS is_usable
        FROM keyed WHERE key_no = 1""",
    "clocked": f"""
        SELECT *, {minutes('scheduled_departure')} AS sched_min,
               CASE WHEN {minutes('actual_departure')} - {minutes('scheduled_departure')} > -180
                    THEN {minutes('actual_departure')} - {minutes('scheduled_departure')}
                    ELSE {minutes('actual_departure')} - {minutes('scheduled_departure')} + 1440 END AS derived
        FROM first_rows WHERE is_usable""",
    "delayed": """
        SELECT * REPLACE (CASE WHEN is_cancelled = 0 THEN coalesce(departure_variance, derived) ELSE departure_variance END AS departure_variance),
               CASE WHEN is_cancelled = 0 AND departure_variance IS NULL AND derived IS NOT NULL THEN 1 ELSE 0 END AS delay_derived
        FROM clocked""",
    "repaired": f"""
        SELECT * REPLACE (CASE WHEN is_cancelled = 0 AND actual_departure IS NULL AND departure_variance IS NOT NULL
                               THEN {hhmm('sched_min + departure_variance')} ELSE actual_departure END AS actual_departure),
               CASE WHEN is_cancelled = 0 AND actual_departure IS NULL AND departure_variance IS NOT NULL THEN 1 ELSE 0 END AS actual_rebuilt
        FROM delayed""",
    "borrowed": """
        SELECT * REPLACE (CASE WHEN is_cancelled = 0 THEN coalesce(departure_variance,
                   arg_min(departure_variance, src_row) FILTER (WHERE departure_variance IS NOT NULL)
                   OVER (PARTITION BY flight_number, flight_date)) ELSE departure_variance END AS departure_variance)
        FROM repaired""",
    "settled": """
        SELECT * REPLACE (CASE WHEN is_cancelled = 0 THEN departure_variance END AS departure_variance,
                          CASE WHEN is_cancelled = 0 THEN actual_departure END AS actual_departure)
        FROM borrowed WHERE is_cancelled = 1 OR departure_variance IS NOT NULL""",
    "distance_medians": "SELECT origin, destination, median(distance_miles) AS m FROM settled GROUP BY ALL",
    "passenger_medians": "SELECT flight_number, cabin_class, median(passengers) AS m FROM settled GROUP BY ALL",
    "price_medians": """
        SELECT origin, destination, cabin_class, month(flight_date) AS mon, median(ticket_price) AS m FROM settled GROUP BY ALL""",
    "imputed": """
        SELECT s.* REPLACE (coalesce(s.distance_miles, d.m) AS distance_miles,
                            CASE WHEN s.is_cancelled = 1 THEN 0 ELSE coalesce(s.passengers, round_even(p.m, 0)) END AS passengers,
                            round_even(coalesce(s.ticket_price, r.m) * 100, 0) / 100 AS ticket_price),
               CASE WHEN s.distance_miles IS NULL THEN 1 ELSE 0 END AS distance_missing,
               CASE WHEN s.passengers IS NULL THEN 1 ELSE 0 END AS passengers_missing,
               CASE WHEN s.ticket_price IS NULL THEN 1 ELSE 0 END AS price_missing
        FROM settled s
        LEFT JOIN distance_medians d USING (origin, destination)
        LEFT JOIN passenger_medians p USING (flight_number, cabin_class)
        LEFT JOIN price_medians r ON r.origin = s.origin AND r.destination = s.destination
             AND r.cabin_class = s.cabin_class AND r.mon = month(s.flight_date)""",
}


def derived(source: str) -> str:
    """Row-local columns over typed rows."""
    return f"""
        SELECT * REPLACE (CAST(passengers AS BIGINT) AS passengers, CAST(trunc(distance_miles) AS INT) AS distance_miles),
               flight_number || '_' || strftime(flight_date, '%Y%m%d') AS flight_id, strftime(flight_date, '%Y-%m') AS month,
               dayname(flight_date) AS day_of_week, origin || '-' || destination AS route,
               CAST(floor({minutes('scheduled_departure')} / 60) AS INT) AS departure_hour,
               {DAYPART.format(h=f"floor({minutes('scheduled_departure')} / 60)")} AS time_of_day,
               CASE WHEN departure_variance < 0 THEN 0 ELSE departure_variance END AS delay_minutes,
               {CATEGORY.format(d='departure_variance')} AS delay_category,
               CASE WHEN is_cancelled = 0 THEN CASE WHEN departure_variance < 15 THEN 1 WHEN departure_variance >= 15 THEN 0 END END AS is_on_time,
               CASE cabin_class WHEN 'Economy' THEN 0 WHEN 'Premium Economy' THEN 1 WHEN 'Business' THEN 2 END AS cabin_rank,
               CAST(passengers * CAST(ticket_price AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS revenue
        FROM {source}"""


CLEAN["clean"] = derived("imputed")
CLEAN["delivered"] = derived("typed")
CLEAN["model_flights"] = """
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY flight_id ORDER BY scheduled_departure NULLS LAST, cabin_rank NULLS LAST, src_row) AS place
                   FROM clean) WHERE place = 1"""
CLEAN["model_totals"] = """
    SELECT flight_id, CAST(sum(passengers) AS BIGINT) AS passengers, coalesce(sum(revenue), 0) AS revenue FROM clean GROUP BY flight_id"""

STEPS = {**BRIDGE, **FEED, **CLEAN}


def with_steps(body: str, upto: str, **more: str) -> str:
    """Put the shared steps up to one of them, then own ones, in front of a query."""
    names = list(STEPS)
    wanted = {n: STEPS[n] for n in names[: names.index(upto) + 1]} | more
    return "WITH " + ",\n".join(f"{n} AS ({sql})" for n, sql in wanted.items()) + "\n" + body


def on_model(name: str, body: str) -> None:
    ORACLES[name] = with_steps(body, "enriched")


def on_feed(name: str, body: str) -> None:
    ORACLES[name] = with_steps(body, "feed")


def on_clean(name: str, body: str, upto: str = "model_totals") -> None:
    ORACLES[name] = with_steps(body, upto)


# --- sources --------------------------------------------------------------------------

FLIGHT_LIST = (
    "flight_id, flight_number, strftime(flight_date, '%Y-%m-%d') AS flight_date, month, day_of_week, airline, origin, destination, "
    "route, aircraft, scheduled_departure, actual_departure, departure_hour, time_of_day, departure_variance, delay_minutes, "
    "delay_category, is_cancelled, is_on_time, distance_miles"
)
MONEY_LIST = "passengers, CAST(revenue AS DOUBLE) AS revenue"

on_feed("dirty_feed", "SELECT * FROM feed")
on_feed("src_csv_all_text", "SELECT " + ", ".join(f'NULLIF("{h}", \'\') AS "{h}"' for h in HEADERS) + " FROM feed")
on_clean("src_rename", "SELECT * FROM renamed", "renamed")
on_model("src_scan_flights", f"SELECT {FLIGHT_LIST}, {MONEY_LIST} FROM flights")
on_model(
    "src_param_sql",
    "SELECT airline, count(*) AS flights, CAST(sum(passengers) AS BIGINT) AS passengers FROM flights "
    "WHERE month BETWEEN '1996-01' AND '1997-12' GROUP BY airline",
)
on_feed(
    "src_csv_malformed",
    """SELECT problem, count(*) AS rows, count(NULLIF("Airline", '')) AS airlines,
              count(CASE WHEN problem = 'short' THEN NULL ELSE NULLIF("Ticket Price", '') END) AS prices
       FROM (SELECT *, CASE WHEN src_row % 97 = 5 THEN 'short' WHEN src_row % 89 = 3 THEN 'long' END AS problem FROM feed) GROUP BY problem""",
)
on_model("src_bookings_enriched_in_buckets", "SELECT * REPLACE (CAST(revenue AS DOUBLE) AS revenue) FROM enriched")
on_model("src_bookings_enriched", "SELECT * REPLACE (CAST(revenue AS DOUBLE) AS revenue) FROM enriched")
on_model(
    "sink_star_model",
    f"SELECT {FLIGHT_LIST.replace('flight_id,', 'CAST(flight_id AS VARCHAR) AS flight_id,', 1)}, {MONEY_LIST} FROM flights",
)
on_model(
    "sink_csv_roundtrip",
    "SELECT CAST(flight_id AS VARCHAR) AS flight_id, cabin_class, passengers, ticket_price, CAST(revenue AS DOUBLE) AS revenue FROM bookings",
)

# --- cleaning steps ---------------------------------------------------------------------

on_clean("clean_strip_empty", "SELECT * FROM stripped", "stripped")
on_clean("clean_exact_dedup", f"SELECT {NAMES}, min(src_row) AS src_row, count(*) AS copies FROM stripped GROUP BY {NAMES}", "stripped")
on_clean("clean_case_standardise", "SELECT src_row, airline, origin, destination, flight_number, cabin_class FROM standard", "standard")
on_clean("clean_mixed_dates", "SELECT src_row, strftime(flight_date, '%Y-%m-%d') AS flight_date FROM typed", "typed")
on_clean("clean_flag_map", "SELECT src_row, is_cancelled FROM typed", "typed")
on_clean("clean_currency", "SELECT src_row, ticket_price, had_symbol FROM typed", "typed")
on_clean("clean_numeric_coerce", "SELECT src_row, departure_variance, distance_miles, passengers FROM typed", "typed")
on_clean(
    "clean_key_dedup",
    "SELECT flight_number, strftime(flight_date, '%Y-%m-%d') AS flight_date, cabin_class, src_row, airline, raw_rows, distinct_rows, symbol_rows "
    "FROM keyed WHERE key_no = 1",
    "keyed",
)
on_clean("clean_invalid_price", "SELECT src_row, ticket_price, price_invalid FROM first_rows", "first_rows")
on_clean("clean_invalid_rows", "SELECT src_row, origin, destination, is_cancelled FROM first_rows WHERE is_usable", "first_rows")
on_clean(
    "clean_hhmm_minutes",
    f"SELECT src_row, {minutes('scheduled_departure')} AS scheduled_minutes, {minutes('actual_departure')} AS actual_minutes FROM stripped",
    "stripped",
)
on_clean("clean_delay_from_times", "SELECT src_row, departure_variance, delay_derived FROM delayed", "delayed")
on_clean("clean_rebuild_actual", "SELECT src_row, actual_departure, actual_rebuilt FROM repaired", "repaired")
on_clean(
    "clean_sibling_borrow",
    "SELECT src_row, flight_number, strftime(flight_date, '%Y-%m-%d') AS flight_date, is_cancelled, departure_variance FROM borrowed",
    "borrowed",
)
on_clean(
    "clean_drop_unrecoverable",
    "SELECT src_row, flight_number, strftime(flight_date, '%Y-%m-%d') AS flight_date, cabin_class FROM settled",
    "settled",
)
on_clean("clean_cancelled_nulls", "SELECT src_row, is_cancelled, departure_variance, actual_departure FROM settled", "settled")
for _name, _column, _flag in (
    ("impute_distance_median", "distance_miles", "distance_missing"),
    ("impute_passengers_median", "passengers", "passengers_missing"),
    ("impute_price_median", "ticket_price", "price_missing"),
):
    on_clean(_name, f"SELECT src_row, {_column}, {_flag} AS was_missing FROM imputed", "imputed")
for _name, _columns in {
    "derive_keys": "flight_id, month, day_of_week, route",
    "derive_time_of_day": "departure_hour, time_of_day",
    "derive_delay_floor": "departure_variance, delay_minutes",
    "derive_on_time": "is_cancelled, is_on_time",
    "derive_delay_category": "delay_minutes, delay_category",
    "derive_revenue": "passengers, ticket_price, CAST(revenue AS DOUBLE) AS revenue",
    "derive_cabin_order": "strftime(flight_date, '%Y-%m-%d') AS flight_date, scheduled_departure, flight_number, cabin_class, cabin_rank",
}.items():
    on_clean(_name, f"SELECT src_row, {_columns} FROM clean", "clean")
on_clean(
    "clean_pipeline",
    f"SELECT {FLIGHT_LIST}, cabin_class, cabin_rank, passengers, ticket_price, CAST(revenue AS DOUBLE) AS revenue, src_row FROM clean",
    "clean",
)

REPORT = """
SELECT 1 AS position, 'raw_rows' AS metric, (SELECT count(*) FROM feed) AS value
UNION ALL SELECT 2, 'exact_duplicates_removed', (SELECT count(*) FROM numbered WHERE copy_no > 1)
UNION ALL SELECT 3, 'prices_with_currency_symbol_fixed', (SELECT count(*) FROM numbered WHERE copy_no = 1 AND had_symbol = 1)
UNION ALL SELECT 4, 'key_duplicates_removed', (SELECT count(*) FROM keyed WHERE copy_no = 1 AND key_no > 1)
UNION ALL SELECT 5, 'invalid_prices_nulled', (SELECT count(*) FROM first_rows WHERE price_invalid = 1)
UNION ALL SELECT 6, 'invalid_rows_dropped', (SELECT count(*) FROM first_rows WHERE NOT is_usable)
UNION ALL SELECT 7, 'delays_derived_from_times', (SELECT count(*) FROM delayed WHERE delay_derived = 1)
UNION ALL SELECT 8, 'actual_departures_rebuilt', (SELECT count(*) FROM repaired WHERE actual_rebuilt = 1)
UNION ALL SELECT 9, 'rows_dropped_no_departure_data', (SELECT count(*) FROM borrowed WHERE is_cancelled = 0 AND departure_variance IS NULL)
UNION ALL SELECT 10, 'distance_imputed_from_route', (SELECT count(*) FROM imputed WHERE distance_missing = 1)
UNION ALL SELECT 11, 'passengers_imputed', (SELECT count(*) FROM imputed WHERE passengers_missing = 1)
UNION ALL SELECT 12, 'ticket_prices_imputed', (SELECT count(*) FROM imputed WHERE price_missing = 1)
UNION ALL SELECT 13, 'clean_rows', (SELECT count(*) FROM clean)
UNION ALL SELECT 14, 'flights', (SELECT count(*) FROM (SELECT DISTINCT flight_number, flight_date FROM clean))"""
on_clean("clean_report", REPORT, "clean")
on_clean("sink_json_report", REPORT, "clean")

# --- model and checks ------------------------------------------------------------------------

on_clean("model_flights", f"SELECT {FLIGHT_LIST} FROM model_flights WHERE flight_id IS NOT NULL")
on_clean("model_flight_totals", "SELECT flight_id, passengers, CAST(revenue AS DOUBLE) AS revenue FROM model_totals WHERE flight_id IS NOT NULL")
on_clean("model_bookings", "SELECT flight_id, cabin_class, passengers, ticket_price, CAST(revenue AS DOUBLE) AS revenue FROM clean", "clean")

BOTH = {"delivered": "delivered", "clean": "clean"}


def on_both(name: str, body) -> None:
    """One query per stage of the rows, stacked."""
    on_clean(name, " UNION ALL ".join(f"({body(stage, table)})" for stage, table in BOTH.items()), "delivered")


def listed(stage: str, table: str, counts: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{stage}' AS stage, {i} AS position, '{metric}' AS metric, CAST(({sql.format(t=table)}) AS BIGINT) AS value"
        for i, (metric, sql) in enumerate(counts.items(), 1)
    )


REQUIRED = (
    "flight_id", "flight_date", "airline", "origin", "destination", "cabin_class", "passengers", "ticket_price",
    "distance_miles", "is_cancelled",
)
NULLS = {c: f"SELECT count(*) FROM {{t}} WHERE {c} IS NULL" for c in REQUIRED}
DUPLICATES = "SELECT flight_id, cabin_class, count(*) AS copies FROM {t} GROUP BY ALL HAVING count(*) > 1"
UNKNOWN = "SELECT count(*) FROM {t} WHERE cabin_class IS NULL OR cabin_class NOT IN ('Economy', 'Premium Economy', 'Business')"
BAD_PASSENGERS = "passengers IS NULL OR passengers < 0"
BAD_PRICE = "ticket_price IS NULL OR ticket_price <= 0"
NO_DELAY = "SELECT count(*) FROM {t} WHERE is_cancelled = 0 AND delay_minutes IS NULL"
STILL_SOLD = "SELECT count(*) FROM {t} WHERE is_cancelled <> 0 AND (passengers IS NULL OR passengers <> 0)"
SHARED = ("airline", "origin", "destination", "is_cancelled", "delay_minutes")
VARYING = {
    c: f"SELECT count(*) FROM (SELECT flight_id FROM (SELECT DISTINCT flight_id, {c} FROM {{t}} WHERE flight_id IS NOT NULL) "
    "GROUP BY flight_id HAVING count(*) > 1)"
    for c in SHARED
}

on_both("check_required_nulls", lambda s, t: listed(s, t, NULLS))
on_both("check_unique_key", lambda s, t: f"SELECT '{s}' AS stage, * FROM ({DUPLICATES.format(t=t)})")
on_both("check_domain", lambda s, t: f"SELECT '{s}' AS stage, ({UNKNOWN.format(t=t)}) AS unknown_cabins")
on_both(
    "check_ranges",
    lambda s, t: f"SELECT '{s}' AS stage, count(*) FILTER (WHERE {BAD_PASSENGERS}) AS bad_passengers, "
    f"count(*) FILTER (WHERE {BAD_PRICE}) AS bad_prices FROM {t}",
)
on_both("check_operated_delay", lambda s, t: f"SELECT '{s}' AS stage, ({NO_DELAY.format(t=t)}) AS operated_without_delay")
on_both("check_cancelled_zero", lambda s, t: f"SELECT '{s}' AS stage, ({STILL_SOLD.format(t=t)}) AS cancelled_with_passengers")
on_both("check_consistent_attrs", lambda s, t: listed(s, t, VARYING))
ALL_COUNTS = {
    "required_nulls": "SELECT " + " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in REQUIRED) + " FROM {t}",
    "duplicate_keys": f"SELECT count(*) FROM ({DUPLICATES})",
    "unknown_cabins": UNKNOWN,
    "out_of_range": f"SELECT count(*) FROM {{t}} WHERE {BAD_PASSENGERS} OR {BAD_PRICE}",
    "operated_without_delay": NO_DELAY,
    "cancelled_with_passengers": STILL_SOLD,
    "inconsistent_flights": f"SELECT count(*) FROM (SELECT flight_id FROM (SELECT DISTINCT flight_id, {', '.join(SHARED)} FROM {{t}} "
    "WHERE flight_id IS NOT NULL) GROUP BY flight_id HAVING count(*) > 1)",
}
on_both("check_all", lambda s, t: listed(s, t, ALL_COUNTS))
on_both("check_all_while_writing", lambda s, t: listed(s, t, ALL_COUNTS))
on_clean(
    "check_pk",
    """SELECT 'flights' AS table_name, (SELECT count(*) FROM (SELECT flight_id FROM model_flights GROUP BY flight_id HAVING count(*) > 1)) AS duplicate_keys,
              (SELECT count(*) FROM model_flights WHERE flight_id IS NULL) AS null_keys
       UNION ALL
       SELECT 'bookings', (SELECT count(*) FROM (SELECT flight_id, cabin_class FROM clean WHERE flight_id IS NOT NULL AND cabin_class IS NOT NULL
                                                 GROUP BY ALL HAVING count(*) > 1)),
              (SELECT count(*) FROM clean WHERE flight_id IS NULL OR cabin_class IS NULL)""",
)
on_clean(
    "check_fk_orphans",
    """SELECT flight_id, cabin_class, passengers, CAST(CAST(ticket_price AS DECIMAL(18,2)) AS DOUBLE) AS ticket_price, CAST(revenue AS DOUBLE) AS revenue
       FROM delivered WHERE flight_id IS NULL OR flight_id NOT IN (SELECT flight_id FROM model_flights WHERE flight_id IS NOT NULL)""",
)
ORACLES["check_orphans_in_buckets"] = ORACLES["check_fk_orphans"]
FLIGHT_NOT_NULL = (
    "flight_id", "flight_number", "flight_date", "month", "day_of_week", "airline", "origin", "destination", "route",
    "scheduled_departure", "departure_hour", "time_of_day", "delay_category", "is_cancelled", "distance_miles",
)
on_clean(
    "check_check01",
    " UNION ALL ".join(
        [f"SELECT {i} AS position, '{c}' AS metric, count(*) FILTER (WHERE {c} IS NULL) AS value FROM model_flights WHERE flight_id IS NOT NULL"
         for i, c in enumerate(FLIGHT_NOT_NULL, 1)]
        + [f"SELECT {len(FLIGHT_NOT_NULL) + 1}, 'passengers', count(*) FILTER (WHERE passengers IS NULL) FROM model_totals",
           f"SELECT {len(FLIGHT_NOT_NULL) + 2}, 'revenue', count(*) FILTER (WHERE revenue IS NULL) FROM model_totals",
           f"SELECT {len(FLIGHT_NOT_NULL) + 3}, 'is_cancelled_not_0_or_1', count(*) FILTER (WHERE is_cancelled NOT IN (0, 1)) FROM model_flights"]
    ),
)

# --- named queries ------------------------------------------------------------------------------

OTR = f"{rnd('avg(is_on_time)', 4)} AS on_time_rate"
DELAY = f"{rnd('avg(delay_minutes)', 2)} AS avg_delay_minutes"
CANCEL = f"{rnd('avg(is_cancelled)', 4)} AS cancellation_rate"
PAX = "CAST(sum(passengers) AS BIGINT) AS passengers"
REVENUE = "CAST(sum(revenue) AS DOUBLE) AS revenue"
FARE = f"{rnd(div('sum(revenue)', 'sum(passengers)'), 2)} AS avg_ticket_price"
REVENUE_SHARE = f"{rnd(div('sum(revenue)', 'sum(sum(revenue)) OVER ()'), 4)} AS revenue_share"

KPI = {
    "executive_kpis": f"""
        SELECT count(*) AS total_flights, CAST(sum(is_cancelled) AS BIGINT) AS cancelled_flights, {CANCEL}, {OTR}, {DELAY},
               CAST(sum(passengers) AS BIGINT) AS total_passengers, CAST(sum(revenue) AS DOUBLE) AS total_revenue,
               {rnd(div('sum(revenue)', 'sum(passengers)'), 2)} AS avg_fare,
               strftime(min(flight_date), '%Y-%m-%d') AS period_start, strftime(max(flight_date), '%Y-%m-%d') AS period_end
        FROM flights""",
    "airline_performance": f"""
        SELECT airline, count(*) AS flights, {OTR}, {rnd('1 - avg(is_on_time)', 4)} AS delay_rate, {DELAY},
               {rnd(div('count(*) FILTER (WHERE delay_minutes >= 60)', 'count(*) FILTER (WHERE is_cancelled = 0)'), 4)} AS severe_delay_rate,
               {CANCEL}, {PAX}, {REVENUE}, rank() OVER (ORDER BY avg(is_on_time) DESC NULLS LAST) AS on_time_rank
        FROM flights GROUP BY airline""",
    "monthly_trends": f"SELECT month, count(*) AS flights, {OTR}, {DELAY}, {CANCEL}, {PAX}, {REVENUE} FROM flights GROUP BY month",
    "delay_by_time_of_day": f"SELECT time_of_day, count(*) AS flights, {OTR}, {DELAY} FROM flights GROUP BY time_of_day",
    "airport_performance": f"""
        SELECT o.*, i.arrivals, i.arriving_passengers, departing_passengers + arriving_passengers AS total_passengers,
               rank() OVER (ORDER BY disruption_rate DESC NULLS LAST) AS disruption_rank
        FROM (SELECT origin AS airport, count(*) AS departures, {DELAY}, {OTR}, {CANCEL},
                     {rnd(div('count(*) FILTER (WHERE is_cancelled = 1 OR delay_minutes >= 60)', 'count(*)'), 4)} AS disruption_rate,
                     CAST(sum(passengers) AS BIGINT) AS departing_passengers FROM flights GROUP BY origin) o
        JOIN (SELECT destination AS airport, count(*) AS arrivals, CAST(sum(passengers) AS BIGINT) AS arriving_passengers
              FROM flights GROUP BY destination) i ON i.airport = o.airport""",
    "delay_by_hour": f"SELECT departure_hour, count(*) AS flights, {DELAY}, {OTR}, {CANCEL} FROM flights GROUP BY departure_hour",
    "airport_seasonality": f"""
        SELECT origin AS airport,
               {rnd('avg(is_on_time) FILTER (WHERE month(flight_date) IN (12, 1, 2))', 4)} AS winter_on_time_rate,
               {rnd('avg(is_on_time) FILTER (WHERE month(flight_date) IN (6, 7, 8))', 4)} AS summer_on_time_rate,
               {rnd('avg(is_on_time) FILTER (WHERE month(flight_date) IN (3, 4, 5, 9, 10, 11))', 4)} AS shoulder_on_time_rate
        FROM flights GROUP BY origin""",
    "cabin_class_summary": f"""
        SELECT cabin_class, {PAX}, {rnd(div('sum(passengers)', 'sum(sum(passengers)) OVER ()'), 4)} AS passenger_share,
               {REVENUE}, {REVENUE_SHARE}, {FARE}
        FROM enriched WHERE flight_id IN (SELECT flight_id FROM flights WHERE is_cancelled = 0) GROUP BY cabin_class""",
    "airline_revenue": f"""
        SELECT airline, {PAX}, {REVENUE}, {REVENUE_SHARE}, {FARE},
               {rnd(div("coalesce(sum(revenue) FILTER (WHERE cabin_class = 'Business'), 0)", 'sum(revenue)'), 4)} AS business_revenue_share
        FROM enriched GROUP BY airline""",
    "monthly_passengers": f"""
        SELECT month, {PAX},
               CAST(coalesce(sum(passengers) FILTER (WHERE cabin_class = 'Economy'), 0) AS BIGINT) AS economy,
               CAST(coalesce(sum(passengers) FILTER (WHERE cabin_class = 'Premium Economy'), 0) AS BIGINT) AS premium_economy,
               CAST(coalesce(sum(passengers) FILTER (WHERE cabin_class = 'Business'), 0) AS BIGINT) AS business,
               {REVENUE}, {FARE},
               {rnd(div('sum(passengers)', 'lag(sum(passengers)) OVER (ORDER BY month)') + ' - 1', 4)} AS passenger_mom_change
        FROM enriched GROUP BY month""",
    "top_revenue_routes": f"""
        SELECT route, {PAX}, {REVENUE}, {REVENUE_SHARE}, {FARE},
               {rnd(div('sum(revenue)', 'count(DISTINCT flight_id)'), 2)} AS revenue_per_flight
        FROM enriched GROUP BY route ORDER BY revenue DESC, route LIMIT 10""",
    "route_performance": f"""
        SELECT route, origin, destination, max(distance_miles) AS distance_miles, count(*) AS flights, count(DISTINCT airline) AS airlines,
               {PAX}, {REVENUE}, {DELAY}, {OTR}, {CANCEL}, rank() OVER (ORDER BY sum(revenue) DESC) AS revenue_rank,
               rank() OVER (ORDER BY sum(passengers) DESC) AS passenger_rank
        FROM flights GROUP BY route, origin, destination""",
    "top_delayed_routes": f"""
        SELECT route, count(*) AS flights, {DELAY}, {OTR}, {CANCEL} FROM flights GROUP BY route HAVING count(*) >= 100
        ORDER BY avg_delay_minutes DESC NULLS LAST, route LIMIT 10""",
    "high_demand_poor_performance": f"""
        SELECT route, passengers, CAST(money AS DOUBLE) AS revenue, {rnd('punctuality', 4)} AS on_time_rate,
               {rnd('network', 4)} AS network_on_time_rate, {rnd('punctuality - network', 4)} AS on_time_gap, avg_delay_minutes, cancellation_rate
        FROM (SELECT *, ntile(4) OVER (ORDER BY passengers DESC, route) AS quartile, (SELECT avg(is_on_time) FROM flights) AS network
              FROM (SELECT route, {PAX}, sum(revenue) AS money, avg(is_on_time) AS punctuality, {DELAY}, {CANCEL} FROM flights GROUP BY route))
        WHERE quartile = 1 AND punctuality < network""",
    "route_airline_breakdown": f"""
        SELECT route, airline, count(*) AS flights, {PAX}, {OTR}, {DELAY} FROM flights
        WHERE route IN (SELECT route FROM flights GROUP BY route HAVING count(DISTINCT airline) > 1) GROUP BY route, airline""",
}
for _name, _sql in KPI.items():
    on_model(_name, _sql)
on_model("top_delayed_routes_from_20", KPI["top_delayed_routes"].replace(">= 100", ">= 20"))

# --- metric layer and panels -----------------------------------------------------------------------

FLIGHT_METRICS = f"""count(*) AS flights, avg(is_on_time) AS on_time_rate, avg(delay_minutes) AS avg_delay_minutes,
    avg(is_cancelled) AS cancellation_rate, avg(CASE WHEN is_cancelled = 1 OR delay_minutes >= 60 THEN 1 ELSE 0 END) AS disruption_rate,
    {PAX}, {REVENUE}"""
SALES = f"{PAX}, {REVENUE}, {div('sum(revenue)', 'sum(passengers)')} AS avg_ticket_price"
LABELS = """
    SELECT month, CASE WHEN (SELECT count(DISTINCT substr(month, 1, 4)) FROM flights) = 1 THEN strftime(CAST(month || '-01' AS DATE), '%b')
                       ELSE strftime(CAST(month || '-01' AS DATE), '%b %Y') END AS month_label
    FROM (SELECT DISTINCT month FROM flights)"""


def flight_metrics(key: str) -> str:
    return f"SELECT {key}, {FLIGHT_METRICS} FROM flights GROUP BY {key}"


def sales(keys: str) -> str:
    return f"SELECT {keys}, {SALES} FROM enriched GROUP BY {keys}"


CHOSEN = "month BETWEEN '1996-01' AND '1997-12' AND airline IN ('BUILDING', 'MACHINERY')"
CHOSEN_SALES = f"{CHOSEN} AND cabin_class IN ('Economy', 'Business')"

for _name, _sql in {
    "metric_flights_global": f"SELECT {FLIGHT_METRICS} FROM flights",
    "metric_flights_by_airline": flight_metrics("airline"),
    "metric_flights_by_month": flight_metrics("month"),
    "metric_bookings_by_cabin": sales("cabin_class"),
    "metric_executive": f"""
        SELECT count(*) AS total_flights, avg(is_on_time) AS on_time_rate, avg(delay_minutes) AS avg_delay_minutes,
               avg(is_cancelled) AS cancellation_rate, (SELECT CAST(sum(passengers) AS BIGINT) FROM bookings) AS total_passengers,
               (SELECT CAST(sum(revenue) AS DOUBLE) FROM bookings) AS total_revenue,
               (SELECT {div('sum(revenue)', 'sum(passengers)')} FROM bookings) AS avg_fare FROM flights""",
    "slice_filter": f"SELECT * REPLACE (CAST(revenue AS DOUBLE) AS revenue) FROM enriched WHERE {CHOSEN_SALES}",
    "slice_vs_network": f"""
        SELECT *, (on_time_rate - network_on_time_rate) * 100 AS on_time_rate_pp,
               (cancellation_rate - network_cancellation_rate) * 100 AS cancellation_rate_pp,
               avg_delay_minutes - network_avg_delay_minutes AS avg_delay_delta
        FROM (SELECT count(*) AS flights, avg(is_on_time) AS on_time_rate, avg(is_cancelled) AS cancellation_rate,
                     avg(delay_minutes) AS avg_delay_minutes FROM flights WHERE {CHOSEN}),
             (SELECT count(*) AS network_flights, avg(is_on_time) AS network_on_time_rate, avg(is_cancelled) AS network_cancellation_rate,
                     avg(delay_minutes) AS network_avg_delay_minutes FROM flights),
             (SELECT {PAX}, {REVENUE} FROM enriched WHERE {CHOSEN_SALES}),
             (SELECT CAST(sum(passengers) AS BIGINT) AS network_passengers, CAST(sum(revenue) AS DOUBLE) AS network_revenue FROM enriched)""",
    "month_labels": LABELS,
    "filter_values": """
        SELECT DISTINCT 'airline' AS field, airline AS value FROM flights UNION SELECT 'origin', origin FROM flights
        UNION SELECT 'destination', destination FROM flights UNION SELECT 'month', month FROM flights""",
    "cube_flights": f"""
        SELECT departure_hour, delay_category, airline, origin, destination, route, month, count(*) AS flights,
               CAST(sum(is_cancelled) AS BIGINT) AS cancelled, count(is_cancelled) AS cancelled_known,
               CAST(coalesce(sum(is_on_time), 0) AS BIGINT) AS on_time, count(is_on_time) AS operated,
               CAST(coalesce(sum(delay_minutes), 0) AS DOUBLE) AS delay, count(delay_minutes) AS delay_known,
               count(*) FILTER (WHERE is_cancelled = 1 OR delay_minutes >= 60) AS disrupted, {PAX}, {REVENUE}
        FROM flights GROUP BY ALL""",
    "cube_sales": f"SELECT cabin_class, airline, origin, destination, route, month, {PAX}, {REVENUE} FROM enriched GROUP BY ALL",
    "cube_by_month_folders": f"SELECT * FROM ({flight_metrics('month')}) JOIN ({LABELS}) USING (month)",
    "panel_monthly_flights": f"SELECT * FROM ({flight_metrics('month')}) JOIN ({LABELS}) USING (month)",
    "panel_monthly_passengers": f"SELECT * FROM ({sales('month')}) JOIN ({LABELS}) USING (month)",
    "panel_airline_on_time": flight_metrics("airline"),
    "panel_airport_delay": flight_metrics("origin"),
    "panel_airline_delay": flight_metrics("airline"),
    "panel_delayed_routes_adaptive": f"""
        SELECT * FROM (SELECT *, greatest(20, CAST(floor(quantile_cont(flights, 0.25) OVER ()) AS BIGINT)) AS min_flights FROM ({flight_metrics('route')}))
        WHERE flights >= min_flights ORDER BY avg_delay_minutes DESC NULLS LAST, route LIMIT 10""",
    "panel_cancellations": """
        SELECT origin, count(*) AS flights, CAST(sum(is_cancelled) AS BIGINT) AS cancelled, avg(is_cancelled) AS cancellation_rate
        FROM flights GROUP BY origin""",
    "panel_delay_distribution": f"""
        SELECT position, delay_category, count(flight_id) AS flights, {div('count(flight_id)', '(SELECT count(*) FROM flights)')} AS share
        FROM (VALUES (1, 'On time (<15)'), (2, '15-29'), (3, '30-59'), (4, '60-119'), (5, '120-179'), (6, '180+'), (7, 'Cancelled'))
             AS spine(position, delay_category) LEFT JOIN flights USING (delay_category) GROUP BY position, delay_category""",
    "panel_hour_profile": flight_metrics("departure_hour"),
    "panel_demand_vs_punctuality": f"""
        SELECT route, flights, passengers, on_time_rate, avg_delay_minutes, cancellation_rate, slice_on_time_rate, busy_from,
               passengers >= busy_from AND coalesce(on_time_rate < slice_on_time_rate, false) AS flagged
        FROM (SELECT *, quantile_cont(CAST(passengers AS DOUBLE), 0.75) OVER () AS busy_from, count(*) OVER () AS listed,
                     (SELECT avg(is_on_time) FROM flights) AS slice_on_time_rate
              FROM ({flight_metrics('route')}) WHERE flights >= 20) WHERE listed >= 4""",
    "panel_cabin_mix": f"""
        SELECT *, (SELECT {div("coalesce(sum(revenue) FILTER (WHERE cabin_class = 'Business'), 0)", 'greatest(sum(revenue), 1)')} FROM enriched)
                  AS business_share,
               CASE cabin_class WHEN 'Economy' THEN 0 WHEN 'Premium Economy' THEN 1 ELSE 2 END AS cabin_rank
        FROM ({sales('cabin_class')})""",
    "panel_top_routes_passengers": f"SELECT * FROM ({sales('route')}) ORDER BY passengers DESC, route LIMIT 15",
    "panel_airline_revenue": sales("airline"),
    "panel_fare_airline_cabin": sales("airline, cabin_class"),
    "panel_monthly_cabin": f"SELECT * FROM ({sales('month, cabin_class')}) JOIN ({LABELS}) USING (month)",
    "panel_top_routes_revenue": f"""
        SELECT route, {SALES}, {div('sum(revenue)', 'sum(sum(revenue)) OVER ()')} AS revenue_share
        FROM enriched GROUP BY route ORDER BY revenue DESC, route LIMIT 15""",
    "slice_flights": f"SELECT {FLIGHT_LIST}, {MONEY_LIST} FROM flights WHERE {CHOSEN}",
    "panel_airline_delay_on_slice": f"SELECT airline, {FLIGHT_METRICS} FROM flights WHERE {CHOSEN} GROUP BY airline",
    "panel_fare_airline_cabin_on_slice": f"SELECT airline, cabin_class, {SALES} FROM enriched WHERE {CHOSEN_SALES} GROUP BY airline, cabin_class",
    "panel_monthly_passengers_on_slice": f"""
        SELECT * FROM (SELECT month, {SALES} FROM enriched WHERE {CHOSEN_SALES} GROUP BY month) JOIN ({LABELS}) USING (month)""",
    "panel_delayed_routes_on_slice": f"""
        SELECT * FROM (SELECT *, greatest(20, CAST(floor(quantile_cont(flights, 0.25) OVER ()) AS BIGINT)) AS min_flights
                       FROM (SELECT route, {FLIGHT_METRICS} FROM flights WHERE {CHOSEN} GROUP BY route))
        WHERE flights >= min_flights ORDER BY avg_delay_minutes DESC NULLS LAST, route LIMIT 10""",
    "panel_top_routes_revenue_on_slice": f"""
        SELECT route, {SALES}, {div('sum(revenue)', 'sum(sum(revenue)) OVER ()')} AS revenue_share
        FROM enriched WHERE {CHOSEN_SALES} GROUP BY route ORDER BY revenue DESC, route LIMIT 15""",
    "reconcile_headline": """
        SELECT position, metric, metric_value, kpi_value, tolerance, abs(metric_value - kpi_value) <= tolerance AS agrees FROM (
        SELECT 1 AS position, 'total_flights' AS metric, CAST(count(*) AS DOUBLE) AS metric_value, CAST(count(*) AS DOUBLE) AS kpi_value, 0.0::DOUBLE AS tolerance FROM flights
        UNION ALL SELECT 2, 'total_passengers', (SELECT CAST(sum(passengers) AS DOUBLE) FROM bookings), CAST(sum(passengers) AS DOUBLE), 0 FROM flights
        UNION ALL SELECT 3, 'on_time_rate', avg(is_on_time), {otr}, 1e-4 FROM flights
        UNION ALL SELECT 4, 'cancellation_rate', avg(is_cancelled), {cancel}, 1e-4 FROM flights
        UNION ALL SELECT 5, 'avg_delay_minutes', avg(delay_minutes), {delay}, 0.01 FROM flights
        UNION ALL SELECT 6, 'total_revenue', (SELECT CAST(sum(revenue) AS DOUBLE) FROM bookings), CAST(sum(revenue) AS DOUBLE), 1 FROM flights)
        """.format(otr=rnd("avg(is_on_time)", 4), cancel=rnd("avg(is_cancelled)", 4), delay=rnd("avg(delay_minutes)", 2)),
    "reconcile_by_airline": f"""
        SELECT airline, avg(is_on_time) AS metric_rate, {rnd('avg(is_on_time)', 4)} AS kpi_rate,
               abs(avg(is_on_time) - {rnd('avg(is_on_time)', 4)}) < 1e-4 AS agrees FROM flights GROUP BY airline""",
}.items():
    on_model(_name, _sql)

# --- insights and report tables --------------------------------------------------------------------


def on_results(name: str, body: str, *results: str) -> None:
    ORACLES[name] = with_steps(body, "enriched", **{f"r_{r}": KPI[r] for r in results})


FINDINGS: dict[str, str] = {}


def finding(name: str, body: str, *results: str) -> None:
    FINDINGS[name] = body
    on_results(f"insight_{name}", body, *results)


finding(
    "airline_extremes",
    """SELECT w.airline AS worst_airline, w.delay_rate AS worst_delay_rate, w.avg_delay_minutes AS worst_avg_delay,
              b.airline AS best_airline, b.delay_rate AS best_delay_rate
       FROM (SELECT * FROM r_airline_performance ORDER BY on_time_rate, airline LIMIT 1) w,
            (SELECT * FROM r_airline_performance ORDER BY on_time_rate DESC, airline DESC LIMIT 1) b""",
    "airline_performance",
)
finding(
    "disruption",
    f"""SELECT t.airport AS most_disrupted, t.disruption_rate AS most_rate, c.airport AS least_disrupted, c.disruption_rate AS least_rate,
               n.rate AS network_disruption_rate, {rnd(div('t.disruption_rate', 'n.rate'), 4)} AS times_network
        FROM (SELECT * FROM r_airport_performance ORDER BY disruption_rate DESC, airport LIMIT 1) t,
             (SELECT * FROM r_airport_performance ORDER BY disruption_rate, airport DESC LIMIT 1) c,
             (SELECT {rnd(div('sum(CAST(disruption_rate AS DECIMAL(10,4)) * departures)', 'sum(departures)'), 6)} AS rate FROM r_airport_performance) n""",
    "airport_performance",
)
finding(
    "cancellation",
    """SELECT airport, cancellation_rate, (SELECT cancellation_rate FROM r_executive_kpis) AS network_cancellation_rate
       FROM r_airport_performance ORDER BY cancellation_rate DESC, airport LIMIT 1""",
    "airport_performance", "executive_kpis",
)
finding(
    "revenue_concentration",
    """SELECT route, revenue, revenue_share, (SELECT CAST(sum(CAST(revenue_share AS DECIMAL(10,4))) AS DOUBLE) FROM r_top_revenue_routes) AS top_routes_share
       FROM r_top_revenue_routes ORDER BY revenue DESC, route LIMIT 1""",
    "top_revenue_routes",
)
finding(
    "risky_routes",
    """SELECT count(*) AS routes, (SELECT on_time_rate FROM r_executive_kpis) AS network_on_time_rate,
              (SELECT string_agg(route, ', ' ORDER BY passengers DESC, route) FROM
                  (SELECT * FROM r_high_demand_poor_performance ORDER BY passengers DESC, route LIMIT 3)) AS biggest
       FROM r_high_demand_poor_performance HAVING count(*) > 0""",
    "high_demand_poor_performance", "executive_kpis",
)


def _weighted(column: str, kind: str, hours: str) -> str:
    return rnd(
        div(
            f"sum(CAST({column} AS {kind}) * flights) FILTER (WHERE departure_hour {hours})",
            f"sum(flights) FILTER (WHERE departure_hour {hours})",
        ),
        6,
    )


finding(
    "daypart",
    f"""SELECT {_weighted('avg_delay_minutes', 'DECIMAL(18,2)', '< 9')} AS morning_delay, {_weighted('on_time_rate', 'DECIMAL(10,4)', '< 9')} AS morning_on_time_rate,
               {_weighted('avg_delay_minutes', 'DECIMAL(18,2)', '>= 18')} AS evening_delay, {_weighted('on_time_rate', 'DECIMAL(10,4)', '>= 18')} AS evening_on_time_rate
        FROM r_delay_by_hour""",
    "delay_by_hour",
)
finding(
    "months",
    """SELECT w.month AS worst_month, strftime(CAST(w.month || '-01' AS DATE), '%B') AS worst_month_name, w.on_time_rate AS worst_on_time_rate,
              b.month AS best_month, strftime(CAST(b.month || '-01' AS DATE), '%B') AS best_month_name, b.on_time_rate AS best_on_time_rate,
              p.month AS peak_month, strftime(CAST(p.month || '-01' AS DATE), '%B') AS peak_month_name, p.passengers AS peak_passengers
       FROM (SELECT * FROM r_monthly_trends ORDER BY on_time_rate NULLS LAST, month LIMIT 1) w,
            (SELECT * FROM r_monthly_trends ORDER BY on_time_rate DESC NULLS LAST, month DESC LIMIT 1) b,
            (SELECT * FROM r_monthly_trends ORDER BY passengers DESC, month DESC LIMIT 1) p""",
    "monthly_trends",
)
finding(
    "business",
    """SELECT b.passenger_share, b.revenue_share, b.avg_ticket_price AS business_fare, e.avg_ticket_price AS economy_fare
       FROM r_cabin_class_summary b, r_cabin_class_summary e WHERE b.cabin_class = 'Business' AND e.cabin_class = 'Economy'""",
    "cabin_class_summary",
)
HEADLINE_ORDER = (
    "total_flights", "total_passengers", "total_revenue", "avg_fare", "on_time_rate", "avg_delay_minutes", "cancellation_rate", "cancelled_flights",
)
HEADLINE_ROWS = " UNION ALL ".join(
    f"SELECT {i} AS position, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM r_executive_kpis" for i, m in enumerate(HEADLINE_ORDER, 1)
)
on_results("report_headline_rows", HEADLINE_ROWS, "executive_kpis")
CABIN_REVENUE = "SELECT cabin_class, revenue, revenue_share, avg_ticket_price FROM r_cabin_class_summary"
on_results("report_cabin_revenue", CABIN_REVENUE, "cabin_class_summary")
# The order in which each result is written.
ORDER = {
    "executive_kpis": "total_flights",
    "airline_performance": "on_time_rate DESC NULLS LAST, airline",
    "monthly_trends": "month",
    "delay_by_time_of_day": "array_position(['Morning', 'Afternoon', 'Evening', 'Night'], time_of_day)",
    "airport_performance": "disruption_rate DESC NULLS LAST, airport",
    "delay_by_hour": "departure_hour",
    "airport_seasonality": "winter_on_time_rate NULLS FIRST, airport",
    "cabin_class_summary": "avg_ticket_price NULLS FIRST, cabin_class",
    "airline_revenue": "revenue DESC, airline",
    "monthly_passengers": "month",
    "top_revenue_routes": "revenue DESC, route",
    "route_performance": "revenue DESC, route",
    "top_delayed_routes": "avg_delay_minutes DESC NULLS LAST, route",
    "high_demand_poor_performance": "passengers DESC, route",
    "route_airline_breakdown": "route, on_time_rate DESC NULLS LAST, airline",
}


def cells(label: str, source: str, order: str) -> str:
    """One row per value of a table, numbered in its order."""
    return f"""
        SELECT {label}, row_no, column_name, CASE WHEN TRY_CAST(value AS DOUBLE) IS NULL THEN value END AS text, TRY_CAST(value AS DOUBLE) AS number
        FROM (UNPIVOT (SELECT CAST(COLUMNS(t.*) AS VARCHAR), row_number() OVER (ORDER BY {order}) AS row_no FROM {source} t)
              ON COLUMNS(* EXCLUDE (row_no)) INTO NAME column_name VALUE value)"""


on_results(
    "sink_kpi_tables",
    " UNION ALL ".join(cells(f"'{name}' AS table_name", f"r_{name}", ORDER[name]) for name in KPI),
    *KPI,
)


def said(value: str, places: int = 1) -> str:
    return f"format('{{:,.{places}f}}', {rnd(value, places)})"


def percent(value: str) -> str:
    return f"{said(f'{value} * 100')} || '%'"


# Each finding's measures (the query of the same name) and its sentence.
SENTENCES = {
    "airline_extremes": "'Least punctual airline: ' || worst_airline || ', late on ' || " + percent("worst_delay_rate")
    + " || ' of operated flights with ' || " + said("worst_avg_delay") + " || ' min average delay. Most punctual: ' || best_airline"
    + " || ', late on ' || " + percent("best_delay_rate") + " || '.'",
    "disruption": "'Most disrupted airport: ' || most_disrupted || ' at ' || " + percent("most_rate") + " || ' of departures, ' || "
    + said("times_network") + " || ' times the network''s ' || " + percent("network_disruption_rate")
    + " || '. Least disrupted: ' || least_disrupted || ' at ' || " + percent("least_rate") + " || '.'",
    "cancellation": "'Most cancellations: ' || airport || ' at ' || " + percent("cancellation_rate") + " || ' of departures; network ' || "
    + percent("network_cancellation_rate") + " || '.'",
    "revenue_concentration": "'Leading route by revenue: ' || route || ' with $' || " + said("revenue / 1e6") + " || 'M or ' || "
    + percent("revenue_share") + " || ' of the total; the leading routes together hold ' || " + percent("top_routes_share") + " || '.'",
    "risky_routes": "'Busy routes below the network''s ' || " + percent("network_on_time_rate")
    + " || ' on-time rate: ' || routes || '. Largest: ' || biggest || '.'",
    "daypart": "'Departures before 09:00 average ' || " + said("morning_delay") + " || ' min delay (' || " + percent("morning_on_time_rate")
    + " || ' on time); from 18:00 it is ' || " + said("evening_delay") + " || ' min (' || " + percent("evening_on_time_rate") + " || ' on time).'",
    "months": "'Punctuality was lowest in ' || worst_month_name || ' (' || " + percent("worst_on_time_rate")
    + " || ') and highest in ' || best_month_name || ' (' || " + percent("best_on_time_rate")
    + " || '). Passengers peaked in ' || peak_month_name || ' with ' || format('{:,}', peak_passengers) || '.'",
    "business": "'Business carries ' || " + percent("passenger_share") + " || ' of passengers and ' || " + percent("revenue_share")
    + " || ' of revenue; its average fare is $' || " + said("business_fare", 0) + " || ', Economy''s $' || " + said("economy_fare", 0) + " || '.'",
}
LARGEST = (
    "string_agg(route || ' with ' || format('{:,}', passengers) || ' passengers at ' || " + percent("on_time_rate")
    + " || ' on time', '; ' ORDER BY passengers DESC, route)"
)
FINDINGS["risky_routes"] = FINDINGS["risky_routes"].replace("string_agg(route, ', ' ORDER BY passengers DESC, route)", LARGEST)
INSIGHTS = " UNION ALL ".join(
    f"SELECT CAST({i} AS BIGINT) AS insight_no, '{kind}' AS kind, {sentence} AS text FROM ({FINDINGS[kind]})"
    for i, (kind, sentence) in enumerate(SENTENCES.items(), 1)
)
on_results("insights_all", INSIGHTS, *KPI)
on_results(
    "sink_insights_text",
    f"SELECT '# Key Insights' AS value UNION ALL SELECT '' UNION ALL SELECT '- ' || text FROM ({INSIGHTS})",
    *KPI,
)
SHEET_TABLES = {
    "Executive Summary": ("headline_kpis", "insights", "cleaning_report"),
    "Airline Performance": ("airline_performance", "delay_by_time_of_day", "monthly_trends"),
    "Route Analysis": ("high_demand_poor_performance", "top_delayed_routes", "route_performance", "route_airline_breakdown"),
    "Airport Analysis": ("airport_performance", "airport_seasonality", "delay_by_hour"),
    "Passenger Analysis": ("monthly_passengers", "cabin_class_summary"),
    "Revenue Analysis": ("airline_revenue", "top_revenue_routes", "cabin_revenue"),
}
TABLE_ROWS = {name: f"(SELECT count(*) FROM r_{name})" for name in KPI} | {
    "headline_kpis": "8",
    "insights": "(SELECT 7 + CASE WHEN count(*) > 0 THEN 1 ELSE 0 END FROM r_high_demand_poor_performance)",
    "cleaning_report": "14",
    "cabin_revenue": "(SELECT count(*) FROM r_cabin_class_summary)",
}
on_results(
    "mart_report_index",
    " UNION ALL ".join(
        f"SELECT '{sheet}' AS sheet, {i} AS position, '{name}' AS table_name, {TABLE_ROWS[name]} AS rows"
        for sheet, names in SHEET_TABLES.items()
        for i, name in enumerate(names, 1)
    ),
    *KPI,
)

REPORT_SOURCES = {name: (f"r_{name}", ORDER[name]) for name in KPI} | {
    "headline_kpis": (f"({HEADLINE_ROWS})", "position"),
    "insights": (f"({INSIGHTS})", "insight_no"),
    "cleaning_report": (f"({REPORT})", "position"),
    "cabin_revenue": (f"({CABIN_REVENUE})", ORDER["cabin_class_summary"]),
}
ORACLES["mart_report_cells"] = with_steps(
    " UNION ALL ".join(
        cells(f"'{sheet}' AS sheet, '{name}' AS table_name", *REPORT_SOURCES[name]) for sheet, names in SHEET_TABLES.items() for name in names
    ),
    "clean",
    **{f"r_{name}": sql for name, sql in KPI.items()},
)

# --- geography and calendar -------------------------------------------------------------------------

on_model(
    "route_distance_matrix",
    """SELECT origin, destination, CAST(round_even(2 * 3958.8 * asin(sqrt(h)), 0) AS INT) AS miles
       FROM (SELECT origin, destination, pow(sin((radians(b.lat) - radians(a.lat)) / 2), 2)
                    + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin((radians(b.lon) - radians(a.lon)) / 2), 2) AS h
             FROM (SELECT DISTINCT origin, destination FROM flights)
             JOIN (SELECT n_name, n_nationkey * 5.0::DOUBLE - 60 AS lat, n_nationkey * 13.0::DOUBLE - 170 AS lon FROM nation) a ON a.n_name = origin
             JOIN (SELECT n_name, n_nationkey * 5.0::DOUBLE - 60 AS lat, n_nationkey * 13.0::DOUBLE - 170 AS lon FROM nation) b ON b.n_name = destination)""",
)
on_model(
    "calendar_spine",
    """SELECT s.airline, strftime(s.day, '%Y-%m-%d') AS flight_date, count(f.flight_id) AS flights
       FROM (SELECT airline, CAST(unnest(generate_series(min(flight_date), max(flight_date), INTERVAL 1 DAY)) AS DATE) AS day
             FROM flights GROUP BY airline) s
       LEFT JOIN flights f ON f.airline = s.airline AND f.flight_date = s.day GROUP BY s.airline, s.day""",
)
on_model(
    "calendar_of_period",
    """SELECT s.airline, strftime(s.day, '%Y-%m-%d') AS flight_date, count(f.flight_id) AS flights
       FROM (SELECT airline, CAST(unnest(generate_series(min(flight_date), max(flight_date), INTERVAL 1 DAY)) AS DATE) AS day
             FROM flights WHERE flight_date BETWEEN '1995-06-01' AND '1997-05-31' GROUP BY airline) s
       LEFT JOIN flights f ON f.airline = s.airline AND f.flight_date = s.day GROUP BY s.airline, s.day""",
)
on_model(
    "check_calendar_dates",
    """SELECT airline, count(*) AS flights FROM flights
       WHERE flight_date IS NULL OR flight_date NOT BETWEEN '1995-06-01' AND '1997-05-31' GROUP BY airline""",
)
on_model(
    "cabin_fanout",
    """SELECT flight_id, aircraft, cabin_class, seats FROM flights
       JOIN (SELECT aircraft, cabin_class, max(bookings.passengers) AS seats FROM flights JOIN bookings USING (flight_id)
             GROUP BY aircraft, cabin_class) USING (aircraft)""",
)
