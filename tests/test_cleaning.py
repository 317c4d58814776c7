import datetime
import random

import pytest
from pyspark.sql import functions as F

from skyledger.operators import joins
from skyledger.plans import cleaning as C
from skyledger.session import stage


def rows_of(feed, *columns):
    return {r["src_row"]: tuple(r[c] for c in columns) for r in C.clean(feed).audited.collect()}


def report_of(feed):
    return {r["metric"]: r["value"] for r in C.clean(feed).report.collect()}


def test_delay_is_derived_from_times_with_one_sided_rollover(feed_of):
    feed = feed_of(
        {"Flight": "A1", "Scheduled Departure": "23:50", "Actual Departure": "00:10", "Delay (min)": ""},
        {"Flight": "A2", "Scheduled Departure": "00:05", "Actual Departure": "23:58", "Delay (min)": ""},
        {"Flight": "A3", "Scheduled Departure": "10:00", "Actual Departure": "09:55", "Delay (min)": "bad"},
    )
    assert rows_of(feed, "departure_variance") == {0: (20,), 1: (1433,), 2: (-5,)}
    assert report_of(feed)["delays_derived_from_times"] == 3


def test_actual_time_is_rebuilt_from_the_delay(feed_of):
    feed = feed_of({"Scheduled Departure": "00:05", "Actual Departure": "", "Delay (min)": "-7"})
    assert rows_of(feed, "actual_departure", "delay_minutes") == {0: ("23:58", 0.0)}
    assert report_of(feed)["actual_departures_rebuilt"] == 1


def test_delay_is_borrowed_from_the_first_sibling_and_the_time_is_not_rebuilt(feed_of):
    gone = {"Actual Departure": "", "Delay (min)": ""}
    feed = feed_of(
        {"Cabin Class": "Economy", **gone},
        {"Cabin Class": "Business", "Delay (min)": "30", "Actual Departure": "10:30"},
        {"Cabin Class": "Premium Economy", "Delay (min)": "40", "Actual Departure": "10:40"},
        {"Flight": "X9", **gone},
    )
    assert rows_of(feed, "departure_variance", "actual_departure") == {0: (30, None), 1: (30, "10:30"), 2: (40, "10:40")}
    assert report_of(feed)["rows_dropped_no_departure_data"] == 1


def test_a_cancelled_row_can_donate_but_ends_without_times_and_passengers(feed_of):
    feed = feed_of(
        {"Cabin Class": "Economy", "Cancelled": "Yes", "Delay (min)": "25", "Actual Departure": "10:25", "Passengers": "80"},
        {"Cabin Class": "Business", "Actual Departure": "", "Delay (min)": ""},
    )
    seen = rows_of(feed, "departure_variance", "actual_departure", "is_on_time", "delay_category", "passengers")
    assert seen == {0: (None, None, None, "Cancelled", 0), 1: (25, None, 0, "15-29", 100)}


def test_missing_flight_key_borrows_nothing(feed_of):
    feed = feed_of(
        {"Date": "never", "Cabin Class": "Economy", "Actual Departure": "", "Delay (min)": ""},
        {"Date": "never", "Cabin Class": "Business", "Delay (min)": "9"},
    )
    assert list(rows_of(feed, "flight_id")) == [1]


def test_duplicates_are_counted_by_kind_and_the_first_in_file_order_stays(feed_of):
    feed = feed_of(
        {"src_row": 5, "Ticket Price": "$10.00"},
        {"src_row": 3, "Ticket Price": "$20.00"},
        {"src_row": 4, "Ticket Price": " $20.00 "},
        {"src_row": 9, "Airline": "BLUE AIR"},
    )
    assert rows_of(feed, "ticket_price") == {3: (20,)}
    report = report_of(feed)
    assert (report["raw_rows"], report["exact_duplicates_removed"], report["key_duplicates_removed"]) == (4, 1, 2)
    assert report["prices_with_currency_symbol_fixed"] == 2
    assert (report["clean_rows"], report["flights"]) == (1, 1)


def test_invalid_rows_and_prices(feed_of):
    feed = feed_of(
        {"Flight": "A", "Origin": "aaa", "Destination": "AAA"},
        {"Flight": "B", "Cancelled": "maybe"},
        {"Flight": "C", "Origin": ""},
        {"Flight": "D", "Ticket Price": "-5"},
        {"Flight": "E", "Ticket Price": "0"},
        {"Flight": "F", "Ticket Price": "60"},
    )
    kept = rows_of(feed, "flight_number", "ticket_price")
    assert sorted(v[0] for v in kept.values()) == ["C", "D", "E", "F"]
    assert kept[3] == ("D", 60) and kept[4] == ("E", 60)
    report = report_of(feed)
    assert (report["invalid_prices_nulled"], report["invalid_rows_dropped"]) == (2, 2)


def test_imputation_uses_the_right_groups(feed_of):
    feed = feed_of(
        {"Flight": "A", "Date": "2024-03-01", "Distance (mi)": "", "Passengers": "", "Ticket Price": ""},
        {"Flight": "A", "Date": "2025-03-02", "Distance (mi)": "100", "Passengers": "10", "Ticket Price": "50"},
        {"Flight": "A", "Date": "2025-03-03", "Distance (mi)": "101", "Passengers": "13", "Ticket Price": "60"},
        {"Flight": "A", "Date": "2025-04-04", "Distance (mi)": "900", "Passengers": "0", "Ticket Price": "999", "Cancelled": "y"},
        {"Flight": "Z", "Origin": "QQQ", "Distance (mi)": "", "Passengers": "", "Ticket Price": ""},
    )
    kept = rows_of(feed, "distance_miles", "passengers", "ticket_price", "revenue")
    # Distance by route (median 101), load by flight and cabin with the cancelled zero (10),
    # fare by route, cabin and month over all years (55).
    assert tuple(map(float, kept[0])) == (101, 10, 55, 550)
    assert kept[4] == (None, None, None, None)
    report = report_of(feed)
    assert [report[m] for m in ("distance_imputed_from_route", "passengers_imputed", "ticket_prices_imputed")] == [2, 2, 2]


def test_half_passengers_round_to_even_and_half_miles_are_cut(feed_of):
    feed = feed_of(
        {"Date": "2025-03-01", "Passengers": "", "Distance (mi)": ""},
        {"Date": "2025-03-02", "Passengers": "2", "Distance (mi)": "10"},
        {"Date": "2025-03-03", "Passengers": "3", "Distance (mi)": "11"},
    )
    assert rows_of(feed, "passengers", "distance_miles")[0] == (2, 10)


def test_derived_columns(feed_of):
    feed = feed_of({"Flight": "ns7", "Date": "03/15/2025", "Origin": "abc", "Scheduled Departure": "17:45", "Delay (min)": "14.5",
                    "Airline": "  BLUE air ", "Cabin Class": "BUSINESS", "Ticket Price": "$10.25", "Passengers": "3"})
    row = C.clean(feed).rows.collect()[0]
    assert row["flight_id"] == "NS7_20250315" and row["flight_date"] == datetime.date(2025, 3, 15)
    assert (row["month"], row["day_of_week"], row["route"]) == ("2025-03", "Saturday", "ABC-BBB")
    assert (row["departure_hour"], row["time_of_day"]) == (17, "Evening")
    # 14.5 minutes counts as on time and yet falls into the second bin.
    assert (row["is_on_time"], row["delay_category"]) == (1, "15-29")
    assert (row["airline"], row["cabin_class"], row["cabin_rank"], float(row["revenue"])) == ("Blue Air", "Business", 2, 30.75)


def noisy(feed_of, shuffle_seed=None):
    random.seed(3)
    rows = []
    for i in range(400):
        cabin = random.choice(["Economy", "Business", "premium economy"])
        rows.append({
            "src_row": i, "Flight": f"F{random.randint(1, 12)}", "Date": f"2025-0{random.randint(1, 3)}-{random.randint(10, 28)}",
            "Cabin Class": cabin, "Origin": random.choice(["aaa", "CCC"]), "Delay (min)": random.choice(["", "5", "70"]),
            "Actual Departure": random.choice(["", "10:20"]), "Passengers": random.choice(["", "10", "20", "31"]),
            "Ticket Price": random.choice(["", "$20.5", "30", "-1"]), "Cancelled": random.choice(["no", "N", "yes"]),
            "Distance (mi)": random.choice(["", "400", "401"]),
        })
    if shuffle_seed is not None:
        random.seed(shuffle_seed)
        random.shuffle(rows)
    return feed_of(*rows)


def test_result_does_not_depend_on_the_order_rows_arrive_in(feed_of):
    one, other = (sorted(map(str, C.clean(noisy(feed_of, seed)).rows.collect())) for seed in (None, 8))
    assert one == other and len(one) > 100


def test_hot_group_of_copies_is_cleaned_whole(feed_of):
    hot = [{"Passengers": str(i % 7)} for i in range(3000)]
    rest = [{"Flight": f"R{i}"} for i in range(50)]
    feed = feed_of(*hot, *rest)
    report = report_of(feed)
    assert report["clean_rows"] == 51 and report["raw_rows"] == 3050
    assert report["exact_duplicates_removed"] == 3000 - 7 and report["key_duplicates_removed"] == 6


def test_cleaning_clean_rows_changes_nothing(feed_of):
    first = stage(C.clean(noisy(feed_of)).rows, "first").where(F.col("ticket_price").isNotNull() & F.col("distance_miles").isNotNull())
    back = {canonical: source for source, canonical in C.K.SOURCE_COLUMNS.items()}
    feed = first.select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(back[c]) for c in C.K.FEED_COLUMNS], "src_row"
    )
    again = C.clean(feed).rows.select(first.columns)
    # A borrowed delay leaves the time blank; the second run can rebuild it.
    compared = [c for c in first.columns if c != "actual_departure"]
    assert sorted(map(str, again.select(compared).collect())) == sorted(map(str, first.select(compared).collect()))


def test_against_a_plain_python_recount(feed_of):
    """Key duplicates and donors recounted row by row."""
    feed = noisy(feed_of)
    raw = sorted(feed.collect(), key=lambda r: r["src_row"])
    first = {}
    for r in raw:
        first.setdefault((r["Flight"], r["Date"], r["Cabin Class"].title()), r)
    kept = [r for r in first.values() if r["Origin"].upper() != r["Destination"]]

    def variance(r):
        cancelled = r["Cancelled"] == "yes"
        if r["Delay (min)"]:
            return float(r["Delay (min)"])
        return 20.0 if r["Actual Departure"] and not cancelled else None

    donors = {}
    for r in sorted(kept, key=lambda r: r["src_row"]):
        if variance(r) is not None:
            donors.setdefault((r["Flight"], r["Date"]), variance(r))
    expected = {}
    for r in kept:
        v = variance(r) if variance(r) is not None else donors.get((r["Flight"], r["Date"]))
        if r["Cancelled"] == "yes":
            expected[r["src_row"]] = None
        elif v is not None:
            expected[r["src_row"]] = v
    assert {k: v[0] for k, v in rows_of(feed, "departure_variance").items()} == expected


def test_empty_feed(feed_of):
    feed = feed_of({}).limit(0)
    cleaned = C.clean(feed)
    assert cleaned.rows.count() == 0
    assert {r["value"] for r in cleaned.report.collect()} == {0}


@pytest.mark.parametrize("column", ["departure_variance", "distance_miles", "passengers"])
def test_text_in_a_number_column_is_missing(feed_of, column):
    prepared = C.prepare(feed_of({"Delay (min)": "12d", "Distance (mi)": "NaN", "Passengers": "1,200", "Actual Departure": ""}))
    assert prepared.collect()[0][column] is None


def test_rows_without_a_readable_date_are_nobodys_copies(feed_of):
    from skyledger.plans import cleaning, quality

    dates = ("14.03.2025", "15.03.2025", "16.03.2025", "2025-03-17")
    cleaned = cleaning.clean(feed_of(*({"Date": d} for d in dates)))
    report = {r["metric"]: r["value"] for r in cleaned.report.collect()}
    assert cleaned.rows.count() == 4 and report["key_duplicates_removed"] == 0
    checks = {r["metric"]: r["value"] for r in quality.all_checks(cleaned.rows).collect()}
    assert checks["required_nulls"] >= 3


def test_values_out_of_range_become_null(feed_of):
    from skyledger.plans import cleaning

    odd = ({"Distance (mi)": "1e30"}, {"Passengers": "1e400"}, {"Scheduled Departure": "1e12:00"}, {"Delay (min)": "1e400"}, {"Ticket Price": "1e300"})
    rows = cleaning.clean(feed_of(*({"Flight": f"NS{i}", **o} for i, o in enumerate(odd)))).rows.collect()
    found = {r.flight_number: r for r in rows}
    assert len(found) == 5 and found["NS0"].distance_miles is None and found["NS2"].departure_hour is None
    assert found["NS4"].revenue is None


def test_gaps_of_a_hot_route_are_dealt_over_many_parts(spark, feed_of):
    gaps = spark.createDataFrame([("A" if i % 3 else f"R{i}" if i % 2 else None, i) for i in range(3000)], "k string, src_row long")
    lookup = spark.createDataFrame([("A", 1.0), ("R3", 2.0), ("none", 3.0)], "k string, v double")
    plain = gaps.join(lookup, "k", "left")
    for key_rows in (100, 7, 10**6):
        spread = joins.spread_left_join(gaps, lookup, ["k"], "src_row", key_rows)
        assert sorted(map(str, spread.collect())) == sorted(map(str, plain.collect()))
    # No part of the hot key, which has two thirds of the rows, has more than a few times the asked rows.
    parts = gaps.where("k = 'A'").groupBy(F.pmod(F.xxhash64("src_row"), F.lit(20))).count()
    assert parts.agg(F.max("count")).first()[0] < 200
    feed = noisy(feed_of)
    cleaned = C.clean(feed)
    spread = C.impute(cleaned.settled, cleaned.medians, few=0)
    assert sorted(map(str, spread.collect())) == sorted(map(str, C.impute(cleaned.settled, cleaned.medians).collect()))


def test_copies_meet_by_fingerprint_and_keep_their_counts(spark, feed_of):
    """Null and empty, and values that move between columns, are different rows."""
    rows = [{"Aircraft": "A320", "Airline": "B"}, {"Aircraft": "A320", "Airline": "B"}, {"Aircraft": "B", "Airline": "A320"}]
    feed = feed_of(*rows, *rows, {"Date": "soon"}, {"Date": "soon"}, {"Date": "later"}, {"Date": ""}).repartition(3)
    kept = C.keep_first(feed.transform(C.rename).transform(C.strip_text))
    found = sorted((r.src_row, r.raw_rows, r.distinct_rows) for r in kept.collect())
    assert found == [(0, 6, 2), (6, 2, 1), (8, 1, 1), (9, 1, 1)]


def test_medians_are_found_for_groups_with_a_gap_only(monkeypatch, feed_of):
    feed = feed_of(
        {"Flight": "A", "Date": "2025-03-01", "Passengers": ""},
        {"Flight": "A", "Date": "2025-03-02", "Passengers": "30"},
        *[{"Flight": f"B{i}", "Passengers": "10"} for i in range(5)],
    )
    cleaned = C.clean(feed)
    assert [(m["measure"], m["key_1"], m["typical"]) for m in cleaned.medians.collect()] == [("passengers", "A", 30)]
    filled = sorted(map(str, cleaned.rows.collect()))
    # Groups that are too many to be sent to every task are not narrowed; the rows are the same.
    monkeypatch.setattr(C, "FEW_GROUPS", 0)
    whole = C.clean(feed)
    assert whole.medians.count() > 1 and sorted(map(str, whole.rows.collect())) == filled


def test_rows_are_typed_once(feed_of):
    """The feed as it came, the winners and the kept rows all read the typed table."""
    cleaned = C.clean(feed_of({"Ticket Price": "$5"}, {"Ticket Price": "$5"}, {"Date": "never"}))
    assert cleaned.delivered.count() == 3 and cleaned.rows.count() == 2
    plan = cleaned.delivered._jdf.queryExecution().executedPlan().toString()
    assert "BatchScan" in plan or "FileScan" in plan
    assert "btrim" not in plan and "initcap" not in plan and "gettimestamp" not in plan


def _some_repeated(feed_of):
    """Copies, copies of a key, unreadable dates and missing parts of a key, beside rows of their own."""
    return feed_of(
        {"Flight": "A1"}, {"Flight": "A1"}, {"Flight": "a1", "Ticket Price": "$7"}, {"Flight": "A1", "Date": "03/14/2025"},
        {"Flight": "A2", "Ticket Price": "$8"}, {"Flight": "A3"}, {"Flight": ""}, {"Flight": "", "Cabin Class": "Business"},
        {"Flight": "", "Airline": "Red Air"}, {"Flight": "A4", "Date": "never"}, {"Flight": "A4", "Date": "never"},
        {"Flight": "A4", "Date": "later"}, {"Flight": "A5", "Date": "never", "Ticket Price": "$9"}, {"Flight": "A6"},
    )


def test_rows_of_unrepeated_keys_are_their_own_winners(monkeypatch, feed_of):
    sent, whole = [], C._won
    monkeypatch.setattr(C, "_won", lambda typed: sent.append(typed.count()) or whole(typed))
    typed = C._type_feed(_some_repeated(feed_of))
    columns = typed.drop("print_a", "print_b", "had_symbol", "bad_date").columns + ["raw_rows", "distinct_rows", "symbol_rows"]
    quick, long = (sorted(map(repr, C.first_of(typed, few).select(*columns).collect())) for few in (C.FEW_REPEATED, 0))
    assert quick == long and len(quick) == 9
    assert sent == [9, 14]


def test_a_feed_row_and_its_copies_come_without_a_lambda(spark):
    from skyledger.sources import bridge

    plan = bridge.dirty_feed(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" in plan and "lambda" not in plan


def test_folders_of_a_staged_table_leave_the_setting_as_it_was(spark, tmp_path):
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    rows = spark.range(100).select("id", (F.col("id") % 7).cast("string").alias("kind"))
    assert sorted(map(tuple, stage(rows, "kinds", "kind").collect())) == [(i, str(i % 7)) for i in range(100)]
    assert spark.conf.get(key, None) == before
