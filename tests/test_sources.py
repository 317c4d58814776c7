import json
import pathlib

import pytest
from pyspark.sql import functions as F

from skyledger import constants as K
from skyledger import session
from skyledger.plans import cleaning, kpis, model, pipeline, quality, reports
from skyledger.sources import bridge, outputs
from skyledger.sources.feed import read_feed

SF = "/root/testdata/sf0.001"


def test_csv_columns_are_text_and_found_by_name(spark, tmp_path):
    names = list(reversed(K.SOURCE_COLUMNS))
    line = ["NA" if n == "Aircraft" else '"a ""b"", c"' if n == "Airline" else "" if n == "Origin" else "1" for n in names]
    (tmp_path / "raw.csv").write_text(",".join(names) + "\n" + ",".join(line) + "\n")
    row = read_feed(spark, str(tmp_path / "raw.csv")).first()
    assert (row["Aircraft"], row["Airline"], row["Origin"], row["Passengers"]) == ("NA", 'a "b", c', None, "1")


def test_rows_keep_their_file_order_over_many_splits(spark, feed_of, tmp_path):
    rows = [{"Flight": f"F{i:05d}"} for i in range(3000)]
    outputs.write_csv(feed_of(*rows).orderBy("src_row").drop("src_row").coalesce(1), str(tmp_path / "raw"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        feed = read_feed(spark, str(tmp_path / "raw"))
        assert feed.rdd.getNumPartitions() > 4
        assert [r["Flight"] for r in feed.orderBy("src_row").collect()] == [r["Flight"] for r in rows]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_model_round_trip_keeps_types_and_prunes_months(spark, tmp_path):
    cleaned = cleaning.clean(bridge.dirty_feed(spark, SF))
    flights, bookings = model.split_flights(cleaned.rows), model.split_bookings(cleaned.rows)
    for _ in range(2):  # the second write replaces the first
        model.write_model(flights, bookings, str(tmp_path))
    stored_flights, stored_bookings = model.read_model(spark, str(tmp_path))
    assert [(f.name, f.dataType) for f in stored_flights.schema] == [(n, t) for n, t, _ in model.FLIGHT_LAYOUT]
    assert [(f.name, f.dataType) for f in stored_bookings.schema] == [(n, t) for n, t, _ in model.BOOKING_LAYOUT]
    assert sorted(map(str, stored_flights.collect())) == sorted(map(str, flights.collect()))
    pruned = stored_flights.where("month = '1996-01'")
    assert "PartitionFilters: [isnotnull(month" in pruned._jdf.queryExecution().executedPlan().toString()


def test_totals_and_first_rows_make_up_the_flights(spark):
    rows = cleaning.clean(bridge.dirty_feed(spark, SF)).rows
    joined = model.first_rows(rows).join(model.flight_totals(rows), "flight_id").select(*model.FLIGHT_COLUMNS)
    assert sorted(map(str, joined.collect())) == sorted(map(str, model.split_flights(rows).collect()))


def test_every_order_with_lines_takes_part(spark):
    lines, orders = bridge.table(spark, SF, "lineitem"), bridge.table(spark, SF, "orders")
    sold = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi").agg(
        F.sum("l_quantity"), F.sum(F.col("l_extendedprice").cast("decimal(12,2)")).cast("double")
    )
    over = lambda prefix: sum(F.coalesce(F.col(f"{prefix}_{i}"), F.lit(0)) for i in range(3))
    flown = bridge.departures(spark, SF).agg(F.sum(over("seats")), F.sum(over("amount")).cast("double"))
    assert tuple(flown.first()) == tuple(sold.first())
    assert bridge.flights(spark, SF).groupBy("flight_number", "flight_date").count().where("count > 1").isEmpty()


def test_sales_equal_the_join(spark):
    joined = model.enrich_bookings(bridge.bookings(spark, SF), bridge.flights(spark, SF), "is_cancelled")
    assert sorted(map(str, joined.collect())) == sorted(map(str, bridge.sales(spark, SF).collect()))


def test_whole_pipeline_writes_every_output(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    outputs.write_csv(bridge.dirty_feed(spark, SF).drop("src_row"), raw)
    result = pipeline.run(spark, raw, out, strict=False, top_delayed_routes={"min_flights": 20})
    assert set(result.results) == set(kpis.KPI_QUERIES) and len(kpis.KPI_QUERIES) == 15
    counters = json.loads(next(pathlib.Path(out, "processed", "cleaning_report").glob("*.json")).read_text())
    assert counters["raw_rows"] == 3339 and list(counters) == list(K.REPORT_COUNTERS)
    index = {(r["sheet"], r["table_name"]): r["rows"] for r in reports.read_index(spark, f"{out}/report").collect()}
    assert len(index) == 18 and index["Executive Summary", "cleaning_report"] == 14
    lines = spark.read.text(f"{out}/insights").collect()
    assert [r["value"] for r in lines[:2]] == ["# Key Insights", ""]
    assert len(lines) == 10 and all(r["value"].startswith("- ") for r in lines[2:])
    csv = spark.read.option("header", True).csv(f"{out}/processed/clean")
    assert csv.count() == counters["clean_rows"] and "src_row" not in csv.columns
    # Some fares of this feed cannot be imputed: the run that is not strict says so, the strict run must stop.
    found = {(r.stage, r.metric): r.value for r in result.checks.collect()}
    assert found["clean", "required_nulls"] > 0 and found["keys", "flights_duplicate_keys"] == 0
    assert spark.read.option("header", True).csv(f"{out}/checks").count() == len(found)
    with pytest.raises(quality.DataQualityError, match="required_nulls"):
        pipeline.checked(result.cleaned.rows)
    assert found["clean", "inconsistent_flights"] == 0
    assert "Join" not in result.sales._jdf.queryExecution().optimizedPlan().toString()
    check_sales(result)


def check_sales(result):
    joined = model.enrich_bookings(result.bookings, result.flights, "is_cancelled")
    assert result.sales.dtypes == joined.dtypes
    assert sorted(map(str, result.sales.collect())) == sorted(map(str, joined.collect()))


LINE = "NS{n},{date},Blue Air,AAA,BBB,A320,{sched},10:05,5,No,{miles},Economy,100,99.50"


def feed_file(folder, lines, name="a.csv", header=tuple(K.SOURCE_COLUMNS)):
    pathlib.Path(folder).mkdir(exist_ok=True)
    pathlib.Path(folder, name).write_text("\n".join([",".join(header), *lines]) + "\n")
    return str(folder)


def good_lines(**changes):
    return [LINE.format(**({"n": i, "date": f"2025-03-{i:02}", "sched": "10:00", "miles": 500} | changes)) for i in range(1, 20)]


def test_strict_run_that_succeeds(spark, tmp_path):
    result = pipeline.run(spark, feed_file(tmp_path / "raw", good_lines()), str(tmp_path / "out"))
    assert result.flights.count() == 19 and result.checks.where("value > 0").count() == 0


def test_flights_whose_rows_disagree_are_sold_as_their_first_row(spark, tmp_path):
    other = good_lines()[0].replace("Economy", "Business").replace("Blue Air", "Red Air")
    result = pipeline.run(spark, feed_file(tmp_path / "raw", [*good_lines(), other]), str(tmp_path / "out"), strict=False)
    assert {r.airline for r in result.sales.collect()} == {"Blue Air"} and result.sales.count() == 20
    check_sales(result)


@pytest.mark.parametrize("change, check", [({"sched": "25:10"}, "time_of_day"), ({"sched": ""}, "departure_hour"), ({"miles": "1e30"}, "required_nulls")])
def test_bad_values_stop_a_strict_run_and_are_counted_otherwise(spark, tmp_path, change, check):
    raw = feed_file(tmp_path / "raw", [*good_lines()[:-1], good_lines(n=99, **change)[0]])
    with pytest.raises(quality.DataQualityError, match=check):
        pipeline.run(spark, raw, str(tmp_path / "strict"))
    result = pipeline.run(spark, raw, str(tmp_path / "out"), strict=False)
    assert result.checks.where("value > 0").where(F.col("metric") == check).count() == 1
    assert result.cleaned.rows.count() == 19


def test_headers_must_agree(spark, tmp_path):
    swapped = list(K.SOURCE_COLUMNS)
    i, j = swapped.index("Origin"), swapped.index("Destination")
    swapped[i], swapped[j] = swapped[j], swapped[i]
    raw = feed_file(tmp_path / "one", good_lines(), header=swapped)
    assert {r["Origin"] for r in read_feed(spark, raw).collect()} == {"BBB"}
    feed_file(tmp_path / "one", good_lines(), "b.csv")
    with pytest.raises(Exception, match="header"):
        read_feed(spark, raw).collect()


def test_malformed_rows_stop_and_line_breaks_need_an_option(spark, tmp_path):
    for line in (LINE + ",more", "NS1,2025-03-01"):
        raw = feed_file(tmp_path / str(len(line)), [line.format(n=1, date="2025-03-01", sched="10:00", miles=1)])
        with pytest.raises(Exception, match="MALFORMED|[Mm]alformed"):
            read_feed(spark, raw).collect()
    raw = feed_file(tmp_path / "break", [good_lines()[0].replace("Blue Air", '"Blue\nAir"')])
    assert [r["Airline"] for r in read_feed(spark, raw, multi_line=True).collect()] == ["Blue\nAir"]


def test_parameterised_sql(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, s string")
    assert pipeline.run_sql(spark, "SELECT s FROM {t} WHERE n = :n", {"n": 2}, t=df).first()["s"] == "b"


class FakeContext:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = f"file:{folder}/id"


class FakeSession:
    def __init__(self, master, conf=None):
        self.sparkContext, self.conf = FakeContext(master), {session.CHECKPOINT_CONF: conf} if conf else {}


def test_shared_folder_is_the_one_the_session_names():
    assert session.shared_folder(FakeSession("spark://host", "hdfs://shared/x/")) == "hdfs://shared/x"
    with pytest.raises(RuntimeError, match="shared by all executors"):
        session.shared_folder(FakeSession("spark://host"))
    own = FakeSession("local[2]")
    assert session.shared_folder(own).startswith("file:/tmp/run-")
    assert session.shared_folder(own) == session.shared_folder(own)


def test_staged_table_lies_in_the_shared_folder(spark):
    staged = session.stage(spark.range(5).toDF("id"), "ids")
    assert staged.count() == 5
    folder = f"{session.shared_folder(spark).removeprefix('file:')}/skyledger/{spark.sparkContext.applicationId}/ids-"
    assert folder in staged.inputFiles()[0]


def test_cached_tables(spark):
    (kept,) = model.cached(spark.range(3).toDF("id"))
    assert kept.is_cached
    kept.unpersist()


def test_lines_and_orders_meet_once_for_several_tables(spark, monkeypatch):
    from skyledger import catalog

    made = []
    departures = bridge.departures
    monkeypatch.setattr(bridge, "departures", lambda *args: made.append(args) or departures(*args))
    monkeypatch.setattr(catalog, "_CUBES", {})
    for query in ("panel_monthly_passengers", "src_bookings_enriched"):
        made.clear()
        assert catalog.QUERIES[query](spark, SF).count() > 0 and len(made) == 1
    made.clear()
    catalog._written_report(spark, SF)
    assert len(made) == 1


def test_buckets_follow_the_rows(spark, monkeypatch):
    from skyledger import catalog

    monkeypatch.setattr(model, "BUCKET_ROWS", 500)
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    was = spark.conf.get(threshold)
    # Tables as small as these would be broadcast.
    spark.conf.set(threshold, "-1")
    try:
        for query in ("src_bookings_enriched_in_buckets", "check_orphans_in_buckets"):
            plan = catalog.QUERIES[query](spark, SF)._jdf.queryExecution().executedPlan().toString()
            assert "SelectedBucketsCount: 7 out of 7" in plan and "Exchange" not in plan
    finally:
        spark.conf.set(threshold, was)
