"""Stored models, observed checks, guards in plans, malformed lines, tables in buckets."""

import pathlib
import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import functions as F
from test_quality import KINDS, ROW, found, rows_of  # noqa: F401
from test_sources import feed_file, good_lines

from skyledger import constants as K
from skyledger.operators.guards import stop_if
from skyledger.plans import model, pipeline, quality
from skyledger.sources.feed import malformed, read_feed


# --- the stored model -----------------------------------------------------------------


def test_a_strict_run_that_fails_leaves_the_old_model(spark, tmp_path):
    out = str(tmp_path / "out")
    pipeline.run(spark, feed_file(tmp_path / "good", good_lines()), out)
    before = sorted(map(str, model.read_model(spark, f"{out}/model")[0].collect()))
    for sched, check in (("25:10", "time_of_day"), ("", "departure_hour")):
        bad = feed_file(tmp_path / f"bad{sched[:2]}", good_lines(sched=sched)[:1])
        with pytest.raises(quality.DataQualityError, match=check):
            pipeline.run(spark, bad, out)
        assert sorted(map(str, model.read_model(spark, f"{out}/model")[0].collect())) == before
    assert model.current_release(spark, f"{out}/model") == (1, "a")
    pipeline.run(spark, feed_file(tmp_path / "next", good_lines()[:3]), out)
    assert model.read_model(spark, f"{out}/model")[0].count() == 3
    assert model.current_release(spark, f"{out}/model") == (2, "b")


def test_a_candidate_is_not_seen_before_its_release(spark, tmp_path):
    folder = str(tmp_path)
    with pytest.raises(FileNotFoundError, match="no model"):
        model.read_model(spark, folder)
    assert model.current_release(spark, folder) is None
    flights = lambda n: spark.createDataFrame([], model.schema(model.FLIGHT_LAYOUT)) if not n else None
    empty = spark.createDataFrame([], model.schema(model.BOOKING_LAYOUT))
    model.write_candidate(flights(0), empty, folder)
    with pytest.raises(FileNotFoundError):
        model.read_model(spark, folder)
    assert model.release(spark, folder) == 1
    assert model.read_model(spark, folder)[1].count() == 0
    assert [model.write_model(flights(0), empty, folder) for _ in range(3)] == [2, 3, 4]


# --- checks while writing ---------------------------------------------------------------

BROKEN = (
    {"airline": None}, {"cabin_class": "Crew"}, {"cabin_class": "Crew"}, {"flight_id": "B", "passengers": -1}, {"flight_id": "B"},
    {"flight_id": "C", "is_cancelled": 1}, {"flight_id": "C", "delay_minutes": None, "cabin_class": "Business"},
    {"flight_id": None, "cabin_class": None}, {"flight_id": None, "cabin_class": None, "origin": "X"},
)


def test_observed_counters_equal_the_checks(rows_of):  # noqa: F811
    rows = rows_of(*BROKEN).repartition(3)
    stored, checks = quality.written_with_checks(rows, "observed")
    assert sorted(map(str, checks.collect())) == sorted(map(str, quality.all_checks(rows).collect()))
    assert found(checks)["duplicate_keys"] == 3 and found(checks)["inconsistent_flights"] == 2
    assert sorted(map(str, stored.collect())) == sorted(map(str, rows.collect()))


def test_observed_checks_of_no_rows(rows_of):  # noqa: F811
    for none in (rows_of({}).where("false"), rows_of({}).where("passengers > 1000")):
        stored, checks = quality.written_with_checks(none, "observed")
        assert found(checks) == {} and checks.count() == len(quality.ALL_CHECKS) and stored.isEmpty()


RETRIED = """
import sys
sys.path.insert(0, {root!r})
from pyspark import TaskContext
from pyspark.sql import functions as F
from skyledger.plans import quality
from skyledger.session import local_session

spark = local_session(2, "retried", **{"spark.master": "local[2,4]"})
columns = "flight_id string, flight_date string, airline string, origin string, destination string, cabin_class string, "
columns += "passengers long, ticket_price decimal(18,2), distance_miles int, is_cancelled int, delay_minutes double, revenue decimal(18,2)"

def fail_at_the_end(batches):
    yield from batches
    # The task has counted and written all its rows when its first attempt fails.
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("first attempt")

rows = spark.range(1000).repartition(4).selectExpr(
    "string(id) flight_id", "'2025-01-01' flight_date", "'A' airline", "'AAA' origin", "'BBB' destination", "'Crew' cabin_class",
    "id passengers", "cast(1 as decimal(18,2)) ticket_price", "1 distance_miles", "0 is_cancelled", "cast(null as double) delay_minutes",
    "cast(1 as decimal(18,2)) revenue",
)
stored, checks = quality.written_with_checks(rows.mapInArrow(fail_at_the_end, rows.schema), "retried")
values = dict((r.metric, r.value) for r in checks.collect())
assert stored.count() == 1000
assert values["unknown_cabins"] == 1000 and values["operated_without_delay"] == 1000, values
print("counted once")
"""


def test_a_task_that_is_run_again_does_not_count_twice(tmp_path):
    script = tmp_path / "retried.py"
    script.write_text(textwrap.dedent(RETRIED).replace("{root!r}", repr(str(pathlib.Path(__file__).resolve().parents[1]))))
    done = subprocess.run([sys.executable, str(script)], capture_output=True, text=True, timeout=120)
    assert "counted once" in done.stdout, done.stderr[-2000:]


@pytest.mark.parametrize(
    "change, check",
    [
        ([{"airline": None}], "required_nulls"),
        ([{"cabin_class": "Crew"}], "unknown_cabins"),
        ([{"passengers": -1}], "out_of_range"),
        ([{"delay_minutes": None}], "operated_without_delay"),
        ([{"is_cancelled": 1}], "cancelled_with_passengers"),
        ([{}, {}], "duplicate_keys"),
        ([{}, {"cabin_class": "Business", "origin": "ZZZ"}], "inconsistent_flights"),
    ],
)
def test_guarded_rows_stop_where_they_are_used(rows_of, change, check):  # noqa: F811
    rows = quality.guarded(rows_of({"flight_id": "B"}, *change))
    for use in (rows, rows.groupBy("airline").count(), rows.where("airline = 'None'")):
        if use is rows or check in ("duplicate_keys", "inconsistent_flights"):
            with pytest.raises(Exception, match=f"{quality.BROKEN}.*{check}"):
                use.collect()
    good = quality.guarded(rows_of({}, {"cabin_class": "Business"}))
    assert good.count() == 2 and good.columns == list(ROW)


def test_a_guard_holds_for_every_type(spark):
    df = spark.sql("SELECT 1 i, 2L l, 1.5D d, 'x' s, date '2025-01-01' t, true b, cast(1 as decimal(9,2)) m, timestamp_ntz '2025-01-01 00:00:00' z")
    count = df.agg(F.count(F.lit(1)).alias("n"))
    assert stop_if(df, count, F.col("n") > 1, F.lit("no")).collect() == df.collect()
    with pytest.raises(Exception, match="too few"):
        stop_if(df, count, F.col("n") < 2, F.lit("too few")).where("s = 'y'").collect()


# --- malformed lines ------------------------------------------------------------------------

SHORT, LONG = "NS7,2025-03-07,Blue Air", good_lines()[0] + ",more"
QUOTED = good_lines()[1].replace("Blue Air", '"Blue, ""Air"", Ltd"')


def test_malformed_rows_stop_whatever_is_read(spark, tmp_path):
    for i, line in enumerate((SHORT, LONG)):
        raw = read_feed(spark, feed_file(tmp_path / str(i), [*good_lines(), line]))
        for use in (raw.agg(F.count("*")), raw.select("Flight", "Origin"), raw):
            with pytest.raises(Exception, match="malformed row in"):
                use.collect()
    assert read_feed(spark, feed_file(tmp_path / "quoted", [QUOTED])).first()["Airline"] == 'Blue, "Air", Ltd'


def test_malformed_rows_are_filled_up_and_counted(spark, tmp_path):
    raw = read_feed(spark, feed_file(tmp_path / "raw", [*good_lines(), SHORT, LONG, QUOTED, QUOTED + ",x,y"]), strict=False)
    rows = {(r["Flight"], r["problem"]): r for r in raw.collect()}
    assert rows["NS7", "short"]["Airline"] == "Blue Air" and rows["NS7", "short"]["Ticket Price"] is None
    assert rows["NS1", "long"]["Ticket Price"] == "99.50" and rows["NS2", "long"]["Airline"] == 'Blue, "Air", Ltd'
    counted, seen = malformed(raw)
    assert counted.select("Flight").count() == 23 and seen.get == {"short_rows": 1, "long_rows": 2}


def test_a_run_that_is_not_strict_reports_malformed_rows(spark, tmp_path):
    raw = feed_file(tmp_path / "raw", [*good_lines(), SHORT, LONG])
    with pytest.raises(Exception, match="malformed"):
        pipeline.run(spark, raw, str(tmp_path / "strict"))
    result = pipeline.run(spark, raw, str(tmp_path / "out"), strict=False)
    lines = {r.metric: r.value for r in result.checks.where("stage = 'feed'").collect()}
    assert lines == {"short_rows": 1, "long_rows": 1}


def test_positions_follow_files_and_rows(spark, tmp_path):
    folder = tmp_path / "a b%20c"
    for name in ("c.csv", "a.csv", "b é.csv"):
        feed_file(folder, [line.replace("NS", name[0].upper()) for line in good_lines()], name)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
        rows = read_feed(spark, str(folder)).select("Flight", "src_row").orderBy("src_row").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r.Flight for r in rows] == [f"{f}{i}" for f in "ABC" for i in range(1, 20)]
    assert len({r.src_row for r in rows}) == 57 and [f.name for f in read_feed(spark, str(folder)).schema][:2] == list(K.SOURCE_COLUMNS)[:2]


# --- tables in buckets ---------------------------------------------------------------------


def test_buckets_hold_all_rows(spark):
    flights = spark.createDataFrame([(f"F{i}", i) for i in range(50)], "flight_id string, x int")
    bookings = spark.createDataFrame([(f"F{i % 60}", i) for i in range(300)] + [(None, -1)], "flight_id string, y int")
    for buckets in (None, 1, 7):
        left, right = model.co_located(flights, bookings, buckets)
        assert sorted(left.collect()) == sorted(flights.collect()) and right.count() == 301
        assert quality.orphan_bookings(left, right).count() == 51
        assert right.join(left, "flight_id").count() == 250
