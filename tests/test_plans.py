"""What the optimised plans of the registered queries must and must not contain."""

import re

import pytest

from skyledger.catalog import QUERIES
from skyledger.plans import cleaning
from skyledger.session import stage
from skyledger.sources import bridge, outputs
from skyledger.sources.feed import read_feed, rename

SF = "/root/testdata/sf0.001"
# Queries that write and read back are covered by their oracles.
LAZY = [n for n in QUERIES if not n.startswith(("sink_", "mart_", "insights_all", "src_csv", "check_", "clean_", "derive_", "impute_", "model_"))]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert unwanted not in text


@pytest.mark.parametrize("name", ["executive_kpis", "airport_performance", "airline_revenue", "cube_flights", "cube_sales", "route_airline_breakdown"])
def test_source_is_read_once_and_pruned(spark, name):
    text = plan(QUERIES[name](spark, SF))
    scans = [s for s in re.findall(r"FileScan parquet \[([^\]]*)\]", text) if "l_orderkey" in s]
    assert len(scans) == 1
    read = {c.split("#")[0] for c in scans[0].split(",")}
    assert read <= {"l_orderkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag"}


@pytest.mark.parametrize("name", [n for n in QUERIES if n.startswith(("panel_", "metric_")) or n in ("slice_vs_network", "month_labels", "filter_values")])
def test_panels_read_the_cube_and_no_rows(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "l_orderkey" not in text and "o_orderkey" not in text
    assert "/cube-" in text
    # No window over all routes, months or cabins beyond what is shown of them.
    if "route" in name or "demand" in name:
        assert "Window" not in re.sub(r"Subquery[\s\S]*", "", text)


@pytest.mark.parametrize("name", ["route_performance", "high_demand_poor_performance"])
def test_routes_are_ranked_without_one_task_for_all(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "/numbered-" in text and "l_orderkey" not in text
    # What comes together in one task are the sizes of the sort's parts.
    for window in re.findall(r"Window \[[^\]]*\], \[[^\]]*\]", text):
        assert "_size" in window


def staged(spark):
    return cleaning.Cleaned(stage(cleaning.prepare(bridge.dirty_feed(spark, SF)), "prepared", "state"))


def test_bulk_of_the_rows_is_imputed_without_a_shuffle(spark):
    text = plan(staged(spark).rows)
    assert "Exchange hashpartitioning" not in text
    whole = [s for s in re.findall(r"PartitionFilters: \[([^\]]*)\]", text) if "= whole" in s]
    gap = [s for s in re.findall(r"PartitionFilters: \[([^\]]*)\]", text) if "= gap" in s]
    assert len(whole) == 1 and len(gap) == 1


def test_dedup_combines_on_the_map_side(spark):
    text = plan(cleaning.prepare(bridge.dirty_feed(spark, SF)))
    assert "partial_min(src_row" in text and "partial_sum(copies" in text
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text


def test_csv_path_has_no_sort_aggregate(spark, tmp_path):
    outputs.write_csv(bridge.dirty_feed(spark, SF).drop("src_row"), str(tmp_path / "raw"))
    raw = read_feed(spark, str(tmp_path / "raw"))
    assert dict(raw.dtypes)["src_row"] == "bigint"
    for df in (cleaning.prepare(raw), cleaning.drop_exact_copies(raw.transform(rename).transform(cleaning.strip_text))):
        assert "SortAggregate" not in plan(df) and "ObjectHashAggregate" not in plan(df)


@pytest.mark.parametrize("name", ["check_all", "check_all_while_writing", "check_consistent_attrs"])
def test_checks_hash(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text


def test_tables_in_buckets_join_without_a_shuffle(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for name in ("check_orphans_in_buckets", "src_bookings_enriched_in_buckets"):
            text = plan(QUERIES[name](spark, SF))
            assert "SortMergeJoin" in text and "Exchange" not in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_columns_reach_the_staged_scan(spark):
    text = plan(staged(spark).settled.select("origin", "distance_miles"))
    assert "aircraft" not in text and "scheduled_departure" not in text


def test_counts_of_a_median_are_shuffled_once(spark):
    medians = cleaning.typical_values(staged(spark).settled)
    medians.collect()
    # In the executed plan the second use of the counts is a reused stage.
    assert "ReusedExchange" in plan(medians)


def test_results_do_not_depend_on_broadcasts(spark):
    """Beyond the size threshold every lookup is shuffled; the rows stay the same."""
    cleaned = staged(spark)
    expected = sorted(map(str, cleaned.rows.collect()))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        again = cleaning.Cleaned(cleaned.prepared).rows
        assert "SortMergeJoin" in plan(again)
        assert sorted(map(str, again.collect())) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
