import random

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from skyledger.operators.medians import grouped_median


def check(spark, rows):
    df = spark.createDataFrame(rows, "k string, v double")
    ours = {r["k"]: r["median"] for r in grouped_median(df, ["k"], "v").collect()}
    theirs = pd.DataFrame(rows, columns=["k", "v"]).groupby("k")["v"].median().dropna().to_dict()
    assert ours == pytest.approx(theirs)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    rows=st.lists(
        st.tuples(st.sampled_from(["a", "b", "c", None]), st.one_of(st.none(), st.integers(-4000, 9000).map(lambda i: i / 4))),
        min_size=1,
        max_size=60,
    )
)
def test_equals_pandas(spark, rows):
    check(spark, rows)


def test_hot_group_over_many_buckets(spark):
    random.seed(5)
    rows = [("hot", random.lognormvariate(4, 2)) for _ in range(4001)] + [("cold", 1.0), ("cold", 2.0)]
    check(spark, rows)


def test_middle_values_in_different_buckets(spark):
    check(spark, [("a", -5.0), ("a", 1000.0), ("b", 0.0), ("b", 0.0), ("b", 7.0)])
