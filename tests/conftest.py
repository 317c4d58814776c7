import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))
sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from skyledger import constants as K  # noqa: E402
from skyledger.session import local_session  # noqa: E402

DEFAULTS = {
    "Flight": "NS1", "Date": "2025-03-14", "Airline": "Blue Air", "Origin": "AAA", "Destination": "BBB",
    "Aircraft": "A320", "Scheduled Departure": "10:00", "Actual Departure": "10:05", "Delay (min)": "5",
    "Cancelled": "No", "Distance (mi)": "500", "Cabin Class": "Economy", "Passengers": "100", "Ticket Price": "99.50",
}
assert list(DEFAULTS) == list(K.SOURCE_COLUMNS)


@pytest.fixture(scope="session")
def spark():
    return local_session(4, "tests")


@pytest.fixture(scope="session")
def feed_of(spark):
    """Raw feed from partial rows; the row number is the file order unless given."""

    def build(*rows: dict):
        full = [{**DEFAULTS, **r} for r in rows]
        data = [tuple(r[c] for c in K.SOURCE_COLUMNS) + (r.get("src_row", i),) for i, r in enumerate(full)]
        fields = ", ".join(f"`{c}` string" for c in K.SOURCE_COLUMNS)
        return spark.createDataFrame(data, f"{fields}, src_row long")

    return build


@pytest.fixture(scope="session")
def column(spark):
    """Apply a column function to a list of values."""

    def apply(function, values, kind="string"):
        from pyspark.sql import functions as F

        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
        return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]

    return apply
