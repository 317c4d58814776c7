"""A cube of additive measures that panels and slices read instead of rows.

Flights collapse to one cell for each combination of month, airline, origin, destination, departure hour and delay
category, sales to one for each month, airline, origin, destination and cabin. Cells hold sums and counts only, so
cells of new rows are added to old ones, and any coarser selection or grouping is a sum of cells. Their number follows
the network's timetable, not its passengers or years of rows in a month.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.plans.kpis import disrupted

PLACES = ("airline", "origin", "destination", "route", "month")
FLIGHT_CELL = ("departure_hour", "delay_category", *PLACES)
SALES_CELL = ("cabin_class", *PLACES)
MONEY = T.DecimalType(28, 2)


def _parts() -> dict[str, tuple[Column, str | T.DataType]]:
    """Measure of a flight cell -> what one flight adds to it, and its type."""
    known = lambda c: F.col(c).isNotNull().cast("long")
    value = lambda c, zero: F.coalesce(F.col(c), F.lit(zero))
    return {
        "flights": (F.lit(1), "long"),
        "cancelled": (value("is_cancelled", 0), "long"),
        "cancelled_known": (known("is_cancelled"), "long"),
        "on_time": (value("is_on_time", 0), "long"),
        "operated": (known("is_on_time"), "long"),
        "delay": (value("delay_minutes", 0.0), "double"),
        "delay_known": (known("delay_minutes"), "long"),
        "disrupted": (disrupted(), "long"),
        "passengers": (F.col("passengers"), "long"),
        "revenue": (F.col("revenue"), MONEY),
    }


FLIGHT_MEASURES = (
    "flights", "cancelled", "cancelled_known", "on_time", "operated", "delay", "delay_known", "disrupted",
    "passengers", "revenue",
)
SALES_MEASURES = ("passengers", "revenue")
KINDS = {"departure_hour": T.IntegerType(), "delay": T.DoubleType(), "revenue": MONEY}


def _schema(dimensions: Iterable[str], measures: Iterable[str]) -> T.StructType:
    fields = [T.StructField(d, KINDS.get(d, T.StringType())) for d in dimensions]
    return T.StructType(fields + [T.StructField(m, KINDS.get(m, T.LongType())) for m in measures])


FLIGHT_SCHEMA = _schema(FLIGHT_CELL, FLIGHT_MEASURES)
SALES_SCHEMA = _schema(SALES_CELL, SALES_MEASURES)


def flight_cells(flights: DataFrame) -> DataFrame:
    """Flights as cells of one each; cells as they are. Nothing is added up, so it costs no shuffle."""
    if "operated" in flights.columns:
        return flights
    parts = [value.cast(kind).alias(name) for name, (value, kind) in _parts().items()]
    return flights.select(*[F.col(c) for c in flights.columns if c not in FLIGHT_MEASURES], *parts)


def _added_up(cells: DataFrame, schema: T.StructType, measures: tuple[str, ...]) -> DataFrame:
    dimensions = [f.name for f in schema.fields if f.name not in measures]
    sums = cells.groupBy(*dimensions).agg(*[F.sum(m).cast(schema[m].dataType).alias(m) for m in measures])
    return sums.select(*schema.names)


@dataclass(frozen=True)
class Cube:
    flights: DataFrame
    sales: DataFrame

    @classmethod
    def of(cls, flights: DataFrame, sales: DataFrame) -> Cube:
        """The cells of model flights and of sales with the places of their flights."""
        return cls(
            _added_up(flight_cells(flights), FLIGHT_SCHEMA, FLIGHT_MEASURES),
            _added_up(sales, SALES_SCHEMA, SALES_MEASURES),
        )

    def merged(self, *others: Cube) -> Cube:
        """One cube of the rows of all; each row must be in one of them only."""
        both = [self, *others]
        return Cube(
            _added_up(reduce(DataFrame.unionByName, [c.flights for c in both]), FLIGHT_SCHEMA, FLIGHT_MEASURES),
            _added_up(reduce(DataFrame.unionByName, [c.sales for c in both]), SALES_SCHEMA, SALES_MEASURES),
        )

    def write(self, folder: str, only_its_months: bool = False) -> None:
        """Replace the stored cube, or only the months that this one has cells of."""
        mode = "dynamic" if only_its_months else "static"
        for cells, name in ((self.flights, "flights"), (self.sales, "sales")):
            cells.hint("rebalance", "month").write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(
                "month"
            ).parquet(f"{folder}/{name}")

    @classmethod
    def read(cls, spark: SparkSession, folder: str) -> Cube:
        """The stored cells; a month is a folder, which a selection of months is read by."""
        one = lambda name, schema: spark.read.schema(schema).parquet(f"{folder}/{name}").select(*schema.names)
        return cls(one("flights", FLIGHT_SCHEMA), one("sales", SALES_SCHEMA))

    def cached(self) -> Cube:
        """Kept in memory for repeated slicing; lost blocks are read again."""
        return Cube(self.flights.persist(), self.sales.persist())

    def released(self) -> Cube:
        return Cube(self.flights.unpersist(), self.sales.unpersist())
