"""Split clean rows into the two model tables and store them."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.session import fresh_path

CENTS = T.DecimalType(18, 2)

# Fixed table layouts: (name, type, nullable).
FLIGHT_LAYOUT = (
    ("flight_id", T.StringType(), False),
    ("flight_number", T.StringType(), False),
    ("flight_date", T.DateType(), False),
    ("month", T.StringType(), False),
    ("day_of_week", T.StringType(), False),
    ("airline", T.StringType(), False),
    ("origin", T.StringType(), False),
    ("destination", T.StringType(), False),
    ("route", T.StringType(), False),
    ("aircraft", T.StringType(), True),
    ("scheduled_departure", T.StringType(), False),
    ("actual_departure", T.StringType(), True),
    ("departure_hour", T.IntegerType(), False),
    ("time_of_day", T.StringType(), False),
    ("departure_variance", T.DoubleType(), True),
    ("delay_minutes", T.DoubleType(), True),
    ("delay_category", T.StringType(), False),
    ("is_cancelled", T.IntegerType(), False),
    ("is_on_time", T.IntegerType(), True),
    ("distance_miles", T.IntegerType(), False),
    ("passengers", T.LongType(), False),
    ("revenue", CENTS, False),
)
BOOKING_LAYOUT = (
    ("flight_id", T.StringType(), False),
    ("cabin_class", T.StringType(), False),
    ("passengers", T.LongType(), False),
    ("ticket_price", CENTS, False),
    ("revenue", CENTS, False),
)
FLIGHT_COLUMNS = [name for name, _, _ in FLIGHT_LAYOUT]
BOOKING_COLUMNS = [name for name, _, _ in BOOKING_LAYOUT]
FLIGHT_ATTRIBUTES = [c for c in FLIGHT_COLUMNS if c not in ("flight_id", "passengers", "revenue")]
NOT_NULL_FLIGHT = [name for name, _, nullable in FLIGHT_LAYOUT if not nullable]


def schema(layout) -> T.StructType:
    return T.StructType([T.StructField(*field) for field in layout])


def _first_in_order():
    """Sort position of a row within its flight: scheduled time, then cabin, then file order."""
    nulls_last = lambda c: [F.col(c).isNull(), F.col(c)]
    return F.struct(*nulls_last("scheduled_departure"), *nulls_last("cabin_rank"), "src_row")


def first_rows(clean_rows: DataFrame) -> DataFrame:
    """The attributes of each flight, from its first row."""
    return (
        clean_rows.where(F.col("flight_id").isNotNull())
        .groupBy("flight_id")
        .agg(F.min_by(F.struct(*FLIGHT_ATTRIBUTES), _first_in_order()).alias("first"))
        .select("flight_id", "first.*")
    )


def flight_totals(clean_rows: DataFrame) -> DataFrame:
    return clean_rows.where(F.col("flight_id").isNotNull()).groupBy("flight_id").agg(*_totals())


def _totals():
    return [
        F.coalesce(F.sum("passengers"), F.lit(0)).cast("bigint").alias("passengers"),
        F.coalesce(F.sum("revenue"), F.lit(0)).cast(CENTS).alias("revenue"),
    ]


def split_flights(clean_rows: DataFrame) -> DataFrame:
    """One row per flight: first-row attributes and totals out of one combined aggregate."""
    return (
        clean_rows.where(F.col("flight_id").isNotNull())
        .groupBy("flight_id")
        .agg(F.min_by(F.struct(*FLIGHT_ATTRIBUTES), _first_in_order()).alias("first"), *_totals())
        .select("flight_id", "first.*", "passengers", "revenue")
        .select(*FLIGHT_COLUMNS)
    )


def split_bookings(clean_rows: DataFrame) -> DataFrame:
    return clean_rows.select(*BOOKING_COLUMNS)


SLICE_ATTRIBUTES = ("airline", "route", "origin", "destination", "month")


def enrich_bookings(bookings: DataFrame, flights: DataFrame, *more: str) -> DataFrame:
    """Bookings with the attributes of their flight that selections and reports use."""
    return bookings.join(flights.select("flight_id", *SLICE_ATTRIBUTES, *more), "flight_id")


def sales_of_rows(clean_rows: DataFrame, *more: str) -> DataFrame:
    """What ``enrich_bookings`` gives, without its join: right only if the rows of a flight agree on its attributes."""
    types = {name: kind for name, kind, _ in (*FLIGHT_LAYOUT, *BOOKING_LAYOUT)}
    names = [*BOOKING_COLUMNS, *SLICE_ATTRIBUTES, *more]
    return clean_rows.where(F.col("flight_id").isNotNull()).select(*[F.col(c).cast(types[c]).alias(c) for c in names])


SLOTS = ("a", "b")
RELEASES = "release long, slot string, flights long, bookings long"


def _releases(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(RELEASES).option("pathGlobFilter", "*.parquet").parquet(f"{folder}/releases")


def current_release(spark: SparkSession, folder: str) -> tuple[int, str] | None:
    """(number, slot) of the model that readers see; None before the first one."""
    try:
        last = _releases(spark, folder).agg(F.max(F.struct("release", "slot")).alias("last")).first().last
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return (last.release, last.slot) if last else None


def _slot(spark: SparkSession, folder: str, slot: str) -> tuple[DataFrame, DataFrame]:
    """Both tables with declared types; ``month`` stays text although it is a folder name."""
    path = f"{folder}/{slot}"
    flights = spark.read.schema(schema(FLIGHT_LAYOUT)).parquet(f"{path}/flights").select(*FLIGHT_COLUMNS)
    return flights, spark.read.schema(schema(BOOKING_LAYOUT)).parquet(f"{path}/bookings")


def write_candidate(flights: DataFrame, bookings: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """Write both tables beside the current model, which readers go on to see; they are read from where they lie.

    Two slots take turns, so nothing has to be deleted. Flights are laid out by month for partition pruning. The
    rebalance hint evens out file sizes: a month that holds most rows is split over many tasks, small months share one.
    """
    spark = flights.sparkSession
    path = f"{folder}/{_free_slot(spark, folder)}"
    flights.hint("rebalance", "month").write.mode("overwrite").partitionBy("month").parquet(f"{path}/flights")
    bookings.hint("rebalance").write.mode("overwrite").parquet(f"{path}/bookings")
    return _slot(spark, folder, _free_slot(spark, folder))


def _free_slot(spark: SparkSession, folder: str) -> str:
    now = current_release(spark, folder)
    return SLOTS[0] if now is None or now[1] == SLOTS[1] else SLOTS[1]


def release(spark: SparkSession, folder: str) -> int:
    """Make the written candidate the model: one appended row, written whole or not at all."""
    now, slot = current_release(spark, folder), _free_slot(spark, folder)
    number = now[0] + 1 if now else 1
    flights, bookings = _slot(spark, folder, slot)
    row = spark.createDataFrame([(number, slot, flights.count(), bookings.count())], RELEASES)
    row.coalesce(1).write.mode("append").parquet(f"{folder}/releases")
    return number


def write_model(flights: DataFrame, bookings: DataFrame, folder: str) -> int:
    """Replace the stored model at once: the number of its release."""
    write_candidate(flights, bookings, folder)
    return release(flights.sparkSession, folder)


def read_model(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Both tables of the current release.

    Frames read before a release stay whole until the second release after it overwrites their slot.
    """
    now = current_release(spark, folder)
    if now is None:
        raise FileNotFoundError(f"no model has been released in {folder}")
    return _slot(spark, folder, now[1])


# Rows of a bucket at most, where the number of buckets is not given.
BUCKET_ROWS = 1_000_000


def co_located(flights: DataFrame, bookings: DataFrame, buckets: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Both tables stored in the same buckets of ``flight_id``, sorted in each: they join without a shuffle.

    A flight has one row and a booking for each cabin, so buckets are even. Each table is shuffled once, when it is
    written; bookings without a flight id lie together in one bucket and join nothing.
    """
    spark = flights.sparkSession
    buckets = buckets or max(1, bookings.count() // BUCKET_ROWS + 1)
    stored = []
    for df, kind in ((flights, "flights"), (bookings, "bookings")):
        path = fresh_path(spark, kind)
        name = f"{kind}_{path.rsplit('-', 1)[1]}"
        writer = df.repartition(buckets, "flight_id").write.format("parquet").option("path", path)
        writer.bucketBy(buckets, "flight_id").sortBy("flight_id").saveAsTable(name)
        stored.append(spark.table(name).select(*df.columns))
    return tuple(stored)


def cached(*tables: DataFrame) -> tuple[DataFrame, ...]:
    """Keep tables for repeated slicing; lost blocks are rebuilt from the plan."""
    return tuple(t.persist() for t in tables)
