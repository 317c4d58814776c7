"""From the all-text feed to typed, deduplicated, imputed rows.

Shape of the full job (``clean``):

1. ``type_rows``, ``prepare``  strip, standardise, parse and stage the rows, find
   the positions to keep (copies and key copies by two narrow hash aggregates,
   combined on the map side), fetch those rows by position, repair the times a row
   can repair by itself. The result is staged: everything after reads it more than once.
2. ``settle_departures``, ``impute``  only the few rows with a gap meet a join
   (donor of the same flight, medians); whole rows pass through without a shuffle.
   The staged table is laid out by that state, so each row is read once.
3. ``derive``  row-local columns.

Counters travel as columns of the prepared rows, so the report is a plain
aggregate of them and counts stay right when tasks are run again.
"""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger import constants as K
from skyledger.functions import text as X
from skyledger.functions.numeric import floored_at_zero, half_even, to_number
from skyledger.operators.joins import spread_left_join
from skyledger.operators.medians import grouped_median
from skyledger.operators.rows import metric_rows, side_by_side
from skyledger.session import stage
from skyledger.sources.feed import rename

FLIGHT_KEY = ["flight_number", "flight_date"]
ROW_KEY = [*FLIGHT_KEY, "cabin_class"]
CENTS = "decimal(18,2)"


def _replace(df: DataFrame, **columns: Column) -> DataFrame:
    return df.withColumns(columns)


def strip_text(df: DataFrame) -> DataFrame:
    return _replace(df, **{c: X.stripped(F.col(c)) for c in K.FEED_COLUMNS})


def drop_exact_copies(df: DataFrame) -> DataFrame:
    """One row per distinct feed row, with the first position and the number of copies."""
    return df.groupBy(*K.FEED_COLUMNS).agg(F.min("src_row").alias("src_row"), F.count(F.lit(1)).alias("copies"))


def standardise_case(df: DataFrame) -> DataFrame:
    upper = {c: F.upper(F.col(c)) for c in ("origin", "destination", "flight_number")}
    title = {c: X.title_case(F.col(c)) for c in ("airline", "cabin_class")}
    return _replace(df, **upper, **title)


def parse_types(df: DataFrame, date_patterns: tuple[str, ...] = K.DATE_PATTERNS) -> DataFrame:
    price = F.col("ticket_price")
    numbers = {c: to_number(F.col(c)) for c in ("departure_variance", "distance_miles", "passengers")}
    return _replace(
        df,
        flight_date=X.parsed_date(F.col("flight_date"), date_patterns),
        bad_date=F.col("flight_date").isNotNull() & X.parsed_date(F.col("flight_date"), date_patterns).isNull(),
        is_cancelled=X.cancelled_flag(F.col("is_cancelled")),
        had_symbol=F.coalesce(F.contains(price, F.lit("$")), F.lit(False)),
        ticket_price=to_number(F.replace(price, F.lit("$"), F.lit(""))),
        **numbers,
    )


def _fingerprints(columns: tuple[str, ...]) -> list[Column]:
    """Two independent 64-bit hashes of all values; rows that are equal in both count as copies."""
    marked = [part for c in columns for part in (F.col(c).isNull(), F.col(c))]
    return [F.xxhash64(F.lit(seed), *marked).alias(f"print_{seed}") for seed in ("a", "b")]


def winners(rows: DataFrame) -> DataFrame:
    """(src_row, raw_rows, distinct_rows, symbol_rows) of the row to keep of each flight number, date and cabin.

    ``rows`` are typed and carry the fingerprints of their text.
    Copies collapse to their first position, then distinct rows of a key to theirs. Both aggregates hold the key, two
    fingerprints, a position and counters, never a row, and are combined on the map side: a key with any number of
    copies leaves each map task once. A row whose date could not be read has no key, so it is nobody's copy: it stays,
    and the checks report it.
    """
    distinct = rows.groupBy(*ROW_KEY, "bad_date", "had_symbol", "print_a", "print_b").agg(
        F.min("src_row").alias("src_row"), F.count(F.lit(1)).alias("copies")
    )
    return (
        distinct.withColumn("keyless", F.when(F.col("bad_date"), F.col("src_row")))
        .groupBy(*ROW_KEY, "keyless")
        .agg(
            F.min("src_row").alias("src_row"),
            F.sum("copies").alias("raw_rows"),
            F.count(F.lit(1)).alias("distinct_rows"),
            F.count_if("had_symbol").alias("symbol_rows"),
        )
        .select("src_row", "raw_rows", "distinct_rows", "symbol_rows")
    )


def keep_first(text_rows: DataFrame) -> DataFrame:
    """Typed rows, the first in file order of each key, with the sizes of what they replace.

    The rows are typed and written once with their positions and the fingerprints of their text; the winners come
    from the columns of the key alone.
    """
    return first_of(type_rows(text_rows))


def type_rows(text_rows: DataFrame) -> DataFrame:
    """All rows, standardised, typed and written, with the fingerprints of their stripped text."""
    marked = text_rows.select(*K.FEED_COLUMNS, "src_row", *_fingerprints(K.FEED_COLUMNS))
    return stage(marked.transform(standardise_case).transform(parse_types), "typed")


# Repeated keys, as hashes of 8 bytes, that are sent to every task: some 200 MB of an executor as a hash table.
FEW_REPEATED = 3_000_000


def repeated_keys(typed: DataFrame) -> DataFrame:
    """(key_hash): hashes of the keys that more than one row has; a shuffle of one number and its count for each key."""
    return (
        typed.groupBy(_key_hash().alias("key_hash"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .where("rows > 1")
        .select("key_hash")
    )


def _key_hash() -> Column:
    return F.xxhash64(*[part for c in ROW_KEY for part in (F.col(c).isNull(), F.col(c))])


def first_of(typed: DataFrame, few: int = FEW_REPEATED) -> DataFrame:
    """The winners of typed rows.

    A row whose key no other row has, as nearly all have, is its own winner and passes without a shuffle. Keys whose
    hashes agree by chance only take the longer way. Where more than ``few`` keys are repeated, all rows take it.
    """
    repeated = stage(repeated_keys(typed), "repeated")
    if repeated.count() > few:
        return _won(typed)
    known = F.broadcast(repeated)
    own = typed.withColumn("key_hash", _key_hash())
    alone = own.join(known, "key_hash", "left_anti").where(F.col("src_row").isNotNull())
    alone = alone.select(
        *_kept(typed).columns,
        F.lit(1).cast("bigint").alias("raw_rows"),
        F.lit(1).cast("bigint").alias("distinct_rows"),
        F.col("had_symbol").cast("bigint").alias("symbol_rows"),
    )
    return alone.unionByName(_won(own.join(known, "key_hash", "left_semi").drop("key_hash")))


def _kept(typed: DataFrame) -> DataFrame:
    return typed.drop("print_a", "print_b", "had_symbol", "bad_date")


def _won(typed: DataFrame) -> DataFrame:
    """Whole rows meet only the winners' positions, which are unique, so no key can be hot.

    The winners, a few numbers a row, are the hashed side: whole rows are not sorted.
    """
    return _kept(typed).join(winners(typed).hint("shuffle_hash"), "src_row")


def flag_invalid(df: DataFrame) -> DataFrame:
    """Null impossible prices; mark rows that cannot be used.

    A missing origin or destination is not a reason to drop (the checks catch it).
    """
    bad_price = F.coalesce(F.col("ticket_price") <= 0, F.lit(False))
    usable = F.coalesce(F.col("origin") != F.col("destination"), F.lit(True)) & F.col("is_cancelled").isNotNull()
    return _replace(
        df,
        price_invalid=bad_price,
        ticket_price=F.when(~bad_price, F.col("ticket_price")),
        is_usable=usable,
    )


def repair_times(df: DataFrame) -> DataFrame:
    """Delay and actual time each rebuild the other, on operated rows."""
    # Parsed times become columns first, so each is computed once per row.
    timed = _replace(
        df,
        scheduled=X.clock_minutes(F.col("scheduled_departure")),
        gap=X.clock_minutes(F.col("actual_departure")) - X.clock_minutes(F.col("scheduled_departure")),
        operated=F.coalesce(F.col("is_cancelled") == 0, F.lit(False)),
    )
    gap, operated = F.col("gap"), F.col("operated")
    derived = F.when(gap > K.EARLIEST_DEPARTURE, gap).otherwise(gap + K.MINUTES_PER_DAY)
    with_delay = _replace(
        timed,
        delay_derived=operated & F.col("departure_variance").isNull() & gap.isNotNull(),
        departure_variance=F.coalesce(F.col("departure_variance"), F.when(operated, derived)),
    )
    rebuild = operated & F.col("actual_departure").isNull() & F.col("departure_variance").isNotNull()
    rebuilt = X.clock_text(F.col("scheduled") + F.col("departure_variance"))
    return _replace(
        with_delay,
        actual_rebuilt=rebuild,
        actual_departure=F.when(rebuild, rebuilt).otherwise(F.col("actual_departure")),
    ).drop("scheduled", "gap", "operated")


MEASURES = ("distance_miles", "passengers", "ticket_price")
WHOLE, GAP, UNUSABLE = "whole", "gap", "unusable"


def _needs_donor() -> Column:
    return (F.col("is_cancelled") == 0) & F.col("departure_variance").isNull()


def mark_state(df: DataFrame) -> DataFrame:
    """Tell apart rows that are whole, rows with a gap to fill, and rows to drop."""
    has_gap = reduce(lambda a, b: a | b, [F.col(m).isNull() for m in MEASURES], _needs_donor())
    return df.withColumn("state", F.when(~F.col("is_usable"), UNUSABLE).when(has_gap, GAP).otherwise(WHOLE))


def prepare(raw: DataFrame) -> DataFrame:
    """All steps up to the point where rows need other rows to be repaired."""
    return _prepare_typed(_type_feed(raw))


def _type_feed(raw: DataFrame) -> DataFrame:
    return raw.transform(rename).transform(strip_text).transform(type_rows)


def _prepare_typed(typed: DataFrame) -> DataFrame:
    steps = (
        first_of,
        flag_invalid,
        repair_times,
        mark_state,
    )
    return reduce(lambda df, step: df.transform(step), steps, typed)


def _usable(prepared: DataFrame) -> DataFrame:
    return prepared.where(F.col("state").isin(WHOLE, GAP))


def find_donors(prepared: DataFrame) -> DataFrame:
    """For each flight with a row in need: the first delay, in file order, of its rows.

    Rows are narrowed to the flights in need and reduced by a combined aggregate;
    the result has at most one row per flight in need.
    """
    wanted = prepared.where((F.col("state") == GAP) & _needs_donor()).select(*FLIGHT_KEY).distinct()
    return (
        _usable(prepared)
        .where(F.col("departure_variance").isNotNull())
        .select(*FLIGHT_KEY, "src_row", "departure_variance")
        .join(wanted, FLIGHT_KEY, "left_semi")
        .groupBy(*FLIGHT_KEY)
        .agg(F.min_by("departure_variance", "src_row").alias("donated"))
    )


def _borrow(rows: DataFrame, donors: DataFrame) -> DataFrame:
    borrowed = F.when(_needs_donor(), F.col("donated")).otherwise(F.col("departure_variance"))
    return rows.join(donors, FLIGHT_KEY, "left").withColumn("departure_variance", borrowed).select(*rows.columns)


def borrow_delay(prepared: DataFrame, donors: DataFrame) -> DataFrame:
    """Rows without a delay take the donated one; whole rows skip the join.

    ``departure_variance`` stays null where no row of the flight has one.
    """
    return prepared.where(F.col("state") == WHOLE).unionByName(
        _borrow(prepared.where(F.col("state") == GAP), donors)
    )


def _settle(rows: DataFrame) -> DataFrame:
    """Drop operated rows that still have no delay, blank the times of cancelled rows."""
    operated = F.col("is_cancelled") == 0
    return _replace(
        rows.where(~_needs_donor()),
        departure_variance=F.when(operated, F.col("departure_variance")),
        actual_departure=F.when(operated, F.col("actual_departure")),
    )


def settle_departures(prepared: DataFrame, donors: DataFrame) -> DataFrame:
    return _settle(borrow_delay(prepared, donors))


# Measure with gaps -> the columns whose group's median fills it. The month of
# the year pools all years.
MEDIAN_KEYS = {
    "distance_miles": ("origin", "destination"),
    "passengers": ("flight_number", "cabin_class"),
    "ticket_price": ("origin", "destination", "cabin_class", "month_of_year"),
}
KEY_SLOTS = ["key_1", "key_2", "key_3", "key_4"]


def _with_month(df: DataFrame) -> DataFrame:
    return df.withColumn("month_of_year", F.lpad(F.month("flight_date").cast("string"), 2, "0"))


def _slots(measure: str) -> list[Column]:
    """The keys of a measure in a fixed number of text columns."""
    keys = [F.col(c) for c in MEDIAN_KEYS[measure]]
    keys += [F.lit("")] * (len(KEY_SLOTS) - len(keys))
    return [key.alias(slot) for key, slot in zip(keys, KEY_SLOTS)]


# Groups with a gap that are sent to every task.
FEW_GROUPS = 1_000_000


def groups_with_gaps(settled: DataFrame, measures: tuple[str, ...] = MEASURES) -> DataFrame:
    """(measure, key slots) of the groups in which a row lacks the measure; only rows with a gap are looked at."""
    cells = [F.struct(F.lit(m).alias("measure"), *_slots(m), F.col(m).isNull().alias("gap")) for m in measures]
    long = _with_month(settled.where(F.col("state") == GAP)).select(F.inline(F.array(*cells)))
    return long.where("gap").drop("gap").distinct()


def typical_values(settled: DataFrame, measures: tuple[str, ...] = MEASURES, wanted: DataFrame | None = None) -> DataFrame:
    """Medians of all measures, (measure, key slots, typical), in one pass; of the ``wanted`` groups only, if they are few."""
    cells = [F.struct(F.lit(m).alias("measure"), *_slots(m), F.col(m).alias("value")) for m in measures]
    long = _with_month(settled).select(F.inline(F.array(*cells)))
    if wanted is not None and wanted.count() <= FEW_GROUPS:
        long = long.join(F.broadcast(wanted), ["measure", *KEY_SLOTS], "left_semi")
    return grouped_median(long, ["measure", *KEY_SLOTS], "value", "typical")


# Medians that Spark may broadcast by their size; beyond these a hot route would meet them in one task.
FEW_MEDIANS = 200_000


def fill(gaps: DataFrame, medians: DataFrame, measure: str, spread: bool = False) -> DataFrame:
    """Put the group's median into the gaps of one measure; passengers are whole.

    ``spread`` deals the gaps of frequent groups over many tasks.
    """
    keys = list(MEDIAN_KEYS[measure])
    typical = half_even(F.col("typical")) if measure == "passengers" else F.col("typical")
    own = medians.where(F.col("measure") == measure).select(
        *[F.col(slot).alias(key) for slot, key in zip(KEY_SLOTS, keys)], "typical"
    )
    met = spread_left_join(gaps, own, keys, "src_row") if spread else gaps.join(own, keys, "left")
    return met.withColumn(measure, F.coalesce(F.col(measure), typical)).select(*gaps.columns)


def finish_amounts(df: DataFrame) -> DataFrame:
    """Cancelled rows carry no passengers; every fare is rounded to cents."""
    return _replace(
        df,
        passengers=F.when(F.col("is_cancelled") == 1, F.lit(0.0)).otherwise(F.col("passengers")),
        ticket_price=half_even(F.col("ticket_price"), 2),
    )


def impute(settled: DataFrame, medians: DataFrame, measures: tuple[str, ...] = MEASURES, few: int = FEW_MEDIANS) -> DataFrame:
    """Fill the measures; rows stored as whole bypass every join, and many medians meet the gaps spread."""
    spread = medians.count() > few
    marked = _with_month(_replace(settled, **{f"{m}_missing": F.col(m).isNull() for m in measures}))
    gaps = marked.where(F.col("state") == GAP)
    filled = reduce(lambda df, m: fill(df, medians, m, spread), measures, gaps)
    return finish_amounts(marked.where(F.col("state") == WHOLE).unionByName(filled))


def derive_keys(df: DataFrame) -> DataFrame:
    """Flight identifier, month, weekday and route; null where a part is missing."""
    return _replace(
        df,
        flight_id=F.concat("flight_number", F.lit("_"), X.compact_date(F.col("flight_date"))),
        month=X.month_text(F.col("flight_date")),
        day_of_week=X.weekday(F.col("flight_date")),
        route=F.concat("origin", F.lit("-"), "destination"),
        cabin_rank=X.cabin_rank(F.col("cabin_class")),
    )


def derive_delay(df: DataFrame) -> DataFrame:
    """Scheduled hour, part of day, and the delay measures."""
    hour = F.floor(X.clock_minutes(F.col("scheduled_departure")) / 60).try_cast("int")
    timed = _replace(df, departure_hour=hour, delay_minutes=floored_at_zero(F.col("departure_variance")))
    delay, cancelled = F.col("delay_minutes"), F.col("is_cancelled")
    return _replace(
        timed,
        time_of_day=X.time_of_day(F.col("departure_hour")),
        delay_category=X.delay_category(delay, cancelled),
        is_on_time=F.when(cancelled == 0, (delay < K.ON_TIME_MINUTES).cast("int")),
    )


def derive_amounts(df: DataFrame) -> DataFrame:
    """Whole numbers, money in cents, revenue; what does not fit its type is null, which the checks report."""
    typed = _replace(
        df,
        passengers=F.col("passengers").try_cast("bigint"),
        distance_miles=F.col("distance_miles").try_cast("int"),
        ticket_price=F.col("ticket_price").try_cast(CENTS),
    )
    return _replace(typed, revenue=F.try_multiply(F.col("passengers"), F.col("ticket_price")).try_cast(CENTS))


def derive(df: DataFrame) -> DataFrame:
    """All row-local columns."""
    return df.transform(derive_keys).transform(derive_delay).transform(derive_amounts)


CLEAN_COLUMNS = [
    "flight_id", "flight_number", "flight_date", "month", "day_of_week", "airline", "origin", "destination",
    "route", "aircraft", "scheduled_departure", "actual_departure", "departure_hour", "time_of_day",
    "departure_variance", "delay_minutes", "delay_category", "is_cancelled", "is_on_time", "distance_miles",
    "cabin_class", "cabin_rank", "passengers", "ticket_price", "revenue", "src_row",
]


def in_report_order(clean_rows: DataFrame) -> DataFrame:
    """Date, scheduled time, flight number, cabin order."""
    last = lambda c: F.col(c).asc_nulls_last()
    return clean_rows.orderBy(*map(last, ("flight_date", "scheduled_departure", "flight_number", "cabin_rank", "src_row")))


class Cleaned:
    """One cleaning run: four staged tables and what follows from them.

    ``typed`` and ``prepared`` are the large ones. ``donors`` and ``medians`` are
    staged too because several plans read them, and a written table tells the planner
    its size: they are broadcast only while they are small.
    """

    def __init__(self, prepared: DataFrame, typed: DataFrame | None = None):
        self.prepared = prepared
        self.typed = typed

    @cached_property
    def delivered(self) -> DataFrame:
        """Typed rows before any repair, with the row-local columns: the feed as it comes."""
        return derive(self.typed.drop("print_a", "print_b"))

    @cached_property
    def donors(self) -> DataFrame:
        return stage(find_donors(self.prepared), "donors")

    @cached_property
    def settled(self) -> DataFrame:
        return settle_departures(self.prepared, self.donors)

    @cached_property
    def medians(self) -> DataFrame:
        wanted = stage(groups_with_gaps(self.settled), "wanted")
        return stage(typical_values(self.settled, wanted=wanted), "medians")

    @cached_property
    def audited(self) -> DataFrame:
        """Clean rows with their audit columns."""
        return derive(impute(self.settled, self.medians))

    @cached_property
    def rows(self) -> DataFrame:
        return self.audited.select(*CLEAN_COLUMNS)

    @cached_property
    def report(self) -> DataFrame:
        return cleaning_report(self.prepared, self.settled)


def clean(raw: DataFrame) -> Cleaned:
    """Run the shared part of the job once and stage it."""
    typed = _type_feed(raw)
    return Cleaned(stage(_prepare_typed(typed), "prepared", "state"), typed)


def cleaning_report(prepared: DataFrame, settled: DataFrame) -> DataFrame:
    """The fourteen counters as (position, metric, value) rows.

    The prepared rows hold the counts of the rows they replaced. The rows that
    are left after settling are known without the medians.
    """
    usable = F.col("is_usable")
    early = prepared.agg(
        F.coalesce(F.sum("raw_rows"), F.lit(0)).alias("raw_rows"),
        F.coalesce(F.sum(F.col("raw_rows") - F.col("distinct_rows")), F.lit(0)).alias("exact_duplicates_removed"),
        F.coalesce(F.sum("symbol_rows"), F.lit(0)).alias("prices_with_currency_symbol_fixed"),
        F.coalesce(F.sum(F.col("distinct_rows") - 1), F.lit(0)).alias("key_duplicates_removed"),
        F.count_if("price_invalid").alias("invalid_prices_nulled"),
        F.count_if(~usable).alias("invalid_rows_dropped"),
        F.count_if(usable & F.col("delay_derived")).alias("delays_derived_from_times"),
        F.count_if(usable & F.col("actual_rebuilt")).alias("actual_departures_rebuilt"),
        F.count_if(usable).alias("usable_rows"),
    )
    per_flight = settled.groupBy(*FLIGHT_KEY).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(m).isNull()).alias(m) for m in MEASURES],
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    late = per_flight.agg(
        total("distance_miles").alias("distance_imputed_from_route"),
        total("passengers").alias("passengers_imputed"),
        total("ticket_price").alias("ticket_prices_imputed"),
        total("rows").alias("clean_rows"),
        F.count(F.lit(1)).alias("flights"),
    )
    counters = side_by_side(early, late).withColumn(
        "rows_dropped_no_departure_data", F.col("usable_rows") - F.col("clean_rows")
    )
    return metric_rows(counters, K.REPORT_COUNTERS, "bigint")
