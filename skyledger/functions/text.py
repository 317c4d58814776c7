"""Text, clock and date parsing for the all-text feed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyledger import constants as K
from skyledger.functions.numeric import to_number


def stripped(text: Column) -> Column:
    """Remove surrounding white space of any kind; empty text becomes null.

    Text of single-byte characters needs only the short list, which is much cheaper to search.
    """
    single_byte = F.char_length(text) == F.octet_length(text)
    return F.nullif(
        F.when(single_byte, F.btrim(text, F.lit(K.ASCII_WHITESPACE))).otherwise(F.btrim(text, F.lit(K.WHITESPACE))),
        F.lit(""),
    )


def title_case(text: Column) -> Column:
    """Capitalise every run of letters.

    ``initcap`` only starts words after a space; text with other separators
    (``o'hare``) takes the split path. Plain letters are told apart first, by a pattern that is cheap to match.
    """
    runs = F.split(F.lower(text), r"(?<=\P{L})")
    by_run = F.array_join(
        F.transform(runs, lambda run: F.concat(F.upper(F.left(run, F.lit(1))), F.substr(run, F.lit(2)))), ""
    )
    by_word = F.initcap(text)
    return F.when(text.rlike(r"^[A-Za-z ]*$"), by_word).when(text.rlike(r"[^\p{L} ]"), by_run).otherwise(by_word)


def parsed_date(text: Column, patterns: tuple[str, ...] = K.DATE_PATTERNS) -> Column:
    """First pattern that fits, value by value; null when none does.

    Text in the usual spelling of a cast needs no formatter, which costs several times as much.
    """
    by_pattern = F.coalesce(*[F.try_to_date(text, pattern) for pattern in patterns])
    if patterns[0] != K.DATE_PATTERNS[0]:
        return by_pattern
    return F.when(text.rlike(r"^[1-9][0-9]{3}-[0-9]{1,2}-[0-9]{1,2}$"), text.try_cast("date")).otherwise(by_pattern)


def _usual_year(date: Column) -> Column:
    return F.year(date).between(1, 9999)


def iso_date(date: Column) -> Column:
    """``YYYY-MM-DD``."""
    return F.when(_usual_year(date), date.cast("string")).otherwise(F.date_format(date, "yyyy-MM-dd"))


def month_text(date: Column) -> Column:
    """``YYYY-MM``."""
    return F.when(_usual_year(date), F.left(date.cast("string"), F.lit(7))).otherwise(F.date_format(date, "yyyy-MM"))


def compact_date(date: Column) -> Column:
    """``YYYYMMDD``."""
    plain = F.replace(date.cast("string"), F.lit("-"), F.lit(""))
    return F.when(_usual_year(date), plain).otherwise(F.date_format(date, "yyyyMMdd"))


def weekday(date: Column) -> Column:
    names = F.array(*map(F.lit, K.WEEKDAYS))
    return F.when(date.isNotNull(), F.element_at(names, F.dayofweek(date)))


def cancelled_flag(text: Column) -> Column:
    lowered = F.lower(text)
    return F.when(lowered.isin(*K.CANCELLED_YES), F.lit(1)).when(lowered.isin(*K.CANCELLED_NO), F.lit(0))


def clock_minutes(text: Column) -> Column:
    """``HH:MM`` to minutes after midnight (double); null when a part is not a number.

    Two and two digits, the usual spelling, are not taken apart part by part.
    """
    hours = F.substring_index(text, ":", 1)
    rest = F.substring_index(F.substring_index(text, ":", 2), ":", -1)
    number = lambda part: to_number(F.trim(part))
    digits = lambda start: F.substring(text, start, 2).try_cast("double")
    return F.when(text.rlike(r"^[0-9]{2}:[0-9]{2}$"), digits(1) * 60 + digits(4)).when(
        F.contains(text, F.lit(":")), number(hours) * 60 + number(rest)
    )


def clock_text(minutes: Column) -> Column:
    """Minutes, wrapped into one day, to ``HH:MM``."""
    whole = F.pmod(minutes, F.lit(K.MINUTES_PER_DAY)).try_cast("int")
    two = lambda part: F.lpad(part.cast("string"), 2, "0")
    return F.concat(two(F.floor(whole / 60)), F.lit(":"), two(whole % 60))


def binned(value: Column, bins: tuple[tuple[str, int | None], ...]) -> Column:
    """Label of the first bin whose upper edge is not exceeded."""
    first, *rest = bins
    upto = lambda edge: F.lit(True) if edge is None else value <= edge
    chain = reduce(
        lambda acc, b: acc.when(value.isNotNull() & upto(b[1]), F.lit(b[0])),
        rest,
        F.when(value.isNotNull() & upto(first[1]), F.lit(first[0])),
    )
    return chain


def time_of_day(hour: Column) -> Column:
    return binned(hour, K.DAYPARTS)


def delay_category(delay: Column, cancelled: Column) -> Column:
    return F.when(cancelled == 0, binned(delay, K.DELAY_BINS)).otherwise(F.lit(K.CANCELLED_LABEL))


def cabin_rank(cabin: Column) -> Column:
    """Position in the fixed cabin order; null for an unknown cabin."""
    return reduce(
        lambda acc, c: acc.when(cabin == c[1], F.lit(c[0])),
        list(enumerate(K.CABINS))[1:],
        F.when(cabin == K.CABINS[0], F.lit(0)),
    )


def month_date(month: Column) -> Column:
    """First day of a ``YYYY-MM`` month."""
    return F.to_date(F.concat(month, F.lit("-01")), "yyyy-MM-dd")
