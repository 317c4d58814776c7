import datetime

from pyspark.sql import functions as F

from skyledger.functions import numeric as N
from skyledger.functions import text as X


def test_strip_removes_any_white_space_and_blanks_become_null(column):
    values = ["\t a \n", " b ", "   ", "", None, "a b", "NA", "\x1cc\x1f", "é "]
    assert column(X.stripped, values) == ["a", "b", None, None, None, "a b", "NA", "c", "é"]


def test_title_case_starts_a_word_after_any_non_letter(column):
    values = ["BLUE AIR", "o'hare", "mc-donald air", "3com", "premium  economy", None]
    assert column(X.title_case, values) == [v.title() if v else None for v in values]


def test_dates_in_both_spellings_and_bad_dates_as_null(column):
    values = ["2025-03-14", "03/14/2025", "3/4/2025", "2025-02-30", "soon", None]
    day = datetime.date
    assert column(X.parsed_date, values) == [day(2025, 3, 14), day(2025, 3, 14), day(2025, 3, 4), None, None, None]


def test_cancelled_flag_spellings(column):
    values = ["Yes", "y", "1", "TRUE", "No", "N", "0", "false", "maybe", "t", None]
    assert column(X.cancelled_flag, values) == [1, 1, 1, 1, 0, 0, 0, 0, None, None, None]


def test_numbers_refuse_what_a_bare_cast_accepts(column):
    values = ["12", "-7", "+3.5", ".5", "5.", "1e3", "12d", "NaN", "inf", "Infinity", "1,200", "0x1Ap3", "", None]
    assert column(N.to_number, values) == [12, -7, 3.5, 0.5, 5, 1000] + [None] * 8


def test_calendar_texts_are_those_of_the_formatter(column):
    values = ["2025-03-04", "0999-12-31", "0001-01-01", "9999-12-31", "0000-02-03", "12025-03-04", None]
    date = lambda v: v.try_cast("date")
    for ours, pattern in ((X.iso_date, "yyyy-MM-dd"), (X.month_text, "yyyy-MM"), (X.compact_date, "yyyyMMdd"), (X.weekday, "EEEE")):
        assert column(lambda v: ours(date(v)), values) == column(lambda v: F.date_format(date(v), pattern), values)


def test_usual_spellings_read_as_the_general_path_reads_them(column):
    dates = ["2025-03-04", "2025-3-4", "2025-02-30", "2024-02-29", "0000-01-01", "2025-13-01", "2025-00-10", "2025-3-4x", "12025-03-04"]
    general = lambda v: F.coalesce(*[F.try_to_date(v, p) for p in ("yyyy-M-d", "M/d/yyyy")]).cast("string")
    assert column(lambda v: X.parsed_date(v).cast("string"), dates) == column(general, dates)
    assert column(X.clock_minutes, ["10:05", "99:99", " 7: 5 ", "1e1:05", "+1:05"]) == [605, 6039, 425, 605, 65]
    assert column(N.to_number, ["1e400", "9" * 400, "123456789012345", "-12.50"]) == [None, None, 123456789012345, -12.5]


def test_clock_minutes(column):
    values = ["10:05", "00:00", "7:5", "ab:cd", "10", "10:", "12:30:45", None]
    assert column(X.clock_minutes, values) == [605, 0, 425, None, None, None, 750, None]


def test_clock_text_wraps_into_one_day(column):
    assert column(X.clock_text, [0.0, 605.0, 1445.0, -7.0, None], "double") == ["00:00", "10:05", "00:05", "23:53", None]


def test_parts_of_day(column):
    hours = [0, 11, 12, 16, 17, 20, 21, 23, 24, None]
    expected = ["Morning"] * 2 + ["Afternoon"] * 2 + ["Evening"] * 2 + ["Night"] * 2 + [None, None]
    assert column(X.time_of_day, hours, "int") == expected


def test_delay_bins(column):
    delays = [0.0, 14.0, 14.5, 15.0, 29.0, 30.0, 59.0, 60.0, 119.0, 120.0, 179.0, 180.0, None]
    labels = ["On time (<15)"] * 2 + ["15-29"] * 3 + ["30-59"] * 2 + ["60-119"] * 2 + ["120-179"] * 2 + ["180+", None]
    assert column(lambda v: X.delay_category(v, F.lit(0)), delays, "double") == labels
    assert column(lambda v: X.delay_category(v, F.lit(1)), [None, 3.0], "double") == ["Cancelled", "Cancelled"]


def test_rounding_styles(column):
    values = [0.125, 2.5, 3900.505, -0.125, None]
    assert column(N.money, values, "double") == [0.13, 2.5, 3900.51, -0.13, None]
    assert column(N.half_even, [2.5, 3.5, 4.4], "double") == [2.0, 4.0, 4.0]


def test_half_even_equals_pandas(column):
    import pandas as pd

    values = [0.125, 0.375, 2.675, 1.005, 99.995, 100.125, 0.015]
    assert column(lambda v: N.half_even(v, 2), values, "double") == pd.Series(values).round(2).tolist()


def test_ratio_of_zero_is_null_and_floor_keeps_null(column):
    assert column(lambda v: N.ratio(F.lit(1.0), v), [0.0, 4.0, None], "double") == [None, 0.25, None]
    assert column(N.floored_at_zero, [-3.0, 0.0, 2.0, None], "double") == [0.0, 0.0, 2.0, None]
