"""Jalali calendar as integer Column arithmetic (33-year rule, years 1300-1500)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filingframe.functions.text import (
    ARABIC_DIGITS,
    ASCII_DIGITS,
    PERSIAN_DIGITS,
    ColumnOrName,
    as_col,
    strip,
)

# Fixed values of the 33-year rule: the day number of 1970-01-01, days per
# 33-year cycle, the phase of the leap cycle and its leap years. A year starts
# on day 365*y + (8*y + 21) div 33.
EPOCH_DAY = 492633
DAYS_33 = 12053
LEAP_PHASE = 21
LEAP_REMAINDERS = (1, 5, 9, 13, 17, 22, 26, 30)
# Well-formed dates of years 1300-1500; months 1-6 have 31 days, the others 30.
# Whether a year has a 30th of month 12 is checked apart.
_DAY_31 = "(0?[1-9]|[12][0-9]|3[01])"
_DAY_30 = "(0?[1-9]|[12][0-9]|30)"
DATE_PATTERN = (
    f"^(1[34][0-9]{{2}}|1500)/(0?[1-6]/{_DAY_31}|(0?[7-9]|1[012])/{_DAY_30})$"
)
_COMPACT_PATTERN = (
    "^(?!0000)[0-9]{4}(0[1-6](0[1-9]|[12][0-9]|3[01])|(0[7-9]|1[012])(0[1-9]|[12][0-9]|30))$"
)



def _div(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b)).cast("int")


def _days_before(year: Column) -> Column:
    return 365 * year + _div(8 * year + LEAP_PHASE, 33)


def _days_of_year(sep: str) -> Column:
    """Month and day of each day of a year; one constant array in the plan."""
    lengths = [31] * 6 + [30] * 6
    days = [f"{m:02d}{sep}{d:02d}" for m, n in enumerate(lengths, 1) for d in range(1, n + 1)]
    return F.split(F.lit(",".join(days)), ",")


# Spark inlines an expression wherever a derived column is used, so these
# mention their input as few times as possible.
def _day_number(date: ColumnOrName) -> Column:
    return F.unix_date(as_col(date).cast("date")) + EPOCH_DAY


def jalali_year(date: ColumnOrName) -> Column:
    return _div(33 * _day_number(date) + 11, DAYS_33)


def to_jalali(date: ColumnOrName, sep: str = "/") -> Column:
    """Gregorian date or timestamp -> ``YYYY/MM/DD``."""
    year = jalali_year(date)
    day_of_year = _day_number(date) - _days_before(year)
    return F.concat(year.cast("string"), F.lit(sep), F.get(_days_of_year(sep), day_of_year))


def gregorian_num_to_jalali(num: ColumnOrName) -> Column:
    """``YYYYMMDD`` number or text -> Jalali text; not eight characters -> null."""
    text = as_col(num).cast("string")
    date = F.when(text.rlike("^[0-9]{8}$"), F.try_to_date(text, "yyyyMMdd"))
    return to_jalali(date)


def is_leap_year(year: Column) -> Column:
    return F.pmod(year, F.lit(33)).isin(*LEAP_REMAINDERS)


def is_jalali_date(c: ColumnOrName) -> Column:
    """Well-formed ``Y/M/D`` text that exists in the calendar; null -> false."""
    text = as_col(c)
    year = F.substring(text, 1, 4).try_cast("int")
    exists = ~text.rlike("/12/30$") | is_leap_year(year)
    return F.coalesce(text.rlike(DATE_PATTERN) & exists, F.lit(False))


def from_jalali(c: ColumnOrName) -> Column:
    """Jalali text (slashes, dashes or compact, any digit script) -> date or null."""
    # separators have no counterpart in the target digits, so they are dropped
    digits = F.translate(
        as_col(c).cast("string"), PERSIAN_DIGITS + ARABIC_DIGITS + "/-", ASCII_DIGITS * 2
    )
    text = strip(digits)
    year = F.substring(text, 1, 4).try_cast("int")
    month = F.substring(text, 5, 2).try_cast("int") - 1
    day = F.substring(text, 7, 2).try_cast("int") - 1
    n = _days_before(year) + 30 * month + F.least(month, F.lit(6)) + day
    exists = ~text.endswith("1230") | is_leap_year(year)
    real = text.rlike(_COMPACT_PATTERN) & exists
    return F.when(real, F.date_from_unix_date(n - EPOCH_DAY))


def d_even(date: ColumnOrName) -> Column:
    """Date -> integer ``YYYYMMDD``."""
    d = as_col(date)
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def from_d_even(c: ColumnOrName) -> Column:
    return F.try_to_date(as_col(c).cast("string"), "yyyyMMdd")


def datetime_to_num(c: ColumnOrName) -> Column:
    """Digits of a date-time as ``YYYYMMDDHHmmss``; no digits -> null."""
    digits = F.regexp_replace(as_col(c).cast("string"), "[^0-9]", "")
    return F.when(digits != "", F.rpad(digits, 14, "0").cast("bigint"))


def num_to_datetime(
    c: ColumnOrName,
    include_time: bool = True,
    date_sep: str = "/",
    time_sep: str = ":",
    dt_sep: str = " ",
) -> Column:
    text = F.lpad(as_col(c).cast("string"), 14, "0")

    def cut(start: int, width: int) -> Column:
        return F.substring(text, start, width)

    date = F.concat(cut(1, 4), F.lit(date_sep), cut(5, 2), F.lit(date_sep), cut(7, 2))
    if not include_time:
        return date
    return F.concat(
        date,
        F.lit(dt_sep),
        cut(9, 2),
        F.lit(time_sep),
        cut(11, 2),
        F.lit(time_sep),
        cut(13, 2),
    )


def year_end(year: Column, fixed_29: bool = False) -> Column:
    """Last day of a Jalali year; ``fixed_29`` always ends on 12/29."""
    last = "12/29"
    tail = F.lit(last) if fixed_29 else F.when(is_leap_year(year), "12/30").otherwise(last)
    return F.concat_ws("/", year.cast("string"), tail)


def year_start(year: Column) -> Column:
    return F.concat_ws("/", year.cast("string"), F.lit("01/01"))


def year_ranges(
    spark: SparkSession, start: int = 1390, end: int | None = None, fixed_29: bool = False
) -> DataFrame:
    """One row per Jalali year with its first and last day."""
    last = F.lit(end) if end is not None else current_jalali_year()
    years = spark.range(1).select(
        F.explode(F.sequence(F.lit(start), last.cast("int"))).alias("year")
    )
    return years.select(
        "year",
        year_start(F.col("year")).alias("start_date"),
        year_end(F.col("year"), fixed_29).alias("end_date"),
    )


def current_jalali_date() -> Column:
    return to_jalali(F.current_date())


def current_jalali_year() -> Column:
    return jalali_year(F.current_date())


def month_key(date_digits: ColumnOrName) -> Column:
    """``YYYYMM`` of an eight-digit date."""
    return F.substring(period_digits(date_digits), 1, 6)


def quarter_key(date_digits: ColumnOrName) -> Column:
    """``YYYYQn`` of an eight-digit date."""
    text = period_digits(date_digits)
    quarter = _div(F.substring(text, 5, 2).try_cast("int") + 2, 3)
    return F.concat(F.substring(text, 1, 4), F.lit("Q"), quarter.cast("string"))


def period_digits(c: ColumnOrName) -> Column:
    """Date text as zero-padded digits; a float tail ``.0`` is dropped."""
    text = F.replace(as_col(c).cast("string"), F.lit(".0"), F.lit(""))
    return F.lpad(text, F.greatest(F.length(text), F.lit(8)), F.lit("0"))
