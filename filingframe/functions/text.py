"""Persian/Arabic text, digits, symbols and flags as Column expressions."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Arabic letters and their Persian counterparts, position by position.
ARABIC_LETTERS = "يكةؤإأ"
PERSIAN_LETTERS = "یکهواا"
# Dropped letter and zero-width / direction marks.
HAMZA = "ء"
ZERO_WIDTH = "‌‏‎‍​﻿"
SYMBOL_NOISE = "‌‏"
# Digits.
PERSIAN_DIGITS = "۰۱۲۳۴۵۶۷۸۹"
ARABIC_DIGITS = "٠١٢٣٤٥٦٧٨٩"
ASCII_DIGITS = "0123456789"

# (?U) makes \s cover NBSP and friends; the four separators below are
# whitespace to the data model but not to Java.
_SPACES = r"(?U)[\s\x1c-\x1f]+"
# The same characters, spelled out for trimming without a regex.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# The symbol marker, what may follow it, and where a ticker ends.
SYMBOL_MARKER = "نماد"
_AFTER_MARKER = "^[ :：]+"
_TICKER_HEAD = "^([^(،,|-]*)"
_TICKER_IN_PARENTHESES = r"^[^(]*\(([^)]*)\)"
_TICKER_TRIM = r"^[()\[\]،,;]+|[()\[\]،,;]+$"

NON_EXECUTIVE = "غیر موظف"
YES = "بله"


def as_col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: ColumnOrName) -> Column:
    """Trim all Unicode whitespace (``trim`` alone only removes spaces)."""
    return F.btrim(as_col(c), F.lit(WHITESPACE))


def squeeze(c: ColumnOrName) -> Column:
    """Collapse whitespace runs to one space and trim."""
    return F.trim(F.regexp_replace(as_col(c), _SPACES, " "))


def clean_str(c: ColumnOrName) -> Column:
    """Null -> empty, otherwise stripped."""
    return strip(F.coalesce(as_col(c), F.lit("")))


def norm_text(c: ColumnOrName) -> Column:
    """Persian letters, no zero-width marks, single spaces; null -> empty."""
    letters = F.translate(
        F.coalesce(as_col(c), F.lit("")),
        ARABIC_LETTERS + HAMZA + ZERO_WIDTH,
        PERSIAN_LETTERS,
    )
    return squeeze(letters)


def latin_digits(c: ColumnOrName) -> Column:
    return F.translate(as_col(c), PERSIAN_DIGITS + ARABIC_DIGITS, ASCII_DIGITS * 2)


def persian_digits(c: ColumnOrName) -> Column:
    return F.translate(as_col(c), ASCII_DIGITS, PERSIAN_DIGITS)


def clean_symbol(c: ColumnOrName) -> Column:
    """Letters, numbers and underscore only; digits unified, ASCII letters upper-cased."""
    # one character map; hamza has no counterpart and is dropped, as are all
    # marks and spaces by the pattern
    letters = F.translate(
        F.coalesce(as_col(c), F.lit("")),
        ARABIC_LETTERS + PERSIAN_DIGITS + ARABIC_DIGITS + ascii_lowercase + HAMZA,
        PERSIAN_LETTERS + ASCII_DIGITS * 2 + ascii_uppercase,
    )
    return F.regexp_replace(letters, r"[^\p{L}\p{N}_\u0600-\u06FF]+", "")


def symbol_key(c: ColumnOrName) -> Column:
    """Join key of a symbol: digits and spacing unified, letters untouched."""
    plain = F.translate(
        F.coalesce(as_col(c), F.lit("")),
        PERSIAN_DIGITS + ARABIC_DIGITS + SYMBOL_NOISE,
        ASCII_DIGITS * 2,
    )
    return squeeze(plain)


def symbol_candidates(company: ColumnOrName) -> Column:
    """Ticker candidates in a company title: parenthesised text first, then the head."""
    text = strip(F.translate(F.coalesce(as_col(company), F.lit("")), SYMBOL_NOISE, ""))
    rest = F.regexp_extract(text, f"(?s){SYMBOL_MARKER}(.*)$", 1)
    rest = strip(F.regexp_replace(rest, _AFTER_MARKER, ""))

    def tidy(c: Column) -> Column:
        return F.regexp_replace(squeeze(c), _TICKER_TRIM, "")

    inside = tidy(F.regexp_extract(rest, _TICKER_IN_PARENTHESES, 1))
    head = tidy(F.regexp_extract(rest, _TICKER_HEAD, 1))
    return F.array_distinct(F.filter(F.array(inside, head), lambda s: s != ""))


def digits_only(c: ColumnOrName) -> Column:
    """ASCII digits of a value after unifying digit scripts; null -> empty."""
    text = latin_digits(F.coalesce(as_col(c).cast("string"), F.lit("")))
    return F.regexp_replace(text, "[^0-9]", "")


def is_person_id(c: ColumnOrName) -> Column:
    """A person identifier has exactly ten digits."""
    return F.length(digits_only(c)) == 10


def person_id(c: ColumnOrName) -> Column:
    """The ten digits of a person identifier, else null."""
    plain = F.when(as_col(c).rlike("^[0-9]{10}$"), as_col(c).cast("string"))
    # only what is not plain yet pays for the conversion
    return F.coalesce(plain, F.when(is_person_id(c), digits_only(c)))


def yes_no(c: ColumnOrName) -> Column:
    return is_yes(norm_text(c))


def is_yes(normalised: Column) -> Column:
    return F.lower(normalised).isin(YES, "yes", "true", "1")


def is_non_executive(normalised_duty: Column) -> Column:
    return F.contains(normalised_duty, F.lit(NON_EXECUTIVE))


def norm_cells(row: ColumnOrName) -> Column:
    """Cells of a TAB-separated row, each as ``norm_text`` gives it.

    The row is normalised as a whole, which leaves its TABs alone.
    """
    letters = F.translate(as_col(row), ARABIC_LETTERS + HAMZA + ZERO_WIDTH, PERSIAN_LETTERS)
    spaced = F.regexp_replace(letters, r"(?U)[\s\x1c-\x1f&&[^\t]]+", " ")
    return F.split(F.trim(F.regexp_replace(spaced, " ?\t ?", "\t")), "\t")


def error_class(message: ColumnOrName) -> Column:
    """Classify a failure message; the first matching rule wins."""
    text = F.lower(F.coalesce(as_col(message), F.lit("")))

    def has(word: str) -> Column:
        return F.contains(text, F.lit(word))

    return (
        F.when(has("net::") | has("network"), "network")
        .when(has("navigation"), "navigation")
        .when(has("timeout"), "timeout")
        .otherwise("unknown")
    )
