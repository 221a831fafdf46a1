"""Human-formatted numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from filingframe.functions.text import ColumnOrName, as_col, latin_digits, strip

# Magnitude suffixes, any case.
MULTIPLIERS = {"K": 1e3, "M": 1e6, "B": 1e9, "T": 1e12}

_NUMBER = (
    r"(?i)^[+-]?(([0-9]+(_[0-9]+)*\.?([0-9]+(_[0-9]+)*)?|\.[0-9]+(_[0-9]+)*)"
    r"(e[+-]?[0-9]+(_[0-9]+)*)?|inf|infinity)$|^nan$"
)


def _plain(text: Column) -> Column:
    value = F.regexp_replace(text, "_", "").try_cast("double")
    return F.when(text.rlike(_NUMBER), value)


def parse_number(c: ColumnOrName) -> Column:
    """``"1.5M"`` -> 1500000.0; anything unreadable -> 0.0."""
    text = strip(F.regexp_replace(latin_digits(as_col(c).cast("string")), "[, ]", ""))
    suffix = F.upper(F.right(text, F.lit(1)))
    body = strip(F.regexp_replace(text, "(?i)[KMBT]$", ""))
    factor = F.lit(None).cast("double")
    for letter, multiple in MULTIPLIERS.items():
        factor = F.when(suffix == letter, F.lit(multiple)).otherwise(factor)
    value = F.when(factor.isNotNull(), _plain(body) * factor).otherwise(_plain(text))
    return F.coalesce(value, F.lit(0.0))


def format_thousands(c: ColumnOrName, decimal_places: int = 0) -> Column:
    """Grouped digits; without decimals the number is truncated, not rounded."""
    number = as_col(c)
    if decimal_places > 0:
        text = F.format_number(number.cast("double"), decimal_places)
    else:
        text = F.format_number(number.try_cast("bigint"), 0)
    return F.coalesce(text, F.lit(""))
