"""Row validation by named rules: violations per row, clean/quarantine split, report."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filingframe.functions.calendar import from_jalali, is_jalali_date
from filingframe.functions.text import strip

# Patterns of the rules.
PATTERNS = {
    "integer_string": r"^[0-9]+$",
    "symbol": r"^[\p{L}\p{N}_\u0600-\u06FF]+$",
    "isic": r"^[0-9]{4,6}$",
    "letter_code": r"^[\u0600-\u06FF]-[0-9]+$",
    "url": r"""^https?://[^\s<>"{}|\\^`\[\]]+""",
}


@dataclass(frozen=True)
class Rule:
    """A named test of a row; it holds or it does not, null counts as not."""

    kind: str
    column: str
    test: Callable[[DataFrame], Column]

    @property
    def name(self) -> str:
        return f"{self.column}:{self.kind}"


def _is(df: DataFrame, column: str, *kinds: type) -> bool:
    return isinstance(df.schema[column].dataType, kinds)


def _text(check: Callable[[Column], Column]) -> Callable[[DataFrame, str], Column]:
    """A check of text columns; any other type fails."""
    return lambda df, c: check(F.col(c)) if _is(df, c, T.StringType) else F.lit(False)


def _typed(*kinds: type) -> Callable[[DataFrame, str], Column]:
    return lambda df, c: F.col(c).isNotNull() & F.lit(_is(df, c, *kinds))


def _filled(df: DataFrame, c: str) -> Column:
    if _is(df, c, T.StringType):
        return strip(c) != ""
    if _is(df, c, T.ArrayType, T.MapType):
        return F.size(c) > 0
    return F.col(c).isNotNull()


def _length(df: DataFrame, c: str) -> Column | None:
    if _is(df, c, T.StringType):
        return F.length(c)
    if _is(df, c, T.ArrayType, T.MapType):
        return F.when(F.col(c).isNotNull(), F.size(c))
    return None


def _length_test(df: DataFrame, c: str, test: Callable[[Column], Column]) -> Column:
    length = _length(df, c)
    return F.lit(False) if length is None else test(length)


def _range(low: float, high: float) -> Callable[[DataFrame, str], Column]:
    def test(df: DataFrame, c: str) -> Column:
        if not _is(df, c, T.NumericType, T.BooleanType):
            return F.lit(False)
        value = F.col(c).cast("double")
        return ~F.isnan(value) & (value >= low) & (value <= high)

    return test


def _member(values: Sequence[object]) -> Callable[[DataFrame, str], Column]:
    known = [v for v in values if v is not None]
    null_allowed = len(known) < len(values)
    return lambda df, c: F.coalesce(F.col(c).isin(known), F.lit(null_allowed))


def _matching(pattern: str) -> Callable[[DataFrame, str], Column]:
    return _text(lambda v: v.rlike(f"^(?:{pattern})"))


_SIMPLE: dict[str, Callable[[DataFrame, str], Column]] = {
    "not_none": lambda df, c: F.col(c).isNotNull(),
    "not_empty": _filled,
    "boolean": _typed(T.BooleanType),
    "integer": _typed(T.IntegralType),
    "string": _typed(T.StringType),
    "integer_string": _text(lambda v: v.rlike(PATTERNS["integer_string"])),
    "date": _text(is_jalali_date),
    "symbol": _text(lambda v: strip(v).rlike(PATTERNS["symbol"])),
    "isic": _text(lambda v: v.rlike(PATTERNS["isic"])),
    "letter_code": _text(lambda v: v.rlike(PATTERNS["letter_code"])),
    "url": _text(lambda v: v.rlike(PATTERNS["url"])),
}


def rule(kind: str, column: str, **options: object) -> Rule:
    """Build a rule; unknown kinds fail here, before any data is read.

    ``range(min_val, max_val)``, ``list(valid_values)``, ``pattern(pattern)``,
    ``min_length(min_length)``, ``max_length(max_length)`` take options.
    """
    if kind in _SIMPLE:
        test = _SIMPLE[kind]
    elif kind == "range":
        test = _range(
            options.get("min_val", float("-inf")), options.get("max_val", float("inf"))
        )
    elif kind == "list":
        test = _member(options.get("valid_values", []))
    elif kind == "pattern":
        test = _matching(options.get("pattern", ".*"))
    elif kind == "min_length":
        least = options.get("min_length", 0)
        test = lambda df, c: _length_test(df, c, lambda n: n >= least)
    elif kind == "max_length":
        most = options.get("max_length", float("inf"))
        test = lambda df, c: _length_test(df, c, lambda n: n <= most)
    else:
        raise ValueError(f"unknown validation type: {kind}")
    return Rule(kind, column, lambda df: test(df, column))


def date_range_rule(first: str, last: str) -> Rule:
    """Both dates are real and in calendar order."""

    def test(_: DataFrame) -> Column:
        return is_jalali_date(first) & is_jalali_date(last) & (_day(first) <= _day(last))

    return Rule(f"not_after_{last}", first, test)


def _day(column: str) -> Column:
    """Day of a date whose month and day may lack leading zeros."""
    parts = F.split(column, "/")
    padded = [F.lpad(F.get(parts, F.lit(i)), w, "0") for i, w in enumerate((4, 2, 2))]
    return from_jalali(F.concat(*padded))


def _holds(df: DataFrame, r: Rule) -> Column:
    if r.column not in df.columns:
        return F.lit(False)
    return F.coalesce(r.test(df), F.lit(False))


def validate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``violations``, the names of the rules a row breaks."""
    broken = [F.when(~_holds(df, r), F.lit(r.name)) for r in rules]
    return df.withColumn("violations", F.array_compact(F.array(*broken)))


def split_valid(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Clean rows, and broken rows with their violations."""
    checked = validate(df, rules)
    clean = checked.where(F.size("violations") == 0).drop("violations")
    return clean, checked.where(F.size("violations") > 0)


def validation_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``rule, column, checked, failed`` of every rule in one aggregate."""
    failed = [F.count_if(~_holds(df, r)).alias(f"f{i}") for i, r in enumerate(rules)]
    totals = df.agg(F.count(F.lit(1)).alias("n"), *failed)
    lines = [
        F.struct(
            F.lit(r.kind).alias("rule"),
            F.lit(r.column).alias("column"),
            F.col("n").alias("checked"),
            F.col(f"f{i}").alias("failed"),
        )
        for i, r in enumerate(rules)
    ]
    return totals.select(F.inline(F.array(*lines)))
