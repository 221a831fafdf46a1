"""Letter search: one conjunction of pushed-down predicates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingframe import dims
from filingframe.functions.text import clean_symbol
from filingframe.operators.frame import filter_by_date_range


def _flag_pair(column: str, include_true: bool, include_false: bool) -> list[Column]:
    if include_true and include_false:
        return []
    flag = F.coalesce(F.col(column), F.lit(False))
    if include_true:
        return [flag]
    return [~flag] if include_false else [F.lit(False)]


def search_letters(
    df: DataFrame,
    *,
    symbol: str | list[str] | None = None,
    company_type: str | None = None,
    isic: str | None = None,
    subject: str | None = None,
    tracing_no: str | None = None,
    letter_code: str | None = None,
    period_length: int | str | None = None,
    from_date: str | None = None,
    to_date: str | None = None,
    year_end: str | None = None,
    audited: bool = True,
    not_audited: bool = True,
    consolidated: bool = True,
    not_consolidated: bool = True,
    childs: bool = True,
    mains: bool = True,
    publisher_only: bool = False,
) -> DataFrame:
    """Letters that meet every criterion that is set."""
    tests: list[Column] = []
    if symbol:
        wanted = [symbol] if isinstance(symbol, str) else list(symbol)
        tests.append(F.col("symbol").isin([clean_symbol(F.lit(s)) for s in wanted]))
    if company_type:
        code = dims.COMPANY_TYPES.get(company_type, company_type)
        if code != "-1":
            tests.append(F.col("company_type") == int(code))
    months = dims.period_length(period_length)
    if months is not None:
        tests.append(F.col("period_length") == months)
    if subject:
        tests.append(F.contains(F.col("title"), F.lit(subject)))
    exact = {
        "isic": isic,
        "tracing_no": tracing_no,
        "letter_code": letter_code,
        "year_end": year_end,
    }
    tests += [F.col(name) == value for name, value in exact.items() if value]
    tests += _flag_pair("audited", audited, not_audited)
    tests += _flag_pair("consolidated", consolidated, not_consolidated)
    tests += _flag_pair("is_child", childs, mains)
    if publisher_only:
        tests.append(F.col("is_publisher"))
    found = df.where(reduce(Column.__and__, tests)) if tests else df
    return filter_by_date_range(found, from_date, to_date, "publish_date_time", end_of_day=True)


def board_changes(
    df: DataFrame,
    from_date: str | None = None,
    to_date: str | None = None,
    company_type: str | None = None,
) -> DataFrame:
    return search_letters(
        df,
        letter_code=dims.BOARD_CHANGE,
        company_type=company_type,
        from_date=from_date,
        to_date=to_date,
        childs=False,
    )


def financial_statements(
    df: DataFrame,
    from_date: str | None = None,
    to_date: str | None = None,
    period_length: int | str = 12,
    audited_only: bool = True,
) -> DataFrame:
    return search_letters(
        df,
        letter_code=dims.FINANCIAL_STATEMENT,
        period_length=period_length,
        not_audited=not audited_only,
        from_date=from_date,
        to_date=to_date,
    )


def monthly_reports(
    df: DataFrame,
    from_date: str | None = None,
    to_date: str | None = None,
    symbol: str | None = None,
) -> DataFrame:
    return search_letters(
        df,
        letter_code=dims.MONTHLY_REPORT,
        symbol=symbol,
        from_date=from_date,
        to_date=to_date,
    )


def letters_of_symbol(
    df: DataFrame,
    symbol: str | list[str],
    from_date: str | None = None,
    to_date: str | None = None,
    both_bounds: bool = True,
) -> DataFrame:
    """Letters of one or more symbols; by default a range needs both its bounds."""
    if both_bounds and not (from_date and to_date):
        from_date = to_date = None
    return search_letters(df, symbol=symbol, from_date=from_date, to_date=to_date)
