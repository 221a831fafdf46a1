from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from filingframe import dims
from filingframe.functions import calendar as cal
from filingframe.functions import collections as col
from filingframe.functions import numbers, text, urls
from filingframe.functions.naming import camel_case, snake_case


@pytest.mark.parametrize(
    ("raw", "clean"),
    [
        ("كتاب يوسف", "کتاب یوسف"),
        ("مي‌خواهم", "میخواهم"),
        ("  a \t\n b c \x1c", "a b c"),
        ("مسؤول إيران أحمد ةء", "مسوول ایران احمد ه"),
        ("", ""),
        (None, ""),
    ],
)
def test_norm_text(values, raw, clean):
    assert values(text.norm_text(F.lit(raw).cast("string"))) == [clean]


def test_digits(values):
    assert values(
        text.latin_digits(F.lit("۱۳۹۸/٠٥/15")),
        text.persian_digits(F.lit("1398/05")),
        text.digits_only(F.lit(" ۰۰۱-23.0 ")),
        text.digits_only(F.lit(None).cast("string")),
        text.is_person_id(F.lit("۰۰۱۲۳۴۵۶۷۸")),
        text.is_person_id(F.lit("001234567")),
    ) == ["1398/05/15", "۱۳۹۸/۰۵", "001230", "", True, False]


@pytest.mark.parametrize(
    ("raw", "clean"),
    [("  فولاد۱  ", "فولاد1"), ("ab-c d_é", "ABCD_é"), ("خودرو!", "خودرو"), ("x²", "X²"), ("", "")],
)
def test_clean_symbol(values, raw, clean):
    assert values(text.clean_symbol(F.lit(raw))) == [clean]


def test_symbol_key_keeps_letters(values):
    assert values(text.symbol_key(F.lit(" كا‏ر  ۱ "))) == ["كار 1"]


@pytest.mark.parametrize(
    ("company", "candidates"),
    [
        ("شرکت الف", []),
        ("شرکت الف - نماد: الف", ["الف"]),
        ("شرکت ب - نماد: ب(ذب)", ["ذب", "ب"]),
        ("شرکت پ - نماد： پ ت ث(پتث)", ["پتث", "پ ت ث"]),
        ("شرکت ت - نماد: ت - بورس (ت)", ["ت"]),
        ("شرکت ث - نماد: ث، دوم", ["ث"]),
        ("شرکت ج - نماد: (ج", []),
        ("شرکت چ - نماد: چ()", ["چ"]),
        ("نماد:", []),
        (None, []),
    ],
)
def test_symbol_candidates(values, company, candidates):
    assert values(text.symbol_candidates(F.lit(company).cast("string"))) == [candidates]


def test_flags_and_errors(values):
    assert values(
        text.yes_no(F.lit("بله ")), text.yes_no(F.lit("TRUE")), text.yes_no(F.lit("خیر")),
        text.yes_no(F.lit(None).cast("string")),
        text.error_class(F.lit("net::ERR timeout")), text.error_class(F.lit("Navigation timeout")),
        text.error_class(F.lit("TIMEOUT")), text.error_class(F.lit(None).cast("string")),
    ) == [True, True, False, False, "network", "navigation", "timeout", "unknown"]


def test_calendar_is_a_bijection(spark):
    days = spark.sql("select explode(sequence(date'1921-03-21', date'2122-03-20')) d")
    dates = days.select("d", cal.to_jalali("d").alias("j")).distinct()
    found = dates.select(
        "d", "j", cal.from_jalali("j").alias("back"), cal.is_jalali_date("j").alias("ok")
    ).agg(
        F.count("*"), F.count_distinct("j"), F.count_if(F.col("d") == F.col("back")), F.count_if("ok"),
        F.min("j"), F.max("j"),
    ).first()
    assert list(found) == [73414] * 4 + ["1300/01/01", "1500/12/29"]


def test_known_dates(values):
    assert values(
        cal.gregorian_num_to_jalali(F.lit("20230815")),
        cal.gregorian_num_to_jalali(F.lit("2023081")),
        cal.from_jalali(F.lit("۱۴۰۲-۰۵-۲۴")).cast("string"),
        cal.from_jalali(F.lit(" 14020524 ")).cast("string"),
        cal.from_jalali(F.lit("1402/13/01")),
        cal.from_jalali(F.lit("1402/07/31")),
        cal.from_jalali(F.lit("1402/12/30")),
        cal.from_jalali(F.lit("1403/12/30")).cast("string"),
        cal.from_jalali(F.lit(None).cast("string")),
        cal.d_even(cal.from_jalali(F.lit("1402/05/24"))),
    ) == ["1402/05/24", None, "2023-08-15", "2023-08-15", None, None, None, "2025-03-20", None,
          20230815]


@pytest.mark.parametrize(
    ("date", "ok"),
    [
        ("1402/05/15", True),
        ("1402/5/1", True),
        ("1402/06/31", True),
        ("1402/07/31", False),
        ("1402/12/30", False),
        ("1403/12/30", True),
        ("1299/01/01", False),
        ("1501/01/01", False),
        ("1402-05-15", False),
        ("14020515", False),
        (None, False),
    ],
)
def test_is_jalali_date(values, date, ok):
    assert values(cal.is_jalali_date(F.lit(date).cast("string"))) == [ok]


def test_datetime_numbers(values):
    assert values(
        cal.datetime_to_num(F.lit("1402/05/15 10:30:00")),
        cal.datetime_to_num(F.lit("1402/05/15")),
        cal.datetime_to_num(F.lit("1402/5/1")),
        cal.datetime_to_num(F.lit("")),
        cal.datetime_to_num(F.lit("۱۴۰۲")),
        cal.num_to_datetime(F.lit(14020515103000)),
        cal.num_to_datetime(F.lit(14020515103000), include_time=False, date_sep="-"),
        cal.num_to_datetime(F.lit(515), time_sep="."),
    ) == [14020515103000, 14020515000000, 14025100000000, None, None, "1402/05/15 10:30:00",
          "1402-05-15", "0000/00/00 00.05.15"]


def test_year_ranges(spark):
    rows = [tuple(r) for r in cal.year_ranges(spark, 1398, 1400).collect()]
    assert rows == [
        (1398, "1398/01/01", "1398/12/29"),
        (1399, "1399/01/01", "1399/12/30"),
        (1400, "1400/01/01", "1400/12/29"),
    ]
    plain = cal.year_ranges(spark, 1399, 1399, fixed_29=True).first()
    assert plain["end_date"] == "1399/12/29"


def test_current_date(values):
    today, year = values(cal.current_jalali_date(), cal.current_jalali_year())
    assert today.startswith(f"{year}/")


def test_period_keys(values):
    assert values(
        cal.month_key(F.lit("14021223.0")), cal.quarter_key(F.lit("14021223")),
        cal.month_key(F.lit("4021223")), cal.quarter_key(F.lit("14020301")),
    ) == ["140212", "1402Q4", "040212", "1402Q1"]


@pytest.mark.parametrize(
    ("raw", "number"),
    [
        ("1.5M", 1500000.0), ("1,234", 1234.0), ("2 k", 2000.0), ("3B", 3e9), ("1T", 1e12),
        ("abc", 0.0), ("", 0.0), (None, 0.0), ("M", 0.0), ("-2.5", -2.5), ("1e3", 1000.0), ("1d", 0.0),
    ],
)
def test_parse_number(values, raw, number):
    assert values(numbers.parse_number(F.lit(raw).cast("string"))) == [number]


def test_format_thousands(values):
    assert values(
        numbers.format_thousands(F.lit(1234567)),
        numbers.format_thousands(F.lit(2.5)),
        numbers.format_thousands(F.lit(-2.7)),
        numbers.format_thousands(F.lit(1234.5), 2),
        numbers.format_thousands(F.lit(None).cast("double")),
    ) == ["1,234,567", "2", "-2", "1,234.50", ""]


def test_urls(values):
    null = F.lit(None).cast("string")
    assert values(
        urls.full_url(F.lit("/a"), "https://b"), urls.full_url(F.lit("a"), "https://b"),
        urls.full_url(F.lit("http://x")), urls.full_url(null),
        urls.letter_url(F.lit("/r"), F.lit("1"), "https://b"),
        urls.letter_url(F.lit(""), F.lit("7"), "https://b"), urls.letter_url(null, F.lit("")),
        urls.tracing_no_from_url(F.lit("x?TracingNo=12&LetterSerial=9")),
        urls.tracing_no_from_url(F.lit("x?TracingNo=12")), urls.tracing_no_from_url(F.lit("/a/77")),
        urls.tracing_no_from_url(F.lit("/a/77/")),
    ) == ["https://b/a", "https://b/a", "http://x", "", "https://b/r",
          "https://b/Reports/Decision.aspx?LetterSerial=7", None, "9", "12", "77", None]


def test_query_url_and_fingerprint(values):
    def params(*order):
        pairs = {"Symbol": "فولاد", "Length": "-1", "Page": "0"}
        return F.create_map(*[F.lit(x) for k in order for x in (k, pairs[k])])

    a, b = params("Symbol", "Length", "Page"), params("Page", "Symbol", "Length")
    one, two, url, web = values(
        urls.fingerprint(F.lit("u"), a), urls.fingerprint(F.lit("u"), b),
        urls.query_url(a, "https://s/q"), urls.query_url(a, "https://s/q", api=False),
    )
    assert one == two
    assert url == "https://s/q?Page=0&Symbol=%D9%81%D9%88%D9%84%D8%A7%D8%AF&search=true"
    assert web == "https://s/q?search&Page=0&Symbol=%D9%81%D9%88%D9%84%D8%A7%D8%AF"


def test_collections(values):
    left = F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("2"))
    right = F.create_map(F.lit("b"), F.lit("3"))
    none = F.lit(None).cast("map<string,string>")
    assert values(
        col.merge_maps(left, none, right), col.merge_maps(none, right),
        col.nested_get(F.lit('{"a":{"b":{"c":1}}}'), "a", "b", "c"),
        col.nested_get(F.lit('{"a":5}'), "a", "b", default="none"),
        col.unique(F.array(*map(F.lit, [3, 1, 3, 2, 1]))),
    ) == [{"a": "1", "b": "3"}, {"b": "3"}, "1", "none", [3, 1, 2]]


@pytest.mark.parametrize(
    ("name", "snake"),
    [
        ("PublishDateTime", "publish_date_time"), ("symbol", "symbol"), ("HasExcel", "has_excel"),
        ("ABC", "abc"), ("tracingNo2Url", "tracing_no2_url"),
    ],
)
def test_snake_case(name, snake):
    assert snake_case(name) == snake


def test_camel_case():
    assert camel_case("publish_date_time") == "publishDateTime"
    assert camel_case("symbol") == "symbol"


@pytest.mark.parametrize(
    ("value", "months"),
    [(12, 12), ("۶", 6), ("3", 3), ("٩", 9), (None, None), (-1, None), (0, None), ("همه موارد", None),
     ("all", None), (13, None), ("x", None)],
)
def test_period_length(value, months):
    assert dims.period_length(value) == months
