"""Readers, writers and validation rules."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from filingframe.operators import aggregates as agg
from filingframe.operators import quality
from filingframe.schemas import BOARD_MEMBER, LETTER
from filingframe.sources import readers, sinks

LETTERS = [
    {"TracingNo": "1", "Symbol": "فولاد ", "Title": "كتاب", "HasExcel": True, "CompanyType": 1},
    {"TracingNo": "2", "Symbol": "خودرو", "Url": "/r/2"},
]


def test_schemas():
    assert len(LETTER.fields) == 23 and LETTER.fieldNames()[:3] == ["url", "tracing_no", "symbol"]
    kinds = [f.dataType.simpleString() for f in BOARD_MEMBER.fields]
    assert (len(kinds), kinds.count("boolean")) == (29, 7)


@pytest.mark.parametrize(
    "document",
    [
        LETTERS,
        {"Letters": LETTERS, "Total": 2, "Page": 1},
        {"data": LETTERS},
        {"pages": {"1": LETTERS[:1], "2": None, "3": [], "4": LETTERS[1:]}},
        {"Letters": LETTERS, "data": [{"TracingNo": "9"}]},
    ],
)
def test_json_envelopes(spark, tmp_path, document):
    (tmp_path / "doc.json").write_text(json.dumps(document, ensure_ascii=False, indent=1))
    rows = readers.normalise(readers.read_letters_json(spark, str(tmp_path))).orderBy("tracing_no").collect()
    assert [(r["tracing_no"], r["symbol"], r["title"], r["url"]) for r in rows] == [
        ("1", "فولاد", "کتاب", None), ("2", "خودرو", "", "/r/2"),
    ]


def test_broken_pages_are_set_aside(spark, tmp_path):
    (tmp_path / "1.json").write_text(json.dumps({"Letters": LETTERS}))
    (tmp_path / "2.json").write_text('{"Letters": [{"Tracin')
    (tmp_path / "3.json").write_text(json.dumps({"Letters": []}))
    assert readers.read_letters_json(spark, str(tmp_path)).count() == 2
    broken = readers.corrupt_documents(spark, str(tmp_path)).collect()
    assert [r["file"].rsplit("/", 1)[1] for r in broken] == ["2.json"]


def test_responses(spark):
    df = spark.createDataFrame([(json.dumps({"Letters": LETTERS}),), ("{}",), ('{"Letters": []}',)], "value string")
    assert readers.parse_responses(df).select("tracing_no", "symbol").count() == 2


def test_url_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿url,symbol\nhttp://a,x\n", encoding="utf-8")
    assert readers.read_url_csv(spark, str(tmp_path / "a.csv")).columns == ["url"]
    assert readers.read_url_csv(spark, str(tmp_path / "a.csv"), "nope").columns == ["url", "symbol"]


def test_jalali_columns_are_found_by_content(spark):
    df = spark.createDataFrame(
        [(None, "2024-01-01 10:00:00", "x"), ("1402/01/01", "bad", "y")],
        "publish_date string, sent_time string, sentiment string",
    )
    assert readers.jalali_text_columns(df) == ["publish_date"]
    kinds = dict(readers.parse_dates(df.drop("sentiment"), ["publish_date"]).dtypes)
    assert kinds == {"publish_date": "string", "sent_time": "timestamp"}


def test_holder_columns(spark):
    df = spark.createDataFrame([("n", 1.5, "x", "last")], "`سهامدار / دارنده` string, Percent double, junk string, `Holder Name` string")
    row = readers.normalise_holders(df).first().asDict()
    assert row == {"shareHolderName": "last", "perOfShares": 1.5, "shareHolderShareID": None}


@pytest.fixture(scope="module")
def frame(spark):
    rows = [("1", "الف", 1402, None), ("2", "ب, \"پ\"", 1403, "x")]
    df = spark.createDataFrame(rows, "tracing_no string, symbol string, jalali_year int, url string")
    return df.withColumn("at", F.lit("2024-01-01 00:00:00").cast("timestamp"))


def test_round_trips(spark, tmp_path, frame):
    path = str(tmp_path)
    sinks.write_parquet(frame, f"{path}/p", partition_by="jalali_year")
    back = spark.read.parquet(f"{path}/p")
    assert sorted(back.select(frame.columns).collect()) == sorted(frame.collect())
    pruned = back.where("jalali_year = 1402")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(jalali_year" in pruned
    sinks.write_csv(frame, f"{path}/c")
    files = [f for f in (tmp_path / "c").iterdir() if f.suffix == ".csv" and f.stat().st_size]
    assert files and all(f.read_bytes().startswith(b"\xef\xbb\xbftracing_no") for f in files)
    back = readers.read_csv(spark, f"{path}/c").orderBy("tracing_no").collect()
    assert [r["symbol"] for r in back] == ["الف", "ب, \"پ\""]
    sinks.write_json(frame, f"{path}/j")
    text = "".join(f.read_text() for f in (tmp_path / "j").glob("*.json"))
    assert "الف" in text and '"at":"2024-01-01 00:00:00"' in text and '"url":null' in text


def test_append_and_report(spark, tmp_path, frame):
    path = str(tmp_path)
    for _ in range(2):
        sinks.append_rows(frame, f"{path}/rows")
        sinks.append_rows(frame, f"{path}/csv", "csv")
        sinks.export_errors(frame.select("url"), f"{path}/errors")
    assert spark.read.parquet(f"{path}/rows").count() == 4
    assert readers.read_csv(spark, f"{path}/csv").count() == 4
    assert spark.read.json(f"{path}/errors").count() == 4
    sinks.write_report({"data": frame, "summary": frame.limit(1)}, f"{path}/report", "csv")
    assert readers.read_csv(spark, f"{path}/report/summary").count() == 1
    letters = frame.select("tracing_no", "symbol", "url")
    sinks.write_letter_urls(letters, f"{path}/urls", base_url="https://b")
    urls = readers.read_csv(spark, f"{path}/urls")
    assert urls.columns == "url symbol company_name tracing_no letter_code sent_date publish_date".split()
    assert urls.count() == 2


CASES = [
    ("not_none", {}, "a", True), ("not_none", {}, None, False), ("not_empty", {}, " \t", False),
    ("integer_string", {}, "12", True), ("integer_string", {}, "1 2", False), ("date", {}, "1402/12/30", False),
    ("date", {}, "1403/12/30", True), ("symbol", {}, " فولاد1 ", True), ("symbol", {}, "a b", False),
    ("isic", {}, "1234", True), ("isic", {}, "123", False), ("isic", {}, "1234567", False),
    ("letter_code", {}, "ن-45", True), ("letter_code", {}, "45", False), ("url", {}, "https://x y", True),
    ("url", {}, "ftp://x", False), ("list", {"valid_values": ["a", None]}, None, True),
    ("list", {"valid_values": ["a"]}, None, False), ("pattern", {"pattern": "a|b"}, "bz", True),
    ("pattern", {"pattern": "a"}, "ba", False), ("min_length", {"min_length": 3}, "ab", False),
    ("max_length", {"max_length": 3}, "abcd", False), ("max_length", {"max_length": 3}, None, False),
    ("range", {"min_val": 0}, "5", False), ("boolean", {}, "true", False), ("string", {}, "x", True),
]


@pytest.mark.parametrize(("kind", "options", "value", "ok"), CASES)
def test_rules(spark, kind, options, value, ok):
    df = spark.createDataFrame([(value,)], "c string")
    broken = quality.validate(df, [quality.rule(kind, "c", **options)]).first()["violations"]
    assert broken == ([] if ok else [f"c:{kind}"])


def test_typed_rules(spark):
    df = spark.createDataFrame([(True, 5, float("nan"), [1], None)], "b boolean, i int, d double, l array<int>, n int")
    rules = [quality.rule("boolean", "b"), quality.rule("integer", "b"), quality.rule("integer", "i"),
             quality.rule("range", "i", min_val=5, max_val=5), quality.rule("range", "d"),
             quality.rule("min_length", "l", min_length=1), quality.rule("max_length", "l", max_length=0),
             quality.rule("not_empty", "l"), quality.rule("min_length", "i"), quality.rule("integer", "n"),
             quality.rule("not_none", "gone")]
    assert quality.validate(df, rules).first()["violations"] == [
        "b:integer", "d:range", "l:max_length", "i:min_length", "n:integer", "gone:not_none",
    ]
    report = {(r["column"], r["rule"]): r["failed"] for r in quality.validation_report(df, rules).collect()}
    assert report["d", "range"] == 1 and report["i", "integer"] == 0
    with pytest.raises(ValueError, match="unknown"):
        quality.rule("nonsense", "b")


def test_date_ranges_compare_days(spark):
    rows = [("1402/2/1", "1402/10/1"), ("1402/10/01", "1402/2/1"), ("1402/13/1", "1402/2/1"), (None, "1402/2/1")]
    df = spark.createDataFrame(rows, "a string, b string")
    clean, broken = quality.split_valid(df, [quality.date_range_rule("a", "b")])
    assert [r["a"] for r in clean.collect()] == ["1402/2/1"] and broken.count() == 3


def test_summaries(spark):
    errors = spark.createDataFrame(
        [("u1", "timeout", True), ("u2", "timeout", False), ("u3", "network", True)],
        "url string, error_type string, recoverable boolean",
    )
    rows = {r["error_type"]: (r["errors"], r["recoverable"]) for r in agg.error_summary(errors).collect()}
    assert rows == {"timeout": (2, 1), "network": (1, 1), "total": (3, 2)}
    none = {r["error_type"]: r["errors"] for r in agg.error_summary(errors.where("false")).collect()}
    assert none == {"total": 0}


def test_tables_written_once_are_dropped_when_replaced(spark):
    from pathlib import Path

    from filingframe.session import drop, materialise

    def folder(df):
        return Path(df.inputFiles()[0].removeprefix("file://")).parent

    first = materialise(spark.range(5), "numbers")
    old = folder(first)
    second = materialise(first.selectExpr("id + 1 as id"), "numbers", replaces=first)
    assert not old.exists() and second.agg({"id": "sum"}).first()[0] == 15
    drop(second.where("id > 1"))  # not a table of its own
    assert folder(second).exists()
    drop(second)
    drop(second)
