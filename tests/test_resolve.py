"""Candidates, corrections, instruments and the forward as-of join."""

from __future__ import annotations

import pytest

from filingframe.operators import resolve

INSTRUMENTS = [("الف", "1", "10 ", "sector ten", 1000), ("ب", "2", " ", None, 2000), ("پ", "3", None, None, 3000)]
ALIASES = [("مستعار", "2"), ("الف", "3")]
CORRECTIONS = [("غلط", "پ", 1), ("غلط", "ب", 2), (" غلط  دو ", "الف", 3), (None, "x", 4), ("y", None, 5)]
# 1402/05/24 is 2023-08-15
HOLDERS = [("1", 20230815, "h1", 10.0, "i1"), ("1", 20230815, "h2", 20.0, "i2"), ("1", 20230816, "late", 1.0, "i"),
           ("2", 20230817, "h3", 30.0, "i3"), ("3", 20230818, "too late", 1.0, "i")]
PRICES = [("1", 20230815, 0.0, 55.0), ("1", 20230816, 9.0, 9.0)]


@pytest.fixture(scope="module")
def enriched(spark):
    board = [
        ("a - نماد: الف", "1402/05/24"),
        ("a - نماد: الف", "1402/05/24"),
        ("b - نماد: ناشناس(مستعار)", "۱۴۰۲-۰۵-۲۴"),
        ("c - نماد: پ(نیست)", "14020524"),
        ("d - نماد: هیچ", "1402/05/24"),
        ("e - نماد: الف", "1402/13/01"),
        ("f no symbol", "1402/05/24"),
        ("g - نماد: غلط(پ)", "1402/05/24"),
        ("h - نماد: الف", None),
        ("i - نماد: ب(الف)", "1402/05/26"),
        ("j - نماد: غلط دو(هیچ)", "1402/05/23"),
    ]
    raw = spark.createDataFrame(CORRECTIONS, "symbol string, symbol_true string, line int")
    return resolve.enrich(
        spark.createDataFrame(board, "company string, assembly_date string").repartition(3),
        resolve.correction_table(raw, "line"),
        spark.createDataFrame(INSTRUMENTS, "symbol string, ins_code string, isic_code string, sector_name string, z_titad long"),
        spark.createDataFrame(ALIASES, "alias string, ins_code string"),
        spark.createDataFrame(HOLDERS, "ins_code string, d_even int, shareHolderName string, perOfShares double, shareHolderShareID string"),
        spark.createDataFrame(PRICES, "ins_code string, d_even int, pClosing double, pc double"),
    )


def test_shareholders(enriched):
    rows = [
        (r["company"][0], r["symbol"], r["effective_dEven"], r["insCode"], r["pClosing"], r["shareHolderName"])
        for r in enriched.shareholders().orderBy("company", "shareHolderName").collect()
    ]
    assert rows == [
        ("a", "الف", 20230815, "1", 55.0, "h1"),
        ("a", "الف", 20230815, "1", 55.0, "h2"),
        ("b", "مستعار", 20230817, "2", None, "h3"),
        # resolved, but no holders in the window: metadata only
        ("c", "پ", None, "3", None, None),
        # never resolved: the first candidate
        ("d", "هیچ", None, None, None, None),
        # unreadable date: nothing at all
        ("e", None, None, None, None, None),
        # first candidate has nothing in the window, the corrected second one wins
        ("g", "ب", 20230817, "2", None, "h3"),
        ("i", "ب", 20230817, "2", None, "h3"),
        ("j", "الف", 20230815, "1", 55.0, "h1"),
        ("j", "الف", 20230815, "1", 55.0, "h2"),
    ]
    codes = {r["insCode"]: r["isic_code"] for r in enriched.shareholders().collect()}
    assert codes["1"] == "10" and codes["2"] is None


def test_reports(enriched):
    no_data = {r["company"][0]: (r["symbols_tried"], r["reason"]) for r in enriched.no_data().collect()}
    assert no_data == {
        "c": ("نیست|پ", "no_holders_for_any_candidate"),
        "d": ("هیچ", "no_holders_for_any_candidate"),
        "e": ("الف", "invalid_jalali_date"),
    }
    # "ناشناس" stands after the winner and was never tried
    unresolved = {r["symbol"]: r["pair_count"] for r in enriched.unresolved().collect()}
    assert unresolved == {"نیست": 1, "هیچ": 2}


def test_corrections(spark):
    raw = spark.createDataFrame(CORRECTIONS, "symbol string, symbol_true string, line int")
    table = resolve.correction_table(raw, "line")
    assert {r["key"]: r["fixed"] for r in table.collect()} == {"غلط": "ب", "غلط دو": "الف"}
    df = spark.createDataFrame(
        [(1, ["غلط", "ب", "x", " ", "x "]), (2, ["z"]), (3, [""])], "id int, candidates array<string>"
    )
    got = {r["id"]: r["candidates"] for r in resolve.correct_candidates(df, table).collect()}
    assert got == {1: ["ب", "x"], 2: ["z"]}


def test_days_are_looked_up_once_for_all_targets(spark):
    # many assemblies name the same instrument on the same day
    targets = spark.range(500).selectExpr(
        "concat('c', id) as company", "'x' as assembly_date",
        "if(id % 50 = 0, null, cast(id % 2 as string)) as ins_code", "if(id % 70 = 1, null, date'2023-08-15') as day",
    )
    days = spark.createDataFrame([("0", 20230816), ("0", 20230817), ("1", 20230818), (None, 20230815)], "ins_code string, d_even int")
    found = resolve.first_days(targets, days)
    hits = {r["company"]: r["hit"] for r in found.collect()}
    assert len(hits) == found.count() == 500
    for n in range(500):
        assert hits[f"c{n}"] == (20230816 if n % 2 == 0 and n % 50 and n % 70 != 1 else None)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    (at,) = (n for n, line in enumerate(lines) if "Generate explode" in line and "_offset" in line)
    # below it lie the distinct instruments and days alone
    assert "Aggregate [ins_code" in lines[at + 1] and "company" not in lines[at + 1]


def test_candidates_are_found_once(spark):
    board = spark.createDataFrame([("a - نماد: الف(ب)", "1402/05/24"), ("f", "1402/05/24")], "company string, assembly_date string")
    none = spark.createDataFrame([], "key string, fixed string")
    pairs = resolve.assembly_pairs(board, none)
    assert [r["candidates"] for r in pairs.collect()] == [["ب", "الف"]]
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_distinct") == 1
