from __future__ import annotations

import pandas as pd
import pytest
from pyspark.sql import functions as F

from filingframe.operators import aggregates as agg
from filingframe.operators import frame, profile
from filingframe.operators.quantiles import exact_quantiles


@pytest.fixture(scope="module")
def letters(spark):
    rows = [
        ("1", "فولاد", "ن-45", "1402/01/05 10:00:00", "a"),
        ("2", "فولاد", "ن-30", "1402/02/05 10:00:00", "b"),
        ("3", "خودرو", "ن-45", "1402/03/05 10:00:00", None),
        ("4", "خودرو", "x", None, "d"),
        ("5", None, "ن-45", "1403/03/05 10:00:00", "e"),
    ]
    return spark.createDataFrame(
        rows, "tracing_no string, symbol string, letter_code string, publish_date_time string, title string"
    )


def ids(df):
    return [r["tracing_no"] for r in df.collect()]


def test_missing_columns_are_ignored(letters):
    assert frame.select_columns(letters, ["title", "nope", "symbol"]).columns == ["title", "symbol"]
    assert frame.select_columns(letters, ["nope"]).columns == letters.columns
    assert frame.drop_columns(letters, ["nope", "title"]).columns == letters.columns[:-1]
    assert "t" in frame.rename_columns(letters, {"title": "t", "nope": "n"}).columns
    assert frame.apply_to_column(letters, "nope", F.upper) is letters
    assert frame.filter_by_symbols(letters.drop("symbol"), "a").count() == 5


def test_date_range_drops_nulls_and_compares_text(letters):
    assert sorted(ids(frame.filter_by_date_range(letters, "1402/02/01"))) == ["2", "3", "5"]
    assert sorted(ids(frame.filter_by_date_range(letters, end="1402/02/05"))) == ["1"]
    whole = frame.filter_by_date_range(letters, end="1402/02/05", end_of_day=True)
    assert sorted(ids(whole)) == ["1", "2"]


def test_fill_na(letters):
    assert frame.fill_na(letters).where("title = ''").count() == 1
    typed = letters.select(F.lit(None).cast("int").alias("n"), "title")
    assert frame.fill_na(typed, "-", ["n"]).where("n = '-'").count() == 5
    assert frame.fill_na(typed, 0).where("n = 0").count() == 5


def test_sort_puts_nulls_last_both_ways(letters):
    for up in (True, False):
        assert ids(frame.sort_by(letters, ["symbol", "tracing_no"], [up, True]))[-1] == "5"


def test_drop_duplicates_does_not_depend_on_partitioning(spark):
    rows = [(k, i, f"v{i}") for i in range(200) for k in ("hot", f"k{i % 7}", None)]
    df = spark.createDataFrame(rows, "k string, i int, v string")
    expected = None
    for parts in (1, 3, 8):
        shuffled = df.orderBy(F.rand(parts)).repartition(parts)
        last = {r["k"]: r["v"] for r in frame.drop_duplicates(shuffled, "k", "last", "i").collect()}
        first = {r["k"]: r["v"] for r in frame.drop_duplicates(shuffled, "k", "first", "i").collect()}
        assert last["hot"] == "v199" and first["hot"] == "v0" and first[None] == "v0"
        assert expected in (None, (last, first))
        expected = (last, first)
    assert frame.drop_duplicates(df, "k", False).count() == 0
    assert frame.drop_duplicates(df, ["k", "i"], False).count() == 600
    assert frame.drop_duplicates(df, "k", "any").count() == 9
    with pytest.raises(ValueError, match="order"):
        frame.drop_duplicates(df, "k", "last")


def test_dedupe_limits_rows_before_the_exchange(letters):
    plan = frame.drop_duplicates(letters, "symbol", "last", "publish_date_time")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_row_numbers(spark, parts):
    df = spark.range(0, 1000, 1, 5).select((F.col("id") * 7 % 1000).alias("v"))
    rows = frame.row_numbers(df, "v", "n", partitions=parts).collect()
    assert sorted((r["v"], r["n"]) for r in rows) == [(i, i + 1) for i in range(1000)]
    batches = frame.assign_batches(df, 300, "v").groupBy("batch").count().collect()
    assert {r["batch"]: r["count"] for r in batches} == {0: 300, 1: 300, 2: 300, 3: 100}


def test_row_numbers_of_nothing(spark):
    assert frame.row_numbers(spark.range(0).toDF("v"), "v").count() == 0


def test_anti_join_trims_and_drops_nulls(spark):
    rows = spark.createDataFrame([(" a ",), ("b",), (None,)], "url string")
    done = spark.createDataFrame([("a",), (None,)], "url string")
    assert [r["url"] for r in frame.anti_join(rows, done).collect()] == ["b"]


def test_pages(spark):
    df = spark.range(25).toDF("k")
    assert [r["k"] for r in frame.page_of(df, "k", 3).collect()] == list(range(20, 25))
    assert [r["k"] for r in frame.page_after(df, "k", 4, 3).collect()] == [5, 6, 7]
    row = frame.pagination(df, page=3).first().asDict()
    assert row == {"current_page": 3, "total_pages": 3, "total_results": 25, "has_next": False,
                   "has_previous": True}


def test_sample(spark):
    df = spark.range(50)
    assert frame.sample_rows(df, 10, 1).distinct().count() == 10
    assert frame.sample_rows(df, 100).count() == 50


def test_observed_counts_without_extra_job(letters):
    kept, watch = frame.observed(letters.where("letter_code = 'ن-45'"), "board changes")
    assert kept.count() == 3
    assert watch.get["rows"] == 3


def test_symbol_year(letters):
    rows = {(r["symbol"], r["year"]): r for r in agg.symbol_year(letters).collect()}
    assert set(rows) == {("فولاد", "1402"), ("خودرو", "1402"), ("خودرو", None)}
    assert rows["فولاد", "1402"]["announcement_count"] == 2
    assert rows["فولاد", "1402"]["letter_code"] == ["ن-45", "ن-30"]


def test_group_by(letters):
    out = agg.group_by(letters, ["symbol", "nope"], {"title": "count", "tracing_no": "last", "x": "sum"},
                       order="tracing_no")
    rows = {r["symbol"]: (r["title"], r["tracing_no"]) for r in out.collect()}
    assert rows == {"فولاد": (2, "2"), "خودرو": (1, "4")}
    assert agg.group_by(letters, "nope", {"title": "count"}) is letters
    with pytest.raises(ValueError, match="unknown"):
        agg.group_by(letters, "symbol", {"title": "frobnicate"})


@pytest.mark.parametrize("parts", [1, 6])
def test_exact_quantiles_equal_numpy(spark, parts):
    import numpy as np

    rng = np.random.default_rng(5)
    groups = {
        "uniform": rng.random(6001).tolist(),
        "ties": rng.integers(0, 4, 5000).astype(float).tolist(),
        "heavy": [*np.exp(rng.normal(0, 4, 4000)).tolist(), *[1.0] * 2000],
        "one": [3.5],
        "two": [1.0, 2.0],
    }
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("one", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(parts)
    probabilities = [0.0, 0.25, 0.5, 0.9, 1.0]
    for r in exact_quantiles(df, ["g"], "v", probabilities).collect():
        wanted = np.quantile(groups[r["g"]], probabilities)
        assert [r[f"q{i}"] for i in range(5)] == pytest.approx(wanted.tolist(), rel=1e-12)
    whole = exact_quantiles(df.withColumn("g", F.lit("all")), ["g"], "v", [0.5]).first()["q0"]
    assert whole == pytest.approx(np.median([v for vs in groups.values() for v in vs]))
    # in any order, beside other aggregates, with a group that has no number
    more = df.unionByName(spark.createDataFrame([("none", None), ("none", float("nan"))], df.schema))
    counts = [F.count(F.lit(1)).alias("rows")]
    for few in (False, True):
        got = {r["g"]: r for r in exact_quantiles(more, ["g"], "v", [0.9, 0.1, 0.5], few, also=counts).collect()}
        assert got["none"]["rows"] == 2 and got["none"]["q0"] is None
        for g, vs in groups.items():
            assert got[g]["rows"] == len(vs) + (g == "one")
            assert [got[g][f"q{i}"] for i in range(3)] == pytest.approx(np.quantile(vs, [0.9, 0.1, 0.5]).tolist(), rel=1e-12)


def test_profile(letters):
    stats = {(r["metric"], r["key"]): r["value"] for r in profile.summary_stats(letters).collect()}
    assert stats["total_records", ""] == "5"
    assert stats["unique_symbols", ""] == "2"
    assert stats["letter_code_distribution", "ن-45"] == "3"
    assert stats["columns_with_na", "title"] == "1"
    assert ("columns_with_na", "tracing_no") not in stats
    nested = letters.select(F.array("symbol").alias("list"), "title")
    info = {r["column"]: r for r in profile.column_info(nested).collect()}
    assert info["list"]["unique_count"] == 3
    assert info["title"]["null_count"] == 1


def test_download_manifest(spark):
    rows = [("1", "a/b", "1402/01/02 10:00:00", "/x.xls"), ("2", None, "1402/01/01", "http://y"),
            ("3", "c", None, None), ("4", "d", "1402/01/03", "")]
    df = spark.createDataFrame(rows, "tracing_no string, symbol string, publish_date_time string, excel_url string")
    found = [tuple(r)[1:] for r in frame.download_manifest(df, base_url="https://b").orderBy("n").collect()]
    assert found == [
        ("2", "http://y", "Unknown_1402-01-01_1.xls"),
        ("1", "https://b/x.xls", "a_b_1402-01-02_2.xls"),
    ]
    assert frame.download_manifest(df, max_files=1).count() == 1


def test_sample_does_not_depend_on_partitioning(spark):
    df = spark.range(200).withColumn("x", F.col("id") % 7)
    first = sorted(r["id"] for r in frame.sample_rows(df, 20, 3).collect())
    assert first == sorted(r["id"] for r in frame.sample_rows(df.repartition(9, "x"), 20, 3).collect())
    assert first != sorted(r["id"] for r in frame.sample_rows(df, 20, 4).collect())
    assert frame.sample_rows(df, 500).count() == 200


def test_steps_note_rows_before_and_after(spark):
    steps = frame.Steps(spark.range(10).withColumn("x", F.col("id") % 3))
    steps.then(frame.filter_by_condition, F.col("id") > 3).then(frame.drop_duplicates, ["x"], "any")
    assert steps.df.count() == 3
    assert steps.log() == ["filter_by_condition: 10 -> 6", "drop_duplicates: 6 -> 3"]


def test_paged_collection(spark):
    rows = [("a", 1, True), ("a", 2, False), ("a", 3, True), ("b", 1, False), ("b", 2, True), ("c", 2, True)]
    pages = spark.createDataFrame(rows, "q string, page int, ok boolean")
    kept = frame.collect_pages(pages, "q")
    assert sorted(tuple(r) for r in kept.collect()) == [("a", 1), ("a", 3)]
    outcomes = {r["q"]: (r["started"], r["failed"], r["collected"]) for r in frame.page_outcomes(pages, "q").collect()}
    assert outcomes == {"a": (True, 1, 2), "b": (False, 1, 0), "c": (False, 0, 0)}


def test_quantiles_of_infinite_values(spark):
    inf = float("inf")
    df = spark.createDataFrame([("a", inf), ("a", inf), ("a", 1.0), ("b", -inf), ("b", 2.0), ("b", 4.0)], "g string, v double")
    rows = {r["g"]: (r["q0"], r["q1"]) for r in exact_quantiles(df, ["g"], "v", [0.5, 1.0], few_groups=True).collect()}
    assert rows == {"a": (inf, inf), "b": (2.0, 4.0)}


def test_column_info_of_no_rows_and_estimates(spark):
    df = spark.range(300).select("id", (F.col("id") % 10).cast("string").alias("s"), F.lit(None).cast("int").alias("n"))
    exact = {r["column"]: tuple(r) for r in profile.column_info(df).collect()}
    assert exact["s"] == ("s", "string", 300, 0, 10, "0") and exact["n"] == ("n", "int", 0, 300, 0, "")
    about = {r["column"]: r["unique_count"] for r in profile.column_info(df, approximate=True).collect()}
    assert about["s"] == 10 and about["n"] == 0 and abs(about["id"] - 300) < 30
    none = profile.column_info(df.where("false"), sample=False).collect()
    assert [tuple(r) for r in none] == [("id", "bigint", 0, 0, 0), ("s", "string", 0, 0, 0), ("n", "int", 0, 0, 0)]


def test_group_functions_take_many_groups_a_batch_and_many_batches_a_group(spark):
    """Each group whole and in order, whatever the batches; groups of few rows are not sent to Python one by one."""
    rows = [(i % 5 if i % 3 else 9, (i * 7919) % 101, None if i % 11 == 0 else i % 13) for i in range(400)]
    df = spark.createDataFrame(rows, "k int, o int, v int")
    seen = agg.GroupFunction(lambda values: f"{values.dtype.kind}:{values.name}:" + ",".join(map(str, values.tolist())), "string", order=("o",))
    want = {}
    for k in sorted({r[0] for r in rows}):
        part = pd.DataFrame([r for r in rows if r[0] == k], columns=["k", "o", "v"]).sort_values(["o", "v"])
        values = part["v"]
        want[k] = f"{values.dtype.kind}:v:" + ",".join(map(str, values.tolist()))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        out = agg.group_by(df, "k", {"v": seen})
        assert {r.k: r.v for r in out.collect()} == want
        assert "FlatMapGroupsInPandas" not in out._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
