"""Queries over letters: projections, filters, order, duplicates, search, flows."""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from filingframe.functions.calendar import datetime_to_num
from filingframe.functions.text import norm_text
from filingframe.operators import aggregates as agg
from filingframe.operators import frame, pages, profile, search, sketches
from filingframe.plans.catalog import query
from filingframe.plans.views import BASE, Tables, letters, with_views
from filingframe.session import materialise, shared_dir

CORE = ["tracing_no", "symbol", "letter_code", "publish_date_time"]
CORE_SQL = "tracing_no, symbol, letter_code, publish_date_time"

# ------------------------------------------------------------------- flagship


@query(
    "symbol_year",
    with_views(
        "letters",
        """, coded AS (
 SELECT symbol, substr(publish_date_time, 1, 4) AS year, letter_code,
  count(*) AS n, min(publish_date_time || '~' || tracing_no) AS seen,
  min(publish_date_time || '~' || lpad(tracing_no, 20, ' ') || '~' || company_name) AS named
 FROM letters GROUP BY ALL)
SELECT symbol, year, CAST(sum(n) AS BIGINT) AS announcement_count,
 arg_min(split_part(named, '~', 3), seen) AS company_name,
 string_agg(letter_code, ',' ORDER BY seen) AS letter_codes
FROM coded GROUP BY ALL""",
    ),
)
def symbol_year(spark, path):
    return agg.symbol_year(letters(spark, path)).select(
        "symbol",
        "year",
        "announcement_count",
        "company_name",
        F.array_join("letter_code", ",").alias("letter_codes"),
    )


# ---------------------------------------------------------------- projections


@query("select_columns", with_views("letters", f"SELECT {CORE_SQL} FROM letters"))
def select_columns(spark, path):
    return letters(spark, path).transform(frame.select_columns, [*CORE, "no_such_column"])


@query(
    "drop_columns",
    with_views(
        "letters",
        "SELECT tracing_no, symbol, company_name, title, letter_code, publish_date_time"
        " FROM letters",
    ),
)
def drop_columns(spark, path):
    gone = (
        "sent_date_time url excel_url has_excel audited consolidated is_child is_publisher "
        "company_type period_length isic amount missing"
    ).split()
    return letters(spark, path).transform(frame.drop_columns, gone)


@query(
    "rename_columns",
    with_views("letters", "SELECT tracing_no AS serial, symbol AS ticker FROM letters"),
)
def rename_columns(spark, path):
    df = letters(spark, path).select("tracing_no", "symbol")
    return df.transform(
        frame.rename_columns, {"tracing_no": "serial", "symbol": "ticker", "nothing": "x"}
    )


@query(
    "add_column",
    with_views(
        "letters",
        "SELECT tracing_no, 'landed' AS origin, symbol || '/' || letter_code AS topic FROM letters",
    ),
)
def add_column(spark, path):
    df = frame.add_column(letters(spark, path), "origin", "landed")
    df = frame.add_column(df, "topic", lambda d: F.concat_ws("/", d["symbol"], d["letter_code"]))
    return df.select("tracing_no", "origin", "topic")


@query(
    "apply_to_column",
    with_views(
        "letters",
        "SELECT tracing_no, lower(symbol) AS symbol, length(title) AS title_length FROM letters",
    ),
)
def apply_to_column(spark, path):
    df = letters(spark, path)
    df = frame.apply_to_column(df, "symbol", F.lower)
    df = frame.apply_to_column(df, "title", F.length, "title_length")
    df = frame.apply_to_column(df, "no_such_column", F.upper)
    return df.select(
        "tracing_no", "symbol", F.col("title_length").cast("bigint").alias("title_length")
    )


def raised(amount: pd.Series) -> pd.Series:
    return amount * 1.25


@query(
    "apply_pandas_function",
    with_views("letters", "SELECT tracing_no, round(amount * 1.25, 4) AS amount FROM letters"),
)
def apply_pandas_function(spark, path):
    df = frame.apply_to_column(letters(spark, path), "amount", F.pandas_udf(raised, "double"))
    return df.select("tracing_no", F.round("amount", 4).alias("amount"))


@query(
    "fill_na",
    with_views(
        "letters",
        "SELECT tracing_no, coalesce(url, '-') AS url, coalesce(excel_url, '') AS excel_url"
        " FROM letters",
    ),
)
def fill_na(spark, path):
    df = letters(spark, path).select("tracing_no", "url", "excel_url")
    return df.transform(frame.fill_na, "-", ["url"]).transform(frame.fill_na)


@query(
    "letter_descriptions",
    with_views(
        "letters letter_codes",
        "SELECT tracing_no, letter_code, letter_description"
        " FROM letters LEFT JOIN letter_codes USING (letter_code)",
    ),
)
def letter_descriptions(spark, path):
    df = letters(spark, path).select("tracing_no", "letter_code")
    return df.transform(frame.add_letter_descriptions)


@query(
    "letter_code_of_description",
    with_views(
        "letters letter_codes",
        "SELECT tracing_no, letter_description, c.letter_code FROM (SELECT tracing_no,"
        " letter_description FROM letters LEFT JOIN letter_codes USING (letter_code)) x"
        " LEFT JOIN letter_codes c USING (letter_description)",
    ),
)
def letter_code_of_description(spark, path):
    df = letters(spark, path).select("tracing_no", "letter_code")
    df = df.transform(frame.add_letter_descriptions).drop("letter_code")
    return df.transform(frame.add_letter_codes)


@query(
    "company_type_codes",
    with_views(
        "letters",
        """SELECT tracing_no, alias, CASE alias WHEN 'bourse' THEN '1' WHEN 'farabourse' THEN '2'
 WHEN 'otc' THEN '3' END AS company_type FROM (SELECT tracing_no,
 CASE company_type WHEN 1 THEN 'bourse' WHEN 2 THEN 'farabourse' ELSE 'unlisted' END AS alias
 FROM letters)""",
    ),
)
def company_type_codes(spark, path):
    kind = F.col("company_type")
    alias = F.when(kind == 1, "bourse").when(kind == 2, "farabourse").otherwise("unlisted")
    df = letters(spark, path).select("tracing_no", alias.alias("alias"))
    return df.transform(frame.add_company_type, "alias")


LETTER_URLS_SQL = f"""SELECT CASE WHEN coalesce(url, '') = '' THEN
  '{BASE}/Reports/Decision.aspx?LetterSerial=' || tracing_no
 WHEN url LIKE 'http%' THEN url ELSE '{BASE}' || url END AS url,
 symbol, company_name, tracing_no, letter_code, sent_date_time AS sent_date,
 publish_date_time AS publish_date FROM letters"""


@query("letter_urls", with_views("letters", LETTER_URLS_SQL))
def letter_urls(spark, path):
    return letters(spark, path).transform(frame.letter_urls)


@query(
    "ingest_letters",
    with_views(
        "letters",
        """SELECT tracing_no, trim(symbol) AS symbol, company_name, title,
 coalesce(url, '') AS description FROM letters""",
    ),
)
def ingest_letters(spark, path):
    from filingframe.sources.readers import normalise

    df = letters(spark, path).select(
        F.col("tracing_no").alias("TracingNo"),
        F.concat(F.lit("  "), F.col("symbol")).alias("Symbol"),
        F.col("company_name").alias("CompanyName"),
        F.col("title").alias("Title"),
        F.col("url").alias("Description"),
    )
    return normalise(df)


# -------------------------------------------------------------------- filters


@query(
    "filter_letter_code",
    with_views("letters", f"SELECT {CORE_SQL} FROM letters WHERE letter_code IN ('ن-45','ن-30')"),
)
def filter_letter_code(spark, path):
    return letters(spark, path).transform(frame.filter_by_letter_code, ["ن-45", "ن-30"]).select(CORE)


@query(
    "filter_date_range",
    with_views(
        "letters",
        f"SELECT {CORE_SQL} FROM letters"
        " WHERE publish_date_time >= '1375/01/01' AND publish_date_time <= '1376/06/31'",
    ),
)
def filter_date_range(spark, path):
    df = letters(spark, path)
    return df.transform(frame.filter_by_date_range, "1375/01/01", "1376/06/31").select(CORE)


@query(
    "filter_date_range_whole_days",
    with_views(
        "letters",
        f"SELECT {CORE_SQL} FROM letters"
        " WHERE substr(publish_date_time, 1, 10) BETWEEN '1375/01/01' AND '1375/02/10'",
    ),
)
def filter_date_range_whole_days(spark, path):
    df = letters(spark, path)
    return df.transform(
        frame.filter_by_date_range, "1375/01/01", "1375/02/10", end_of_day=True
    ).select(CORE)


@query(
    "filter_symbols",
    with_views(
        "letters", f"SELECT {CORE_SQL} FROM letters WHERE symbol IN ('NATION_3', 'NATION_7')"
    ),
)
def filter_symbols(spark, path):
    df = letters(spark, path)
    return df.transform(frame.filter_by_symbols, [" NATION_3", "NATION_7  ", "none"]).select(CORE)


@query(
    "filter_symbols_in_table",
    with_views(
        "letters",
        f"SELECT {CORE_SQL} FROM letters WHERE symbol IN"
        " (SELECT n_name FROM nation JOIN region ON n_regionkey = r_regionkey"
        "  WHERE r_name = 'ASIA')",
    ),
)
def filter_symbols_in_table(spark, path):
    t = Tables(spark, path)
    asia = t.nation.join(t.region.where("r_name = 'ASIA'"), F.expr("n_regionkey = r_regionkey"))
    wanted = asia.select(F.concat(F.lit(" "), "n_name").alias("symbol"))
    return letters(spark, path).transform(frame.filter_by_symbols, wanted).select(CORE)


@query(
    "filter_condition",
    with_views(
        "letters", f"SELECT {CORE_SQL} FROM letters WHERE amount > 200000 AND has_excel"
    ),
)
def filter_condition(spark, path):
    df = letters(spark, path)
    return df.transform(
        frame.filter_by_condition, lambda d: (d["amount"] > 200000) & d["has_excel"]
    ).select(CORE)


@query(
    "search_all_criteria",
    with_views(
        "letters",
        f"""SELECT {CORE_SQL} FROM letters WHERE symbol = 'NATION_4' AND company_type = 2
 AND isic = '0004' AND title LIKE '%BUILDING%' AND letter_code = 'ن-45' AND period_length = 6
 AND audited AND NOT consolidated AND NOT is_child AND NOT is_publisher
 AND substr(publish_date_time, 1, 10) BETWEEN '1374/01/01' AND '1380/12/29'
 UNION ALL SELECT {CORE_SQL} FROM letters WHERE tracing_no = '77'
 UNION ALL SELECT {CORE_SQL} FROM letters WHERE is_publisher AND is_child AND NOT audited""",
    ),
)
def search_all_criteria(spark, path):
    df = letters(spark, path)
    first = search.search_letters(
        df.where("not is_publisher"),
        symbol=" nation_4 ",
        company_type="farabourse",
        isic="0004",
        subject="BUILDING",
        letter_code="ن-45",
        period_length="۶",
        not_audited=False,
        consolidated=False,
        childs=False,
        from_date="1374/01/01",
        to_date="1380/12/29",
    )
    second = search.search_letters(df, tracing_no="77")
    third = search.search_letters(df, publisher_only=True, mains=False, audited=False)
    return frame.union_letters(first, second, third).select(CORE)


@query(
    "search_board_changes",
    with_views(
        "letters",
        f"""SELECT {CORE_SQL} FROM letters WHERE letter_code = 'ن-45' AND NOT is_child
 AND substr(publish_date_time, 1, 10) BETWEEN '1375/01/01' AND '1377/12/29'""",
    ),
)
def search_board_changes(spark, path):
    return search.board_changes(letters(spark, path), "1375/01/01", "1377/12/29").select(CORE)


@query(
    "search_financial_statements",
    with_views(
        "letters",
        f"""SELECT {CORE_SQL} FROM letters WHERE letter_code = 'ن-10' AND period_length = 12
 AND audited AND substr(publish_date_time, 1, 10) >= '1375/01/01'""",
    ),
)
def search_financial_statements(spark, path):
    return search.financial_statements(letters(spark, path), "1375/01/01").select(CORE)


@query(
    "search_monthly_reports",
    with_views(
        "letters",
        f"SELECT {CORE_SQL} FROM letters WHERE letter_code = 'ن-30' AND symbol = 'NATION_9'",
    ),
)
def search_monthly_reports(spark, path):
    return search.monthly_reports(letters(spark, path), symbol="nation_9").select(CORE)


@query(
    "search_by_symbol",
    with_views(
        "letters",
        f"""SELECT {CORE_SQL}, 'both' AS mode FROM letters WHERE symbol = 'NATION_1'
 AND substr(publish_date_time, 1, 10) BETWEEN '1376/01/01' AND '1376/12/29'
 UNION ALL SELECT {CORE_SQL}, 'ignored' FROM letters WHERE symbol = 'NATION_1'
 UNION ALL SELECT {CORE_SQL}, 'either' FROM letters WHERE symbol = 'NATION_1'
 AND substr(publish_date_time, 1, 10) >= '1376/01/01'""",
    ),
)
def search_by_symbol(spark, path):
    df = letters(spark, path)
    return frame.tagged_union(
        {
            "both": search.letters_of_symbol(df, "NATION_1", "1376/01/01", "1376/12/29"),
            "ignored": search.letters_of_symbol(df, "NATION_1", "1376/01/01"),
            "either": search.letters_of_symbol(df, "NATION_1", "1376/01/01", both_bounds=False),
        },
        "mode",
    ).select(*CORE, "mode")


@query(
    "valid_urls",
    "SELECT page_id, url FROM pages WHERE starts_with(trim(url), 'http')"
    " UNION ALL SELECT o_orderkey, 'http://x/' || o_orderkey FROM orders WHERE o_orderkey % 4 = 2",
)
def valid_urls(spark, path):
    t = Tables(spark, path)
    key = F.col("o_orderkey")
    mixed = F.when(key % 4 == 2, F.concat(F.lit("http://x/"), key.cast("string"))).when(
        key % 4 == 3, "/relative"
    )
    urls = t.pages.select("page_id", "url").union(t.orders.select(key, mixed))
    return urls.transform(frame.filter_valid_urls)


@query(
    "year_between",
    with_views(
        "letters",
        "SELECT tracing_no, year FROM (SELECT tracing_no, CASE WHEN amount < 100000 THEN 'n/a'"
        " ELSE substr(publish_date_time, 1, 4) END AS year FROM letters)"
        " WHERE TRY_CAST(year AS INTEGER) BETWEEN 1375 AND 1377",
    ),
)
def year_between(spark, path):
    year = F.when(F.col("amount") < 100000, "n/a").otherwise(F.substring("publish_date_time", 1, 4))
    df = letters(spark, path).select("tracing_no", year.alias("year"))
    return df.transform(frame.filter_year_between, 1375, 1377)


# ------------------------------------------------------ order, pages, batches


@query(
    "sort_nulls_last",
    with_views(
        "letters",
        "SELECT tracing_no, excel_url FROM letters"
        " ORDER BY excel_url DESC NULLS LAST, tracing_no ASC NULLS LAST",
    ),
)
def sort_nulls_last(spark, path):
    df = letters(spark, path).select("tracing_no", "excel_url")
    return df.transform(frame.sort_by, ["excel_url", "tracing_no", "nothing"], [False, True, True])


NEWEST = "ORDER BY publish_date_time DESC, tracing_no DESC"
OLDEST = "ORDER BY publish_date_time, tracing_no"
ORDER = ("publish_date_time", "tracing_no")


@query(
    "first_letters", with_views("letters", f"SELECT {CORE_SQL} FROM letters {OLDEST} LIMIT 25")
)
def first_letters(spark, path):
    return letters(spark, path).select(CORE).transform(frame.head, 25, ORDER)


@query("last_letters", with_views("letters", f"SELECT {CORE_SQL} FROM letters {NEWEST} LIMIT 25"))
def last_letters(spark, path):
    return letters(spark, path).select(CORE).transform(frame.tail, 25, ORDER)


@query("sample_letters")
def sample_letters(spark, path):
    return letters(spark, path).select(CORE).transform(frame.sample_rows, 100, 7)


@query(
    "result_page",
    with_views("letters", f"SELECT {CORE_SQL} FROM letters {OLDEST} LIMIT 10 OFFSET 20"),
)
def result_page(spark, path):
    return letters(spark, path).select(CORE).transform(frame.page_of, ORDER, 3)


@query(
    "stored_page",
    with_views(
        "letters",
        f"""SELECT tracing_no, publish_date_time, row_no FROM (SELECT tracing_no, publish_date_time,
 row_number() OVER ({OLDEST}) AS row_no FROM letters) WHERE row_no BETWEEN 976 AND 1050""",
    ),
)
def stored_page(spark, path):
    """A page that crosses a border of the stored ranges."""
    folder = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/pages-{uuid.uuid4().hex}"
    pages.write_ordered(letters(spark, path).select("tracing_no", "publish_date_time"), folder, ORDER, span=1000)
    return pages.read_page(spark, folder, 14, 75)


PROFILED = {
    "o_custkey": "BIGINT", "o_orderpriority": "VARCHAR", "o_orderstatus": "VARCHAR", "o_totalprice": "DOUBLE"
}


@query(
    "united_profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) AS \"rows\", count(*) - count({c}) AS nulls,"
        f" {'CAST(min(' + c + ') AS DOUBLE)' if k != 'VARCHAR' else 'CAST(NULL AS DOUBLE)'} AS least,"
        f" {'CAST(max(' + c + ') AS DOUBLE)' if k != 'VARCHAR' else 'CAST(NULL AS DOUBLE)'} AS most,"
        f" true AS distinct_close, {'true' if k != 'VARCHAR' else 'CAST(NULL AS BOOLEAN)'} AS median_close FROM orders"
        for c, k in PROFILED.items()
    ),
)
def united_profile(spark, path):
    """Profiles of the years of orders, united; estimates are held against exact counts of all rows."""
    orders = Tables(spark, path).orders
    parts = sketches.profile_parts(orders.select(F.year("o_orderdate").alias("part"), *PROFILED), "part")
    # kept as a table, as a load would; the union reads the sketches alone
    found = sketches.estimates(sketches.unite(materialise(parts, "profile-parts")))
    exact = profile.column_info(orders.select(*PROFILED), sample=False)
    # two rows of numbers at most, one for each of the columns
    medians = F.broadcast(found.where("q1 is not null").select("column", "q1"))
    numbers = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c, k in PROFILED.items() if k != "VARCHAR"]
    below = (
        orders.select(F.inline(F.array(*numbers))).join(medians, "column")
        .groupBy("column").agg((F.count_if(F.col("v") <= F.col("q1")) / F.count("v")).alias("share"))
    )
    error = F.abs(F.col("distinct") - F.col("unique_count")) / F.greatest("unique_count", F.lit(1))
    return found.join(exact, "column").join(below, "column", "left").select(
        "column", "rows", "nulls", "least", "most",
        (error <= 0.05).alias("distinct_close"),
        F.col("share").between(0.48, 0.52).alias("median_close"),
    )


@query(
    "result_page_after_key",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey > 1200"
    " ORDER BY o_orderkey LIMIT 10",
)
def result_page_after_key(spark, path):
    orders = Tables(spark, path).orders.select("o_orderkey", "o_totalprice")
    return orders.transform(frame.page_after, "o_orderkey", 1200)


@query(
    "result_pages",
    with_views(
        "letters",
        f"SELECT tracing_no, (row_number() OVER ({OLDEST}) - 1) // 10 + 1 AS page FROM letters",
    ),
)
def result_pages(spark, path):
    return letters(spark, path).select("publish_date_time", "tracing_no").transform(
        frame.paginate, ORDER
    ).select("tracing_no", "page")


@query(
    "pagination",
    with_views(
        "letters",
        """SELECT 3 AS current_page, CAST(ceil(count(*) / 10.0) AS BIGINT) AS total_pages,
 count(*) AS total_results, 3 < ceil(count(*) / 10.0) AS has_next, true AS has_previous
 FROM letters WHERE letter_code = 'ن-45'""",
    ),
)
def pagination(spark, path):
    found = search.search_letters(letters(spark, path), letter_code="ن-45")
    return frame.pagination(found, page=3)


@query(
    "url_batches",
    "SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 800 AS batch FROM orders",
)
def url_batches(spark, path):
    orders = Tables(spark, path).orders.select("o_orderkey")
    return orders.transform(frame.assign_batches, 800, "o_orderkey")


@query(
    "download_manifest",
    with_views(
        "letters",
        f"""SELECT n, tracing_no, '{BASE}' || excel_url AS excel_url, symbol || '_' ||
 replace(substr(publish_date_time, 1, 10), '/', '-') || '_' || n || '.xls' AS filename
 FROM (SELECT *, row_number() OVER (ORDER BY publish_date_time, tracing_no) AS n FROM letters
  WHERE letter_code = 'ن-10' AND period_length = 12 AND audited AND excel_url IS NOT NULL)""",
    ),
)
def download_manifest(spark, path):
    return search.financial_statements(letters(spark, path)).transform(frame.download_manifest)


@query(
    "download_manifest_first_files",
    with_views(
        "letters",
        f"""SELECT n, tracing_no, '{BASE}' || excel_url AS excel_url, symbol || '_' ||
 replace(substr(publish_date_time, 1, 10), '/', '-') || '_' || n || '.xls' AS filename
 FROM (SELECT *, row_number() OVER (ORDER BY publish_date_time, tracing_no) AS n FROM letters
  WHERE letter_code = 'ن-10' AND period_length = 12 AND audited AND excel_url IS NOT NULL)
 WHERE n <= 30""",
    ),
)
def download_manifest_first_files(spark, path):
    found = search.financial_statements(letters(spark, path))
    return found.transform(frame.download_manifest, max_files=30)


# --------------------------------------------------------- duplicates and sets


def _ranked(order: str) -> str:
    return with_views(
        "letters",
        "SELECT symbol, letter_code, tracing_no, publish_date_time FROM (SELECT *, row_number()"
        f" OVER (PARTITION BY symbol, letter_code ORDER BY {order}) AS r FROM letters)"
        " WHERE r = 1",
    )


DEDUPE = ["symbol", "letter_code", "tracing_no", "publish_date_time"]


@query("keep_last_per_key", _ranked("publish_date_time DESC, tracing_no DESC"))
def keep_last_per_key(spark, path):
    df = letters(spark, path).select(DEDUPE)
    return df.transform(
        frame.drop_duplicates, ["symbol", "letter_code"], "last", "publish_date_time"
    )


@query("keep_first_per_key", _ranked("publish_date_time, tracing_no"))
def keep_first_per_key(spark, path):
    df = letters(spark, path).select(DEDUPE)
    return df.transform(
        frame.drop_duplicates, ["symbol", "letter_code"], "first", "publish_date_time"
    )


@query(
    "keep_unrepeated_keys",
    with_views(
        "letters",
        "SELECT company_name, any_value(tracing_no) AS tracing_no, substr(publish_date_time, 1, 7)"
        " AS month FROM letters GROUP BY company_name, month HAVING count(*) = 1",
    ),
)
def keep_unrepeated_keys(spark, path):
    df = letters(spark, path).select(
        "company_name", "tracing_no", F.substring("publish_date_time", 1, 7).alias("month")
    )
    return df.transform(frame.drop_duplicates, ["company_name", "month"], False)


@query(
    "distinct_rows", with_views("letters", "SELECT DISTINCT symbol, letter_code FROM letters")
)
def distinct_rows(spark, path):
    return letters(spark, path).select("symbol", "letter_code").transform(frame.drop_duplicates)


@query(
    "remaining_urls",
    with_views(
        "letters",
        f"SELECT url FROM ({LETTER_URLS_SQL}) WHERE url NOT IN (SELECT u FROM (SELECT '{BASE}/r/'"
        " || l_orderkey AS u FROM lineitem WHERE l_returnflag = 'R'))",
    ),
)
def remaining_urls(spark, path):
    serial = F.col("l_orderkey").cast("string")
    done = (
        Tables(spark, path)
        .lineitem.where("l_returnflag = 'R'")
        .select(F.concat(F.lit(f" {BASE}/r/"), serial, F.lit(" ")).alias("url"))
    )
    return letters(spark, path).transform(frame.letter_urls).transform(frame.anti_join, done).select("url")


@query(
    "union_letter_sets",
    with_views(
        "letters",
        """SELECT tracing_no, symbol, NULL AS letter_code FROM letters WHERE letter_code = 'ن-10'
 UNION ALL SELECT tracing_no, NULL, letter_code FROM letters WHERE letter_code = 'ن-30'""",
    ),
)
def union_letter_sets(spark, path):
    df = letters(spark, path)
    first = df.where(F.col("letter_code") == "ن-10").select("tracing_no", "symbol")
    second = df.where(F.col("letter_code") == "ن-30").select("tracing_no", "letter_code")
    return frame.union_letters(first, second)


@query(
    "tagged_union",
    with_views(
        "letters",
        """SELECT tracing_no, 'interim' AS topic FROM letters WHERE letter_code = 'ن-10'
 UNION ALL SELECT tracing_no, 'monthly' FROM letters WHERE letter_code = 'ن-30'""",
    ),
)
def tagged_union(spark, path):
    df = letters(spark, path).select("tracing_no", "letter_code")
    parts = {"interim": "ن-10", "monthly": "ن-30"}
    sets = {k: frame.filter_by_letter_code(df, v).select("tracing_no") for k, v in parts.items()}
    return frame.tagged_union(sets, "topic")


# ---------------------------------------------------------------- aggregations


@query(
    "group_by_functions",
    with_views(
        "letters",
        """SELECT symbol, letter_code, round(sum(amount), 2) AS amount,
 count(DISTINCT company_name) AS company_name, min(publish_date_time) AS publish_date_time,
 max(tracing_no) AS tracing_no, count(url) AS url,
 arg_min(title, publish_date_time || '~' || tracing_no) AS title
 FROM letters GROUP BY ALL""",
    ),
)
def group_by_functions(spark, path):
    grouped = agg.group_by(
        letters(spark, path).withColumn(
            "title_order", F.concat_ws("~", "publish_date_time", "tracing_no")
        ),
        ["symbol", "letter_code", "missing"],
        {
            "amount": "sum",
            "company_name": "nunique",
            "publish_date_time": "min",
            "tracing_no": "max",
            "url": "count",
            "title": "first",
            "nothing": "max",
        },
        order="title_order",
    )
    return grouped.withColumn("amount", F.round("amount", 2))


@query(
    "group_by_moments",
    """SELECT l_returnflag, l_linestatus, round(avg(l_quantity), 6) AS l_quantity,
 round(stddev_samp(l_extendedprice), 4) AS l_extendedprice,
 round(var_samp(l_discount), 8) AS l_discount FROM lineitem GROUP BY ALL""",
)
def group_by_moments(spark, path):
    grouped = agg.group_by(
        Tables(spark, path).lineitem,
        ["l_returnflag", "l_linestatus"],
        {"l_quantity": "mean", "l_extendedprice": "std", "l_discount": "var"},
    )
    return grouped.select(
        "l_returnflag",
        "l_linestatus",
        F.round("l_quantity", 6).alias("l_quantity"),
        F.round("l_extendedprice", 4).alias("l_extendedprice"),
        F.round("l_discount", 8).alias("l_discount"),
    )


@query(
    "group_by_median",
    with_views(
        "letters",
        "SELECT symbol, round(median(amount), 4) AS amount, max(tracing_no) AS tracing_no"
        " FROM letters GROUP BY symbol",
    ),
)
def group_by_median(spark, path):
    grouped = agg.group_by(
        letters(spark, path), "symbol", {"amount": "median", "tracing_no": "max"}
    )
    return grouped.withColumn("amount", F.round("amount", 4))


def _longest_rise(values):
    """Length of the longest run of values that grow."""
    ends = np.flatnonzero(np.diff(values.to_numpy(dtype=float)) <= 0) + 1
    return int(np.diff(ends, prepend=0, append=len(values)).max())


@query(
    "group_by_callable",
    """WITH s AS (SELECT o_custkey, o_orderdate, o_orderkey, CASE WHEN o_totalprice > lag(o_totalprice)
  OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) THEN 0 ELSE 1 END AS starts FROM orders),
 r AS (SELECT o_custkey, sum(starts) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS run FROM s)
SELECT o_custkey, max(n) AS o_totalprice FROM (SELECT o_custkey, run, count(*) AS n FROM r GROUP BY ALL)
 GROUP BY o_custkey""",
)
def group_by_callable(spark, path):
    """Any function of a group's values: the longest run of orders that each cost more than the last."""
    rise = agg.GroupFunction(_longest_rise, "bigint", order=("o_orderdate", "o_orderkey"))
    return agg.group_by(Tables(spark, path).orders, "o_custkey", {"o_totalprice": rise})


@query(
    "group_by_user_function",
    """SELECT l_returnflag, max(l_quantity) - min(l_quantity) AS l_quantity,
 round(sqrt(sum(l_tax * l_tax) / count(*)), 8) AS l_tax FROM lineitem GROUP BY l_returnflag""",
)
def group_by_user_function(spark, path):
    root_mean_square = agg.MergeableAggregate(
        partial=lambda part: {"s": float((part["l_tax"] ** 2).sum()), "n": len(part)},
        merge=lambda states: {"s": float(states["s"].sum()), "n": int(states["n"].sum())},
        finish=lambda: F.sqrt(F.col("s") / F.col("n")),
        state="s double, n bigint",
    )
    grouped = agg.group_by(
        Tables(spark, path).lineitem,
        "l_returnflag",
        {"l_quantity": lambda c: F.max(c) - F.min(c), "l_tax": root_mean_square},
    )
    return grouped.withColumn("l_tax", F.round("l_tax", 8))


@query(
    "letter_code_distribution",
    with_views("letters", "SELECT letter_code, count(*) AS count FROM letters GROUP BY 1"),
)
def letter_code_distribution(spark, path):
    return letters(spark, path).transform(agg.value_counts, "letter_code")


@query(
    "top_symbols",
    with_views(
        "letters",
        "SELECT symbol, count(*) AS count FROM letters GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
    ),
)
def top_symbols(spark, path):
    return letters(spark, path).transform(agg.top_values, "symbol")


@query(
    "distinct_counts",
    with_views(
        "letters",
        "SELECT count(DISTINCT symbol) AS symbol, count(DISTINCT letter_code) AS letter_code,"
        " count(DISTINCT url) AS url FROM letters",
    ),
)
def distinct_counts(spark, path):
    return letters(spark, path).transform(agg.distinct_count, ["symbol", "letter_code", "url"])


LETTER = {
    "tracing_no": "string",
    "symbol": "string",
    "company_name": "string",
    "title": "string",
    "letter_code": "string",
    "publish_date_time": "string",
    "sent_date_time": "string",
    "url": "string",
    "excel_url": "string",
    "has_excel": "boolean",
    "audited": "boolean",
    "consolidated": "boolean",
    "is_child": "boolean",
    "is_publisher": "boolean",
    "company_type": "int",
    "period_length": "int",
    "isic": "string",
    "amount": "double",
}
def _summary_sql(table: str, columns: list[str]) -> str:
    """Summary of a table with the columns of letters; of those it holds, only some have nulls."""
    nulls = " ".join(
        f"UNION ALL SELECT 'columns_with_na', '{c}', CAST(count(*) AS VARCHAR) FROM {table}"
        f" WHERE {c} IS NULL HAVING count(*) > 0"
        for c in columns
    )
    return f"""
SELECT 'total_records' AS metric, '' AS key, CAST(count(*) AS VARCHAR) AS value FROM {table}
UNION ALL SELECT 'column_count', '', '{len(columns)}'
UNION ALL SELECT 'columns', '', '{",".join(columns)}'
UNION ALL SELECT 'unique_symbols', '', CAST(count(DISTINCT symbol) AS VARCHAR) FROM {table}
UNION ALL SELECT 'unique_letter_codes', '', CAST(count(DISTINCT letter_code) AS VARCHAR) FROM {table}
UNION ALL SELECT 'date_range_min', 'publish_date_time', min(publish_date_time) FROM {table}
UNION ALL SELECT 'date_range_max', 'publish_date_time', max(publish_date_time) FROM {table}
{nulls}
UNION ALL (SELECT 'top_symbols', symbol, CAST(count(*) AS VARCHAR) FROM {table} GROUP BY symbol
 ORDER BY count(*) DESC, symbol LIMIT 10)
UNION ALL SELECT 'letter_code_distribution', letter_code, CAST(count(*) AS VARCHAR) FROM {table}
 GROUP BY letter_code"""


@query("summary_stats", with_views("letters", _summary_sql("letters", list(LETTER))))
def summary_stats(spark, path):
    return letters(spark, path).transform(profile.summary_stats)


def _info(column: str, kind: str) -> str:
    return (
        f'SELECT \'{column}\' AS "column", \'{kind}\' AS dtype, count({column}) AS non_null_count,'
        f" count(*) - count({column}) AS null_count, count(DISTINCT {column}) AS unique_count,"
        # text of a double differs between engines, so its sample cannot be compared
        + (" '' AS sample_value" if kind == "double" else f" coalesce(min(CAST({column} AS VARCHAR)), '') AS sample_value")
        + " FROM letters"
    )


@query("column_info", with_views("letters", " UNION ALL ".join(_info(c, k) for c, k in LETTER.items())))
def column_info(spark, path):
    info = letters(spark, path).transform(profile.column_info)
    return info.withColumn("sample_value", F.when(F.col("dtype") == "double", "").otherwise(F.col("sample_value")))


def _numbers(c: str) -> str:
    return (
        f"SELECT '{c}' AS \"column\", count({c}) AS count, NULL::BIGINT AS \"unique\","
        f" NULL::VARCHAR AS top, NULL::BIGINT AS freq, round(avg({c}), 4) AS mean,"
        f" round(stddev_samp({c}), 4) AS std, min({c})::DOUBLE AS min,"
        f" round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50,"
        f" round(quantile_cont({c}, 0.75), 4) AS q75, max({c})::DOUBLE AS max FROM lineitem"
    )


def _texts(c: str) -> str:
    return (
        f"SELECT '{c}', CAST(sum(n) AS BIGINT), count(*), arg_min(v, lpad(CAST(1000000000 - n AS"
        " VARCHAR), 10, '0') || v), max(n), NULL, NULL, NULL, NULL, NULL, NULL, NULL"
        f" FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM lineitem GROUP BY {c})"
    )


DESCRIBED = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax",
]
DESCRIBED_TEXT = ["l_returnflag", "l_linestatus", "l_shipdate"]


@query(
    "describe_table",
    " UNION ALL ".join([_numbers(c) for c in DESCRIBED] + [_texts(c) for c in DESCRIBED_TEXT]),
)
def describe_table(spark, path):
    described = profile.describe(Tables(spark, path).lineitem)
    rounded = ("mean", "std", "q25", "q50", "q75")
    return described.withColumns({c: F.round(c, 4) for c in rounded})


# ----------------------------------------------------------------------- flows


@query(
    "report_board_changes",
    with_views(
        "letters letter_codes",
        f""", src AS (SELECT tracing_no, symbol, letter_code, publish_date_time, letter_description
 FROM letters LEFT JOIN letter_codes USING (letter_code)
 WHERE letter_code = 'ن-45' AND NOT is_child
  AND substr(publish_date_time, 1, 10) BETWEEN '1376/01/01' AND '1376/12/29')
{_summary_sql("src", [*CORE, "letter_description"])}""",
    ),
)
def report_board_changes(spark, path):
    found = search.board_changes(letters(spark, path), "1376/01/01", "1376/12/29")
    return (
        found.select("tracing_no", "symbol", "letter_code", "publish_date_time")
        .transform(frame.add_letter_descriptions)
        .transform(profile.summary_stats)
    )


@query(
    "report_newest_of_symbol",
    with_views(
        "letters letter_codes",
        f"""SELECT {CORE_SQL}, letter_description FROM letters LEFT JOIN letter_codes
 USING (letter_code) WHERE symbol = 'NATION_5' {NEWEST} LIMIT 5""",
    ),
)
def report_newest_of_symbol(spark, path):
    return (
        search.letters_of_symbol(letters(spark, path), "NATION_5")
        .select(CORE)
        .transform(frame.add_letter_descriptions)
        .transform(frame.tail, 5, ORDER)
    )


@query(
    "report_annual_statements",
    with_views(
        "letters",
        """SELECT symbol, substr(publish_date_time, 1, 4) AS year, count(*) AS announcement_count,
 arg_min(company_name, publish_date_time || '~' || tracing_no) AS company_name,
 'ن-10' AS letter_codes FROM letters
 WHERE letter_code = 'ن-10' AND period_length = 12 AND audited GROUP BY 1, 2""",
    ),
)
def report_annual_statements(spark, path):
    found = search.financial_statements(letters(spark, path))
    return agg.symbol_year(found).select(
        "symbol",
        "year",
        "announcement_count",
        "company_name",
        F.array_join("letter_code", ",").alias("letter_codes"),
    )


@query(
    "report_clean_letters",
    with_views(
        "letters letter_codes",
        f"""SELECT {CORE_SQL}, coalesce(url, '') AS url,
 coalesce(letter_description, '') AS letter_description
 FROM (SELECT *, row_number() OVER (PARTITION BY symbol, tracing_no ORDER BY publish_date_time
  DESC) AS r FROM letters WHERE letter_code = 'ن-45' AND NOT is_child
  AND substr(publish_date_time, 1, 10) BETWEEN '1375/01/01' AND '1379/12/29') LEFT JOIN letter_codes USING (letter_code) WHERE r = 1""",
    ),
)
def report_clean_letters(spark, path):
    wanted = [*CORE, "url", "letter_description"]
    return (
        letters(spark, path)
        .transform(search.board_changes, "1375/01/01", "1379/12/29")
        .select(*CORE, "url")
        .transform(frame.drop_duplicates, ["symbol", "tracing_no"], "last", ORDER)
        .transform(frame.add_letter_descriptions)
        .transform(frame.sort_by, "publish_date_time", False)
        .transform(frame.fill_na)
        .select(wanted)
    )


@query(
    "report_statements_with_spreadsheet",
    with_views(
        "letters",
        f"SELECT {CORE_SQL} FROM letters WHERE letter_code = 'ن-10' AND has_excel",
    ),
)
def report_statements_with_spreadsheet(spark, path):
    found = search.search_letters(letters(spark, path), letter_code="ن-10")
    kept = found.transform(frame.filter_by_condition, F.col("has_excel"))
    watched, _ = frame.observed(kept, "with spreadsheet")
    return watched.select(CORE)


@query(
    "report_several_symbols",
    with_views(
        "letters letter_codes",
        f"""SELECT {CORE_SQL}, letter_description FROM letters LEFT JOIN letter_codes
 USING (letter_code) WHERE symbol IN ('NATION_1', 'NATION_2', 'NATION_3')""",
    ),
)
def report_several_symbols(spark, path):
    found = search.letters_of_symbol(letters(spark, path), ["NATION_1", "NATION_2", "NATION_3"])
    return found.select(CORE).transform(frame.add_letter_descriptions)


@query(
    "letter_numbers",
    with_views(
        "letters",
        "SELECT tracing_no, CAST(rpad(regexp_replace(publish_date_time, '[^0-9]', '', 'g'), 14,"
        " '0') AS BIGINT) AS published, upper(company_name) AS company FROM letters",
    ),
)
def letter_numbers(spark, path):
    return letters(spark, path).select(
        "tracing_no",
        datetime_to_num("publish_date_time").alias("published"),
        F.upper(norm_text("company_name")).alias("company"),
    )
