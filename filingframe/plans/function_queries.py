"""Queries that run the Column functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from filingframe.functions import calendar as cal
from filingframe.functions import collections as col
from filingframe.functions import numbers, text, urls
from filingframe.operators import quality
from filingframe.plans.catalog import query
from filingframe.plans.views import BASE, Tables, board_members, letters, sql_jalali, with_views

# Whitespace as one explicit class, since \s differs between regex engines.
SPACE = (
    r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
PERSIAN = "'يكةؤإأ', 'یکهواا'"
DROPPED = "[ء\\x{200b}-\\x{200f}\\x{feff}]"


def sql_norm(c: str) -> str:
    letters_ = f"regexp_replace(translate(coalesce({c}, ''), {PERSIAN}), '{DROPPED}', '', 'g')"
    return f"trim(regexp_replace({letters_}, '{SPACE}+', ' ', 'g'))"


def sql_latin(c: str) -> str:
    return f"translate({c}, '۰۱۲۳۴۵۶۷۸۹٠١٢٣٤٥٦٧٨٩', '01234567890123456789')"


def sql_symbol(c: str) -> str:
    kept = f"regexp_replace({sql_norm(sql_latin(c))}, '[^\\p{{L}}\\p{{N}}_\\x{{600}}-\\x{{6ff}}]+', '', 'g')"
    return f"translate({kept}, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ')"


# Arabic letters, marks and digits are woven into whole texts on both sides.
def woven(c):
    return F.translate(c, "aeiou0123456789", "يكةؤإ۰۱۲۳۴٥٦٧٨٩")


SQL_WOVEN = "translate(text, 'aeiou0123456789', 'يكةؤإ۰۱۲۳۴٥٦٧٨٩')"


@query(
    "normalise_text",
    f"SELECT doc_id, md5({sql_norm(SQL_WOVEN)}) AS digest,"
    f" CAST(length({sql_norm(SQL_WOVEN)}) AS BIGINT) AS n FROM documents",
)
def normalise_text(spark, path):
    clean = text.norm_text(woven(F.col("text")))
    return Tables(spark, path).documents.select(
        "doc_id", F.md5(clean).alias("digest"), F.length(clean).cast("bigint").alias("n")
    )


@query(
    "convert_digits",
    f"SELECT doc_id, md5({sql_latin(SQL_WOVEN)}) AS latin,"
    " md5(translate(text, '0123456789', '۰۱۲۳۴۵۶۷۸۹')) AS persian FROM documents",
)
def convert_digits(spark, path):
    return Tables(spark, path).documents.select(
        "doc_id",
        F.md5(text.latin_digits(woven(F.col("text")))).alias("latin"),
        F.md5(text.persian_digits("text")).alias("persian"),
    )


@query("clean_symbols", f"SELECT doc_id, md5({sql_symbol(SQL_WOVEN)}) AS digest FROM documents")
def clean_symbols(spark, path):
    return Tables(spark, path).documents.select(
        "doc_id", F.md5(text.clean_symbol(woven(F.col("text")))).alias("digest")
    )


@query(
    "symbol_keys",
    "SELECT doc_id, md5(trim(regexp_replace(regexp_replace("
    f"{sql_latin(SQL_WOVEN)}, '[\\x{{200c}}\\x{{200f}}]', '', 'g'), '{SPACE}+', ' ', 'g'))) AS digest"
    " FROM documents",
)
def symbol_keys(spark, path):
    return Tables(spark, path).documents.select(
        "doc_id", F.md5(text.symbol_key(woven(F.col("text")))).alias("digest")
    )


@query(
    "strip_and_flags",
    f"""SELECT doc_id, md5(regexp_replace(text, '^{SPACE}+|{SPACE}+$', '', 'g')) AS stripped,
 lang IN ('en') AS is_english, contains(lower(text), 'network') AS mentions_network,
 CASE WHEN contains(lower(text), 'net::') OR contains(lower(text), 'network') THEN 'network'
  WHEN contains(lower(text), 'navigation') THEN 'navigation'
  WHEN contains(lower(text), 'timeout') THEN 'timeout' ELSE 'unknown' END AS error_type
 FROM documents""",
)
def strip_and_flags(spark, path):
    answer = F.when(F.col("lang") == "en", " Yes ").otherwise("خیر")
    return Tables(spark, path).documents.select(
        "doc_id",
        F.md5(text.clean_str("text")).alias("stripped"),
        text.yes_no(answer).alias("is_english"),
        F.contains(F.lower("text"), F.lit("network")).alias("mentions_network"),
        text.error_class("text").alias("error_type"),
    )


@query(
    "error_classes",
    with_views(
        "fetch_log", "SELECT event_id, error_type FROM fetch_log WHERE error_type IS NOT NULL"
    ),
)
def error_classes(spark, path):
    from filingframe.plans.views import fetch_log

    failed = fetch_log(spark, path).where("message is not null")
    return failed.select("event_id", text.error_class("message").alias("error_type"))


@query(
    "jalali_dates",
    f"""SELECT o_orderkey, j AS jalali, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS back,
 year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS d_even,
 CAST(substr(j, 1, 4) AS INTEGER) AS jalali_year, j AS from_number
 FROM (SELECT *, {sql_jalali("o_orderdate")} AS j FROM orders)""",
)
def jalali_dates(spark, path):
    jalali = cal.to_jalali("o_orderdate")
    dates = Tables(spark, path).orders.select("o_orderkey", "o_orderdate", jalali.alias("jalali"))
    spread = F.translate(text.persian_digits("jalali"), "/", "-")
    return dates.select(
        "o_orderkey",
        "jalali",
        cal.from_jalali(spread).cast("string").alias("back"),
        cal.d_even("o_orderdate").cast("bigint").alias("d_even"),
        cal.jalali_year("o_orderdate").alias("jalali_year"),
        cal.gregorian_num_to_jalali(cal.d_even("o_orderdate")).alias("from_number"),
    )


@query(
    "date_numbers",
    with_views(
        "letters",
        """SELECT tracing_no,
 CAST(rpad(regexp_replace(publish_date_time, '[^0-9]', '', 'g'), 14, '0') AS BIGINT) AS number,
 publish_date_time AS text, replace(substr(publish_date_time, 1, 10), '/', '-') AS day,
 CAST(rpad(regexp_replace(sent_date_time, '[^0-9]', '', 'g'), 14, '0') AS BIGINT) AS sent
 FROM letters""",
    ),
)
def date_numbers(spark, path):
    number = cal.datetime_to_num("publish_date_time")
    return letters(spark, path).select(
        "tracing_no",
        number.alias("number"),
        cal.num_to_datetime(number).alias("text"),
        cal.num_to_datetime(number, include_time=False, date_sep="-").alias("day"),
        cal.datetime_to_num("sent_date_time").alias("sent"),
    )


@query(
    "jalali_year_ranges",
    """SELECT CAST(year AS INTEGER) AS year, year || '/01/01' AS start_date,
 year || CASE WHEN year % 33 IN (1, 5, 9, 13, 17, 22, 26, 30) THEN '/12/30' ELSE '/12/29' END
  AS end_date, year || '/12/29' AS plain_end, count(*) AS orders
 FROM (SELECT CAST(substr("""
    + sql_jalali("o_orderdate")
    + """, 1, 4) AS INTEGER) AS year FROM orders) GROUP BY year""",
)
def jalali_year_ranges(spark, path):
    years = cal.year_ranges(spark, 1300, 1500)
    plain = cal.year_ranges(spark, 1300, 1500, fixed_29=True).select(
        "year", F.col("end_date").alias("plain_end")
    )
    orders = Tables(spark, path).orders.groupBy(cal.jalali_year("o_orderdate").alias("year"))
    counted = orders.agg(F.count(F.lit(1)).alias("orders"))
    return counted.join(years, "year").join(plain, "year")


@query(
    "valid_jalali_dates",
    f"""SELECT o_orderkey, d, m BETWEEN 1 AND 12 AND d BETWEEN 1 AND CASE WHEN m <= 6 THEN 31
 WHEN m <= 11 THEN 30 WHEN y % 33 IN (1, 5, 9, 13, 17, 22, 26, 30) THEN 30 ELSE 29 END AS valid
 FROM (SELECT o_orderkey, CAST(substr(j, 1, 4) AS INTEGER) AS y,
  CAST(o_orderkey % 14 AS INTEGER) AS m, CAST(o_custkey % 33 AS INTEGER) AS d
  FROM (SELECT *, {sql_jalali("o_orderdate")} AS j FROM orders))""",
)
def valid_jalali_dates(spark, path):
    month, day = F.col("o_orderkey") % 14, (F.col("o_custkey") % 33).cast("int")
    date = F.concat_ws(
        "/", F.substring(cal.to_jalali("o_orderdate"), 1, 4), month.cast("string"), day.cast("string")
    )
    return Tables(spark, path).orders.select(
        "o_orderkey", day.alias("d"), cal.is_jalali_date(date).alias("valid")
    )


@query(
    "period_keys",
    with_views(
        "board",
        """SELECT url, row_no, member_id, company, substr(assembly_date, 1, 6) AS month,
 substr(assembly_date, 1, 4) || 'Q' ||
  CAST((CAST(substr(assembly_date, 5, 2) AS INTEGER) - 1) // 3 + 1 AS VARCHAR) AS quarter
 FROM board""",
    ),
)
def period_keys(spark, path):
    return board_members(spark, path).select(
        "url",
        "row_no",
        "member_id",
        "company",
        cal.month_key("assembly_date").alias("month"),
        cal.quarter_key("assembly_date").alias("quarter"),
    )


@query(
    "parse_numbers",
    """SELECT o_orderkey, round(CASE o_orderkey % 6 WHEN 0 THEN o_custkey * 1000.0
 WHEN 1 THEN (o_custkey + 0.5) * 1000000 WHEN 2 THEN o_custkey * 1e9
 WHEN 3 THEN 0.0 WHEN 4 THEN o_custkey * 1e12 ELSE o_custkey + 0.25 END, 2) AS number
 FROM orders""",
)
def parse_numbers(spark, path):
    key, cust = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    human = (
        F.when(key % 6 == 0, F.concat(F.format_number("o_custkey", 0), F.lit(" k")))
        .when(key % 6 == 1, F.concat(cust, F.lit(".5M")))
        .when(key % 6 == 2, F.concat(text.persian_digits(cust), F.lit("B ")))
        .when(key % 6 == 3, F.concat(F.lit("x"), cust))
        .when(key % 6 == 4, F.concat(F.lit("  "), cust, F.lit("t")))
        .otherwise(F.concat(cust, F.lit(".25")))
    )
    return Tables(spark, path).orders.select(
        "o_orderkey", F.round(numbers.parse_number(human), 2).alias("number")
    )


@query(
    "format_numbers",
    "SELECT o_orderkey, format('{:,}', CAST(trunc(o_totalprice) AS BIGINT)) AS whole,"
    " format('{:,.2f}', o_totalprice) AS cents FROM orders",
)
def format_numbers(spark, path):
    return Tables(spark, path).orders.select(
        "o_orderkey",
        numbers.format_thousands("o_totalprice").alias("whole"),
        numbers.format_thousands("o_totalprice", 2).alias("cents"),
    )


@query(
    "tracing_numbers",
    """SELECT page_id, url, coalesce(nullif(regexp_extract(url, 'LetterSerial=([0-9]+)', 1), ''),
 nullif(regexp_extract(url, 'TracingNo=([0-9]+)', 1), ''),
 nullif(regexp_extract(url, '/([0-9]+)$', 1), '')) AS tracing_no FROM pages
 UNION ALL SELECT o_orderkey, '/x?TracingNo=1&LetterSerial=' || o_orderkey,
  CAST(o_orderkey AS VARCHAR) FROM orders""",
)
def tracing_numbers(spark, path):
    t = Tables(spark, path)
    key = F.col("o_orderkey")
    made = F.concat(F.lit("/x?TracingNo=1&LetterSerial="), key.cast("string"))
    both = t.pages.select("page_id", "url").union(t.orders.select(key, made))
    return both.withColumn("tracing_no", urls.tracing_no_from_url("url"))


@query(
    "full_urls",
    with_views(
        "letters",
        f"""SELECT tracing_no, CASE WHEN coalesce(url, '') = '' THEN '' WHEN url LIKE 'http%' THEN url
 ELSE '{BASE}' || url END AS url, '{BASE}/' || tracing_no AS joined FROM letters""",
    ),
)
def full_urls(spark, path):
    return letters(spark, path).select(
        "tracing_no", urls.full_url("url").alias("url"), urls.full_url("tracing_no").alias("joined")
    )


@query(
    "query_urls",
    "SELECT c_custkey, 'https://search.example/q?Page=' || (c_nationkey + 1) || '&Symbol=' ||"
    " url_encode(c_mktsegment) || '&search=true' AS api,"
    " 'https://search.example/q?search&Page=' || (c_nationkey + 1) || '&Symbol=' ||"
    " url_encode(c_mktsegment) AS web,"
    " md5('https://search.example/q' || '{\"Page\":\"' || (c_nationkey + 1) || '\",\"Symbol\":\"'"
    " || c_mktsegment || '\"}') AS request_key FROM customer",
)
def query_urls(spark, path):
    params = F.create_map(
        F.lit("Symbol"), F.col("c_mktsegment"),
        F.lit("Page"), (F.col("c_nationkey") + 1).cast("string"),
        F.lit("Length"), F.lit("-1"),
        F.lit("Isic"), F.lit(None).cast("string"),
    )
    endpoint = "https://search.example/q"
    return Tables(spark, path).customer.select(
        "c_custkey",
        urls.query_url(params, endpoint).alias("api"),
        urls.query_url(params, endpoint, api=False).alias("web"),
        urls.fingerprint(F.lit(endpoint), urls.drop_unset(params)).alias("request_key"),
    )


@query(
    "person_ids",
    with_views(
        "board",
        "SELECT url, row_no, company, member_id, length(member_id) = 10 AS is_person FROM board",
    ),
)
def person_ids(spark, path):
    spread = F.concat_ws("-", F.substring(text.persian_digits("member_id"), 1, 3),
                         F.expr("substring(member_id, 4)"))
    rows = board_members(spark, path).select("url", "row_no", "company", spread.alias("raw"))
    return rows.select(
        "url",
        "row_no",
        "company",
        text.digits_only("raw").alias("member_id"),
        text.is_person_id("raw").alias("is_person"),
    )


@query(
    "map_without_unset",
    "SELECT c_custkey, concat_ws(',', CASE WHEN c_custkey % 3 <> 0 THEN 'a=' || c_custkey END,"
    " 'b=0') AS params, concat_ws(',', CASE WHEN c_custkey % 3 <> 0 THEN 'a=' || c_custkey"
    " ELSE 'a=-1' END, 'b=' || c_nationkey, 'd=new') AS merged FROM customer",
)
def map_without_unset(spark, path):
    value = F.when(F.col("c_custkey") % 3 != 0, F.col("c_custkey").cast("string")).otherwise("-1")
    first = F.create_map(F.lit("a"), value, F.lit("b"), F.lit("0"))
    second = F.create_map(F.lit("b"), F.col("c_nationkey").cast("string"), F.lit("d"), F.lit("new"))
    nothing = F.lit(None).cast("map<string,string>")

    def listed(m):
        pairs = F.array_sort(F.map_entries(m))
        return F.array_join(F.transform(pairs, lambda e: F.concat_ws("=", e["key"], e["value"])), ",")

    return Tables(spark, path).customer.select(
        "c_custkey",
        listed(urls.drop_unset(first)).alias("params"),
        listed(col.merge_maps(first, nothing, second)).alias("merged"),
    )


@query(
    "nested_values",
    "SELECT event_id, json_extract_string(props, '$.k') AS k, 'none' AS missing FROM events",
)
def nested_values(spark, path):
    return Tables(spark, path).events.select(
        "event_id",
        col.nested_get("props", "k").alias("k"),
        col.nested_get("props", "k", "deeper", default="none").alias("missing"),
    )


@query(
    "flat_unique_arrays",
    "SELECT o_orderkey, concat_ws(',', o_orderstatus, CASE WHEN o_orderpriority <> o_orderstatus"
    " THEN o_orderpriority END, 'F_') AS parts FROM orders",
)
def flat_unique_arrays(spark, path):
    nested = F.array(
        F.array("o_orderstatus", "o_orderpriority"), F.array("o_orderstatus", F.lit("F_"))
    )
    return Tables(spark, path).orders.select(
        "o_orderkey", F.array_join(col.unique(col.flatten(nested)), ",").alias("parts")
    )


@query(
    "symbol_candidates",
    with_views(
        "assemblies",
        """SELECT company, CASE WHEN company NOT LIKE '%نماد%' THEN '' ELSE
 concat_ws('|', nullif(inside, ''), CASE WHEN head <> inside THEN head END) END AS candidates
 FROM (SELECT company, regexp_extract(company, '\\(([^)]*)\\)', 1) AS inside,
  regexp_extract(company, 'نماد: ([^(]*)', 1) AS head FROM assemblies)""",
    ),
)
def symbol_candidates(spark, path):
    from filingframe.plans.views import assemblies

    return assemblies(spark, path).select(
        "company", F.array_join(text.symbol_candidates("company"), "|").alias("candidates")
    )


# ---------------------------------------------------------------- data quality

RULES = [
    quality.rule("not_none", "url"),
    quality.rule("not_empty", "url"),
    quality.rule("boolean", "audited"),
    quality.rule("integer", "period_length"),
    quality.rule("string", "symbol"),
    quality.rule("integer_string", "tracing_no"),
    quality.rule("date", "sent_date_time"),
    quality.rule("date", "publish_date_time"),
    quality.rule("symbol", "symbol"),
    quality.rule("isic", "isic"),
    quality.rule("letter_code", "letter_code"),
    quality.rule("url", "url"),
    quality.rule("range", "amount", min_val=1000, max_val=300000),
    quality.rule("list", "company_type", valid_values=[1, 2]),
    quality.rule("pattern", "title", pattern="[A-M]"),
    quality.rule("min_length", "title", min_length=14),
    quality.rule("max_length", "title", max_length=20),
]
SQL_RULES = {
    ("not_none", "url"): "url IS NOT NULL",
    ("not_empty", "url"): "coalesce(url, '') <> ''",
    ("boolean", "audited"): "k % 7 <> 0",
    ("integer", "period_length"): "k % 11 <> 0",
    ("string", "symbol"): "k % 13 <> 0",
    ("integer_string", "tracing_no"): "k % 19 <> 0",
    ("date", "sent_date_time"): "k % 5 <> 0",
    ("date", "publish_date_time"): "k % 2 = 0",
    ("symbol", "symbol"): "k % 13 <> 0 AND k % 17 <> 0",
    ("isic", "isic"): "k % 3 <> 0",
    ("letter_code", "letter_code"): "k % 23 <> 0 AND letter_code IS NOT NULL",
    ("url", "url"): "coalesce(url LIKE 'http%', false)",
    ("range", "amount"): "amount BETWEEN 1000 AND 300000",
    ("list", "company_type"): "company_type IN (1, 2)",
    ("pattern", "title"): "title < 'N'",
    ("min_length", "title"): "length(title) >= 14",
    ("max_length", "title"): "length(title) <= 20",
}


def _worn(df):
    """Letters of which some break each rule."""
    k = F.col("tracing_no").cast("bigint")

    def every(n, bad, column):
        return F.when(k % n != 0, F.col(column)).otherwise(bad)

    # the serial number goes last, the others are worn by it
    worn = df.withColumns(
        {
            "audited": every(7, F.lit(None), "audited"),
            "period_length": every(11, F.lit(None), "period_length"),
            "symbol": F.when(k % 13 == 0, F.lit(None)).otherwise(every(17, F.lit("two words"), "symbol")),
            "sent_date_time": every(5, F.lit("1402/13/01"), "sent_date_time"),
            "publish_date_time": F.when(k % 2 == 0, F.substring("publish_date_time", 1, 10)).otherwise(
                F.col("publish_date_time")
            ),
            "isic": every(3, F.lit("12"), "isic"),
            "letter_code": every(23, F.lit("45"), "letter_code"),
        }
    )
    return worn.withColumn("tracing_no", every(19, F.lit("12x"), "tracing_no"))


@query(
    "validation_report",
    with_views(
        "letters",
        " UNION ALL ".join(
            f"SELECT '{kind}' AS rule, '{c}' AS \"column\", count(*) AS checked,"
            f" count(*) FILTER (NOT ({test})) AS failed FROM"
            " (SELECT *, CAST(tracing_no AS BIGINT) AS k FROM letters)"
            for (kind, c), test in SQL_RULES.items()
        ),
    ),
)
def validation_report(spark, path):
    return quality.validation_report(_worn(letters(spark, path)), RULES)


@query(
    "rows_with_violations",
    with_views(
        "letters",
        "SELECT tracing_no, concat_ws(',', CASE WHEN coalesce(url, '') = '' THEN 'url:not_empty' END,"
        " CASE WHEN NOT amount BETWEEN 1000 AND 300000 THEN 'amount:range' END) AS violations"
        " FROM letters WHERE coalesce(url, '') = '' OR NOT amount BETWEEN 1000 AND 300000",
    ),
)
def rows_with_violations(spark, path):
    rules = [
        quality.rule("not_empty", "url"),
        quality.rule("range", "amount", min_val=1000, max_val=300000),
    ]
    _, broken = quality.split_valid(letters(spark, path), rules)
    return broken.select("tracing_no", F.array_join("violations", ",").alias("violations"))


@query(
    "date_range_rule",
    with_views(
        "letters",
        "SELECT tracing_no, sent_date_time <= '1377/06/15' AS ordered FROM letters",
    ),
)
def date_range_rule(spark, path):
    rows = letters(spark, path).withColumn("until", F.lit("1377/6/15"))
    checked = quality.validate(rows, [quality.date_range_rule("sent_date_time", "until")])
    return checked.select("tracing_no", (F.size("violations") == 0).alias("ordered"))


@query(
    "document_rules",
    """SELECT 'pattern' AS rule, 'text' AS "column", count(*) AS checked,
 count(*) FILTER (NOT regexp_matches(text, '^[A-Z]')) AS failed FROM documents
 UNION ALL SELECT 'max_length', 'text', count(*), count(*) FILTER (length(text) > 5000)
 FROM documents
 UNION ALL SELECT 'list', 'lang', count(*), count(*) FILTER (lang NOT IN ('en', 'fr'))
 FROM documents""",
)
def document_rules(spark, path):
    rules = [
        quality.rule("pattern", "text", pattern="[A-Z]"),
        quality.rule("max_length", "text", max_length=5000),
        quality.rule("list", "lang", valid_values=["en", "fr"]),
    ]
    return quality.validation_report(Tables(spark, path).documents, rules)
