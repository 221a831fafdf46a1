"""Round trips through sources and sinks: what is written in the shared folder is read back."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from filingframe.functions.calendar import to_jalali
from filingframe.operators import aggregates as agg
from filingframe.operators import frame
from filingframe.plans.board_queries import MEMBER, MEMBERS_SQL, board_pages
from filingframe.plans.catalog import query
from filingframe.plans.ledger_queries import _errors as fetch_errors
from filingframe.plans.letter_queries import CORE, CORE_SQL, LETTER_URLS_SQL
from filingframe.plans.views import Tables, letters, sql_jalali, text, with_views
from filingframe.session import shared_dir
from filingframe.sources import html, readers, sinks
from filingframe.streaming import ingest

#: Letters of one landed document.
PAGE = 100


def _folder(spark, name):
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _raw_letter():
    return F.struct(
        text("o_orderkey").alias("TracingNo"),
        F.concat(F.lit(" sym"), text("o_custkey")).alias("Symbol"),
        F.col("o_orderpriority").alias("Title"),
        (F.col("o_orderkey") % 2 == 0).alias("HasExcel"),
    )


def _documents(spark, path):
    """Landed JSON documents, a page of orders each, in every envelope shape."""
    page = F.floor(F.col("o_orderkey") / PAGE)
    held = F.collect_list(_raw_letter())
    pages = Tables(spark, path).orders.groupBy(page.alias("page")).agg(held.alias("l"))
    paged = F.create_map(text("page"), F.col("l"))
    return pages.select(
        "page",
        F.when(F.col("page") % 4 == 0, F.to_json("l"))
        .when(F.col("page") % 4 == 1, F.to_json(F.struct(F.col("l").alias("Letters"))))
        .when(F.col("page") % 4 == 2, F.to_json(F.struct(F.col("l").alias("data"))))
        .otherwise(F.to_json(F.struct(paged.alias("pages"))))
        .alias("value"),
    )


@query(
    "scan_json_documents",
    "SELECT CAST(o_orderkey AS VARCHAR) AS tracing_no, 'sym' || o_custkey AS symbol,"
    " o_orderpriority AS title, o_orderkey % 2 = 0 AS has_excel FROM orders",
)
def scan_json_documents(spark, path):
    folder = _folder(spark, "documents")
    # a document is a file
    _documents(spark, path).select("value").write.option("maxRecordsPerFile", 1).text(folder)
    found = readers.normalise(readers.read_letters_json(spark, folder))
    return found.select("tracing_no", "symbol", "title", "has_excel")


@query(
    "parse_api_replies",
    "SELECT CAST(o_orderkey AS VARCHAR) AS tracing_no, 'sym' || o_custkey AS symbol FROM orders",
)
def parse_api_replies(spark, path):
    reply = F.to_json(F.struct(F.array(_raw_letter()).alias("Letters"), F.lit(1).alias("Total")))
    replies = Tables(spark, path).orders.select(reply.alias("value"))
    return readers.parse_responses(replies).select("tracing_no", "symbol")


@query("csv_round_trip", with_views("letters", f"SELECT {CORE_SQL}, company_name FROM letters"))
def csv_round_trip(spark, path):
    folder = _folder(spark, "csv")
    sinks.write_csv(letters(spark, path).select(*CORE, "company_name"), folder)
    return readers.read_csv(spark, folder)


@query(
    "csv_url_column",
    with_views("letters", "SELECT url FROM letters WHERE url IS NOT NULL AND url <> ''"),
)
def csv_url_column(spark, path):
    folder = _folder(spark, "urls")
    sinks.write_csv(letters(spark, path).select("tracing_no", "url"), folder, bom=False)
    return readers.read_url_csv(spark, folder).where("url is not null")


@query(
    "parquet_round_trip",
    f"""SELECT o_orderkey, CAST(substr({sql_jalali("o_orderdate")}, 1, 4) AS INTEGER) AS jalali_year
 FROM orders""",
)
def parquet_round_trip(spark, path):
    folder = _folder(spark, "parquet")
    year = F.substring(to_jalali("o_orderdate"), 1, 4).cast("int")
    orders = Tables(spark, path).orders.select("o_orderkey", year.alias("jalali_year"))
    sinks.write_parquet(orders, folder, compression="zstd", partition_by="jalali_year")
    return readers.read_parquet(spark, folder)


@query("json_round_trip", "SELECT event_id, epoch_us(ts) AS at, event_type, value FROM events")
def json_round_trip(spark, path):
    folder = _folder(spark, "json")
    sinks.write_json(Tables(spark, path).events.select("event_id", "ts", "event_type", "value"), folder)
    schema = "event_id bigint, ts timestamp, event_type string, value double"
    back = spark.read.schema(schema).json(folder)
    return back.select("event_id", F.unix_micros("ts").alias("at"), "event_type", "value")


@query("url_table_export", with_views("letters", f"SELECT * REPLACE (coalesce(letter_code, '') AS letter_code) FROM ({LETTER_URLS_SQL})"))
def url_table_export(spark, path):
    folder = _folder(spark, "url-table")
    sinks.write_letter_urls(letters(spark, path), folder)
    return readers.read_csv(spark, folder).na.fill("")


@query(
    "error_log_export",
    with_views(
        "fetch_log",
        "SELECT url, error_type, count(*) AS entries FROM fetch_log WHERE status = 'failed' GROUP BY ALL",
    ),
)
def error_log_export(spark, path):
    """Two appends to one log."""
    folder = _folder(spark, "errors")
    errors = agg.failed_urls(fetch_errors(spark, path)).select("url", "error_type")
    for part in (0, 1):
        sinks.export_errors(errors.where(F.pmod(F.length("url"), F.lit(2)) == part), folder)
    log = spark.read.schema("url string, error_type string").json(folder)
    return log.groupBy("url", "error_type").agg(F.count(F.lit(1)).alias("entries"))


@query("append_chunks", with_views("letters", f"SELECT {CORE_SQL} FROM letters"))
def append_chunks(spark, path):
    folder, rows = _folder(spark, "chunks"), letters(spark, path).select(CORE)
    for part in range(3):
        chunk = rows.where(F.pmod(F.col("tracing_no").cast("bigint"), F.lit(3)) == part)
        sinks.append_rows(chunk, folder)
    return readers.read_parquet(spark, folder)


@query(
    "report_tables",
    with_views(
        "letters",
        """SELECT 'data' AS part, symbol, count(*) AS count FROM letters GROUP BY symbol
 UNION ALL SELECT 'summary', symbol, count(*) FROM letters GROUP BY symbol""",
    ),
)
def report_tables(spark, path):
    folder, rows = _folder(spark, "report"), letters(spark, path).select(CORE)
    counts = agg.value_counts(rows, "symbol")
    sinks.write_report({"data": rows, "summary": counts}, folder)
    back = {name: readers.read_parquet(spark, f"{folder}/{name}") for name in ("data", "summary")}
    back["data"] = agg.value_counts(back["data"], "symbol")
    return frame.tagged_union(back, "part").select("part", "symbol", "count")


@query(
    "holder_columns",
    """SELECT 'holder ' || l_partkey AS "shareHolderName", l_quantity AS "perOfShares",
 l_orderkey || '-' || l_linenumber AS "shareHolderShareID" FROM lineitem""",
)
def holder_columns(spark, path):
    found = Tables(spark, path).lineitem.select(
        F.concat(F.lit("holder "), text("l_partkey")).alias("سهامدار / دارنده"),
        F.col("l_quantity").alias("درصد سهام"),
        F.concat_ws("-", text("l_orderkey"), text("l_linenumber")).alias("ID"),
        F.col("l_tax").alias("unrelated"),
    )
    return readers.normalise_holders(found)


COLLECTED_SQL = """WITH pages AS (SELECT user_id, event_id, event_type <> 'error' AS ok,
  row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS page FROM events),
 found AS (SELECT user_id, bool_or(page = 1 AND ok) AS started, count(*) FILTER (NOT ok) AS failed
  FROM pages GROUP BY user_id)"""


def _reply_pages(spark, path):
    number = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id"))
    return Tables(spark, path).events.select(
        "user_id", "event_id", number.alias("page"), (F.col("event_type") != "error").alias("ok")
    )


@query(
    "collected_pages",
    f"{COLLECTED_SQL} SELECT user_id, page, event_id FROM pages JOIN found USING (user_id) WHERE ok AND started",
)
def collected_pages(spark, path):
    """Failed pages are left out; without its first page a query gives nothing."""
    kept = frame.collect_pages(_reply_pages(spark, path), "user_id")
    return kept.select("user_id", F.col("page").cast("bigint").alias("page"), "event_id")


@query(
    "skipped_pages",
    f"""{COLLECTED_SQL} SELECT user_id, started, failed,
 CASE WHEN started THEN n - failed ELSE 0 END AS collected FROM found
 JOIN (SELECT user_id, count(*) AS n FROM pages GROUP BY user_id) USING (user_id)""",
)
def skipped_pages(spark, path):
    return frame.page_outcomes(_reply_pages(spark, path), "user_id")


@query("board_load", MEMBERS_SQL)
def board_load(spark, path):
    """A resumable load of a URL list, run again with a list that overlaps."""
    folder = _folder(spark, "load")
    pages = board_pages(spark, path)
    pages.write.parquet(f"{folder}/pages")
    key = F.substring("url", 10, 20).cast("bigint")
    urls = pages.select("url")
    for run, part in (("first", urls.where(key % 3 != 0)), ("second", urls)):
        sinks.write_csv(part, f"{folder}/urls-{run}", bom=False)
        stream = ingest.read_url_stream(spark, f"{folder}/urls-{run}")
        ingest.load_board_members(stream, f"{folder}/pages", f"{folder}/out", f"{folder}/checkpoint-{run}")
    members = ingest.loaded(spark, f"{folder}/out", "members")
    numbered = members.withColumn("row_no", F.when(F.col("prev_member") == "", 0).otherwise(1))
    return numbered.select(MEMBER)


LINK_SQL = """WITH p AS (SELECT page_id, url AS page_url, page_id AS k FROM pages)
SELECT page_id, page_url, 'https://portal.example/files/' || k || '.xlsx' AS url, k || '.xlsx' AS filename,
 'Statement' AS text FROM p
UNION ALL SELECT page_id, page_url, 'https://portal.example/get?id=' || k, 'get?id=' || k, 'Excel file' FROM p
UNION ALL SELECT page_id, page_url, 'https://portal.example/x/' || k || '.xls', k || '.xls', '' FROM p
 WHERE k % 5 <> 0"""


@query("spreadsheet_links", LINK_SQL)
def spreadsheet_links(spark, path):
    """The default rule on pages with anchors by address and by text, an embed, and broken markup."""
    k = text("page_id")
    page = F.concat(
        F.lit('<p><a href="/files/'), k, F.lit('.xlsx">Statement</a><a href="/about">About</a><a href="/get?id='), k,
        F.lit('">Excel file</a>'),
        # every fifth page breaks off in a section that no parser accepts
        F.when(F.col("page_id") % 5 == 0, "<![foo[x]]>").otherwise(""),
        F.lit('<iframe src="/frame.html"></iframe><embed src="/x/'), k, F.lit('.xls">'),
    )
    pages = Tables(spark, path).pages.select("page_id", "url", page.alias("html"))
    return html.extract_links(pages)


@query(
    "broken_link_pages",
    "SELECT url, 'parsing' AS error_type, true AS recoverable FROM pages WHERE page_id % 5 = 0",
)
def broken_link_pages(spark, path):
    broken = F.when(F.col("page_id") % 5 == 0, "<a href='x.xls'>a</a><![foo[x]]>").otherwise("<p>fine</p>")
    pages = Tables(spark, path).pages.select("url", broken.alias("html"))
    return html.link_errors(pages).select("url", "error_type", "recoverable")


@query(
    "step_counts",
    with_views(
        "letters",
        """, s AS (SELECT count(*) AS a, count(*) FILTER (letter_code = 'ن-10') AS b,
  count(DISTINCT symbol) FILTER (letter_code = 'ن-10') AS c FROM letters)
SELECT 1 AS no, 'filter_by_letter_code: ' || a || ' -> ' || b AS step FROM s
UNION ALL SELECT 2, 'drop_duplicates: ' || b || ' -> ' || c FROM s""",
    ),
)
def step_counts(spark, path):
    """Rows before and after each step, counted while the steps run."""
    steps = frame.Steps(letters(spark, path).select(CORE))
    steps.then(frame.filter_by_letter_code, "ن-10")
    steps.then(frame.drop_duplicates, ["symbol"], "last", ["publish_date_time", "tracing_no"])
    steps.df.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame(list(enumerate(steps.log(), 1)), "no int, step string")


@query(
    "stable_sample",
    with_views(
        "letters",
        "SELECT least(count(*), 25) AS rows, true AS contained, true AS repeatable FROM letters",
    ),
)
def stable_sample(spark, path):
    """A sample is the same however the rows are partitioned, and holds rows of the table."""
    rows = letters(spark, path).select(CORE)
    first = frame.sample_rows(rows, 25, 7)
    again = frame.sample_rows(rows.repartition(7, "symbol"), 25, 7).select(F.col("tracing_no").alias("_again"))
    both = first.join(again, F.col("tracing_no") == F.col("_again"), "left")
    known = rows.select(F.col("tracing_no").alias("_known"))
    return both.join(known, F.col("tracing_no") == F.col("_known"), "left").agg(
        F.count(F.lit(1)).alias("rows"),
        F.every(F.col("_known").isNotNull()).alias("contained"),
        F.every(F.col("_again").isNotNull()).alias("repeatable"),
    )

