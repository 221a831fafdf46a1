"""Queries over board tables, pages and graphs."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from filingframe.functions.calendar import to_jalali
from filingframe.functions.text import persian_digits
from filingframe.operators import aggregates as agg
from filingframe.operators import board, buckets, graph
from filingframe.plans.catalog import query
from filingframe.plans.views import Tables, board_members, sql_jalali, text, with_views
from filingframe.session import materialise, shared_dir, spread
from filingframe.sources import html

# ----------------------------------------------------------------- page links


@query(
    "page_links",
    """SELECT page_id, url AS page_url, CASE WHEN href LIKE '/%' THEN 'https://portal.example'
 || href ELSE 'https://portal.example/' || href END AS url, split_part(href, '/', -1) AS filename,
 txt AS text FROM (SELECT page_id, url, regexp_extract(a, 'href="([^"]*)"', 1) AS href,
  trim(regexp_extract(a, '>([^<]*)<', 1)) AS txt FROM (SELECT page_id, url,
   unnest(regexp_extract_all(html, '<a href="[^"]*">[^<]*</a>')) AS a FROM pages))
 WHERE regexp_matches(href, '(?i)^/t') OR regexp_matches(txt, '(?i)en$')""",
)
def page_links(spark, path):
    return html.extract_links(Tables(spark, path).pages, patterns=["^/t", "en$"])


# ------------------------------------------------------------------ board pages


def board_pages(spark, path):
    """A board page per order: a long and a short row; every tenth page has no grid."""
    t = Tables(spark, path)
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    date = to_jalali("o_orderdate")

    def span(name, value):
        return [F.lit(f'<span id="{name}">'), value, F.lit("</span>\n")]

    def row(css, cells):
        out = [F.lit(f'<tr class="{css}">\n')]
        for cell in cells:
            out += [F.lit("<td> "), cell if not isinstance(cell, str) else F.lit(cell), F.lit("\n</td>")]
        return [*out, F.lit("</tr>")]

    long_cells = [
        "", F.concat(F.lit("عضو&nbsp;"), text(cust)), persian_digits(F.lpad(text(cust), 10, "0")),
        "قديم", "فاقد نماینده", "", F.col("o_orderpriority"),
        F.when(key % 2 == 0, "غیر موظف").otherwise("موظف"), "دكترا", F.col("c_mktsegment"),
        "12", "بله", "خیر", "yes", "no", "تایید",
    ]
    short_cells = [
        F.col("c_name"), F.concat(F.lit("<b>rep</b> "), text(key)), F.lpad(text(key), 11, "0"),
        "", "نماینده", F.lpad(text(cust), 10, "0"), "رئیس", "غیر موظف", "-", "-", "خیر", "بله", "",
    ]
    grid = [
        F.lit('<table id="dgAssemblyBoardMember"><tr class="GridHeader"><td>a</td></tr>'),
        *row("GridItem", long_cells),
        *row("GridAlternating", short_cells),
        *row("GridItem", ["only", "three", "cells"]),
        F.lit("</table>"),
    ]
    page = F.concat(
        F.lit("<html><body>"),
        *span("lblCompany", F.col("c_name")),
        *span("txbSessionDate", persian_digits(date)),
        *span("lblAssemblyDate", date),
        *span("lblDMBoardMemberList", F.lit("مدير <i>عامل</i>")),
        F.when(key % 3 == 0, '<a id="ucNavigateToNextPrevLetter_hlPrevVersion" href="/p">p</a>')
        .otherwise(""),
        F.when(key % 10 != 0, F.concat(*grid)).otherwise(""),
        F.lit("</body></html>"),
    )
    orders = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    orders = orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "c_name", "c_mktsegment")
    # dealt out while the rows are short: a small file is one task, and each of its pages is parsed
    return spread(orders).select(F.concat(F.lit("http://p/"), text(key)).alias("url"), page.alias("html"))


MEMBER = [
    "url", "row_no", "year", "month", "date", "assembly_date", "company", "has_previous",
    "prev_member", "new_member", "member_id", "prev_representative", "new_representative",
    "national_id", "position", "is_independent", "degree", "major", "experience",
    "has_multiple_executive", "has_multiple_non_executive", "has_corporate_declaration",
    "has_position_acceptance", "verification_status", "ceo_name",
]
MEMBERS_SQL = f"""
SELECT url, row_no, substr(d, 1, 4) AS year, substr(d, 5, 2) AS month, d AS date,
 d AS assembly_date, c_name AS company, o_orderkey % 3 = 0 AS has_previous,
 CASE row_no WHEN 0 THEN '' ELSE c_name END AS prev_member,
 CASE row_no WHEN 0 THEN 'عضو ' || o_custkey ELSE 'rep ' || o_orderkey END AS new_member,
 CASE row_no WHEN 0 THEN lpad(CAST(o_custkey AS VARCHAR), 10, '0')
  ELSE lpad(CAST(o_orderkey AS VARCHAR), 11, '0') END AS member_id,
 CASE row_no WHEN 0 THEN 'قدیم' ELSE '' END AS prev_representative,
 CASE row_no WHEN 0 THEN 'فاقد نماینده' ELSE 'نماینده' END AS new_representative,
 CASE row_no WHEN 0 THEN '' ELSE lpad(CAST(o_custkey AS VARCHAR), 10, '0') END AS national_id,
 CASE row_no WHEN 0 THEN o_orderpriority ELSE 'رئیس' END AS "position",
 row_no = 1 OR o_orderkey % 2 = 0 AS is_independent,
 CASE row_no WHEN 0 THEN 'دکترا' ELSE '-' END AS degree,
 CASE row_no WHEN 0 THEN c_mktsegment ELSE '-' END AS major,
 CASE row_no WHEN 0 THEN '12' ELSE '' END AS experience,
 row_no = 0 AS has_multiple_executive, row_no = 1 AS has_multiple_non_executive,
 row_no = 0 AS has_corporate_declaration, false AS has_position_acceptance,
 CASE row_no WHEN 0 THEN 'تایید' ELSE '' END AS verification_status, 'مدیر عامل' AS ceo_name
FROM (SELECT *, 'http://p/' || o_orderkey AS url, {sql_jalali("o_orderdate", "")} AS d
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 10 <> 0),
 (VALUES (0), (1)) AS r(row_no)"""


@query("board_records_of_pages", MEMBERS_SQL)
def board_records_of_pages(spark, path):
    parsed = html.parse_board_pages(board_pages(spark, path))
    return board.board_records(html.board_rows(parsed)).select(MEMBER)


@query(
    "board_page_errors",
    "SELECT 'http://p/' || o_orderkey AS url, 'selector_not_found' AS error_type,"
    " true AS recoverable, 1 AS attempt FROM orders WHERE o_orderkey % 10 = 0",
)
def board_page_errors(spark, path):
    errors = html.page_errors(html.parse_board_pages(board_pages(spark, path)))
    return errors.select("url", "error_type", "recoverable", "attempt")


@query(
    "board_load_outcomes",
    """SELECT status, count(*) AS pages FROM (SELECT CASE WHEN o_orderkey % 10 = 0
  THEN 'selector_not_found' ELSE 'ok' END AS status FROM orders
  UNION ALL SELECT 'navigation' FROM customer) GROUP BY status""",
)
def board_load_outcomes(spark, path):
    """A URL list, with repeats, blanks and pages that never landed, against the landed pages."""
    t = Tables(spark, path)
    listed = t.orders.select(F.concat(F.lit(" http://p/"), text("o_orderkey")).alias("url"))
    blank = t.orders.select(F.lit("").alias("url"))
    never = t.customer.select(F.concat(F.lit("http://p/none/"), text("c_custkey")).alias("url"))
    pages = html.pages_of_urls(listed.union(listed).union(blank).union(never), board_pages(spark, path))
    return html.parse_board_pages(pages).groupBy("status").agg(F.count(F.lit(1)).alias("pages"))


@query(
    "board_rows_from_text",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_partkey AS VARCHAR) AS member_id,
 p_name AS new_member, l_linestatus = 'O' AS is_independent,
 CASE WHEN l_linenumber % 2 = 0 THEN p_type ELSE '' END AS experience,
 l_returnflag = 'R' AS has_multiple_executive
 FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_linenumber % 3 <> 0""",
)
def board_rows_from_text(spark, path):
    t = Tables(spark, path)
    line = F.col("l_linenumber")
    yes = F.when(F.col("l_returnflag") == "R", "بله").otherwise("خیر")
    duty = F.when(F.col("l_linestatus") == "O", "عضو غیر موظف").otherwise("موظف")
    head = [F.lit(""), F.col("p_name"), text("l_partkey"), F.lit(""), F.lit(" "), F.lit(""), F.lit("x"), duty,
            F.lit("y"), F.lit("z")]
    tail_long = [F.col("p_type"), yes, F.lit("no"), F.lit("no"), F.lit("no"), F.lit("v")]
    tail_short = [yes, F.lit("1"), F.lit(""), F.lit(" ")]
    row = (
        F.when(line % 3 == 0, F.concat_ws("\t", *head, F.lit(""), F.lit("")))
        .when(line % 2 == 0, F.concat_ws("\t", *head, *tail_long))
        .otherwise(F.concat_ws("\t", *head, *tail_short))
    )
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    parsed = board.parse_rows(rows.select(*keys, row.alias("row_text")))
    return parsed.select(
        *keys, "member_id", "new_member", "is_independent", "experience", "has_multiple_executive"
    )


REP = ["company", "url", "row_no", "member_id", "rep_name", "rep_id", "rep_key", "rep_is_person"]


@query(
    "representatives",
    with_views(
        "board_rep",
        "SELECT company, url, row_no, member_id, rep_name, rep_id, rep_key,"
        " rep_name IS NOT NULL AS rep_is_person FROM board_rep",
    ),
)
def representatives(spark, path):
    return board_members(spark, path).transform(board.representatives).select(REP)


# ---------------------------------------------------------------------- graphs

NODES_SQL = """nodes AS (SELECT id, CASE WHEN role = 0 THEN 'company' ELSE 'person' END AS node_type,
 degree, major FROM (SELECT *, row_number() OVER (PARTITION BY id
  ORDER BY assembly_date, url, row_no, role, degree NULLS FIRST, major NULLS FIRST) AS r
  FROM (SELECT company AS id, 0 AS role, NULL AS degree, NULL AS major, assembly_date, url, row_no
   FROM board UNION ALL SELECT new_member, 1, degree, major, assembly_date, url, row_no FROM board))
 WHERE r = 1)"""
EDGES_SQL = """edges AS (SELECT company, new_member AS person, "position", year, is_independent
 FROM (SELECT *, row_number() OVER (PARTITION BY company, new_member ORDER BY assembly_date DESC,
  url DESC, row_no DESC, "position" DESC, year DESC, is_independent DESC) AS r FROM board)
 WHERE r = 1)"""


@query("graph_nodes", with_views("board", f", {NODES_SQL} SELECT * FROM nodes"))
def graph_nodes(spark, path):
    return graph.graph_nodes(board_members(spark, path))


@query("graph_edges", with_views("board", f", {EDGES_SQL} SELECT * FROM edges"))
def graph_edges(spark, path):
    return graph.graph_edges(board_members(spark, path))


@query(
    "graph_stats",
    with_views(
        "board",
        f""", {NODES_SQL}, {EDGES_SQL}, s AS (SELECT (SELECT count(*) FROM nodes) AS n,
 (SELECT count(*) FROM edges) AS e, (SELECT count(*) FROM nodes WHERE node_type = 'person') AS p)
SELECT 'Total Nodes' AS metric, CAST(n AS DOUBLE) AS value FROM s
UNION ALL SELECT 'Total Edges', e FROM s UNION ALL SELECT 'Companies', n - p FROM s
UNION ALL SELECT 'Board Members', p FROM s
UNION ALL SELECT 'Average Connections per Person', round(2 * e / greatest(p, 1), 2) FROM s
UNION ALL SELECT 'Network Density', round(2 * e / (n * (n - 1)), 4) FROM s""",
    ),
)
def graph_stats(spark, path):
    members = board_members(spark, path)
    return graph.graph_stats(graph.graph_nodes(members), graph.graph_edges(members))


@query(
    "top_connected_people",
    with_views(
        "board",
        f""", {EDGES_SQL} SELECT person, count(*) AS companies FROM edges GROUP BY person
 ORDER BY companies DESC, person LIMIT 5""",
    ),
)
def top_connected_people(spark, path):
    return graph.graph_edges(board_members(spark, path)).transform(graph.top_connected)


PERIODS_SQL = """periods AS MATERIALIZED (SELECT *, 'year' AS grain, year AS period FROM board_rep
 UNION ALL SELECT *, 'quarter', substr(assembly_date, 1, 4) || 'Q' ||
  CAST((CAST(substr(assembly_date, 5, 2) AS INTEGER) - 1) // 3 + 1 AS VARCHAR) FROM board_rep
 UNION ALL SELECT *, 'month', substr(assembly_date, 1, 6) FROM board_rep)"""
SEATS_SQL = f"""{PERIODS_SQL}, seats AS MATERIALIZED (SELECT DISTINCT grain, period, rep_key, company
 FROM periods WHERE rep_name IS NOT NULL),
 named AS MATERIALIZED (SELECT grain, period, rep_key, rep_name, rep_id FROM (SELECT *, row_number() OVER
  (PARTITION BY grain, period, rep_key ORDER BY assembly_date, url, row_no, rep_name, rep_id) AS r
  FROM periods WHERE rep_name IS NOT NULL) WHERE r = 1)"""
PAIRS_SQL = f"""{SEATS_SQL}, pairs AS (SELECT x.grain, x.period, x.company AS a, y.company AS b,
 x.rep_key FROM seats x JOIN seats y USING (grain, period, rep_key) WHERE x.company < y.company)"""


def _months(members):
    """Seats by month, written once: sizes, names and pairs all start from them."""
    return materialise(graph.seat_months(members), "seat-months")


@query(
    "interlock_edges",
    with_views(
        "board_rep",
        f""", {PAIRS_SQL} SELECT grain, period, a, b, rep_name, rep_id, rep_key
 FROM pairs JOIN named USING (grain, period, rep_key)""",
    ),
)
def interlock_edges(spark, path):
    return graph.interlock_edges(_months(board_members(spark, path)))


@query(
    "interlock_groups",
    with_views(
        "board_rep",
        f""", {SEATS_SQL} SELECT grain, period, rep_key, count(*) AS companies,
 CAST(count(*) * (count(*) - 1) / 2 AS BIGINT) AS pairs, any_value(rep_name) AS rep_name,
 any_value(rep_id) AS rep_id FROM seats JOIN named USING (grain, period, rep_key)
 GROUP BY grain, period, rep_key HAVING count(*) >= 2""",
    ),
)
def interlock_groups(spark, path):
    return graph.interlock_groups(_months(board_members(spark, path)))


@query(
    "interlock_weights",
    with_views(
        "board_rep",
        f""", {PAIRS_SQL} SELECT grain, period, a, b, count(*) AS shared
 FROM pairs GROUP BY ALL""",
    ),
)
def interlock_weights(spark, path):
    return graph.interlock_weights(_months(board_members(spark, path)))


OVERVIEW_SQL = with_views(
    "board_rep",
    f""", {SEATS_SQL}, g AS (SELECT grain, period, rep_key, count(*) AS c FROM seats
  GROUP BY ALL HAVING count(*) >= 2)
SELECT grain, period, people, edges, companies FROM
 (SELECT grain, period, count(*) AS people, CAST(sum(c * (c - 1) / 2) AS BIGINT) AS edges
  FROM g GROUP BY ALL) JOIN
 (SELECT grain, period, count(DISTINCT company) AS companies FROM periods GROUP BY ALL)
 USING (grain, period)""",
)


def _counted(groups):
    """What the overview reads of the groups, written once: nodes and counts start from it."""
    return materialise(groups.select("grain", "period", "pairs"), "groups")


@query("report_interlock_periods", OVERVIEW_SQL)
def report_interlock_periods(spark, path):
    members = board_members(spark, path)
    groups = _counted(graph.interlock_groups(_months(members)))
    return graph.period_overview(groups, graph.period_nodes(members, groups))


@query("stored_interlock_periods", OVERVIEW_SQL)
def stored_interlock_periods(spark, path):
    """The same from seats that lie in buckets of person and company."""
    members = board_members(spark, path)
    folder = f"{shared_dir(spark)}/seats-{uuid.uuid4().hex}"
    seats = buckets.write(_months(members), folder, graph.SEAT)
    groups = _counted(graph.interlock_groups(seats))
    return graph.period_overview(groups, graph.period_nodes(members, groups))


# --------------------------------------------------------------------- reports


@query(
    "board_summary",
    with_views(
        "board",
        """, s AS (SELECT * FROM board)
SELECT 'Total Records' AS metric, CAST(count(*) AS VARCHAR) AS value FROM s
UNION ALL SELECT 'Unique Companies', CAST(count(DISTINCT company) AS VARCHAR) FROM s
UNION ALL SELECT 'Unique Board Members', CAST(count(DISTINCT new_member) AS VARCHAR) FROM s
UNION ALL SELECT 'Date Range', min(date) || ' - ' || max(date) FROM s
UNION ALL SELECT 'Independent Members', CAST(count(*) FILTER (is_independent) AS VARCHAR) FROM s
UNION ALL SELECT 'Members with Multiple Executive Roles',
 CAST(count(*) FILTER (has_multiple_executive) AS VARCHAR) FROM s
UNION ALL SELECT 'URLs Processed', CAST(count(DISTINCT url) + (SELECT count(*) FROM pages)
 AS VARCHAR) FROM s
UNION ALL SELECT 'URLs Succeeded', CAST(count(DISTINCT url) AS VARCHAR) FROM s
UNION ALL SELECT 'URLs Failed', CAST(count(*) AS VARCHAR) FROM pages
UNION ALL SELECT 'Error Count', CAST(count(*) AS VARCHAR) FROM pages""",
    ),
)
def board_summary(spark, path):
    pages = Tables(spark, path).pages
    keyed = pages.select(F.concat(F.lit("page "), text("page_id")).alias("url"), "html")
    errors = html.page_errors(html.parse_board_pages(keyed))
    return agg.board_summary(board_members(spark, path), errors)


@query(
    "report_board_analysis",
    with_views(
        "board",
        """SELECT * FROM (SELECT 'position' AS field, "position" AS value, count(*) AS count
  FROM board GROUP BY 2 ORDER BY count DESC, value LIMIT 10)
 UNION ALL SELECT * FROM (SELECT 'degree', degree, count(*) AS c FROM board GROUP BY 2
  ORDER BY c DESC, degree LIMIT 10)
 UNION ALL SELECT 'independent', 'true', count(*) FROM board WHERE is_independent
 UNION ALL SELECT 'companies', '', count(DISTINCT company) FROM board""",
    ),
)
def report_board_analysis(spark, path):
    members = board_members(spark, path)

    def top(column):
        return agg.top_values(members, column).select(
            F.lit(column).alias("field"), F.col(column).alias("value"), "count"
        )

    independent = members.where("is_independent").agg(F.count(F.lit(1)).alias("count"))
    companies = agg.distinct_count(members, "company")
    return (
        top("position")
        .unionByName(top("degree"))
        .unionByName(
            independent.select(F.lit("independent").alias("field"), F.lit("true").alias("value"), "count")
        )
        .unionByName(
            companies.select(
                F.lit("companies").alias("field"), F.lit("").alias("value"), F.col("company").alias("count")
            )
        )
    )
