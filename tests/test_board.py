"""Pages, rows, representatives, graphs and interlocks."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from filingframe.operators import board, graph
from filingframe.sources import html

GRID = """<html><body><span id="lblCompany">شركت&nbsp;الف<b> (الف)</b></span>
<span id=txbSessionDate>۱۴۰۲/۰۵/۱۵</span><span id="lblAssemblyDate">1402/05/10</span>
<a id="ucNavigateToNextPrevLetter_hlNewVersion" href="/n">n</a>
<table id="dgAssemblyBoardMember"><tbody>
<tr class="GridHeader"><th>a<th>b</tr>
<tr class="GridItem"><td>p<td>n &amp; m<td>۰۰۱<td><td><td><td>x<td>عضو غير موظف<td>d<td>m<td>بله<td>no<td></tr>
<tr class="other"><td>p</td><td>q</td></tr>
<tr class="GridAlternating"><td><table><tr><td>nested</td></tr></table></td><td>z</td></tr>
</table><table><tr class="GridItem"><td>elsewhere</td></tr></table></body>"""


def test_board_page(spark):
    pages = spark.createDataFrame([("u", GRID), ("v", "<p>no grid</p>"), ("w", None)], "url string, html string")
    parsed = {r["url"]: r for r in html.parse_board_pages(pages).collect()}
    assert {u: r["status"] for u, r in parsed.items()} == {
        "u": "ok", "v": "selector_not_found", "w": "navigation",
    }
    page = parsed["u"]
    assert (page["has_previous"], page["has_next"]) == (False, True)
    assert page["labels"]["company"] == "شركت الف (الف)"
    assert [r.split("\t")[1] for r in page["rows"]] == ["n & m", "q", "z"]
    errors = html.page_errors(html.parse_board_pages(pages)).collect()
    assert sorted((r["url"], r["error_type"], r["recoverable"], r["attempt"]) for r in errors) == [
        ("v", "selector_not_found", True, 1), ("w", "navigation", True, 1),
    ]
    (record,) = board.board_records(html.board_rows(html.parse_board_pages(pages))).collect()
    assert record["company"] == "شرکت الف (الف)"
    assert (record["date"], record["year"], record["month"]) == ("14020515", "1402", "05")
    assert record["assembly_date"] == "14020510"
    assert (record["member_id"], record["new_member"], record["is_independent"]) == ("001", "n & m", True)
    assert (record["has_multiple_executive"], record["has_multiple_non_executive"]) == (True, False)


def test_unclosed_and_odd_html_never_fails(spark):
    odd = ["<table id=dgAssemblyBoardMember><tr><td>a", "<", "<a href", "<!-- ", "</td></tr>", "<![x", ""]
    pages = spark.createDataFrame([(str(i), h) for i, h in enumerate(odd)], "url string, html string")
    statuses = {r["url"]: r["status"] for r in html.parse_board_pages(pages).collect()}
    assert statuses["0"] == "ok"
    assert html.extract_links(pages).count() == 0


def test_links(spark):
    page = """<a href="/f/one.xlsx">one</a><a href='two.XLS'>two</a><a href="/get/">the Excel file</a>
    <a href="/no">no</a><a name="x">anchor.xls</a><iframe src="http://h/three.xls"></iframe>
    <embed src="/four.xlsx?x"><a href="/excel/5"> five <b>bold</b> </a><a href="/open/excel">open"""
    pages = spark.createDataFrame([(1, "p", page)], "page_id int, url string, html string")
    found = [(r["url"], r["filename"], r["text"]) for r in html.extract_links(pages, base_url="https://b").collect()]
    assert found == [
        ("https://b/f/one.xlsx", "one.xlsx", "one"),
        ("https://b/two.XLS", "two.XLS", "two"),
        ("https://b/get/", "the Excel file", "the Excel file"),
        ("http://h/three.xls", "three.xls", ""),
        ("https://b/excel/5", "5", "fivebold"),
        ("https://b/open/excel", "excel", "open"),
    ]


def cells(n, **at):
    return "\t".join(at.get(f"c{i}", f"v{i}") for i in range(n))


def test_row_layouts(spark):
    rows = [
        ("short", cells(11)),
        ("old", cells(12, c2="۱۲ ", c7="غیر موظف", c10="بله", c11="خیر")),
        ("old_tail", cells(15, c0="", c3="", c10="yes", c11="1", c12="", c13=" ", c14="")),
        ("long", cells(16, c7="موظف", c10="12", c11="بله", c12="no", c13="TRUE", c14="x", c15="ok")),
        ("padded", cells(10) + "\t\t \t  "),
    ]
    df = spark.createDataFrame(rows, "url string, row_text string")
    got = {r["url"]: r for r in board.parse_rows(df).collect()}
    assert set(got) == {"old", "old_tail", "long"}
    old, tail, long = got["old"], got["old_tail"], got["long"]
    assert (old["member_id"], old["is_independent"], old["experience"]) == ("12", True, "")
    assert (old["has_multiple_executive"], old["has_multiple_non_executive"]) == (True, False)
    assert (tail["prev_member"], tail["prev_representative"], tail["new_member"]) == ("", "", "v1")
    assert (tail["has_multiple_executive"], tail["has_multiple_non_executive"]) == (True, True)
    assert tail["has_corporate_declaration"] is False
    assert (long["experience"], long["verification_status"]) == ("12", "ok")
    assert [long[c] for c in ("has_multiple_executive", "has_multiple_non_executive",
                              "has_corporate_declaration", "has_position_acceptance")] == [
        True, False, True, False]


def test_whole_row_normalisation_equals_cell_by_cell(spark):
    from filingframe.functions.text import norm_cells, norm_text

    raw = ["  ي‌ ك ", "", "   ", "a \x1f b", "‏", "ة  ء", "x"]
    df = spark.createDataFrame([("\t".join(raw),)], "row string")
    each = [norm_text(F.get(F.split("row", "\t"), F.lit(i))) for i in range(len(raw))]
    row = df.select(norm_cells("row").alias("whole"), F.array(*each).alias("each")).first()
    assert row["whole"] == row["each"]


@pytest.mark.parametrize(
    ("member_id", "national_id", "rep", "member", "name", "key"),
    [
        ("0012345678", None, "نماینده", "شرکت", "نماینده", "0012345678"),
        ("0012345678", None, "فاقد نماینده", "شرکت", "شرکت", "0012345678"),
        ("0012345678", None, " ", "شرکت", "شرکت", "0012345678"),
        ("123", "۰۰۹۸۷۶۵۴۳۲", None, "شخص", "شخص", "0098765432"),
        ("123", "456", "نماینده", "شرکت", None, None),
        ("0012345678", None, None, None, None, "0012345678"),
    ],
)
def test_representatives(spark, member_id, national_id, rep, member, name, key):
    df = spark.createDataFrame(
        [(member_id, national_id, rep, member)],
        "member_id string, national_id string, new_representative string, new_member string",
    )
    row = board.representatives(df).first()
    assert (row["rep_name"], row["rep_key"], row["rep_is_person"]) == (name, key, name is not None)


def members(spark, rows):
    columns = ("company new_member member_id national_id new_representative assembly_date year url "
               "row_no position is_independent degree major").split()  # fmt: skip
    kinds = {"row_no": "int", "is_independent": "boolean"}
    schema = ", ".join(f"{c} {kinds.get(c, 'string')}" for c in columns)
    full = [
        (c, m, i, "", "", d, d[:4], "u", n, f"p{n}", n % 2 == 0, f"deg{n}", "maj")
        for n, (c, m, i, d) in enumerate(rows)
    ]
    return spark.createDataFrame(full, schema)


def test_graph_first_node_and_last_edge(spark):
    df = members(spark, [("A", "x", "1", "14020101"), ("B", "x", "1", "14020201"), ("A", "x", "1", "14030101"),
                         ("A", "B", "1", "14030102"), ("C", "", "1", "14030103")])
    nodes = {r["id"]: (r["node_type"], r["degree"]) for r in graph.graph_nodes(df).collect()}
    assert nodes == {"A": ("company", None), "B": ("company", None), "x": ("person", "deg0")}
    edges = {(r["company"], r["person"]): (r["position"], r["year"]) for r in graph.graph_edges(df).collect()}
    assert edges == {("A", "x"): ("p2", "1403"), ("B", "x"): ("p1", "1402"), ("A", "B"): ("p3", "1403")}
    stats = {r["metric"]: r["value"] for r in graph.graph_stats(graph.graph_nodes(df), graph.graph_edges(df)).collect()}
    assert stats == {"Total Nodes": 3, "Total Edges": 3, "Companies": 2, "Board Members": 1,
                     "Average Connections per Person": 6.0, "Network Density": 1.0}


@pytest.mark.parametrize("block", [2, 7, 512])
def test_interlocks_of_a_hot_person_equal_brute_force(spark, block):
    rows = [(f"c{i:02d}", "hot", "0000000001", f"1402{i % 3 + 1:02d}01") for i in range(40)]
    rows += [(f"c{i:02d}", f"m{i % 5}", f"000000001{i % 5}", "14030501") for i in range(20)]
    rows += rows[:15] + [("solo", "s", "0000000099", "14020101"), ("c00", "firm", "77", "14020101")]
    months = graph.seat_months(members(spark, rows))
    edges = graph.interlock_edges(months, block=block).collect()
    got = {(r["grain"], r["period"], r["a"], r["b"], r["rep_key"]) for r in edges}
    seats = defaultdict(set)
    for company, _, person, date in rows:
        if len(person) == 10:
            quarter = f"{date[:4]}Q{(int(date[4:6]) - 1) // 3 + 1}"
            for grain, period in (("year", date[:4]), ("quarter", quarter), ("month", date[:6])):
                seats[grain, period, person].add(company)
    wanted = {(g, p, a, b, k) for (g, p, k), cs in seats.items() for a, b in combinations(sorted(cs), 2)}
    assert got == wanted and len(edges) == len(wanted)
    groups = graph.interlock_groups(months)
    assert groups.agg(F.sum("pairs")).first()[0] == len(wanted)
    weights = graph.interlock_weights(months, block=block)
    counted = Counter((g, p, a, b) for g, p, a, b, _ in wanted)
    assert {tuple(r[:4]): r["shared"] for r in weights.collect()} == counted


def test_pairs_are_counted_in_numbers(spark):
    rows = [(f"c{i}", "x", "0000000001", f"1402{m}01") for i in range(3) for m in ("01", "02")]
    months = graph.seat_months(members(spark, rows))
    plan = graph.interlock_weights(months)._jdf.queryExecution().optimizedPlan().toString()
    summed = next(line for line in plan.splitlines() if "count(1)" in line and "period_no" in line and "b_no" in line)
    assert "rep_key" not in summed and "rep_name" not in summed


def test_people_with_few_seats_are_dealt_once(spark):
    rows = [(f"c{i % 9}", "x", f"000000000{i % 7}", f"1402{i % 12 + 1:02d}01") for i in range(200)]
    months = graph.seat_months(members(spark, rows)).cache()
    few, many = graph.interlock_groups(months), graph.interlock_groups(months, most=5)
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect())) and few.count() > 7
    # months move once, by person, and are counted there
    plan = graph.interlock_groups(months)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_COL") == 1
    quiet, busy = graph._by_person(months, "rep_key", 28)
    known = {r["rep_key"]: r["count"] for r in months.groupBy("rep_key").count().collect()}
    assert {r["rep_key"] for r in quiet.collect()} == {k for k, n in known.items() if n <= 28}
    assert {r["rep_key"] for r in busy.collect()} == {k for k, n in known.items() if n > 28}


def test_a_seat_without_a_year_counts_in_its_month(spark):
    rows = [("a", "x", "0000000001", "14020101"), ("b", "x", "0000000001", "14020101")]
    seats = members(spark, rows).withColumn("year", F.lit(None).cast("string"))
    months = graph.seat_months(seats)
    found = sorted(tuple(r) for r in graph.interlock_weights(months).collect())
    assert found == [("month", "140201", "a", "b", 1), ("quarter", "1402Q1", "a", "b", 1)]
    assert graph.interlock_weights(months.limit(0)).count() == 0


def test_a_broken_page_keeps_its_links_and_gives_an_error(spark):
    pages = spark.createDataFrame(
        [("u1", '<a href="/x.xls">a</a><![foo[x]]><a href="/y.xls">b</a>'), ("u2", '<a href="z.xlsx">c</a>'), ("u3", None)],
        "url string, html string",
    )
    found = html.extract_links(pages, base_url="https://b").collect()
    assert sorted((r["page_url"], r["filename"]) for r in found) == [("u1", "x.xls"), ("u2", "z.xlsx")]
    errors = html.link_errors(pages).collect()
    assert [(r["url"], r["error_type"]) for r in errors] == [("u1", "parsing")]


def test_newest_landing_of_a_page(spark):
    urls = spark.createDataFrame([("http://a",), (" http://a ",), ("http://b",), ("",)], "url string")
    pages = spark.createDataFrame(
        [("http://a", "old", 1), ("http://a", "new", 2), ("http://c", "x", 1)], "url string, html string, day int"
    )
    found = {r["url"]: r["html"] for r in html.pages_of_urls(urls, pages, landed="day").collect()}
    assert found == {"http://a": "new", "http://b": None}
    plan = html.pages_of_urls(urls, pages)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan


def test_regular_markup_is_read_as_the_parser_reads_it():
    """Pages in pieces of markup, regular or not: one pattern or HTMLParser, the same labels, rows and links."""
    rng = random.Random(7)
    bits = [
        '<table id="dgAssemblyBoardMember">', '<tr class="GridItem">', "<tr>", "</tr>", "<td>", "</td>", "<td> a&nbsp;b </td>",
        "<th class='x'>c</th>", "</table>", '<span ID="lblCompany">', "</span>", '<a href="x&amp;y">', "</a>", "<a href>t</a>",
        "<br>", "<br/>", "<br>u</br>", "<p id=lblAssemblyDate>", "text", "&lt;", "&", "<", " ", "<!-- c -->", "<TD>", "<script>",
        "</script>", '<embed src="e">', '<div id="p" id="lblCompany">', "</div>", "<title>", "x<y", "<![foo[x]]>",
    ]

    class Slow:
        def read(self, page):
            self.feed(page)
            self.close()

    def seen(scanner, page):
        try:
            scanner.read(page)
        except (AssertionError, ValueError):
            return None
        if isinstance(scanner, html._Links):
            return scanner.found
        ids = {k: html._squeezed(v) for k, v in scanner.ids.items()}
        return ids, [[html._squeezed(c) for c in row] for row in scanner.rows], scanner.open

    read = 0
    for _ in range(4000):
        page = "".join(rng.choices(bits[:2], k=2) + rng.choices(bits, k=rng.randrange(1, 14)))
        for kind in (html._Board, html._Links):
            slow = type("Slow" + kind.__name__, (Slow, kind), {})
            assert seen(kind(), page) == seen(slow(), page), page
        read += all(not token[-1] for token in html._TOKENS.findall(page))
    assert read > 400


def test_pages_of_a_small_file_are_dealt_to_all_tasks(spark, tmp_path):
    """One file of short orders is one task; its pages are parsed in many."""
    from filingframe.plans import board_queries

    orders = spark.range(200).selectExpr(
        "id as o_orderkey", "id % 3 as o_custkey", "timestamp'1996-01-02' as o_orderdate", "'1-URGENT' as o_orderpriority"
    )
    orders.coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    customers = spark.range(3).selectExpr("id as c_custkey", "concat('c', id) as c_name", "'m' as c_mktsegment")
    customers.write.parquet(f"{tmp_path}/customer.parquet")
    parsed = html.parse_board_pages(board_queries.board_pages(spark, str(tmp_path)))
    tasks = parsed.groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) == max(4, spark.sparkContext.defaultParallelism) and sum(r["count"] for r in tasks) == 200
