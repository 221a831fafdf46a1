"""The domain tables, derived from the driver's tables, as DataFrames and as SQL.

Each view exists twice: a DataFrame for Spark and a common table expression for
the SQL check. Both read whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filingframe import dims
from filingframe.functions.calendar import d_even, to_jalali
from filingframe.functions.text import ColumnOrName, as_col
from filingframe.functions.urls import DEFAULT_BASE_URL

BASE = DEFAULT_BASE_URL


class Tables:
    """Lazy readers of one data folder: ``Tables(spark, path).orders``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}.parquet")


def text(c: ColumnOrName) -> Column:
    return as_col(c).cast("string")


def two(c: Column) -> Column:
    return F.lpad(text(c), 2, "0")


# ------------------------------------------------------------- SQL fragments


def sql_jalali(ts: str, sep: str = "/") -> str:
    """Jalali text of a timestamp, by the same public 33-year arithmetic."""
    n = f"(datediff('day', DATE '1970-01-01', CAST({ts} AS DATE)) + 492633)"
    y = f"((33*{n}+11) // 12053)"
    doy = f"({n} - 365*{y} - ((8*{y}+21) // 33))"
    m = f"(CASE WHEN {doy} < 186 THEN {doy} // 31 ELSE ({doy}-6) // 30 END)"
    d = f"({doy} - 30*{m} - least({m}, 6) + 1)"
    return (
        f"(CAST({y} AS VARCHAR) || '{sep}' || lpad(CAST({m}+1 AS VARCHAR), 2, '0')"
        f" || '{sep}' || lpad(CAST({d} AS VARCHAR), 2, '0'))"
    )


def sql_values(rows: list[tuple[str, str]]) -> str:
    return ", ".join("('" + a + "', '" + b + "')" for a, b in rows)


_SQL: dict[str, tuple[tuple[str, ...], str]] = {}


def with_views(names: str, body: str) -> str:
    """``WITH view AS (...), ... body`` including what the views depend on."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in _SQL[name][0]:
            add(need)
        if name not in order:
            order.append(name)

    for name in names.split():
        add(name)
    ctes = ",\n".join(f"{n} AS ({_SQL[n][1]})" for n in order)
    return f"WITH RECURSIVE {ctes}\n{body}"


# -------------------------------------------------------------------- letters

PRIORITY_CODES = {
    "1-URGENT": "ن-10",
    "2-HIGH": "ن-30",
    "3-MEDIUM": "ن-45",
    "4-NOT SPECIFIED": "ن-52",
    "5-LOW": "ن-99",
}


def letters(spark: SparkSession, path: str) -> DataFrame:
    t = Tables(spark, path)
    orders, customer, nation = t.orders, t.customer, t.nation
    key, nk, ck = F.col("o_orderkey"), F.col("c_nationkey"), F.col("o_custkey")
    code = F.lit(None).cast("string")
    for priority, value in PRIORITY_CODES.items():
        code = F.when(F.col("o_orderpriority") == priority, value).otherwise(code)
    clock = F.concat_ws(":", two(key % 24), two(key % 60), two((key + 7) % 60))
    serial = text("o_orderkey")
    url = (
        F.when(key % 4 == 0, "")
        .when(key % 4 == 2, F.concat(F.lit(f"{BASE}/r/"), serial))
        .when(key % 4 == 3, F.concat(F.lit("/Reports/Decision.aspx?LetterSerial="), serial))
    )
    excel = F.when(key % 3 != 0, F.concat(F.lit("/excel/"), serial, F.lit(".xls")))
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            serial.alias("tracing_no"),
            F.col("n_name").alias("symbol"),
            F.col("c_name").alias("company_name"),
            F.concat_ws(" ", "c_mktsegment", "o_orderpriority").alias("title"),
            code.alias("letter_code"),
            F.concat_ws(" ", to_jalali("o_orderdate"), clock).alias("publish_date_time"),
            to_jalali("o_orderdate").alias("sent_date_time"),
            url.alias("url"),
            excel.alias("excel_url"),
            excel.isNotNull().alias("has_excel"),
            (F.col("o_orderstatus") == "F").alias("audited"),
            (key % 2 == 0).alias("consolidated"),
            (ck % 4 == 0).alias("is_child"),
            (ck % 10 == 0).alias("is_publisher"),
            (nk % 3 + 1).cast("int").alias("company_type"),
            ((key % 4 + 1) * 3).cast("int").alias("period_length"),
            F.lpad(text(nk), 4, "0").alias("isic"),
            F.col("o_totalprice").alias("amount"),
        )
    )


_SQL["letters"] = (
    (),
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS tracing_no, n_name AS symbol, c_name AS company_name,
 c_mktsegment || ' ' || o_orderpriority AS title,
 CASE o_orderpriority {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PRIORITY_CODES.items())} END
   AS letter_code,
 {sql_jalali("o_orderdate")} || ' ' || lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || ':'
   || lpad(CAST(o_orderkey % 60 AS VARCHAR), 2, '0') || ':'
   || lpad(CAST((o_orderkey + 7) % 60 AS VARCHAR), 2, '0') AS publish_date_time,
 {sql_jalali("o_orderdate")} AS sent_date_time,
 CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 2 THEN '{BASE}/r/' || o_orderkey
   WHEN 3 THEN '/Reports/Decision.aspx?LetterSerial=' || o_orderkey END AS url,
 CASE WHEN o_orderkey % 3 <> 0 THEN '/excel/' || o_orderkey || '.xls' END AS excel_url,
 o_orderkey % 3 <> 0 AS has_excel,
 o_orderstatus = 'F' AS audited, o_orderkey % 2 = 0 AS consolidated,
 o_custkey % 4 = 0 AS is_child, o_custkey % 10 = 0 AS is_publisher,
 CAST(c_nationkey % 3 + 1 AS INTEGER) AS company_type,
 CAST((o_orderkey % 4 + 1) * 3 AS INTEGER) AS period_length,
 lpad(CAST(c_nationkey AS VARCHAR), 4, '0') AS isic,
 o_totalprice AS amount
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
)

_SQL["letter_codes"] = (
    (),
    "SELECT * FROM (VALUES "
    + sql_values(list(dims.LETTER_CODES.items()))
    + ") AS v(letter_code, letter_description)",
)

# -------------------------------------------------------------- board members

NO_REPRESENTATIVE = "فاقد نماینده"


def board_members(spark: SparkSession, path: str) -> DataFrame:
    t = Tables(spark, path)
    part = F.col("l_partkey")
    line = F.col("l_linenumber")
    date = to_jalali("l_shipdate", "")
    representative = (
        F.when(line % 4 == 0, NO_REPRESENTATIVE)
        .when(line % 4 == 1, "")
        .when(line % 4 == 3, F.concat(F.lit("نماینده "), F.col("p_name")))
    )
    return (
        t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("s_name").alias("company"),
            F.col("p_name").alias("new_member"),
            F.when(part % 5 == 0, F.lpad(text(part), 9, "0"))
            .otherwise(F.lpad(text(part), 10, "0"))
            .alias("member_id"),
            F.when(part % 10 == 0, F.lpad(text(part), 10, "0")).otherwise("").alias("national_id"),
            representative.alias("new_representative"),
            date.alias("assembly_date"),
            date.alias("date"),
            F.substring(date, 1, 4).alias("year"),
            F.col("l_returnflag").alias("position"),
            (F.col("l_linestatus") == "O").alias("is_independent"),
            (line % 2 == 0).alias("has_multiple_executive"),
            F.col("p_brand").alias("degree"),
            F.col("p_type").alias("major"),
            F.concat(F.lit("/boards/"), text("l_orderkey")).alias("url"),
            line.alias("row_no"),
        )
    )


_SQL["board"] = (
    (),
    f"""SELECT *, substr(assembly_date, 1, 4) AS year, assembly_date AS date FROM (
 SELECT s_name AS company, p_name AS new_member,
  CASE WHEN l_partkey % 5 = 0 THEN lpad(CAST(l_partkey AS VARCHAR), 9, '0')
       ELSE lpad(CAST(l_partkey AS VARCHAR), 10, '0') END AS member_id,
  CASE WHEN l_partkey % 10 = 0 THEN lpad(CAST(l_partkey AS VARCHAR), 10, '0') ELSE '' END
    AS national_id,
  CASE l_linenumber % 4 WHEN 0 THEN '{NO_REPRESENTATIVE}' WHEN 1 THEN ''
    WHEN 3 THEN 'نماینده ' || p_name END AS new_representative,
  {sql_jalali("l_shipdate", "")} AS assembly_date,
  l_returnflag AS "position", l_linestatus = 'O' AS is_independent,
  l_linenumber % 2 = 0 AS has_multiple_executive, p_brand AS degree, p_type AS major,
  '/boards/' || l_orderkey AS url, l_linenumber AS row_no
 FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey)""",
)

# Identity of the person behind a board row, by the rules of the representative operator.
_SQL["board_rep"] = (
    ("board",),
    f"""SELECT *, CASE WHEN rep_id IS NOT NULL THEN rep_id ELSE rep_name END AS rep_key FROM (
 SELECT *, CASE WHEN length(member_id) = 10 THEN member_id
   WHEN length(national_id) = 10 THEN national_id END AS rep_id,
  CASE WHEN NOT (length(member_id) = 10 OR length(national_id) = 10) THEN NULL
   WHEN coalesce(new_representative, '') NOT IN ('', '{NO_REPRESENTATIVE}')
     THEN new_representative
   ELSE nullif(new_member, '') END AS rep_name
 FROM board)""",
)

# ------------------------------------------------- instruments and shareholders


def instruments(spark: SparkSession, path: str) -> DataFrame:
    s = Tables(spark, path).supplier
    key = text("s_suppkey")
    return s.select(
        F.concat(F.lit("S"), key).alias("symbol"),
        key.alias("ins_code"),
        F.when(F.col("s_suppkey") % 7 != 0, F.lpad(text("s_nationkey"), 2, "0"))
        .otherwise(" ")
        .alias("isic_code"),
        F.concat(F.lit("sector "), text("s_nationkey")).alias("sector_name"),
        (F.col("s_suppkey") * 1000).alias("z_titad"),
    )


def aliases(spark: SparkSession, path: str) -> DataFrame:
    key = text("s_suppkey")
    return Tables(spark, path).supplier.select(
        F.concat(F.lit("A"), key).alias("alias"), key.alias("ins_code")
    )


def corrections(spark: SparkSession, path: str) -> DataFrame:
    key = text("n_nationkey")
    return Tables(spark, path).nation.select(
        F.concat(F.lit("C"), key).alias("symbol"),
        F.concat(F.lit("S"), key).alias("symbol_true"),
        F.col("n_nationkey").alias("line"),
    )


def holders(spark: SparkSession, path: str) -> DataFrame:
    return Tables(spark, path).lineitem.select(
        text("l_suppkey").alias("ins_code"),
        d_even("l_shipdate").alias("d_even"),
        F.concat(F.lit("holder "), text("l_partkey")).alias("shareHolderName"),
        F.col("l_quantity").alias("perOfShares"),
        F.concat_ws("-", text("l_orderkey"), text("l_linenumber")).alias("shareHolderShareID"),
    )


def prices(spark: SparkSession, path: str) -> DataFrame:
    """A row a day, without a price on every third; zero closing prices fall back to ``pc``."""
    li = Tables(spark, path).lineitem
    day = d_even("l_shipdate")
    traded = F.when(F.dayofyear("l_shipdate") % 3 != 0, F.col("l_extendedprice"))
    return (
        li.withColumn("traded", traded)
        .groupBy(text("l_suppkey").alias("ins_code"), day.alias("d_even"))
        .agg(
            F.max(
                F.when(F.col("l_quantity") > 10, F.col("traded")).when(F.col("traded").isNotNull(), 0.0)
            ).alias("pClosing"),
            F.max("traded").alias("pc"),
        )
    )


def assemblies(spark: SparkSession, path: str) -> DataFrame:
    key, cust = F.col("o_orderkey"), F.col("o_custkey")

    def tag(letter: str, c: Column) -> Column:
        return F.concat(F.lit(letter), text(c))

    inside = (
        F.when(key % 4 == 0, tag("Z", key % 50))
        .when(key % 4 == 1, tag("S", cust % 100))
        .when(key % 4 == 2, tag("A", cust % 100))
        .otherwise("")
    )
    head = (
        F.when(key % 3 == 0, tag("A", (cust + 3) % 100))
        .when(key % 3 == 1, tag("C", cust % 25))
        .otherwise(tag("S", (cust + 7) % 100))
    )
    company = F.concat(
        F.lit("شرکت "), text(key), F.lit(" - نماد: "), head, F.lit("("), inside, F.lit(")")
    )
    date = F.when(key % 97 == 0, "1375/13/01").otherwise(to_jalali("o_orderdate"))
    return Tables(spark, path).orders.select(
        F.when(key % 89 == 0, F.concat(F.lit("شرکت "), text(key))).otherwise(company).alias(
            "company"
        ),
        date.alias("assembly_date"),
    )


_SQL["instruments"] = (
    (),
    """SELECT 'S' || s_suppkey AS symbol, CAST(s_suppkey AS VARCHAR) AS ins_code,
 CASE WHEN s_suppkey % 7 <> 0 THEN lpad(CAST(s_nationkey AS VARCHAR), 2, '0') END AS isic_code,
 'sector ' || s_nationkey AS sector_name, s_suppkey * 1000 AS z_titad FROM supplier""",
)
_SQL["resolvable"] = (
    ("instruments",),
    """SELECT symbol AS name, * EXCLUDE (symbol) FROM instruments
 UNION ALL SELECT 'A' || ins_code AS name, * EXCLUDE (symbol) FROM instruments""",
)
_SQL["holders"] = (
    (),
    """SELECT CAST(l_suppkey AS VARCHAR) AS ins_code, CAST(l_shipdate AS DATE) AS day,
 'holder ' || l_partkey AS shareHolderName, l_quantity AS perOfShares,
 l_orderkey || '-' || l_linenumber AS shareHolderShareID FROM lineitem""",
)
_SQL["prices"] = (
    (),
    """SELECT CAST(l_suppkey AS VARCHAR) AS ins_code, CAST(l_shipdate AS DATE) AS day,
 max(CASE WHEN dayofyear(l_shipdate) % 3 <> 0
   THEN CASE WHEN l_quantity > 10 THEN l_extendedprice ELSE 0 END END) AS pClosing,
 max(CASE WHEN dayofyear(l_shipdate) % 3 <> 0 THEN l_extendedprice END) AS pc
FROM lineitem GROUP BY ALL""",
)
# Raw assemblies with their two candidate texts and the Gregorian day.
_SQL["assemblies"] = (
    (),
    f"""SELECT o_orderkey,
 CASE WHEN o_orderkey % 89 = 0 THEN 'شرکت ' || o_orderkey
  ELSE 'شرکت ' || o_orderkey || ' - نماد: ' || head || '(' || inside || ')' END AS company,
 CASE WHEN o_orderkey % 97 = 0 THEN '1375/13/01' ELSE {sql_jalali("o_orderdate")} END
   AS assembly_date,
 CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS day,
 CASE WHEN o_orderkey % 89 = 0 THEN '' ELSE inside END AS first_candidate,
 CASE WHEN o_orderkey % 89 = 0 THEN '' WHEN head LIKE 'C%' THEN 'S' || substr(head, 2)
  ELSE head END AS second_candidate
FROM (SELECT *, CASE o_orderkey % 4 WHEN 0 THEN 'Z' || (o_orderkey % 50)
   WHEN 1 THEN 'S' || (o_custkey % 100) WHEN 2 THEN 'A' || (o_custkey % 100) ELSE '' END AS inside,
  CASE o_orderkey % 3 WHEN 0 THEN 'A' || ((o_custkey + 3) % 100)
   WHEN 1 THEN 'C' || (o_custkey % 25) ELSE 'S' || ((o_custkey + 7) % 100) END AS head
 FROM orders)""",
)
# One row per candidate that is tried, in order, without duplicates.
_SQL["candidates"] = (
    ("assemblies",),
    """SELECT company, assembly_date, day, 1 AS pos, first_candidate AS name FROM assemblies
  WHERE first_candidate <> ''
 UNION ALL SELECT company, assembly_date, day,
   CASE WHEN first_candidate = '' THEN 1 ELSE 2 END, second_candidate FROM assemblies
  WHERE second_candidate <> '' AND second_candidate <> first_candidate""",
)
_SQL["attempts"] = (
    ("candidates", "resolvable", "holders"),
    """SELECT c.*, r.ins_code, r.isic_code, r.sector_name, r.z_titad,
  (SELECT min(h.day) FROM (SELECT DISTINCT ins_code, day FROM holders) h
    WHERE h.ins_code = r.ins_code AND h.day BETWEEN c.day AND c.day + 2) AS hit_day
 FROM candidates c LEFT JOIN resolvable r ON r.name = c.name""",
)
_SQL["outcomes"] = (
    ("attempts",),
    """SELECT company, assembly_date, any_value(day) AS day,
  min(pos) FILTER (hit_day IS NOT NULL) AS win,
  max(pos) FILTER (ins_code IS NOT NULL) AS last_resolved,
  string_agg(name, '|' ORDER BY pos) AS symbols_tried
 FROM attempts GROUP BY ALL""",
)

# ------------------------------------------------------------------ fetch log


def fetch_log(spark: SparkSession, path: str) -> DataFrame:
    return log_of_events(Tables(spark, path).events)


def log_of_events(e: DataFrame) -> DataFrame:
    """The fetch log of an events table or stream."""
    user = text("user_id")
    kind = F.col("event_type")
    k = F.get_json_object("props", "$.k").cast("int")
    message = (
        F.when(k % 5 == 0, "net::ERR_FAILED after timeout")
        .when(k % 5 == 1, "Timeout 60000ms exceeded")
        .when(k % 5 == 2, "Navigation failed: timeout")
        .when(k % 5 == 3, "Network unreachable")
        .otherwise("boom")
    )
    return e.select(
        "event_id",
        F.concat(F.lit("/letters/"), user).alias("url"),
        F.col("ts").cast("timestamp").alias("started"),
        F.when(kind == "error", "failed").otherwise("ok").alias("status"),
        (kind == "view").alias("from_cache"),
        k.cast("bigint").alias("items"),
        F.when(kind == "error", message).alias("message"),
    )


_SQL["fetch_log"] = (
    (),
    """SELECT event_id, '/letters/' || user_id AS url, ts AS started,
 CASE WHEN event_type = 'error' THEN 'failed' ELSE 'ok' END AS status,
 event_type = 'view' AS from_cache, k AS items,
 CASE WHEN event_type <> 'error' THEN NULL WHEN k % 5 = 0 THEN 'net::ERR_FAILED after timeout'
  WHEN k % 5 = 1 THEN 'Timeout 60000ms exceeded' WHEN k % 5 = 2 THEN 'Navigation failed: timeout'
  WHEN k % 5 = 3 THEN 'Network unreachable' ELSE 'boom' END AS message,
 CASE WHEN event_type <> 'error' THEN NULL WHEN k % 5 IN (0, 3) THEN 'network'
  WHEN k % 5 = 2 THEN 'navigation' WHEN k % 5 = 1 THEN 'timeout' ELSE 'unknown' END AS error_type
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)""",
)
