"""Queries from assemblies to shareholders."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from filingframe.operators import buckets, frame, resolve, textsearch
from filingframe.plans.catalog import query
from filingframe.plans.views import (
    Tables,
    aliases,
    assemblies,
    corrections,
    holders,
    instruments,
    prices,
    with_views,
)
from filingframe.session import materialise, shared_dir


def _corrections(spark, path):
    return resolve.correction_table(corrections(spark, path), "line")


def _pairs(spark, path):
    return resolve.assembly_pairs(assemblies(spark, path), _corrections(spark, path))


def _enriched(spark, path, held=None):
    return resolve.enrich(
        assemblies(spark, path),
        _corrections(spark, path),
        instruments(spark, path),
        aliases(spark, path),
        held or holders(spark, path),
        prices(spark, path),
    )


@query(
    "corrected_candidates",
    with_views(
        "candidates",
        "SELECT company, assembly_date, string_agg(name, '|' ORDER BY pos) AS candidates"
        " FROM candidates GROUP BY ALL",
    ),
)
def corrected_candidates(spark, path):
    pairs = _pairs(spark, path).transform(frame.filter_non_empty, "candidates")
    return pairs.select(
        "company", "assembly_date", F.array_join("candidates", "|").alias("candidates")
    )


@query(
    "resolved_instruments",
    with_views(
        "candidates resolvable",
        "SELECT company, assembly_date, c.name, ins_code, sector_name FROM candidates c"
        " LEFT JOIN resolvable r ON r.name = c.name",
    ),
)
def resolved_instruments(spark, path):
    tries = _pairs(spark, path).select(
        "company", "assembly_date", F.explode("candidates").alias("name")
    )
    found = resolve.resolve_instruments(tries, instruments(spark, path), aliases(spark, path))
    return found.select("company", "assembly_date", "name", "ins_code", "sector_name")


def _search_sql(queries: str, names: str, least: float) -> str:
    """All pairs by brute force: distinct n-grams of names with blanks around them."""

    def side(name: str, source: str) -> str:
        return (
            f"{name} AS (SELECT name, list_distinct(list_transform(range(1, length(name) + 2),"
            f" lambda i: substr('  ' || name || ' ', i, 3))) AS g FROM ({source}) WHERE name <> '')"
        )

    return f"""{side("q", queries)}, {side("n", names)},
 pairs AS (SELECT q.name AS query, n.name, len(list_intersect(q.g, n.g)) AS common, len(q.g) + len(n.g) AS total
  FROM q CROSS JOIN n),
 best AS (SELECT query, name, common / (total - common) AS similarity FROM pairs WHERE common / (total - common) >= {least}
  QUALIFY row_number() OVER (PARTITION BY query ORDER BY common / (total - common) DESC, name) = 1)"""


@query(
    "name_search",
    "WITH "
    + _search_sql("SELECT DISTINCT c_name AS name FROM customer", "SELECT DISTINCT s_name AS name FROM supplier", 0.25)
    + " SELECT query, name, round(similarity, 9) AS similarity FROM best",
)
def name_search(spark, path):
    """The supplier whose name is most like a customer's."""
    tables = Tables(spark, path)
    found = textsearch.best_match(tables.customer.select("c_name"), tables.supplier.select("s_name"), 0.25)
    return found.withColumn("similarity", F.round("similarity", 9))


@query(
    "searched_instruments",
    with_views(
        "candidates resolvable",
        ", "
        + _search_sql(
            "SELECT DISTINCT name FROM candidates WHERE name NOT IN (SELECT name FROM resolvable)",
            "SELECT name FROM resolvable",
            0.3,
        )
        + """ SELECT company, assembly_date, c.name, coalesce(r.ins_code, f.ins_code) AS ins_code
 FROM candidates c LEFT JOIN resolvable r ON r.name = c.name LEFT JOIN best ON best.query = c.name
 LEFT JOIN resolvable f ON f.name = best.name""",
    ),
)
def searched_instruments(spark, path):
    """Candidates by ticker, by alias, and else by the most similar of both."""
    tries = _pairs(spark, path).select("company", "assembly_date", F.explode("candidates").alias("name"))
    found = resolve.resolve_instruments(tries, instruments(spark, path), aliases(spark, path), search=0.3)
    return found.select("company", "assembly_date", "name", "ins_code")


@query(
    "holders_as_of",
    with_views(
        "attempts prices",
        """SELECT t.company, t.name, t.ins_code, CAST(t.hit_day AS VARCHAR) AS day,
 h.shareHolderName, h.perOfShares, h.shareHolderShareID,
 round(CASE WHEN coalesce(p.pClosing, 0) = 0 THEN p.pc ELSE p.pClosing END, 2) AS pClosing
 FROM attempts t JOIN holders h ON h.ins_code = t.ins_code AND h.day = t.hit_day
 LEFT JOIN prices p ON p.ins_code = t.ins_code AND p.day = t.hit_day""",
    ),
)
def holders_as_of(spark, path):
    tries = resolve.explode_candidates(_pairs(spark, path), ["company", "assembly_date", "day"])
    tries = tries.drop("pos").withColumnRenamed("candidate", "name")
    found = resolve.resolve_instruments(tries, instruments(spark, path), aliases(spark, path))
    targets = found.where("ins_code is not null and day is not null").select(
        "company", "assembly_date", "name", "ins_code", "day"
    )
    # their days, their keys and they themselves are read
    targets = materialise(targets, "targets")
    rows = resolve.as_of_forward(targets, holders(spark, path), prices(spark, path))
    return rows.select(
        "company",
        "name",
        "ins_code",
        F.to_date(F.col("d_even").cast("string"), "yyyyMMdd").cast("string").alias("day"),
        "shareHolderName",
        "perOfShares",
        "shareHolderShareID",
        F.round("pClosing", 2).alias("pClosing"),
    )


SHAREHOLDERS_SQL = with_views(
    "outcomes prices",
    """SELECT o.company, CASE WHEN o.day IS NULL THEN NULL ELSE c.name END AS symbol,
 o.assembly_date AS assembly_date_jalali, CAST(w.hit_day AS VARCHAR) AS effective_gregorian_date,
 CAST(strftime(w.hit_day, '%Y%m%d') AS INTEGER) AS "effective_dEven",
 CASE WHEN o.day IS NOT NULL THEN i.ins_code END AS "insCode",
 CASE WHEN o.day IS NOT NULL THEN i.isic_code END AS isic_code,
 CASE WHEN o.day IS NOT NULL THEN i.sector_name END AS sector_name,
 CASE WHEN o.day IS NOT NULL THEN i.z_titad END AS "zTitad",
 round(CASE WHEN coalesce(p.pClosing, 0) = 0 THEN p.pc ELSE p.pClosing END, 2) AS "pClosing",
 h."shareHolderName", h."perOfShares", h."shareHolderShareID"
FROM outcomes o
LEFT JOIN attempts c ON c.company = o.company AND c.assembly_date = o.assembly_date
 AND c.pos = coalesce(o.win, o.last_resolved, 1)
LEFT JOIN attempts i ON i.company = o.company AND i.assembly_date = o.assembly_date
 AND i.pos = coalesce(o.win, o.last_resolved)
LEFT JOIN attempts w ON w.company = o.company AND w.assembly_date = o.assembly_date AND w.pos = o.win
LEFT JOIN holders h ON h.ins_code = w.ins_code AND h.day = w.hit_day
LEFT JOIN prices p ON p.ins_code = w.ins_code AND p.day = w.hit_day""",
)


@query("shareholders", SHAREHOLDERS_SQL)
def shareholders(spark, path):
    rows = _enriched(spark, path).shareholders()
    return rows.withColumn("pClosing", F.round("pClosing", 2))


@query("stored_shareholders", SHAREHOLDERS_SQL)
def stored_shareholders(spark, path):
    """The same from holders that lie in buckets of instrument and day."""
    folder = f"{shared_dir(spark)}/holders-{uuid.uuid4().hex}"
    held = buckets.write(holders(spark, path), folder, resolve.SNAPSHOT, rows_per_task=1000)
    rows = _enriched(spark, path, held).shareholders()
    return rows.withColumn("pClosing", F.round("pClosing", 2))


@query(
    "assemblies_without_data",
    with_views(
        "outcomes",
        """SELECT company, symbols_tried, assembly_date AS assembly_date_jalali,
 CASE WHEN day IS NULL THEN 'invalid_jalali_date' ELSE 'no_holders_for_any_candidate' END
  AS reason FROM outcomes WHERE day IS NULL OR win IS NULL""",
    ),
)
def assemblies_without_data(spark, path):
    return (
        _enriched(spark, path)
        .no_data()
        .transform(frame.sort_by, ["company", "assembly_date_jalali"])
    )


@query(
    "unresolved_symbols",
    with_views(
        "outcomes",
        """SELECT name AS symbol, count(*) AS pair_count FROM attempts WHERE name IN
 (SELECT a.name FROM attempts a JOIN outcomes o USING (company, assembly_date)
  WHERE a.day IS NOT NULL AND a.ins_code IS NULL AND (o.win IS NULL OR a.pos <= o.win))
 GROUP BY name""",
    ),
)
def unresolved_symbols(spark, path):
    return _enriched(spark, path).unresolved()
