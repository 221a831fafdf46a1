"""Company/person graphs and company interlocks as plain tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filingframe.functions.calendar import month_key, period_digits, quarter_key
from filingframe.functions.text import strip
from filingframe.operators.board import representatives
from filingframe.operators.buckets import Bucketed
from filingframe.operators.frame import row_numbers
from filingframe.session import materialise

GRAINS = ("year", "quarter", "month")
ROW_ORDER = ("assembly_date", "url", "row_no")
# Companies of one person and period that are paired in one piece; larger
# groups are cut into blocks of about this size.
BLOCK = 512
# Months of one person that are grouped in one task, in blocks and at most;
# people with more are spread.
PEOPLE_BLOCKS = 8
PERSON = PEOPLE_BLOCKS * BLOCK


def _linked(members: DataFrame) -> DataFrame:
    filled = [F.coalesce(F.col(c), F.lit("")) != "" for c in ("company", "new_member")]
    return members.where(filled[0] & filled[1])


def _seq(order: Sequence[str]) -> list[Column]:
    return [F.col(c) for c in order]


def graph_nodes(members: DataFrame, order: Sequence[str] = ROW_ORDER) -> DataFrame:
    """``id, node_type, degree, major``; the first row that names a node decides."""
    seq = _seq(order)
    none = F.lit(None).cast("string")

    # within a row the company is written before the person
    def role(kind: str, degree: Column, major: Column) -> Column:
        rank = F.lit(0 if kind == "company" else 1).alias("role")
        node = F.col("company" if kind == "company" else "new_member").alias("id")
        return F.struct(node, F.struct(*seq, rank, degree.alias("degree"), major.alias("major")).alias("w"))

    both = F.array(
        role("company", none, none),
        role("person", F.col("degree").cast("string"), F.col("major").cast("string")),
    )
    writes = _linked(members).select(F.inline(both))
    first = writes.groupBy("id").agg(F.min("w").alias("w"))
    kind = F.when(F.col("w.role") == 0, "company").otherwise("person")
    return first.select("id", kind.alias("node_type"), "w.degree", "w.major")


def graph_edges(members: DataFrame, order: Sequence[str] = ROW_ORDER) -> DataFrame:
    """One undirected edge per company and person; the last row's attributes stay."""
    pair = [
        F.least("company", "new_member").alias("_a"),
        F.greatest("company", "new_member").alias("_b"),
    ]
    row = F.struct(*_seq(order), "company", "new_member", "position", "year", "is_independent")
    last = _linked(members).groupBy(*pair).agg(F.max(row).alias("r"))
    return last.select(
        F.col("r.company").alias("company"),
        F.col("r.new_member").alias("person"),
        "r.position",
        "r.year",
        "r.is_independent",
    )


def graph_stats(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Six ``(metric, value)`` rows: sizes, average connections, density."""
    kinds = nodes.select(F.col("node_type").alias("kind"))
    kinds = kinds.unionByName(edges.select(F.lit("edge").alias("kind")))

    def count(kind: str) -> Column:
        return F.count_if(F.col("kind") == kind)

    one = kinds.agg(
        count("company").alias("companies"), count("person").alias("people"), count("edge").alias("e")
    ).withColumn("n", F.col("companies") + F.col("people"))
    n, e = F.col("n"), F.col("e")
    connections = F.round(2 * e / F.greatest(F.col("people"), F.lit(1)), 2)
    density = F.when(n > 1, F.round(2 * e / (n * (n - 1)), 4)).otherwise(0.0)

    def line(metric: str, value: Column) -> Column:
        return F.struct(F.lit(metric).alias("metric"), value.cast("double").alias("value"))

    lines = [
        line("Total Nodes", n),
        line("Total Edges", e),
        line("Companies", F.col("companies")),
        line("Board Members", F.col("people")),
        line("Average Connections per Person", connections),
        line("Network Density", density),
    ]
    return one.select(F.inline(F.array(*lines)))


def person_degree(edges: DataFrame) -> DataFrame:
    """Number of companies per person."""
    return edges.groupBy("person").agg(F.count(F.lit(1)).alias("companies"))


def top_connected(edges: DataFrame, k: int = 5) -> DataFrame:
    return person_degree(edges).orderBy(F.desc("companies"), F.asc("person")).limit(k)


def _by_period(df: DataFrame, keep: Sequence[str], grains: Sequence[str]) -> DataFrame:
    """``keep`` with ``grain, period``, a row per grain, from ``year`` and ``assembly_date``.

    The texts are built once a row, before the rows are multiplied.
    """
    keys = {
        "year": F.col("year").cast("string"),
        "quarter": quarter_key("assembly_date"),
        "month": month_key("assembly_date"),
    }
    built = df.select(*keep, *[keys[g].alias(f"_{g}") for g in grains])
    each = F.array(*[F.struct(F.lit(g).alias("grain"), F.col(f"_{g}").alias("period")) for g in grains])
    return built.select(*keep, F.inline(each))


def _seat_rows(members: DataFrame) -> DataFrame:
    """Board rows with the company name and the assembly date as period keys need them."""
    return members.withColumns(
        {"company": strip("company"), "assembly_date": period_digits("assembly_date")}
    )


def seat_months(members: DataFrame, order: Sequence[str] = ROW_ORDER) -> DataFrame:
    """Distinct ``year, month, rep_key, company`` with the first row that says so.

    The one wide exchange of the interlock jobs: repeated rows collapse before
    it, and every grain is derived from its result.
    """
    rows = _seat_rows(members.transform(representatives)).withColumn(
        "month", month_key("assembly_date")
    )
    # a condition of the aggregate, as a filter would be pushed below and evaluate ids and names again
    first = F.when(F.col("rep_is_person"), F.struct(*_seq(order), "rep_name"))
    kept = list(dict.fromkeys([*order, "year", "month", "company", "rep_key", "rep_name", "rep_is_person"]))
    keys = ["rep_key", "company", "month", "year"]
    return (
        rows.where("company is not null")
        .select(*kept)
        .groupBy(F.xxhash64(*keys).alias(_CODE), *keys)
        .agg(F.min(first).alias("first"))
        .where("first is not null")
        .drop(_CODE)
    )


#: Keys by which seat months may be stored in buckets: a person with many companies is in many.
SEAT = ["rep_key", "company"]


GROUP = ["rep_key", "period", "grain"]
#: A hash in front of keys that are texts, so that sorting compares a number first.
_CODE = "_code"


def _with_periods(months: DataFrame, periods: DataFrame) -> DataFrame:
    # a month or year may be missing, and still belongs to the periods of the other
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"n.{c}")) for c in ("month", "year")]
    return months.alias("s").join(periods.alias("n"), same).select("s.*", "n.periods")


def _periods_of(months: DataFrame, grains: Sequence[str]) -> DataFrame:
    """``month, year, periods`` of the months that occur: texts are built for them, not for every seat.

    Written, so that its size is known where it is joined.
    """
    spans = months.select("month", "year").distinct().withColumn("assembly_date", F.rpad("month", 8, "01"))
    each = _by_period(spans, ["month", "year"], grains).where("period is not null")
    listed = each.groupBy("month", "year").agg(  # one a grain
        F.collect_list(F.struct("grain", "period")).alias("periods")
    )
    return materialise(listed, "periods")


def _seats(months: DataFrame, periods: DataFrame) -> DataFrame:
    """Distinct ``rep_key, period, grain, company`` with the first row that says so, and the code of the group."""
    dated = _with_periods(months, periods).select("rep_key", "company", "first", F.inline("periods"))
    return dated.groupBy(F.xxhash64(*GROUP).alias(_CODE), *GROUP, "company").agg(F.min("first").alias("first"))


def incidence(months: DataFrame | Bucketed, grains: Sequence[str] = GRAINS) -> DataFrame:
    """Distinct ``grain, period, rep_key, company``: all interlocks, without any pair.

    Months in buckets of ``SEAT`` need no exchange for it.
    """
    if isinstance(months, Bucketed):
        return months.apart(lambda part: incidence(part, grains))
    dated = months.withColumn("assembly_date", F.rpad("month", 8, "01"))
    # the most selective key first, which is what string sorts compare first
    return _by_period(dated, ["rep_key", "company"], grains).where("period is not null").distinct()


def _by_person(months: DataFrame, person: str, most: int) -> tuple[DataFrame, DataFrame]:
    """Months of people with ``most`` of them at most, and those of the others.

    The first are dealt by person, so whatever is grouped by person and more needs no other
    exchange, and no task holds more than ``most`` rows of one. The others stay as they are.
    """
    code = F.xxhash64(person)
    # two people with the same hash only go to the others, where everyone may be
    counts = months.groupBy(code.alias("_person")).agg(F.count(F.lit(1)).alias("_count"))
    # at most a row for every `most` months
    busy = F.broadcast(counts.where(F.col("_count") > most).select("_person"))
    same = code == F.col("_person")
    quiet = months.where(F.col(person).isNotNull()).join(busy, same, "left_anti")
    return quiet.repartition(person), months.join(busy, same, "left_semi")


def _groups(seats: DataFrame) -> DataFrame:
    size = F.col("companies")
    sizes = seats.groupBy(_CODE, *GROUP).agg(
        F.count(F.lit(1)).alias("companies"), F.min("first")["rep_name"].alias("rep_name")
    )
    return sizes.where((size >= 2) & F.col("rep_key").isNotNull()).select(
        *GROUP,
        "companies",
        (size * (size - 1) / 2).cast("bigint").alias("pairs"),
        F.coalesce("rep_name", F.lit("Unknown")).alias("rep_name"),
        F.col("rep_key").alias("rep_id"),
    )


def interlock_groups(
    months: DataFrame | Bucketed, grains: Sequence[str] = GRAINS, most: int = PERSON
) -> DataFrame:
    """People who link companies in a period: group size, pair count, name and id.

    Counts and periods with edges are read from here without forming pairs. Months are dealt
    by person, but for people with more than ``most``, whose seats are counted where they lie first.
    """
    if isinstance(months, Bucketed):
        periods = _periods_of(months.rows(), grains)
        return _groups(months.apart(lambda part: _seats(part, periods)))
    periods = _periods_of(months, grains)
    quiet, busy = (_groups(_seats(part, periods)) for part in _by_person(months, "rep_key", most))
    return quiet.unionByName(busy)


def _sized(seats: DataFrame, keys: Sequence[str], name: Column | None = None) -> DataFrame:
    """``seats`` of groups with two companies or more, their number and name, where each group lies in one task."""
    group = Window.partitionBy(*keys)
    given = {"companies": F.count(F.lit(1)).over(group)}
    if name is not None:
        given["first"] = F.min(name).over(group)
    return seats.withColumns(given).where("companies >= 2")


def _cells(seats: DataFrame, company: str, block: int) -> DataFrame:
    """``seats`` with the sizes of their groups, ``companies``: a row for every cell ``_lo, _hi`` of blocks.

    A group with more than ``block`` companies is cut into blocks by company hash, and
    each pair of blocks is a join key of its own: a hot person is spread over many tasks.
    """
    blocks = F.ceil(F.col("companies") / F.lit(float(block))).cast("int")
    return (
        seats.withColumn("_n", blocks)
        .drop("companies")
        .withColumn("_mine", F.pmod(F.xxhash64(company), F.col("_n")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
        .withColumns({"_lo": F.least("_mine", "_other"), "_hi": F.greatest("_mine", "_other")})
        .drop("_n", "_other")
    )


def _pairs(cells: DataFrame, keys: Sequence[str], company: str) -> DataFrame:
    """Rows ``x`` and ``y`` of a group with ``x.company < y.company``, each pair once."""
    # both sides have the same columns, so one exchange serves them both
    left, right = cells.alias("x"), cells.alias("y")
    # two companies of the same block meet only in that block's own cell
    proper = (F.col("x._lo") == F.col("x._hi")) | (F.col("x._mine") != F.col("y._mine"))
    return left.join(right, [F.col(f"x.{c}") == F.col(f"y.{c}") for c in (*keys, "_lo", "_hi")]).where(
        (F.col(f"x.{company}") < F.col(f"y.{company}")) & proper
    )


def interlock_edges(
    months: DataFrame | Bucketed, grains: Sequence[str] = GRAINS, block: int = BLOCK
) -> DataFrame:
    """Every company pair ``a < b`` that shares a person in a period.

    The pairs are the result, so none may be left out; see :func:`_cells` for hot people.
    """
    rows = months.rows() if isinstance(months, Bucketed) else months
    periods = _periods_of(rows, grains)
    quiet, busy = (_seats(part, periods) for part in _by_person(rows, "rep_key", PEOPLE_BLOCKS * block))
    keys = [_CODE, *GROUP]
    near = _sized(quiet, keys, F.col("first")).select(*keys, "company", "companies", "first.rep_name")
    sizes = _groups(busy).select(*GROUP, "companies", "rep_name")
    far = busy.drop("first").join(sizes, GROUP).select(*near.columns)
    return _pairs(_cells(near.unionByName(far), "company", block), keys, "company").select(
        "x.grain",
        "x.period",
        F.col("x.company").alias("a"),
        F.col("y.company").alias("b"),
        # named on both sides, so that one exchange serves them both
        F.coalesce("x.rep_name", "y.rep_name", F.lit("Unknown")).alias("rep_name"),
        F.col("x.rep_key").alias("rep_id"),
        "x.rep_key",
    )


def interlock_weights(
    months: DataFrame, grains: Sequence[str] = GRAINS, block: int = BLOCK
) -> DataFrame:
    """Number of shared people per period and company pair.

    The product of the incidence with itself, in integers: companies and periods are
    numbered in their order, and a person is the number that the ten digits of
    ``rep_key`` spell. A seat is there once, so a pair counts one for each person; the
    counts are summed before the exchange of pairs, which carries three numbers and a
    count. Names come last.
    """
    companies = row_numbers(months.select("company").distinct(), ["company"], "company_no")
    companies = materialise(companies, "companies")  # so that its size is known where it is joined
    spans = _periods_of(months, grains).select("month", "year", F.inline("periods"))
    periods = row_numbers(spans.select("grain", "period").distinct(), ["grain", "period"], "period_no")
    numbered = spans.join(periods, ["grain", "period"]).groupBy("month", "year").agg(
        F.collect_list("period_no").alias("periods")
    )
    keys = ["person", "period_no"]

    def seats_of(part: DataFrame) -> DataFrame:
        return part.select("person", "company_no", F.explode("periods").alias("period_no")).distinct()

    rows = (
        _with_periods(months.select("rep_key", "company", "month", "year"), materialise(numbered, "periods"))
        .join(companies, "company")
        .select(F.col("rep_key").cast("bigint").alias("person"), "company_no", "periods")
    )
    quiet, busy = _by_person(rows, "person", PEOPLE_BLOCKS * block)
    near = _sized(seats_of(quiet), keys)
    far = seats_of(busy)
    groups = far.groupBy(*keys).agg(F.count(F.lit(1)).alias("companies")).where("companies >= 2")
    cells = _cells(near.unionByName(far.join(groups, keys)), "company_no", block)
    pairs = _pairs(cells, keys, "company_no")
    shared = pairs.groupBy(
        "x.period_no", F.col("x.company_no").alias("a_no"), F.col("y.company_no").alias("b_no")
    ).agg(F.count(F.lit(1)).alias("shared"))

    def named(side: str) -> DataFrame:
        return companies.select(F.col("company_no").alias(f"{side}_no"), F.col("company").alias(side))

    named_pairs = shared.join(periods, "period_no").join(named("a"), "a_no").join(named("b"), "b_no")
    return named_pairs.select("grain", "period", "a", "b", "shared")


def period_nodes(
    members: DataFrame, groups: DataFrame, grains: Sequence[str] = GRAINS
) -> DataFrame:
    """Companies of each period that has at least one edge."""
    # months of a company first, so that its repeated rows collapse before they are multiplied
    months = (
        _seat_rows(members)
        .where("company is not null")
        .select("company", "year", F.substring("assembly_date", 1, 6).alias("month"))
        .distinct()
    )
    months = materialise(months, "company-months")
    companies = _with_periods(months, _periods_of(months, grains)).select("company", F.inline("periods")).distinct()
    with_edges = groups.select("grain", "period").distinct()
    return companies.join(with_edges, ["grain", "period"], "left_semi")


def period_overview(groups: DataFrame, nodes: DataFrame) -> DataFrame:
    """Nodes, edges and linking people per period, without forming pairs."""
    people = groups.groupBy("grain", "period").agg(
        F.count(F.lit(1)).alias("people"), F.sum("pairs").alias("edges")
    )
    companies = nodes.groupBy("grain", "period").agg(F.count(F.lit(1)).alias("companies"))
    return people.join(companies, ["grain", "period"])
