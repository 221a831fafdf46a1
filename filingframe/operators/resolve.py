"""From board assemblies to shareholders: candidates, corrections, instruments,
and the forward as-of join to holder snapshots."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingframe.functions.calendar import d_even, from_jalali
from filingframe.functions.text import symbol_candidates, symbol_key
from filingframe.operators.buckets import Bucketed
from filingframe.operators.skew import salted_join
from filingframe.operators.textsearch import best_match
from filingframe.session import materialise

# Fixed value: how many days after the assembly a snapshot may lie.
MAX_FORWARD_DAYS = 2

PAIR = ["company", "assembly_date"]
#: Keys of a holder snapshot, by which it may be stored in buckets.
SNAPSHOT = ["ins_code", "d_even"]


def correction_table(raw: DataFrame, order: str) -> DataFrame:
    """``key, fixed`` from ``symbol, symbol_true``; the last row of a key counts."""
    rows = raw.select(
        symbol_key("symbol").alias("key"), symbol_key("symbol_true").alias("fixed"), F.col(order)
    ).where((F.col("key") != "") & (F.col("fixed") != ""))
    last = rows.groupBy("key").agg(F.max(F.struct(order, "fixed")).alias("r"))
    return last.select("key", F.col("r.fixed").alias("fixed"))


def correct_candidates(
    df: DataFrame, corrections: DataFrame, column: str = "candidates", keys: list[str] | None = None
) -> DataFrame:
    """Replace candidates found in the corrections; drop blanks and repeats, keep order.

    ``keys`` identify a row. Whether the corrections are broadcast is left to
    their measured size.
    """
    keys = keys or [c for c in df.columns if c != column]
    each = explode_candidates(df, keys, column).withColumn("_name", symbol_key("candidate"))
    # names are found before the join, once for a candidate and once for a correction
    known = corrections.select("key", "fixed", symbol_key("fixed").alias("_fixed_name"))
    name = F.when(F.col("fixed").isNotNull(), F.col("_fixed_name")).otherwise(F.col("_name"))
    joined = each.join(known, each["_name"] == known["key"], "left").select(
        *keys, "pos", F.coalesce("fixed", "candidate").alias("candidate"), name.alias("name")
    )
    # a row has as many candidates as its own text names, so this list is short
    listed = (
        joined.where("name != ''")
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(F.struct("pos", "name", "candidate"))).alias("l"))
    )
    first = F.filter(
        "l",
        lambda x, i: F.array_position(F.col("l.name"), x["name"]) == i + 1,
    )
    return listed.select(*keys, F.transform(first, lambda x: x["candidate"]).alias(column))


def explode_candidates(df: DataFrame, keep: list[str], column: str = "candidates") -> DataFrame:
    """``keep`` with ``pos, candidate``, a row for every candidate.

    From a plain explode Spark infers a filter on the list, which finds all candidates again.
    """
    each = df.select(*keep, F.posexplode_outer(column).alias("pos", "candidate"))
    return each.where("pos is not null")


def assembly_pairs(board: DataFrame, corrections: DataFrame) -> DataFrame:
    """Distinct ``company, assembly_date`` with at least one candidate, and its day."""
    pairs = board.select(*PAIR).na.drop().distinct()
    raw = pairs.withColumn("candidates", symbol_candidates("company"))
    fixed = correct_candidates(raw, corrections, "candidates", PAIR)
    return fixed.withColumn("day", from_jalali("assembly_date"))


def resolve_instruments(
    candidates: DataFrame, instruments: DataFrame, aliases: DataFrame, search: float | None = None
) -> DataFrame:
    """Add instrument columns to ``name`` rows: exact ticker first, then alias.

    With ``search``, names that neither knows are looked up by the n-grams they share
    with tickers and aliases; the most similar one counts, if it is that similar.
    """
    info = ["ins_code", "isic_code", "sector_name", "z_titad"]
    known = instruments.select(symbol_key("symbol").alias("name"), *info)
    exact = known.select("name", F.lit(0).alias("rank"), *info)
    other = aliases.select(symbol_key("alias").alias("name"), "ins_code")
    # of several rows of one instrument the least counts
    one = known.groupBy("ins_code").agg(F.min(F.struct(*info[1:])).alias("i"))
    fallback = other.join(one, "ins_code").select(
        "name", F.lit(1).alias("rank"), "ins_code", *[F.col(f"i.{c}").alias(c) for c in info[1:]]
    )
    best = F.min(F.struct("rank", *info)).alias("i")
    book = exact.unionByName(fallback).groupBy("name").agg(best)
    if search is not None:
        unknown = candidates.select("name").distinct().join(book, "name", "left_anti")
        hits = best_match(unknown, book.select("name"), search).select("query", "name")
        book = book.unionByName(hits.join(book, "name").select(F.col("query").alias("name"), "i"))
    return candidates.join(book, "name", "left").select(
        *candidates.columns, *[F.col(f"i.{c}").alias(c) for c in info]
    )


def snapshot_days(holders: DataFrame | Bucketed, targets: DataFrame, day: str = "day") -> DataFrame:
    """Distinct ``ins_code, d_even`` with holders, of a stored table those alone that targets may use."""
    if isinstance(holders, DataFrame):
        return holders.select(*SNAPSHOT).distinct()
    ahead = F.sequence(F.lit(0), F.lit(MAX_FORWARD_DAYS))
    days = F.transform(ahead, lambda offset: d_even(F.date_add(day, offset)))
    wanted = targets.select("ins_code", F.explode(days).alias("d_even")).na.drop().distinct()
    return holders.known(wanted)


def with_holders(holders: DataFrame | Bucketed, hits: DataFrame) -> DataFrame:
    """Inner join by instrument and day; a day with many holders is spread."""
    if isinstance(holders, DataFrame):
        return salted_join(holders, hits, SNAPSHOT)
    return holders.join(hits)


def first_days(targets: DataFrame, days: DataFrame, day: str = "day") -> DataFrame:
    """Add ``hit``, the first day with data (``d_even``) of ``day .. day + 2``, or null.

    Instruments and days are looked up once, however many targets name them: an equi-join on
    exploded offsets. A target without instrument or day finds nothing and skips the joins.
    """
    keys = ["ins_code", day]
    dated = F.col("ins_code").isNotNull() & F.col(day).isNotNull()
    asked = targets.where(dated).select(*keys).distinct()
    ahead = F.explode(F.sequence(F.lit(0), F.lit(MAX_FORWARD_DAYS)))
    each = asked.withColumn("_offset", ahead)
    each = each.select(*keys, d_even(F.date_add(day, F.col("_offset"))).alias("d_even"))
    first = each.join(days, SNAPSHOT).groupBy(*keys).agg(F.min("d_even").alias("hit"))
    found = salted_join(targets.where(dated), first, keys, "left").select(*targets.columns, "hit")
    return found.unionByName(targets.where(~dated).withColumn("hit", F.lit(None).cast("int")))


def as_of_forward(targets: DataFrame, holders: DataFrame | Bucketed, prices: DataFrame) -> DataFrame:
    """Holders and price of the first day with data on ``day .. day + 2``.

    ``targets`` are distinct rows with ``company, assembly_date, ins_code, day``;
    targets without data give no row. Holders in buckets of ``SNAPSHOT`` are not shuffled.
    """
    found = first_days(targets, snapshot_days(holders, targets)).where("hit is not null")
    first = found.withColumnRenamed("hit", "d_even")
    # prices meet the few targets, not their holders
    return with_holders(holders, attach_prices(first, prices))


def attach_prices(rows: DataFrame, prices: DataFrame) -> DataFrame:
    """Left join the price of the day; a zero or missing close falls back to ``pc``."""
    close = F.coalesce(F.nullif("pClosing", F.lit(0.0)), F.col("pc"))
    known = prices.select("ins_code", "d_even", close.alias("pClosing"))
    return rows.join(known, SNAPSHOT, "left")


@dataclass(frozen=True)
class Enrichment:
    """Outcome per pair, and everything derived from it."""

    attempts: DataFrame
    outcomes: DataFrame
    holders: DataFrame | Bucketed
    prices: DataFrame

    def shareholders(self) -> DataFrame:
        """One row per shareholder; pairs without data keep one row of metadata."""
        won = F.col("win").isNotNull()

        def of(field: str) -> Column:
            return F.when(won, F.col(f"win.{field}")).otherwise(F.col(f"last.{field}"))

        dated = F.col("day").isNotNull()
        symbol = F.coalesce(of("candidate"), F.col("first.candidate"))
        pairs = self.outcomes.select(
            *PAIR,
            F.when(dated, symbol).alias("symbol"),
            *[F.when(dated, of(c)).alias(c) for c in ("ins_code", "isic_code", "sector_name", "z_titad")],
            F.when(dated, F.col("win.hit")).alias("d_even"),
        )
        hits = pairs.where("d_even is not null")
        rows = with_holders(self.holders, attach_prices(hits, self.prices))
        # pairs without data skip the joins instead of piling up on a null key
        bare = pairs.where("d_even is null")
        both = rows.unionByName(bare, allowMissingColumns=True)
        date = F.to_date(F.col("d_even").cast("string"), "yyyyMMdd")
        return both.select(
            "company",
            "symbol",
            F.col("assembly_date").alias("assembly_date_jalali"),
            F.date_format(date, "yyyy-MM-dd").alias("effective_gregorian_date"),
            F.col("d_even").alias("effective_dEven"),
            F.col("ins_code").alias("insCode"),
            F.nullif(F.trim("isic_code"), F.lit("")).alias("isic_code"),
            "sector_name",
            F.col("z_titad").alias("zTitad"),
            "pClosing",
            "shareHolderName",
            "perOfShares",
            "shareHolderShareID",
        )

    def no_data(self) -> DataFrame:
        """Pairs that gave no shareholders, what was tried, and why."""
        reason = F.when(F.col("day").isNull(), "invalid_jalali_date").otherwise(
            "no_holders_for_any_candidate"
        )
        return self.outcomes.where("day is null or win is null").select(
            "company",
            F.col("symbols_tried"),
            F.col("assembly_date").alias("assembly_date_jalali"),
            reason.alias("reason"),
        )

    def unresolved(self) -> DataFrame:
        """Symbols that were tried and match no instrument, and how many pairs name them."""
        won = self.outcomes.select(*PAIR, F.col("win.pos").alias("_won"))
        tried = (
            self.attempts.join(won, PAIR)
            .withColumn("failed", F.col("day").isNotNull() & F.col("ins_code").isNull()
                & (F.coalesce(F.col("pos") <= F.col("_won"), F.lit(True))))
        )
        counts = tried.groupBy(F.col("name").alias("symbol")).agg(
            F.count(F.lit(1)).alias("pair_count"), F.bool_or("failed").alias("failed")
        )
        return counts.where("failed").select("symbol", "pair_count")


def enrich(
    board: DataFrame,
    corrections: DataFrame,
    instruments: DataFrame,
    aliases: DataFrame,
    holders: DataFrame | Bucketed,
    prices: DataFrame,
    search: float | None = None,
) -> Enrichment:
    """Try the candidates of each pair in order, each over its day window.

    The winner is the smallest (candidate position, day) with holders; one
    grouping per pair yields winner, last resolved and first candidate at once.
    Attempts and outcomes are written once in the shared folder, since every
    report starts from them.
    """
    pairs = assembly_pairs(board, corrections)
    tries = explode_candidates(pairs, [*PAIR, "day"])
    named = tries.withColumn("name", symbol_key("candidate"))
    attempts = materialise(resolve_instruments(named, instruments, aliases, search), "attempts")
    reached = first_days(attempts, snapshot_days(holders, attempts))
    fields = ["pos", "candidate", "ins_code", "isic_code", "sector_name", "z_titad"]
    hit = F.when(F.col("hit").isNotNull(), F.struct("pos", "hit", *fields[1:]))
    resolved = F.when(F.col("ins_code").isNotNull(), F.struct(*fields))
    # a position is there once
    tried = F.array_sort(F.collect_list(F.struct("pos", "candidate")))
    outcomes = reached.groupBy(*PAIR, "day").agg(
        F.min(hit).alias("win"),
        F.max(resolved).alias("last"),
        F.min(F.struct("pos", "candidate")).alias("first"),
        F.array_join(tried["candidate"], "|").alias("symbols_tried"),
    )
    return Enrichment(attempts, materialise(outcomes, "outcomes"), holders, prices)
