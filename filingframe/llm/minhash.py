"""Document fingerprints by one-permutation MinHash with optimal densification.

Each shingle is hashed once. Eight bits of the hash name its bin, 48 others are
its value; a bin keeps its least value. An empty bin takes the value of the first
non-empty bin in a hashed probe order of its own. Four low-order bits of each bin
are packed, sixteen bins to a long, and likeness is the share of equal bins,
corrected for the one in sixteen that agree by chance. Column expressions only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filingframe.llm.common import let, texts

BINS, BITS, SHINGLE = 256, 4, 5
#: Probes of an empty bin before all non-empty bins are ordered by hash.
PROBES = 6
#: Documents of one range of ids, and the most ranges.
RANGE_ROWS, RANGES = 1000, 2048

VALUE = (1 << 48) - 1


def _shingles(words: Column) -> Column:
    """Hash of every run of SHINGLE words; fewer words are one shingle, none give none."""

    def of(hashes: Column) -> Column:
        n = F.size(hashes)
        runs = F.transform(
            F.sequence(F.lit(0), n - SHINGLE), lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(SHINGLE)])
        )
        nothing = F.array().cast("array<bigint>")
        return F.when(n >= SHINGLE, runs).when(n > 0, F.array(F.xxhash64(hashes))).otherwise(nothing)

    return let(F.transform(words, lambda w: F.xxhash64(w)), of)


def _bins(shingles: Column) -> Column:
    """The least value of each bin, in bin order; VALUE where a bin is empty."""
    slots = F.sequence(F.lit(0).cast("long"), F.lit(BINS - 1).cast("long"))
    # one entry above all values stands in each bin, so that sorting finds every bin
    ends = F.transform(slots, lambda b: F.shiftleft(b, 48).bitwiseOR(F.lit(VALUE)))
    keyed = F.transform(
        shingles,
        lambda h: F.shiftleft(h.bitwiseAND(F.lit(BINS - 1)), 48).bitwiseOR(F.shiftrightunsigned(h, 16)),
    )
    return let(
        F.sort_array(F.concat(keyed, ends)),
        lambda s: F.filter(
            s, lambda x, i: (i == 0) | (F.shiftright(x, 48) != F.shiftright(F.get(s, i - 1), 48))
        ),
    )


def _densified(bins: Column) -> Column:
    """Low-order bits of each bin's value, empty bins filled; zeros where all are empty."""

    def value(x: Column) -> Column:
        return x.bitwiseAND(F.lit(VALUE))

    def low(x: Column) -> Column:
        return x.bitwiseAND(F.lit((1 << BITS) - 1))

    def fill(some: Column) -> Column:
        def one(x: Column) -> Column:
            own = F.shiftright(x, 48)
            tries = []
            for t in range(PROBES):
                probe = F.get(bins, F.pmod(F.xxhash64(own, F.lit(t)), F.lit(BINS)).cast("int"))
                tries.append(F.when(value(probe) != VALUE, low(probe)))
            nearest = F.array_min(
                F.transform(
                    some,
                    lambda y: F.shiftleft(F.shiftrightunsigned(F.xxhash64(own, F.shiftright(y, 48)), 8), BITS).bitwiseOR(
                        low(y)
                    ),
                )
            )
            return F.when(value(x) != VALUE, low(x)).otherwise(F.coalesce(*tries, low(nearest)))

        return F.when(F.size(some) > 0, F.transform(bins, one)).otherwise(
            F.array_repeat(F.lit(0).cast("long"), BINS)
        )

    return let(F.filter(bins, lambda x: value(x) != VALUE), fill)


def fingerprint(text: Column) -> Column:
    """Packed fingerprint (array of longs) of a text; equal texts have equal fingerprints.

    Words are runs without white space, in lower case. Null counts as empty; a
    text without words has the fingerprint of zeros.
    """
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"), lambda w: w != "")
    per = 64 // BITS

    def pack(nibbles: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.lit(BINS // per - 1)),
            lambda j: F.aggregate(
                F.slice(nibbles, j * per + 1, per),
                F.lit(0).cast("long"),
                lambda acc, x: F.shiftleft(acc, BITS).bitwiseOR(x),
            ),
        )

    return let(_bins(_shingles(words)), lambda bins: let(_densified(bins), pack))


def written(packed: Column) -> Column:
    """Lowercase hex digits of a packed fingerprint, one a bin."""
    return F.array_join(F.transform(packed, lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two packed fingerprints, from 0 to 1."""

    def differing(x: Column, y: Column) -> Column:
        bits = x.bitwiseXOR(y)
        half = bits.bitwiseOR(F.shiftrightunsigned(bits, 1))
        return F.bit_count(half.bitwiseOR(F.shiftrightunsigned(half, 2)).bitwiseAND(F.lit(0x1111111111111111)))

    unequal = F.aggregate(F.zip_with(a, b, differing), F.lit(0), lambda acc, n: acc + n)
    agree, chance = 1 - unequal / F.lit(float(BINS)), 1.0 / (1 << BITS)
    return F.greatest(F.lit(0.0), (agree - chance) / (1 - chance))


def _with_next(rows: DataFrame, add: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``add(rows)`` with ``next``: text and fingerprint of the next row in ascending doc_id (after the last: the first).

    Rows are dealt by ranges of ids, so neighbours meet in one task; the first row of
    each range, one for each, is what the last row before it needs. Rows of equal
    doc_id follow one another by the hash of their text.
    """
    ranges = max(1, min(RANGES, -(-rows.count() // RANGE_ROWS)))
    shares = [i / ranges for i in range(ranges)]
    cuts = sorted(set(rows.agg(F.percentile_approx("doc_id", shares, 4 * ranges)).first()[0] or []))
    bounds = F.array(*[F.lit(c) for c in cuts]).cast("array<bigint>")
    rank = F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(F.size(F.filter(bounds, lambda b: b <= F.col("doc_id"))))
    dealt = rows.withColumn("range", rank)
    order = Window.partitionBy("range").orderBy("doc_id", F.xxhash64("text"))
    ahead = add(dealt).withColumn("next", F.lead(F.struct("text", "packed")).over(order))
    # one row a range: its first document, and the range before it (before the first: the last)
    all_ranges = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = (
        dealt.groupBy("range")
        .agg(F.min("doc_id").alias("first_id"))
        .withColumn("prior", F.coalesce(F.lag("range").over(Window.orderBy("range")), F.max("range").over(all_ranges)))
    )
    found = (
        dealt.join(F.broadcast(firsts), (dealt.range == firsts.range) & dealt.doc_id.eqNullSafe(firsts.first_id))
        .select(firsts.prior.alias("range"), "text")
        .withColumn("at", F.row_number().over(Window.partitionBy("range").orderBy(F.xxhash64("text"))))
        .filter("at = 1")
    )
    follows = add(found).select("range", F.struct("text", "packed").alias("first"))
    return (
        ahead.join(follows, "range", "left")
        .withColumn("next", F.coalesce("next", "first"))
        .drop("range", "first")
    )


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of the text whose second half gives way to the next document's start.

    ``doc_id, n_chars, edited, packed, edited_packed, near_edited, near_next``.
    A null text is empty; the only document of a table is its own next.
    """
    paired = _with_next(texts(docs), lambda rows: rows.withColumn("packed", fingerprint(F.col("text"))))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring(F.col("next.text"), F.lit(1), half))
    # the edited text is named several times below: a column of its own keeps it computed once
    return paired.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        "packed",
        F.col("next.packed").alias("next_packed"),
        let(edited, lambda e: F.struct(e.alias("text"), fingerprint(e).alias("packed"))).alias("edited"),
    ).select(
        "doc_id",
        "n_chars",
        F.col("edited.text").alias("edited"),
        "packed",
        F.col("edited.packed").alias("edited_packed"),
        likeness(F.col("packed"), F.col("edited.packed")).alias("near_edited"),
        likeness(F.col("packed"), F.col("next_packed")).alias("near_next"),
    )
