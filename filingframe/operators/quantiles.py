"""Exact grouped quantiles that never gather a group in one task.

A first pass takes approximate bounds around each wanted rank. The second pass
keeps only values between the bounds, counts what lies below them, and cuts the
interval into BINS slices of equal width: a slice is ranked by itself, from the
number of values in the slices before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filingframe.session import materialise

# The sketch errs by at most n / ACCURACY ranks; the bounds leave twenty times
# that. Where that is less than two ranks the bounds are the extremes.
ACCURACY = 10_000
MARGIN = 20 / ACCURACY
FEWEST = int(2 / MARGIN)
BINS = 1024


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probabilities: Sequence[float],
    few_groups: bool = False,
    also: Sequence[Column] = (),
) -> DataFrame:
    """``keys, q0, q1, ...`` with linear interpolation between neighbours; groups without a value give no row.

    ``few_groups`` says that the number of groups is bounded by the schema, so
    that their bounds may be broadcast. ``also`` are aggregates of ``df`` that the first
    pass takes too: one row a group is then written once, when this is called, and every
    group has a row.
    """
    keys = list(keys)
    if not keys:
        raise ValueError("exact quantiles need a grouping key")
    number = F.col(value).cast("double")
    plain = F.when(~F.isnan(number), number)
    ascending = sorted(range(len(probabilities)), key=lambda i: probabilities[i])
    wanted = [probabilities[i] for i in ascending]
    lows = [max(p - MARGIN, 0.0) for p in wanted]
    highs = [min(p + MARGIN, 1.0) for p in wanted]
    k = len(wanted)
    groups = df.groupBy(*keys).agg(
        *also,
        F.count(plain).alias("_n"),
        F.min(plain).alias("_least"),
        F.max(plain).alias("_most"),
        F.percentile_approx(plain, [*lows, *highs], ACCURACY).alias("_s"),
    )
    if also:
        groups = materialise(groups, "groups")

    many = F.col("_n") > FEWEST

    def low(i: int) -> Column:
        return F.when(many & F.lit(wanted[i] > MARGIN), F.get("_s", F.lit(i))).otherwise(F.col("_least"))

    def bound(i: int) -> Column:
        high = F.when(many & F.lit(wanted[i] < 1 - MARGIN), F.get("_s", F.lit(k + i))).otherwise(F.col("_most"))
        return F.struct(
            F.lit(i).alias("i"),
            (low(i - 1) if i else F.lit(None).cast("double")).alias("before"),
            low(i).alias("low"),
            high.alias("high"),
            ((F.col("_n") - 1) * F.lit(float(wanted[i]))).alias("at"),
        )

    bounds = groups.where("_n > 0").select(
        *[F.col(c).alias(f"_k_{c}") for c in keys], F.array(*map(bound, range(k))).alias("_b")
    )
    if few_groups:
        bounds = F.broadcast(bounds)
    rows = df.select(*keys, plain.alias("_v")).where("_v is not null")
    placed = rows.join(bounds, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in keys])
    # rows above a bound are not needed; a row below some bounds is counted at the first of them
    first, low_, high_ = F.col("_b.before"), F.col("_b.low"), F.col("_b.high")
    near = placed.select(*keys, "_v", F.explode("_b").alias("_b")).where(
        (F.col("_v") <= high_) & ((F.col("_v") >= low_) | first.isNull() | (F.col("_v") >= first))
    )
    width = high_ - low_
    slice_ = F.floor((F.col("_v") - low_) / width * BINS).cast("int")
    bin_ = (
        F.when(F.col("_v") < low_, -1)
        # an infinite interval is one slice
        .when((width > 0) & (width < float("inf")), F.least(slice_, F.lit(BINS - 1)))
        .otherwise(0)
    )
    counted = near.groupBy(
        *keys,
        F.col("_b.i").alias("_i"),
        F.col("_b.at").alias("_at"),
        bin_.alias("_bin"),
        F.when(F.col("_v") >= low_, F.col("_v")).alias("_v"),
    ).agg(F.count(F.lit(1)).alias("_c"))
    # below a bound lies what is below an earlier one, too
    below = Window.partitionBy(*keys).orderBy("_i").rangeBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*keys, "_i").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    under = F.sum(F.when(F.col("_bin") < 0, F.col("_c"))).over(below)
    inside = F.sum(F.when(F.col("_bin") >= 0, F.col("_c"))).over(earlier)
    offsets = (
        counted.groupBy(*keys, "_i", "_bin")
        .agg(F.sum("_c").alias("_c"))
        .select(
            *[F.col(c).alias(f"_k_{c}") for c in keys],
            F.col("_i").alias("_k_i"),
            F.col("_bin").alias("_k_bin"),
            (F.coalesce(under, F.lit(0)) + F.coalesce(inside, F.lit(0))).alias("_before"),
        )
    )
    same = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in keys]
    upto = Window.partitionBy(*keys, "_i", "_bin").orderBy("_v")
    ranked = (
        counted.where("_bin >= 0")
        .join(offsets, [*same, F.col("_i") == F.col("_k_i"), F.col("_bin") == F.col("_k_bin")])
        .withColumn("_rank", F.col("_before") + F.sum("_c").over(upto))
    )
    at = F.col("_at")
    lower = F.min(F.when(F.col("_rank") >= F.floor(at) + 1, F.col("_v")))
    upper = F.min(F.when(F.col("_rank") >= F.ceil(at) + 1, F.col("_v")))
    each = ranked.groupBy(*keys, "_i", "_at").agg(lower.alias("_lo"), upper.alias("_hi"))
    part = at - F.floor(at)
    between = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * part
    # infinite neighbours have no difference
    exact = (part == 0) | (F.col("_lo") == F.col("_hi"))
    quantile = F.when(exact, F.col("_lo")).otherwise(between)
    picks = [F.max(F.when(F.col("_i") == i, quantile)).alias(f"q{ascending[i]}") for i in range(k)]
    names = [f"q{i}" for i in range(k)]
    found = each.groupBy(*keys).agg(*picks).select(*keys, *names)
    if not also:
        return found
    found = found.select(*[F.col(c).alias(f"_k_{c}") for c in keys], *names)
    return groups.drop("_n", "_least", "_most", "_s").join(F.broadcast(found) if few_groups else found, same, "left").drop(
        *[f"_k_{c}" for c in keys]
    )
