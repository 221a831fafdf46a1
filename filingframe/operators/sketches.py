"""Profiles that add up: one small row per part and column, united without the data.

Counts are exact; distinct values and quantiles come from mergeable sketches of a
fixed size. A part (a day, a load) is profiled once, when it arrives.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filingframe.operators.profile import _countable

# 2^14 registers: a standard error of 0.8 % of a distinct count.
LG_K = 14
# A rank within 0.4 % of the rows, nearly always.
KLL_K = 800


def profile_parts(df: DataFrame, part: str) -> DataFrame:
    """``part, column, rows, filled, distinct_sketch, quantile_sketch, least, most`` for each part.

    Values are reduced before the exchange, which carries a sketch per part, column and
    task. Quantiles and bounds are those of numbers, not-a-number left out.
    """
    numbers = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    names = [c for c in df.columns if c != part]
    pairs = [
        F.struct(
            F.lit(n).alias("column"),
            _countable(df, n).cast("string").alias("text"),
            (F.col(n).cast("double") if n in numbers else F.lit(None).cast("double")).alias("v"),
        )
        for n in names
    ]
    tall = df.select(F.col(part).alias("part"), F.inline(F.array(*pairs)))
    number = F.when(~F.isnan("v"), F.col("v"))
    return tall.groupBy("part", "column").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("text").alias("filled"),
        F.hll_sketch_agg("text", LG_K).alias("distinct_sketch"),
        F.kll_sketch_agg_double(number, KLL_K).alias("quantile_sketch"),
        F.min(number).alias("least"),
        F.max(number).alias("most"),
    )


def unite(parts: DataFrame, keys: Sequence[str] = ("column",)) -> DataFrame:
    """The profile of all parts together, in the same columns without ``part``."""
    return parts.groupBy(*keys).agg(
        F.sum("rows").alias("rows"),
        F.sum("filled").alias("filled"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"),
        F.min("least").alias("least"),
        F.max("most").alias("most"),
    )


def estimates(profile: DataFrame, probabilities: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Read a profile: counts, about how many distinct values, about which quantiles."""
    # an empty sketch has no quantile
    filled = F.col("least").isNotNull()
    quantiles = [
        F.when(filled, F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(float(p)))).alias(f"q{i}")
        for i, p in enumerate(probabilities)
    ]
    keys = [c for c in ("part", "column") if c in profile.columns]
    return profile.select(
        *keys,
        "rows",
        (F.col("rows") - F.col("filled")).alias("nulls"),
        F.hll_sketch_estimate("distinct_sketch").alias("distinct"),
        "least",
        *quantiles,
        "most",
    )
