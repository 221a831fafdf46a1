"""Joins on keys of which a few hold most rows: a sketch finds them, and only they are salted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keys that may be salted at most, counters of the sketch, and rows of a key that one task takes.
MOST_KEYS, COUNTERS, ROWS_PER_TASK = 1_000, 16_384, 100_000


def _code(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)


def frequent_keys(
    df: DataFrame, keys: Sequence[str], rows_per_task: int = ROWS_PER_TASK, most: int = MOST_KEYS
) -> DataFrame:
    """``code, salts``: hashes of the keys that hold more than ``rows_per_task`` rows, and into how many parts each is cut.

    One pass with a mergeable sketch of frequent items, reduced before the exchange; the
    result has ``most`` rows at most. Counts are estimates, which only decide how a join
    is spread, never what it gives. Rows with a null key are not counted.
    """
    known = df.dropna(subset=list(keys)).select(_code(keys).alias("code"))
    top = known.agg(F.expr(f"approx_top_k(code, {most}, {max(COUNTERS, most)})").alias("top"))
    each = top.select(F.inline("top")).filter(F.col("count") > rows_per_task)
    return each.select(
        F.col("item").alias("code"), F.ceil(F.col("count") / F.lit(rows_per_task)).cast("int").alias("salts")
    )


def salted_join(
    many: DataFrame, few: DataFrame, keys: Sequence[str], how: str = "inner", rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """``many.join(few, keys, how)`` (inner or left), spread where a key holds many rows of ``many``.

    Rows of frequent keys are dealt in turn to the parts of their key, and the rows of
    ``few`` with such a key are repeated once a part; all others are joined as they are.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"cannot salt a join of kind {how!r}")
    keys = list(keys)
    # a bounded number of rows, whatever the data
    hot = F.broadcast(frequent_keys(many, keys, rows_per_task))
    salts = F.coalesce("_salts", F.lit(1))
    hot = hot.select(F.col("code").alias("_code"), F.col("salts").alias("_salts"))
    dealt = (
        many.withColumn("_turn", F.monotonically_increasing_id())
        .join(hot, _code(keys) == F.col("_code"), "left")
        .withColumn("_salt", F.pmod(F.col("_turn"), salts).cast("int"))
        .drop("_turn", "_code", "_salts")
    )
    repeated = (
        few.join(hot, _code(keys) == F.col("_code"), "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
        .drop("_code", "_salts")
    )
    return dealt.join(repeated, [*keys, "_salt"], how).drop("_salt")
