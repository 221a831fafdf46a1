"""Table profiles: summary statistics, column info, describe."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filingframe.operators.aggregates import top_values, value_counts
from filingframe.operators.quantiles import exact_quantiles

_NESTED = T.ArrayType | T.MapType | T.StructType


def _countable(df: DataFrame, name: str) -> Column:
    """Nested values are compared through their text."""
    kind = df.schema[name].dataType
    return F.to_json(F.col(name)) if isinstance(kind, _NESTED) else F.col(name)


def _tall(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """One ``column, v`` row per row and column."""
    pairs = [F.struct(F.lit(n).alias("column"), v.alias("v")) for n, v in columns.items()]
    return df.select(F.inline(F.array(*pairs)))


def column_info(df: DataFrame, sample: bool = True, approximate: bool = False) -> DataFrame:
    """One row per column: type, non-null, null and distinct counts, a sample value.

    The sample is the smallest value as text, so it does not depend on row order.
    Values are counted per column and text before they are shuffled; with
    ``approximate`` the distinct counts are estimates and no value is shuffled at all.
    """
    tall = _tall(df, {n: _countable(df, n).cast("string") for n in df.columns})
    if approximate:
        info = tall.groupBy("column").agg(
            F.count("v").alias("filled"),
            F.count(F.lit(1)).alias("rows"),
            F.approx_count_distinct("v").alias("unique"),
            F.min("v").alias("sample"),
        )
    else:
        counts = tall.groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"))
        info = counts.groupBy("column").agg(
            F.sum(F.when(F.col("v").isNotNull(), F.col("n"))).alias("filled"),
            F.sum("n").alias("rows"),
            F.count("v").alias("unique"),
            F.min("v").alias("sample"),
        )
    kinds = [F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("dtype")) for f in df.schema.fields]
    # a table without rows has its columns all the same
    names = df.sparkSession.range(1).select(F.inline(F.array(*kinds)))
    filled, none = F.coalesce("filled", F.lit(0)), F.lit(0).cast("bigint")
    out = names.join(info, "column", "left").select(
        "column",
        "dtype",
        filled.alias("non_null_count"),
        (F.coalesce("rows", none) - filled).alias("null_count"),
        F.coalesce("unique", none).alias("unique_count"),
        F.coalesce("sample", F.lit("")).alias("sample_value"),
    )
    return out if sample else out.drop("sample_value")


def summary_stats(df: DataFrame) -> DataFrame:
    """``(metric, key, value)`` rows: totals, distributions, date range, null counts."""
    date = next((c for c in df.columns if "date" in c.lower()), None)
    parts = [F.count(F.lit(1)).alias("_rows")]
    parts += [F.count_if(F.col(c).isNull()).alias(f"{c}_null") for c in df.columns]
    counted = [c for c in ("symbol", "letter_code") if c in df.columns]
    parts += [F.count_distinct(c).alias(f"{c}_unique") for c in counted]
    if date:
        parts += [F.min(date).alias("_first"), F.max(date).alias("_last")]

    def line(metric: str, key: str, value: Column) -> Column:
        return F.struct(
            F.lit(metric).alias("metric"),
            F.lit(key).alias("key"),
            value.cast("string").alias("value"),
        )

    lines = [
        line("total_records", "", F.col("_rows")),
        line("column_count", "", F.lit(len(df.columns))),
        line("columns", "", F.lit(",".join(df.columns))),
    ]
    names = {"symbol": "unique_symbols", "letter_code": "unique_letter_codes"}
    lines += [line(names[c], "", F.col(f"{c}_unique")) for c in counted]
    if date:
        lines += [
            line("date_range_min", date, F.col("_first")),
            line("date_range_max", date, F.col("_last")),
        ]
    lines += [line("columns_with_na", c, F.col(f"{c}_null")) for c in df.columns]
    one = df.agg(*parts).select(F.inline(F.array(*lines)))
    one = one.where("metric != 'columns_with_na' or value != '0'")
    frames = [one]

    def spread(counts: DataFrame, metric: str, column: str) -> DataFrame:
        return counts.select(
            F.lit(metric).alias("metric"),
            F.col(column).alias("key"),
            F.col("count").cast("string").alias("value"),
        )

    if "symbol" in df.columns:
        frames.append(spread(top_values(df, "symbol"), "top_symbols", "symbol"))
    if "letter_code" in df.columns:
        codes = value_counts(df, "letter_code")
        frames.append(spread(codes, "letter_code_distribution", "letter_code"))
    return reduce(DataFrame.unionByName, frames)


def describe(df: DataFrame) -> DataFrame:
    """One row per column: count, unique/top/freq of texts, moments and quartiles of numbers."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    # dates are counted like texts
    plain = T.StringType | T.BooleanType | T.DateType | T.TimestampType | T.TimestampNTZType
    textual = [f.name for f in df.schema.fields if isinstance(f.dataType, plain)]
    frames: list[DataFrame] = []
    number_columns = ("mean", "std", "min", "q25", "q50", "q75", "max")
    if numeric:
        tall = _tall(df, {n: F.col(n).cast("double") for n in numeric})
        moments = [
            F.count("v").alias("count"),
            F.avg("v").alias("mean"),
            F.stddev_samp("v").alias("std"),
            F.min("v").alias("min"),
            F.max("v").alias("max"),
        ]
        numbers = exact_quantiles(tall, ["column"], "v", [0.25, 0.5, 0.75], few_groups=True, also=moments)
        frames.append(
            numbers.select(
                "column",
                "count",
                F.lit(None).cast("bigint").alias("unique"),
                F.lit(None).cast("string").alias("top"),
                F.lit(None).cast("bigint").alias("freq"),
                "mean",
                "std",
                "min",
                F.col("q0").alias("q25"),
                F.col("q1").alias("q50"),
                F.col("q2").alias("q75"),
                "max",
            )
        )
    if textual:
        tall = _tall(df, {n: F.col(n).cast("string") for n in textual}).where("v is not null")
        counts = tall.groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"))
        best = F.min(F.struct((-F.col("n")).alias("rank"), F.col("v")))
        texts = counts.groupBy("column").agg(
            F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"), best.alias("best")
        )
        frames.append(
            texts.select(
                "column",
                "count",
                "unique",
                F.col("best.v").alias("top"),
                (-F.col("best.rank")).alias("freq"),
                *[F.lit(None).cast("double").alias(c) for c in number_columns],
            )
        )
    return reduce(DataFrame.unionByName, frames)
