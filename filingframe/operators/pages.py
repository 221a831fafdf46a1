"""Pages of an ordered table that is stored once: page p reads its own range of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filingframe.operators.frame import Names, row_numbers

RANGE = "range_no"
ROW = "row_no"
# Rows of a range, which is what a page costs at most twice.
SPAN = 1_000_000


def write_ordered(df: DataFrame, path: str, order: Names, span: int = SPAN) -> None:
    """Store ``df`` in its order, numbered from 1, in folders of ``span`` rows.

    Ties are broken by the other columns. ``df`` must not have the columns ``row_no`` and ``range_no``.
    """
    if clash := {ROW, RANGE} & set(df.columns):
        raise ValueError(f"columns {sorted(clash)} are taken by the stored order")
    if span < 1:
        raise ValueError("a range has one row at least")
    numbered = row_numbers(df, order, ROW).withColumn(RANGE, F.expr(f"({ROW} - 1) div {int(span)}"))
    # rows come range by range from the numbering, so a task writes few folders
    numbered.write.mode("overwrite").partitionBy(RANGE).option("maxRecordsPerFile", span).parquet(f"{path}/rows")
    # an empty table has no folder of rows, and keeps its columns all the same
    spark = df.sparkSession
    spark.createDataFrame([], numbered.schema).write.mode("overwrite").parquet(f"{path}/columns")
    sizes = _rows(spark, path).groupBy(RANGE).agg(
        F.min(ROW).alias("first"), F.max(ROW).alias("last"), F.count(F.lit(1)).alias("rows")
    )
    sizes.withColumn("span", F.lit(int(span)).cast("bigint")).write.mode("overwrite").parquet(f"{path}/directory")


def _rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(spark.read.parquet(f"{path}/columns").schema).parquet(f"{path}/rows")


def directory(spark: SparkSession, path: str) -> DataFrame:
    """``range_no, first, last, rows, span`` of each range."""
    return spark.read.parquet(f"{path}/directory")


def read_page(spark: SparkSession, path: str, page: int, size: int = 10) -> DataFrame:
    """Rows of a 1-based page with their ``row_no``; beyond the last page there are none.

    The ranges that hold the page are constants of the filter, so other folders
    are not listed as input, and the row numbers reach the Parquet scan.
    """
    if page < 1 or size < 1:
        raise ValueError("pages and sizes start from 1")
    rows = _rows(spark, path)
    any_range = directory(spark, path).select("span").first()
    if any_range is None:
        return rows.drop(RANGE)
    first, last = (page - 1) * size + 1, page * size
    low, high = (first - 1) // any_range["span"], (last - 1) // any_range["span"]
    return rows.where(F.col(RANGE).between(low, high) & F.col(ROW).between(first, last)).drop(RANGE).orderBy(ROW)


def page_count(spark: SparkSession, path: str, size: int = 10) -> int:
    """Number of pages, from the directory alone."""
    total = directory(spark, path).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    return -(-total // size)
