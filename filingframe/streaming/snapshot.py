"""A compacted ledger: the newest entry of every key, kept by buckets of keys.

A delta of the log is merged into the buckets its keys fall into; the others are
neither read nor written. Each bucket is a folder per attempt, and a commit record
names the folder that counts, so a merge that is lost half way changes nothing.
One merge runs at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filingframe.operators.ledger import DEFAULT_TTL
from filingframe.streaming.commits import ATTEMPT, commit, new_attempt

BUCKET = "key_bucket"
# Folders of a snapshot that is made without a number of its own.
BUCKETS = 64

_RECORD = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField(BUCKET, T.IntegerType()),
        T.StructField(ATTEMPT, T.StringType()),
        T.StructField("buckets", T.IntegerType()),
    ]
)


_ENTRY = T.StructType(
    [
        T.StructField("request_key", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("ttl_seconds", T.IntegerType()),
        T.StructField(BUCKET, T.IntegerType()),
        T.StructField(ATTEMPT, T.StringType()),
    ]
)


def _records(spark: SparkSession, path: str) -> DataFrame:
    spark.createDataFrame([], _RECORD).write.mode("ignore").parquet(f"{path}/commits")
    return spark.read.schema(_RECORD).parquet(f"{path}/commits")


def _current(spark: SparkSession, path: str) -> list:
    """The newest record of each bucket, one row a bucket."""
    newest = Window.partitionBy(BUCKET).orderBy(F.desc("version"))
    return (
        _records(spark, path).withColumn("_r", F.row_number().over(newest)).where("_r = 1").drop("_r").collect()
    )


def _read(spark: SparkSession, path: str, chosen: list) -> DataFrame:
    """Entries of the chosen buckets; other folders are not even listed."""
    if not chosen:
        return spark.createDataFrame([], _ENTRY).drop(BUCKET, ATTEMPT)
    folders = [f"{path}/entries/{BUCKET}={r[BUCKET]}/{ATTEMPT}={r[ATTEMPT]}" for r in chosen]
    kept = spark.read.schema(_ENTRY).option("basePath", f"{path}/entries").parquet(*folders)
    return kept.drop(BUCKET, ATTEMPT)


def read(spark: SparkSession, path: str) -> DataFrame:
    """``request_key, created_at, ttl_seconds``: the newest entry of every key."""
    return _read(spark, path, _current(spark, path))


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("request_key"), F.lit(buckets)).cast("int")


def merge(
    delta: DataFrame,
    path: str,
    key: str = "request_key",
    ttl_seconds: int = DEFAULT_TTL,
    buckets: int = BUCKETS,
) -> list[int]:
    """Merge new log entries; gives the numbers of the buckets that were rewritten.

    Of entries of one key the latest stays, at equal times the one with the longer
    ttl. A delta may repeat entries or come late: merging it twice, or in another
    order, gives the same. Keys are compared as text; a null key is a key. ``buckets`` counts
    for the first merge and stays what it was then; choose it so that a bucket's
    entries fit a few tasks. An empty delta changes nothing.
    """
    spark = delta.sparkSession
    ttl = F.col("ttl_seconds") if "ttl_seconds" in delta.columns else F.lit(ttl_seconds)
    fresh = delta.select(
        F.col(key).cast("string").alias("request_key"),
        F.col("created_at").cast("timestamp").alias("created_at"),
        ttl.cast("int").alias("ttl_seconds"),
    )
    now = _current(spark, path)
    buckets = now[0]["buckets"] if now else buckets
    # at most as many numbers as there are buckets
    touched = sorted(r["b"] for r in fresh.select(_bucket(buckets).alias("b")).distinct().collect())
    if not touched:
        return []
    known = _read(spark, path, [r for r in now if r[BUCKET] in set(touched)])
    latest = (
        known.unionByName(fresh)
        .groupBy("request_key")
        .agg(F.max(F.struct("created_at", "ttl_seconds")).alias("e"))
        .select("request_key", "e.created_at", "e.ttl_seconds")
    )
    attempt = new_attempt()
    placed = latest.withColumns({BUCKET: _bucket(buckets), ATTEMPT: F.lit(attempt)})
    # a large bucket is split over tasks, small ones share them
    placed.hint("rebalance", BUCKET).write.mode("append").partitionBy(BUCKET, ATTEMPT).parquet(f"{path}/entries")
    version = max((r["version"] for r in now), default=0) + 1
    rows = [(version, b, attempt, buckets) for b in touched]
    commit(spark.createDataFrame(rows, _RECORD), f"{path}/commits")
    return touched
