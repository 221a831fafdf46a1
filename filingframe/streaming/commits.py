"""Commit records: rows of several tables become visible together, or not at all.

Every attempt to write has a name of its own, which is a folder level of the tables it
writes. The last step is one row in one file of the record table; a file appears by a rename, so a
crash before it leaves folders that no reader resolves.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ATTEMPT = "attempt"
RECORD = T.StructType(
    [
        T.StructField("stream", T.StringType()),
        T.StructField("batch", T.LongType()),
        T.StructField(ATTEMPT, T.StringType()),
    ]
)


def new_attempt() -> str:
    return uuid.uuid4().hex


def commit(records: DataFrame, path: str) -> None:
    """Append the records as one file."""
    records.coalesce(1).write.mode("append").parquet(path)


def records(spark: SparkSession, path: str) -> DataFrame:
    """Batches committed so far; an empty table is created where there is none."""
    spark.createDataFrame([], RECORD).write.mode("ignore").parquet(path)
    return spark.read.schema(RECORD).parquet(path)


def commit_batch(spark: SparkSession, path: str, stream: str, batch: int, attempt: str) -> None:
    commit(spark.createDataFrame([(stream, batch, attempt)], RECORD), path)


def is_committed(spark: SparkSession, path: str, stream: str, batch: int) -> bool:
    mine = (F.col("stream") == stream) & (F.col("batch") == batch)
    return not records(spark, path).where(mine).isEmpty()


def visible(table: DataFrame, committed: DataFrame) -> DataFrame:
    """Rows of committed attempts, without the column that names them."""
    return table.join(committed.select(ATTEMPT), ATTEMPT, "left_semi").drop(ATTEMPT)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream keeps with its checkpoint; a new checkpoint counts batches anew."""
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]
