"""Tables stored in buckets of their join keys: joins and groupings by them move only the other side.

A key that holds many rows would fill its bucket, so rows of frequent keys, and rows
without a key, are stored apart; no key is in both parts. Every attempt to write has
a folder of its own, and the record that is written last names the one that counts.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filingframe.operators.skew import ROWS_PER_TASK, frequent_keys, salted_join
from filingframe.session import materialise
from filingframe.streaming.commits import ATTEMPT, commit, new_attempt

_RECORD = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField(ATTEMPT, T.StringType()),
        T.StructField("buckets", T.IntegerType()),
        T.StructField("keys", T.ArrayType(T.StringType())),
    ]
)


@dataclass(frozen=True)
class Bucketed:
    """``even`` lies in buckets of ``keys``; ``rest`` holds frequent keys and rows without one."""

    keys: tuple[str, ...]
    even: DataFrame
    rest: DataFrame

    def rows(self) -> DataFrame:
        return self.even.unionByName(self.rest)

    def apart(self, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """``work`` of both parts, united: right for whatever treats every key by itself."""
        return work(self.even).unionByName(work(self.rest))

    def known(self, few: DataFrame) -> DataFrame:
        """Rows of ``few`` whose key the table holds; ``few`` should name a key once."""
        keys = list(self.keys)
        near = few.join(self.even.select(*keys), keys, "left_semi")
        return near.unionByName(few.join(self.rest.select(*keys).distinct(), keys, "left_semi"))

    def join(self, few: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
        """Inner join by the keys, in which the buckets stay where they are.

        ``few`` is written once. Keys that are frequent in it are joined apart, salted, with the
        rows of the table that have them; so are the table's own frequent keys.
        """
        keys = list(self.keys)
        few = materialise(few, "few")
        # a bounded number of rows, whatever the data
        crowded = F.broadcast(_codes(few, keys, rows_per_task))
        same = F.xxhash64(*keys) == F.col("_code")
        calm, busy = (few.join(crowded, same, how) for how in ("left_anti", "left_semi"))
        parts = [
            self.even.join(calm, keys),
            salted_join(self.rest, calm, keys, rows_per_task=rows_per_task),
            salted_join(busy, self.rows().join(crowded, same, "left_semi"), keys, rows_per_task=rows_per_task),
        ]
        return reduce(DataFrame.unionByName, parts)


def _codes(df: DataFrame, keys: Sequence[str], rows_per_task: int) -> DataFrame:
    return frequent_keys(df, keys, rows_per_task).select(F.col("code").alias("_code"))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _records(spark: SparkSession, path: str) -> DataFrame:
    spark.createDataFrame([], _RECORD).write.mode("ignore").parquet(f"{path}/commits")
    return spark.read.schema(_RECORD).parquet(f"{path}/commits")


def _filled(keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])


def write(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    buckets: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> Bucketed:
    """Store ``df`` in buckets of ``keys``, one file a bucket, and give it back as :func:`read` does.

    Choose ``buckets`` so that one of them fits a task; the default is the session's number of
    shuffle partitions, and with fewer Spark may shuffle both sides of a join all the same. ``df`` is
    read three times: for its frequent keys and for each part. One writer at a time.
    """
    spark, keys = df.sparkSession, list(keys)
    if not keys:
        raise ValueError("buckets need a key")
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    attempt = new_attempt()
    hot = F.broadcast(materialise(_codes(df, keys, rows_per_task), "frequent"))
    same = F.xxhash64(*keys) == F.col("_code")
    even = df.filter(_filled(keys)).join(hot, same, "left_anti")
    rest = df.filter(_filled(keys)).join(hot, same, "left_semi").unionByName(df.filter(~_filled(keys)))
    rest.write.parquet(f"{path}/{attempt}/rest")
    # the exchange deals rows as buckets do, so a task writes one file
    placed = even.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
    placed.format("parquet").option("path", f"{path}/{attempt}/even").saveAsTable(_table(attempt))
    version = (_records(spark, path).agg(F.max("version")).first()[0] or 0) + 1
    commit(spark.createDataFrame([(version, attempt, buckets, keys)], _RECORD), f"{path}/commits")
    return read(spark, path)


def _table(attempt: str) -> str:
    return f"bucketed_{attempt}"


def read(spark: SparkSession, path: str) -> Bucketed:
    """The newest complete table below ``path``; a session that does not know it yet registers it."""
    newest = _records(spark, path).orderBy(F.desc("version")).first()
    if newest is None:
        raise ValueError(f"no bucketed table in {path!r}")
    folder, name = f"{path}/{newest[ATTEMPT]}", _table(newest[ATTEMPT])
    rest = spark.read.parquet(f"{folder}/rest")
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in rest.schema.fields)
        keys = ", ".join(map(_quoted, newest["keys"]))
        place = f"{folder}/even".replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys})"
            f" INTO {newest['buckets']} BUCKETS LOCATION '{place}'"
        )
    return Bucketed(tuple(newest["keys"]), spark.table(name), rest)
