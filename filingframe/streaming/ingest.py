"""Resumable loads: a file stream appends what the target does not hold yet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from filingframe.functions.text import strip
from filingframe.operators.board import board_records
from filingframe.operators.frame import drop_duplicates, filter_valid_urls
from filingframe.schemas import BOARD_MEMBER, FETCH_ERROR
from filingframe.session import drop, materialise
from filingframe.sources.html import board_rows, page_errors, pages_of_urls, parse_board_pages
from filingframe.streaming import commits, keys

# Files of one micro-batch, which bounds what the first run takes at once.
FILES_PER_BATCH = 1000


def touched(batch: DataFrame, target_path: str, schema: T.StructType, key: str = "url") -> DataFrame:
    """Rows of the target in the folders that may hold keys of the batch, by the bitmaps beside them."""
    spark = batch.sparkSession
    whole = T.StructType([*schema.fields, *(T.StructField(c, T.IntegerType()) for c in (keys.LEVEL, keys.PART))])
    target = spark.read.schema(whole).parquet(target_path)
    held = F.lit(False)
    for level, parts in keys.folders(batch, target_path, key).items():
        held = held | ((F.col(keys.LEVEL) == level) & F.col(keys.PART).isin(parts))
    return target.where(held).drop(keys.LEVEL, keys.PART)


def append(
    rows: DataFrame,
    target_path: str,
    key: str = "url",
    below: tuple[str, ...] = (),
    rows_per_part: int = keys.ROWS_PER_PART,
) -> None:
    """Append to the folders of the rows' keys, a file each; ``below`` names columns of further levels.

    ``rows`` are read twice, for their keys' bits and for the files, so they must not change in between.
    """
    placed = keys.place(rows, target_path, key, rows_per_part).repartition(keys.PART)
    placed.write.mode("append").partitionBy(keys.LEVEL, keys.PART, *below).parquet(target_path)


def create_table(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """An empty Parquet folder, unless there is one already."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)


def unseen(batch: DataFrame, target: DataFrame, key: str = "url") -> DataFrame:
    """Batch rows whose key the target lacks, one a key: the least of those that share it; null is a key.

    The target's keys are first cut down to those in the batch, a semi join
    whose small side is the batch; the whole target is never shuffled for it.
    """
    rest = [c for c in batch.columns if c != key]
    fresh = drop_duplicates(batch, [key], "first", rest) if rest else batch.distinct()
    same = F.col(f"new.{key}").eqNullSafe(F.col(f"old.{key}"))
    fresh = fresh.alias("new")
    seen = target.select(key).alias("old").join(fresh.select(key).alias("new"), same, "left_semi")
    return fresh.join(seen.alias("old"), same, "left_anti")


def append_unseen(
    batch: DataFrame, target_path: str, key: str = "url", rows_per_part: int = keys.ROWS_PER_PART
) -> None:
    """Append unseen rows. A replayed batch finds its rows in the target and adds nothing."""
    fresh = unseen(batch, touched(batch, target_path, batch.schema, key), key)
    append(fresh, target_path, key, rows_per_part=rows_per_part)


def run_available(
    stream: DataFrame, each_batch: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """Process everything that has landed since the last run, then stop."""
    query = (
        stream.writeStream.foreachBatch(each_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def load_new_rows(stream: DataFrame, target_path: str, checkpoint: str, key: str = "url") -> None:
    """Append-only load of a file stream, one row per key over all runs."""
    create_table(stream.sparkSession, target_path, stream.schema)
    run_available(stream, lambda batch, _: append_unseen(batch, target_path, key), checkpoint)


#: Tables that a load fills together.
LOADED = {"members": BOARD_MEMBER, "errors": FETCH_ERROR}


def _with_attempt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(commits.ATTEMPT, T.StringType())])


def loaded(spark: SparkSession, target: str, name: str) -> DataFrame:
    """Table ``members`` or ``errors`` of a load: the rows of its committed batches."""
    schema = _with_attempt(LOADED[name])
    table = spark.read.schema(schema).parquet(f"{target}/{name}")
    return commits.visible(table, commits.records(spark, f"{target}/commits"))


def load_board_members(
    urls: DataFrame, pages_path: str, target: str, checkpoint: str, url_column: str = "url"
) -> None:
    """URL stream -> ``members`` and ``errors`` below ``target``; read them with :func:`loaded`.

    URLs already among the members are left out, so an interrupted load resumes.
    Members and errors of a micro-batch become visible together, by its commit record: after a
    crash before it the batch is done anew, after one behind it the replay finds it done.
    """
    spark = urls.sparkSession
    members_path, errors_path, record = f"{target}/members", f"{target}/errors", f"{target}/commits"
    create_table(spark, members_path, BOARD_MEMBER)
    create_table(spark, errors_path, FETCH_ERROR)

    def each_batch(batch: DataFrame, number: int) -> None:
        stream = commits.stream_id(spark, checkpoint)
        if commits.is_committed(spark, record, stream, number):
            return
        wanted = filter_valid_urls(batch, url_column).select(strip(url_column).alias("url"))
        near = touched(wanted, members_path, _with_attempt(BOARD_MEMBER))
        done = commits.visible(near, commits.records(spark, record))
        pages = spark.read.parquet(pages_path)
        # written, since what is appended below would change what is unseen
        fresh = materialise(unseen(wanted, done), "unseen")
        parsed = parse_board_pages(pages_of_urls(fresh, pages)).persist()
        attempt = commits.new_attempt()
        name = F.lit(attempt)
        try:
            rows = board_records(board_rows(parsed).drop("row_no"))
            append(rows.withColumn(commits.ATTEMPT, name), members_path, below=(commits.ATTEMPT,))
            errors = page_errors(parsed).withColumn(commits.ATTEMPT, name)
            errors.write.mode("append").partitionBy(commits.ATTEMPT).parquet(errors_path)
            commits.commit_batch(spark, record, stream, number, attempt)
        finally:
            parsed.unpersist()
            drop(fresh)

    run_available(urls, each_batch, checkpoint)


def read_url_stream(
    spark: SparkSession, path: str, url_column: str = "url", files_per_batch: int = FILES_PER_BATCH
) -> DataFrame:
    """CSV files of URLs, as they land, so many in a micro-batch at most."""
    schema = T.StructType([T.StructField(url_column, T.StringType(), True)])
    reader = spark.readStream.schema(schema).option("header", True)
    return reader.option("maxFilesPerTrigger", files_per_batch).csv(path)
