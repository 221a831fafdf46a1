"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

T = TypeVar("T")

#: Rows per Arrow batch. Texts vary from one word to megabytes, so batches are kept short.
BATCH_ROWS = 256
#: Every fourth document (by checksum of its id) is held out from learning.
FOLDS, HELD_OUT_FOLD = 4, 2


_HELD: dict[tuple, object] = {}


def remembered(make: Callable[..., T], *args: object) -> T:
    """``make(*args)``, kept by a Python worker from task to task until another is asked for.

    A worker that runs several operators one after the other so holds one memory, not all.
    """
    key = (make, *args)
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make(*args)
    return _HELD[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def short_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch of whole texts can hold."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone; a null text is the empty text."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def held_out(doc_id: str = "doc_id") -> Column:
    """True for documents no model may learn from; a null id is never held out."""
    fold = F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS
    return fold == HELD_OUT_FOLD


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The given names, each with as many underscores before it as ``df`` has no column of."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out
