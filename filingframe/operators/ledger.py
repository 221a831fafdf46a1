"""Fetch planning against a ledger of earlier requests with a time to live."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from filingframe.functions.urls import fingerprint, query_url
from filingframe.operators.frame import assign_batches

# Default time to live, URLs per batch, search paths.
DEFAULT_TTL = 3600
BATCH_SIZE = 800


def requests(
    symbols: DataFrame,
    endpoint: str,
    from_date: str | None = None,
    to_date: str | None = None,
    max_pages: int | None = None,
) -> DataFrame:
    """One row per symbol and page, with URL and fingerprint.

    ``symbols`` has ``symbol, total_pages``; unset parameters are left out.
    """
    pages = F.col("total_pages").cast("int")
    last = F.least(pages, F.lit(max_pages)) if max_pages is not None else pages
    none = F.lit(None).cast("string")
    params = F.create_map(
        F.lit("Symbol"), F.col("symbol"),
        F.lit("FromDate"), F.lit(from_date) if from_date else none,
        F.lit("ToDate"), F.lit(to_date) if to_date else none,
        F.lit("PageNumber"), F.col("page").cast("string"),
    )
    each = symbols.where(pages >= 1).select("symbol", F.explode(F.sequence(F.lit(1), last)).alias("page"))
    planned = each.withColumn("url", query_url(params, endpoint))
    return planned.withColumn("request_key", fingerprint("url"))


def _expiry(created: Column, ttl: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(created) + ttl.cast("bigint") * 1_000_000)


def ledger_state(
    log: DataFrame, now: str | Column, key: str = "request_key", ttl_seconds: int = DEFAULT_TTL
) -> DataFrame:
    """Latest entry per key and whether it is still fresh (expiry is inclusive)."""
    moment = F.lit(now).cast("timestamp") if isinstance(now, str) else now
    ttl = F.col("ttl_seconds") if "ttl_seconds" in log.columns else F.lit(ttl_seconds)
    latest = log.groupBy(key).agg(F.max(F.struct("created_at", ttl.alias("ttl"))).alias("e"))
    expires = _expiry(F.col("e.created_at"), F.col("e.ttl"))
    return latest.select(
        key,
        F.col("e.created_at").alias("created_at"),
        F.when(moment <= expires, "fresh").otherwise("expired").alias("state"),
    )


def request_state(planned: DataFrame, state: DataFrame, key: str = "request_key") -> DataFrame:
    """Planned requests with ``state``; without an entry it is ``missing``."""
    joined = planned.join(state, key, "left")
    return joined.withColumn("state", F.coalesce("state", F.lit("missing")))


def drop_expired(
    log: DataFrame, now: str | Column, ttl_seconds: int = DEFAULT_TTL
) -> DataFrame:
    """Entries that are still fresh."""
    moment = F.lit(now).cast("timestamp") if isinstance(now, str) else now
    ttl = F.col("ttl_seconds") if "ttl_seconds" in log.columns else F.lit(ttl_seconds)
    return log.where(moment <= _expiry(F.col("created_at"), ttl))


def fetch_frontier(
    planned: DataFrame, state: DataFrame, batch_size: int = BATCH_SIZE
) -> DataFrame:
    """Requests without a fresh entry, in batches of fixed size."""
    fresh = state.where("state = 'fresh'").select("request_key")
    open_requests = planned.join(fresh, "request_key", "left_anti")
    return assign_batches(open_requests, batch_size, ["symbol", "page"])


# ------------------------------------------------- requests that miss the cache

# Length of a piece of a key's timeline, in ttl units.
PIECE_TTLS = 64


class _Heads:
    """Last kept times of a piece, for every time that may be the first one kept in it.

    A head is a last kept time with the ranges of entries that lead to it. Heads that
    fall behind meet in the next time, so there are never more than there are
    times within one ttl.
    """

    def __init__(self, begin: int, ttl: int):
        self.reach, self.ttl = begin + ttl, ttl
        #: last kept time, ranges of entries as (first number, last number, last entry)
        self.heads: deque[tuple[int, list[tuple[int, int, int]]]] = deque()
        self.entries = 0
        self.open = True  # what was kept before the piece may still cover the next time

    def add(self, t: int) -> None:
        ranges: list[tuple[int, int, int]] = []
        while self.heads and self.heads[0][0] + self.ttl < t:
            ranges += self.heads.popleft()[1]
        if self.open:
            ranges.append((self.entries, self.entries, t))
            self.entries += 1
            self.open = t <= self.reach
        if ranges:
            joined: list[tuple[int, int, int]] = []
            for first, last, entry in sorted(ranges):
                if joined and joined[-1][1] + 1 == first:
                    first = joined.pop()[0]
                joined.append((first, last, entry))
            self.heads.append((t, joined))

    def runs(self) -> list[tuple[int, int]]:
        """``(upto, end)`` in order of entry: entries up to ``upto`` lead to ``end``."""
        return sorted((entry, t) for t, ranges in self.heads for _, _, entry in ranges)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def _table(rows: Iterator[tuple], schema: pa.Schema, size: int = 10_000) -> Iterator[pa.RecordBatch]:
    while part := list(islice(rows, size)):
        columns = [pa.array(c, f.type) for c, f in zip(zip(*part, strict=True), schema, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)


def kept_requests(
    df: DataFrame, key: str, ts: str, ttl_seconds: int = DEFAULT_TTL, piece_ttls: int = PIECE_TTLS
) -> DataFrame:
    """Requests that create a cache entry: ``key, kept_at`` in microseconds.

    Per key the first request is kept, then always the first one later than the
    last kept time plus the ttl; a hit does not extend an entry. This is a fold
    over time. Every key's timeline is cut into pieces of ``piece_ttls`` ttl: each
    piece is summarised as "first time kept in it -> last time kept in it", the
    summaries are chained per key, and all pieces are then folded independently.
    Rows pass in order of time, so a task holds the times of one ttl at most.
    """
    ttl = ttl_seconds * 1_000_000
    span = ttl * piece_ttls
    kind = df.schema[key].dataType
    times = df.select(F.col(key).alias("k"), F.unix_micros(F.col(ts).cast("timestamp")).alias("t"))
    times = times.where(F.col("k").isNotNull() & F.col("t").isNotNull())
    times = times.select("k", F.floor(F.col("t") / F.lit(span)).alias("piece"), "t")
    arrow = to_arrow_type(kind)

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def runs() -> Iterator[tuple]:
            for (k, piece), rows in groupby(_rows(batches), key=lambda row: row[:2]):
                heads = _Heads(piece * span, ttl)
                for t, _ in groupby(row[2] for row in rows):
                    heads.add(t)
                yield from ((k, piece, upto, end) for upto, end in heads.runs())

        fields = [("k", arrow), ("piece", pa.int64()), ("upto", pa.int64()), ("end", pa.int64())]
        return _table(runs(), pa.schema(fields))

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def entries() -> Iterator[tuple]:
            for k, own in groupby(_rows(batches), key=lambda row: row[0]):
                last = None
                for piece, runs in groupby(own, key=lambda row: row[1]):
                    yield k, piece, last
                    last = next((end for _, _, upto, end in runs if last is None or upto > last + ttl), last)

        return _table(entries(), pa.schema([("k", arrow), ("piece", pa.int64()), ("after", pa.int64())]))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def kept() -> Iterator[tuple]:
            for (k, _), rows in groupby(_rows(batches), key=lambda row: row[:2]):
                last = None
                for _, _, t, after in rows:
                    # the entry of a piece comes before its times
                    if t is None:
                        last = after
                    elif last is None or t > last + ttl:
                        last = t
                        yield k, t

        return _table(kept(), pa.schema([(key, arrow), ("kept_at", pa.int64())]))

    def typed(*names: str) -> T.StructType:
        longs = [T.StructField(n, T.LongType()) for n in names]
        return T.StructType([T.StructField("k", kind), *longs])

    runs = (
        times.repartition("k", "piece")
        .sortWithinPartitions("k", "piece", "t")
        .mapInArrow(summarise, typed("piece", "upto", "end"))
    )
    chained = (
        runs.repartition("k")
        .sortWithinPartitions("k", "piece", "upto")
        .mapInArrow(chain, typed("piece", "after"))
    )
    none = F.lit(None).cast("bigint")
    marked = chained.select("k", "piece", none.alias("t"), "after")
    return (
        times.withColumn("after", none)
        .unionByName(marked)
        .repartition("k", "piece")
        .sortWithinPartitions("k", "piece", F.col("t").asc_nulls_first())
        .mapInArrow(fold, T.StructType([T.StructField(key, kind), T.StructField("kept_at", T.LongType())]))
    )


def fold_state(
    last: int | None, times: Iterator[int], ttl: int
) -> tuple[int | None, list[int]]:
    """Continue a fold with sorted times; shared with the streaming form."""
    kept = []
    for t in times:
        if last is None or t > last + ttl:
            kept.append(t)
            last = t
    return last, kept
