"""Stateful streams: ttl-bounded requests and running counters."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from filingframe.functions.text import error_class
from filingframe.operators.ledger import DEFAULT_TTL, fold_state


def kept_requests_stream(
    df: DataFrame, key: str, ts: str, ttl_seconds: int = DEFAULT_TTL, delay: str = "1 hour"
) -> DataFrame:
    """Streaming form of ``kept_requests``, in order of event time whatever the order of arrival.

    Times wait in their key's state until the watermark has passed them, so that a time
    which arrives in a later batch, but within ``delay``, is folded in its place. A
    timer at a key's earliest waiting time releases them; what is released gives the same
    rows as the batch form. The times of the last ``delay`` come out when later events
    move the watermark. State per key are the last kept time and the distinct times
    of one delay; it ends once the last kept time has expired and nothing waits.
    """
    ttl = ttl_seconds * 1_000_000
    key_type = df.schema[key].dataType.simpleString()

    def fold(
        group_key: tuple, parts: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        last, waiting = state.get if state.exists else (None, [])
        times = set(waiting)
        for part in parts:
            times.update(part["_t"].tolist())
        # nothing at or before the watermark can arrive any more
        watermark = state.getCurrentWatermarkMs()
        ready = sorted(t for t in times if t // 1000 < watermark)
        last, kept = fold_state(last, iter(ready), ttl)
        waiting = sorted(times.difference(ready))
        expires = None if last is None else (last + ttl) // 1000 + 1
        timer = waiting[0] // 1000 if waiting else expires
        if waiting or (expires is not None and expires > watermark):
            state.update((last, waiting))
            state.setTimeoutTimestamp(max(timer, watermark + 1))
        elif state.exists:
            state.remove()
        yield pd.DataFrame({key: [group_key[0]] * len(kept), "kept_at": kept})

    rows = df.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", delay)
    return (
        rows.where(F.col(key).isNotNull() & F.col("_ts").isNotNull())
        .select(key, "_ts", F.unix_micros("_ts").alias("_t"))
        .groupBy(key)
        .applyInPandasWithState(
            fold,
            f"`{key}` {key_type}, kept_at bigint",
            "last bigint, waiting array<bigint>",
            "append",
            GroupStateTimeout.EventTimeTimeout,
        )
    )


def fetch_counters(df: DataFrame, window: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Requests per time window, status and error class; runs on batch and stream alike.

    ``df`` has ``started, status, message``. Counts are combined before the
    exchange, so one busy status does not burden one task.
    """
    timed = df.withColumn("started", F.col("started").cast("timestamp"))
    if df.isStreaming:
        timed = timed.withWatermark("started", delay)
    kind = F.when(F.col("status") == "failed", error_class("message")).otherwise("none")
    return timed.groupBy(
        F.window("started", window).alias("window"), "status", kind.alias("error_type")
    ).agg(F.count(F.lit(1)).alias("requests"))
