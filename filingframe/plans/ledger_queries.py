"""Queries over the fetch log: metrics, errors, freshness, frontier, streams."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from filingframe.operators import aggregates as agg
from filingframe.operators import ledger
from filingframe.plans.catalog import query
from filingframe.plans.views import Tables, fetch_log, log_of_events, with_views
from filingframe.session import shared_dir
from filingframe.streaming import ingest, snapshot, state

DAY = 86400
NOW = "2024-01-30 12:00:00"


@query(
    "fetch_metrics",
    with_views(
        "fetch_log",
        """SELECT url, count(*) AS pages_fetched, count(*) FILTER (status = 'failed') AS pages_failed,
 CAST(sum(items) AS BIGINT) AS items,
 round((count(*) - count(*) FILTER (status = 'failed')) / count(*) * 100, 2) AS success_rate,
 round(count(*) FILTER (from_cache) / count(*) * 100, 2) AS cache_hit_rate,
 (epoch_us(max(started)) - epoch_us(min(started))) // 1000000 AS duration_seconds
 FROM fetch_log GROUP BY url""",
    ),
)
def fetch_metrics(spark, path):
    return fetch_log(spark, path).transform(agg.fetch_metrics, "url")


def _errors(spark, path):
    from filingframe.functions.text import error_class

    failed = fetch_log(spark, path).where("status = 'failed'")
    kind = error_class("message")
    return failed.select("url", kind.alias("error_type"), (kind != "unknown").alias("recoverable"))


@query(
    "error_summary",
    with_views(
        "fetch_log",
        """, e AS (SELECT error_type FROM fetch_log WHERE status = 'failed')
SELECT error_type, count(*) AS errors, count(*) FILTER (error_type <> 'unknown') AS recoverable
 FROM e GROUP BY error_type
UNION ALL SELECT 'total', count(*), count(*) FILTER (error_type <> 'unknown') FROM e""",
    ),
)
def error_summary(spark, path):
    return agg.error_summary(_errors(spark, path))


@query(
    "failed_urls",
    with_views("fetch_log", "SELECT url, error_type FROM fetch_log WHERE status = 'failed'"),
)
def failed_urls(spark, path):
    return agg.failed_urls(_errors(spark, path))


KEPT_SQL = """, t AS (SELECT DISTINCT user_id, epoch_us(ts) AS t FROM events),
 kept AS (SELECT user_id, min(t) AS kept_at FROM t GROUP BY user_id
  UNION ALL SELECT k.user_id, (SELECT min(t.t) FROM t WHERE t.user_id = k.user_id
    AND t.t > k.kept_at + {ttl}) AS kept_at FROM kept k
  WHERE EXISTS (SELECT 1 FROM t WHERE t.user_id = k.user_id AND t.t > k.kept_at + {ttl}))
SELECT user_id, kept_at FROM kept"""


@query("kept_requests", with_views("fetch_log", KEPT_SQL.format(ttl=DAY * 1_000_000)))
def kept_requests(spark, path):
    return ledger.kept_requests(Tables(spark, path).events, "user_id", "ts", DAY)


@query("kept_requests_in_pieces", with_views("fetch_log", KEPT_SQL.format(ttl=6 * 3600 * 1_000_000)))
def kept_requests_in_pieces(spark, path):
    """The same fold with a shorter ttl and pieces of two ttl."""
    events = Tables(spark, path).events
    return ledger.kept_requests(events, "user_id", "ts", 6 * 3600, piece_ttls=2)


def _log(spark, path):
    created = F.col("ts").cast("timestamp")
    key = F.concat(F.lit("/letters/"), F.col("user_id").cast("string"))
    ttl = (F.col("user_id") % 5 + 1) * 3600
    return Tables(spark, path).events.select(
        key.alias("request_key"), created.alias("created_at"), ttl.cast("int").alias("ttl_seconds")
    )


STATE_SQL = f"""latest AS (SELECT '/letters/' || user_id AS request_key, epoch_us(max(ts)) AS created_at,
  CASE WHEN TIMESTAMP '{NOW}' <= max(ts) + to_hours(CAST(user_id % 5 + 1 AS INTEGER)) THEN 'fresh'
  ELSE 'expired' END AS state FROM events GROUP BY user_id)"""


@query(
    "ledger_state",
    with_views("fetch_log", f", {STATE_SQL} SELECT request_key, created_at, state FROM latest"),
)
def ledger_state(spark, path):
    found = ledger.ledger_state(_log(spark, path), NOW)
    return found.withColumn("created_at", F.unix_micros("created_at"))


@query(
    "ledger_state_merged",
    with_views("fetch_log", f", {STATE_SQL} SELECT request_key, created_at, state FROM latest"),
)
def ledger_state_merged(spark, path):
    """The state from a snapshot that took the log in three deltas, one of them late."""
    folder = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/snapshot-{uuid.uuid4().hex}"
    log = _log(spark, path)
    part = F.pmod(F.dayofyear("created_at"), F.lit(3))
    for number in (1, 2, 0):
        snapshot.merge(log.where(part == number), folder, buckets=8)
    found = ledger.ledger_state(snapshot.read(spark, folder), NOW)
    return found.withColumn("created_at", F.unix_micros("created_at"))


@query(
    "request_state",
    with_views(
        "fetch_log",
        f""", {STATE_SQL} SELECT request_key, coalesce(state, 'missing') AS state
 FROM (SELECT '/letters/' || c_custkey AS request_key FROM customer)
 LEFT JOIN latest USING (request_key)""",
    ),
)
def request_state(spark, path):
    key = F.concat(F.lit("/letters/"), F.col("c_custkey").cast("string"))
    planned = Tables(spark, path).customer.select(key.alias("request_key"))
    found = ledger.ledger_state(_log(spark, path), NOW).select("request_key", "state")
    return ledger.request_state(planned, found)


@query(
    "fresh_entries",
    f"""SELECT '/letters/' || user_id AS request_key, epoch_us(ts) AS created_at FROM events
 WHERE TIMESTAMP '{NOW}' <= ts + to_hours(CAST(user_id % 5 + 1 AS INTEGER))""",
)
def fresh_entries(spark, path):
    kept = ledger.drop_expired(_log(spark, path), NOW)
    return kept.select("request_key", F.unix_micros("created_at").alias("created_at"))


ENDPOINT = "https://search.example/q"
REQUESTS_SQL = f"""requests AS (SELECT symbol, CAST(page AS INTEGER) AS page,
  '{ENDPOINT}?FromDate=1380%2F01%2F01&PageNumber=' || page || '&Symbol=' || symbol ||
  '&search=true' AS url FROM (SELECT c_name AS symbol,
   unnest(generate_series(1, CAST(c_custkey % 7 AS INTEGER))) AS page FROM (SELECT
   c_custkey, replace(c_name, '#', '_') AS c_name FROM customer)))"""


def _symbols(spark, path):
    return Tables(spark, path).customer.select(
        F.translate("c_name", "#", "_").alias("symbol"),
        (F.col("c_custkey") % 7).alias("total_pages"),
    )


@query(
    "planned_requests",
    with_views(
        "fetch_log", f", {REQUESTS_SQL} SELECT symbol, page, url, md5(url) AS request_key FROM requests"
    ),
)
def planned_requests(spark, path):
    return ledger.requests(_symbols(spark, path), ENDPOINT, from_date="1380/01/01")


@query(
    "planned_requests_max_pages",
    with_views(
        "fetch_log",
        f", {REQUESTS_SQL} SELECT symbol, page, url, md5(url) AS request_key FROM requests WHERE page <= 4",
    ),
)
def planned_requests_max_pages(spark, path):
    """The page limit of a search, which is a parameter of the feature."""
    return ledger.requests(_symbols(spark, path), ENDPOINT, from_date="1380/01/01", max_pages=4)


@query(
    "fetch_frontier",
    with_views(
        "fetch_log",
        f""", {REQUESTS_SQL}, open AS (SELECT * FROM requests WHERE page <> 2)
SELECT symbol, page, (row_number() OVER (ORDER BY symbol, page) - 1) // 800 AS batch FROM open""",
    ),
)
def fetch_frontier(spark, path):
    planned = ledger.requests(_symbols(spark, path), ENDPOINT, from_date="1380/01/01")
    created = F.when(F.col("page") == 2, "2024-01-30 11:30:00").otherwise("2024-01-30 09:00:00")
    log = planned.where("page in (2, 3)").select(
        "request_key", created.cast("timestamp").alias("created_at")
    )
    found = ledger.ledger_state(log, NOW)
    return ledger.fetch_frontier(planned, found).select("symbol", "page", "batch")


@query(
    "fetch_counters",
    with_views(
        "fetch_log",
        """SELECT epoch_us(date_trunc('hour', started)) AS window_start, status,
 coalesce(error_type, 'none') AS error_type, count(*) AS requests FROM fetch_log GROUP BY ALL""",
    ),
)
def fetch_counters(spark, path):
    counted = state.fetch_counters(fetch_log(spark, path))
    return counted.select(
        F.unix_micros("window.start").alias("window_start"), "status", "error_type", "requests"
    )


# --------------------------------------------------------------------- streams


def _scratch(spark, name):
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _events_stream(spark, path):
    schema = Tables(spark, path).events.schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", ingest.FILES_PER_BATCH)
    return reader.option("pathGlobFilter", "events.parquet").parquet(path)


@query(
    "stream_new_urls",
    "SELECT '/letters/' || user_id AS url, count(DISTINCT user_id) AS rows FROM events GROUP BY user_id",
)
def stream_new_urls(spark, path):
    """Two runs of the resumable load; the second one finds nothing new."""
    folder = _scratch(spark, "new-urls")
    url = F.concat(F.lit("/letters/"), F.col("user_id").cast("string"))
    urls = _events_stream(spark, path).select(url.alias("url"))
    for run in ("first", "second"):
        # a new checkpoint replays all files, as after an overlapping delivery
        ingest.load_new_rows(urls, f"{folder}/urls", f"{folder}/checkpoint-{run}")
    loaded = spark.read.parquet(f"{folder}/urls")
    return loaded.groupBy("url").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "stream_kept_requests",
    with_views(
        "fetch_log",
        KEPT_SQL.format(ttl=DAY * 1_000_000)
        + " WHERE kept_at // 1000 < (SELECT max(epoch_us(ts)) // 1000 - 3600000 FROM events)",
    ),
)
def stream_kept_requests(spark, path):
    """What the watermark has passed, an hour before the last event."""
    folder = _scratch(spark, "kept-requests")
    kept = state.kept_requests_stream(_events_stream(spark, path), "user_id", "ts", DAY)
    writer = kept.writeStream.outputMode("append").format("parquet")
    writer = writer.option("checkpointLocation", f"{folder}/checkpoint")
    writer.trigger(availableNow=True).start(f"{folder}/kept").awaitTermination()
    return spark.read.parquet(f"{folder}/kept")


@query(
    "stream_fetch_counters",
    with_views(
        "fetch_log",
        """SELECT epoch_us(date_trunc('hour', started)) AS window_start, status,
 coalesce(error_type, 'none') AS error_type, count(*) AS requests FROM fetch_log GROUP BY ALL""",
    ),
)
def stream_fetch_counters(spark, path):
    """Counts of all windows so far, those still open included, after each batch."""
    folder = _scratch(spark, "fetch-counters")
    log = log_of_events(_events_stream(spark, path))
    counted = state.fetch_counters(log).select(
        F.unix_micros("window.start").alias("window_start"), "status", "error_type", "requests"
    )
    counted.writeStream.outputMode("complete").foreachBatch(
        lambda batch, _: batch.write.mode("overwrite").parquet(f"{folder}/counts")
    ).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/counts")
