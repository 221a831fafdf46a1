"""Requests with a time to live: folds, freshness, frontier, streams."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from filingframe.operators import ledger
from filingframe.streaming import commits, ingest, keys, snapshot, state

START = datetime(2024, 1, 1)


def brute_force(events, ttl):
    last, kept = {}, set()
    for key, ts in sorted(events, key=lambda e: e[1]):
        if key not in last or ts > last[key] + timedelta(seconds=ttl):
            last[key] = ts
            kept.add((key, ts))
    return kept


def make_events(seed, hot):
    rng = random.Random(seed)
    events = [("hot", START + timedelta(seconds=rng.randrange(200_000) / 4)) for _ in range(hot)]
    events += [("dense", START + timedelta(seconds=i)) for i in range(0, 900)]
    events += [("gaps", START + timedelta(seconds=i * 601)) for i in range(50)]
    events += [("exact", START + timedelta(seconds=i * 600)) for i in range(50)]
    events += [(f"k{rng.randrange(30)}", START + timedelta(seconds=rng.randrange(50_000))) for _ in range(300)]
    events += events[:200]
    rng.shuffle(events)
    return events


def kept_set(df):
    rows = df.withColumn("t", F.timestamp_micros("kept_at")).collect()
    found = [(r["key"], r["t"]) for r in rows]
    assert len(found) == len(set(found))
    return set(found)


@pytest.mark.parametrize("pieces", [1, 2, 64])
@pytest.mark.parametrize("seed", [1, 2])
def test_kept_requests_equal_brute_force(spark, seed, pieces):
    events = make_events(seed, 3000)
    df = spark.createDataFrame(events, "key string, ts timestamp").repartition(5)
    kept = ledger.kept_requests(df, "key", "ts", 600, piece_ttls=pieces)
    assert kept_set(kept) == brute_force(events, 600)


def stream_folds(spark, folder, batches, ttl, delay):
    """Feed the batches one after the other and return what came out."""
    for part in batches:
        df = spark.createDataFrame(part, "key string, ts timestamp").coalesce(1)
        df.write.mode("append").parquet(str(folder / "in"))
        stream = spark.readStream.schema("key string, ts timestamp").parquet(str(folder / "in"))
        kept = state.kept_requests_stream(stream, "key", "ts", ttl, delay=delay)
        writer = kept.writeStream.format("parquet").option("checkpointLocation", str(folder / "cp"))
        query = writer.trigger(availableNow=True).start(str(folder / "out"))
        query.awaitTermination()
    return kept_set(spark.read.parquet(str(folder / "out")))


def closed(events, ttl, delay):
    """The batch result up to the last watermark."""
    end = max(ts for _, ts in events if ts) - delay
    return {(k, ts) for k, ts in brute_force([e for e in events if None not in e], ttl) if ts < end}


def test_streamed_fold_equals_batch(spark, tmp_path):
    events = sorted(make_events(3, 500), key=lambda e: e[1])
    cut = [events[:700], events[700:1100], [*events[1100:], (None, START)]]
    got = stream_folds(spark, tmp_path, cut, 600, "10 minutes")
    assert got == closed(events, 600, timedelta(minutes=10))
    assert len(got) > 100


def test_late_times_are_folded_in_order(spark, tmp_path):
    events = make_events(4, 400)
    # arrival is up to two hours behind the time itself
    rng = random.Random(5)
    arrival = sorted(events, key=lambda e: e[1] + timedelta(minutes=rng.randrange(120)))
    cut = [arrival[i : i + 350] for i in range(0, len(arrival), 350)]
    assert any(max(t for _, t in a) > min(t for _, t in b) for a, b in zip(cut, cut[1:], strict=False))
    got = stream_folds(spark, tmp_path, cut, 600, "2 hours")
    assert got == closed(events, 600, timedelta(hours=2))


def test_counters_in_stream_equal_batch(spark, tmp_path):
    rows = [(START + timedelta(minutes=7 * i), "failed" if i % 3 else "ok", "timeout" if i % 2 else "net::x")
            for i in range(100)]
    df = spark.createDataFrame(rows, "started timestamp, status string, message string")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    writer = state.fetch_counters(stream).writeStream.format("parquet").outputMode("append")
    writer = writer.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True)
    writer.start(str(tmp_path / "out")).awaitTermination()
    closed = rows[-1][0] - timedelta(hours=1)
    batch = state.fetch_counters(df).where(F.col("window.end") <= F.lit(closed))
    streamed = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(str, streamed.collect())) == sorted(map(str, batch.collect()))
    assert batch.count() > 10


@pytest.mark.parametrize("pieces", [1, 3])
def test_evenly_spaced_times_and_repeats(spark, pieces):
    events = [("a", START + timedelta(seconds=7 * i)) for i in range(2000)] * 2 + [("b", START)] * 3 + [(None, START)]
    df = spark.createDataFrame(events, "key string, ts timestamp")
    kept = ledger.kept_requests(df, "key", "ts", 600, piece_ttls=pieces)
    assert kept_set(kept) == brute_force([e for e in events if e[0]], 600)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[-1].count("Exchange hashpartitioning") <= 3


def test_ledger_state(spark):
    now = datetime(2024, 1, 2, 12)
    rows = [("fresh", now - timedelta(seconds=10), 3600), ("edge", now - timedelta(seconds=3600), 3600),
            ("late", now - timedelta(seconds=3601), 3600), ("renewed", now - timedelta(days=2), 3600),
            ("renewed", now, 1), ("long", now - timedelta(days=2), 86400 * 3)]
    log = spark.createDataFrame(rows, "request_key string, created_at timestamp, ttl_seconds int")
    found = ledger.ledger_state(log, "2024-01-02 12:00:00")
    states = {r["request_key"]: r["state"] for r in found.collect()}
    assert states == {"fresh": "fresh", "edge": "fresh", "late": "expired", "renewed": "fresh", "long": "fresh"}
    planned = spark.createDataFrame([("late",), ("new",)], "request_key string")
    joined = ledger.request_state(planned, found.select("request_key", "state"))
    assert {r["request_key"]: r["state"] for r in joined.collect()} == {"late": "expired", "new": "missing"}
    assert ledger.drop_expired(log, "2024-01-02 12:00:00").count() == 4


def test_frontier(spark):
    symbols = spark.createDataFrame([("a", 3), ("b", 0), ("c", 5)], "symbol string, total_pages int")
    planned = ledger.requests(symbols, "https://s/q", to_date="1402/01/01", max_pages=4)
    rows = {(r["symbol"], r["page"]): r for r in planned.collect()}
    assert set(rows) == {("a", 1), ("a", 2), ("a", 3), ("c", 1), ("c", 2), ("c", 3), ("c", 4)}
    assert rows["a", 2]["url"] == "https://s/q?PageNumber=2&Symbol=a&ToDate=1402%2F01%2F01&search=true"
    known = planned.where("symbol = 'c' and page < 3").select("request_key", F.lit("fresh").alias("state"))
    frontier = ledger.fetch_frontier(planned, known, batch_size=2).orderBy("symbol", "page").collect()
    assert [(r["symbol"], r["page"], r["batch"]) for r in frontier] == [
        ("a", 1, 0), ("a", 2, 0), ("a", 3, 1), ("c", 3, 1), ("c", 4, 2),
    ]


def test_resumable_load(spark, tmp_path):
    """2, then 3 rows after an overlapping file, and nothing from a replay."""
    source, target = str(tmp_path / "in"), str(tmp_path / "urls")

    def land(name, urls):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / name).write_text("url\n" + "\n".join(urls) + "\n")

    def load(checkpoint):
        ingest.load_new_rows(ingest.read_url_stream(spark, source), target, str(tmp_path / checkpoint))
        return sorted(r["url"] for r in spark.read.parquet(target).collect())

    land("1.csv", ["http://a", "http://b", "http://a"])
    assert load("cp") == ["http://a", "http://b"]
    assert load("cp") == ["http://a", "http://b"]
    land("2.csv", ["http://b", "http://c"])
    assert load("cp") == ["http://a", "http://b", "http://c"]
    assert load("fresh") == ["http://a", "http://b", "http://c"]


def _read_files(df):
    return {r["f"] for r in df.select(F.input_file_name().alias("f")).distinct().collect()}


def test_a_batch_reads_only_folders_that_may_hold_its_keys(spark, tmp_path):
    target = str(tmp_path / "t")
    rows = spark.range(500).selectExpr("concat('http://', id) as url", "id")
    ingest.create_table(spark, target, rows.schema)
    assert ingest.touched(rows, target, rows.schema).isEmpty()
    ingest.append_unseen(rows, target)
    files = _read_files(spark.read.parquet(target))
    assert len(files) == 1 << keys.FIRST_LEVEL
    few = rows.where("id in (3, 4, 900)").unionByName(spark.createDataFrame([("http://new", 1)], rows.schema))
    found = ingest.touched(few, target, rows.schema)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and keys.PART in plan.split("PartitionFilters")[1]
    assert 1 <= len(_read_files(found)) <= 3
    assert [r["url"] for r in ingest.unseen(few, found).collect()] == ["http://new"]
    # keys that were never loaded: their folders hold rows, yet hardly one is read
    strange = spark.range(20).selectExpr("concat('ftp://', id) as url", "id")
    assert len(_read_files(ingest.touched(strange, target, rows.schema))) <= 2


def test_folders_grow_with_the_target_and_no_row_is_lost(spark, tmp_path):
    target = str(tmp_path / "t")
    whole = spark.range(1200).selectExpr("nullif(concat('http://', id), 'http://7') as url", "id")
    ingest.create_table(spark, target, whole.schema)
    for last in (300, 600, 1200, 1200):
        ingest.append_unseen(whole.where(F.col("id") < last), target, rows_per_part=4)
    loaded = spark.read.parquet(target)
    # a missing key is a key too
    assert sorted(str(r["url"]) for r in loaded.collect()) == sorted(str(r["url"]) for r in whole.collect())
    assert {r[0] for r in loaded.select(keys.LEVEL).distinct().collect()} == {5, 7, 8}
    # every loaded key is found again, at whatever level it came
    again = ingest.touched(whole, target, whole.schema).select("url").na.drop()
    assert again.distinct().count() == 1199
    # bits whose rows were lost on the way do no harm
    lost = spark.createDataFrame([("http://lost", 1)], whole.schema)
    keys.place(lost, target, "url")
    ingest.append_unseen(lost, target)
    assert spark.read.parquet(target).where("url = 'http://lost'").count() == 1


def test_board_load_resumes(spark, tmp_path):
    def page(company):
        cells = "".join(f"<td>{company}{i}</td>" for i in range(12))
        return (f'<span id="lblCompany">{company}</span><table id="dgAssemblyBoardMember">'
                f'<tr class="GridItem">{cells}</tr></table>')  # fmt: skip

    pages = str(tmp_path / "pages")
    rows = [("http://a", page("a")), ("http://b", page("b")), ("http://bad", "<p></p>")]
    spark.createDataFrame(rows, "url string, html string").write.parquet(pages)
    (tmp_path / "in").mkdir()
    target = str(tmp_path / "out")

    def load(name, urls):
        (tmp_path / "in" / name).write_text("url\n" + "\n".join(urls) + "\n")
        stream = ingest.read_url_stream(spark, str(tmp_path / "in"))
        ingest.load_board_members(stream, pages, target, str(tmp_path / "cp"))
        members, errors = (ingest.loaded(spark, target, n) for n in ("members", "errors"))
        return (sorted(r["company"] for r in members.collect()),
                sorted((r["url"], r["error_type"]) for r in errors.collect()))

    failed = [("http://bad", "selector_not_found"), ("http://gone", "navigation")]
    assert load("1.csv", ["http://a ", "http://bad", "ftp://x", "", "http://gone"]) == (["a"], failed)
    assert load("2.csv", ["http://a", "http://b"]) == (["a", "b"], failed)


@pytest.mark.parametrize("when", ["before the record", "behind the record"])
def test_a_load_that_dies_leaves_no_half_batch(spark, tmp_path, monkeypatch, when):
    cells = "".join(f"<td>x{i}</td>" for i in range(12))
    html = (f'<span id="lblCompany">a</span><table id="dgAssemblyBoardMember">'
            f'<tr class="GridItem">{cells}</tr></table>')  # fmt: skip
    pages, target = str(tmp_path / "pages"), str(tmp_path / "out")
    rows = [("http://a", html), ("http://bad", "<p></p>")]
    spark.createDataFrame(rows, "url string, html string").write.parquet(pages)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.csv").write_text("url\nhttp://a\nhttp://bad\n")

    def load():
        stream = ingest.read_url_stream(spark, str(tmp_path / "in"))
        ingest.load_board_members(stream, pages, target, str(tmp_path / "cp"))

    def seen():
        return [sorted(r["url"] for r in ingest.loaded(spark, target, n).collect()) for n in ("members", "errors")]

    record = commits.commit_batch

    def dies(*args):
        if when == "behind the record":
            record(*args)
        raise RuntimeError("executor lost")

    with monkeypatch.context() as patch:
        patch.setattr(commits, "commit_batch", dies)
        with pytest.raises(Exception, match="executor lost"):
            load()
    # both tables were written, and count only with the record
    assert spark.read.parquet(f"{target}/members").count() > 0
    assert seen() == ([[], []] if when == "before the record" else [["http://a"], ["http://bad"]])
    load()
    assert seen() == [["http://a"], ["http://bad"]]


def entries(spark, rows):
    return spark.createDataFrame(rows, "request_key string, created_at timestamp, ttl_seconds int")


def test_a_snapshot_equals_the_whole_log(spark, tmp_path):
    rng = random.Random(3)
    rows = [(f"k{rng.randrange(40)}", START + timedelta(seconds=rng.randrange(50)), rng.randrange(5)) for _ in range(400)]
    rows += [(None, START, 1), (None, START, 2), ("k1", None, 9)]
    path = str(tmp_path / "snapshot")
    for part in (rows[:150], rows[150:151], rows[151:], rows[:20], []):
        snapshot.merge(entries(spark, part), path, buckets=8)
    wanted = {}
    for key, at, ttl in rows:
        new = (at or datetime.min, ttl)
        wanted[key] = max(wanted.get(key, new), new)
    got = [(r["request_key"], (r["created_at"], r["ttl_seconds"])) for r in snapshot.read(spark, path).collect()]
    assert dict(got) == wanted and len(got) == len(wanted)


def test_a_merge_rewrites_only_the_buckets_of_its_keys(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "snapshot")
    assert snapshot.read(spark, path).count() == 0
    first = snapshot.merge(entries(spark, [(f"k{i}", START, 1) for i in range(200)]), path, buckets=8)
    assert first == list(range(8))
    files = {f: f.stat().st_mtime_ns for f in (tmp_path / "snapshot").rglob("*.parquet")}
    later = entries(spark, [("k7", START + timedelta(days=1), 5)])
    # the number of buckets stays what it was
    (bucket,) = snapshot.merge(later, path, buckets=3)
    new = [f for f in (tmp_path / "snapshot" / "entries").rglob("*.parquet") if f not in files]
    assert new and all(f"key_bucket={bucket}/" in str(f) for f in new)
    assert all(f.stat().st_mtime_ns == at for f, at in files.items())
    # entries of a merge that never came to its record do not count
    monkeypatch.setattr(snapshot, "commit", lambda *_: None)
    snapshot.merge(entries(spark, [("lost", START, 1)]), path)
    found = {r["request_key"]: r["ttl_seconds"] for r in snapshot.read(spark, path).collect()}
    assert len(found) == 200 and found["k7"] == 5 and "lost" not in found
