from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from filingframe.llm import minhash
from tests_words import words


def jaccard(a: str, b: str) -> float:
    def runs(text):
        own = text.lower().split()
        return {tuple(own[i : i + 5]) for i in range(len(own) - 4)} or ({tuple(own)} if own else set())

    x, y = runs(a), runs(b)
    return len(x & y) / len(x | y) if x | y else 1.0


def edit(texts):
    """The edited text of each, in order."""
    out = []
    for i, t in enumerate(texts):
        half, after = len(t) // 2, texts[(i + 1) % len(texts)]
        out.append(t[: len(t) - half] + after[:half])
    return out


@pytest.mark.parametrize("rows", [2, 1000])
def test_edited_texts(awkward, monkeypatch, rows):
    monkeypatch.setattr(minhash, "RANGE_ROWS", rows)  # neighbours in other ranges too
    docs = awkward.filter("doc_id is not null").dropDuplicates(["doc_id"])
    found = minhash.edited_fingerprints(docs).orderBy("doc_id").collect()
    texts = [r.text or "" for r in docs.orderBy("doc_id").collect()]
    for r, t, e, after in zip(found, texts, edit(texts), [*texts[1:], texts[0]], strict=True):
        assert r.n_chars == len(t)
        assert hashlib.sha256(r.edited.encode()).digest() == hashlib.sha256(e.encode()).digest()
        assert abs(r.near_edited - jaccard(t, e)) < 0.16, (r.doc_id, r.near_edited, jaccard(t, e))
        assert abs(r.near_next - jaccard(t, after)) < 0.16
        if t == after:
            assert r.near_next == 1


def test_likeness_is_close_to_jaccard(make_docs):
    base = words(1, 400).split()
    texts = [" ".join(base)]
    for k in (4, 10, 30, 80, 200):
        own = list(base)
        own[100 : 100 + k] = words(50 + k, k).split()
        texts.append(" ".join(own))
    short = " ".join(base[:12])
    texts += [short, short + " more", short + " other words", "one two", "one two", ""]
    docs = make_docs(texts).withColumn("packed", minhash.fingerprint(F.col("text")))
    pairs = docs.alias("a").join(docs.alias("b"), F.col("a.doc_id") < F.col("b.doc_id"))
    rows = pairs.select("a.text", F.col("b.text").alias("other"), minhash.likeness(F.col("a.packed"), F.col("b.packed")).alias("s"))
    errors = [abs(r.s - jaccard(r.text, r.other)) for r in rows.collect()]
    assert sum(errors) / len(errors) < 0.03 and max(errors) < 0.17


def test_every_bin_has_its_least_value_and_empty_bins_borrow(spark):
    hashes = spark.range(1, 20).select(F.collect_list(F.xxhash64("id")).over(__import__("pyspark.sql").sql.Window.orderBy("id")).alias("h"))
    rows = hashes.select("h", minhash._bins(F.col("h")).alias("bins"), minhash._densified(minhash._bins(F.col("h"))).alias("low")).collect()
    for r in rows:
        want = [minhash.VALUE] * minhash.BINS
        for h in r.h:
            u = h % (1 << 64)
            want[u & 255] = min(want[u & 255], u >> 16)
        assert [b & minhash.VALUE for b in r.bins] == want and [b >> 48 for b in r.bins] == list(range(256))
        full = {w & 15 for w in want if w != minhash.VALUE}
        assert all(low == (w & 15) if w != minhash.VALUE else low in full for w, low in zip(want, r.low, strict=True))


def test_awkward_rows(awkward, nothing):
    out = minhash.edited_fingerprints(awkward).select(
        "doc_id", minhash.written(F.col("packed")).alias("f"), minhash.written(F.col("edited_packed")).alias("e"), "near_edited", "near_next"
    )
    rows = out.collect()
    assert len(rows) == awkward.count()
    assert all(len(r.f) == len(r.e) == 256 and 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert minhash.edited_fingerprints(nothing).count() == 0


def test_only_document_is_its_own_next(make_docs):
    row = minhash.edited_fingerprints(make_docs(["abcd"])).first()
    assert row.edited == "abab" and row.near_next == 1
