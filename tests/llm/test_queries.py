"""The numbered queries on a small folder, against brute force."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import test_ann
import test_bpe
import test_minhash
import test_simhash
import test_token_counts
from tokenizers import Tokenizer

from filingframe.llm import packing, queries


@pytest.fixture(scope="module")
def folder(spark, awkward, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    docs = awkward.filter("doc_id is not null").dropDuplicates(["doc_id"])
    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{path}/documents.parquet")
    labels = [(i, 0, i % 2) for i in range(14)] + [(3, 1, None), (None, 0, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    rng = np.random.default_rng(5)
    vectors = [(i, rng.standard_normal(8).tolist(), 0) for i in range(400)]
    vectors += [(500, vectors[100][1], 0), (600, None, 0), (700, [0.0] * 8, 0)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").write.parquet(f"{path}/embeddings.parquet")
    return path


@pytest.fixture(scope="module")
def texts(spark, folder):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}


def held(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def run(spark, folder, name):
    df = queries.QUERIES[name](spark, folder)
    return df.columns, df.collect()


def test_op1(spark, folder, texts):
    columns, rows = run(spark, folder, "op1_pack")
    assert columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {k: np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 2], "<u4") for k, t in texts.items()}
    for r in rows:
        own = ids[r.doc_id]
        assert r.doc_tokens == len(own) and r.ids_crc32 == zlib.crc32(own[r.start : r.start + r.length].tobytes())
    assert sum(r.length for r in rows) == sum(map(len, ids.values()))
    places: dict = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        own.sort()
        ends = np.cumsum([n for _, n in own])
        assert [o for o, _ in own] == [0, *ends[:-1]] and ends[-1] <= packing.WINDOW


def test_op2_and_op10(spark, folder, texts):
    columns, rows = run(spark, folder, "op2_toxicity")
    assert columns == ["doc_id", "held_out", "score", "predicted"]
    assert {r.doc_id: r.held_out for r in rows} == {i: held(i) for i in texts}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    columns, rows = run(spark, folder, "op10_language")
    assert columns == ["doc_id", "held_out", "lang_pred", "score"]
    assert {r.doc_id: r.held_out for r in rows} == {i: held(i) for i in texts}
    assert {r.doc_id: r.lang_pred for r in rows} == {i: "en" if any(map(str.isalpha, t)) else "und" for i, t in texts.items()}


def test_op3(spark, folder, texts):
    columns, rows = run(spark, folder, "op3_minhash")
    assert columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    keys = sorted(texts)
    edited = dict(zip(keys, test_minhash.edit([texts[k] for k in keys]), strict=True))
    prints = {r.doc_id: r for r in rows}
    for i, k in enumerate(keys):
        r, after = prints[k], keys[(i + 1) % len(keys)]
        assert r.n_chars == len(texts[k]) and r.edited_sha256 == hashlib.sha256(edited[k].encode()).hexdigest()
        agree = sum(a == b for a, b in zip(r.fingerprint, prints[after].fingerprint, strict=True)) / 256
        assert abs(r.near_next - max(0.0, (agree - 1 / 16) / (15 / 16))) < 1e-9
        for other in keys:
            if texts[other] == texts[k]:
                assert prints[other].fingerprint == r.fingerprint
            if edited[k] == texts[other]:
                assert r.edited_fingerprint == prints[other].fingerprint


def test_op4(spark, folder, texts):
    _, rows = run(spark, folder, "op4_byte_bpe")
    for r in rows:
        ids = test_bpe.LIBRARY.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    assert len(rows) == len(texts)


def test_op5(spark, folder, texts):
    _, rows = run(spark, folder, "op5_token_counts")
    short = {k: t for k, t in texts.items() if max(map(len, t.split()), default=0) < 1000}
    want = {k: (len(t.split()), sum(test_token_counts.brute("▁" + w) for w in t.split())) for k, t in short.items()}
    assert {r.doc_id: (r.n_words, r.n_tokens) for r in rows if r.doc_id in short} == want and len(rows) == len(texts)


def test_op8(spark, folder):
    columns, rows = run(spark, folder, "op8_nearest")
    assert columns == ["query_id", "rank", "vec_id", "score"]
    vectors = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got = {(r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in rows}
    assert len(got & test_ann.brute(vectors, 100, 10)) >= 0.9 * len(got) and len(got) == 50


def test_op9(spark, folder, texts):
    columns, rows = run(spark, folder, "op9_simhash")
    assert columns == ["doc_id", "fingerprint", "component_id"]
    prints = [(k, test_simhash.brute_fingerprint(t, 4)) for k, t in texts.items()]
    classes = test_simhash.brute_components(prints, 4)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {k: (f"{f:016x}", classes[f]) for k, f in prints}
