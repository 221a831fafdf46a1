from __future__ import annotations

import random

import pytest
import test_simhash

import __spark_entry__ as entry
import corpus_pipeline
from filingframe.llm import queries
from tests_words import words


@pytest.fixture(scope="module")
def folder(spark, make_docs, tmp_path_factory):
    """A small corpus with a planted case for every stage."""
    def clean(seed, n=150):
        return words(seed, n).translate(str.maketrans("0123456789", "abcdefghij"))

    texts, toxic = [], []
    for i in range(120):
        texts.append(clean(i))
        if i % 5 == 0:
            texts[-1] += " vilemonger " + clean(900 + i, 5)
        toxic.append((i, 0, int(i % 5 == 0)))
    passage = clean(500, 80)
    edited = clean(601, 400).split()
    edited[399] = "swapped"
    texts += [
        clean(600) + "\n" + passage, clean(602) + "\n" + passage,  # a passage in two documents
        clean(601, 400), " ".join(edited), clean(601, 400),  # near and exact copies
        clean(603) + " v1lem0nger", "12345 67890", None, "",
    ]
    path = str(tmp_path_factory.mktemp("corpus"))
    docs = make_docs(texts, ["en" if i % 3 else "de" for i in range(len(texts))])
    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(toxic, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == columns
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
    everything = set(range(129))
    assert set(kept["language"]) == everything - {126, 127, 128}
    assert set(kept["toxicity"]) == set(kept["language"]) - {i for i in range(0, 120, 5)} - {125}
    assert set(kept["line_dedup"]) == set(kept["toxicity"])
    assert "\n" in kept["line_dedup"][120] and "\n" not in kept["line_dedup"][121]
    assert kept["line_dedup"][124] == ""  # an exact copy repeats its only line
    prints = [(i, test_simhash.brute_fingerprint(t, 4)) for i, t in kept["line_dedup"].items()]
    classes = test_simhash.brute_components(prints, 4)
    gone = set(kept["line_dedup"]) - set(kept["near_dedup"])
    assert gone == {i for i, p in prints if classes[p] != i} and 123 in gone
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == set(kept["near_dedup"])


def test_run_equals_its_stages(spark, folder):
    got = corpus_pipeline.run(spark, folder)
    assert got.count() >= 90 and got.columns[:3] == ["doc_id", "start", "length"]


def test_all_are_registered():
    names = list(entry.queries())
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13 and "pipeline" in names
    assert set(queries.ORACLE) <= set(queries.QUERIES) and random


@pytest.mark.parametrize("empty", ["documents", "labels", "both"])
def test_empty_tables(spark, folder, tmp_path, empty):
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    (docs.filter("false") if empty != "labels" else docs.limit(20)).write.parquet(f"{tmp_path}/documents.parquet")
    (labels.filter("false") if empty != "documents" else labels).write.parquet(f"{tmp_path}/labels.parquet")
    assert (corpus_pipeline.run(spark, str(tmp_path)).count() > 0) == (empty == "labels")


def test_columns_that_clash(spark, folder):
    names = ["_number", "_doc_id", "_text_hash", "_runs", "removed_lines", "piece", "place"]
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(30).selectExpr("*", *(f"1 as {n}" for n in names))
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert sorted(docs.columns) == sorted(columns)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() > 0
