"""From documents to packed training sequences, stage by stage.

Each stage is a function of (spark, docs, sf_dir) that works on all its predecessor
kept. All but the last return the columns of ``documents``; the result of each is
written as Parquet and read again as the next one's input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from filingframe.llm import langid, line_dedup, packing, simhash, toxicity
from filingframe.llm.common import table
from filingframe.session import materialise


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; texts without a letter or with hardly a leading language go."""
    net = langid.fit(docs)
    return langid.keep_determined(docs, net, langid.least_score(docs, net))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not score as toxic."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without runs of lines that occurred before."""
    return line_dedup.remove_repeated_runs(docs).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: linked fingerprints of four-word shingles, four bits apart at most."""
    return simhash.keep_one(docs, size=4, bits=simhash.MAX_BITS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in training sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language", language),
    ("toxicity", clean),
    ("line_dedup", lines),
    ("near_dedup", near_duplicates),
    ("packing", pack),
]

#: The stages learn their models, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents that the stages kept."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name, replaces=docs)
    return STAGES[-1][1](spark, docs, sf_dir)
