"""The numbered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from filingframe.llm import ann, bpe, collocations, langid, line_dedup, merkle, minhash, packing, pii, quotes, simhash, token_counts, toxicity
from filingframe.llm.common import held_out, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted")
    return found.select("doc_id", held_out().alias("held_out"), "score", predicted)


@query
def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.edited_fingerprints(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        minhash.written(F.col("packed")).alias("fingerprint"),
        minhash.written(F.col("edited_packed")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


@query
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


@query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(
        table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")
    )


@query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.remove_repeated_runs(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "removed_lines", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


ORACLE["op6_line_dedup"] = line_dedup.SQL


@query
def op7_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.reply_ordered(table(spark, sf_dir, "conversations"))


ORACLE["op7_quotes"] = quotes.SQL


@query
def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


@query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), size=4, bits=simhash.MAX_BITS)
    fingerprint = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return found.select("doc_id", fingerprint, "component_id")


@query
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.fit(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@query
def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified(merkle.manifest(table(spark, sf_dir, "documents")))


ORACLE["op11_merkle"] = merkle.SQL


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


ORACLE["op12_collocations"] = collocations.SQL


@query
def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *(f"n_{kind}" for kind in pii.KINDS),
        F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"),
        "spans",
    )


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
