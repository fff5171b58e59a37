"""Registered queries of the operators, with production parameters, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import materialize
from ..suite.registry import table
from . import (bpe, collocations, html_extraction, jaccard, lexical_search, line_dedup, neighbours, packing, quality, sharding,
               simhash, sql, token_counts, toxicity)

SHARDS = 24
MAX_TOKENS = 2048
WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.json"


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    counted = token_counts.token_counts(docs, public_tokenizers.path(WORD_BPE))
    return counted.withColumn("over_limit", F.col("n_tokens") > MAX_TOKENS)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, public_tokenizers.path(WORD_BPE), limit=MAX_TOKENS)


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, F.col("vec_id") % 20 == 0).withColumnRenamed("id", "vec_id")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    return toxicity.score(docs, model).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.jaccard_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    extracted = html_extraction.extract(table(spark, sf_dir, "pages"), ["page_id", "url"])
    return extracted.withColumn("n_chars", F.char_length("text").cast("bigint"))


def op9_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", (F.octet_length(text) + 8).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.md5(text.cast("binary")).alias("text_md5"))
    placed = sharding.hilbert_shards(docs, ["source", "lang", "size"], SHARDS, ["text_md5", "doc_id"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "curve")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.assess(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = materialize(simhash.compare_with_next(table(spark, sf_dir, "documents")), "fingerprints")
    near = simhash.within_radius(compared.select("hi", "lo")).select("hi", "lo", "n_near")
    return compared.join(near, ["hi", "lo"]).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
        (F.col("n_near") - 1).alias("n_near"))


QUERIES = {f.__name__: f for f in (
    op1_token_counts, op2_packing, op3_neighbours, op4_toxicity, op5_bpe,
    op6_jaccard_join, op7_line_dedup, op8_html_extraction, op9_hilbert_sharding, op10_quality_rules,
    op11_collocations, op12_lexical_search, op13_fingerprints)}
ORACLES = {"op7_line_dedup": sql.LINE_DEDUP, "op9_hilbert_sharding": sql.hilbert_sharding(SHARDS),
           "op11_collocations": sql.collocations(), "op12_lexical_search": sql.lexical_search()}
