"""Pipeline over the documents of a folder: each stage's rows are written and reread as the next one's documents.

A stage gives its operator the id, the text and all columns as one struct, so extra columns of any name pass through
untouched; where the operator runs in Python the struct lacks the text, which then goes there only once. Nulls, empty texts, repeated rows and empty tables are treated as the operators say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from panelspark.llm import jaccard, line_dedup, packing, quality, toxicity
from panelspark.session import materialize
from panelspark.suite.registry import table

MAX_TOKENS = 2048


def wrapped(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"))


def apart(docs: DataFrame) -> DataFrame:
    """The text, and all other columns as one struct."""
    return docs.select("text", F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("__row"))


def joined(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The columns that ``apart`` took apart."""
    return rows.select(*[F.col("text") if c == "text" else F.col("__row").getField(c).alias(c) for c in columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine does not call toxic."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return joined(toxicity.score(apart(docs), model, ["__row", "text"]).where("predicted = 0"), docs.columns)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose lines are mostly content."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return joined(quality.assess(apart(docs), model, ["__row", "text"]).where("kept"), docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that others repeat."""
    return line_dedup.dedup_lines(wrapped(docs)).select(
        F.col("__row").withField("text", F.col("text")).alias("__row")).select("__row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    return jaccard.one_per_component(wrapped(docs)).select("__row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their place in sequences."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(docs.select("doc_id", "text"), path, limit=MAX_TOKENS)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", drop_low_quality),
    ("line dedup", drop_repeated_lines),
    ("near duplicates", drop_near_duplicates),
    ("packing", pack),
]

ORACLE_SQL = None  # trained models and tokenizers are not SQL; tests compare with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
