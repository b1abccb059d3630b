"""A corpus pipeline: toxic documents go, one of each group of near copies stays, personal data get surrogates, sources
are mixed to their weights, and what is left is encoded.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each stage's result to the shared folder and
reads it back, so a lost executor repeats one stage's tasks at most. All stages but the last return the five columns of
documents; further columns of docs are left out. Rows without a text pass through the first three stages as empty ones
do (not toxic unless training says so, fingerprint zero, no entities) and have size 0, so the mix never takes them. Rows
without a doc_id, or that share one, are documents of their own; near copies among them go like any other. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from disclosa.llm import bpe, mixing, pii, simhash, toxicity
from disclosa.llm.common import materialise, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the convolutional classifier scores below their language's threshold; it learns from the labelled ones outside its fold."""
    docs = docs.select(*COLUMNS)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored_rows(docs, model, COLUMNS[1:]).where(F.col("score") < toxicity.bound(model)).select(*COLUMNS)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies, by fingerprints or by five-word shingles: the one with the smallest doc_id."""
    return simhash.one_of_each(docs.select(*COLUMNS))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its personal data replaced, n_chars counted anew."""
    return pii.replace(docs.select(*COLUMNS), kinds=None).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, in the order of its schedule."""
    return mixing.mixed_rows(docs.select(*COLUMNS)).select(*COLUMNS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, tokens, n_tokens, decoded of every row."""
    found = bpe.encode_table(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return found.select("doc_id", "tokens", F.size("tokens").cast("long").alias("n_tokens"), "decoded")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", one_of_each),
    ("pii", without_personal_data),
    ("source_mixing", mixed),
    ("bpe", encoded),
]

#: SQL cannot express the trained classifier and the tokenizer; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
