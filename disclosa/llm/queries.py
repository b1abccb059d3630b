"""The queries of the training-data operators, each over its whole table with production parameters."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from disclosa.llm import bpe, chat, covertree, mixing, pii, quality_model, quality_rules, secrets, simhash, toxicity
from disclosa.llm.common import digest, shared_folder, table
from disclosa.llm.oracles import ORACLES as ORACLES


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The ledger of these tables: a second run over them scans only texts and rule versions that are new.
    store = f"{shared_folder(spark)}/disclosa/secrets-{hashlib.sha256(sf_dir.encode()).hexdigest()[:16]}"
    found = secrets.scan_stored(table(spark, sf_dir, "documents"), store)
    base = F.filter("spans", lambda s: s["rank"] < len(secrets.BASE_RULES))
    count = lambda k: F.size(F.filter("spans", lambda s: s["rank"] == k)).cast("long")
    counts = [count(k).alias(f"n_{r.kind}") for k, r in enumerate(secrets.BASE_RULES)]
    return found.select("doc_id", *counts, digest(secrets.joined(base)).alias("base_sha256"), secrets.joined(F.col("spans")).alias("spans"))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.taken_words(mixing.mix(table(spark, sf_dir, "documents")))
    return found.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken", "first_slot")


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "</s>[INST] ok [/INST]"
    extra = spark.sql("SELECT -7L AS conv_id, turn, role, :text AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS v(turn, role)", {"text": text})
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_back(chat.format_chats(chat.events_of(rows)))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = toxicity.score_table(documents, toxicity.fit(documents, table(spark, sf_dir, "labels")))
    return found.select("doc_id", "held_out", "score", "predicted", "flagged")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.encode_table(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), digests=True)


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = quality_model.score_table(documents, quality_model.fit(documents, table(spark, sf_dir, "labels")))
    return found.select("doc_id", "held_out", "score", "predicted")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.replace(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "text", F.size("_pii_found").cast("long").alias("n_entities"), F.array_join("_pii_found", ",").alias("kinds"))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingles=False)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_secret_scans,
        op2_toxicity,
        op3_bpe,
        op4_source_mixing,
        op5_chat_formatting,
        op6_quality_rules,
        op7_quality_classifier,
        op8_pii,
        op9_embedding_near_dedup,
        op10_simhash_near_dedup,
    )
}
