"""Registered queries of the operators, with production parameters, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, imatch, jaccard, lattice, lines, mixing, packing, resampling, runs, secrets, subword, token_counts, toxicity
from .common import table


def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = lines.line_groups(table(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), "line", "group", F.col("first.id").alias("first_doc_id"), F.col("first.line").alias("first_line"), "kept")


def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.report(secrets.scan(table(spark, folder, "documents")))


def op3_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken, "copies")


def op4_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    marks = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-7, 0, "user", marks), (-7, 1, "assistant", marks)], "conv_id long, turn long, role string, text string")
    return chat.digests(chat.format_conversations(turns.unionByName(added)))


def op5_imatch_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return imatch.fingerprints(table(spark, folder, "documents"))


def op6_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.join_groups(table(spark, folder, "documents"), percent=80, width=5)


def op7_lattice_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lattice.near_groups(table(spark, folder, "embeddings"), threshold=0.9)


def op8_pack_documents(spark: SparkSession, folder: str) -> DataFrame:
    definition = token_counts.read_definition(public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(packing.token_pieces(table(spark, folder, "documents"), definition))


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.score(docs, toxicity.learn(docs, table(spark, folder, "labels")))


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    definition = token_counts.read_definition(public_tokenizers.path("byte_bpe_50k.json"))
    return token_counts.count_tokens(table(spark, folder, "documents"), definition, limit=1024)


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return runs.digests(runs.looped(table(spark, folder, "documents")))


def op12_quality_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return subword.score(docs, subword.learn(docs, table(spark, folder, "labels")))


def op13_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resampling.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


QUERIES = {f.__name__: f for f in (op1_line_dedup, op2_secret_scan, op3_mix_sources, op4_chat_format, op5_imatch_fingerprints, op6_ngram_jaccard, op7_lattice_near_dedup, op8_pack_documents, op9_toxicity, op10_token_counts, op11_periodic_runs, op12_quality_embeddings, op13_importance_resampling)}

ORACLES = {
    "op4_chat_format": chat.ORACLE.replace("{turns}", "conversations"),
    "op13_importance_resampling": resampling.ORACLE.replace("{docs}", "documents").replace("{target}", "benchmark"),
    "op6_ngram_jaccard": jaccard.ORACLE.replace("{docs}", "documents"),
    "op3_mix_sources": mixing.ORACLE.format(docs="documents")
    + "SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM mixed",
}
