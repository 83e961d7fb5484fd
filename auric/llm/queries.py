"""Registered queries of the operators: (spark, sf_dir) -> DataFrame.

Each applies its operator, with production parameters, to the whole table and
derives the digest columns from the operator's own output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auric.llm import align as _align
from auric.llm import bpe as _bpe
from auric.llm import embed_dedup as _embed
from auric.llm import line_dedup as _lines
from auric.llm import mixing as _mixing
from auric.llm import packing as _packing
from auric.llm import qda as _qda
from auric.llm import quality_rules as _quality
from auric.llm import secrets as _secrets
from auric.llm import simhash as _simhash
from auric.llm import substring as _substring
from auric.llm import turns as _turns
from auric.llm import url_lists as _urls
from auric.llm.common import table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _secrets.digest(_secrets.secret_scan(table(spark, sf_dir, "documents")))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "repeats")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _packing.pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _quality.quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "fail_bits")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines.line_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed",
        F.array_join(F.transform("kept_lines", lambda x: x.cast("string")), ",").alias("kept_lines"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _qda.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _embed.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return _urls.url_filter(_urls.dated_captures(pages), _urls.dated_lists(pages))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _substring.substring_dedup(table(spark, sf_dir, "documents")).drop("kept")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return _turns.repair(_turns.damaged(conversations), of=conversations)


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bpe.encode(table(spark, sf_dir, "documents"), decoded=True).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _align.align(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
        F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256"))


QUERIES = {f.__name__: f for f in (op1_secret_scan, op2_mixing, op3_packing, op4_simhash, op5_quality_rules, op6_line_dedup,
                                op7_quality_classifier, op8_embedding_dedup, op9_url_filters, op10_substring_dedup,
                                   op11_conversation_repair, op12_bpe, op13_alignment)}
