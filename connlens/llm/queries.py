"""The registered queries of the corpus operators, over the whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from connlens.llm import (bpe, conversation_repair, exact_dedup, hamming, hard_negatives, near_dedup, packing, secrets, sharding,
                          substring_dedup, token_counts, toxicity, warc)
from connlens.session import materialize
from connlens.sources.tables import table


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.spans(table(spark, sf_dir, "documents"), passage=substring_dedup.PASSAGE)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.verdicts(table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.report(table(spark, sf_dir, "pages")).drop("archive", "place", "length")


def op4_hamming_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = materialize(hamming.sign_codes(table(spark, sf_dir, "embeddings"), "vec_id", "embedding"), "sign-codes")
    return hamming.search(codes, codes.where("id % 50 = 0"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    ids = bpe.encode(table(spark, sf_dir, "documents"), path)
    return ids.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(bpe.decoded(F.col("ids"), path), 256).alias("decoded_sha256"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents"), "doc_id")


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.report(table(spark, sf_dir, "embeddings"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.report(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_warc": op3_warc,
    "op4_hamming_topk": op4_hamming_topk,
    "op5_bpe": op5_bpe,
    "op6_sharding": op6_sharding,
    "op7_near_dedup": op7_near_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_packing": op9_packing,
    "op10_secrets": op10_secrets,
    "op11_token_counts": op11_token_counts,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLE_SQL = {
    "op2_exact_dedup": exact_dedup.VERDICT_SQL,
    "op3_warc": warc.REPORT_SQL,
    "op4_hamming_topk": hamming.SEARCH_SQL,
    "op6_sharding": sharding.placement_sql("documents", "doc_id"),
    "op12_hard_negatives": hard_negatives.REPORT_SQL,
    "op13_conversation_repair": conversation_repair.REPORT_SQL,
}
