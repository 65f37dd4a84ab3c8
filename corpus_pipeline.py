"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``.  All but the last keep the columns of documents:

* toxicity: rows whose text scores 0.5 or more go (the model is fitted to the labels of the rows at hand);
* exact_dedup: of texts equal but for white space, the row with the smallest doc_id stays;
* near_dedup: of each class of similar texts, the row with the smallest doc_id stays;
* secret_scan: no row goes; secrets are replaced by a mark, and n_chars is the new length;
* packing: one row per piece, with its place in a sequence of at most 4096 tokens.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from connlens.llm import exact_dedup, near_dedup, packing, secrets, toxicity
from connlens.session import materialize
from connlens.sources.tables import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.kept_rows(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.kept_rows(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs, length_col="n_chars" if "n_chars" in docs.columns else None)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_exact_copies), ("near_dedup", drop_near_copies), ("secret_scan", mask_secrets), ("packing", pack_sequences)]
ORACLE_SQL = None  # learned scores, similarity classes and best fit are beyond SQL; tests/llm/test_pipeline.py has brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written and read again by the next stage."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs, f"pipeline-{name}")
    return docs
