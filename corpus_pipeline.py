"""A corpus from raw documents to packed sequences: rules, line dedup, near-dedup, mixing, packing."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.mixing import mix_to_targets, token_count
from tidemark.llm.near_dedup import near_dedup, text_key
from tidemark.llm.packing import pack_concat, pack_digest
from tidemark.llm.passage_dedup import passage_dedup
from tidemark.llm.quality_rules import quality_rules, trusted_ids
from tidemark.llm.shared import delete, fresh_path, keep, scratch, small_or_plain, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A document that lost passages goes when fewer words are left; the quality rules ask for as many.
LEAST_WORDS = 10


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. Null, empty and short texts fail them; an empty table stays empty."""
    return quality_rules(docs, trusted_ids(spark, sf_dir)).where("kept").select(COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that repeat earlier ones, wherever lines break; those that this leaves too short go.

    Documents without a repeat stay as they are, null and empty texts too.
    """
    return passage_dedup(docs).where((F.col("n_removed") == 0) | (token_count(F.col("text")) >= LEAST_WORDS)).select(COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id.

    Rows are told apart by id and text, so that another text under a dropped copy's id stays; null ids always stay.
    """
    dropped = near_dedup(docs).where("not kept").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    here = (F.col("doc_id").cast("bigint") == F.col("_id")) & (text_key() == F.col("_key"))
    return docs.join(small_or_plain(keep(dropped, "pipeline-dropped")), here, "left_anti").select(COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled to the target weights; those without words stay, null sources and languages are names."""
    return mix_to_targets(docs).where("kept").select(COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of full sequences, one row each; a null text has its end id alone."""
    return pack_digest(pack_concat(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", rules),
    ("line_dedup", lines),
    ("near_dedup", near_copies),
    ("mixing", mixture),
    ("packing", pack),
]

#: Packing needs a tokenizer, so SQL cannot express the pipeline; tests hold it against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each one's working tables go when it is written, and its input when the next one has read it."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            delete(spark, before)
        before = path
    return docs
