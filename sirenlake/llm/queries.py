"""Thin queries over the whole tables, one per operator."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bm25_search, bpe, embedding_dedup, importance, line_dedup, max_sketch_search, minhash_dedup, mixing, pii, run_detection, sentencepiece_scan, toxicity, url_filter

TOKENIZER_FILE = os.environ.get("BPE_TOKENIZER", "/opt/tokenizers/word_bpe_49k.json")
MODEL_FILE = os.environ.get("SENTENCEPIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_bm25_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten best documents for every document whose id is divisible by 20."""
    docs = _table(spark, sf_dir, "documents")
    return bm25_search.top_documents(docs, docs.where("doc_id % 20 = 0"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines before and dropped, and the digest of the text that stays."""
    docs = line_dedup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", F.col("_lines").alias("n_lines"), F.col("_dropped").alias("n_dropped"), F.sha2("text", 256).alias("text_sha256"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and digest of the pieces of every text, and whether they decode to it."""
    vocab = sentencepiece_scan.load_vocabulary(MODEL_FILE)
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    decoded = sentencepiece_scan.decode_documents(sentencepiece_scan.encode_documents(docs, vocab), vocab)
    return decoded.select(
        "doc_id", F.size("_ids").cast("long").alias("n_pieces"), F.xxhash64("_ids").alias("pieces_hash"), F.col("text").eqNullSafe(F.col("_decoded")).alias("round_trip")
    )


def op6_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "labels"))


def op7_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(_table(spark, sf_dir, "documents"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicate_vectors(_table(spark, sf_dir, "embeddings"))


def op9_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(mixing.plan_mix(_table(spark, sf_dir, "documents")))


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and digest of the tokens of every text, and the digest of what they decode to."""
    return bpe.token_digests(_table(spark, sf_dir, "documents"), bpe.load_bpe(TOKENIZER_FILE))


def op12_max_sketch_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten best documents for every benchmark item."""
    found = max_sketch_search.rank_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("item_id", "rank", "doc_id", "score")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_detection.detect_runs(_table(spark, sf_dir, "documents"), tail=True)


OPERATORS: tuple[Query, ...] = (
    op1_toxicity,
    op2_importance_resampling,
    op3_bm25_search,
    op4_line_dedup,
    op5_sentencepiece,
    op6_url_reputation,
    op7_pii_spans,
    op8_embedding_dedup,
    op9_minhash_dedup,
    op10_source_mix,
    op11_bpe,
    op12_max_sketch_search,
    op13_periodic_runs,
)
LLM_QUERIES: dict[str, Query] = {f.__name__: f for f in OPERATORS}
