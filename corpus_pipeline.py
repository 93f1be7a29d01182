"""The corpus pipeline: toxicity, line dedup, MinHash near-dedup, source mixing, tokenising.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns a DataFrame,
which ``run`` writes as Parquet and reads again. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sirenlake.functions.session import scratch_path
from sirenlake.llm import line_dedup, minhash_dedup, mixing, sentencepiece_scan, toxicity
from sirenlake.llm.queries import MODEL_FILE

THRESHOLD = 0.7

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; the classifier is fitted on the labelled ones among them."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit_toxicity(docs, labels)
    return toxicity.score_toxicity(docs, model).where(F.col("_toxicity") < THRESHOLD).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that come earlier, ``n_chars`` counted anew."""
    clean = line_dedup.dedup_lines(docs)
    chars = F.when(F.col("_dropped") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return clean.withColumn("n_chars", chars).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of every group of near copies."""
    gone = minhash_dedup.near_duplicates(docs).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, as often as the mix takes them."""
    return mixing.mixed_documents(mixing.plan_mix(docs), docs.columns)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their piece numbers, which decode to the exact text."""
    vocab = sentencepiece_scan.load_vocabulary(MODEL_FILE)
    encoded = sentencepiece_scan.encode_documents(docs, vocab)
    decoded = sentencepiece_scan.decode_documents(encoded, vocab)
    exact = F.col("text").eqNullSafe(F.col("_decoded"))
    return decoded.select(*docs.columns, F.col("_ids").alias("piece_ids"), F.size("_ids").alias("n_pieces"), exact.alias("round_trip"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("MinHash near-dedup", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", tokenise),
]

ORACLE_SQL = None  # no SQL for hashed classifiers, sketches and piece paths; tests/llm compares with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        path = scratch_path(spark, "pipeline")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
