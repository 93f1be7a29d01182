"""Quality by importance resampling: hashed n-gram models of target and raw text, sampled by Gumbel top-k.

Words and pairs of words fall into buckets. The target model counts the buckets of all labelled good
documents, the raw model those of all documents. A document's log weight is the sum over its
n-grams of the log ratio of the two models; adding seeded Gumbel noise and taking the k largest keys samples
k documents without replacement in proportion to their weights.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sirenlake.functions.session import cut_lineage

from .common import BASE, Words, mix, pieces

FILTER = 1 << 20  # numbers of the filter of good ids
BUCKETS = 10_000
BINS = 1024
FEW = 4096


def ngram_buckets(data: np.ndarray, offsets: np.ndarray, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and document of every word and of every two neighbouring words."""
    words = Words(data, offsets)
    h, doc = words.hashes, words.doc
    pair = mix(h[:-1] * BASE + h[1:])[doc[:-1] == doc[1:]] if len(h) > 1 else h[:0]
    of_pair = doc[:-1][doc[:-1] == doc[1:]] if len(h) > 1 else doc[:0]
    return (np.concatenate([h, pair]) % np.uint64(buckets)).astype(np.int64), np.concatenate([doc, of_pair])


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """N-grams per bucket over all of ``docs``; every task sends one row per bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, data, offsets in pieces(batch):
                total += np.bincount(ngram_buckets(data, offsets, buckets)[0], minlength=buckets)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(buckets)), pa.array(total)], ["bucket", "n"])

    return collected(docs.select("text").mapInArrow(count, "bucket long, n long"), buckets)


def target_counts(docs: DataFrame, good: DataFrame, buckets: int) -> np.ndarray:
    """N-grams per bucket over the documents whose id is in ``good``, without sending a text between tasks.

    A filter of at most FILTER numbers, so small enough for a broadcast, lets all good documents and few others
    through. Their bucket numbers, packed, then meet the good ids in the same kind of join at every size.
    """
    number = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER)).alias("number")
    thin = docs.select("doc_id", "text", number).join(F.broadcast(good.select(number).distinct()), "number", "left_semi")
    kind = np.dtype(np.uint16 if buckets <= 1 << 16 else np.uint32)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in pieces(batch):
                bucket, doc = ngram_buckets(data, offsets, buckets)
                order = np.argsort(doc, kind="stable")
                ends = np.searchsorted(doc[order], np.arange(end - row + 1))
                packed = bucket[order].astype(kind)
                lists = pa.array([packed[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(row, end - row), lists], ["doc_id", "packed"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for packed in batch.column("packed"):
                total += np.bincount(np.frombuffer(packed.as_buffer(), kind), minlength=buckets)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(buckets)), pa.array(total)], ["bucket", "n"])

    met = thin.select("doc_id", "text").mapInArrow(pack, "doc_id long, packed binary").join(good.hint("merge"), "doc_id", "left_semi")
    return collected(met.select("packed").mapInArrow(count, "bucket long, n long"), buckets)


def collected(rows: DataFrame, buckets: int) -> np.ndarray:
    """Sums by bucket, on the driver."""
    out = np.zeros(buckets, np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Log ratio of the two models per bucket, with one n-gram added to each bucket."""
    return np.log((target + 1) / (target + 1).sum()) - np.log((raw + 1) / (raw + 1).sum())


def gumbel(seed: int, *columns: str) -> Column:
    """Standard Gumbel noise, the same for the same columns."""
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11) + 0.5) / float(1 << 53)
    return -F.log(-F.log(uniform))


def kth_largest(rows: DataFrame, column: str, k: int) -> float:
    """Exact k-th largest value of a finite column with at least k rows, by histograms over ever smaller spans."""
    low, high = rows.agg(F.min(column), F.max(column)).first()
    while low < high:
        inside = rows.where(F.col(column).between(low, high))
        step = (high - low) / BINS
        at = F.least(F.floor((F.col(column) - low) / step), F.lit(BINS - 1)) if step > 0 else F.lit(0)
        bins = sorted(inside.groupBy(at.alias("bin")).agg(F.count("*"), F.min(column), F.max(column)).collect(), reverse=True)
        for _, n, a, b in bins:
            if k <= n:
                break
            k -= n
        if n <= FEW or (a, b) == (low, high):
            return sorted((r[0] for r in rows.where(F.col(column).between(a, b)).select(column).collect()), reverse=True)[k - 1] if n <= FEW else a
        low, high = a, b
    return low


def resample(
    docs: DataFrame, labels: DataFrame, share: float = 0.5, buckets: int = BUCKETS, temperature: float = 1.0, seed: int = 11
) -> DataFrame:
    """``doc_id``, ``log_weight``, ``gumbel_key``, ``selected`` per document.

    The target is all documents labelled as good. Of n rows, the ceil(n * share) with the largest keys are selected, and rows with a key equal to the last one's.
    NULL and empty texts weigh 0. Repeated rows have equal keys; NULL ids share one noise. Without good labels
    the weights are those of an empty target model. An empty table gives an empty result.
    """
    good = labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    ratio = log_ratio(target_counts(docs, good, buckets), bucket_counts(docs, buckets))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in pieces(batch):
                bucket, doc = ngram_buckets(data, offsets, buckets)
                weight = np.bincount(doc, ratio[bucket], end - row)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(row, end - row), pa.array(weight, pa.float64())], ["doc_id", "log_weight"])

    weighed = docs.select("doc_id", "text").mapInArrow(weigh, "doc_id long, log_weight double")
    keyed = cut_lineage(weighed.withColumn("gumbel_key", F.col("log_weight") / temperature + gumbel(seed, "doc_id")))
    k = math.ceil(keyed.count() * share)
    last = kth_largest(keyed, "gumbel_key", k) if k else math.inf
    return keyed.withColumn("selected", F.col("gumbel_key") >= last)
