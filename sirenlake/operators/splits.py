"""Reproducible train / validation / test splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranking import hash_rank, seeded_hash
from ..functions.semantics import strip
from ..functions.session import cut_lineage
from .clean import quarter_label
from .features import period_rank
from .mapping import label_encode, label_map, rare_label_group

SEED = 42
TRAIN, VALIDATION = 0.70, 0.15

# Call type is never a feature: the target is derived from it.
CLASSIFIER_FEATURES = [
    "priority_code", "priority_description", "quarter", "year", "city_code", "service_type",
    "longitude", "latitude", "completeness_score",
]
FORECASTER_KEYS = ["year", "quarter", "service_type", "city_code", "priority_code"]


def _cut(share: float) -> Column:
    """Rows of a group that lie within ``share``, rounded to the nearest whole row."""
    return F.floor(F.col("group_size") * share + 0.5)


def stratified_split(
    df: DataFrame, ids: Sequence[str], label: str | None = None, seed: int = SEED, train: float = TRAIN, validation: float = VALIDATION
) -> DataFrame:
    """Add ``split``: exact shares within each label, by the rank of a seeded hash of the row id.

    The assignment depends on ids and seed only, not on partitioning. Labels too rare for a share
    (rare labels are grouped beforehand) fall to the nearest whole row. Without a label it is a
    plain random split.
    """
    ranked = hash_rank(df.withColumn("_h", seeded_hash(seed, *ids)), [label] if label else [], "_h", "_r")
    split = (
        F.when(F.col("_r") <= _cut(train), "train")
        .when(F.col("_r") <= _cut(train + validation), "validation")
        .otherwise("test")
    )
    return ranked.withColumn("split", split).drop("_h", "_r", "group_size")


def split_frames(df: DataFrame) -> dict[str, DataFrame]:
    return {s: df.where(F.col("split") == s).drop("split") for s in ("train", "validation", "test")}


def classifier_frame(df: DataFrame, ids: Sequence[str] = (), target: str = "call_type", min_rows: int = 8) -> DataFrame:
    """Features and target without blank targets, rare labels grouped, labels coded.

    The rows are written once, as counting the labels, coding them and the result each read them. The tables of
    labels are written too, so their joins need no shuffle by label, which would gather a frequent one in one task.
    """
    kept = cut_lineage(df.select(*ids, *CLASSIFIER_FEATURES, strip(target).alias(target)).where(F.col(target) != ""))
    grouped = rare_label_group(kept, target, min_rows)
    return label_encode(grouped, label_map(grouped, target), target)


def forecaster_split(df: DataFrame) -> DataFrame:
    """Calls per five keys with a chronological role; random by hash below four periods."""
    keys = FORECASTER_KEYS
    counted = df.withColumn("quarter", quarter_label("quarter")).na.drop(subset=keys).groupBy(*keys).agg(
        F.count("*").alias("call_count")
    )
    roles = period_rank(counted).select("year", "quarter", "role")
    dated = counted.join(roles, ["year", "quarter"])
    undated = stratified_split(dated.where(F.col("role") == "random"), keys)
    return dated.where(F.col("role") != "random").unionByName(undated.withColumn("role", F.col("split")).drop("split"))


def fit_eval_split(df: DataFrame, ids: Sequence[str], seed: int = SEED, fit: float = 0.80) -> DataFrame:
    ranked = hash_rank(df.withColumn("_h", seeded_hash(seed, *ids)), [], "_h", "_r")
    return ranked.withColumn("split", F.when(F.col("_r") <= _cut(fit), "fit").otherwise("eval")).drop("_h", "_r", "group_size")
