"""Rule-based mapping of call types and labels."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.semantics import round_even, strip
from ..functions.session import cut_lineage

DEFAULT_GROUP = "Unknown Problem"
RARE_LABEL = "Other / Rare Call Type"
OTHER_LABEL = "Other"
MIN_LABEL_ROWS = 8


def map_call_group(
    df: DataFrame,
    lookup: DataFrame,
    rules: Sequence[tuple[Sequence[str], str]],
    source: str = "call_type",
    target: str = "mpds_group",
    default: str = DEFAULT_GROUP,
) -> DataFrame:
    """Exact lookup, then ordered all-keywords rules, then the default.

    ``lookup`` is a table (call_key, call_group); it is written first, so that Spark knows its size and broadcasts
    it when that allows, as a shuffle by call type would gather a frequent or missing type in one task. The rules are
    configuration and become one CASE expression.
    """
    keyed = df.withColumn("_key", F.upper(strip(source)))
    by_key = cut_lineage(lookup.select(F.upper(strip("call_key")).alias("_key"), F.col("call_group").alias("_hit")))

    def applies(words: Sequence[str]) -> Column:
        return reduce(lambda a, b: a & b, [F.col("_key").contains(w) for w in words])

    ruled = [F.when(applies(words), F.lit(group)) for words, group in rules]
    return (
        keyed.join(by_key, "_key", "left")
        .withColumn(target, F.coalesce("_hit", *ruled, F.lit(default)))
        .drop("_key", "_hit")
    )


def mapping_coverage(df: DataFrame, target: str = "mpds_group", default: str = DEFAULT_GROUP) -> DataFrame:
    mapped = (F.col(target) != default).cast("double")
    return df.agg(F.coalesce(F.avg(mapped), F.lit(0.0)).alias("coverage"), F.count("*").alias("total_rows"))


def mapping_report(df: DataFrame, source: str = "call_type", target: str = "mpds_group", default: str = DEFAULT_GROUP) -> DataFrame:
    """Per call type and group: rows, percent of all rows, mapped or not."""
    per_type = df.where(F.col(source).isNotNull()).groupBy(source, target).agg(F.count("*").alias("count"))
    total = df.agg(F.count("*")).scalar()
    return per_type.withColumns(
        {
            "pct": round_even(F.col("count") / total * 100.0, 2),
            "is_mapped": F.col(target) != default,
        }
    )


def collapse_long_tail(train: DataFrame, frames: Sequence[DataFrame], label: str, top_n: int, other: str = OTHER_LABEL) -> list[DataFrame]:
    """Keep the ``top_n`` most frequent training classes in every frame, the rest become ``other``.

    With no more than ``top_n`` classes there is no tail, and the frames stay as they are.
    """
    classes = train.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("_n"))
    if classes.limit(top_n + 1).count() <= top_n:
        return list(frames)
    kept = classes.orderBy(F.desc("_n"), label).limit(top_n).select(label, F.lit(True).alias("_kept"))
    return [
        f.join(kept, label, "left")
        .withColumn(label, F.when(F.col("_kept"), F.col(label)).otherwise(F.lit(other)))
        .drop("_kept")
        for f in frames
    ]


def rare_label_group(df: DataFrame, label: str, min_rows: int = MIN_LABEL_ROWS, rare: str = RARE_LABEL) -> DataFrame:
    """Labels with fewer than ``min_rows`` rows share one name; only the rare ones are written and joined."""
    few = cut_lineage(
        df.where(F.col(label).isNotNull())
        .groupBy(label)
        .agg(F.count("*").alias("_n"))
        .where(F.col("_n") < min_rows)
        .select(label, F.lit(True).alias("_rare"))
    )
    return (
        df.join(few, label, "left")
        .withColumn(label, F.when(F.col("_rare"), F.lit(rare)).otherwise(F.col(label)))
        .drop("_rare")
    )


def label_map(df: DataFrame, label: str, code: str = "label_code") -> DataFrame:
    """Distinct labels in alphabetical order with codes from 0 (one row per class), written, so that its size is known."""
    classes = df.where(F.col(label).isNotNull()).select(label).distinct()
    in_order = Window.partitionBy(F.lit(0)).orderBy(label)
    return cut_lineage(classes.withColumn(code, (F.row_number().over(in_order) - 1).cast("int")))


def label_encode(df: DataFrame, classes: DataFrame, label: str) -> DataFrame:
    return df.join(classes, label, "left")


def align_label_space(df: DataFrame, classes: DataFrame, label: str, other: str = OTHER_LABEL) -> DataFrame:
    """Classes the model never saw become ``other``, but only if the model knows ``other``."""
    known = classes.select(label, F.lit(True).alias("_known"))
    has_other = classes.agg(F.bool_or(F.col(label) == other)).scalar()
    return (
        df.join(known, label, "left")
        .withColumn(
            label,
            F.when(F.col("_known").isNull() & F.coalesce(has_other, F.lit(False)), F.lit(other)).otherwise(F.col(label)),
        )
        .drop("_known")
    )
