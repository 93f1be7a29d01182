"""Exact ranks and order statistics that never sort a whole hot group in one task."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .session import cut_lineage

BINS = 1024


def seeded_hash(seed: int, *ids: str) -> Column:
    """Uniform 32-hex-digit key of a row; the same in every engine and for every partitioning."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in ids]))


def hash_int(hex_key: Column, start: int = 1, digits: int = 8) -> Column:
    return F.conv(F.substring(hex_key, start, digits), 16, 10).cast("bigint")


def _join_offsets(rows: DataFrame, offsets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Equi-join that keeps rows with a missing group (they form a group of their own)."""
    renamed = offsets.withColumnsRenamed({k: f"_o_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_o_{k}")) for k in keys])
    return rows.join(renamed, same).drop(*[f"_o_{k}" for k in keys])


def hash_rank(df: DataFrame, groups: Sequence[str], key: str, name: str = "rank") -> DataFrame:
    """1-based rank by the hash column ``key`` within ``groups`` plus the group size.

    The first hex digits split each group, however hot, into even slices: about as many as a slice of
    the whole table then has rows, so neither the slices nor the table of their counts grows too large.
    Slice counts give the offset of a slice, so only slices are ever sorted. The offsets are written, so that
    Spark knows their size and joins them without another shuffle of the rows while they are small.
    """
    groups = list(groups)
    digits = max(3, math.ceil(math.log(max(df.count(), 1), 16) / 2))
    sliced = df.withColumn("_slice", F.substring(key, 1, digits))
    per_slice = sliced.groupBy(*groups, "_slice").agg(F.count("*").alias("_n"))
    of_group = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    before = of_group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut_lineage(per_slice.select(
        *groups,
        "_slice",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(of_group).alias("group_size"),
    ))
    in_slice = Window.partitionBy(*groups, "_slice").orderBy(key)
    return (
        _join_offsets(sliced, offsets, [*groups, "_slice"])
        .withColumn(name, F.col("_before") + F.row_number().over(in_slice))
        .drop("_slice", "_before")
    )


def range_rank(
    df: DataFrame, groups: Sequence[str], order: Sequence[str], name: str = "rank", partitions: int | None = None
) -> DataFrame:
    """1-based rank within ``groups`` by ``order`` (which must be unique within a group).

    A range shuffle on groups + order splits hot groups and ties alike. The result is
    written out first, so partition numbers and offsets always describe the same rows.
    """
    groups, order = list(groups), list(order)
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = cut_lineage(
        df.repartitionByRange(n, *groups, *order).withColumn("_pid", F.spark_partition_id())
    )
    per_part = placed.groupBy(*groups, "_pid").agg(F.count("*").alias("_n"))
    of_group = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    before = of_group.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select(
        *groups, "_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    in_part = Window.partitionBy(*groups, "_pid").orderBy(*order)
    return (
        _join_offsets(placed, offsets, [*groups, "_pid"])
        .withColumn(name, F.col("_before") + F.row_number().over(in_part))
        .drop("_pid", "_before")
    )


def order_statistics(values: DataFrame, column: str, ranks: Mapping[str, Callable[[int], int]]) -> dict[str, float | None]:
    """Exact k-th smallest values; a rank is a function of ``n``, the number of values that are neither NULL nor NaN.

    Infinite values are counted and ranked apart. Histograms over the raw rows, combined inside every task,
    narrow each rank down until its bin holds a single value; the next level spans just the smallest to the
    largest value of that bin, so the span shrinks every time. The driver sees at most BINS rows per rank.
    """
    v = F.col("v")
    kept = values.select(F.col(column).cast("double").alias("v")).where(v.isNotNull() & ~F.isnan("v")).persist()
    try:
        infinite = F.abs("v") == math.inf
        low, high, below, above, n = kept.agg(
            F.min(F.when(~infinite, v)), F.max(F.when(~infinite, v)), F.count_if(v == -math.inf), F.count_if(v == math.inf), F.count("v")
        ).first()
        if not n:
            return {"n": 0} | dict.fromkeys(ranks)
        found: dict[str, float | None] = {"n": n}
        todo = {}
        for name, rank in ranks.items():
            k = min(max(int(rank(n)), 1), n)
            if k <= below or k > n - above:
                found[name] = -math.inf if k <= below else math.inf
            else:
                todo[name] = (low, high, k - below)
        while todo:
            spans = F.array(*[F.struct(F.lit(k).alias("name"), F.lit(a).alias("a"), F.lit(b).alias("b")) for k, (a, b, _) in todo.items()])
            inside = kept.select("v", F.inline(spans)).where(v.between(F.col("a"), F.col("b")))
            # halves, so that the distance of two large numbers stays finite
            share = F.try_divide(v / 2 - F.col("a") / 2, F.col("b") / 2 - F.col("a") / 2)
            bin_no = F.when(v == F.col("b"), BINS).otherwise(F.coalesce(F.floor(share * BINS), F.lit(0)))
            hist = inside.groupBy("name", bin_no.alias("bin")).agg(F.count("*"), F.min("v"), F.max("v")).collect()
            for name in list(todo):
                left = todo[name][2]
                for _, _, c, a, b in sorted((h for h in hist if h[0] == name), key=lambda h: h[1]):
                    if left <= c:
                        break
                    left -= c
                if a == b:
                    found[name] = a
                    del todo[name]
                else:
                    todo[name] = (a, b, left)
        return found
    finally:
        kept.unpersist()


def interpolated_ranks(name: str, p: float) -> dict[str, Callable[[int], int]]:
    """The two ranks around the linear-interpolation quantile ``p``."""
    return {f"{name}_lo": lambda n: math.floor((n - 1) * p) + 1, f"{name}_hi": lambda n: math.ceil((n - 1) * p) + 1}


def interpolate(found: Mapping[str, float | None], name: str, p: float) -> float | None:
    if not found["n"]:
        return None
    pos = (found["n"] - 1) * p
    low, high = found[f"{name}_lo"], found[f"{name}_hi"]
    return low + (high - low) * (pos - math.floor(pos))
