"""Mixing sources to target weights along a time-varying curriculum.

Every source gets a target number of words and a schedule of relative weight over training time. A
source's demand up to time t is the integral of its schedule; inverting it turns a place in the
source's own stream of documents into a training position, and a range sort by position gives the mix.

Streams are ordered by a hash of ``doc_id``. Places in them come from sums per slice of the hash, so a
source with a third of all rows is never ordered, or gathered, in one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import word_count

Schedule = Sequence[tuple[float, float]]

WEIGHTS = (3.0, 1.0, 2.0)
SCHEDULES: tuple[Schedule, ...] = (
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.2), (0.5, 1.0), (1.0, 1.8)),
    ((0.0, 1.5), (0.5, 1.5), (1.0, 0.25)),
)


def source_targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.5, limit: float = 2.0) -> DataFrame:
    """Target words per source from ``source`` and ``source_size``.

    Sources by code point, NULL last, take the weights in turn. They divide ``share`` of all words by
    weight; a target stops at ``limit`` times its source's size and the excess goes to the others by
    weight, until none is above (the common level is found in closed form from running sums over the
    sources in the order in which they fill up). The table of sources is small: one row per source.
    """
    all_sources = Window.partitionBy(F.lit(0))
    turn = (F.row_number().over(all_sources.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    cap = F.col("source_size") * limit
    weighed = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1)).withColumn("cap", cap)
    filling = all_sources.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    full = filling.rowsBetween(Window.unboundedPreceding, -1)
    rest = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    words = F.sum("source_size").over(all_sources) * share - F.coalesce(F.sum("cap").over(full), F.lit(0.0))
    level = weighed.withColumn("level", words / F.sum("weight").over(rest))
    fits = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct((F.col("cap") / F.col("weight")).alias("at"), "level"))).over(all_sources)
    return level.withColumn("fits", F.coalesce(fits["level"], F.max("level").over(all_sources))).select(
        "source", "source_size", "weight", turn.alias("turn"), F.least("cap", F.col("fits") * F.col("weight")).alias("target")
    )


def invert_schedule(demand: Column, schedule: Schedule) -> Column:
    """Training time in [0, 1] at which a share ``demand`` of the integrated schedule is reached.

    The schedule is linear between its knots (time, weight); weights must not all be zero.
    """
    areas = [(t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(schedule, schedule[1:])]
    total = sum(areas)
    if total <= 0 or min(areas) < 0:
        raise ValueError("a schedule needs ascending times and a positive integral")
    wanted = demand * total
    time, before = F.lit(float(schedule[-1][0])), total
    for ((t0, w0), (t1, w1)), area in reversed(list(zip(zip(schedule, schedule[1:]), areas))):
        before -= area
        slope = (w1 - w0) / (t1 - t0)
        left = F.greatest(wanted - before, F.lit(0.0))
        root = F.sqrt(F.greatest(F.lit(w0 * w0) + 2 * slope * left, F.lit(0.0)))
        inside = F.lit(t0) + F.coalesce(F.try_divide(2 * left, F.lit(float(w0)) + root), F.lit(0.0))
        time = F.when(wanted <= before + area, F.least(inside, F.lit(float(t1)))).otherwise(time)
    return time


def plan_mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = 1.5,
    limit: float = 2.0,
    schedules: Sequence[Schedule] = SCHEDULES,
    text: str = "text",
) -> DataFrame:
    """Add to every document what the mix takes of it.

    New columns: ``_size`` (words), ``_source_size``, ``_target`` (of its source), ``_takes``: one
    struct per copy taken with ``epoch``, ``words`` and training ``position`` in [0, 1]. A source's
    stream is read again from its start once it is used up; the copy in which the target is reached
    counts with the words up to the target, so a source's words add up to its target, rounded down.

    NULL or empty texts have size 0 and are never taken. NULL sources are one source of their own.
    Repeated rows are documents of their own. No table columns are lost; input columns that begin
    with an underscore must not use the new names. An empty table gives an empty table.
    """
    sized = docs.withColumn("_size", word_count(F.col(text))).withColumn("_key", F.md5(F.concat_ws("|", F.lit("mix"), F.col("doc_id").cast("string"))))
    rows = docs.count()
    digits = math.ceil(math.log(max(math.sqrt(rows), 1), 16)) if rows > 1 else 0
    sized = sized.withColumn("_slice", F.substring("_key", 1, digits))
    # one key for source and slice, never NULL: the window and the join below then share one shuffle of the texts
    sized = sized.withColumn("_bin", F.concat("_slice", F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))))
    slices = sized.groupBy("source", "_slice", "_bin").agg(F.sum("_size").alias("words"))
    in_source = Window.partitionBy("source")
    before = in_source.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select("source", "_bin", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("_before"), F.sum("words").over(in_source).alias("_source_size"))
    targets = source_targets(slices.groupBy("source").agg(F.max("_source_size").alias("source_size")), weights, share, limit)
    targets = targets.select(F.col("source").alias("_s"), F.col("target").alias("_target"), "turn")
    places = slices.join(targets, F.col("source").eqNullSafe(F.col("_s"))).drop("_s", "source")
    in_slice = Window.partitionBy("_bin").orderBy("_key", "doc_id", "_size").rowsBetween(Window.unboundedPreceding, -1)
    within = sized.withColumn("_within", F.coalesce(F.sum("_size").over(in_slice), F.lit(0)))
    placed = within.join(places, "_bin").withColumn("_place", F.col("_before") + F.col("_within"))
    budget = F.floor(F.col("_target"))
    copies = []
    for epoch in range(math.ceil(limit)):
        start = F.col("_place") + epoch * F.col("_source_size")
        words = F.greatest(F.lit(0), F.least(F.col("_size"), budget - start)).cast("long")
        demand = F.try_divide(start + words / 2, budget)
        position = F.lit(None).cast("double")
        for turn in range(len(weights)):
            position = F.when(F.col("turn") == turn, invert_schedule(demand, schedules[turn % len(schedules)])).otherwise(position)
        copies.append(F.struct(F.lit(epoch).alias("epoch"), words.alias("words"), position.alias("position")))
    taken = F.filter(F.array(*copies), lambda c: c["words"] > 0)
    return placed.withColumn("_takes", taken).drop("_key", "_slice", "_bin", "_within", "_before", "_place", "turn")


def taken_words(planned: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``size``, ``source_size``, ``target`` and ``taken`` words, repeats counted."""
    taken = F.aggregate("_takes", F.lit(0).cast("long"), lambda n, c: n + c["words"])
    return planned.select("doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), taken.alias("taken"))


def mixed_documents(planned: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The documents in training order, one row per copy, whole texts.

    A copy of which the mix needs less than half is left out, one of which it needs half or more stays
    whole, so every source is within half a document of its target.
    """
    copies = planned.select("*", F.inline("_takes")).where(F.col("words") * 2 >= F.col("_size"))
    return copies.repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id", "epoch").select(*columns)
