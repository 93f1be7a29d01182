"""Hotspots: neighbour counts, density clusters and silhouettes over positions.

All distance work runs on distinct positions (with the number of points there) and on grid cells,
so a crowd of points at one place costs one row, and a crowded cell is never paired point by point.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranking import range_rank
from ..functions.session import cut_lineage

REACH = 2  # cells of side eps / sqrt(2) can only touch within two steps
PAIR_LIMIT = 4096  # largest position x position product compared directly
SPLIT = 4  # a crowded box is cut into SPLIT x SPLIT parts
BLOCK_POSITIONS = 512


def hotspot_input(calls: DataFrame) -> DataFrame:
    """Mean position and call volume per block group; groups without a position drop out."""
    return (
        calls.where(F.col("census_block_group").isNotNull())
        .groupBy("census_block_group")
        .agg(
            F.avg("latitude").alias("latitude"),
            F.avg("longitude").alias("longitude"),
            F.count("incident_id").alias("call_volume"),
        )
        .na.drop()
    )


def _positions(points: DataFrame, x: str, y: str, side: float, key: str | None = None) -> DataFrame:
    """Distinct positions with their number of points, lowest key and home cell."""
    lowest = [F.min(key).alias("first_key")] if key else []
    return (
        points.na.drop(subset=[x, y])
        .groupBy(F.col(x).alias("x"), F.col(y).alias("y"))
        .agg(F.count("*").alias("n"), *lowest)
        .withColumns({"cx": F.floor(F.col("x") / side), "cy": F.floor(F.col("y") / side)})
    )


def _boxes(positions: DataFrame, side: float) -> DataFrame:
    """Bounding boxes of the positions that share a grid box of the given side."""
    return positions.groupBy("cx", "cy", F.floor(F.col("x") / side).alias("bx"), F.floor(F.col("y") / side).alias("by")).agg(
        F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"),
        F.sum("n").alias("n"), F.count("*").alias("m"),
    )


BOX = ["cx", "cy", "bx", "by", "x0", "x1", "y0", "y1", "n", "m"]


def _gap2(a: str, b: str) -> Column:
    """Squared smallest distance between two boxes."""
    gap = lambda lo, hi: F.greatest(F.lit(0.0), F.col(f"{a}.{lo}") - F.col(f"{b}.{hi}"), F.col(f"{b}.{lo}") - F.col(f"{a}.{hi}"))
    return gap("x0", "x1") ** 2 + gap("y0", "y1") ** 2


def _span2(a: str, b: str) -> Column:
    """Squared largest distance between two boxes."""
    span = lambda lo, hi: F.greatest(F.abs(F.col(f"{a}.{hi}") - F.col(f"{b}.{lo}")), F.abs(F.col(f"{b}.{hi}") - F.col(f"{a}.{lo}")))
    return span("x0", "x1") ** 2 + span("y0", "y1") ** 2


def _neighbour_cells(df: DataFrame, cx: str, cy: str) -> DataFrame:
    steps = F.sequence(F.lit(-REACH), F.lit(REACH))
    return df.withColumn("_dx", F.explode(steps)).withColumn("_dy", F.explode(steps)).withColumns(
        {"nx": F.col(cx) + F.col("_dx"), "ny": F.col(cy) + F.col("_dy")}
    ).drop("_dx", "_dy")


def _cells_of_pair() -> list[Column]:
    return [F.col(f"{s}.c{c}").alias(f"{s}{c}") for s in "ab" for c in "xy"]


def _near_box_pairs(left: DataFrame, right: DataFrame, eps: float, settle_cells: bool) -> tuple[list[DataFrame], list[DataFrame]]:
    """Exact split of all (left box, right box) pairs that may hold positions within eps.

    Returns, per level, the pairs wholly within eps and the pairs small enough to compare position
    by position. Pairs in between are cut into smaller boxes for the next level. With ``settle_cells`` a pair of
    cells is dropped once any of its boxes is known to touch (connectivity only).
    """
    side = eps / math.sqrt(2)
    limit = eps * eps
    boxes = _neighbour_cells(_boxes(left, side), "cx", "cy").select(F.struct(*BOX).alias("a"), "nx", "ny")
    other = _boxes(right, side)
    pairs = boxes.join(other, (F.col("nx") == other.cx) & (F.col("ny") == other.cy)).select("a", F.struct(*BOX).alias("b"))
    whole, leaves = [], []
    while True:
        pairs = pairs.where(_gap2("a", "b") <= limit)
        small = F.col("a.m") * F.col("b.m") <= PAIR_LIMIT
        state = F.when(_span2("a", "b") <= limit, "whole").when(small, "leaf").otherwise("split")
        pairs = cut_lineage(pairs.withColumn("state", state))
        whole.append(pairs.where(F.col("state") == "whole").drop("state"))
        leaves.append(pairs.where(F.col("state") == "leaf").drop("state"))
        pairs = pairs.where(F.col("state") == "split").drop("state")
        if pairs.isEmpty():
            return whole, leaves
        if settle_cells:
            touching = whole[-1].select(*_cells_of_pair()).distinct()
            pairs = pairs.select("a", "b", *_cells_of_pair()).join(touching, ["ax", "ay", "bx", "by"], "left_anti")
        for name, positions in (("a", left), ("b", right)):
            # A part knows its parent by the box its lower corner lies in.
            parts = _boxes(positions, side / SPLIT).select(
                F.struct(*BOX).alias("part"), "cx", "cy", F.floor(F.col("x0") / side).alias("px"), F.floor(F.col("y0") / side).alias("py")
            )
            parent = {"cx": F.col(f"{name}.cx"), "cy": F.col(f"{name}.cy"), "px": F.col(f"{name}.bx"), "py": F.col(f"{name}.by")}
            pairs = pairs.withColumns(parent).join(parts, list(parent)).withColumn(name, F.col("part")).select("a", "b")
        side = side / SPLIT


def _leaf_positions(leaves: list[DataFrame], left: DataFrame, right: DataFrame, eps: float) -> DataFrame:
    """Position pairs within eps from the small box pairs (each at most PAIR_LIMIT comparisons)."""

    def at(positions: DataFrame, side: float, name: str) -> DataFrame:
        box = {"bx": F.floor(F.col("x") / side), "by": F.floor(F.col("y") / side)}
        key = F.struct("cx", "cy", *[c.alias(k) for k, c in box.items()])
        return positions.select(key.alias(f"key_{name}"), *[F.col(c).alias(f"{name}_{c}") for c in ("x", "y", "n")])

    found = []
    for level, pairs in enumerate(leaves):
        side = eps / math.sqrt(2) / SPLIT**level
        keyed = pairs.select(*[F.struct(*[F.col(f"{s}.{c}").alias(c) for c in ("cx", "cy", "bx", "by")]).alias(f"key_{s}") for s in "ab"])
        both = keyed.join(at(left, side, "a"), "key_a").join(at(right, side, "b"), "key_b")
        near = (F.col("a_x") - F.col("b_x")) ** 2 + (F.col("a_y") - F.col("b_y")) ** 2 <= eps * eps
        found.append(both.where(near).drop("key_a", "key_b"))
    return reduce(DataFrame.unionByName, found)


def neighbour_count(points: DataFrame, eps: float, x: str = "latitude", y: str = "longitude") -> DataFrame:
    """Points within ``eps`` of each point, itself included."""
    side = eps / math.sqrt(2)
    positions = cut_lineage(_positions(points, x, y, side))
    whole, leaves = _near_box_pairs(positions, positions, eps, settle_cells=False)
    exact = _leaf_positions(leaves, positions, positions, eps).groupBy(F.col("a_x").alias("x"), F.col("a_y").alias("y")).agg(
        F.sum("b_n").alias("k")
    )
    parts = [exact]
    for level, pairs in enumerate(whole):
        s = side / SPLIT**level
        per_box = pairs.groupBy("a.cx", "a.cy", "a.bx", "a.by").agg(F.sum("b.n").alias("k"))
        here = positions.select("x", "y", "cx", "cy", F.floor(F.col("x") / s).alias("bx"), F.floor(F.col("y") / s).alias("by"))
        parts.append(here.join(per_box, ["cx", "cy", "bx", "by"]).select("x", "y", "k"))
    counts = reduce(DataFrame.unionByName, parts).groupBy("x", "y").agg(F.sum("k").alias("neighbours"))
    return points.join(counts.withColumnsRenamed({"x": x, "y": y}), [x, y])


def core_points(points: DataFrame, eps: float, min_samples: int, x: str = "latitude", y: str = "longitude") -> DataFrame:
    return neighbour_count(points, eps, x, y).where(F.col("neighbours") >= min_samples)


def _connected(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(v, label): the lowest vertex of each component.

    Per round all vertices with one label take the lowest label next to any of them, then the
    label of that label. Whole groups merge at once, so rounds grow with the logarithm of the size.
    """
    labels = cut_lineage(vertices.select("v", F.col("v").alias("label")))
    while True:
        near = edges.join(labels, edges.b == labels.v).groupBy("a").agg(F.min("label").alias("near"))
        seen = labels.join(near, labels.v == near.a, "left").select("v", F.col("label").alias("old"), F.least("label", "near").alias("near"))
        hooks = seen.groupBy("old").agg(F.min("near").alias("label"))
        moved = seen.select("v", "old").join(hooks, "old")
        roots = moved.select(F.col("v").alias("root"), F.col("label").alias("jump"))
        step = cut_lineage(
            moved.join(roots, F.col("label") == F.col("root")).select("v", "old", F.least("label", "jump").alias("label"))
        )
        labels = step.select("v", "label")
        if step.where(F.col("label") != F.col("old")).isEmpty():
            return labels


def dbscan(points: DataFrame, eps: float, min_samples: int, key: str, x: str = "latitude", y: str = "longitude") -> DataFrame:
    """Density clusters numbered by their first core point in key order; noise is -1.

    A cell with ``min_samples`` points is all core without any comparison; sparse cells hold few
    points, so their comparisons grow with the data only linearly. Cells, not points, form the
    graph whose components are the clusters. A border point joins its lowest-numbered neighbour.
    """
    side = eps / math.sqrt(2)
    limit = eps * eps
    positions = _positions(points, x, y, side, key)
    per_cell = positions.groupBy("cx", "cy").agg((F.sum("n") >= min_samples).alias("dense"))
    positions = cut_lineage(positions.join(per_cell, ["cx", "cy"]))

    def close(few: DataFrame, many: DataFrame) -> DataFrame:
        """Pairs within eps between the positions of sparse cells and their neighbourhood."""
        around = _neighbour_cells(few.select("x", "y", "cx", "cy"), "cx", "cy").drop("cx", "cy")
        other = many.withColumnsRenamed({"x": "ox", "y": "oy", "cx": "nx", "cy": "ny"})
        return around.join(other, ["nx", "ny"]).where((F.col("x") - F.col("ox")) ** 2 + (F.col("y") - F.col("oy")) ** 2 <= limit)

    sparse = positions.where(~F.col("dense"))
    crowd = close(sparse, positions.select("x", "y", "cx", "cy", "n")).groupBy("x", "y").agg(F.sum("n").alias("k"))
    flagged = cut_lineage(
        positions.join(crowd, ["x", "y"], "left").withColumn("core", F.col("dense") | (F.coalesce("k", F.lit(0)) >= min_samples)).drop("k")
    )
    core = flagged.where("core").select("x", "y", "cx", "cy", "n", "first_key")
    # A cell's core points are all within eps of each other: its lowest key names the vertex.
    cells = core.groupBy("cx", "cy").agg(F.min("first_key").alias("v"))
    core = cut_lineage(core.select("x", "y", "cx", "cy", "n"))
    whole, leaves = _near_box_pairs(core, core, eps, settle_cells=True)
    near = _leaf_positions(leaves, core, core, eps).select(
        *[F.floor(F.col(f"{s}_{c}") / side).alias(f"{s}{c}") for s in "ab" for c in "xy"]
    )
    for pairs in whole:
        near = near.unionByName(pairs.select(*_cells_of_pair()))
    name = lambda s: cells.select(F.col("cx").alias(f"{s}x"), F.col("cy").alias(f"{s}y"), F.col("v").alias(s))
    edges = near.where((F.col("ax") != F.col("bx")) | (F.col("ay") != F.col("by"))).distinct()
    edges = cut_lineage(edges.join(name("a"), ["ax", "ay"]).join(name("b"), ["bx", "by"]).select("a", "b"))
    labels = _connected(cells, edges)
    numbers = range_rank(labels.select("label").distinct(), [], ["label"], "cluster").withColumn("cluster", (F.col("cluster") - 1).cast("int"))
    per_cell = cells.join(labels, "v").join(numbers, "label").select("cx", "cy", "cluster")
    core_label = core.join(per_cell, ["cx", "cy"]).select("x", "y", "cx", "cy", "cluster")
    border = close(flagged.where(~F.col("core")), core_label).groupBy("x", "y").agg(F.min("cluster").alias("cluster"))
    found = core_label.select("x", "y", "cluster").unionByName(border)
    return points.join(found.withColumnsRenamed({"x": x, "y": y}), [x, y], "left").withColumn(
        "cluster", F.coalesce("cluster", F.lit(-1))
    )


def cluster_count(clustered: DataFrame) -> Column:
    return clustered.agg(F.count_distinct(F.when(F.col("cluster") >= 0, F.col("cluster")))).scalar()


def assign_clusters(clustered: DataFrame, key: str = "census_block_group") -> DataFrame:
    """Clusters without noise, block groups in total and inside hotspots."""
    inside = F.col("cluster") >= 0
    return clustered.agg(
        F.count_distinct(F.when(inside, F.col("cluster"))).alias("clusters"),
        F.count_distinct(key).alias("block_groups"),
        F.count_distinct(F.when(inside, F.col(key))).alias("block_groups_in_hotspots"),
    )


def _block_distances(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Weighted sums of distances from each position of block a to the positions of block b."""
    for pdf in batches:
        for row in pdf.itertuples(index=False):
            ax, ay, bx, by = (np.asarray(getattr(row, c)) for c in ("ax", "ay", "bx", "by"))
            weight, cluster = np.asarray(row.bn, dtype=float), np.asarray(row.bc)
            ids, slot = np.unique(cluster, return_inverse=True)
            spread = np.sqrt((ax[:, None] - bx) ** 2 + (ay[:, None] - by) ** 2) * weight
            sums = np.zeros((len(ax), len(ids)))
            for j in range(len(ids)):
                sums[:, j] = spread[:, slot == j].sum(axis=1)
            yield pd.DataFrame(
                {
                    "x": np.repeat(ax, len(ids)), "y": np.repeat(ay, len(ids)), "own": np.repeat(np.asarray(row.ac), len(ids)),
                    "cluster": np.tile(ids, len(ax)), "total": sums.ravel(),
                }
            )


def silhouette_exact(points: DataFrame, x: str = "latitude", y: str = "longitude", cluster: str = "cluster") -> DataFrame:
    """Mean Euclidean silhouette; noise counts as a cluster of its own, lone points score 0.

    Every pair of positions has to be looked at, so this is meant for aggregated centroids. Work
    is done on distinct positions in blocks of fixed size: tasks stay small, no pair is emitted,
    and the sums per (position, cluster) are exact.
    """
    weighted = points.groupBy(F.col(x).alias("x"), F.col(y).alias("y"), F.col(cluster).alias("c")).agg(F.count("*").alias("n"))
    sizes = points.groupBy(F.col(cluster).alias("cluster")).agg(F.count("*").alias("size"))
    blocks = F.greatest(F.lit(1), F.ceil(weighted.agg(F.count("*")).scalar() / BLOCK_POSITIONS))
    placed = cut_lineage(weighted.withColumn("block", F.pmod(F.xxhash64("x", "y", "c"), blocks)).withColumn("blocks", blocks))
    packed = placed.groupBy("block", "blocks").agg(F.collect_list(F.struct("x", "y", "c", "n")).alias("p"))
    pack = lambda s: [F.col(f"p.{f}").alias(f"{s}{f}") for f in "xycn"]
    left = packed.select(*pack("a"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    right = packed.select(F.col("block").alias("other"), *pack("b"))
    types = dict(placed.dtypes)
    schema = f"x {types['x']}, y {types['y']}, own {types['c']}, cluster {types['c']}, total double"
    sums = left.join(right, "other").mapInPandas(_block_distances, schema).groupBy("x", "y", "own", "cluster").agg(
        F.sum("total").alias("total")
    )
    own = F.col("cluster") == F.col("own")
    means = sums.join(sizes, "cluster").groupBy("x", "y", "own").agg(
        F.max(F.when(own, F.try_divide("total", F.col("size") - 1))).alias("a"),
        F.max(F.when(own, F.col("size"))).alias("size"),
        F.min(F.when(~own, F.col("total") / F.col("size"))).alias("b"),
    )
    score = F.when((F.col("size") > 1) & F.col("b").isNotNull(), F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0))).otherwise(0.0)
    per_position = placed.withColumnRenamed("c", "own").join(means, ["x", "y", "own"])
    real = sizes.agg(F.count_if(F.col("cluster") >= 0)).scalar()
    mean = F.try_divide(F.sum(score * F.col("n")), F.sum("n"))
    return per_position.agg(F.coalesce(mean, F.lit(0.0)).alias("m")).select(
        F.when(real > 1, F.col("m")).otherwise(0.0).alias("silhouette"), real.alias("clusters")
    )
