"""Isolation forest on Spark: fixed-size random trees, scored by partition."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranking import hash_int, hash_rank, order_statistics, seeded_hash
from ..functions.semantics import drop_null_keys, ratio, round_even
from ..functions.session import cut_lineage
from .features import zscore_scale

TREES = 100
TREE_ROWS = 256
CONTAMINATION = 0.05
TOP_SHARE = 0.2
FEATURES = ["latitude", "longitude", "hour", "day_of_week", "month"]
NODE_SCHEMA = "tree int, node int, feature int, cut double, depth int, rows int"


def average_path(n: np.ndarray | float) -> np.ndarray | float:
    """Expected depth of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=float)
    harmonic = np.log(np.maximum(n - 1, 1)) + np.euler_gamma
    return np.where(n > 2, 2 * harmonic - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


def _grow(features: Sequence[str], seed: int):
    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        """Node table of one tree from its (at most TREE_ROWS) rows, in a fixed row order."""
        tree = int(pdf["tree"].iloc[0])
        data = pdf.sort_values("_h")[list(features)].to_numpy(dtype=float)
        rng = np.random.default_rng([seed, tree])
        limit = math.ceil(math.log2(max(len(data), 2)))
        nodes, todo = [], [(1, data, 0)]
        while todo:
            node, rows, depth = todo.pop()
            spread = np.ptp(rows, axis=0) if len(rows) else np.zeros(len(features))
            choices = np.flatnonzero(spread > 0)
            if depth >= limit or len(rows) <= 1 or len(choices) == 0:
                nodes.append((tree, node, -1, 0.0, depth, len(rows)))
                continue
            f = int(rng.choice(choices))
            cut = float(rng.uniform(rows[:, f].min(), rows[:, f].max()))
            nodes.append((tree, node, f, cut, depth, len(rows)))
            left = rows[:, f] <= cut
            todo += [(2 * node, rows[left], depth + 1), (2 * node + 1, rows[~left], depth + 1)]
        return pd.DataFrame(nodes, columns=["tree", "node", "feature", "cut", "depth", "rows"])

    return grow


def isolation_forest_fit(df: DataFrame, ids: Sequence[str], features: Sequence[str] = FEATURES, trees: int = TREES, seed: int = 42) -> DataFrame:
    """Node table of a forest on z-scored features (those present).

    Rows are put in the order of a seeded hash; the first trees x 256 of them form a pool, and
    each tree takes the next 256 of the pool, going round when it is short. So fitting costs the
    same for any input size and gives the same trees for any partitioning.
    """
    used = [f for f in features if f in df.columns]
    complete = df.na.drop(subset=used)
    hashed = zscore_scale(complete, used).select(seeded_hash(seed, *ids).alias("_h"), *[F.col(f"{f}_z").cast("double").alias(f) for f in used])
    # Four times the pool is far more than enough for its lowest hashes, so big inputs send only
    # that many rows to the sort; the pool itself is the same as without this filter.
    wanted = trees * TREE_ROWS
    near = hash_int(F.col("_h")) < 4.0 * wanted / complete.agg(F.count("*")).scalar() * 2**32
    pool = hashed.where(near).orderBy("_h").limit(wanted)
    one = Window.partitionBy(F.lit(0))
    placed = pool.withColumns({"_r": F.row_number().over(one.orderBy("_h")) - 1, "_n": F.count("*").over(one)})
    takes = lambda t: F.pmod(F.col("_r") - t * TREE_ROWS, F.col("_n")) < TREE_ROWS
    members = placed.withColumn("tree", F.explode(F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), takes)))
    return members.select("tree", "_h", *used).groupBy("tree").applyInPandas(_grow(used, seed), NODE_SCHEMA)


def isolation_forest_score(df: DataFrame, nodes: DataFrame, features: Sequence[str] = FEATURES, contamination: float = CONTAMINATION, flag: bool = True) -> DataFrame:
    """Add ``anomaly_score`` (lower is more anomalous) and a flag for the lowest share.

    The node table has a fixed size (trees x at most 511 nodes) and is shipped to the tasks.
    """
    used = [f for f in features if f in df.columns]
    model = nodes.toPandas().sort_values(["tree", "node"])
    tables = []
    for _, t in model.groupby("tree"):
        size = int(t["node"].max()) + 1
        feature, cut, length = np.full(size, -1), np.zeros(size), np.zeros(size)
        at = t["node"].to_numpy()
        feature[at], cut[at] = t["feature"], t["cut"]
        length[at] = t["depth"] + average_path(t["rows"].to_numpy())
        tables.append((feature, cut, length))
    norm = float(average_path(min(TREE_ROWS, int(model.loc[model["node"] == 1, "rows"].max()))))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            data = pdf[zcols].to_numpy(dtype=float)
            total = np.zeros(len(data))
            for feature, cut, length in tables:
                node = np.ones(len(data), dtype=int)
                while True:
                    f = feature[node]
                    inner = np.flatnonzero(f >= 0)
                    if len(inner) == 0:
                        break
                    here = node[inner]
                    node[inner] = 2 * here + (data[inner, f[inner]] > cut[here])
                total += length[node]
            pdf["anomaly_score"] = -np.power(2.0, -(total / len(tables)) / norm)
            yield pdf.drop(columns=zcols)

    scaled = zscore_scale(df.na.drop(subset=used), used)
    zcols = [f"{f}_z" for f in used]
    scaled = scaled.withColumns({c: F.col(c).cast("double") for c in zcols})
    schema = ", ".join(f"`{n}` {t}" for n, t in df.dtypes) + ", anomaly_score double"
    scored = scaled.mapInPandas(score, schema)
    if not flag:
        return scored
    scored = cut_lineage(scored)  # the threshold and the result share one scoring pass
    cutoff = order_statistics(scored, "anomaly_score", {"cutoff": lambda n: math.ceil(n * contamination)})["cutoff"]
    return scored.withColumn("is_anomaly", F.col("anomaly_score") <= F.lit(cutoff))


def recall_top_share(df: DataFrame, score: str, ids: Sequence[str], priority: str = "priority_code", share: float = TOP_SHARE, seed: int = 42) -> DataFrame:
    """Share of the high-priority rows among the lowest-scored ``share`` of all rows.

    Scores are compared at six digits; equal scores are ordered by a seeded hash of the row id.
    The cut-off score is found by counting; just the rows on it are ranked.
    """
    high = F.coalesce(F.col(priority).rlike("E1|F1"), F.lit(False))
    rows = drop_null_keys(df, score).select(round_even(F.col(score), 6).alias("s"), high.alias("high"), seeded_hash(seed, *ids).alias("h"))
    found = order_statistics(rows, "s", {"cutoff": lambda n: math.floor(n * share)})
    quota = math.floor(found["n"] * share)
    below = F.col("s") < F.lit(found["cutoff"])
    total, under, hit = rows.agg(F.count_if("high"), F.count_if(below), F.count_if(below & F.col("high"))).first()
    tied = hash_rank(rows.where(F.col("s") == F.lit(found["cutoff"])), [], "h", "r").where(F.col("r") <= quota - under)
    captured = F.count_if("high") + hit
    return tied.agg(
        F.lit(quota).cast("bigint").alias("top_rows"),
        F.lit(total).cast("bigint").alias("high_priority_rows"),
        captured.alias("captured"),
        round_even(F.coalesce(ratio(captured, F.lit(total)), F.lit(0.0)), 6).alias("recall"),
    )
