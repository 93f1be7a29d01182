"""Multiclass boosted trees: one tree per round for all classes, softmax gradients, early stopping.

Every round adds one tree whose leaves hold a value per class. A level of the tree takes one aggregate over the
training rows (below the root over the smaller child of each node, as the other one is what is left), sums of gradients and curvatures by (node, feature, bin), so the driver sees tables whose size
depends on nodes, features, bins and classes and not on the rows. The scores of the rows are written to the
shared folder after every round; a lost executor reads them again. The rounds end when the loss of the validation
rows has not fallen for ``patience`` rounds, and the model keeps the rounds up to the best one.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.session import cut_lineage, spread
from .classify import CATEGORICAL, NUMERIC, TASK_ROWS, as_numbers, class_weights, feature_prep

LEAST_GAIN = 1e-7


@dataclass
class Tree:
    """Splits (feature, bin; up to the bin goes left) and leaf values by node; the children of n are 2n + 1 and 2n + 2."""

    splits: dict[int, tuple[int, int]] = field(default_factory=dict)
    leaves: dict[int, list[float]] = field(default_factory=dict)

    def expression(self, bins: Column, leaf, node: int = 0) -> Column:
        """Nested conditions over the bins of a row; ``leaf`` gives the value of a leaf's number."""
        if node not in self.splits:
            return leaf(node)
        feature, cut = self.splits[node]
        return F.when(bins[feature] <= cut, self.expression(bins, leaf, 2 * node + 1)).otherwise(self.expression(bins, leaf, 2 * node + 2))

    def values(self, bins: np.ndarray, classes: int) -> np.ndarray:
        out = np.empty((len(bins), classes))
        rows = [(0, np.arange(len(bins)))]
        while rows:
            node, some = rows.pop()
            if node in self.splits:
                feature, cut = self.splits[node]
                left = bins[some, feature] <= cut
                rows += [(2 * node + 1, some[left]), (2 * node + 2, some[~left])]
            else:
                out[some] = self.leaves[node]
        return out


@dataclass
class BoostedModel:
    """Fitted feature stages, bin edges, start scores and trees."""

    prep: PipelineModel
    edges: list[list[float]]
    start: list[float]
    trees: list[Tree]
    losses: list[float]  # of the validation rows, before the first round and after each
    gains: list[float]  # by feature

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` after the feature stages, with ``probability`` (vector) and ``prediction``; the trees run in Arrow batches."""
        edges, start, trees = self.edges, self.start, self.trees

        @F.pandas_udf("array<double>")
        def shares(features: pd.Series) -> pd.Series:
            x = np.stack(features.to_list()) if len(features) else np.zeros((0, len(edges)))
            bins = np.stack([np.searchsorted(np.array(e), x[:, i], "left") for i, e in enumerate(edges)], axis=1)
            score = np.tile(start, (len(x), 1))
            for tree in trees:
                score += tree.values(bins, len(start))
            score = np.exp(score - score.max(axis=1, keepdims=True))
            return pd.Series(list(score / score.sum(axis=1, keepdims=True)))

        scored = self.prep.transform(df).withColumn("_shares", shares(vector_to_array("features")))
        best = (F.array_position("_shares", F.array_max("_shares")) - 1).cast("double")
        return scored.withColumns({"probability": array_to_vector("_shares"), "prediction": best}).drop("_shares")

    def importance(self, spark: SparkSession) -> DataFrame:
        """Share of the gain by feature."""
        total = sum(self.gains) or 1.0
        rows = [(n, round(g / total, 6)) for n, g in zip(CATEGORICAL + NUMERIC, self.gains)]
        return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")

    def save(self, path: str) -> None:
        """The feature stages and one row with the trees, below ``path``."""
        self.prep.write().save(f"{path}/prep")
        trees = [{"splits": [[n, *s] for n, s in t.splits.items()], "leaves": [[n, v] for n, v in t.leaves.items()]} for t in self.trees]
        content = {"edges": self.edges, "start": self.start, "losses": self.losses, "gains": self.gains, "trees": trees}
        spark = SparkSession.active()
        spark.createDataFrame([(json.dumps(content),)], "value string").coalesce(1).write.text(f"{path}/trees")

    @staticmethod
    def load(path: str) -> BoostedModel:
        content = json.loads(SparkSession.active().read.text(f"{path}/trees").first()[0])
        trees = [Tree({n: (f, b) for n, f, b in t["splits"]}, dict(map(tuple, t["leaves"]))) for t in content.pop("trees")]
        return BoostedModel(PipelineModel.load(f"{path}/prep"), trees=trees, **content)


def bin_edges(x: DataFrame, features: int, bins: int) -> list[list[float]]:
    """Upper edges of all bins but the last, by feature: quantiles, each value once."""
    shares = [i / bins for i in range(1, bins)]
    found = x.agg(*[F.percentile_approx(F.col("x")[i], shares, 10_000).alias(f"q{i}") for i in range(features)]).first()
    return [sorted(set(q or [])) for q in found]


def _bin(x: Column, edges: list[float]) -> Column:
    """Number of edges below ``x``."""
    return F.size(F.filter(F.array(*map(F.lit, edges)), lambda t: t < x)) if edges else F.lit(0)


def softmax_columns(state: DataFrame, classes: int) -> DataFrame:
    """``state`` with gradient ``g<k>`` and curvature ``h<k>`` of every class."""
    top = F.array_max("score")
    exps = state.withColumns({f"e{k}": F.exp(F.col("score")[k] - top) for k in range(classes)})
    total = sum((F.col(f"e{k}") for k in range(1, classes)), F.col("e0"))
    shares = exps.withColumns({f"p{k}": F.col(f"e{k}") / total for k in range(classes)})
    hit = [(F.col("y") == k).cast("double") for k in range(classes)]
    slopes = {f"g{k}": F.col("w") * (F.col(f"p{k}") - hit[k]) for k in range(classes)}
    bends = {f"h{k}": F.col("w") * F.col(f"p{k}") * (1 - F.col(f"p{k}")) for k in range(classes)}
    return shares.withColumns(slopes | bends)


def histograms(state: DataFrame, node: Column, classes: int) -> DataFrame:
    """Rows, gradients and curvatures by (node, feature, bin); rows whose ``node`` is NULL have ended in a leaf."""
    sums = [F.sum(f"{s}{k}").alias(f"{s}{k}") for s in "gh" for k in range(classes)]
    rows = softmax_columns(state.where("NOT held_out"), classes).withColumn("node", node).where("node IS NOT NULL")
    cells = rows.select("node", F.posexplode("bins").alias("feature", "bin"), *[f"{s}{k}" for s in "gh" for k in range(classes)])
    return cells.groupBy("node", "feature", "bin").agg(F.count("*").alias("n"), *sums)


def validation_loss(state: DataFrame) -> float:
    """Weighted mean negative log share of the true class over the held-out rows."""
    top = F.array_max("score")
    log_total = top + F.log(F.aggregate(F.transform("score", lambda s: F.exp(s - top)), F.lit(0.0), lambda a, b: a + b))
    held = state.where("held_out").agg((F.sum(F.col("w") * (log_total - F.get("score", F.col("y")))) / F.sum("w")).alias("loss"))
    return held.first()["loss"]


def _best_split(cells: np.ndarray, l2: float, min_rows: int) -> tuple[float, int, int, np.ndarray]:
    """Gain, feature, bin and left sums of the best cut of a node; ``cells`` is (feature, bin, 1 + 2 * classes)."""
    left = np.cumsum(cells, axis=1)
    total = left[:1, -1:, :]
    right = total - left
    k = (cells.shape[2] - 1) // 2

    def worth(s: np.ndarray) -> np.ndarray:
        return (s[..., 1 : 1 + k] ** 2 / (s[..., 1 + k :] + l2)).sum(axis=-1)

    gain = worth(left) + worth(right) - worth(total)
    gain[(left[..., 0] < min_rows) | (right[..., 0] < min_rows)] = -np.inf
    at = int(np.argmax(np.round(gain, 9)))  # ties go to the first feature and bin
    feature, cut = divmod(at, cells.shape[1])
    return float(gain[feature, cut]), feature, cut, left[feature, cut]


def grow_tree(state: DataFrame, classes: int, features: int, bins: int, depth: int, rate: float, l2: float, min_rows: int) -> tuple[Tree, np.ndarray]:
    """A tree over the current gradients, level by level, and the gain of every feature."""
    tree, gains = Tree(), np.zeros(features)
    open_nodes, sums, parents = {0}, {}, {}
    sibling = lambda n: n + 1 if n % 2 else n - 1
    for _ in range(depth):
        # of two children the one with fewer rows is summed; the other one is what is left of their parent
        summed = {n for n in open_nodes if n == 0 or (sums[n][0], n) < (sums[sibling(n)][0], sibling(n))}
        number = lambda n: F.lit(n if n in summed else None).cast("int")  # noqa: B023, E731
        cells: dict[int, np.ndarray] = {n: np.zeros((features, bins, 1 + 2 * classes)) for n in summed}
        for r in histograms(state, tree.expression(F.col("bins"), number), classes).collect():
            cells[r["node"]][r["feature"], r["bin"]] = r[3:]
        cells |= {n: parents[(n - 1) // 2] - cells[sibling(n)] for n in open_nodes - summed}
        parents = cells
        following = set()
        for node, table in sorted(cells.items()):
            sums.setdefault(node, table[0].sum(axis=0))
            gain, feature, cut, left = _best_split(table, l2, min_rows)
            if gain > LEAST_GAIN:
                tree.splits[node] = (feature, cut)
                gains[feature] += gain
                sums[2 * node + 1], sums[2 * node + 2] = left, sums[node] - left
                following |= {2 * node + 1, 2 * node + 2}
        open_nodes = following
        if not open_nodes:
            break
    for node, s in sums.items():
        if node not in tree.splits:
            tree.leaves[node] = (-rate * s[1 : 1 + classes] / (s[1 + classes :] + l2)).tolist()
    return tree, gains


def fit_boosted(
    train: DataFrame,
    validation: DataFrame,
    label: str = "label_code",
    balanced: bool = False,
    rounds: int = 300,
    depth: int = 5,
    rate: float = 0.1,
    patience: int = 15,
    bins: int = 64,
    min_rows: int = 30,
    l2: float = 1.0,
) -> BoostedModel:
    """Boosted trees for all classes of ``label`` (codes 0, 1, ...) that stop early by the loss of ``validation``.

    Features and bins come from ``train`` alone. With ``balanced`` the rows weigh n / (k * n_class) of the
    training rows, in the gradients and in the loss. Rows without a label are left out; validation rows of a class that
    training has not seen are, too. Empty tables are an error.
    """
    weighed = class_weights(train, label).select(F.col(label).alias("_label"), (F.col("weight") if balanced else F.lit(1.0)).alias("w"), "n_rows")
    counted = {int(r["_label"]): r for r in weighed.collect()}
    if not counted:
        raise ValueError("no training row has a label")
    prep = Pipeline(stages=feature_prep()).fit(as_numbers(train))
    features = len(CATEGORICAL) + len(NUMERIC)
    classes = max(counted) + 1
    mass = np.array([counted[k]["w"] * counted[k]["n_rows"] if k in counted else 0.0 for k in range(classes)])
    start = np.log((mass + 1e-3) / (mass + 1e-3).sum()).tolist()
    weight = F.get(F.array(*[F.lit(float(counted[k]["w"]) if k in counted else None) for k in range(classes)]), F.col("y"))

    def prepared(df: DataFrame, held_out: bool) -> DataFrame:
        x = vector_to_array("features").alias("x")
        rows = prep.transform(as_numbers(df.where(F.col(label).isNotNull()))).select(x, F.col(label).cast("int").alias("y"))
        return rows.withColumns({"w": weight, "held_out": F.lit(held_out)}).where("w IS NOT NULL")

    both = cut_lineage(spread(prepared(train, False).unionByName(prepared(validation, True)), TASK_ROWS))
    edges = bin_edges(both.where("NOT held_out"), features, bins)
    binned = F.array(*[_bin(F.col("x")[i], e) for i, e in enumerate(edges)])
    state = cut_lineage(both.select(binned.alias("bins"), "y", "w", "held_out", F.array(*map(F.lit, start)).alias("score")))
    losses = [validation_loss(state)]
    if losses[0] is None:
        raise ValueError("no validation row has a class of the training rows")
    trees, gains = [], []
    for _ in range(rounds):
        tree, gain = grow_tree(state, classes, features, bins, depth, rate, l2, min_rows)
        if not tree.splits:
            break
        value = tree.expression(F.col("bins"), lambda n: F.array(*map(F.lit, tree.leaves[n])))  # noqa: B023
        state = cut_lineage(state.withColumn("score", F.zip_with("score", value, lambda a, b: a + b)))
        trees.append(tree)
        gains.append(gain)
        losses.append(validation_loss(state))
        if len(losses) - 1 - int(np.argmin(losses)) >= patience:
            break
    best = int(np.argmin(losses))
    return BoostedModel(prep, edges, start, trees[:best], losses, np.sum(gains[:best], axis=0).tolist() if best else [0.0] * features)
