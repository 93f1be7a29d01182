"""Random forests over binned rows, all trees of many forests at once.

Rows become bytes: a bin per feature, the label and a hash that draws how often a tree takes the row (Poisson, mean 1).
So a pass reads a few bytes a row, and nothing is kept per tree and row. A pass grows every open node of every tree by a
level: tasks count rows by node, feature bin and class, counts are summed per tree, and only the best splits come back.
Draws and the features a node may use depend on seed, tree, row and node only, not on the partitioning.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.session import cut_lineage

CHUNK_ROWS = 1 << 15
TASK_CHUNKS = 32
HELD_BYTES = 1 << 27  # counts that a task holds at once
CHUNK_SCHEMA = "n int, bins binary, label binary, hash binary"


class Binning(NamedTuple):
    codes: Sequence[str]  # categories, numbered from 0
    sizes: Sequence[int]  # categories of each
    numbers: Sequence[str]
    cuts: Sequence[Sequence[float]]  # a number's bin is the first cut that is not below it


class Forest(NamedTuple):
    trees: int
    depth: int
    min_rows: int


class Tree:
    def __init__(self, number: int, forest: Forest, bins: int, classes: int):
        self.number, self.forest = number, forest
        self.feature = np.full(1, -1, np.int16)  # -1: a leaf
        self.left = np.zeros((1, bins), bool)
        self.child = np.zeros(1, np.int32)  # the left one; the right one follows
        self.counts = np.zeros((1, classes))

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The node in which each row ends, for bins by feature and row."""
        n = bins.shape[1]
        flat, place = bins.ravel(), np.arange(n)
        node = np.zeros(n, np.int32)
        for _ in range(self.forest.depth):
            feature = self.feature[node]
            inner = feature >= 0
            if not inner.any():
                break
            right = ~self.left[node, flat[np.maximum(feature, 0) * np.int64(n) + place]]
            node = np.where(inner, self.child[node] + right, node)
        return node

    def split(self, node: int, feature: int, left: np.ndarray, left_counts: np.ndarray) -> list[int]:
        """Split a node; the children that may be split in turn."""
        at = len(self.feature)
        self.feature[node], self.left[node], self.child[node] = feature, left, at
        both = np.stack([left_counts, self.counts[node] - left_counts])
        self.feature = np.append(self.feature, np.full(2, -1, np.int16))
        self.left = np.concatenate([self.left, np.zeros((2, self.left.shape[1]), bool)])
        self.child = np.append(self.child, np.zeros(2, np.int32))
        self.counts = np.concatenate([self.counts, both])
        rows = both.sum(axis=1)
        return [at + i for i in (0, 1) if rows[i] >= 2 * self.forest.min_rows and both[i].max() < rows[i]]


def _draws() -> np.ndarray:
    """Poisson numbers with mean 1 for 2**16 equal shares."""
    below = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(12)])
    return np.searchsorted(below, (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.uint8)


def _taken(draws: np.ndarray, hashes: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """How often a tree takes each row."""
    x = hashes ^ np.uint64(int(np.random.SeedSequence([seed, tree]).generate_state(1, np.uint64)[0]))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return draws[x >> np.uint64(48)]


def _chosen(seed: int, tree: int, nodes: Sequence[int], features: int) -> np.ndarray:
    """The features each node may use: the root of their number, rounded up."""
    k, out = math.ceil(math.sqrt(features)), np.zeros((len(nodes), features), bool)
    for i, node in enumerate(nodes):
        out[i, np.random.default_rng([seed, tree, node]).permutation(features)[:k]] = True
    return out


def cuts_of(df: DataFrame, numbers: Sequence[str], bins: int = 64) -> list[list[float]]:
    """At most ``bins`` - 1 cuts per number between equal shares of the rows."""
    found = df.approxQuantile(list(numbers), [i / bins for i in range(1, bins)], 0.002)
    return [sorted(set(values)) for values in found]


def binned(df: DataFrame, binning: Binning, label: str, row_hash: str) -> DataFrame:
    """Rows of ``df`` as bytes, many to a row of the result, written and dealt evenly."""
    widest = max(*binning.sizes, *(len(c) + 1 for c in binning.cuts), 2)
    kind = np.uint8 if widest <= 256 else np.uint16 if widest <= 1 << 16 else np.uint32

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def chunk() -> pa.RecordBatch:
            t = pa.Table.from_batches(held)
            bins = [t[c].to_numpy() for c in binning.codes] + [np.searchsorted(cuts, t[c].to_numpy()) for c, cuts in zip(binning.numbers, binning.cuts)]
            parts = np.stack([b.astype(kind) for b in bins]), t[label].to_numpy().astype(np.int32), t[row_hash].to_numpy()
            return pa.RecordBatch.from_arrays([pa.array([t.num_rows], pa.int32()), *(pa.array([p.tobytes()], pa.binary()) for p in parts)], ["n", "bins", "label", "hash"])

        for batch in batches:
            for low in range(0, batch.num_rows, CHUNK_ROWS):
                part = batch.slice(low, CHUNK_ROWS)
                if held and sum(b.num_rows for b in held) + part.num_rows > CHUNK_ROWS:
                    yield chunk()
                    held.clear()
                held.append(part)
        if sum(b.num_rows for b in held):
            yield chunk()

    chunks = cut_lineage(df.select(*binning.codes, *binning.numbers, label, row_hash).mapInArrow(rows, CHUNK_SCHEMA))
    n = chunks.count()
    return chunks.repartition(max(1, min(n, chunks.sparkSession.sparkContext.defaultParallelism), math.ceil(n / TASK_CHUNKS)))


def _chunks(batches: Iterator[pa.RecordBatch], features: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Bins by feature and row, labels and hashes of every chunk."""
    for batch in batches:
        for n, *parts in zip(*(batch.column(c) for c in ("n", "bins", "label", "hash"))):
            bins, label, hashes = (p.as_buffer() for p in parts)
            kind = np.dtype(f"u{len(bins) // (features * n.as_py())}")
            yield np.frombuffer(bins, kind).reshape(features, -1), np.frombuffer(label, np.int32), np.frombuffer(hashes, np.uint64)


def _counter(work: Sequence[tuple[Tree, Sequence[int]]], sizes: Sequence[int], classes: int, share: float, seed: int):
    """Rows by open node, feature bin and class, summed in the task: a row per part of the work."""
    offset, total = np.cumsum([0, *sizes[:-1]]), sum(sizes)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draws, sums = _draws(), [np.zeros(len(nodes) * total * classes) for _, nodes in work]
        slots = []
        for tree, nodes in work:
            slots.append(np.full(len(tree.feature), -1, np.int64))
            slots[-1][list(nodes)] = np.arange(len(nodes))
        for bins, label, hashes in _chunks(batches, len(sizes)):
            some = np.flatnonzero((hashes & np.uint64((1 << 30) - 1)) < share * (1 << 30))
            bins, label, hashes = bins[:, some], label[some], hashes[some]
            cell = (offset[:, None] + bins) * classes + label
            for (tree, _), slot, counts in zip(work, slots, sums):
                taken = _taken(draws, hashes, seed, tree.number)
                mine = np.flatnonzero(taken)
                at = slot[tree.leaves(bins[:, mine])]
                mine, at = mine[at >= 0], at[at >= 0]
                where = (cell[:, mine] + at * (total * classes)).ravel()
                counts += np.bincount(where, np.tile(taken[mine], len(sizes)), len(counts))
        codec, out = pa.Codec("zstd", compression_level=1), []
        for (tree, nodes), counts in zip(work, sums):
            counts = counts.reshape(len(nodes), total, classes)
            counts[~np.repeat(_chosen(seed, tree.number, nodes, len(sizes)), sizes, axis=1)] = 0
            out.append(codec.compress(counts.tobytes(), asbytes=True))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(work), dtype=np.int32)), pa.array(out, pa.binary())], ["part", "counts"])

    return rows


def _splitter(work: Sequence[tuple[Tree, Sequence[int]]], sizes: Sequence[int], categories: int, classes: int, seed: int):
    """The best split of every node of a part by Gini impurity; categories are put in order of their share of the node's largest class."""
    offset, total, widest = np.cumsum([0, *sizes]), sum(sizes), max(sizes)

    def rows(table: pa.Table) -> pa.Table:
        part = table["part"][0].as_py()
        tree, nodes = work[part]
        shape = (len(nodes), total, classes)
        counts, codec = np.zeros(shape), pa.Codec("zstd")
        for value in table["counts"]:
            counts += np.frombuffer(codec.decompress(value.as_buffer(), 8 * math.prod(shape)), np.float64).reshape(shape)
        chosen = _chosen(seed, tree.number, nodes, len(sizes))
        first = chosen.argmax(axis=1)
        node_counts = np.stack([counts[i, offset[f] : offset[f + 1]].sum(axis=0) for i, f in enumerate(first)])
        n = node_counts.sum(axis=1)
        worth = lambda c: (c**2).sum(axis=-1) / np.maximum(c.sum(axis=-1), 1)  # noqa: E731  grows as impurity falls
        best = worth(node_counts) + 1e-9 * np.maximum(n, 1)
        feature, left, left_counts = np.full(len(nodes), -1, np.int16), np.zeros((len(nodes), widest), bool), np.zeros((len(nodes), classes))
        for f, size in enumerate(sizes):
            at = np.flatnonzero(chosen[:, f])
            if not len(at) or size < 2:
                continue
            c = counts[at, offset[f] : offset[f + 1]]
            rank = np.broadcast_to(np.arange(size), c.shape[:2])
            if f < categories:
                largest = np.take_along_axis(c, node_counts[at].argmax(axis=1)[:, None, None], axis=2)[:, :, 0]
                order = np.argsort(largest / np.maximum(c.sum(axis=2), 1), axis=1, kind="stable")
                c, rank = np.take_along_axis(c, order[:, :, None], axis=1), np.argsort(order, axis=1, kind="stable")
            lower = np.cumsum(c, axis=1)[:, :-1]
            upper = node_counts[at][:, None] - lower
            value = worth(lower) + worth(upper)
            value[(lower.sum(axis=2) < tree.forest.min_rows) | (upper.sum(axis=2) < tree.forest.min_rows)] = -1
            cut = value.argmax(axis=1)
            value = value[np.arange(len(at)), cut]
            better = np.flatnonzero(value > best[at])
            at, cut = at[better], cut[better]
            best[at], feature[at], left_counts[at] = value[better], f, lower[better, cut]
            left[at] = False
            left[at, :size] = rank[better] <= cut[:, None]
        values = feature, left, left_counts, node_counts
        return pa.table({"part": pa.array([part], pa.int32())} | {name: pa.array([v.tobytes()], pa.binary()) for name, v in zip(("feature", "left", "left_counts", "node_counts"), values)})

    return rows


def fit_forests(chunks: DataFrame, binning: Binning, classes: int, forests: Mapping[int, Forest], share: float = 1.0, seed: int = 42) -> dict[int, list[Tree]]:
    """Forests on the rows of ``chunks`` whose hash lies below ``share``; a pass grows all of them by a level."""
    sizes = [*binning.sizes, *(len(c) + 1 for c in binning.cuts)]
    grown = {name: [Tree(i, forest, max(sizes), classes) for i in range(forest.trees)] for name, forest in forests.items()}
    open_nodes = [(tree, [0]) for trees in grown.values() for tree in trees]
    most = max(1, HELD_BYTES // (8 * sum(sizes) * classes))  # nodes of a pass
    for level in range(max(forest.depth for forest in forests.values())):
        parts = [(tree, nodes[i : i + most]) for tree, nodes in open_nodes if level < tree.forest.depth for i in range(0, len(nodes), most)]
        work, held, following = [], 0, {}
        for i, part in enumerate(parts):
            work.append(part)
            held += len(part[1])
            if i + 1 < len(parts) and held + len(parts[i + 1][1]) <= most:
                continue
            counts = chunks.mapInArrow(_counter(work, sizes, classes, share, seed), "part int, counts binary")
            best = counts.groupBy("part").applyInArrow(_splitter(work, sizes, len(binning.sizes), classes, seed), "part int, feature binary, left binary, left_counts binary, node_counts binary")
            for row in best.collect():
                tree, nodes = work[row["part"]]
                feature, left = np.frombuffer(row["feature"], np.int16), np.frombuffer(row["left"], bool).reshape(len(nodes), -1)
                left_counts, node_counts = (np.frombuffer(row[c], np.float64).reshape(len(nodes), -1) for c in ("left_counts", "node_counts"))
                for j, node in enumerate(nodes):
                    tree.counts[node] = node_counts[j]
                    if feature[j] >= 0:
                        following.setdefault(id(tree), (tree, []))[1].extend(tree.split(node, feature[j], left[j], left_counts[j]))
            work, held = [], 0
        open_nodes = [(tree, sorted(nodes)) for tree, nodes in following.values() if nodes]
        if not open_nodes:
            break
    return grown


def confusion_of(chunks: DataFrame, binning: Binning, forests: Mapping[int, Sequence[Tree]]) -> DataFrame:
    """``forest``, ``truth``, ``predicted``, ``n``: every tree votes with the shares of the classes in the row's leaf."""
    features = len(binning.sizes) + len(binning.cuts)
    votes = {name: [t.counts / np.maximum(t.counts.sum(axis=1, keepdims=True), 1) for t in trees] for name, trees in forests.items()}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bins, label, _ in _chunks(batches, features):
            for name, trees in forests.items():
                predicted = sum(vote[tree.leaves(bins)] for tree, vote in zip(trees, votes[name])).argmax(axis=1)
                pairs, n = np.unique(np.stack([label.astype(np.int64), predicted]), axis=1, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (np.full(len(n), name), *pairs, n)], ["forest", "truth", "predicted", "n"])

    found = chunks.mapInArrow(rows, "forest long, truth long, predicted long, n long")
    text = [F.col(c).cast("string").alias(c) for c in ("truth", "predicted")]
    return cut_lineage(found.groupBy("forest", *text).agg(F.sum("n").alias("n")))
