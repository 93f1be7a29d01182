"""Forests over binned rows against brute force and Spark's own forest."""

import math

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from sirenlake.operators import classify, forest

SIZES, CLASSES, SEED = [5, 300, 7], 3, 9


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(1)
    rows = [(int(c), float(x), float(y), int((c % 2 + (x > 0.4) + (y > 0.7)) % 3 if rng.random() < 0.8 else rng.integers(3))) for c, x, y in zip(rng.integers(0, 5, 900), rng.random(900), rng.random(900))]
    frame = spark.createDataFrame(rows, "c int, x double, y double, label int").withColumn("h", F.xxhash64("c", "x", "y"))
    return frame.repartition(5).cache()


def fitted(table, monkeypatch, forests, share=1.0, chunk=70, held=1 << 27):
    monkeypatch.setattr(forest, "CHUNK_ROWS", chunk)
    monkeypatch.setattr(forest, "HELD_BYTES", held)
    cuts = [[i / 300 for i in range(1, 300)], [i / 7 for i in range(1, 7)]]  # bins beyond a byte
    binning = forest.Binning(["c"], SIZES[:1], ["x", "y"], cuts)
    chunks = forest.binned(table, binning, "label", "h")
    return chunks, binning, forest.fit_forests(chunks, binning, CLASSES, forests, share, SEED)


@pytest.mark.parametrize("share", [1.0, 0.5])
def test_trees_have_the_best_splits(spark, table, monkeypatch, share):
    """Counts of every node, its best split over all cuts of its features, and the votes, from the rows themselves."""
    chunks, binning, grown = fitted(table, monkeypatch, {7: forest.Forest(3, 4, 5), 8: forest.Forest(1, 2, 40)}, share)
    rows = table.collect()
    bins = np.array([[r.c for r in rows], np.searchsorted(binning.cuts[0], [r.x for r in rows]), np.searchsorted(binning.cuts[1], [r.y for r in rows])])
    label, hashes = np.array([r.label for r in rows]), np.array([r.h for r in rows]).view(np.uint64)
    inside = (hashes % (1 << 30)) / (1 << 30) < share
    gini = lambda c: c.sum() - (c**2).sum() / c.sum() if c.sum() else 0.0
    splits = 0
    for tree in [t for trees in grown.values() for t in trees]:
        taken = forest._taken(forest._draws(), hashes, SEED, tree.number) * inside
        count = lambda rows: np.bincount(label[rows], taken[rows], CLASSES)
        reach = {0: np.arange(len(rows))}
        for node in range(len(tree.feature)):
            here, f = reach[node], int(tree.feature[node])
            assert np.array_equal(tree.counts[node], count(here))
            used = np.flatnonzero(forest._chosen(SEED, tree.number, [node], 3)[0])
            assert len(used) == 2 and (f < 0 or f in used)
            gains = [0.0]
            for g in used:
                values = range(SIZES[g])
                if g == 0:
                    largest = count(here).argmax()
                    part = [count(here[bins[0, here] == v]) for v in values]
                    values = sorted(values, key=lambda v: part[v][largest] / max(part[v].sum(), 1))
                for i in range(1, SIZES[g]):
                    sides = [count(here[np.isin(bins[g, here], list(values)[:i])]), count(here[np.isin(bins[g, here], list(values)[i:])])]
                    if min(s.sum() for s in sides) >= tree.forest.min_rows:
                        gains.append(gini(count(here)) - sum(map(gini, sides)))
            if f < 0:
                continue
            splits += 1
            goes = tree.left[node, bins[f, here]]
            reach[tree.child[node]], reach[tree.child[node] + 1] = here[goes], here[~goes]
            got = gini(count(here)) - gini(count(here[goes])) - gini(count(here[~goes]))
            assert got == pytest.approx(max(gains)) and got > 0
    assert splits > 15
    found = {(r.forest, int(r.truth), int(r.predicted)): r.n for r in forest.confusion_of(chunks, binning, grown).collect()}
    for name, trees in grown.items():
        votes = sum((t.counts / np.maximum(t.counts.sum(axis=1, keepdims=True), 1))[t.leaves(bins)] for t in trees).argmax(axis=1)
        assert all(found.get((name, a, b), 0) == ((label == a) & (votes == b)).sum() for a in range(3) for b in range(3))


def test_trees_do_not_depend_on_partitions_chunks_or_passes(spark, table, monkeypatch):
    trees = {1: forest.Forest(4, 5, 3), 2: forest.Forest(2, 3, 1)}
    shape = lambda got: [(t.feature.tolist(), t.left.tolist(), t.child.tolist(), t.counts.tolist()) for k in got for t in got[k]]
    want = shape(fitted(table, monkeypatch, trees)[2])
    assert shape(fitted(table.repartition(1), monkeypatch, trees, chunk=1000)[2]) == want
    assert shape(fitted(table.coalesce(2), monkeypatch, trees, held=8 * sum(SIZES) * CLASSES * 3)[2]) == want


def test_rows_are_drawn_as_a_bootstrap_draws_them():
    draws = forest._taken(forest._draws(), np.random.default_rng(3).integers(0, 1 << 63, 400_000).astype(np.uint64), 1, 2)
    assert np.bincount(draws)[:5] / len(draws) == pytest.approx([math.exp(-1) / math.factorial(i) for i in range(5)], abs=0.003)
    other = forest._taken(forest._draws(), np.random.default_rng(3).integers(0, 1 << 63, 400_000).astype(np.uint64), 1, 3)
    assert abs(np.corrcoef(draws, other)[0, 1]) < 0.01


def test_halving_grows_all_forests_of_a_rung_at_once_and_as_well_as_spark(spark, monkeypatch):
    """Spark's forests were fitted one after the other, with a pass per level of each and counts per tree kept with every row."""
    frame = spark.range(6000).select(
        *[F.concat(F.lit(c), (F.xxhash64("id", F.lit(c)) % 4).cast("string")).alias(c) for c in classify.CATEGORICAL],
        *[(F.pmod(F.xxhash64("id", F.lit(c)), F.lit(1000)) / 1000).alias(c) for c in classify.NUMERIC],
        F.pmod(F.xxhash64("id"), F.lit(4)).alias("part"),
    )
    noise = F.pmod(F.xxhash64("longitude", "latitude"), F.lit(10)) < 2
    frame = frame.withColumn("label_code", F.when(noise, 2).otherwise((F.col("city_code").endswith("1").cast("int") + (F.col("longitude") > 0.6).cast("int")).cast("int"))).cache()
    train, validation = frame.where("part > 0").drop("part"), frame.where("part = 0").drop("part")
    passes = []
    counter = forest._counter
    monkeypatch.setattr(forest, "_counter", lambda work, *a: passes.append(len(work)) or counter(work, *a))
    own = {r.trial: r for r in classify.tune_classifier(train, validation, trials=4).collect()}
    assert len(passes) == max(r.max_depth for r in own.values()) and passes[0] == sum(r.num_trees for r in own.values())
    prep = Pipeline(stages=classify.feature_prep()).fit(classify.as_numbers(train))
    coded = [prep.transform(classify.as_numbers(df)) for df in (train, validation)]
    for r in own.values():
        model = classify.make_classifier(numTrees=r.num_trees, maxDepth=r.max_depth, minInstancesPerNode=r.min_rows).fit(coded[0])
        long = classify.confusion_long(model.transform(coded[1]), "label_code", "prediction")
        assert r.macro_f1 > classify.overall_metrics(classify.per_class_metrics(long)).first().macro_f1 - 0.03
    del passes[:]
    monkeypatch.setattr(classify, "make_classifier", None)
    got = classify.halve_classifier(train, validation, trials=4, rungs=2, keep=0.5).collect()
    assert len(passes) == sum(max(r.max_depth for r in got if r.rung == rung) for rung in (0, 1))
