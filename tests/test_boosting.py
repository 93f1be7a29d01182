"""Multiclass boosting with early stopping: planted classes, weights, reload, and what reaches the driver."""

import math

import pytest
from pyspark.sql import functions as F

from sirenlake.operators import boosting, classify

FAST = {"rounds": 12, "depth": 3, "rate": 0.6, "patience": 2, "min_rows": 5}


def planted(spark, n, seed=0, classes=9, noise=0.0):
    """The class is the ninth in which the sum of three features lies, so single splits say little."""
    a, b, c = (F.rand(seed * 10 + i) for i in range(3))
    base = spark.range(n, numPartitions=4).select("id", a.alias("longitude"), b.alias("latitude"), c.alias("completeness_score"), F.rand(seed * 10 + 5).alias("r"))
    label = F.least(F.floor((F.col("longitude") + F.col("latitude") + F.col("completeness_score")) / 3 * classes), F.lit(classes - 1)).cast("int")
    return base.select(
        "id", "longitude", "latitude", "completeness_score", F.lit(2000).alias("year"),
        *[F.lit("x").alias(k) for k in classify.CATEGORICAL],
        F.when(F.col("r") < noise, (F.col("id") % classes).cast("int")).otherwise(label).alias("label_code"),
    ).cache()


def macro_f1(model, df):
    scored = classify.predict_confidence(model, df)
    return classify.overall_metrics(classify.per_class_metrics(classify.confusion_long(scored, "label_code", "predicted_code"))).first().macro_f1


@pytest.fixture(scope="module")
def tables(spark):
    return planted(spark, 2500, 1, noise=0.1), planted(spark, 1000, 2, noise=0.1), planted(spark, 1500, 3)


@pytest.fixture(scope="module")
def model(tables):
    return boosting.fit_boosted(*tables[:2], **FAST)


def test_beats_the_forest_on_nine_planted_classes(tables, model):
    train, _, test = tables
    forest = classify.train_classifier(train, numTrees=20, maxDepth=3)
    got, other = macro_f1(model, test), macro_f1(forest, test)
    assert got > other and got > 0.55, (got, other)


def test_rounds_end_before_the_limit_at_the_best_loss(tables):
    few = tables[0].where("id < 400").coalesce(1)
    model = boosting.fit_boosted(few, tables[1].coalesce(1), **FAST | {"rounds": 20, "rate": 1.5, "min_rows": 1})
    assert 0 < len(model.trees) == model.losses.index(min(model.losses)) < 18
    assert len(model.losses) == len(model.trees) + FAST["patience"] + 1
    assert model.losses[len(model.trees)] < model.losses[0] < math.log(9) + 0.2


def test_probabilities_and_importance(spark, tables, model):
    scored = classify.predict_confidence(model, tables[2].withColumn("city_code", F.lit("unseen")))
    assert scored.where("max_confidence NOT BETWEEN 0 AND 1").isEmpty() and scored.count() == 1500
    importance = model.importance(spark).collect()
    assert {r.feature for r in importance[:3]} == {"longitude", "latitude", "completeness_score"}
    assert abs(sum(r.importance for r in importance) - 1) < 1e-4


def test_reload_gives_the_same_predictions(spark, tables, model, tmp_path):
    model.save(str(tmp_path / "m"))
    again = boosting.BoostedModel.load(str(tmp_path / "m"))
    a, b = (sorted(map(tuple, classify.predict_confidence(m, tables[2]).select("id", "predicted_code", "max_confidence").collect())) for m in (model, again))
    assert a == b and again.trees == model.trees


def test_weights_move_the_rare_class(spark):
    """The rare class lies in a region where the frequent one is three times as common."""
    def rows(seed):
        df = planted(spark, 2400, seed, classes=1)
        region = (F.col("longitude") < 0.3) & (F.col("id") % 4 == 0)
        return df.withColumn("label_code", F.when(region, 1).otherwise(0))

    train, validation, test = rows(4), rows(5), rows(6)
    options = FAST | {"rounds": 4, "depth": 2}
    recall = {}
    for balanced in (False, True):
        scored = classify.predict_confidence(boosting.fit_boosted(train, validation, balanced=balanced, **options), test)
        recall[balanced] = scored.where("label_code = 1 AND predicted_code = 1").count() / test.where("label_code = 1").count()
    assert recall[False] < 0.2 and recall[True] > 0.8


def test_one_round_equals_plain_sums(spark, tables):
    """Leaf values of a stump against gradients summed in Python."""
    train, validation, _ = tables
    got = boosting.fit_boosted(train, validation, rounds=1, depth=1, rate=1.0, bins=8, min_rows=1)
    tree = got.trees[0]
    feature, cut = tree.splits[0]
    name = (classify.CATEGORICAL + classify.NUMERIC)[feature]
    edge = got.edges[feature][cut]
    data = [(r[name], r.label_code) for r in train.collect()]
    shares = [math.exp(s) for s in got.start]
    for node, side in ((1, [y for x, y in data if x <= edge]), (2, [y for x, y in data if x > edge])):
        for k in range(9):
            g = sum(shares[k] - (y == k) for y in side)
            h = len(side) * shares[k] * (1 - shares[k])
            assert tree.leaves[node][k] == pytest.approx(-g / (h + 1.0), rel=1e-6)


def test_the_driver_sees_cells_not_rows(spark, tables):
    """Histograms of a level: the same number of rows for four times the data, combined before the shuffle."""
    bins = F.array(*[F.floor(F.col(c) * 8).cast("int") for c in ("longitude", "latitude")])
    state = tables[0].select(bins.alias("bins"), F.col("label_code").alias("y"), F.lit(1.0).alias("w"), F.lit(False).alias("held_out"), F.array_repeat(F.lit(0.0), 9).alias("score"))
    four = state
    for _ in range(2):
        four = four.unionByName(four)
    small, large = (boosting.histograms(s, F.lit(0), 9) for s in (state, four))
    assert small.count() == large.count() == 16
    plan = large._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2 and plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan


def test_labels_that_miss(spark, tables):
    train, validation, _ = tables
    with pytest.raises(ValueError):
        boosting.fit_boosted(train.where("false"), validation, **FAST)
    with pytest.raises(ValueError):
        boosting.fit_boosted(train, validation.where("false"), **FAST)
    odd = train.where("id < 400").withColumn("label_code", F.when(F.col("id") % 5 > 0, F.col("label_code") % 2 * 2))  # NULLs, and no class 1
    some = boosting.fit_boosted(odd, validation.withColumn("label_code", F.col("label_code") % 3), rounds=2, depth=2)
    assert classify.predict_confidence(some, validation).where("predicted_code = 1").isEmpty()


def test_only_the_smaller_children_are_summed(spark, tables, monkeypatch):
    """Levels below the root look at half of the rows at most; the tree is the one that sums of all children give."""
    bins = F.array(*[F.floor(F.col(c) * 8).cast("int") for c in ("longitude", "latitude")])
    state = tables[0].select(bins.alias("bins"), F.col("label_code").alias("y"), F.lit(1.0).alias("w"), F.lit(False).alias("held_out"), F.array_repeat(F.lit(0.0), 9).alias("score")).persist()
    looked_at = []

    def counted(*args, plain=boosting.histograms):
        out = plain(*args)
        looked_at.append(out.where("feature = 0").agg(F.sum("n")).first()[0])
        return out

    monkeypatch.setattr(boosting, "histograms", counted)
    tree, _ = boosting.grow_tree(state, 9, 2, 9, 3, 1.0, 1.0, 1)
    rows = state.count()
    state = state.withColumn("leaf", tree.expression(F.col("bins"), F.lit))
    assert looked_at[0] == rows and len(looked_at) == 3 and max(looked_at[1:]) <= rows / 2, (rows, looked_at)
    for r in state.groupBy("leaf").agg(F.count("*").alias("n"), *[F.count_if(F.col("y") == k).alias(f"c{k}") for k in range(9)]).collect():
        for k in range(9):
            assert tree.leaves[r["leaf"]][k] == pytest.approx(-(r["n"] / 9 - r[f"c{k}"]) / (r["n"] * 8 / 81 + 1.0), rel=1e-6, abs=1e-9)
