import pytest
from pyspark.sql import functions as F

from sirenlake.operators import classify, splits
from sirenlake.plans import fixtures


def test_splits_are_disjoint_exact_and_stable(spark, sf):
    calls = fixtures.dispatch(spark, sf)
    parts = splits.stratified_split(calls, ["incident_id"], "service_type")
    assert parts.count() == calls.count() == parts.select("incident_id").distinct().count()
    for r in parts.groupBy("service_type").pivot("split", ["train", "validation", "test"]).count().collect():
        n = r.train + r.validation + r.test
        assert abs(r.train - 0.7 * n) <= 1 and abs(r.validation - 0.15 * n) <= 1
    again = splits.stratified_split(calls.repartition(3), ["incident_id"], "service_type")
    assert again.join(parts, ["incident_id", "split"], "left_anti").isEmpty()
    other = splits.stratified_split(calls, ["incident_id"], "service_type", seed=7)
    assert not other.join(parts, ["incident_id", "split"], "left_anti").isEmpty()


def test_short_calendars_fall_back_to_a_random_split(spark):
    df = spark.createDataFrame([(2000, q, "EMS", f"C{i}", "E1") for q in ("Q1", "Q2") for i in range(50)], "year int, quarter string, service_type string, city_code string, priority_code string")
    roles = {r.role: r["count"] for r in splits.forecaster_split(df).groupBy("role").count().collect()}
    assert roles == {"train": 70, "validation": 15, "test": 15}


def test_confusion_rows_sum_to_supports(spark, sf):
    p = fixtures.predictions(spark, sf)
    matrix = {r.truth: r.A + r.N + r.R for r in classify.confusion_matrix(p, ["A", "N", "R"]).collect()}
    support = {r["class"]: r.support for r in classify.rounded_class_metrics(classify.confusion_long(p)).collect()}
    assert matrix == support
    unseen = classify.confusion_matrix(p, ["A", "N", "R", "Z"]).where("truth = 'Z'").first()
    assert (unseen.A, unseen.Z) == (0, 0)


def test_metrics_of_a_small_case(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "b")], "truth string, predicted string")
    got = {r["class"]: (r.precision, r.recall, r.f1, r.support) for r in classify.rounded_class_metrics(classify.confusion_long(df)).collect()}
    assert got == {"a": (1.0, 0.5, 0.6667, 2), "b": (0.3333, 1.0, 0.5, 1), "c": (0.0, 0.0, 0.0, 1)}
    o = classify.overall_metrics(classify.per_class_metrics(classify.confusion_long(df))).first()
    assert (o.accuracy, o.macro_f1, o.weighted_f1) == (0.5, 0.3889, 0.4583)


def test_injection_moves_the_asked_share_to_other_classes(spark, sf):
    p = fixtures.predictions(spark, sf)
    out = classify.inject_label_errors(p, "truth_code", 3, ["rid"], 0.05)
    moved = out.where("is_injected")
    assert moved.count() == round(0.05 * p.count())
    assert moved.where("label_after = truth_code OR label_after NOT BETWEEN 0 AND 2").isEmpty()
    assert out.where("NOT is_injected AND label_after <> truth_code").isEmpty()
    for bad in ({"share": 0.0}, {"share": 1.0}, {"classes": 1}):
        with pytest.raises(ValueError):
            classify.inject_label_errors(p, "truth_code", bad.get("classes", 3), ["rid"], bad.get("share", 0.05))


def test_recall_falls_with_the_threshold(spark, sf):
    out = classify.inject_label_errors(fixtures.predictions(spark, sf), "truth_code", 3, ["rid"])
    recall = [r.recall_on_injected for r in classify.threshold_sweep(out, "predicted_code").orderBy("threshold").collect()]
    assert recall == sorted(recall, reverse=True) and len(recall) == 5


def test_gates_need_every_metric(spark):
    metrics = spark.createDataFrame([("macro_f1", 0.55), ("avg_mape", 0.15)], "metric string, value double")
    got = {r.metric: (r.passed, r.overall_pass) for r in classify.metric_gates(metrics).collect()}
    assert got["macro_f1"] == (True, False) and got["avg_mape"] == (False, False) and got["dbscan_silhouette"] == (False, False)


@pytest.fixture(scope="module")
def learnable(spark):
    calls = spark.range(900).select(
        F.col("id"), F.concat(F.lit("E"), (F.col("id") % 3).cast("string")).alias("priority_code"), F.lit(None).cast("string").alias("priority_description"),
        F.lit("Q1").alias("quarter"), F.lit(2000).alias("year"), F.concat(F.lit("C"), (F.col("id") % 7).cast("string")).alias("city_code"),
        F.lit("EMS").alias("service_type"), F.when(F.col("id") % 10 > 0, F.rand(1)).alias("longitude"), F.rand(2).alias("latitude"),
        F.lit(0.9).alias("completeness_score"), (F.col("id") % 3).cast("int").alias("label_code"),
    )
    return splits.split_frames(splits.stratified_split(calls, ["id"], "label_code").cache())


@pytest.mark.parametrize("kind, options", [("forest", {"numTrees": 10, "maxDepth": 4}), ("boosted", {"maxIter": 3})])
def test_both_classifiers_learn_and_report_confidence(spark, learnable, kind, options):
    model = classify.train_classifier(learnable["train"], kind=kind, balanced=True, **options)
    scored = classify.predict_confidence(model, learnable["test"].withColumn("city_code", F.lit("unseen")))
    assert scored.where("is_correct").count() >= 0.9 * scored.count()
    assert scored.where("max_confidence NOT BETWEEN 0 AND 1").isEmpty()


def test_importance_and_tuning(spark, learnable):
    model = classify.train_classifier(learnable["train"], numTrees=5, maxDepth=3)
    importance = classify.feature_importance(model, spark).collect()
    assert importance[0].feature == "priority_code" and len(importance) == 9
    trials = classify.tune_classifier(learnable["train"], learnable["validation"], trials=2).collect()
    assert len(trials) == 2 and trials[0].macro_f1 >= trials[1].macro_f1 > 0.9


def test_halving_finds_the_best_set_with_less_work(spark, learnable):
    """Noisy numbers hide the label, so depth and trees matter; every rung keeps its best sets."""
    hidden = {
        name: learnable[name].withColumn("priority_code", F.lit("E")).withColumn("longitude", F.col("label_code") * 10 + F.rand(5) * 8).withColumn("latitude", F.rand(6))
        for name in ("train", "validation")
    }
    got = classify.halve_classifier(hidden["train"], hidden["validation"], trials=6, rungs=2, keep=0.34).collect()
    last, first = [r for r in got if r.rung == 1], [r for r in got if r.rung == 0]
    assert len(first) == 6 and len(last) == 3 and all(r.share == 1.0 for r in last)
    assert {r.trial for r in last} == {r.trial for r in sorted(first, key=lambda r: (-r.macro_f1, r.trial))[:3]}
    full = {r.trial: r for r in classify.tune_classifier(hidden["train"], hidden["validation"], trials=6).collect()}
    assert all(full[r.trial].macro_f1 == pytest.approx(r.macro_f1) and full[r.trial].num_trees == r.num_trees for r in last)
    assert last[0].macro_f1 >= max(r.macro_f1 for r in full.values()) - 0.02
    for bad in ({"rungs": 0}, {"keep": 1.0}):
        with pytest.raises(ValueError):
            classify.halve_classifier(hidden["train"], hidden["validation"], **bad)


def test_many_labels_and_categories(spark):
    rows = 1200
    df = spark.range(rows).select(
        (F.col("id") % 120).cast("int").alias("label_code"),
        *[F.concat(F.lit(c), (F.col("id") % 100).cast("string")).alias(c) for c in classify.CATEGORICAL],
        *[(F.col("id") % (7 + i)).cast("int").alias(c) for i, c in enumerate(classify.NUMERIC)],
    )
    model = classify.train_classifier(df, numTrees=2, maxDepth=3)
    assert model.stages[-1].numClasses == 120
    assert classify.predict_confidence(model, df).count() == rows


def test_trees_are_fit_on_rows_dealt_evenly_to_tasks(spark, monkeypatch):
    """However few files a table has, no task keeps more rows than its share."""
    rows = [(i % 3, f"c{i % 4}", float(i % 50), float(i % 7), 1.0, 1996) for i in range(2000)]
    train = spark.createDataFrame(rows, "label_code int, city_code string, longitude double, latitude double, completeness_score double, year int")
    for c in ("priority_code", "priority_description", "quarter", "service_type"):
        train = train.withColumn(c, F.lit("x"))
    monkeypatch.setattr(classify, "TASK_ROWS", 100, raising=False)
    seen = []

    class Stop(Exception):
        pass

    class Trees:
        def fit(self, data):
            seen.extend(r["count"] for r in data.groupBy(F.spark_partition_id()).count().collect())
            raise Stop

    monkeypatch.setattr(classify, "make_classifier", lambda *a, **k: Trees())
    with pytest.raises(Stop):
        classify.train_classifier(train.coalesce(1))
    assert sum(seen) == 2000 and len(seen) == 20 and max(seen) <= 110, seen
