"""Classifier training, scoring and evaluation tables."""

from __future__ import annotations

import math
import random
from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, OneVsRest, RandomForestClassifier
from pyspark.ml.feature import Imputer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.ranking import hash_int, hash_rank, seeded_hash
from ..functions.semantics import count_where, drop_null_keys, ratio, round_even
from ..functions.session import spread
from .aggregates import _band
from .forest import Binning, Forest, Tree, binned, confusion_of, cuts_of, fit_forests

CATEGORICAL = ["priority_code", "priority_description", "quarter", "city_code", "service_type"]
NUMERIC = ["year", "longitude", "latitude", "completeness_score"]
CONFIDENT = 0.7
THRESHOLDS = (0.5, 0.6, 0.7, 0.8, 0.9)
ERROR_SHARE = 0.05
MISSING = "__MISSING__"
TASK_ROWS = 100_000  # training rows that a task keeps and passes over for every level of the trees


# Fitting


def fill_missing_categories(df: DataFrame, columns: Sequence[str] = CATEGORICAL) -> DataFrame:
    return df.na.fill(MISSING, subset=list(columns))


def feature_prep() -> list:
    """Stages: alphabetical codes (unknown values get a code of their own), median imputation.

    Feed it through ``fill_missing_categories``, which makes missing categories a category.
    """
    return [
        StringIndexer(
            inputCols=CATEGORICAL, outputCols=[f"{c}_code" for c in CATEGORICAL], stringOrderType="alphabetAsc", handleInvalid="keep"
        ),
        Imputer(strategy="median", inputCols=NUMERIC, outputCols=[f"{c}_num" for c in NUMERIC], relativeError=0.0001),
        VectorAssembler(inputCols=[f"{c}_code" for c in CATEGORICAL] + [f"{c}_num" for c in NUMERIC], outputCol="features"),
    ]


def as_numbers(df: DataFrame) -> DataFrame:
    """The imputer works on floating point columns only."""
    return fill_missing_categories(df).withColumns({c: F.col(c).cast("double") for c in NUMERIC})


def class_weights(train: DataFrame, label: str) -> DataFrame:
    """Balanced weights n / (k * n_class), one row per class."""
    per = drop_null_keys(train, label).groupBy(label).agg(F.count("*").alias("n_rows"))
    totals = per.agg(F.sum("n_rows").alias("n"), F.count("*").alias("k"))
    n, k = totals.select("n").scalar(), totals.select("k").scalar()
    return per.withColumn("weight", n / (k * F.col("n_rows")))


def make_classifier(kind: str = "forest", label: str = "label_code", weight: str | None = None, seed: int = 42, **params) -> Estimator:
    """Multiclass trees: a random forest (has probabilities) or one-vs-rest boosted trees."""
    common = {"labelCol": label, "featuresCol": "features"}
    if kind == "forest":
        options = {"numTrees": 40, "maxDepth": 8, "minInstancesPerNode": 5, "maxBins": 64} | params
        return RandomForestClassifier(**common, seed=seed, **options, **({"weightCol": weight} if weight else {}))
    options = {"maxIter": 20, "maxDepth": 5, "stepSize": 0.1, "maxBins": 64} | params
    booster = GBTClassifier(featuresCol="features", seed=seed, **options)
    return OneVsRest(classifier=booster, **common, **({"weightCol": weight} if weight else {}))


def train_classifier(train: DataFrame, label: str = "label_code", balanced: bool = False, kind: str = "forest", **params) -> PipelineModel:
    """Features are fitted on the table alone, then the trees; ``maxBins`` follows the largest category count."""
    data = as_numbers(train)
    columns, weight = ["features", label], None
    if balanced:
        weight = "weight"
        data = data.join(class_weights(train, label).select(label, weight), label)
        columns.append(weight)
    prep = Pipeline(stages=feature_prep()).fit(as_numbers(train))
    data = nominal_label(data, label)
    rows = spread(prep.transform(data).select(*columns), TASK_ROWS)
    trees = make_classifier(kind, label, weight, **({"maxBins": bins_for(prep)} | params)).fit(rows)
    return PipelineModel([*prep.stages, trees])


def bins_for(prep: PipelineModel) -> int:
    """Bins that hold every category of the fitted indexer and the one for unknown values."""
    return max(64, *(len(labels) + 1 for labels in prep.stages[0].labelsArray))


def nominal_label(df: DataFrame, label: str) -> DataFrame:
    """State the number of classes on the label, so that it is not guessed (which stops at 100)."""
    classes = int(df.agg(F.max(label)).first()[0] or 0) + 1
    meta = {"ml_attr": {"type": "nominal", "name": label, "num_vals": classes}}
    return df.withColumn(label, F.col(label).cast("double").alias(label, metadata=meta))


def confidence(df: DataFrame) -> Column:
    """Largest class probability; raw one-vs-rest scores are turned into shares first."""
    if "probability" in df.columns:
        return F.array_max(vector_to_array("probability"))
    raw = F.transform(vector_to_array("rawPrediction"), lambda m: 1 / (1 + F.exp(-2 * m)))
    return F.array_max(raw) / F.aggregate(raw, F.lit(0.0), lambda a, b: a + b)


def predict_confidence(model: PipelineModel, df: DataFrame, label: str = "label_code") -> DataFrame:
    scored = model.transform(as_numbers(df))
    keep = [c for c in df.columns]
    return scored.select(
        *keep,
        F.col("prediction").cast("int").alias("predicted_code"),
        round_even(confidence(scored), 4).alias("max_confidence"),
        (F.col("prediction") == F.col(label)).alias("is_correct"),
    )


def parameter_samples(n: int, seed: int = 42) -> list[dict]:
    """A reproducible random sample of the forest's parameter space."""
    rng = random.Random(seed)
    return [
        {"numTrees": rng.choice([10, 20, 40]), "maxDepth": rng.randint(4, 8), "minInstancesPerNode": rng.randint(1, 20)}
        for _ in range(n)
    ]


def _binned_frames(train: DataFrame, validation: DataFrame, label: str, seed: int) -> tuple[DataFrame, DataFrame, Binning, int]:
    """Both frames prepared by the features of ``train`` and binned, the binning and the number of classes."""
    prep = Pipeline(stages=feature_prep()).fit(as_numbers(train))
    row_hash = F.xxhash64(F.lit(seed), *train.columns).alias("_hash")
    coded = lambda df: prep.transform(as_numbers(df.where(F.col(label).isNotNull()).select("*", row_hash)))
    codes, numbers = [f"{c}_code" for c in CATEGORICAL], [f"{c}_num" for c in NUMERIC]
    arity = [len(labels) + 1 for labels in prep.stages[0].labelsArray]
    binning = Binning(codes, arity, numbers, cuts_of(coded(train), numbers))
    classes = int(train.agg(F.max(label)).first()[0] or 0) + 1
    fit_on, score_on = (binned(coded(df), binning, label, "_hash").persist() for df in (train, validation))
    return fit_on, score_on, binning, classes


def _macro_f1(score_on: DataFrame, binning: Binning, forests: Mapping[int, Sequence[Tree]]) -> dict[int, float]:
    long = confusion_of(score_on, binning, forests)
    f1 = lambda t: overall_metrics(per_class_metrics(long.where(F.col("forest") == t))).select("macro_f1").first()[0]
    return {t: float(f1(t)) for t in forests}


def tune_classifier(train: DataFrame, validation: DataFrame, label: str = "label_code", trials: int = 50, seed: int = 42) -> DataFrame:
    """Macro F1 of every sampled parameter set on the fixed validation rows, best first.

    Features are prepared and binned once; all candidates grow together, level by level.
    """
    fit_on, score_on, binning, classes = _binned_frames(train, validation, label, seed)
    samples = dict(enumerate(parameter_samples(trials, seed)))
    grown = fit_forests(fit_on, binning, classes, {t: Forest(*s.values()) for t, s in samples.items()}, seed=seed)
    scores = _macro_f1(score_on, binning, grown)
    fit_on.unpersist()
    score_on.unpersist()
    schema = "trial int, macro_f1 double, num_trees int, max_depth int, min_rows int"
    return train.sparkSession.createDataFrame([(t, scores[t], *s.values()) for t, s in samples.items()], schema).orderBy(F.desc("macro_f1"), "trial")


def halve_classifier(
    train: DataFrame, validation: DataFrame, label: str = "label_code", trials: int = 27, rungs: int = 3, keep: float = 1 / 3, seed: int = 42
) -> DataFrame:
    """Successive halving: all sampled parameter sets on few rows and trees, the best ones on ever more.

    The last rung fits on all rows with all trees; each rung before it on the share ``keep`` of the next
    one's rows, chosen by a seeded hash of the row, and as small a share of the trees, and hands on the best
    ``keep`` of its sets (at least one; ties to the smaller trial). All rungs are scored on the whole validation table.
    One row per fit, the last rung first and best first within a rung. Every rung needs rows.
    """
    if rungs < 1 or not 0 < keep < 1:
        raise ValueError("rungs must be positive and keep between 0 and 1")
    fit_on, score_on, binning, classes = _binned_frames(train, validation, label, seed)
    left, rows = dict(enumerate(parameter_samples(trials, seed))), []
    for rung in range(rungs):
        share = keep ** (rungs - 1 - rung)
        sized = {t: s | {"numTrees": max(1, round(s["numTrees"] * share))} for t, s in left.items()}
        grown = fit_forests(fit_on, binning, classes, {t: Forest(*s.values()) for t, s in sized.items()}, share, seed)
        scores = _macro_f1(score_on, binning, grown)
        rows += [(rung, share, t, scores[t], *sized[t].values()) for t in sized]
        best = sorted(sized, key=lambda t: (-scores[t], t))[: max(1, math.ceil(len(sized) * keep - 1e-9))]
        left = {t: left[t] for t in best}
    fit_on.unpersist()
    score_on.unpersist()
    schema = "rung int, share double, trial int, macro_f1 double, num_trees int, max_depth int, min_rows int"
    return train.sparkSession.createDataFrame(rows, schema).orderBy(F.desc("rung"), F.desc("macro_f1"), "trial")


def feature_importance(model: PipelineModel, spark: SparkSession) -> DataFrame:
    values = model.stages[-1].featureImportances.toArray()
    rows = [(n, round(float(v), 6)) for n, v in zip(CATEGORICAL + NUMERIC, values)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def score_saved_model(path: str, df: DataFrame, label: str = "label_code") -> DataFrame:
    """Reload a fitted pipeline, predict the held-out rows and report the overall metrics."""
    scored = predict_confidence(PipelineModel.load(path), df, label)
    return overall_metrics(per_class_metrics(confusion_long(scored, label, "predicted_code")))


# Evaluation tables


def flag_disagreements(df: DataFrame, threshold: float = CONFIDENT) -> DataFrame:
    return df.withColumn("is_disagreement", (F.col("max_confidence") > threshold) & ~F.col("is_correct"))


def confusion_long(df: DataFrame, truth: str = "truth", predicted: str = "predicted") -> DataFrame:
    """Rows per (truth, predicted) pair as text; numeric codes lose their fraction."""
    types = dict(df.dtypes)

    def text(c: str) -> Column:
        return (F.col(c).cast("int") if types[c] == "double" else F.col(c)).cast("string")

    return df.groupBy(text(truth).alias("truth"), text(predicted).alias("predicted")).agg(F.count("*").alias("n"))


def confusion_matrix(df: DataFrame, labels: Sequence[str], truth: str = "truth", predicted: str = "predicted") -> DataFrame:
    """Square matrix over the given classes, zero-filled, in label order."""
    labels = list(labels)
    wide = confusion_long(df, truth, predicted).groupBy("truth").pivot("predicted", labels).agg(F.sum("n"))
    frame = df.sparkSession.createDataFrame([(i, c) for i, c in enumerate(labels)], "class_order int, truth string")
    return frame.join(wide, "truth", "left").na.fill(0, subset=labels).orderBy("class_order").drop("class_order")


def per_class_metrics(long: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class; a zero denominator gives 0."""
    hit = F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(0)
    sides = long.select(
        F.explode(
            F.array(
                F.struct(F.col("truth").alias("class"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted_rows"), hit.alias("tp")),
                F.struct(F.col("predicted").alias("class"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predicted_rows"), F.lit(0).cast("bigint").alias("tp")),
            )
        ).alias("s")
    )
    per = sides.groupBy("s.class").agg(
        F.sum("s.support").alias("support"), F.sum("s.predicted_rows").alias("predicted_rows"), F.sum("s.tp").alias("tp")
    )
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return per.select(
        "class",
        zero(ratio(F.col("tp"), F.col("predicted_rows"))).alias("precision"),
        zero(ratio(F.col("tp"), F.col("support"))).alias("recall"),
        zero(ratio(2 * F.col("tp"), F.col("predicted_rows") + F.col("support"))).alias("f1"),
        "support",
        "tp",
    )


def rounded_class_metrics(long: DataFrame) -> DataFrame:
    out = per_class_metrics(long)
    return out.select("class", *[round_even(F.col(c), 4).alias(c) for c in ("precision", "recall", "f1")], "support")


def overall_metrics(per_class: DataFrame) -> DataFrame:
    share = lambda c: ratio(F.sum(F.col(c) * F.col("support")), F.sum("support"))
    values = {
        "accuracy": ratio(F.sum("tp"), F.sum("support")),
        "macro_f1": F.avg("f1"),
        "weighted_f1": share("f1"),
        "macro_precision": F.avg("precision"),
        "macro_recall": F.avg("recall"),
    }
    return per_class.agg(*[round_even(v, 4).alias(k) for k, v in values.items()])


def inject_label_errors(df: DataFrame, label: str, classes: int, ids: Sequence[str], share: float = ERROR_SHARE, seed: int = 42) -> DataFrame:
    """Move a seeded share of the label codes to another class (always a different one)."""
    if not 0 < share < 1:
        raise ValueError("share must lie strictly between 0 and 1")
    if classes < 2:
        raise ValueError("need at least two classes")
    ranked = hash_rank(df.withColumn("_h", seeded_hash(seed, *ids)), [], "_h", "_r")
    quota = F.greatest(F.lit(1), F.rint(F.col("group_size") * share).cast("bigint"))
    moved = (F.col(label) + 1 + hash_int(F.col("_h"), 9, 8) % (classes - 1)) % classes
    return (
        ranked.withColumn("is_injected", F.col("_r") <= quota)
        .withColumn("label_after", F.when(F.col("is_injected"), moved).otherwise(F.col(label)).cast("int"))
        .drop("_h", "_r", "group_size")
    )


def threshold_sweep(df: DataFrame, predicted: str, thresholds: Sequence[float] = THRESHOLDS) -> DataFrame:
    """Flag quality per threshold from one scan (conditional counts, unpivoted afterwards)."""
    wrong = F.col(predicted) != F.col("label_after")
    counts = [F.count_if("is_injected").alias("p"), F.count_if(~F.col("is_injected")).alias("u")]
    for i, t in enumerate(thresholds):
        flagged = (F.col("max_confidence") > t) & wrong
        counts += [F.count_if(flagged & F.col("is_injected")).alias(f"p{i}"), F.count_if(flagged & ~F.col("is_injected")).alias(f"u{i}")]
    rows = F.array(
        *[
            F.struct(F.lit(float(t)).alias("threshold"), F.col(f"p{i}").alias("fp"), F.col(f"u{i}").alias("fu"))
            for i, t in enumerate(thresholds)
        ]
    )
    long = df.agg(*counts).select("p", "u", F.inline(rows))
    rate = lambda a, b: round_even(F.coalesce(ratio(a, b), F.lit(0.0)), 4)
    p, u, fp, fu = (F.col(c) for c in ("p", "u", "fp", "fu"))
    return long.select(
        "threshold",
        p.alias("n_injected"),
        u.alias("n_untouched"),
        (fp + fu).alias("n_flagged"),
        fp.alias("n_flagged_injected"),
        fu.alias("n_flagged_untouched"),
        rate(fp, p).alias("recall_on_injected"),
        rate(fu, u).alias("false_alarm_rate"),
        rate(fp, fp + fu).alias("precision_proxy"),
    )


def agreement_status(df: DataFrame) -> DataFrame:
    right, sure = F.col("is_correct"), F.col("max_confidence") >= CONFIDENT
    return df.withColumn("status", F.when(right & sure, "Match").when(right, "Review").otherwise("Mismatch"))


def agreement_by_group(df: DataFrame, group: str, n: int | None = None) -> DataFrame:
    per = (
        drop_null_keys(df, group)
        .groupBy(group)
        .agg(
            F.count("*").alias("total"),
            count_where(F.col("is_correct")).alias("matches"),
            round_even(F.avg(F.col("is_correct").cast("double")) * 100, 2).alias("accuracy_pct"),
            round_even(F.avg("max_confidence") * 100, 1).alias("avg_confidence_pct"),
            count_where(F.col("is_disagreement")).alias("disagreements"),
        )
        .withColumn("status", _band(F.col("accuracy_pct"), ((70.0, "Match"), (50.0, "Review")), "Mismatch"))
    )
    ordered = per.orderBy(F.desc("total"), group)
    return ordered.limit(n) if n else ordered


def completeness_trend(df: DataFrame) -> DataFrame:
    return drop_null_keys(df, "year").groupBy("year").agg(round_even(F.avg("completeness_score") * 100, 2).alias("completeness_pct"))


# Metric -> (target, direction).
METRIC_TARGETS = {
    "macro_f1": (0.55, "greater"),
    "avg_mape": (0.15, "less"),
    "dbscan_silhouette": (0.35, "greater"),
    "iso_forest_recall_20": (0.25, "greater"),
}


def metric_gates(metrics: DataFrame, targets: Mapping[str, tuple[float, str]] = METRIC_TARGETS) -> DataFrame:
    """Each computed metric against its target (a value on the target passes "greater")."""
    spec = metrics.sparkSession.createDataFrame([(k, *v) for k, v in targets.items()], "metric string, target double, direction string")
    passed = F.when(F.col("direction") == "greater", F.col("value") >= F.col("target")).otherwise(F.col("value") < F.col("target"))
    judged = spec.join(metrics.select("metric", "value"), "metric", "left").withColumn("passed", F.coalesce(passed, F.lit(False)))
    overall = F.min(F.col("passed").cast("int")).over(Window.partitionBy(F.lit(0)))
    return judged.withColumn("overall_pass", overall == 1)


def qa_kpis(df: DataFrame, target: float = 0.90) -> DataFrame:
    mean = F.coalesce(F.avg("completeness_score"), F.lit(0.0))
    return df.agg(
        count_where(F.col("is_disagreement")).alias("disagreements"),
        F.count("*").alias("n_rows"),
        round_even(mean, 6).alias("mean_completeness"),
        (round_even(mean, 6) >= target).alias("meets_target"),
    )
