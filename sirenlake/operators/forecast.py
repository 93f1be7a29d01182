"""Demand series and forecasts for many series at once."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranking import range_rank
from ..functions.semantics import drop_null_keys, ratio, round_even
from ..functions.session import cut_lineage
from .clean import filter_by
from .features import cycle, quarter_lag_features
from .joins import join_forecasts

Z95 = 1.96
MIN_HISTORY = 6
QUARTER_LAGS = (1, 2, 4)
STEP_MONTHS = {"month": 1, "quarter": 3}


def monthly_series(df: DataFrame, keys: Sequence[str] = (), ts: str = "ds") -> DataFrame:
    start = F.date_trunc("month", F.col(ts)).cast("timestamp_ntz")
    dated = df.where(F.col(ts).isNotNull()).withColumn("ds", start)
    return dated.groupBy(*keys, "ds").agg(F.count("*").alias("y"))


def quarter_start(year: Column, quarter: Column) -> Column:
    number = F.substring(quarter, 2, 1).cast("int")
    return F.make_date(year.cast("int"), number * 3 - 2, F.lit(1)).cast("timestamp_ntz")


def quarterly_series(df: DataFrame, keys: Sequence[str] = (), densify: bool = False, **filters) -> DataFrame:
    """Filtered calls per quarter start; ``densify`` adds zero rows for quarters without calls."""
    kept = drop_null_keys(filter_by(df, **filters), "year", "quarter")
    out = (
        kept.groupBy(*keys, "year", "quarter")
        .agg(F.count("*").alias("y"))
        .select(*keys, quarter_start(F.col("year"), F.col("quarter")).alias("ds"), "y")
    )
    if not densify:
        return out
    ends = out.groupBy(*keys).agg(F.min("ds").alias("a"), F.max("ds").alias("b"))
    grid = ends.select(*keys, F.explode(F.sequence("a", "b", F.expr("INTERVAL 3 MONTHS"))).alias("ds"))
    return grid.join(out, [*keys, "ds"], "left").withColumn("y", F.coalesce("y", F.lit(0)))


def series_validate(df: DataFrame, keys: Sequence[str] = (), allow_missing_y: bool = False) -> DataFrame:
    """Typed (ds, y) rows without missing values; a run-time error when nothing is left."""
    absent = {"ds", "y"} - set(df.columns)
    if absent:
        raise ValueError(f"time series lacks {sorted(absent)}")
    typed = df.select(
        *keys,
        F.col("ds").cast("string").try_cast("timestamp_ntz").alias("ds"),
        F.col("y").cast("string").try_cast("double").alias("y"),
    ).na.drop(subset=["ds"] if allow_missing_y else ["ds", "y"])
    rows = typed.agg(F.count("*").alias("n"))
    checked = rows.select(F.when(F.col("n") == 0, F.raise_error(F.lit("time series has no valid rows")).cast("bigint")).otherwise(F.col("n")))
    return typed.where(checked.scalar() > 0).orderBy(*keys, "ds")


def future_periods(ts: DataFrame, horizon: int, grain: str = "quarter", series: str = "series_id") -> DataFrame:
    """The next period starts of every series and their step number."""
    months = STEP_MONTHS[grain]
    last = ts.groupBy(series).agg(F.max("ds").alias("last"), F.count("*").alias("n"))
    start = F.date_trunc(grain, F.col("last")).cast("date")
    return last.select(series, "n", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"), start.alias("s")).select(
        series, "n", "step", F.add_months("s", F.col("step") * months).cast("timestamp_ntz").alias("ds")
    )


# Trend + season by least squares: sums per series, then a 4 x 4 solve


def _design(t: Column, quarter: Column) -> list[Column]:
    angle = 2 * math.pi * quarter / 4
    return [F.lit(1.0), t.cast("double"), F.sin(angle), F.cos(angle)]


def _solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row of cross products per series in, its four coefficients out."""
    for pdf in batches:
        xx = np.stack(pdf["xx"].to_numpy()).reshape(-1, 4, 4) if len(pdf) else np.zeros((0, 4, 4))
        xy = np.stack(pdf["xy"].to_numpy()) if len(pdf) else np.zeros((0, 4))
        beta = np.einsum("nij,nj->ni", np.linalg.pinv(xx, hermitian=True, rcond=1e-12), xy)
        yield pdf.drop(columns=["xx", "xy"]).assign(beta=list(beta))


def fit_trend_season(ts: DataFrame, keys: Sequence[str] = ("series_id",)) -> DataFrame:
    """Coefficients on [1, t, sin, cos of the quarter] and the residual spread of each series.

    Everything that touches the rows is a grouped sum; Python sees one row per series.
    """
    keys = list(keys)
    order = Window.partitionBy(*keys).orderBy("ds")
    x = _design(F.col("t"), F.quarter("ds"))
    rows = ts.withColumn("t", F.row_number().over(order) - 1).withColumn("x", F.array(*x))
    part = lambda i, j: F.sum(F.col("x")[i] * F.col("x")[j])
    sums = rows.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.max("ds").alias("last"),
        F.array(*[part(i, j) for i in range(4) for j in range(4)]).alias("xx"),
        F.array(*[F.sum(F.col("x")[i] * F.col("y")) for i in range(4)]).alias("xy"),
    )
    types = {f.name: f.dataType.simpleString() for f in sums.schema.fields}
    schema = ", ".join([f"`{k}` {types[k]}" for k in keys] + ["n bigint", f"last {types['last']}", "beta array<double>"])
    fitted = sums.mapInPandas(_solve, schema)
    residual = F.col("y") - sum(F.col("x")[i] * F.col("beta")[i] for i in range(4))
    spread = (
        rows.join(fitted.select(*keys, "beta"), keys)
        .groupBy(*keys)
        .agg(F.stddev_samp(residual).alias("sd"), F.count("*").alias("rows"))
        .select(*keys, F.when(F.col("rows") > 4, F.col("sd")).otherwise(0.0).alias("sigma"))
    )
    return fitted.join(spread, keys)


def _predict(beta: Column, t: Column, quarter: Column) -> Column:
    return sum(x * beta[i] for i, x in enumerate(_design(t, quarter)))


def trend_seasonal_forecast(ts: DataFrame, horizon: int = 4, grain: str = "quarter", series: str = "series_id") -> DataFrame:
    """Point forecast with a 95 % interval for the next periods of every series."""
    fitted = fit_trend_season(ts, [series]).drop("n", "last")
    ahead = future_periods(ts, horizon, grain, series).join(fitted, series)
    yhat = _predict(F.col("beta"), F.col("n") + F.col("step") - 1, F.quarter("ds"))
    return ahead.withColumn("yhat", yhat).select(
        series,
        "ds",
        "yhat",
        (F.col("yhat") - Z95 * F.col("sigma")).alias("yhat_lower"),
        (F.col("yhat") + Z95 * F.col("sigma")).alias("yhat_upper"),
    )


# Boosted trees on lags: one model over all series


def _boosted_features(lags: Sequence[int]) -> list[str]:
    return ["series_index", "t", "q_sin", "q_cos", *[f"lag_{n}" for n in lags]]


def series_numbers(ts: DataFrame, series: str) -> DataFrame:
    """Series in alphabetical order with a dense number, ``series_index``, of their own."""
    return range_rank(ts.select(series).where(F.col(series).isNotNull()).distinct(), [], [series], "series_index").select(series, F.col("series_index").cast("int"))


def boosted_frame(ts: DataFrame, series: str = "series_id", lags: Sequence[int] = QUARTER_LAGS) -> DataFrame:
    """Lag features, series index and a time-based hold-out mark (last fifth, at least 3 rows).

    A series too short to keep three training rows gives up fewer hold-out rows.
    """
    rows = quarter_lag_features(ts, series, lags).join(series_numbers(ts, series), series, "left")
    whole = Window.partitionBy(series)
    from_end = F.row_number().over(whole.orderBy(F.desc("ds")))
    size = F.count("*").over(whole)
    held = F.least(F.greatest(F.lit(3), F.floor(size * 0.2)), F.greatest(F.lit(1), size - 3))
    return rows.withColumn("is_holdout", from_end <= held)


def gbt_lag_fit(frame: DataFrame, lags: Sequence[int] = QUARTER_LAGS, iterations: int = 40, depth: int = 4, seed: int = 42) -> PipelineModel:
    assembler = VectorAssembler(inputCols=_boosted_features(lags), outputCol="features")
    train = assembler.transform(frame.withColumn("y", F.col("y").cast("double")))
    model = GBTRegressor(labelCol="y", maxIter=iterations, maxDepth=depth, stepSize=0.1, seed=seed).fit(train)
    return PipelineModel([assembler, model])


def _non_negative(df: DataFrame) -> DataFrame:
    return df.withColumn("yhat", F.greatest(F.lit(0.0), F.col("prediction"))).drop("prediction", "features")


def gbt_lag_forecast(ts: DataFrame, series: str = "series_id", **options) -> tuple[PipelineModel, DataFrame]:
    """(model refitted on all rows, scored hold-out of the model fitted without it)."""
    frame = cut_lineage(boosted_frame(ts, series))
    trial = gbt_lag_fit(frame.where(~F.col("is_holdout")), **options)
    scored = _non_negative(trial.transform(frame.where("is_holdout")))
    return gbt_lag_fit(frame, **options), scored.select(series, "ds", "y", "yhat")


def recursive_forecast(
    model: PipelineModel, ts: DataFrame, horizon: int = 4, grain: str = "quarter", series: str = "series_id", lags: Sequence[int] = QUARTER_LAGS, sigma: float = 0.0
) -> DataFrame:
    """Feed each prediction back as the newest lag.

    The driver loops over the horizon only; a step is one projection over all series, whose state
    is the few most recent values. Each step is written out so that plans stay flat.
    """
    reach = max(lags)
    w = Window.partitionBy(series).orderBy("ds")
    recent = ts.withColumn("n", F.row_number().over(w)).withColumn(
        "state", F.array(*[F.lag("y", k).over(w).cast("double") for k in range(reach)])
    )
    newest = Window.partitionBy(series).orderBy(F.desc("ds"))
    state = (
        recent.withColumn("r", F.row_number().over(newest))
        .where((F.col("r") == 1) & (F.col("n") >= reach))
        .join(series_numbers(ts, series), series)
        .select(series, "series_index", "n", "state", F.date_trunc(grain, F.col("ds")).cast("date").alias("d"))
    )
    state = cut_lineage(state)
    steps = []
    for _ in range(horizon):
        ahead = state.withColumn("d", F.add_months("d", STEP_MONTHS[grain]))
        ahead = ahead.withColumn("t", F.col("n")).withColumns(cycle(F.quarter("d"), 4, "q"))
        ahead = ahead.withColumns({f"lag_{k}": F.col("state")[k - 1] for k in lags})
        scored = cut_lineage(_non_negative(model.transform(ahead)))
        steps.append(scored.select(series, F.col("d").cast("timestamp_ntz").alias("ds"), "yhat"))
        state = scored.select(
            series,
            "series_index",
            (F.col("n") + 1).alias("n"),
            F.slice(F.concat(F.array("yhat"), F.col("state")), 1, reach).alias("state"),
            "d",
        )
    out = steps[0]
    for s in steps[1:]:
        out = out.unionByName(s)
    return out.withColumns(
        {
            "yhat_lower": F.greatest(F.lit(0.0), F.col("yhat") - Z95 * sigma),
            "yhat_upper": F.col("yhat") + Z95 * sigma,
        }
    )


def ensemble_combine(trend: DataFrame, boosted: DataFrame, weights: tuple[float, float] = (0.5, 0.5), keys: Sequence[str] = ("series_id", "ds")) -> DataFrame:
    """Weighted mean of both models; bounds are combined when both models have them.

    With one set of bounds (the trend model's) those are kept as they are.
    """
    total = sum(weights)
    if total <= 0:
        raise ValueError("ensemble weights must have a positive sum")
    a, b = weights[0] / total, weights[1] / total
    out = join_forecasts(trend, boosted, keys)
    out = out.withColumn("yhat", a * F.col("trend_yhat") + b * F.col("boosted_yhat"))
    bounds = ("yhat_lower", "yhat_upper")
    if set(bounds) <= set(trend.columns) and set(bounds) <= set(boosted.columns):
        other = boosted.select(*keys, *[F.col(c).alias(f"_{c}") for c in bounds])
        out = out.join(other, list(keys), "left").withColumns({c: a * F.col(c) + b * F.col(f"_{c}") for c in bounds})
        out = out.drop(*[f"_{c}" for c in bounds])
    return out


def quarter_name(ds: Column) -> Column:
    return F.concat(F.lit("Q"), F.quarter(ds).cast("string"), F.lit(" "), F.year(ds).cast("string"))


def forecast_finalise(history: DataFrame, forecast: DataFrame, series: str = "series_id", context: int = 12, min_history: int = MIN_HISTORY) -> DataFrame:
    """Recent history and the clipped, rounded forecast in one labelled table.

    Series with too little history have no forecast and drop out.
    """
    newest = Window.partitionBy(series).orderBy(F.desc("ds"))
    long_enough = history.groupBy(series).agg(F.count("*").alias("n")).where(F.col("n") >= min_history).select(series)
    shown = (
        history.withColumn("r", F.row_number().over(newest))
        .where(F.col("r") <= context)
        .select(series, "ds", F.lit("history").alias("kind"), F.col("y").cast("double").alias("value"))
        .withColumns({"lower_bound": F.lit(None).cast("double"), "upper_bound": F.lit(None).cast("double")})
    )
    tidy = lambda c: F.rint(F.greatest(F.lit(0.0), F.col(c)))
    ahead = forecast.select(
        series, "ds", F.lit("forecast").alias("kind"), tidy("yhat").alias("value"),
        tidy("yhat_lower").alias("lower_bound"), tidy("yhat_upper").alias("upper_bound"),
    )
    return shown.unionByName(ahead).join(long_enough, series, "left_semi").withColumn("quarter_label", quarter_name(F.col("ds")))


def mape(df: DataFrame, actual: str = "y", predicted: str = "yhat", keys: Sequence[str] = ()) -> DataFrame:
    error = F.abs(ratio(F.col(actual) - F.col(predicted), F.col(actual)))
    return df.groupBy(*keys).agg(round_even(F.avg(error), 6).alias("mape"), F.count("*").alias("n_rows"))


def walk_forward_cv(
    ts: DataFrame, initial_days: int = 730, step_days: int = 180, horizon_days: int = 365, series: str = "series_id"
) -> DataFrame:
    """Rolling-origin error per series and cutoff.

    Cutoffs go back from (last - horizon) in steps while enough history remains. Rows are summed once per
    stretch between two cutoffs; the normal equations of a cutoff are the sums of all stretches up to it. The
    errors of a row under the few cutoffs whose horizon it lies in are summed per stretch, too, so rows are
    never multiplied, however many cutoffs there are.
    """
    newest = (F.col("b") - F.make_dt_interval(F.lit(horizon_days))).cast("date")
    ends = ts.groupBy(series).agg(F.min("ds").alias("a"), F.max("ds").alias("b"))
    bounds = ends.select(series, newest.alias("newest"), F.floor((F.datediff(newest, F.col("a")) - initial_days) / step_days).alias("oldest")).where("oldest >= 0")
    numbered = ts.withColumn("t", F.row_number().over(Window.partitionBy(series).orderBy("ds")) - 1)
    back = F.datediff("newest", F.to_date("ds"))
    rows = numbered.join(bounds, series).withColumns({"stretch": F.floor(back / step_days), "last": F.floor((back + horizon_days) / step_days)})

    x = _design(F.col("t"), F.quarter("ds"))
    terms = [a * b for a in x for b in x] + [a * F.col("y") for a in x]
    moments = (
        rows.where("stretch >= 0")
        .groupBy(series, F.least("stretch", "oldest").alias("fold"))
        .agg(*[F.sum(term).alias(f"m{i}") for i, term in enumerate(terms)])
    )
    folds = bounds.select(series, F.explode(F.sequence(F.lit(0).cast("bigint"), "oldest")).alias("fold"))
    earlier = Window.partitionBy(series).orderBy(F.desc("fold")).rowsBetween(Window.unboundedPreceding, 0)
    upto = [F.coalesce(F.sum(f"m{i}").over(earlier), F.lit(0.0)) for i in range(len(terms))]
    sums = folds.join(moments, [series, "fold"], "left").select(series, "fold", F.array(*upto[:16]).alias("xx"), F.array(*upto[16:]).alias("xy"))
    fitted = sums.mapInPandas(_solve, f"`{series}` {ts.schema[series].dataType.simpleString()}, fold bigint, beta array<double>")
    of_series = fitted.groupBy(series).agg(F.map_from_entries(F.collect_list(F.struct("fold", "beta"))).alias("betas"))

    measures = []
    for j in range(math.ceil(horizon_days / step_days)):
        fold = F.col("stretch") + 1 + j
        tested = (fold >= 0) & (fold <= F.least("last", "oldest"))
        yhat = _predict(F.element_at("betas", fold), F.col("t"), F.quarter("ds"))
        error = F.when(tested, F.abs(ratio(F.col("y") - yhat, F.col("y"))))
        measures += [F.sum(error).alias(f"e{j}"), F.count(error).alias(f"k{j}"), F.count_if(tested).alias(f"n{j}")]
    per_stretch = rows.join(of_series, series).groupBy(series, "newest", "stretch").agg(*measures)
    parts = F.array(*[F.struct((F.col("stretch") + 1 + j).alias("fold"), F.col(f"e{j}").alias("e"), F.col(f"k{j}").alias("k"), F.col(f"n{j}").alias("n")) for j in range(len(measures) // 3)])
    per_fold = per_stretch.select(series, "newest", F.inline(parts)).where("n > 0").groupBy(series, "newest", "fold").agg(F.sum("e").alias("e"), F.sum("k").alias("k"), F.sum("n").alias("n_rows"))
    cutoff = F.date_sub("newest", (F.col("fold") * step_days).cast("int"))
    return per_fold.select(series, cutoff.alias("cutoff"), round_even(ratio(F.col("e"), F.col("k")), 6).alias("mape"), "n_rows")
