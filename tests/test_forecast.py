import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from sirenlake.operators import features, forecast


def quarters(n, start=2010):
    return [dt.datetime(start + i // 4, 3 * (i % 4) + 1, 1) for i in range(n)]


def series(spark, **ys):
    data = [(k, d, float(v)) for k, y in ys.items() for d, v in zip(quarters(len(y)), y)]
    return spark.createDataFrame(data, "series_id string, ds timestamp_ntz, y double")


def design(n0, n1, dates):
    q = np.array([(d.month - 1) // 3 + 1 for d in dates])
    t = np.arange(n0, n1)
    return np.column_stack([np.ones(len(t)), t, np.sin(2 * np.pi * q / 4), np.cos(2 * np.pi * q / 4)])


def test_trend_season_equals_least_squares(spark):
    rng = np.random.default_rng(0)
    ys = {"a": 50 + 3 * np.arange(20) + 10 * np.sin(np.arange(20) * np.pi / 2) + rng.normal(0, 2, 20), "b": rng.normal(100, 5, 9), "c": [1.0, 2, 4, 8]}
    got = {}
    for r in forecast.trend_seasonal_forecast(series(spark, **ys)).orderBy("ds").collect():
        got.setdefault(r.series_id, []).append(r)
    for k, y in ys.items():
        n, dates = len(y), quarters(len(y) + 4)
        a = design(0, n, dates[:n])
        beta = np.linalg.lstsq(a, np.asarray(y), rcond=None)[0]
        sigma = np.std(np.asarray(y) - a @ beta, ddof=1) if n > 4 else 0.0
        want = design(n, n + 4, dates[n:]) @ beta
        assert [r.ds for r in got[k]] == dates[n:]
        assert np.allclose([r.yhat for r in got[k]], want, atol=1e-5)
        assert np.allclose([r.yhat_upper - r.yhat_lower for r in got[k]], 2 * 1.96 * sigma, atol=1e-5)


def test_ensemble_weights(spark):
    ds = quarters(4)
    make = lambda v: spark.createDataFrame([("s", d, float(x)) for d, x in zip(ds, v)], "series_id string, ds timestamp_ntz, yhat double")
    a, b = make([100, 110, 120, 130]), make([90, 100, 110, 120])
    got = [r.yhat for r in forecast.ensemble_combine(a, b, (0.6, 0.4)).orderBy("ds").collect()]
    assert got == pytest.approx([96, 106, 116, 126])
    assert [r.yhat for r in forecast.ensemble_combine(a, b, (3, 2)).orderBy("ds").collect()] == pytest.approx(got)
    with pytest.raises(ValueError):
        forecast.ensemble_combine(a, b, (0, 0))


def test_series_features_need_full_windows(spark):
    y = list(range(1, 21))
    got = features.series_features(series(spark, a=y)).orderBy("ds").collect()
    assert len(got) == 8
    first = got[0]
    assert (first.y, first.lag_1, first.lag_12, first.time_index, first.rolling_mean_3, first.rolling_mean_6) == (13, 12, 1, 12, 11, 9.5)


def test_empty_series_is_an_error(spark):
    bad = spark.createDataFrame([("x", "1"), (None, "2")], "ds string, y string")
    with pytest.raises(Exception, match="no valid rows"):
        forecast.series_validate(bad).collect()
    with pytest.raises(ValueError):
        forecast.series_validate(bad.drop("y"))


def test_boosting_and_recursion(spark):
    ys = {k: base + 5 * np.arange(24) % 20 for k, base in (("a", 100), ("b", 300), ("c", 500))}
    ts = series(spark, **ys, short=[1.0, 2.0, 3.0])
    model, holdout = forecast.gbt_lag_forecast(ts, iterations=5)
    assert {r.n for r in holdout.groupBy("series_id").agg(F.count("*").alias("n")).collect()} == {4}
    assert forecast.mape(holdout).first().mape < 0.5
    ahead = forecast.recursive_forecast(model, ts, 4, sigma=2.0).orderBy("series_id", "ds").collect()
    assert {r.series_id for r in ahead} == {"a", "b", "c"} and len(ahead) == 12
    assert [r.ds for r in ahead[:4]] == quarters(28)[24:]
    assert all(r.yhat >= 0 and r.yhat_lower <= r.yhat <= r.yhat_upper for r in ahead)


def test_walk_forward_folds(spark):
    y = 100 + 2 * np.arange(24)
    got = forecast.walk_forward_cv(series(spark, a=y, b=y[:5])).orderBy("cutoff").collect()
    last, first = dt.date(2015, 10, 1), dt.date(2010, 1, 1)
    newest = last - dt.timedelta(365)
    want, c = [], newest
    while (c - first).days >= 730:
        want.append(c)
        c -= dt.timedelta(180)
    assert [(r.series_id, r.cutoff) for r in got] == [("a", c) for c in reversed(want)]
    assert all(r.mape < 1e-6 for r in got)


def test_quarterly_series_can_be_densified(spark):
    calls = spark.createDataFrame([(2000, "Q1"), (2000, "Q1"), (2000, "Q4"), (None, "Q2")], "year int, quarter string")
    dense = [(r.ds.month, r.y) for r in forecast.quarterly_series(calls, densify=True).orderBy("ds").collect()]
    assert dense == [(1, 2), (4, 0), (7, 0), (10, 1)]


def test_out_of_fold_encoding_never_sees_the_own_fold(spark):
    df = spark.createDataFrame([("k", 0, 1.0), ("k", 0, 3.0), ("k", 1, 10.0), ("m", 0, 5.0)], "g string, fold int, y double")
    got = {(r.g, r.fold): r.g_target_enc for r in features.geo_target_encoding_out_of_fold(df, "g", "y", "fold").collect()}
    assert got == {("k", 0): 10.0, ("k", 1): 2.0, ("m", 0): None}


def test_walk_forward_errors_equal_separate_fits(spark):
    rng = np.random.default_rng(4)
    data = {k: 50 + 3 * np.arange(n) + 8 * rng.standard_normal(n) for k, n in (("a", 40), ("b", 23), ("c", 13))}
    data["a"][20] = 0.0  # no relative error
    got = {(r.series_id, r.cutoff): (r.mape, r.n_rows) for r in forecast.walk_forward_cv(series(spark, **data), horizon_days=500).collect()}
    want = {}
    for k, y in data.items():
        days = [dt.date(2010 + i // 4, 3 * (i % 4) + 1, 1) for i in range(len(y))]
        angle = [2 * np.pi * (i % 4 + 1) / 4 for i in range(len(y))]
        x = np.array([[1, i, np.sin(a), np.cos(a)] for i, a in enumerate(angle)])
        cutoff = days[-1] - dt.timedelta(500)
        while (cutoff - days[0]).days >= 730:
            n = sum(d <= cutoff for d in days)
            beta = np.linalg.lstsq(x[:n], y[:n], rcond=None)[0]
            tested = [i for i, d in enumerate(days) if cutoff < d <= cutoff + dt.timedelta(500)]
            errors = [abs((y[i] - x[i] @ beta) / y[i]) for i in tested if y[i] != 0]
            want[k, cutoff] = (pytest.approx(np.mean(errors), abs=2e-6), len(tested))
            cutoff -= dt.timedelta(180)
    assert got == want and len(want) == 18


def test_walk_forward_never_multiplies_rows(spark):
    plan = forecast.walk_forward_cv(series(spark, a=np.arange(40.0)))._jdf.queryExecution().optimizedPlan().toString()
    for part in plan.split("Generate")[1:]:  # only folds and sums per stretch are unpacked
        assert part.lstrip().startswith(("explode(sequence", "inline(array(struct"))
    assert plan.count("Generate") == 2
