"""Time-series and model features."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranking import range_rank
from ..functions.semantics import drop_null_keys, ratio, round_even

BLOCK_ROWS = 100_000


def cycle(c: Column, period: int, name: str) -> dict[str, Column]:
    angle = 2 * math.pi * c / period
    return {f"{name}_sin": F.sin(angle), f"{name}_cos": F.cos(angle)}


def cyclical_features(df: DataFrame, ts: str) -> DataFrame:
    """Hour, weekday (Monday = 0) and month with their position on the circle."""
    out = df.withColumns(
        {
            "hour": F.hour(ts).cast("tinyint"),
            "day_of_week": F.weekday(ts).cast("tinyint"),
            "month": F.month(ts).cast("tinyint"),
        }
    )
    return out.withColumns(
        cycle(F.col("hour"), 24, "hour") | cycle(F.col("day_of_week"), 7, "dow") | cycle(F.col("month"), 12, "month")
    )


def geo_target_encoding(df: DataFrame, key: str, target: str) -> DataFrame:
    """Mean target per key, joined back. A grouped mean survives hot keys; a window would not."""
    means = drop_null_keys(df, key).groupBy(key).agg(F.avg(target).alias(f"{key}_target_enc"))
    return df.join(means, key, "left")


def geo_target_encoding_out_of_fold(df: DataFrame, key: str, target: str, fold: str) -> DataFrame:
    """The mean over the other folds only, from per-(key, fold) sums, so a row never sees itself."""
    parts = drop_null_keys(df, key).groupBy(key, fold).agg(F.sum(target).alias("s"), F.count(target).alias("n"))
    totals = parts.groupBy(key).agg(F.sum("s").alias("ts"), F.sum("n").alias("tn"))
    enc = parts.join(totals, key).select(
        key, fold, ratio(F.col("ts") - F.col("s"), F.col("tn") - F.col("n")).alias(f"{key}_target_enc")
    )
    return df.join(enc, [key, fold], "left")


def lag_features(
    df: DataFrame,
    target: str,
    order_by: Sequence[str],
    lags: Sequence[int] = (1, 2, 3),
    groups: Sequence[str] = (),
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Row lags within groups in a stated, unique order.

    Groups of any size are cut into blocks of ``block_rows`` consecutive rows; the last rows of a
    block are repeated at the start of the next, so no task ever sorts a whole hot group.
    """
    groups, reach = list(groups), max(lags)
    ranked = range_rank(df, groups, order_by, "_rank")
    block = F.floor((F.col("_rank") - 1) / block_rows)
    near_end = (F.col("_rank") - 1) % block_rows >= block_rows - reach
    placed = ranked.withColumn(
        "_block", F.explode(F.when(near_end, F.array(block, block + 1)).otherwise(F.array(block)))
    )
    in_block = Window.partitionBy(*groups, "_block").orderBy("_rank")
    lagged = placed.withColumns({f"{target}_lag_{n}": F.lag(target, n).over(in_block) for n in lags})
    return lagged.where(F.col("_block") == block).drop("_rank", "_block")


def _series_window(series: str) -> Window:
    """One row per period and series: a window here is as long as the calendar, never the data."""
    return Window.partitionBy(series).orderBy("ds")


def series_features(
    ts: DataFrame, series: str = "series_id", lags: Sequence[int] = (1, 2, 3, 6, 12), windows: Sequence[int] = (3, 6), drop_incomplete: bool = True
) -> DataFrame:
    """Calendar features, row lags and means of the previous rows (full windows only)."""
    w = _series_window(series)
    out = ts.withColumns(
        {
            "month": F.month("ds"),
            "quarter": F.quarter("ds"),
            "year": F.year("ds"),
            "time_index": F.row_number().over(w) - 1,
        }
    ).withColumns(cycle(F.month("ds"), 12, "month"))
    out = out.withColumns({f"lag_{n}": F.lag("y", n).over(w) for n in lags})
    means = {}
    for n in windows:
        prev = w.rowsBetween(-n, -1)
        means[f"rolling_mean_{n}"] = F.when(F.count("y").over(prev) == n, F.avg("y").over(prev))
    out = out.withColumns(means)
    return out.na.drop(subset=[*[f"lag_{n}" for n in lags], *means, "y"]) if drop_incomplete else out


def quarter_lag_features(ts: DataFrame, series: str = "series_id", lags: Sequence[int] = (1, 2, 4), drop_incomplete: bool = True) -> DataFrame:
    w = _series_window(series)
    out = ts.withColumn("t", F.row_number().over(w) - 1).withColumns(cycle(F.quarter("ds"), 4, "q"))
    out = out.withColumns({f"lag_{n}": F.lag("y", n).over(w) for n in lags})
    return out.na.drop(subset=[f"lag_{n}" for n in lags]) if drop_incomplete else out


def yoy_growth(df: DataFrame, year: str = "year") -> DataFrame:
    """Percent change between consecutive years that have rows (the window is over years)."""
    yearly = drop_null_keys(df, year).groupBy(year).agg(F.count("*").alias("total_calls"))
    before = F.lag("total_calls").over(Window.partitionBy(F.lit(0)).orderBy(year))
    pct = F.try_divide((F.col("total_calls") - before) * 100.0, before)
    return yearly.withColumn("yoy_growth_pct", round_even(pct, 6))


def period_rank(df: DataFrame) -> DataFrame:
    """Distinct (year, quarter) in order; the last is test, the one before validation.

    With fewer than four periods there is no chronological split and the role is "random".
    """
    periods = drop_null_keys(df, "year", "quarter").select("year", "quarter").distinct()
    w = Window.partitionBy(F.lit(0)).orderBy("year", "quarter")
    whole = Window.partitionBy(F.lit(0))
    ranked = periods.withColumns({"period_no": F.row_number().over(w), "periods": F.count("*").over(whole).cast("int")})
    role = (
        F.when(F.col("periods") < 4, "random")
        .when(F.col("period_no") == F.col("periods"), "test")
        .when(F.col("period_no") == F.col("periods") - 1, "validation")
        .otherwise("train")
    )
    return ranked.withColumn("role", role).drop("periods")


def row_share_normalise(long: DataFrame, row: str = "truth", value: str = "n") -> DataFrame:
    """Percent of each confusion row; an all-zero row divides by 1."""
    total = F.sum(value).over(Window.partitionBy(row))
    base = F.when(total == 0, F.lit(1)).otherwise(total)
    return long.withColumn("row_pct", round_even(F.col(value) / base * 100.0, 6))


def zscore_scale(df: DataFrame, columns: Sequence[str], suffix: str = "_z") -> DataFrame:
    """Population z-scores; a constant column is only centred."""
    stats = df.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]
    )

    def scaled(c: str) -> Column:
        mean, std = stats.select(f"m_{c}").scalar(), stats.select(f"s_{c}").scalar()
        return (F.col(c) - mean) / F.coalesce(F.nullif(std, F.lit(0.0)), F.lit(1.0))

    return df.withColumns({f"{c}{suffix}": scaled(c) for c in columns})
