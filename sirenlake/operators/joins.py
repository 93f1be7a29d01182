"""Joins, set operations and lookups.

No join carries a broadcast hint for data that can grow: Spark compares the actual size with
``spark.sql.autoBroadcastJoinThreshold`` and otherwise sorts and merges, splitting skewed keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.semantics import col, ratio, strip, to_number, zero_pad
from .quality import many_to_one_guard

# Survey variable -> column name.
CENSUS_VARIABLES = {
    "B01003_001E": "population",
    "B17001_001E": "poverty_universe",
    "B17001_002E": "poverty_count",
    "B02001_002E": "white_alone_count",
    "B02001_003E": "black_alone_count",
    "B02001_005E": "asian_alone_count",
    "B03003_003E": "hispanic_or_latino_count",
    "B19013_001E": "median_household_income",
}
SHARES = {
    "poverty_rate": ("poverty_count", "poverty_universe"),
    "white_alone_pct": ("white_alone_count", "population"),
    "black_alone_pct": ("black_alone_count", "population"),
    "asian_alone_pct": ("asian_alone_count", "population"),
    "hispanic_or_latino_pct": ("hispanic_or_latino_count", "population"),
}
KEY = "census_block_group"


def normalise_geoid(c: Column | str) -> Column:
    """12 digits: drop a trailing ".0", keep digits, pad with zeros; NULL when none are left."""
    digits = F.regexp_replace(F.regexp_replace(strip(col(c).cast("string")), r"\.0$", ""), r"\D", "")
    return zero_pad(F.nullif(digits, F.lit("")), 12)


def standardise_census(raw: DataFrame, order: str | None = None) -> DataFrame:
    """Tidy survey columns, area in km2, density and shares; the first row per key by ``order``."""
    key = next((c for c in (KEY, "geoid", "GEOID") if c in raw.columns), None)
    if key is None:
        raise KeyError("census data needs census_block_group, geoid or GEOID")
    df = raw.withColumnsRenamed({**CENSUS_VARIABLES, "NAME": "census_name"})
    df = df.withColumn(KEY, normalise_geoid(key))
    numbers = [*CENSUS_VARIABLES.values(), "land_area_sq_km", "land_area_sq_m", "ALAND"]
    df = df.withColumns({c: to_number(c) for c in numbers if c in df.columns})
    for c in CENSUS_VARIABLES.values():
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("double"))
    if "census_name" not in df.columns:
        df = df.withColumn("census_name", F.lit(None).cast("string"))
    if "land_area_sq_km" not in df.columns:
        metres = next((c for c in ("land_area_sq_m", "ALAND") if c in df.columns), None)
        area = F.col(metres) / 1e6 if metres else F.lit(None).cast("double")
        df = df.withColumn("land_area_sq_km", area)
    if "population_density_per_sq_km" not in df.columns:
        df = df.withColumn("population_density_per_sq_km", ratio(F.col("population"), F.col("land_area_sq_km")))
    df = df.withColumns({name: ratio(F.col(a), F.col(b)) for name, (a, b) in SHARES.items()})
    out = ["census_name", "population", "land_area_sq_km", "population_density_per_sq_km", *SHARES, "median_household_income"]
    row = F.struct(*out)
    first = F.min_by(row, F.col(order)) if order else F.first(row)
    return df.groupBy(KEY).agg(first.alias("r")).select(KEY, *[f"r.{c}" for c in out])


def join_demographics(dispatch: DataFrame, census: DataFrame, guard: bool = True) -> DataFrame:
    """Left many-to-one join of a standardised census table; unmatched calls keep NULLs, a repeated key is an error."""
    source = KEY if KEY in dispatch.columns else "geoid"
    keyed = dispatch.withColumn(KEY, normalise_geoid(source))
    dim = many_to_one_guard(census, KEY) if guard else census
    return keyed.join(dim, KEY, "left")


def join_forecasts(trend: DataFrame, boosted: DataFrame, keys: Sequence[str] = ("series_id", "ds")) -> DataFrame:
    """Dates both models cover, with the trend model's interval where it has one."""
    keys = list(keys)
    points = trend.select(*keys, F.col("yhat").alias("trend_yhat")).join(
        boosted.select(*keys, F.col("yhat").alias("boosted_yhat")), keys
    )
    if {"yhat_lower", "yhat_upper"} <= set(trend.columns):
        points = points.join(trend.select(*keys, "yhat_lower", "yhat_upper"), keys, "left")
    return points


def join_stats_back(detail: DataFrame, baseline: DataFrame, key: str, value: str) -> DataFrame:
    stats = baseline.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.avg(value).alias("mean"), F.stddev_samp(value).alias("std")
    )
    return detail.join(stats, key, "left")


def join_anomaly_flags(cells: DataFrame, flags: DataFrame, keys: Sequence[str] = ("year", "quarter")) -> DataFrame:
    return cells.join(flags.select(*keys, "is_anomaly"), list(keys), "left").withColumn(
        "is_anomaly", F.coalesce("is_anomaly", F.lit(False))
    )


def code_to_name(df: DataFrame, names: DataFrame, code: str) -> DataFrame:
    return df.join(names, code, "left")


def top_keys(df: DataFrame, key: str, n: int, measure: Column | None = None) -> DataFrame:
    """The ``n`` largest keys; ties go to the smaller key."""
    total = F.sum(measure) if measure is not None else F.count("*")
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(total.alias("_total"))
        .orderBy(F.desc("_total"), key)
        .limit(n)
        .select(key)
    )


def semi_top_n(df: DataFrame, key: str, n: int, measure: Column | None = None) -> DataFrame:
    """Rows whose key is among the top ``n``; that side has at most ``n`` rows."""
    return df.join(top_keys(df, key, n, measure), key, "left_semi")


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def matched_ids(expected: Column | str, candidates: Column | str) -> Column:
    return F.array_intersect(col(expected), col(candidates))


def distinct_sorted_options(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct non-null values per filter column as (option_kind, option_value).

    Options are a long table, so a column with many values never builds one huge array.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("option_kind"), F.col(c).cast("string").alias("option_value")) for c in columns])
    return (
        df.select(F.explode(pairs).alias("o"))
        .select("o.*")
        .where(F.col("option_value").isNotNull())
        .distinct()
        .orderBy("option_kind", "option_value")
    )
