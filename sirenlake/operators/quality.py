"""Row validation and data-quality profiles."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.semantics import round_even, strip
from .schema import CORE_COLUMNS, QUALITY_COLUMNS

# The row contract.
SERVICES = ("EMS", "Fire")
QUARTERS = ("Q1", "Q2", "Q3", "Q4")
YEARS = (2000, 2030)
NOT_BLANK = ("incident_id", "priority_code", "call_type", "city_code", "city_name")


def _rules(years: tuple[int, int]) -> list[tuple[str, Column]]:
    """(reason, broken?) pairs; a range rule never fires on a missing value."""
    rules = [(f"{c}:missing", F.col(c).isNull()) for c in CORE_COLUMNS]
    rules += [(f"{c}:blank", strip(c) == "") for c in NOT_BLANK]
    rules += [
        ("service_type:unknown", ~F.col("service_type").isin(*SERVICES)),
        ("quarter:unknown", ~F.col("quarter").isin(*QUARTERS)),
        ("year:out_of_range", ~F.col("year").between(*years)),
        ("longitude:out_of_range", ~F.col("longitude").between(-180, 180)),
        ("latitude:out_of_range", ~F.col("latitude").between(-90, 90)),
    ]
    return rules


def validate_rules(df: DataFrame, years: tuple[int, int] = YEARS) -> DataFrame:
    """Add ``violations``: the reasons why a row breaks the contract (empty for a valid row)."""
    marks = F.array(*[F.when(broken, F.lit(reason)) for reason, broken in _rules(years)])
    return df.withColumn("violations", F.filter(marks, lambda r: r.isNotNull()))


def data_completeness_pct(df: DataFrame, columns: Sequence[str] = QUALITY_COLUMNS) -> DataFrame:
    """Share of the available columns that hold a value which is not blank (4 digits)."""
    types = dict(df.dtypes)
    filled = [
        F.coalesce((strip(c) != "") if types[c] == "string" else F.col(c).isNotNull(), F.lit(False)).cast("int")
        for c in columns
        if c in types
    ]
    share = reduce(lambda a, b: a + b, filled) / F.lit(float(len(filled))) if filled else F.lit(0.0)
    return df.withColumn("data_completeness_pct", round_even(share, 4))


def _summary_measures() -> list[Column]:
    bad = F.size("violations") > 0
    return [
        F.count_if(~bad).alias("valid_count"),
        F.count_if(bad).alias("invalid_count"),
        F.count("*").alias("total_count"),
        round_even(F.coalesce(F.avg("data_completeness_pct"), F.lit(0.0)), 4).alias("mean_completeness"),
    ]


def validation_summary(df: DataFrame, years: tuple[int, int] = YEARS) -> DataFrame:
    """Valid, invalid and total rows and the mean completeness, in one pass."""
    return data_completeness_pct(validate_rules(df, years)).agg(*_summary_measures())


def validation_errors(df: DataFrame, key: str = "incident_id", limit: int = 100, years: tuple[int, int] = YEARS) -> DataFrame:
    """The first failing rows by key, with their reasons."""
    failing = validate_rules(df, years).where(F.size("violations") > 0)
    return failing.select(key, "violations").orderBy(F.col(key).asc_nulls_last(), F.col("violations").cast("string")).limit(limit)


def quarantine_split(df: DataFrame, years: tuple[int, int] = YEARS) -> tuple[DataFrame, DataFrame]:
    """(valid rows, failing rows with reasons): nothing is lost or capped."""
    checked = validate_rules(df, years)
    return (
        checked.where(F.size("violations") == 0).drop("violations"),
        checked.where(F.size("violations") > 0),
    )


def quarantine_write(df: DataFrame, path: str, years: tuple[int, int] = YEARS) -> dict[str, int | float]:
    """Write valid and failing rows below ``path`` and return the measures of ``validation_summary``.

    The rows are read and checked once: the measures are observed while one job writes both parts, the folders
    ``is_valid=true`` and ``is_valid=false`` (Spark reads that column back as text). Failing rows keep their reasons in ``violations``, which is
    empty for valid ones; ``is_valid`` and ``violations`` of the input are replaced. An empty table writes no
    rows and gives zeros.
    """
    seen = Observation()
    checked = data_completeness_pct(validate_rules(df, years)).observe(seen, *_summary_measures())
    parts = checked.withColumn("is_valid", F.size("violations") == 0)
    if "data_completeness_pct" not in df.columns:
        parts = parts.drop("data_completeness_pct")
    parts.write.mode("errorifexists").partitionBy("is_valid").parquet(path)
    return seen.get


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing values per column, counted in one pass and unpivoted afterwards."""
    columns = list(columns or df.columns)
    counted = df.agg(
        F.count("*").alias("_rows"), *[(F.count("*") - F.count(F.col(c))).alias(c) for c in columns]
    )
    long = counted.unpivot(["_rows"], columns, "column_name", "null_count")
    pct = round_even(F.try_divide(F.col("null_count") * 100.0, F.col("_rows")), 2)
    return long.select("column_name", "null_count", pct.alias("null_pct")).orderBy(
        F.desc("null_pct"), "column_name"
    )


def many_to_one_guard(dim: DataFrame, key: str) -> DataFrame:
    """The dimension, or an error at run time when its key repeats.

    The check sits in the key column itself, so no optimiser rule can prune it away.
    """
    rest = [c for c in dim.columns if c != key]
    once = dim.groupBy(key).agg(
        F.count("*").alias("_n"), F.any_value(F.struct(*rest) if rest else F.lit(None)).alias("_r")
    )
    message = F.concat(F.lit(f"key {key} repeats: "), F.coalesce(F.col(key).cast("string"), F.lit("NULL")))
    safe = F.when(F.col("_n") > 1, F.raise_error(message).cast(dim.schema[key].dataType)).otherwise(F.col(key))
    return once.select(safe.alias(key), *[F.col(f"_r.{c}").alias(c) for c in rest])
