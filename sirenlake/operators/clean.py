"""Cleaning, projection and predicates on call records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.semantics import (
    col,
    missing_to_null,
    round_even,
    strip,
    title_case,
    to_number,
    zero_pad,
)
from .schema import CANONICAL_NAMES, COLUMN_ALIASES, HEADER_ALIASES, QUALITY_COLUMNS, RAW_COLUMNS, STORAGE_TYPES

MAX_RESPONSE_SEC = 7200
HIGH_COMPLETENESS = 0.75


def normalise_headers(df: DataFrame) -> DataFrame:
    """Map header spellings to raw names, ignoring case and blanks; colliding spellings coalesce."""
    known = {c.upper(): c for c in RAW_COLUMNS} | HEADER_ALIASES
    targets: dict[str, list[str]] = {}
    for name in df.columns:
        key = name.strip().upper()
        targets.setdefault(known.get(key, key), []).append(name)
    return df.select(
        *[F.coalesce(*[F.col(f"`{c}`") for c in cols]).alias(out) for out, cols in targets.items()]
    )


def rename_canonical(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(CANONICAL_NAMES)


def inject_service(df: DataFrame, label: str) -> DataFrame:
    given = F.col("service") if "service" in df.columns else F.lit(None).cast("string")
    return df.withColumn("service", F.coalesce(given, F.lit(label)))


def parse_datetime(df: DataFrame, source: str = "call_create_time", formats: Sequence[str] = ()) -> DataFrame:
    """Lenient timestamp plus its year and quarter; bad text gives NULL, an absent column too."""
    if source not in df.columns:
        return df.withColumns(
            {"call_year": F.lit(None).cast("smallint"), "call_quarter": F.lit(None).cast("tinyint")}
        )
    text = strip(F.col(source).cast("string"))
    tries = [text.try_cast("timestamp_ntz")]
    tries += [F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in formats]
    return df.withColumn(source, F.coalesce(*tries)).withColumns(
        {
            "call_year": F.year(source).cast("smallint"),
            "call_quarter": F.quarter(source).cast("tinyint"),
        }
    )


def _cleaned(df: DataFrame, name: str, shape) -> Column:
    if name not in df.columns:
        return F.lit(None).cast("string")
    return missing_to_null(shape(strip(name)))


def clean_priority(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "priority": _cleaned(df, "priority", F.upper),
            "priority_desc": _cleaned(df, "priority_desc", title_case),
        }
    )


def clean_description(df: DataFrame) -> DataFrame:
    return df.withColumn("description_short", _cleaned(df, "description_short", F.upper))


def clean_geography(df: DataFrame) -> DataFrame:
    """City text, 12-digit block-group key and numeric position.

    A missing city or key stays NULL instead of turning into the text "Nan" / "000000000nan".
    """
    shaped = {
        "city_name": lambda c: title_case(strip(c)),
        "city_code": lambda c: F.upper(strip(c)),
        "geoid": lambda c: zero_pad(strip(c), 12),
    }
    changes = {c: f(c) for c, f in shaped.items() if c in df.columns}
    for c in ("census_block_group_center__x", "census_block_group_center__y"):
        changes[c] = to_number(c) if c in df.columns else F.lit(None).cast("double")
    return df.withColumns(changes)


def clean_response_time(df: DataFrame) -> DataFrame:
    """Seconds as given, or on-scene minus dispatch time; values outside 0..7200 become NULL."""
    if "response_time_sec" in df.columns:
        seconds = to_number("response_time_sec")
    elif {"unit_dispatch_time", "unit_on_scene_time"} <= set(df.columns):
        start, end = (
            strip(F.col(c).cast("string")).try_cast("timestamp_ntz")
            for c in ("unit_dispatch_time", "unit_on_scene_time")
        )
        # Wall-clock times without a zone: a change to summer time must not add an hour.
        seconds = (end - start).cast("interval second").cast("decimal(18,6)").cast("double")
    else:
        seconds = F.lit(None).cast("double")
    return df.withColumn("response_time_sec", seconds).withColumn(
        "response_time_sec",
        F.when(F.col("response_time_sec").between(0, MAX_RESPONSE_SEC), F.col("response_time_sec")),
    )


def ensure_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    return df.withColumns({c: F.lit(None).cast(t) for c, t in types.items() if c not in df.columns})


def apply_dtypes(df: DataFrame, types: Mapping[str, str] = STORAGE_TYPES) -> DataFrame:
    """Lenient casts; integers go through a number first so that "3.0" is a 3."""
    small = {"tinyint", "smallint", "int", "bigint"}

    def cast(c: str, t: str) -> Column:
        if t == "string":
            return F.col(c).cast("string")
        number = to_number(c)
        return number.try_cast(t) if t in small or t == "float" else number

    return df.withColumns({c: cast(c, t) for c, t in types.items() if c in df.columns})


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def duplicate_report(df: DataFrame) -> DataFrame:
    """Rows before, after and removed, from one shuffle."""
    return (
        df.groupBy(*df.columns)
        .agg(F.count("*").alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows_before"),
            F.count("*").alias("rows_after"),
            F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("rows_removed"),
        )
    )


def completeness(columns: Sequence[str], available: Sequence[str]) -> Column:
    """Share of ``columns`` with a value; an absent column counts as missing."""
    filled = [F.col(c).isNotNull().cast("int") for c in columns if c in available]
    if not filled:
        return F.lit(0.0)
    return round_even(reduce(lambda a, b: a + b, filled) / F.lit(float(len(columns))), 3)


def completeness_score(df: DataFrame, columns: Sequence[str] = QUALITY_COLUMNS) -> DataFrame:
    return df.withColumn("completeness_score", completeness(columns, df.columns))


def quarter_label(c: Column | str) -> Column:
    """1, "1.0", "Quarter 1" and "Q1" all become "Q1"."""
    text = F.regexp_replace(F.upper(col(c).cast("string")), "QUARTER | ", "")
    return F.regexp_replace(text, r"^Q?0*(\d+)(\.\d*)?$", "Q$1")


def canonicalise_aliases(df: DataFrame, aliases: Mapping[str, Sequence[str]] = COLUMN_ALIASES) -> DataFrame:
    """Fill a canonical column's NULLs from its aliases in order, then tidy quarter and year."""
    changes = {}
    for name, others in aliases.items():
        present = [c for c in [name, *others] if c in df.columns]
        if present:
            same = len({df.schema[c].dataType for c in present}) == 1
            changes[name] = F.coalesce(*[F.col(c) if same else F.col(c).cast("string") for c in present])
    out = df.withColumns(changes)
    tidy = {}
    if "quarter" in out.columns:
        tidy["quarter"] = quarter_label("quarter")
    if "year" in out.columns:
        tidy["year"] = to_number("year").try_cast("smallint")
    return out.withColumns(tidy)


def filter_by(df: DataFrame, years=(), services=(), call_types=(), names: Mapping[str, str] | None = None) -> DataFrame:
    """Dashboard filter: an empty list keeps everything; lists become pushed-down IN predicates."""
    names = {"years": "year", "services": "service_type", "call_types": "call_type"} | dict(names or {})
    for key, wanted in (("years", years), ("services", services), ("call_types", call_types)):
        if wanted and names[key] in df.columns:
            df = df.where(F.col(names[key]).isin(list(wanted)))
    return df


def service_filter_ci(df: DataFrame, services=None, years=None, service: str = "service_type", year: str = "year") -> DataFrame:
    """Service names in any case (both services by default); all known years by default."""
    wanted = [s.upper() for s in (services or ["EMS", "Fire"])]
    df = df.where(F.upper(service).isin(wanted))
    return df.where(F.col(year).isin(list(years))) if years else df.where(F.col(year).isNotNull())


# Level -> words looked for anywhere in the lower-cased description, in this order.
PRIORITY_WORDS = (
    ("Life Threatening", ("life threatening",)),
    ("ALS", ("advanced life support", "als")),
    ("BLS", ("basic life support", "bls")),
    ("Non-Emergency", ("assist", "admin", "non emergency", "no immediate threat", "mark out")),
)
PRIORITY_LEVELS = [level for level, _ in PRIORITY_WORDS] + ["Other"]


def priority_level(description: Column | str, whole_words: bool = False) -> Column:
    """Five levels from free text. Substrings count, so "hospitals" is ALS unless whole_words."""
    edge = r"\b" if whole_words else ""
    text = F.lower(col(description))
    rules = [(level, text.rlike(f"{edge}({'|'.join(words)}){edge}")) for level, words in PRIORITY_WORDS]
    return F.coalesce(*[F.when(hit, F.lit(level)) for level, hit in rules], F.lit("Other"))


def with_flags(df: DataFrame, threshold: float = HIGH_COMPLETENESS) -> DataFrame:
    return df.withColumns(
        {
            "with_coords": F.col("longitude").isNotNull(),
            "high_completeness": F.coalesce(F.col("completeness_score"), F.lit(0.0)) >= threshold,
        }
    )


def drop_null_subset(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(columns))


def blank_to_unknown(c: Column | str) -> Column:
    return strip(F.coalesce(col(c), F.lit("Unknown")))


def event_time_resolve(df: DataFrame, name: str = "ds") -> DataFrame:
    """Event date from the best column there is: timestamp, date, year + month, year + quarter.

    The choice is made from the schema, so only the chosen columns are read.
    """
    have = set(df.columns)
    if "call_create_time" in have:
        ds = F.col("call_create_time").cast("string").try_cast("timestamp_ntz")
    elif "date" in have:
        ds = F.col("date").cast("string").try_cast("timestamp_ntz")
    elif {"year", "month"} <= have:
        ds = F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.lit(1)).cast("timestamp_ntz")
    elif {"year", "quarter"} <= have:
        q = F.coalesce(F.regexp_extract(quarter_label("quarter"), "^Q([1-4])$", 1).try_cast("int"), F.lit(1))
        ds = F.make_date(F.col("year").cast("int"), q * 3 - 2, F.lit(1)).cast("timestamp_ntz")
    else:
        raise ValueError("no time columns: need call_create_time, date, year + month or year + quarter")
    return df.withColumn(name, ds).where(F.col(name).isNotNull())


def preprocess(df: DataFrame, label: str) -> DataFrame:
    """One file's full cleaning as a single lazy plan (the duplicate drop is its only shuffle)."""
    out = inject_service(normalise_headers(df), label)
    for step in (parse_datetime, clean_priority, clean_description, clean_geography, clean_response_time):
        out = step(out)
    out = ensure_columns(out, STORAGE_TYPES)
    return apply_dtypes(drop_exact_duplicates(out))


def build_fact(sources: Mapping[str, DataFrame]) -> DataFrame:
    """Stack the cleaned files, rename to canonical names, label quarters and score rows."""
    stacked = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [preprocess(df, label) for label, df in sources.items()],
    )
    out = rename_canonical(stacked)
    return completeness_score(out.withColumn("quarter", quarter_label("quarter")))
