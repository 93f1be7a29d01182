"""Pre-aggregates and the small report tables derived from them.

Every report groups with map-side partial aggregation, so a key that owns a third of the rows
reaches the shuffle as one partial row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranking import interpolate, interpolated_ranks, order_statistics, range_rank
from ..functions.semantics import count_where, drop_null_keys, ratio, round_even, strip
from .clean import PRIORITY_LEVELS, blank_to_unknown, priority_level, quarter_label, with_flags
from .joins import join_stats_back, semi_top_n

QUARTERS = ["Q1", "Q2", "Q3", "Q4"]
EQUITY_BANDS = ((90.0, "success"), (70.0, "warning"))


def _band(value: Column, bands, lowest: str) -> Column:
    return F.coalesce(*[F.when(value >= limit, F.lit(name)) for limit, name in bands], F.lit(lowest))



# Pre-aggregates over the fact table


def prepared(fact: DataFrame) -> DataFrame:
    """Report naming: service, tidy quarter, call type without gaps, priority level and flags."""
    return with_flags(fact).select(
        F.col("year"),
        quarter_label("quarter").alias("quarter"),
        strip("service_type").alias("service"),
        priority_level("priority_description").alias("priority_level"),
        blank_to_unknown("call_type").alias("call_type"),
        strip("city_name").alias("city_name"),
        "census_block_group",
        "latitude",
        "longitude",
        "completeness_score",
        "with_coords",
        "high_completeness",
    )


def overview_agg(fact: DataFrame) -> DataFrame:
    keys = ["year", "quarter", "service", "priority_level", "call_type"]
    return (
        drop_null_keys(prepared(fact), *keys)
        .groupBy(*keys)
        .agg(
            F.count("*").alias("call_count"),
            count_where(F.col("with_coords")).alias("with_coords_count"),
            count_where(F.col("high_completeness")).alias("high_completeness_count"),
        )
    )


def count_by(df: DataFrame, keys: Sequence[str], name: str = "call_count", measure: str | None = None) -> DataFrame:
    value = F.sum(measure) if measure else F.count("*")
    return drop_null_keys(df, *keys).groupBy(*keys).agg(value.alias(name))


def temporal_heatmap_agg(fact: DataFrame) -> DataFrame:
    return count_by(prepared(fact), ["year", "quarter", "service"])


def temporal_slope_agg(fact: DataFrame) -> DataFrame:
    return count_by(prepared(fact).where(F.col("quarter").isNotNull()), ["year", "service", "call_type"])


def geo_density_agg(fact: DataFrame) -> DataFrame:
    keys = ["year", "service", "call_type", "census_block_group"]
    return (
        drop_null_keys(prepared(fact), *keys, "latitude", "longitude")
        .groupBy(*keys)
        .agg(
            F.count("*").alias("call_count"),
            F.avg("latitude").alias("latitude"),
            F.avg("longitude").alias("longitude"),
        )
    )


def geo_city_agg(fact: DataFrame) -> DataFrame:
    """Sum and count of completeness, so that means can be formed again at any level."""
    keys = ["year", "service", "city_name"]
    return (
        drop_null_keys(prepared(fact), *keys)
        .groupBy(*keys)
        .agg(
            F.count("*").alias("call_count"),
            F.sum("completeness_score").alias("completeness_sum"),
            F.count("completeness_score").alias("completeness_count"),
        )
    )


def geo_call_type_cbg_agg(fact: DataFrame, exact: bool = True) -> DataFrame:
    keys = ["year", "service", "call_type"]
    distinct = F.count_distinct if exact else F.approx_count_distinct
    return (
        drop_null_keys(prepared(fact), *keys)
        .groupBy(*keys)
        .agg(F.count("*").alias("total_calls"), distinct(F.col("census_block_group")).alias("unique_cbg_count"))
    )


# Distinct counts that can be formed again at any level: block groups as bits


def block_group_positions(fact: DataFrame) -> DataFrame:
    """A dense number from 1 on for every block group, in alphabetical order."""
    known = fact.select("census_block_group").where(F.col("census_block_group").isNotNull()).distinct()
    return range_rank(known, [], ["census_block_group"], "position")


def geo_bitmap_agg(fact: DataFrame, positions: DataFrame) -> DataFrame:
    """Per (year, service, call type) and bucket of positions: calls, and the block groups as a bitmap.

    Calls without a block group, or with one that ``positions`` does not know, have a NULL bucket and no bits.
    """
    keys = ["year", "service", "call_type"]
    placed = drop_null_keys(prepared(fact), *keys).join(positions, "census_block_group", "left")
    bucket, bit = F.bitmap_bucket_number("position"), F.bitmap_bit_position("position")
    return placed.groupBy(*keys, bucket.alias("bucket")).agg(F.count("*").alias("calls"), F.bitmap_construct_agg(bit).alias("block_groups"))


def distinct_block_groups(bitmaps: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Calls and exact distinct block groups per ``keys`` of any selection of rows of ``geo_bitmap_agg``."""
    merged = bitmaps.groupBy(*keys, "bucket").agg(F.sum("calls").alias("calls"), F.bitmap_or_agg("block_groups").alias("block_groups"))
    bits = F.when(F.col("bucket").isNotNull(), F.bitmap_count("block_groups")).otherwise(0)
    return merged.groupBy(*keys).agg(F.coalesce(F.sum("calls"), F.lit(0)).alias("total_calls"), F.coalesce(F.sum(bits), F.lit(0)).alias("unique_cbg_count"))


# Overview reports (input: overview_agg)


def kpi_totals(agg: DataFrame) -> DataFrame:
    per_quarter = agg.groupBy("year", "quarter").agg(
        F.sum("call_count").alias("n"),
        F.sum(F.when(F.col("service") == "EMS", F.col("call_count"))).alias("ems"),
        F.sum(F.when(F.col("service") == "Fire", F.col("call_count"))).alias("fire"),
    )
    total = F.coalesce(F.sum("n"), F.lit(0))
    return per_quarter.agg(
        total.alias("total_calls"),
        F.coalesce(F.sum("ems"), F.lit(0)).alias("ems_calls"),
        F.coalesce(F.sum("fire"), F.lit(0)).alias("fire_calls"),
        F.count("*").alias("quarters"),
        ratio(total, F.greatest(F.count("*"), F.lit(1))).alias("avg_per_quarter"),
    )


def top_categories(agg: DataFrame, key: str = "call_type", n: int = 8, measure: str = "call_count") -> DataFrame:
    return (
        agg.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.sum(measure).alias("call_count"))
        .orderBy(F.desc("call_count"), key)
        .limit(n)
    )


def triage_flow(agg: DataFrame, n: int = 8) -> DataFrame:
    """Links service -> level and level -> call type over the busiest call types, in one scan."""
    kept = semi_top_n(agg, "call_type", n, F.col("call_count"))
    links = F.array(
        F.struct(F.lit("service_to_level").alias("link"), F.col("service").alias("from_node"), F.col("priority_level").alias("to_node")),
        F.struct(F.lit("level_to_call_type").alias("link"), F.col("priority_level").alias("from_node"), F.col("call_type").alias("to_node")),
    )
    return (
        kept.select("call_count", F.explode(links).alias("l"))
        .groupBy("l.link", "l.from_node", "l.to_node")
        .agg(F.sum("call_count").alias("call_count"))
    )


def priority_funnel(agg: DataFrame) -> DataFrame:
    position = F.array_position(F.array(*[F.lit(x) for x in PRIORITY_LEVELS]), F.col("priority_level"))
    return (
        agg.where(F.col("priority_level").isin(PRIORITY_LEVELS))
        .groupBy("priority_level")
        .agg(F.sum("call_count").alias("call_count"))
        .withColumn("level_order", position.cast("int"))
        .orderBy("level_order")
    )


def quality_pipeline(agg: DataFrame) -> DataFrame:
    totals = agg.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("call_count", "with_coords_count", "high_completeness_count")]
    )
    stages = [("Total Calls", "call_count"), ("With Coordinates", "with_coords_count"), ("High Completeness", "high_completeness_count")]
    rows = F.array(
        *[F.struct(F.lit(i + 1).alias("stage_order"), F.lit(s).alias("stage"), F.col(c).alias("records")) for i, (s, c) in enumerate(stages)]
    )
    return totals.select(F.inline(rows))


# Temporal reports


def quarter_year_matrix(df: DataFrame, measure: str | None = None) -> DataFrame:
    value = F.sum(measure) if measure else F.count(F.lit(1))
    return drop_null_keys(df, "year", "quarter").groupBy("year").pivot("quarter", QUARTERS).agg(value)


def slope_first_last(slope: DataFrame, n: int = 6) -> DataFrame:
    """The busiest types of the first and last year together, with both years' counts.

    Empty when there is only one year.
    """
    ends = slope.agg(F.min("year").alias("a"), F.max("year").alias("b"))
    first, last = ends.select("a").scalar(), ends.select("b").scalar()
    at = lambda y: F.coalesce(F.sum(F.when(F.col("year") == y, F.col("call_count"))), F.lit(0))
    both = (
        slope.where((F.col("year") == first) | (F.col("year") == last))
        .where(first < last)
        .groupBy("call_type")
        .agg(at(first).alias("first_count"), at(last).alias("last_count"))
    )
    return (
        both.orderBy(F.desc(F.col("first_count") + F.col("last_count")), "call_type")
        .limit(n)
        .withColumns({"first_year": first, "last_year": last})
        .orderBy("last_count", "call_type")
    )


def quarter_anomaly(cells: DataFrame, baseline: DataFrame | None = None, value: str = "call_count", z: float = 1.2, share: float = 1.1) -> DataFrame:
    """Flag (year, quarter) cells that are high for their quarter.

    With enough history (every quarter has three cells) by z-score against the baseline, or
    against the cells themselves when the baseline has fewer than twelve. Otherwise the largest
    cell is flagged if it is well above the median. Cells are calendar quarters, so this is small.
    """
    ref = cells
    if baseline is not None:
        enough = baseline.agg(F.count("*")).scalar() >= 12
        ref = baseline.where(enough).unionByName(cells.where(~enough))
    per_quarter = drop_null_keys(ref, "quarter").groupBy("quarter").agg(F.count("*").alias("n"))
    history = F.coalesce(per_quarter.agg(F.min("n")).scalar() >= 3, F.lit(True))
    overall = cells.agg(
        F.stddev_samp(value).alias("std"), F.median(value).alias("med"), F.max(value).alias("top")
    )
    spread = F.coalesce(F.nullif(overall.select("std").scalar(), F.lit(0.0)), F.lit(1.0))
    median, top = overall.select("med").scalar(), overall.select("top").scalar()
    joined = join_stats_back(cells, ref, "quarter", value)
    std = F.coalesce(F.nullif(F.col("std"), F.lit(0.0)), spread)
    by_z = F.coalesce((F.col(value) - F.col("mean")) / std, F.lit(0.0)) > z
    by_top = (median > 0) & (top >= share * median) & (F.col(value) == top)
    return joined.withColumn("is_anomaly", F.when(history, by_z).otherwise(by_top)).drop("mean", "std")


def quarterly_trend(df: DataFrame, keys: Sequence[str] = (), name: str = "call_count") -> DataFrame:
    """Counts per sortable period; ``period_sort`` is year * 10 + quarter number."""
    dated = drop_null_keys(df, "year", "quarter").withColumns(
        {
            "period": F.concat_ws("-", F.col("year").cast("string"), "quarter"),
            "period_sort": (F.col("year") * 10 + F.substring("quarter", 2, 1).cast("int")).cast("int"),
        }
    )
    return dated.groupBy("period", "period_sort", *keys).agg(F.count("*").alias(name)).orderBy("period_sort", *keys)


def priority_over_time(df: DataFrame, n: int = 5) -> DataFrame:
    return quarterly_trend(semi_top_n(df, "priority_code", n), ["priority_code"])


def period_extremes(trend: DataFrame) -> DataFrame:
    """Mean, largest and smallest period volume with their periods (the earlier one on a tie)."""
    up = F.struct(F.col("call_count"), -F.col("period_sort"))
    down = F.struct(F.col("call_count"), F.col("period_sort"))
    return trend.agg(
        F.count("*").alias("periods"),
        round_even(F.avg("call_count"), 6).alias("mean_count"),
        F.max("call_count").alias("max_count"),
        F.max_by("period", up).alias("max_period"),
        F.min("call_count").alias("min_count"),
        F.min_by("period", down).alias("min_period"),
    )


# Geographic reports


def cbg_centroids(density: DataFrame) -> DataFrame:
    """Per block group: all calls and the plain mean of the group means."""
    return (
        density.where(F.col("census_block_group").isNotNull())
        .groupBy("census_block_group")
        .agg(
            F.sum("call_count").alias("call_count"),
            F.avg("latitude").alias("latitude"),
            F.avg("longitude").alias("longitude"),
        )
    )


def city_completeness(city: DataFrame, keys: Sequence[str] = ("city_name",)) -> DataFrame:
    return (
        drop_null_keys(city, *keys)
        .groupBy(*keys)
        .agg(
            F.sum("call_count").alias("call_count"),
            (F.sum("completeness_sum") / F.nullif(F.sum("completeness_count"), F.lit(0))).alias("mean"),
        )
        .where(F.col("mean").isNotNull())
    )


def geo_kpis(density: DataFrame, city: DataFrame, cluster_count: Column | None = None) -> DataFrame:
    """Block groups, located calls, hotspot clusters and equity of completeness between cities."""
    per_city = city_completeness(city)
    spread = per_city.agg(F.avg("mean").alias("m"), F.stddev_samp("mean").alias("s"), F.count("*").alias("n"))
    equity = spread.select(
        F.when(
            (F.col("n") > 1) & (F.col("m") > 0),
            F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - F.col("s") / F.col("m"))),
        )
    ).scalar()
    out = cbg_centroids(density).agg(
        F.count("*").alias("block_groups"), F.coalesce(F.sum("call_count"), F.lit(0)).alias("located_calls")
    )
    if cluster_count is not None:
        out = out.withColumn("hotspot_clusters", cluster_count)
    return out.withColumn("equity", round_even(equity, 6))


def city_service_top(city: DataFrame, n: int = 12) -> DataFrame:
    kept = semi_top_n(city, "city_name", n, F.col("call_count"))
    return count_by(kept, ["city_name", "service"], measure="call_count")


def equity_scatter(city: DataFrame) -> DataFrame:
    per = city_completeness(city, ["city_name", "service"])
    return per.select("city_name", "service", "call_count", round_even(F.col("mean") * 100, 2).alias("completeness_pct"))


def equity_rank(city: DataFrame, n: int = 15) -> DataFrame:
    """The best cities by completeness, with a colour band."""
    scored = city_completeness(city).select("city_name", round_even(F.col("mean") * 100, 2).alias("score_pct"))
    best = scored.orderBy(F.desc("score_pct"), "city_name").limit(n)
    return best.withColumn("band", _band(F.col("score_pct"), EQUITY_BANDS, "danger"))


def call_type_spread(types: DataFrame, n: int = 12) -> DataFrame:
    """Distinct block groups do not add up, so the widest slice is reported."""
    per = types.groupBy("call_type").agg(
        F.sum("total_calls").alias("total_calls"), F.max("unique_cbg_count").alias("cbg_spread")
    )
    return per.orderBy(F.desc("total_calls"), "call_type").limit(n).orderBy("cbg_spread", "call_type")


def bubble_scale(centroids: DataFrame) -> DataFrame:
    top = F.coalesce(F.nullif(centroids.agg(F.max("call_count")).scalar(), F.lit(0)), F.lit(1))
    return centroids.withColumn("bubble_size", 4 + 28 * (F.col("call_count") / top))


def grid_density(df: DataFrame, measure: str, bins: int = 20) -> DataFrame:
    """Sum of a measure and mean position per cell of an equal-width grid (non-empty cells only).

    Cells are closed on the right; the lowest value belongs to the first cell.
    """
    located = df.na.drop(subset=["latitude", "longitude"])
    span = located.agg(*[f(c).alias(f"{n}_{c}") for c in ("latitude", "longitude") for n, f in (("lo", F.min), ("hi", F.max))])

    def cell(c: str) -> Column:
        lo, hi = span.select(f"lo_{c}").scalar(), span.select(f"hi_{c}").scalar()
        at = F.ceil(F.try_divide(F.col(c) - lo, hi - lo) * bins)
        return F.greatest(F.lit(1), F.coalesce(at, F.lit(1))).cast("int")

    return (
        located.withColumns({"lat_bin": cell("latitude"), "lon_bin": cell("longitude")})
        .groupBy("lat_bin", "lon_bin")
        .agg(
            F.sum(measure).alias("total"),
            F.avg("latitude").alias("latitude"),
            F.avg("longitude").alias("longitude"),
        )
    )


def cluster_summary(points: DataFrame, default_centre: tuple[float, float] = (40.4406, -79.9959)) -> DataFrame:
    """Points and mean centre per cluster, plus the overall centre (a default when empty)."""
    overall = points.agg(
        F.coalesce(F.avg("latitude"), F.lit(default_centre[0])).alias("lat"),
        F.coalesce(F.avg("longitude"), F.lit(default_centre[1])).alias("lon"),
    )
    return (
        points.where(F.col("cluster") >= 0)
        .groupBy("cluster")
        .agg(F.count("*").alias("points"), F.avg("latitude").alias("centre_lat"), F.avg("longitude").alias("centre_lon"))
        .withColumns({"map_lat": overall.select("lat").scalar(), "map_lon": overall.select("lon").scalar()})
    )


# Profiles


def value_counts_top(df: DataFrame, column: str, n: int) -> DataFrame:
    return count_by(df, [column]).orderBy(F.desc("call_count"), column).limit(n)


def describe_column(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, std, min, quartiles and max; the quartiles are exact and distributed."""
    quartiles = {"q25": 0.25, "median": 0.5, "q75": 0.75}
    ranks = {k: v for name, p in quartiles.items() for k, v in interpolated_ranks(name, p).items()}
    found = order_statistics(df, column, ranks)
    exact = [round_even(F.lit(interpolate(found, name, p)).cast("double"), 6).alias(name) for name, p in quartiles.items()]
    return df.agg(
        F.count(column).alias("count"),
        round_even(F.avg(column), 6).alias("mean"),
        round_even(F.stddev_samp(column), 6).alias("std"),
        F.min(column).alias("min"),
        *exact,
        F.max(column).alias("max"),
    )


def histogram(df: DataFrame, column: str, bins: int, low: float = 0.0, high: float = 1.0, keys: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins over a fixed range; the top edge belongs to the last bin."""
    width = (high - low) / bins
    at = F.floor((F.col(column) - low) / width)
    placed = df.where(F.col(column).between(low, high)).withColumn("bin", F.least(at, F.lit(bins - 1)).cast("int"))
    return placed.groupBy(*keys, "bin").agg(F.count("*").alias("n"))


def geo_coverage(df: DataFrame) -> DataFrame:
    key = F.col("census_block_group")
    return df.agg(
        F.count("*").alias("total_rows"),
        F.count(key).alias("with_key"),
        count_where(key.isNull()).alias("without_key"),
        F.count_distinct(key).alias("distinct_keys"),
        F.min("latitude").alias("min_lat"),
        F.max("latitude").alias("max_lat"),
        F.min("longitude").alias("min_lon"),
        F.max("longitude").alias("max_lon"),
    )


def missing_geo_by_city(df: DataFrame, n: int = 15) -> DataFrame:
    missing = count_where(F.col("census_block_group").isNull())
    per_city = (
        df.where(F.col("city_name").isNotNull())
        .groupBy("city_name")
        .agg(
            F.count("*").alias("total"),
            missing.alias("missing_key"),
            (missing / F.count("*") * 100.0).alias("missing_pct"),
            count_where(F.col("longitude").isNull()).alias("missing_lon"),
            count_where(F.col("latitude").isNull()).alias("missing_lat"),
        )
    )
    return per_city.orderBy(F.desc("missing_key"), "city_name").limit(n)


def blockgroup_profile(df: DataFrame, n: int = 10, order: str = "incident_id") -> DataFrame:
    """Busiest block groups: calls, the first position by ``order`` and the most common city.

    Two-level counts give the mode (count, then name), so no group is ever collected.
    """
    key = "census_block_group"
    located = df.na.drop(subset=[key, "latitude", "longitude"])
    per_city = located.groupBy(key, "city_name").agg(
        F.count("*").alias("n"), F.min(F.struct(order, "latitude", "longitude")).alias("first")
    )
    named = F.when(F.col("city_name").isNotNull(), F.struct((-F.col("n")).alias("k"), F.col("city_name").alias("city")))
    return (
        per_city.groupBy(key)
        .agg(
            F.sum("n").alias("call_count"),
            F.min("first").alias("f"),
            F.coalesce(F.min(named)["city"], F.lit("Unknown")).alias("top_city"),
        )
        .orderBy(F.desc("call_count"), key)
        .limit(n)
        .select(key, "call_count", F.col("f.latitude").alias("lat"), F.col("f.longitude").alias("lon"), "top_city")
    )


def distinct_summary(df: DataFrame) -> DataFrame:
    """Distinct values per column and the year range in one scan."""
    counts = {
        "call_types": "call_type", "cities": "city_name", "city_codes": "city_code", "block_groups": "census_block_group",
    }
    return df.agg(
        F.count("*").alias("total_rows"), F.min("year").alias("min_year"), F.max("year").alias("max_year"),
        *[F.count_distinct(c).alias(name) for name, c in counts.items()],
    )


def city_service_breakdown(df: DataFrame, n: int = 10) -> DataFrame:
    return count_by(semi_top_n(df, "city_name", n), ["city_name", "service_type"])
