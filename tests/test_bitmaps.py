"""Distinct block groups from bitmaps for every selection of the aggregate."""

import itertools

import pytest
from pyspark.sql import functions as F

from sirenlake.operators import aggregates
from sirenlake.plans import fixtures


@pytest.fixture(scope="module")
def tables(spark, sf, tmp_path_factory):
    fact = fixtures.dispatch(spark, sf).cache()
    path = str(tmp_path_factory.mktemp("bitmaps") / "b")
    aggregates.geo_bitmap_agg(fact, aggregates.block_group_positions(fact)).write.parquet(path)
    return aggregates.prepared(fact).where("year IS NOT NULL AND service IS NOT NULL").cache(), spark.read.parquet(path).cache()


def test_equals_the_fact_for_every_combination_of_filters(tables):
    fact, bitmaps = tables
    years = sorted(r[0] for r in bitmaps.select("year").distinct().collect())
    types = sorted(r[0] for r in bitmaps.groupBy("call_type").count().orderBy(F.desc("count")).limit(3).collect())
    for year, service, kind in itertools.product([None, f"year >= {years[len(years) // 2]}", f"year IN ({years[0]}, {years[-1]})"], [None, "service = 'EMS'"], [None, f"call_type = '{types[0]}'", f"call_type <> '{types[1]}'"]):
        wanted = " AND ".join(c for c in (year, service, kind) if c) or "true"
        truth = fact.where(wanted).agg(F.count("*"), F.count_distinct("census_block_group")).first()
        assert tuple(aggregates.distinct_block_groups(bitmaps.where(wanted)).first()) == tuple(truth), wanted


def test_more_groups_than_a_bucket_and_missing_ones(spark):
    rows = spark.range(100_000).select(
        F.lit(2000).alias("year"), F.lit("Q1").alias("quarter"), F.lit("EMS").alias("service_type"), F.lit(None).cast("string").alias("priority_description"),
        F.concat(F.lit("T"), (F.col("id") % 2).cast("string")).alias("call_type"), F.lit("c").alias("city_name"),
        F.when(F.col("id") % 10 > 0, (F.col("id") % 70_001).cast("string")).alias("census_block_group"),
        F.lit(1.0).alias("latitude"), F.lit(1.0).alias("longitude"), F.lit(1.0).alias("completeness_score"),
    )
    bitmaps = aggregates.geo_bitmap_agg(rows, aggregates.block_group_positions(rows))
    got = {r.call_type: (r.total_calls, r.unique_cbg_count) for r in aggregates.distinct_block_groups(bitmaps, ["call_type"]).collect()}
    truth = {r[0]: (r[1], r[2]) for r in rows.groupBy("call_type").agg(F.count("*"), F.count_distinct("census_block_group")).collect()}
    assert got == truth
    assert bitmaps.where("bucket IS NOT NULL").select("bucket").distinct().count() == 3
    assert tuple(aggregates.distinct_block_groups(bitmaps.where("false")).first()) == (0, 0)
