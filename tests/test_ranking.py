import numpy as np
from pyspark.sql import functions as F

from sirenlake.functions.ranking import hash_rank, interpolate, interpolated_ranks, order_statistics, range_rank, seeded_hash
from sirenlake.operators.features import lag_features


def test_order_statistics_match_numpy_on_long_tails_and_ties(spark):
    rng = np.random.default_rng(0)
    values = np.concatenate([np.exp(rng.normal(0, 6, 3000)), np.full(1500, 2.5), -rng.random(500)])
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double")
    probs = {"a": 0.05, "b": 0.5, "c": 0.95}
    found = order_statistics(df, "x", {k: v for n, p in probs.items() for k, v in interpolated_ranks(n, p).items()})
    assert found["n"] == len(values)
    for name, p in probs.items():
        assert np.isclose(interpolate(found, name, p), np.quantile(values, p), rtol=1e-12)


def test_order_statistics_of_nothing(spark):
    found = order_statistics(spark.createDataFrame([], "x double"), "x", {"k": lambda n: 1})
    assert found == {"n": 0, "k": None}


def skewed(spark, n=3000):
    """One group holds most rows and one instant a third of them."""
    return spark.range(n).select(
        F.col("id"), F.when(F.col("id") % 10 == 0, "b").otherwise("a").alias("g"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") * 31 % 97).alias("t"), (F.col("id") * 17 % 1009).alias("v"),
    )


def test_hash_rank_is_a_permutation_per_group_whatever_the_partitioning(spark):
    df = skewed(spark).withColumn("h", seeded_hash(1, "id"))
    got = {r.id: (r.g, r["rank"], r.group_size) for r in hash_rank(df, ["g"], "h").collect()}
    for g in "ab":
        ranks = sorted(r for gg, r, _ in got.values() if gg == g)
        assert ranks == list(range(1, len(ranks) + 1))
        assert {s for gg, _, s in got.values() if gg == g} == {len(ranks)}
    again = {r.id: (r.g, r["rank"], r.group_size) for r in hash_rank(df.repartition(3, "t"), ["g"], "h").collect()}
    assert again == got


def test_range_rank_splits_hot_groups_and_ties(spark):
    df = skewed(spark)
    got = sorted((r.g, r["rank"], r.t, r.id) for r in range_rank(df, ["g"], ["t", "id"], partitions=7).collect())
    want, seen = [], {"a": 0, "b": 0}
    for g, t, i in sorted((r.g, r.t, r.id) for r in df.collect()):
        seen[g] += 1
        want.append((g, seen[g], t, i))
    assert got == want


def test_lags_cross_block_and_partition_borders(spark):
    df = skewed(spark, 500)
    got = {r.id: (r.v_lag_1, r.v_lag_3) for r in lag_features(df, "v", ["t", "id"], (1, 3), ["g"], block_rows=7).collect()}
    data = sorted((r.g, r.t, r.id, r.v) for r in df.collect())
    for g in "ab":
        mine = [d for d in data if d[0] == g]
        for i, d in enumerate(mine):
            assert got[d[2]] == (mine[i - 1][3] if i >= 1 else None, mine[i - 3][3] if i >= 3 else None)


def test_rows_without_a_group_are_kept(spark):
    df = spark.createDataFrame([(i, None if i % 2 else "a") for i in range(20)], "id int, g string")
    by_hash = hash_rank(df.withColumn("h", seeded_hash(1, "id")), ["g"], "h")
    by_range = range_rank(df, ["g"], ["id"], partitions=3)
    for ranked in (by_hash, by_range):
        for g in ("a", None):
            assert sorted(r["rank"] for r in ranked.collect() if r.g == g) == list(range(1, 11))


def test_order_statistics_with_nan_and_infinity(spark):
    values = [float("nan"), None, float("inf"), float("-inf"), float("-inf"), 1e308, -1e308, 0.0, 2.0, 3.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = order_statistics(df, "v", {str(k): (lambda n, k=k: k) for k in range(1, 9)})
    assert [got["n"], *(got[str(k)] for k in range(1, 9))] == [8, float("-inf"), float("-inf"), -1e308, 0.0, 2.0, 3.0, 1e308, float("inf")]
