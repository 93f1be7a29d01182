import pytest
from conftest import rows
from pyspark.sql import functions as F

from sirenlake.operators import aggregates, joins, mapping, quality

LOOKUP = [("Chest Pain", "Chest Pain"), ("BOMB THREAT", "Unknown Problem")]
RULES = [(["TRAFFIC"], "Traffic Accident"), (["INACCESS", "TRENCH"], "Rescue"), (["FIRE"], "Fire")]


@pytest.mark.parametrize(
    "text, want",
    [(" chest pain ", "Chest Pain"), ("traffic fire", "Traffic Accident"), ("FIRE alarm", "Fire"), ("INACCESS", "Unknown Problem"),
     ("trench inaccess", "Rescue"), ("", "Unknown Problem"), (None, "Unknown Problem"), ("bomb threat", "Unknown Problem")],
)
def test_exact_then_ordered_rules_then_default(spark, text, want):
    df = spark.createDataFrame([(text,)], "call_type string")
    lookup = spark.createDataFrame(LOOKUP, "call_key string, call_group string")
    assert mapping.map_call_group(df, lookup, RULES).first().mpds_group == want


def test_coverage_of_nothing_is_zero(spark):
    assert mapping.mapping_coverage(spark.createDataFrame([], "mpds_group string")).first().coverage == 0.0


def test_report_adds_up(spark):
    df = spark.createDataFrame([("a", "A"), ("a", "A"), ("b", "Unknown Problem"), (None, "Unknown Problem")], "call_type string, mpds_group string")
    got = sorted(rows(mapping.mapping_report(df)))
    assert got == [("a", "A", 2, 50.0, True), ("b", "Unknown Problem", 1, 25.0, False)]


def test_unknown_classes_become_other_only_if_the_model_knows_other(spark):
    df = spark.createDataFrame([("x",), ("y",)], "label string")
    with_other = spark.createDataFrame([("x", 0), ("Other", 1)], "label string, label_code int")
    assert sorted(r.label for r in mapping.align_label_space(df, with_other, "label").collect()) == ["Other", "x"]
    without = spark.createDataFrame([("x", 0)], "label string, label_code int")
    assert sorted(r.label for r in mapping.align_label_space(df, without, "label").collect()) == ["x", "y"]


@pytest.mark.parametrize("text, want", [("420030001001.0", "420030001001"), ("BG 7", "000000000007"), (" ", None), ("none", None), (None, None), ("1234567890123", "1234567890123")])
def test_geoid(spark, text, want):
    assert spark.createDataFrame([(text,)], "g string").select(joins.normalise_geoid("g")).first()[0] == want


def census(spark, *more):
    row = ("420030001001", "One", "1000", "800", "120", "600", "250", "80", "70", "50000", "2000000")
    names = ["GEOID", "NAME", *[k for k in joins.CENSUS_VARIABLES], "ALAND"]
    return spark.createDataFrame([row, *more], ", ".join(f"{n} string" for n in names))


def test_census_shares_and_density(spark):
    r = joins.standardise_census(census(spark)).first()
    assert (r.poverty_rate, r.population_density_per_sq_km, r.white_alone_pct, r.black_alone_pct) == (0.15, 500.0, 0.6, 0.25)
    assert (r.asian_alone_pct, r.hispanic_or_latino_pct) == (0.08, 0.07)


def test_join_keeps_unmatched_calls(spark):
    calls = spark.createDataFrame([("a", "420030001001.0"), ("b", "9"), ("c", None)], "call_id_hash string, geoid string")
    got = {r.call_id_hash: r.population for r in joins.join_demographics(calls, joins.standardise_census(census(spark)), guard=True).collect()}
    assert got == {"a": 1000.0, "b": None, "c": None}


def test_guard_fails_on_a_repeated_key(spark):
    dim = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    with pytest.raises(Exception, match="repeats"):
        quality.many_to_one_guard(dim, "k").select("v", "k").collect()


def test_zero_denominators_are_null(spark):
    row = ("420030001002", "Two", "0", "0", "5", "1", "1", "1", "1", "1", "0")
    r = joins.standardise_census(census(spark, row)).where(F.col("census_name") == "Two").first()
    assert r.poverty_rate is None and r.population_density_per_sq_km is None and r.white_alone_pct is None


def test_grouping_ignores_missing_keys(spark):
    df = spark.createDataFrame([("a",), (None,)], "k string")
    assert rows(aggregates.count_by(df, ["k"])) == [("a", 1)]


def test_anomaly_branches(spark):
    wide = [(y, q, 100 + (y == 2003 and q == "Q2") * 50) for y in range(2000, 2004) for q in ("Q1", "Q2", "Q3", "Q4")]
    cells = spark.createDataFrame(wide, "year int, quarter string, call_count bigint")
    assert [(r.year, r.quarter) for r in aggregates.quarter_anomaly(cells).where("is_anomaly").collect()] == [(2003, "Q2")]
    few = spark.createDataFrame([(2000, "Q1", 10), (2000, "Q2", 10), (2000, "Q3", 12)], "year int, quarter string, call_count bigint")
    assert [r.quarter for r in aggregates.quarter_anomaly(few, few).where("is_anomaly").collect()] == ["Q3"]
    flat = spark.createDataFrame([(2000, "Q1", 10), (2000, "Q2", 10)], "year int, quarter string, call_count bigint")
    assert aggregates.quarter_anomaly(flat).where("is_anomaly").isEmpty()


def test_one_year_has_no_slope(spark):
    df = spark.createDataFrame([(2000, "EMS", "a", 5)], "year int, service string, call_type string, call_count bigint")
    assert aggregates.slope_first_last(df).isEmpty()
