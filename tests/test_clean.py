import pytest
from conftest import rows
from pyspark.sql import functions as F

from sirenlake.functions.semantics import round_even, strip, title_case, zero_pad
from sirenlake.operators import clean, quality, schema


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x"))).first()[0]


@pytest.mark.parametrize("text, want", [("o'hara-east", "O'Hara-East"), ("mc keesport", "Mc Keesport"), ("x1y", "X1Y"), ("ÉTÉ d'été", "Été D'Été"), ("", "")])
def test_title_case_capitalises_after_any_non_letter(spark, text, want):
    assert one(spark, text, title_case) == want == text.title()


@pytest.mark.parametrize("text, want", [("42", "000000000042"), ("4200300010011", "4200300010011"), (None, None)])
def test_zero_pad_never_cuts(spark, text, want):
    assert one(spark, text, lambda c: zero_pad(c, 12)) == want


@pytest.mark.parametrize("value, digits, want", [(0.125, 2, 0.12), (0.135, 2, 0.14), (2.5, 0, 2.0), (-0.5, 0, 0.0)])
def test_rounding_is_half_to_even(spark, value, digits, want):
    assert one(spark, value, lambda c: round_even(c, digits), "double") == want


def test_strip_takes_all_white_space(spark):
    assert one(spark, " \t x  \n", strip) == "x"


@pytest.mark.parametrize("text, want", [("1", "Q1"), ("2.0", "Q2"), ("Quarter 3", "Q3"), ("q 4", "Q4"), ("Q1", "Q1"), ("other", "OTHER"), (None, None)])
def test_quarter_label(spark, text, want):
    assert one(spark, text, clean.quarter_label) == want


@pytest.mark.parametrize(
    "text, want",
    [("LIFE THREATENING", "Life Threatening"), ("Hospitals", "ALS"), ("bls call", "BLS"), ("Mark Out", "Non-Emergency"), ("else", "Other"), (None, "Other")],
)
def test_priority_level_uses_substrings_in_order(spark, text, want):
    assert one(spark, text, clean.priority_level) == want
    if text == "Hospitals":
        assert one(spark, text, lambda c: clean.priority_level(c, whole_words=True)) == "Other"


def test_headers_match_in_any_case_and_collisions_coalesce(spark):
    df = spark.createDataFrame([("a", None, "x"), (None, "b", "y")], "` Call_ID_Hash ` string, INCIDENT_ID string, Odd string")
    out = clean.normalise_headers(df)
    assert out.columns == ["call_id_hash", "ODD"]
    assert rows(out) == [("a", "x"), ("b", "y")]


def test_bad_values_become_null_and_missing_columns_appear(spark):
    df = spark.createDataFrame([("2020-05-06 07:08:09", "9000"), ("bad", "abc"), (None, "60")], "call_create_time string, response_time_sec string")
    out = clean.clean_response_time(clean.parse_datetime(df))
    assert rows(out.select("call_year", "call_quarter", "response_time_sec")) == [(2020, 2, None), (None, None, None), (None, None, 60.0)]
    without = clean.parse_datetime(df.drop("call_create_time"))
    assert rows(without.select("call_year").distinct()) == [(None,)]
    us = clean.parse_datetime(spark.createDataFrame([("05/06/2020",)], "call_create_time string"), formats=["MM/dd/yyyy"])
    assert us.first().call_year == 2020


def test_full_cleaning_keeps_canonical_columns(spark):
    raw = "CALL_ID_HASH string, PRIORITY string, DESCRIPTION_SHORT string, GEOID string"
    ems = spark.createDataFrame([("1", " e1 ", "sick", "42"), ("1", " e1 ", "sick", "42"), ("2", "nan", "", None)], raw)
    fire = spark.createDataFrame([("3", "F2", "fire")], "incident_id string, priority string, call_type string")
    out = {r.incident_id: r for r in clean.build_fact({"EMS": ems, "Fire": fire}).collect()}
    assert len(out) == 3
    assert (out["1"].service_type, out["1"].priority_code, out["1"].call_type, out["1"].census_block_group) == ("EMS", "E1", "SICK", "000000000042")
    assert (out["2"].priority_code, out["2"].call_type, out["2"].census_block_group) == (None, None, None)
    assert out["3"].service_type == "Fire"
    assert out["1"].completeness_score == round(5 / 12, 3)


def test_completeness_counts_ten_of_twelve(spark):
    values = {c: "x" for c in schema.QUALITY_COLUMNS} | {"city_name": " ", "latitude": None, "longitude": 1.0, "year": 2020}
    kinds = ", ".join(f"{c} {'double' if c in ('latitude', 'longitude') else 'int' if c == 'year' else 'string'}" for c in values)
    df = spark.createDataFrame([tuple(values.values())], kinds)
    assert quality.data_completeness_pct(df).first().data_completeness_pct == 0.8333
    assert clean.completeness_score(df).first().completeness_score == 0.917


def test_schema_conformance_reads_only_the_schema(spark):
    df = spark.createDataFrame([("a", 1.5, 1)], "incident_id string, year double, extra int")
    report = schema.schema_conformance(df)
    assert report["extra_columns"] == ["extra"] and "city_name" in report["missing_columns"]
    assert [m["column"] for m in report["dtype_mismatches"]] == ["year"]
    with pytest.raises(ValueError):
        schema.require_columns(df, ["city_name"], "test")


def test_quarantine_loses_no_row(spark, sf):
    from sirenlake.plans import fixtures

    dirty = fixtures.dispatch_dirty(spark, sf)
    valid, failing = quality.quarantine_split(dirty)
    assert valid.count() + failing.count() == dirty.count()
    assert failing.where(F.size("violations") == 0).isEmpty()
    assert quality.validation_summary(dirty).first().invalid_count == failing.count()


def test_quarantine_write_observes_its_one_pass(spark, sf, tmp_path):
    from sirenlake.plans import fixtures

    dirty = fixtures.dispatch_dirty(spark, sf)
    seen = quality.quarantine_write(dirty, str(tmp_path / "q"))
    assert seen == quality.validation_summary(dirty).first().asDict()
    back = spark.read.parquet(str(tmp_path / "q")).withColumn("is_valid", F.col("is_valid").cast("boolean"))
    assert {r.is_valid: r["count"] for r in back.groupBy("is_valid").count().collect()} == {True: seen["valid_count"], False: seen["invalid_count"]}
    assert back.where("is_valid = (size(violations) > 0)").isEmpty()
    assert set(back.columns) == {*dirty.columns, "violations", "is_valid"}
    want = quality.quarantine_split(dirty)[1]
    assert back.where("NOT is_valid").select(want.columns).exceptAll(want).isEmpty()
    empty = quality.quarantine_write(dirty.where("false"), str(tmp_path / "none"))
    assert empty == {"valid_count": 0, "invalid_count": 0, "total_count": 0, "mean_completeness": 0.0}


def test_derived_response_times_ignore_summer_time(spark):
    df = spark.createDataFrame(
        [("2020-03-08 01:30:00", "2020-03-08 03:00:00.5"), ("2020-01-01 00:00:00", "2020-01-01 03:00:00"), ("x", "2020-01-01 00:00:00")],
        "unit_dispatch_time string, unit_on_scene_time string",
    )
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert [r.response_time_sec for r in clean.clean_response_time(df).collect()] == [5400.5, None, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
