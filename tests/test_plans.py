"""Plan shapes that matter at scale."""

import re

import pytest
from conftest import SF

from sirenlake.operators import aggregates, clean, splits
from sirenlake.plans import fixtures, queries
from sirenlake.plans.oracles import ORACLES
from sirenlake.plans.queries import QUERIES

EAGER = {
    "model_io", "train_classifier", "boosted_classifier", "tune_classifier", "halve_classifier", "quarantine_write", "predict_confidence", "feature_importance", "score_saved_model", "feature_prep",
    "recursive_forecast", "gbt_lag_forecast", "read_documents", "isolation_forest_score", "geo_kpis", "cluster_summary", "assign_clusters",
}
PYTHON = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")
CHUNKER = {"silhouette_exact"}


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(set(QUERIES) - EAGER))
def test_no_cross_joins_and_no_python_in_sql_operators(spark, key):
    plan = physical(QUERIES[key](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if key in ORACLES and key not in CHUNKER:
        assert not any(node in plan for node in PYTHON)


@pytest.mark.parametrize("key", ["keyword_rank", "vector_topk", "vector_topk_lsh", "source_summary", "extractive_answer"])
def test_top_k_is_cut_before_the_shuffle(spark, key):
    assert "WindowGroupLimit" in physical(QUERIES[key](spark, SF))


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    fixtures.dispatch(spark, SF).write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    plan = physical(aggregates.temporal_heatmap_agg(clean.filter_by(fact, years=[1996], services=["EMS"])))
    assert re.search(r"PushedFilters: \[.*(In\(year|EqualTo\(year).*service_type", plan)
    read = re.search(r"ReadSchema: struct<(.*?)>", plan).group(1)
    assert {c.split(":")[0] for c in read.split(",")} == {"service_type", "year", "quarter"}


def test_overview_needs_one_shuffle_from_a_table(spark, tmp_path):
    fixtures.dispatch(spark, SF).write.parquet(str(tmp_path / "fact"))
    plan = physical(aggregates.overview_agg(spark.read.parquet(str(tmp_path / "fact"))))
    assert plan.count("Exchange") == 1


def test_labels_and_slices_meet_their_tables_without_a_shuffle(spark):
    """A shuffle by call type or label gathers a frequent one in one task; the only shuffle is by label and slice."""
    coded = splits.classifier_frame(queries._mapped(spark, SF).drop("call_type"), ["incident_id"], "mpds_group")
    assert "Exchange hashpartitioning" not in physical(coded) and "SortMergeJoin" not in physical(coded)
    plan = physical(splits.stratified_split(coded, ["incident_id"], "label_code"))
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan
    assert "SortMergeJoin" not in physical(queries._mapped(spark, SF))


def test_keyword_hits_and_scores_are_summed_without_a_shuffle_of_their_own(spark):
    plan = physical(QUERIES["keyword_rank"](spark, SF))
    by = [re.findall(r"([a-z_]+)#", keys) for keys in re.findall(r"Exchange hashpartitioning\((.*?)\)", plan)]
    assert ["doc_id"] in by and not any(len(keys) > 1 for keys in by), by
