"""Queries against their SQL and against the contract's columns; the pipeline's stages."""

import re

import duckdb
import pytest
from conftest import SF

import corpus_pipeline
from sirenlake.llm import mixing
from sirenlake.llm.oracles import LLM_ORACLES
from sirenlake.llm.queries import LLM_QUERIES

COLUMNS = {
    "op1_toxicity": {"doc_id", "held_out", "score", "predicted"},
    "op6_url_reputation": {"page_id", "host", "path", "rule", "verdict"},
    "op7_pii_spans": {"doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"},
    "op8_embedding_dedup": {"vec_id", "n_links", "component_id", "kept"},
    "op9_minhash_dedup": {"doc_id", "n_shingles", "component_id", "kept"},
    "op10_source_mix": {"doc_id", "size", "source_size", "target", "taken"},
    "op11_bpe": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    "op12_max_sketch_search": {"item_id", "rank", "doc_id", "score"},
    "op13_periodic_runs": {"doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"},
}


def test_one_query_per_operator():
    assert [int(re.match(r"op(\d+)_", k)[1]) for k in LLM_QUERIES] == list(range(1, 14))


@pytest.mark.parametrize("key", sorted(COLUMNS))
def test_columns(spark, key):
    assert COLUMNS[key] <= set(LLM_QUERIES[key](spark, SF).columns)


@pytest.mark.parametrize("key", sorted(LLM_ORACLES))
def test_same_as_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = LLM_QUERIES[key](spark, SF).toArrow()
    names = sorted(got.column_names)
    want = con.sql(LLM_ORACLES[key]).to_arrow_table()
    assert sorted(want.column_names) == names
    rows = [sorted((tuple(r.values()) for r in t.select(names).to_pylist()), key=repr) for t in (got, want)]
    assert rows[0] == rows[1]


@pytest.mark.parametrize("key", ["op4_line_dedup", "op6_url_reputation", "op7_pii_spans"])
def test_native_queries_run_no_python(spark, key):
    plan = LLM_QUERIES[key](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoopJoin", plan)


def test_pipeline_from_stage_to_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    given = {r["doc_id"]: r for r in docs.collect()}
    out = corpus_pipeline.run(spark, SF).collect()
    assert out and all(r["round_trip"] for r in out)
    assert all(r["doc_id"] in given and r["source"] == given[r["doc_id"]]["source"] for r in out)
    for r in out:  # lines may go, none is new
        assert set(r["text"].split("\n")) <= set(given[r["doc_id"]]["text"].split("\n"))
    toxic = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 1").collect()}
    assert len(toxic & {r["doc_id"] for r in out}) <= 0.2 * len(toxic)


def test_mixing_shuffles_the_texts_twice_at_most(spark):
    """Once by source and slice, once by training position; joins to tables that are not broadcast add no shuffle."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        mixed = mixing.mixed_documents(mixing.plan_mix(docs), docs.columns)
        plan = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(mixed._jdf.queryExecution(), "formatted")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    carried = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*?)\]\n", plan)
    assert sum("text#" in columns for columns in carried) == 2, carried
