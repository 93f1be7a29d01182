"""The persisted vector index against the exact search."""

import re

import pytest
from pyspark.sql import functions as F

from sirenlake.operators import retrieval, vector_index
from sirenlake.plans import fixtures as X


@pytest.fixture(scope="module")
def vectors(spark, sf):
    return X.table(spark, sf, "embeddings").select("vec_id", "embedding").cache()


@pytest.fixture(scope="module")
def queries(vectors):
    """Shifted vectors, so that no query is a vector."""
    moved = F.transform("embedding", lambda x: x * 0.97 + 0.002)
    return vectors.where("vec_id % 9 = 0").select((-F.col("vec_id")).alias("qid"), moved.alias("embedding")).cache()


@pytest.fixture(scope="module")
def index(vectors, tmp_path_factory):
    return vector_index.build_index(vectors, "vec_id", str(tmp_path_factory.mktemp("index") / "i"))


def pairs(df):
    return {(r.query_id, r.rank): (r.vec_id, round(r.distance, 9)) for r in df.collect()}


@pytest.fixture(scope="module")
def truth(vectors, queries):
    return pairs(retrieval.vector_topk(queries, vectors, "qid", "vec_id"))


def recall(got, truth):
    want = {(q, v) for (q, _), (v, _) in truth.items()}
    return len(want & {(q, v) for (q, _), (v, _) in got.items()}) / len(want)


def test_recall_and_cells_read(index, queries, truth):
    assert recall(pairs(index.search(queries, "qid")), truth) >= 0.95
    share = index.cells_read(queries, "qid")
    assert len(index.centres) > 10 and share < 0.6


def test_exact_search_equals_the_full_scan(index, queries, truth):
    assert pairs(index.search(queries, "qid", probes=1, exact=True)) == truth


def test_only_probed_cells_are_scanned(index, queries):
    plan = index.search(queries.limit(1), "qid", probes=2)._jdf.queryExecution().executedPlan().toString()
    found = re.search(r"PartitionFilters: \[[^\]]*cell#\d+ (IN \(([^)]*)\)|INSET ([^\]]*)|= (\d+))", plan)
    assert found and "WindowGroupLimit" in plan


def test_reload_and_add(spark, vectors, queries, truth, tmp_path):
    path = str(tmp_path / "i")
    vector_index.build_index(vectors.where("vec_id % 2 = 0"), "vec_id", path, cells=12)
    grown = vector_index.VectorIndex.load(spark, path).add(vectors.where("vec_id % 2 = 1"), "vec_id")
    assert grown.count.sum() == vectors.count()
    again = vector_index.VectorIndex.load(spark, path)
    assert pairs(again.search(queries, "qid", exact=True)) == truth


def test_vectors_that_cannot_be_compared(spark, tmp_path):
    rows = [(i, [float(i), 1.0]) for i in range(20)] + [(20, None), (21, [1.0, None]), (22, [float("nan"), 1.0]), (23, [1.0]), (24, [float("inf"), 0.0]), (25, []), (5, [5.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    index = vector_index.build_index(df, "vec_id", str(tmp_path / "i"), cells=3)
    assert index.count.sum() == 21
    asked = spark.createDataFrame([(1, [4.6, 1.0]), (2, None), (3, [1.0])], "qid long, embedding array<double>")
    got = pairs(index.search(asked, "qid", k=3, probes=1))
    assert [got[1, r][0] for r in (1, 2, 3)] == [5, 5, 4] and len(got) == 3
    assert len(pairs(index.search(asked, "qid", k=21, probes=1))) == 21  # more cells until there are k
    with pytest.raises(ValueError):
        vector_index.build_index(df.where("vec_id > 19 AND vec_id < 26 AND vec_id <> 23"), "vec_id", str(tmp_path / "none"))
