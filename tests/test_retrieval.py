import math
import re

import pytest
from pyspark.sql import functions as F

from sirenlake.operators import retrieval


def test_keyword_scores_equal_brute_force(spark):
    docs = [(0, "Chest pain", "chest pain chestpain protocol"), (1, "Burns", "burn burns burning"), (2, "Other", "aaaa nothing"), (3, "Chest", "pain in the chest: protocol for chest pain"), (4, "É", "naïve chestée")]
    queries = [(0, "What is the chest pain protocol?"), (1, "burn burn the AAA"), (2, "is it of"), (3, "zzzz")]
    d = spark.createDataFrame(docs, "doc_id long, title string, text string")
    q = spark.createDataFrame(queries, "qid long, question string")
    got = {}
    for r in retrieval.keyword_rank(q, d, "qid", "question", "doc_id", ["title", "text"], k=3).orderBy("rank").collect():
        got.setdefault(r.query_id, []).append((r.doc_id, r.score))
    want = {}
    for qid, question in queries:
        terms = [t for t in re.findall("[a-z0-9]+", question.lower()) if len(t) > 2 and t not in retrieval.STOPWORDS]
        scored = []
        for i, title, body in docs:
            hay = f"{title} {body}".lower()
            score = sum(hay.count(t) for t in terms)
            score += 5 if terms and all(t in hay for t in terms[:3]) else 0
            if score:
                scored.append((i, score))
        if scored:
            want[qid] = sorted(scored, key=lambda p: (-p[1], p[0]))[:3]
    assert got == want


def test_lsh_finds_a_subset_of_the_exact_neighbours_with_good_recall(spark, sf):
    from sirenlake.plans.queries import QUERIES

    exact = {(r.query_id, r.vec_id): r.distance for r in QUERIES["vector_topk"](spark, sf).collect()}
    near = [(r.query_id, r.vec_id, r.distance) for r in QUERIES["vector_topk_lsh"](spark, sf).collect()]
    hit = [n for n in near if (n[0], n[1]) in exact]
    assert len(hit) >= 0.8 * len(exact)
    assert all(exact[(q, v)] == d for q, v, d in hit)


def test_query_packs_do_not_change_the_answer(spark, sf):
    from sirenlake.plans import fixtures

    q, v = fixtures.query_vectors(spark, sf), fixtures.table(spark, sf, "embeddings")
    one = sorted(map(tuple, retrieval.vector_topk(q, v, "label", "vec_id").select("query_id", "rank", "vec_id").collect()))
    many = sorted(map(tuple, retrieval.vector_topk(q, v, "label", "vec_id", batch=3).select("query_id", "rank", "vec_id").collect()))
    assert one == many and len(one) == 50


@pytest.mark.parametrize(
    "reply, score, reasoning",
    [
        ('{"score": 2, "reasoning": "ok"}', 2.0, "ok"),
        ('```json\n{"score": 2.5, "reasoning": "fenced"}\n```', 2.5, "fenced"),
        ('Sure: {"score": 9, "reasoning": "x"} done', 3.0, "x"),
        ('{"score": -4}', 0.0, ""),
        ('{"reasoning": "none"}', 0.0, "none"),
        ("score: 1.5 because", 1.5, "score: 1.5 because"),
        ('{"score": bad json} Score: 2', 2.0, '{"score": bad json} Score: 2'),
        ("nothing", 0.0, "Could not parse judge response: nothing"),
    ],
)
def test_judge_replies(spark, reply, score, reasoning):
    r = retrieval.judge_parse(spark.createDataFrame([(reply,)], "response string")).first()
    assert (r.score, r.reasoning) == (score, reasoning)


def test_latency(spark):
    df = spark.createDataFrame([(float(i), True) for i in range(1, 6)] + [(99.0, False)], "latency_s double, success boolean")
    r = retrieval.latency_percentiles(df).first()
    assert (r.p50, r.p95, r.mean, r.min, r.max, r.n, r.passes) == (3.0, 5.0, 3.0, 1.0, 5.0, 5, True)
    none = retrieval.latency_percentiles(df.where("NOT success")).first()
    assert none.p50 == none.p95 == none.mean == math.inf and none.passes is False


def test_precision_divides_by_k(spark):
    got = spark.createDataFrame([(1, 1, ["a"]), (1, 2, ["b", "x"]), (1, 3, ["y"])], "query_id int, rank int, candidate_ids array<string>")
    want = spark.createDataFrame([(1, ["a", "b"]), (2, ["a"])], "query_id int, expected_ids array<string>")
    per = retrieval.precision_at_k(got, want)
    assert {r.query_id: r.precision_at_k for r in per.collect()} == {1: 0.4, 2: 0.0}
    assert retrieval.precision_summary(per).first().mean_precision == 0.2


def test_source_ids(spark):
    df = spark.createDataFrame([("Docs\\My File.MD",), ("a/b/c.jsonl",), ("",), (None,), ("Plain name",)], "x string")
    assert [r[0] for r in df.select(retrieval.normalise_source_id("x")).collect()] == ["my_file", "c", "", "", "plain_name"]


def test_citations_and_answers(spark):
    schema = "query_id int, rank int, source_id string, title string, chunk_index string, chunk_id string, url string, file_name string, text string"
    rows = [
        (1, 1, "s1", "T1", "2", "c1", "http://x", "f", "first   text"),
        (1, 2, "s1", "T1", "2", "c2", "http://x", "f", "again"),
        (1, 3, "s2", "", "bad", "c3", "", "f", "y" * 400),
        (1, 4, "s3", "T3", None, "c4", "http://y", "f", "z"),
    ]
    df = spark.createDataFrame(rows, schema)
    cites = {r.chunk_id: r for r in retrieval.dedupe_citations(df).collect()}
    assert set(cites) == {"c1", "c3", "c4"}
    assert cites["c1"].citation == "[source: T1; chunk: 2]" and cites["c3"].citation == "[source: s2]"
    assert cites["c1"].snippet == "first text" and len(cites["c3"].snippet) == 260 and cites["c3"].snippet.endswith("...")
    assert retrieval.source_summary(df).first().summary == "T1; s2; T3"
    assert sorted(r.source_key for r in retrieval.displayable_sources(df).collect()) == ["s1", "s3"]
    questions = spark.createDataFrame([(1,), (2,)], "query_id int")
    answers = {r.query_id: r.answer for r in retrieval.extractive_answer(questions, df).collect()}
    assert answers[1] == "Based on the retrieved documents:\n\n- first text\n- again\n\nSources: T1; s2; T3"
    assert answers[2] == retrieval.NO_ANSWER
    listed = {r.query_id: r.answer_text for r in retrieval.answer_text(retrieval.extractive_answer(questions, df), retrieval.dedupe_citations(df)).collect()}
    assert listed[1].endswith("Sources:\n- [source: T1; chunk: 2]\n- [source: s2]\n- [source: T3]") and listed[2] == retrieval.NO_ANSWER


def test_markers_go(spark):
    df = spark.createDataFrame([("Give oxygen [Source: a; chunk: 3] now. [source: b]",)], "x string")
    assert df.select(retrieval.strip_markers("x")).first()[0] == "Give oxygen now."


def test_store_integrity(spark):
    good = spark.createDataFrame([(1, [0.0, 1.0]), (2, [1.0, 0.0])], "vec_id int, embedding array<float>")
    assert retrieval.store_integrity(good, "vec_id").first().is_sound
    ragged = spark.createDataFrame([(1, [0.0, 1.0]), (2, [1.0])], "vec_id int, embedding array<float>")
    assert not retrieval.store_integrity(ragged, "vec_id").first().is_sound
    assert not retrieval.store_integrity(good.where("vec_id > 5"), "vec_id").first().is_sound


def test_verdict_needs_components_that_ran(spark):
    make = lambda *v: spark.createDataFrame([(x,) for x in v], "passes boolean")
    assert retrieval.eval_summary([make(True), make(True)]).first().all_pass
    assert not retrieval.eval_summary([make(True), make(False)]).first().all_pass
    assert not retrieval.eval_summary([make()]).first().all_pass
