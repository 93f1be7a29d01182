"""Every operator and stage on NULLs, empty and very long texts, repeated rows, empty tables and extra columns."""

import pytest

import corpus_pipeline
from sirenlake.llm import bm25_search, embedding_dedup, importance, line_dedup, minhash_dedup, mixing, pii, sentencepiece_scan, toxicity, url_filter
from sirenlake.llm.queries import MODEL_FILE

DOCS = "doc_id long, text string, lang string, source string, n_chars long, band long, h string, id long"
LABELS = "doc_id long, quality int, toxic int"
LONG = " ".join(f"word{i % 977} other" for i in range(40_000))
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog", "en", "a", 43, 1, "x", 9),
    (1, "The quick brown fox jumps over the lazy dog", "en", "a", 43, 1, "x", 9),
    (2, None, None, None, None, None, None, None),
    (3, "", "en", "b", 0, 2, "y", 1),
    (4, " \t\n ", "en", None, 4, 2, "y", 1),
    (None, "A text whose id is missing, with words", "en", "b", 38, 3, "z", 2),
    (5, LONG, "en", "c", len(LONG), 3, "z", 2),
    (6, "idiot 10.0.0.1 mail a.b@example.com", "en", "a", 30, 4, "w", 3),
    (7, "word", "de", "a", 4, 4, "w", 3),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (6, 0, 1), (6, 0, 1), (None, 1, 1), (7, None, None), (5, 1, 0)], LABELS)


def ids(df):
    return sorted((r["doc_id"] for r in df.collect()), key=repr)


ALL = sorted((r[0] for r in ROWS), key=repr)


def test_one_row_per_document(spark, docs, labels):
    vocab = sentencepiece_scan.load_vocabulary(MODEL_FILE)
    assert ids(toxicity.judge_documents(docs, labels)) == ALL
    assert ids(importance.resample(docs, labels)) == ALL
    assert ids(line_dedup.dedup_lines(docs)) == ALL
    assert ids(sentencepiece_scan.encode_documents(docs, vocab, chunk=5000)) == ALL
    assert ids(pii.find_personal_data(docs)) == ALL
    assert ids(minhash_dedup.near_duplicates(docs)) == ALL
    assert ids(mixing.taken_words(mixing.plan_mix(docs))) == ALL


def test_empty_tables(spark, docs, labels):
    none, no_labels = docs.limit(0), labels.limit(0)
    vocab = sentencepiece_scan.load_vocabulary(MODEL_FILE)
    assert toxicity.judge_documents(none, no_labels).count() == 0
    assert importance.resample(none, no_labels).count() == 0
    assert bm25_search.top_documents(none, none).count() == 0
    assert line_dedup.dedup_lines(none).count() == 0
    assert sentencepiece_scan.encode_documents(none, vocab).count() == 0
    assert pii.find_personal_data(none).count() == 0
    assert minhash_dedup.near_duplicates(none).count() == 0
    assert mixing.taken_words(mixing.plan_mix(none)).count() == 0
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_dedup.near_duplicate_vectors(vectors).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert url_filter.judge_urls(pages, no_labels).count() == 0


def test_texts_without_words(spark, docs, labels):
    near = {r["doc_id"]: r for r in minhash_dedup.near_duplicates(docs).collect()}
    for i in (2, 3, 4):
        assert (near[i]["n_shingles"], near[i]["component_id"], near[i]["kept"]) == (0, i, True)
    assert near[7]["n_shingles"] == 1
    without = toxicity.judge_documents(docs.where("doc_id in (2, 3, 4)"), labels).collect()
    assert len({r["score"] for r in without}) == 1 and 0 <= without[0]["score"] <= 1
    assert {r["spans"] for r in pii.find_personal_data(docs.where("doc_id in (2, 3, 4)")).collect()} == {""}
    mixed = {r["doc_id"]: r["taken"] for r in mixing.taken_words(mixing.plan_mix(docs)).collect()}
    assert mixed[2] == mixed[3] == mixed[4] == 0
    kept = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(docs).collect()}
    assert kept[2] is None and kept[3] == "" and kept[4] == " \t\n "
    found = bm25_search.top_documents(docs, docs)
    assert not {2, 3, 4} & {r["doc_id"] for r in found.collect()}


@pytest.mark.parametrize("number", range(5))
def test_stages(spark, docs, labels, tmp_path, number):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    name, stage = corpus_pipeline.STAGES[number]
    out = stage(spark, docs, str(tmp_path))
    assert set(docs.columns) <= set(out.columns)
    if number < 4:
        assert out.columns == docs.columns
    rows = out.collect()
    assert rows
    if number != 3:  # the mix takes no empty documents
        assert {2, 3, 4} <= {r["doc_id"] for r in rows}
    assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
