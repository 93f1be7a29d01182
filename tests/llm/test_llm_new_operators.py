"""BPE, max-sketch search and periodic runs against the tokenizers library and plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SF
from tokenizers import Tokenizer

from sirenlake.llm import bpe, max_sketch_search, run_detection
from sirenlake.llm.queries import LLM_QUERIES, TOKENIZER_FILE

LOWER = {i: i + 32 for i in range(65, 91)}
EDGE = "doc_id long, text string, lang string, _ids long, item_id string"
ROWS = [
    (1, "the quick brown fox", "en", 1, "x"),
    (1, "the quick brown fox", "en", 1, "x"),
    (2, None, None, None, None),
    (3, "", "en", 2, "y"),
    (4, " \t\n ", "en", 2, "y"),
    (None, "Fox and hound, fox and hound, fox and hound, fox and hound", "en", 3, "z"),
    (5, "go on " * 50_000, "en", 3, "z"),
    (6, "你好世界" * 3000, "zh", 4, "w"),
]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(ROWS, EDGE)


@pytest.fixture(scope="module")
def model():
    return bpe.load_bpe(TOKENIZER_FILE)


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


# BPE


def reference_tokens(texts):
    library = Tokenizer.from_file(TOKENIZER_FILE)
    library.no_truncation()
    library.no_padding()
    encoded = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    return encoded, [library.decode(i, skip_special_tokens=False) for i in encoded]


def test_bpe_query_equals_the_library(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    encoded, decoded = reference_tokens([r["text"] or "" for r in docs])
    want = sorted((r["doc_id"], len(i), sha(np.array(i, "<u4").tobytes()), sha(d)) for r, i, d in zip(docs, encoded, decoded))
    assert sorted(map(tuple, LLM_QUERIES["op11_bpe"](spark, SF).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect())) == want


def test_bpe_on_hard_texts(model):
    random.seed(7)
    letters = list("aAbÉé'sS1२ \t\x1c\x85 ßΣ中ไ!?.<İ́") + ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "'ll", "\U0001f600"]
    texts = ["".join(random.choices(letters, k=random.randrange(40))) for _ in range(3000)] + ["ab" * 50_000, "!" * 9999, "<|endoftext|>" * 500, "9" * 300]
    encoded, decoded = reference_tokens(texts)
    for text, ids, plain in zip(texts, encoded, decoded):
        got = np.frombuffer(model.encode(text), "<u4")
        assert got.tolist() == ids, text
        assert model.decode(got) == plain


def test_bpe_memory_is_bounded(model, monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY", 10)
    text = " ".join(f"word{i % 37}" for i in range(400))
    assert np.frombuffer(model.encode(text), "<u4").tolist() == reference_tokens([text])[0][0]
    assert len(model._solved) <= 10 and len(model._merged) <= 10
    model._solved.clear()
    model._merged.clear()


def test_bpe_columns_and_edges(spark, edge, model):
    tokens = bpe.decode_documents(bpe.encode_documents(edge.drop("_ids"), model), model).collect()
    assert len(tokens) == len(ROWS)
    encoded, decoded = reference_tokens([r["text"] or "" for r in tokens])
    assert [r["_ids"] for r in tokens] == encoded and [r["_decoded"] for r in tokens] == decoded
    assert bpe.token_digests(edge, model).count() == len(ROWS)
    assert bpe.token_digests(edge.limit(0), model).count() == 0
    with pytest.raises(ValueError):
        bpe.encode_documents(edge, model)


# max-sketch search


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def ranked(docs, items, k=10):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    n, total = sum(bool(c) for _, c in counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    out = []
    for item, wanted in asked.items():
        scores = []
        for i, c in counts:
            m = 10 + 90 * sum(c.values()) * n // max(total, 1)
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in wanted if t in c)
            if score > 0:
                scores.append((-score, i is None, i))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=repr)


def found(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


@pytest.mark.parametrize("block_terms", [1 << 17, 40])
def test_search_equals_brute_force(spark, monkeypatch, block_terms):
    random.seed(11)
    vocabulary = [f"w{i}" for i in range(400)]
    docs = [(i, " ".join(random.choices(vocabulary, weights=[1 / (j + 1) for j in range(400)], k=random.choice([0, 1, 3, 20, 400])))) for i in range(500)]
    docs += docs[:40] + [(None, "w1 w2 w3"), (900, None), (901, "W7,w7;w7")]
    items = [(f"q{i % 25}", " ".join(random.sample(vocabulary, random.randrange(0, 12)))) for i in range(40)] + [(None, "w5 w6"), ("none", None)]
    got = max_sketch_search.rank_documents(spark.createDataFrame(docs, "doc_id long, text string").repartition(7), spark.createDataFrame(items, "item_id string, text string"), block_terms=block_terms)
    assert found(got) == ranked(docs, items)


def test_bounds_prune_and_pages_agree(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").coalesce(1)
    items = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text")
    got = max_sketch_search.rank_documents(docs, items)
    assert found(got) == ranked([tuple(r) for r in docs.collect()], [tuple(r) for r in items.collect()])
    assert got.agg({"rescored": "avg"}).first()[0] < 0.5 * docs.count()


def test_search_edges(spark, edge):
    items = spark.createDataFrame([("a", "FOX"), ("a", "hound"), (None, "quick"), ("b", None), ("c", "absent")], "item_id string, text string")
    docs = [(r[0], r[1]) for r in ROWS]
    assert found(max_sketch_search.rank_documents(edge, items)) == ranked(docs, [tuple(r) for r in items.collect()])
    assert max_sketch_search.rank_documents(edge.limit(0), items).count() == 0
    assert max_sketch_search.rank_documents(edge, items.limit(0)).count() == 0


# periodic runs


def plain_runs(words):
    n, runs = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q) and not any(words[i : j + q - r] == words[i + r : j + q] for r in range(1, q)):
                runs.append((i, j + q - i, q))
            i = j + 1
    return sorted(runs, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text, tail):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if tail and doc_id is not None and h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = words[:a] + [words[a + i % p] for i in range(n - a)]
    runs = plain_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = (None, None, None)
    for run in runs:
        if best[0] is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    exponent = 1000 * best[1] // best[2] if runs else None
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (doc_id, len(runs), *best, exponent, sha(listed), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_runs_equal_brute_force(spark):
    random.seed(5)
    docs = []
    for i in range(1500):
        words = random.choices("abcdef"[: random.choice([1, 2, 2, 3, 6])], k=random.randrange(60))
        if random.random() < 0.6:
            words[len(words) // 2 : len(words) // 2] = random.choices("abc", k=random.randrange(1, 5)) * random.randrange(3, 8)
        docs.append((i, random.choice(["", "\n\n"]) + random.choice([" ", "  ", "\t"]).join(words)))
    got = run_detection.detect_runs(spark.createDataFrame(docs, "doc_id long, text string"), tail=True)
    assert sorted(map(tuple, got.collect())) == [plain_row(i, t, True) for i, t in docs]


def test_runs_query_equals_brute_force(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r["doc_id"]: tuple(r) for r in LLM_QUERIES["op13_periodic_runs"](spark, SF).collect()}
    assert got.keys() == docs.keys()
    brief = [i for i, t in docs.items() if len(t) < 5000]
    assert len(brief) > 0.8 * len(docs) and sum(got[i][1] for i in brief) > 0
    for i in brief:
        assert got[i] == plain_row(i, docs[i], True)


def test_lyndon_lengths_under_both_orders():
    random.seed(2)
    for _ in range(1500):
        word = [0] + random.choices(range(random.choice([2, 3, 5])), k=random.randrange(1, 25))
        for w in (word, [0 if not x else max(word) + 1 - x for x in word]):
            got = run_detection.lyndon_lengths(np.array(w))
            for i in (i for i in range(len(w)) if w[i]):
                want = next((j for j in range(i + 1, len(w)) if w[j:] < w[i:]), len(w)) - i
                assert got[i] == want, (w, i)


def test_words_without_powers_have_no_run():
    thue_morse = " ".join("ab"[i.bit_count() % 2] for i in range(1 << 14))
    data = np.frombuffer(thue_morse.encode(), np.uint8)
    row = run_detection._piece([1], data, np.array([0, len(data)]), False).to_pylist()[0]
    assert row["n_runs"] == 0 and row["start"] is None and row["collapsed_sha256"] == sha(thue_morse)


def test_runs_edges(spark, edge):
    got = sorted((tuple(r) for r in run_detection.detect_runs(edge).collect()), key=repr)
    brief = [r for r in ROWS if r[0] != 5]
    assert sorted((g for g in got if g[0] != 5), key=repr) == sorted((plain_row(r[0], r[1], False) for r in brief), key=repr)
    assert [g[1:6] for g in got if g[0] == 5] == [(1, 0, 100_000, 2, 50_000_000)]
    assert run_detection.detect_runs(edge.limit(0)).count() == 0
