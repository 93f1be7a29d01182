"""Operators against plain Python over whole texts."""

import math
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from sirenlake.llm import bm25_search, embedding_dedup, importance, line_dedup, linking, minhash_dedup, pii, sentencepiece_scan, toxicity
from sirenlake.llm.common import connected_components
from sirenlake.llm.queries import MODEL_FILE

LOWER = {i: i + 32 for i in range(65, 91)}


class Groups:
    def __init__(self):
        self.up = {}

    def top(self, x):
        while self.up.get(x, x) != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.top(a), self.top(b)
        self.up[max(a, b)] = min(a, b)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return {r["doc_id"]: r["text"] or "" for r in documents.select("doc_id", "text").collect()}


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text.translate(LOWER))
    return set(zip(*[words[i:] for i in range(5)])) if len(words) >= 5 else ({tuple(words)} if words else set())


def test_components(spark):
    random.seed(3)
    pairs = [(random.randrange(300), random.randrange(300)) for _ in range(220)] + [(1000, i) for i in range(1001, 1200)] + [(i, i + 1) for i in range(2000, 2100)]
    groups = Groups()
    for a, b in pairs:
        groups.join(a, b)
    got = {r["id"]: r["component_id"] for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: groups.top(x) for p in pairs for x in p if p[0] != p[1] or x in got}


def near_copies(seed, count, words, changes):
    random.seed(seed)
    base = [f"w{random.randrange(5000)}" for _ in range(words)]
    for _ in range(count):
        copy = list(base)
        for _ in range(random.randrange(changes + 1)):
            copy[random.randrange(words)] = f"x{random.randrange(10**6)}"
        yield " ".join(copy)


def test_minhash_components(spark, texts):
    rows = list(texts.items()) + [(10_000 + i, t) for i, t in enumerate([*near_copies(1, 120, 120, 6), *near_copies(2, 60, 40, 3), *near_copies(3, 30, 9, 1)])]
    sets = {i: shingles(t) for i, t in rows}
    groups = Groups()
    order = sorted(sets)
    for n, i in enumerate(order):
        for j in order[n + 1 :]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                groups.join(i, j)
    got = minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == {i: (len(sets[i]), groups.top(i), groups.top(i) == i) for i in order}


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 2**63, 300).astype(np.uint64), rng.integers(0, 2**63, 100).astype(np.uint64)
    sets = [np.sort(a), np.sort(np.concatenate([a[:200], b])), a[:1], a[:0]]
    first = np.cumsum([0, *map(len, sets)])
    sketch = minhash_dedup.fast_sketch(np.concatenate(sets), first, 1024)
    assert (sketch[:3] != np.uint64(0xFFFFFFFFFFFFFFFF)).all() and (sketch[3] == np.uint64(0xFFFFFFFFFFFFFFFF)).all()
    assert abs((sketch[0] == sketch[1]).mean() - 0.5) < 0.06


def test_embedding_links(spark):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((40, 16))
    vectors = [c + rng.standard_normal(16) * s for c in centres for s in (0, 0.02, 0.05, 0.12, 0.2)] + [centres[0]] * 30
    vectors += [vectors[3] * 7, np.zeros(16), np.full(16, np.nan)]
    rows = [(i, [float(np.float32(x)) for x in v], i % 2 if i < 200 else 0) for i, v in enumerate(vectors)] + [(900, None, 1), (901, [1.0, None], 1), (902, [1.0] * 16, None), (903, [], 1)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    good = {i: (np.float32(v).astype(float), l) for i, v, l in rows if v and l is not None and None not in v and np.isfinite(v).all() and np.any(v)}
    links, groups = Counter(), Groups()
    for i, (v, l) in good.items():
        for j, (w, m) in good.items():
            if i != j and l == m and v @ w / (np.linalg.norm(v) * np.linalg.norm(w)) >= 0.98:
                links[i] += 1
                groups.join(i, j)
    assert got == {i: (links[i], groups.top(i), groups.top(i) == i) for i, _, _ in rows}


def test_estimate_is_unbiased():
    rng = np.random.default_rng(2)
    u = embedding_dedup.unit_rows(rng.standard_normal((2, 32)))
    v = u[0] * 0.8 + u[1] * 0.3
    out = []
    for seed in range(400):
        r = embedding_dedup.rotations(32, 32, seed)
        x, y = r @ u[0], r @ v
        out.append((np.sign(x) @ y) / np.abs(x).sum())
    assert abs(np.mean(out) - u[0] @ v) < 0.02


def luhn(digits):
    doubled = [int(d) if i % 2 == 0 else int(d) * 2 - 9 * (int(d) > 4) for i, d in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text):
    out = []
    for place, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 12 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((m.start(), place, f"{kind}:{m.start()}:{m.end()}"))
    return [s[2] for s in sorted(out)]


def test_pii_base(spark, texts):
    odd = [
        "a@b.c_x@d.e 1.2.3.4.5 300.1.1.1 +1 (980) 555-6268 4111 1111 1111 1111", "é😀 x@y.zz, 0255.001.1.1 +1234", "@a.b a@b a@b. +12345678 4111-1111-1111-1112",
        "9" * 5000, "a." * 5000 + "@", "1." * 5000, "+1" + "(" * 3000, "a@b" + ".c" * 20000, "mail a@b.cc+1 202 555 0143 4111111111111111",
    ]
    rows = list(texts.items()) + [(50_000 + i, t) for i, t in enumerate(odd)]
    import hashlib

    for r in pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        want = base_spans(dict(rows)[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(s.startswith(k + ":") for s in want) for k in PLAIN]
        assert set(want) <= set(filter(None, r["spans"].split(",")))


def line_words(line):
    return tuple(w for w in re.split(r"[\W_]+", line.lower()) if w)


def test_lines(spark, documents, texts):
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(documents.select("doc_id", "text"), similarity=1.0).collect()}
    seen = set()
    for i in sorted(texts):
        keep = []
        for line in texts[i].split("\n"):
            words = line_words(line)
            if not words or words not in seen:
                keep.append(line)
            seen.add(words)
        assert got[i]["text"] == "\n".join(keep)


def test_fuzzy_lines(spark):
    random.seed(4)
    base = [f"alpha{chr(97 + random.randrange(26))}{chr(97 + i % 26)}" for i in range(60)]
    changed = list(base)
    changed[30] = "different"
    other = [w[::-1] for w in base]
    rows = [(1, " ".join(base) + "\nshort line"), (2, "KEEP\n" + " ".join(base).upper() + " 2024!"), (3, " ".join(changed)), (4, " ".join(other)), (5, "short line")]
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == rows[0][1] and got[2] == "KEEP" and got[4] == rows[3][1] and got[3] == got[5] == ""
    assert line_dedup.dedup_lines(spark.createDataFrame(rows[:1] * 2, "doc_id long, text string")).where("_dropped > 0").count() == 0


def test_bm25(spark, documents, texts):
    queries = documents.where("doc_id % 20 = 0")
    got = {}
    for r in bm25_search.top_documents(documents, queries, 10, shard_docs=64).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["doc_id"], r["score"]))
    words = {i: Counter(re.findall(r"[0-9A-Za-z\u0080-\U0010ffff]+", t.translate(LOWER))) for i, t in texts.items()}
    df = Counter(w for c in words.values() for w in c)
    n, average = len(words), sum(sum(c.values()) for c in words.values()) / len(words)
    for q in (i for i in texts if i % 20 == 0):
        scores = {}
        for i, c in words.items():
            norm = bm25_search.K1 * (1 - bm25_search.B + bm25_search.B * sum(c.values()) / average)
            score = sum(math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * (bm25_search.K1 + 1) / (c[w] + norm) for w in words[q] if w in c)
            if score:
                scores[i] = score
        want = sorted(scores.values(), reverse=True)[:10]
        rows = sorted(got.get(q, []))
        assert [s for *_, s in rows] == pytest.approx(want) and all(scores[d] == pytest.approx(s) for _, d, s in rows)


def test_importance(spark, documents, texts):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = importance.resample(documents, labels, share=0.3).collect()
    assert sum(r["selected"] for r in rows) == math.ceil(len(rows) * 0.3)
    assert min(r["gumbel_key"] for r in rows if r["selected"]) > max(r["gumbel_key"] for r in rows if not r["selected"])
    assert importance.log_ratio(np.array([5, 1, 0]), np.array([50, 10, 0])) == pytest.approx(np.log([6 / 9, 2 / 9, 1 / 9]) - np.log([51 / 63, 11 / 63, 1 / 63]))
    values = [random.Random(1).choice([1.5, 2.5, 1e300, -1e300, 0.0]) for _ in range(5000)] + [i / 7 for i in range(6000)]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    assert [importance.kth_largest(frame, "v", k) for k in (1, 1500, 9000)] == [sorted(values, reverse=True)[k - 1] for k in (1, 1500, 9000)]


@pytest.fixture(scope="module")
def vocab():
    return sentencepiece_scan.load_vocabulary(MODEL_FILE)


ODD_TEXTS = ["", "a", "  a b", " ", "\n\t x", "😀 ▁▁ wörld", "x" * 500 + " y  ", "你好 世界" * 40, "\u0000 a b", "ab" * 300]


def path_score(vocab, numbers):
    spelled = set(vocab.byte_ids.tolist())
    return sum(vocab.scores[i] for i in numbers if i not in spelled) + vocab.unknown * sentencepiece_scan.lost_characters(vocab, np.array(numbers, int))


def test_pieces_of_short_and_cut_texts(spark, vocab, texts):
    rows = [(i, t) for i, t in enumerate([*ODD_TEXTS, *list(texts.values())[:30]])]
    frame = spark.createDataFrame([*rows, (len(rows), None)], "doc_id long, text string")
    want = {i: sentencepiece_scan.encode_segment(vocab, b" " + t.encode()) if t else [] for i, t in rows}
    whole = sentencepiece_scan.encode_documents(frame, vocab)
    assert {r["doc_id"]: r["_ids"] for r in whole.collect()} == want | {len(rows): None}
    cut = sentencepiece_scan.decode_documents(sentencepiece_scan.encode_documents(frame, vocab, chunk=64, group=3), vocab).collect()
    for r in cut:
        assert r["text"] == r["_decoded"]
        if r["text"]:
            assert path_score(vocab, r["_ids"]) == path_score(vocab, want[r["doc_id"]])


def test_held_out_toxicity(spark):
    documents, labels = (spark.read.parquet(f"{SF.replace('0.001', '0.1')}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.judge_documents(documents, labels).join(labels.select("doc_id", "toxic"), "doc_id").where("held_out").toPandas()
    rank, bad = rows.score.rank(), rows.toxic == 1
    auc = (rank[bad].sum() - bad.sum() * (bad.sum() + 1) / 2) / (bad.sum() * (~bad).sum())
    assert auc > 0.97
    assert rows.predicted[bad].mean() > 0.75 and rows.predicted[~bad].mean() < 0.01


def test_group_names_do_not_decide(spark):
    random.seed(6)
    filler = [f"filler{i}" for i in range(400)]
    rows, marks = [], []
    for i in range(600):
        words = random.sample(filler, 8)
        toxic = i % 3 == 0
        if toxic:
            words += ["vile"] * (i % 2) + ["muslims"]  # half of the toxic texts only name a group
        rows.append((i, " ".join(words) + "."))
        marks.append((i, 1, int(toxic)))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    neutral = ["muslims " + " ".join(filler[:6])]
    free, bound = (toxicity.fit_toxicity(docs, labels, counterfactual=c) for c in (0.0, 50.0))
    assert bound.score_texts(neutral)[0] < 0.5 < free.score_texts(neutral)[0]
    assert bound.score_texts(["vile " + " ".join(filler[:6])])[0] > 0.5


def word_edits(x, y):
    row = list(range(len(y) + 1))
    for i, a in enumerate(x, 1):
        last, row[0] = row[0], i
        for j, b in enumerate(y, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (a != b))
    return row[-1]


def line_similar(x, y, similarity=0.9):
    return word_edits(x, y) <= math.floor(max(len(x), len(y)) * (1 - similarity) + 1e-9)


def test_recall_of_similar_lines(spark):
    """No pair that is not similar, and at least nine in ten of the similar ones at every length."""
    random.seed(12)
    word = lambda: "".join(random.choices("abcdefghij", k=random.randint(2, 8)))
    common = [word() for _ in range(30)]
    lines = []
    for size in [1, 2, 3, 5, 9, 10, 11, 12, 14, 15, 17, 19, 20, 22, 25, 29, 30, 35, 40, 50, 70, 99, 200] * 4:
        base = [random.choice(common) if size > 5 and random.random() < 0.6 else word() for _ in range(size)]
        lines.append(base)
        for share in (0, 0.05, 0.1, 0.1, 0.13):
            line = list(base)
            for _ in range(max(1, int(size * share)) if share else 0):
                i, kind = random.randrange(len(line)), random.randrange(4)
                if kind == 1:
                    line.insert(i, word())
                elif kind == 2 and len(line) > 1:
                    del line[i]
                else:
                    line[i] = word()
            lines.append(line)
    docs = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(lines)], "doc_id long, text string")
    group = {r["doc_id"]: r["group"] for r in line_dedup.line_groups(docs).collect()}
    whole, found = Groups(), {"short": [], "medium": [], "long": []}
    for i, x in enumerate(lines):
        for j in range(i):
            if line_similar(x, lines[j]):
                whole.join(i, j)
                found["short" if len(x) < 10 else "medium" if len(x) < 30 else "long"].append(i in group and group[i] == group.get(j))
    assert all(sum(f) >= 0.9 * len(f) > 0 for f in found.values()) and all(found["short"])
    for g in set(group.values()):
        assert len({whole.top(i) for i in group if group[i] == g}) == 1


def test_one_edit_rule_at_every_length(spark):
    random.seed(13)
    word = lambda: "".join(random.choices("abcdefghijklmnop", k=6))
    bases = [[word() for _ in range(n)] for n in (4000, 4001, 34_000)]
    changed = [[word() if i % 16 == 0 else w for i, w in enumerate(b)] for b in bases]
    rows = [" ".join(b) for b in bases + changed] + ["Chapter 1", "Chapter 2", "天地玄黄宇宙洪荒日月", "天地玄黄，宇宙洪荒日月", "CHAPTER 1.", "--", "--"]
    got = line_dedup.dedup_lines(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).where("_dropped > 0").collect()
    assert {r["doc_id"] for r in got} == {3, 4, 5, 9, 10}


def test_lines_with_clashing_columns(spark):
    names = ["doc_id", "text", "_doc", "copy", "_gone", "h", "lines", "_lines", "d.x"]
    docs = spark.createDataFrame([(1, "one line", 2, 3, 4, 5, 6, 7, 8), (2, "One line!", 2, 3, 4, 5, 6, 7, 8)], names)
    out = line_dedup.dedup_lines(docs)
    assert out.columns == [*(n for n in names if n != "_lines"), "_lines", "_dropped"]
    assert sorted((r["doc_id"], r["text"], r["_doc"], r["d.x"], r["_lines"]) for r in out.collect()) == [(1, "one line", 2, 8, 1), (2, "", 2, 8, 1)]


def test_all_good_documents_are_the_target(spark):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "concat('word', id % 5000, ' other', id % 700) AS text")
    rows = importance.resample(docs, docs.selectExpr("doc_id", "1 AS quality")).agg({"log_weight": "min"}).union(importance.resample(docs, docs.selectExpr("doc_id", "1 AS quality")).agg({"log_weight": "max"}))
    assert [r[0] for r in rows.collect()] == pytest.approx([0, 0])


def test_obfuscated_personal_data_is_added(spark):
    random.seed(14)
    n = lambda: random.randrange(1, 255)
    rows, planted = [], {}
    for i in range(400):
        text = f"mail user{i}@host{i % 9}.example.com or {n()}.{n()}.{n()}.{n()} or call +1 202 555 0{100 + i} now; {n()}.{n()}.{300 + n()}.{n()} and 12-34-567"
        if i % 20 == 0:
            hidden = {"email": f"name{i} (at) host (dot) com", "ip": f"{n()}[.]{n()}[.]{n()}[.]{n()}", "phone": f"1 303 555 0{100 + i}"}
            for kind, span in hidden.items():
                text += " ; see "
                planted.setdefault(i, set()).add(f"{kind}:{len(text)}:{len(text) + len(span)}")
                text += span
        rows.append((i, text))
    got = {r["doc_id"]: set(r["spans"].split(",")) for r in pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(len(planted[i] & got[i]) for i in planted) >= 0.9 * sum(map(len, planted.values()))
    assert not any(pii_ip.search(rows[i][1][int(a) : int(b)]) for i in got for kind, a, b in (s.split(":") for s in got[i]) if kind == "ip")


pii_ip = re.compile(r"(?<![0-9])(?:2[6-9]|25[6-9]|[3-9][0-9])[0-9](?![0-9])")


def test_repeated_ids_lose_no_link_between_documents(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    rows = [(1, a), (1, b), (1, b), (2, a + " end"), (3, b + " end"), (4, "nothing like these two at all"), (None, a), (5, None), (1, None)]
    got = sorted(map(tuple, minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "component_id", "kept").collect()), key=repr)
    assert got == sorted([(1, 1, True)] * 4 + [(2, 1, False), (3, 1, False), (4, 4, True), (None, None, True), (5, 5, True)], key=repr)
    rng = random.Random(8)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(9)], k=30)) for _ in range(12)]
    many = [(rng.randrange(25), rng.choice(texts) + rng.choice(["", " x", " y z"])) for _ in range(120)]
    groups = Groups()
    sets = [(i, shingles(t)) for i, t in many]
    for i, x in sets:
        for j, y in sets:
            if 100 * len(x & y) >= 75 * len(x | y):
                groups.join(i, j)
    found = {(r["doc_id"], r["component_id"]) for r in minhash_dedup.near_duplicates(spark.createDataFrame(many, "doc_id long, text string")).collect()}
    assert found == {(i, groups.top(i)) for i, _ in many}


def test_repeated_ids_lose_no_link_between_vectors(spark):
    e1, e2, n1, n2 = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [1.0, 0.05, 0.0], [0.05, 1.0, 0.0]
    rows = [(1, e1, 1), (1, e2, 1), (2, n1, 1), (3, n2, 1), (1, e2, 2), (4, n2, 2), (1, e2, 1)]
    got = sorted(map(tuple, embedding_dedup.near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label long")).select("vec_id", "n_links", "component_id", "kept").collect()))
    assert got == sorted([(1, 1, 1, True), (1, 2, 1, True), (1, 2, 1, True), (2, 1, 1, False), (3, 2, 1, False), (1, 1, 1, True), (4, 1, 1, False)])


@pytest.mark.parametrize("filter_size", [1 << 20, 3])
def test_importance_weights_in_plain_python(spark, documents, texts, monkeypatch, filter_size):
    monkeypatch.setattr(importance, "FILTER", filter_size)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = {r["doc_id"] for r in labels.where("quality = 1").collect()}
    buckets = {}
    for i, t in texts.items():
        data = np.frombuffer(t.encode(), np.uint8)
        buckets[i] = importance.ngram_buckets(data, np.array([0, len(data)]))[0].tolist()
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        assert len(buckets[i]) == len(words) + max(0, len(words) - 1)
    raw, target = Counter(b for v in buckets.values() for b in v), Counter(b for i, v in buckets.items() if i in good for b in v)
    n = importance.BUCKETS
    of_raw, of_target = sum(raw.values()) + n, sum(target.values()) + n
    ratio = {b: math.log((target[b] + 1) / of_target) - math.log((raw[b] + 1) / of_raw) for b in raw}
    for r in importance.resample(documents, labels).collect():
        assert r["log_weight"] == pytest.approx(sum(ratio[b] for b in buckets[r["doc_id"]]), abs=1e-6)


def test_pii_trees_see_every_labelled_candidate(spark, monkeypatch):
    """24,000 labelled spans of 8,000 addresses and one number that fails its check; a quarter calibrates."""
    seen = []

    class Recorder:
        def __init__(self, **options):
            pass

        def fit(self, rows):
            seen.append(rows.count())
            raise InterruptedError

    monkeypatch.setattr(pii, "GBTClassifier", Recorder)
    docs = spark.range(8000).selectExpr("id AS doc_id", "concat('mail u', id, '@example.org') AS text")
    docs = docs.union(spark.createDataFrame([(-i, "host 999.1.1.1 is down") for i in range(1, 20)], docs.schema))
    with pytest.raises(InterruptedError):
        pii.find_personal_data(docs)
    assert 17_500 < seen[0] < 18_500


def test_pii_thresholds_count_equal_scores_together(spark):
    rows = [("email", s, float(p)) for s, p in [(0.9, 1), (0.9, 1), (0.8, 1), (0.8, 0), (0.8, 1), (0.7, 1), (0.3, 1)]] + [("ip", 0.9, 0.0), ("ip", 0.8, 1.0)]
    scored = spark.createDataFrame(rows, "kind string, score double, label double")
    assert pii.span_thresholds(scored, 0.8, 0.5) == {"email": 0.7}
    assert pii.span_thresholds(scored, 0.85, 0.5) == {"email": 0.9}
    assert pii.span_thresholds(scored, 0.5, 0.5) == {"email": 0.7, "ip": 0.8}


def test_lines_that_share_blocks_but_no_rare_words_are_not_compared(spark, monkeypatch):
    """All lines have the same twelve longest words and so all blocks in common; only those of a few families are similar."""
    rng = random.Random(5)
    shared = [f"{i:02d}longestwordsofall" for i in range(12)]
    lines = [shared + [f"w{rng.randrange(100_000)}" for _ in range(30)] for _ in range(120)]
    for i in range(0, 40, 2):  # a twin with four words changed, the same ones deleted or put elsewhere
        twin = list(lines[i])
        for at in rng.sample(range(12, 42), 4):
            twin[at] = f"x{rng.randrange(100_000)}"
        lines.append(twin)
    compared = []

    def counted(pairs, similarity, plain=line_dedup.similar):
        compared.append(pairs.count())
        return plain(pairs, similarity)

    monkeypatch.setattr(line_dedup, "similar", counted)
    docs = spark.createDataFrame([(i, " ".join(line)) for i, line in enumerate(lines)], "doc_id long, text string")
    groups = {}
    for r in line_dedup.line_groups(docs).collect():
        groups.setdefault(r["group"], set()).add(r["doc_id"])
    assert sorted(map(sorted, groups.values())) == [[i, 120 + i // 2] for i in range(0, 40, 2)]
    assert sum(compared) < 10 * len(lines), compared  # all pairs would be 9,730


def test_rare_word_bands_lose_no_similar_pair(spark):
    rng = random.Random(8)
    lines = [[rng.choice("abcdefgh") for _ in range(rng.randint(10, 30))] for _ in range(40)]
    for line in lines[:25]:
        lines.append([rng.choice("abcdefgh") if rng.random() < 0.07 else w for w in line if rng.random() < 0.97])
    codes = spark.createDataFrame([(i, "".join(line)) for i, line in enumerate(lines)], "h long, code string")
    members = spark.createDataFrame([(7, i, len(line), 1) for i, line in enumerate(lines)], "band long, id long, size int, mark int")
    bands = line_dedup.prefix_bands(members, codes, 0.9)
    a, b = (bands.select("band", *[F.col(c).alias(f"{c}{k}") for c in ("id", "size", "mark")]) for k in (1, 2))
    meet = a.join(b, "band").where((F.col("id1") < F.col("id2")) & line_dedup.may_be_similar("size1", "mark1", "size2", "mark2", 0.9))
    met = {(r["id1"], r["id2"]) for r in meet.collect()}
    x, y = (codes.select(F.col("h").alias(h), F.col("code").alias(c)) for h, c in (("a", "x"), ("b", "y")))
    wanted = {(r["a"], r["b"]) for r in line_dedup.similar(x.join(y, F.col("a") < F.col("b")), 0.9).collect()}
    assert len(wanted) >= 10 and wanted <= met


def test_loose_copies_are_compared_by_their_words_first(spark, monkeypatch):
    """Copies of one line with words changed at random: most pairs share rare words, but differ in too many others."""
    rng = random.Random(21)
    base = [f"b{i:02d}{'xyz'[i % 3] * (i % 9)}" for i in range(60)]
    lines = []
    for _ in range(400):
        line = list(base)
        for at in rng.sample(range(60), rng.randint(4, 6)):
            line[at] = f"n{rng.randrange(10**9)}"
        lines.append(line)
    compared = []

    def counted(pairs, similarity, plain=line_dedup.similar):
        compared.append(pairs.count())
        return plain(pairs, similarity)

    monkeypatch.setattr(line_dedup, "similar", counted)
    codes = {w: i for i, w in enumerate(sorted({w for line in lines for w in line}))}
    table = spark.createDataFrame([(i, "".join(chr(0x10000 + codes[w]) for w in line)) for i, line in enumerate(lines)], "h long, code string")
    members = spark.createDataFrame([(7, i, 60, 1, 400) for i in range(400)], "band long, id long, size int, mark int, n long")
    near = line_dedup.may_be_similar("size", "mark", "other_size", "other_mark", 0.9)

    def confirm(pairs):
        x, y = (table.select(F.col("h").alias(h), F.col("code").alias(c)) for h, c in (("a", "x"), ("b", "y")))
        return line_dedup.similar(pairs.join(x, "a").join(y, "b"), 0.9)

    found = linking.link(members, confirm, near, lambda rows: line_dedup.prefix_bands(rows, table, 0.9), near & line_dedup.may_have_words(0.9))
    whole = Groups()
    for i, x in enumerate(lines):
        for j in range(i):
            if len(set(x) & set(lines[j])) >= 52 and line_similar(x, lines[j]):
                whole.join(i, j)
    got = {r["id"]: r["component_id"] for r in found.collect()}
    tops = {}
    for i in range(400):
        tops.setdefault(whole.top(i), []).append(i)
    assert all(len({got.get(i, i) for i in group}) == 1 for group in tops.values())
    assert len({got.get(i, i) for i in range(400)}) == len(tops)
    assert sum(compared) < 10 * len(lines), compared


def test_bits_of_words_lose_no_similar_pair(spark):
    rng = random.Random(9)
    lines = [[rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(10, 30))] for _ in range(40)]
    for line in lines[:25]:
        lines.append([rng.choice("abcdefgh") if rng.random() < 0.07 else w for w in line if rng.random() < 0.97])
    codes = spark.createDataFrame([(i, "".join(line)) for i, line in enumerate(lines)], "h long, code string")
    members = spark.createDataFrame([(7, i, len(line), 1) for i, line in enumerate(lines)], "band long, id long, size int, mark int")
    names = ["size", *[f"bits{i}" for i in range(line_dedup.BITS)]]
    bands = line_dedup.prefix_bands(members, codes, 0.9).select("id", *names).distinct()
    pairs = bands.withColumnRenamed("id", "a").join(bands.select(F.col("id").alias("b"), *[F.col(c).alias(f"other_{c}") for c in names]), F.col("a") < F.col("b"))
    kept = {(r["a"], r["b"]) for r in pairs.where(line_dedup.may_have_words(0.9)).collect()}
    x, y = (codes.select(F.col("h").alias(h), F.col("code").alias(c)) for h, c in (("a", "x"), ("b", "y")))
    wanted = {(r["a"], r["b"]) for r in line_dedup.similar(x.join(y, F.col("a") < F.col("b")), 0.9).collect()}
    assert len(wanted) >= 10 and wanted <= kept
    assert len(kept) < pairs.count() / 4


def test_postings_of_a_shard_stay_small(monkeypatch):
    """The peak while an index is built, over its postings: sixteen bytes a posting were held twice before."""
    monkeypatch.setattr(bm25_search, "CHUNK", 1 << 15)
    rng = np.random.default_rng(4)
    parts = [(np.repeat(np.arange(i, i + 20), 500), np.concatenate([np.sort(rng.choice(20_000, 500, False)) for _ in range(20)]).astype(np.int64)) for i in range(0, 2000, 20)]
    tracemalloc.start()
    postings = bm25_search.Postings()
    for doc, term in parts:
        postings.add(doc, term, np.full(len(doc), 2))
    index = bm25_search.ShardIndex(np.arange(2000), postings, np.full(2000, 1000), 1000.0)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 24 * len(index.doc), peak / len(index.doc)
    assert len(index.doc) == 1_000_000 and int(index.start[-1]) == len(index.doc) and (np.diff(index.first) > 0).all()
    want = {}
    for doc, term in parts:
        for d, t in zip(doc.tolist(), term.tolist()):
            want.setdefault(t, []).append(d)
    for row in range(0, len(index.terms), 997):
        cells = slice(index.first[row], index.first[row + 1])
        assert index.doc[index.start[cells.start] : index.start[cells.stop]].tolist() == want[int(index.terms[row])]


def test_parts_of_long_queries_count_once(spark, monkeypatch):
    """Queries come in several rows; results do not depend on how they are cut, nor on chunks of postings."""
    rng = random.Random(3)
    docs = spark.createDataFrame([(i, " ".join(f"w{int(rng.paretovariate(0.6))}" for _ in range(rng.randint(0, 60)))) for i in range(300)], "doc_id long, text string").cache()
    found = lambda: sorted(map(tuple, bm25_search.top_documents(docs, docs.where("doc_id % 3 = 0"), 5, 64).collect()))
    want = found()
    monkeypatch.setattr(bm25_search, "PART", 1)
    monkeypatch.setattr(bm25_search, "CHUNK", 50)
    assert found() == want and len(want) > 400


def test_blocks_are_scored_for_many_queries_at_once(monkeypatch):
    """One pass over a block's matrix serves all queries that want it; its rounding does not reach the results, ties go to smaller ids."""
    monkeypatch.setattr(bm25_search, "BLOCK", 16)
    rng = np.random.default_rng(5)
    terms = [np.unique(rng.zipf(1.3, rng.integers(1, 80)) % 5000) for _ in range(400)]
    terms += [terms[i % 3] for i in range(200)]  # groups of copies
    tf = [rng.integers(1, 300, len(t)) for t in terms]
    tf[400:] = [tf[i % 3] for i in range(200)]
    length, ids = np.array([t.sum() for t in tf]), rng.permutation(600)
    queries = [(t, np.log(2 + 1 / t)) for t in terms[::5]] + [(np.array([6000]), np.ones(1)), (np.zeros(0, np.int64), np.zeros(0))]
    for dense, rare in ((512, 32), (3, 32), (512, 1 << 40), (0, 32)):  # some, few, all and no terms in the matrix
        monkeypatch.setattr(bm25_search, "DENSE", dense)
        monkeypatch.setattr(bm25_search, "RARE", rare)
        postings = bm25_search.Postings()
        for doc, (t, n) in enumerate(zip(terms, tf)):
            postings.add(np.full(len(t), doc), t, n)
        index = bm25_search.ShardIndex(ids, postings, length, length.mean())
        for k in (1, 10, 1000):
            for (words, weight), (found, score) in zip(queries, index.search(queries, k)):
                want = []
                for i, t, n in zip(ids.tolist(), terms, tf):
                    norm = bm25_search.K1 * (1 - bm25_search.B + bm25_search.B * n.sum() / length.mean())
                    parts = [w * (c * ((bm25_search.K1 + 1) / (c + norm))) for x, w in zip(words, weight) for c in n[t == x].tolist()]
                    want += [(-sum(parts), i)] if parts else []
                want = sorted(want)[:k]
                assert found.tolist() == [i for _, i in want] and (-score).tolist() == [s for s, _ in want]


def test_every_shard_has_a_task_of_its_own(spark):
    """Numbers hashed to tasks met: of 16 shards 12 tasks had rows, and one had three shards."""
    docs = spark.createDataFrame([(i, f"word{i % 7} common") for i in range(160)], "doc_id long, text string")
    found = bm25_search.top_documents(docs, docs.where("doc_id % 80 = 0"), 3, shard_docs=10)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(shard" not in plan and found.count() == 6


def test_queries_are_not_copied_to_every_shard(spark, monkeypatch):
    """Tasks read the index of all shards for a group of queries; results do not depend on shards, groups or the size of an index."""
    rng = random.Random(8)
    rows = [(i, " ".join(f"w{int(rng.paretovariate(0.7))}" for _ in range(rng.randint(0, 40)))) for i in range(400)]
    docs = spark.createDataFrame(rows + [(400 + i, rows[i % 5][1]) for i in range(60)], "doc_id long, text string").cache()
    found = lambda n: bm25_search.top_documents(docs, docs.where("doc_id % 3 = 0"), 5, n)
    whole = found(1000)
    want = sorted(map(tuple, whole.collect()))
    assert len(want) > 700 and sorted({r[1] for r in want}) == [1, 2, 3, 4, 5]
    copied = []
    explode = F.explode
    monkeypatch.setattr(bm25_search.F, "explode", lambda c: copied.append(str(c)) or explode(c))
    assert sorted(map(tuple, found(20).collect())) == want and not any("sequence(0" in c for c in copied), copied
    monkeypatch.setattr(bm25_search, "GROUP_TERMS", (100, 200))
    monkeypatch.setattr(bm25_search, "MOST_DOCS", 7)
    monkeypatch.setattr(bm25_search, "MOST_POSTINGS", 90)
    monkeypatch.setattr(bm25_search, "TOGETHER_TERMS", 50)
    assert sorted(map(tuple, found(20).collect())) == want


def test_only_lines_with_wide_characters_are_spaced(spark):
    """Accents do not start the search for scripts without blanks; letters of these are words wherever they lie."""
    ends = [int(x, 16) for x in re.findall(r"\\[ux]\{?([0-9A-F]+)\}?", line_dedup.UNSPACED)]
    points = sorted({c + d for c in ends for d in (-1, 0, 1)} | {0xE9, 0x3B1, 0x2014, 0x1F600, 0xE00, 0xE01})
    texts = [f"é{chr(c)}b {chr(c)}{chr(c)}" for c in points] + ["é ä", "ab"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    lines = line_dedup.lines_of(docs, 1)
    assert "RLIKE" in lines._jdf.queryExecution().optimizedPlan().toString()
    got = {r["doc_id"]: r["words"] for r in lines.collect()}
    always = F.regexp_replace(F.lower("text"), line_dedup.UNSPACED, " $1 ")
    want = docs.select("doc_id", F.array_remove(F.split(always, r"[^\p{L}\p{M}\p{N}]+"), "").alias("words"))
    assert got == {r["doc_id"]: r["words"] for r in want.collect() if r["words"]}
    assert got[points.index(0x4E00)] == ["é", "一", "b", "一", "一"] and got[len(points)] == ["é", "ä"]
