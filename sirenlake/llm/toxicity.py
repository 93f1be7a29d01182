"""Toxicity: a counterfactually regularised linear classifier over words and word beginnings.

Features are the distinct hashed words of a text and the beginnings of its words (which carry the stem in
inflected languages). Sentences of the labelled sample that mention a group are copied with the mention
swapped for another group, and the fit pays for every change of score between the two, so neutral mentions
of a group do not make a text toxic. The sample of labelled rows is bounded; scoring covers every text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sirenlake.functions.session import cut_lineage

from .common import NO_LETTER, Words, mix, pieces

BUCKETS = 1 << 18
STEMS = (4, 5, 6, 7, 8)  # bytes
SENTENCE = re.compile(r"[^.!?\n]+")

# Group mentions that are swapped for one another.
IDENTITY_TERMS = (
    "women", "men", "girls", "boys", "lesbian", "gay", "straight", "transgender", "christians", "muslims", "jews", "hindus",
    "buddhists", "atheists", "black", "white", "asian", "latino", "african", "european", "immigrants", "refugees", "disabled",
    "deaf", "blind", "elderly", "frauen", "männer", "muslime", "juden", "femmes", "hommes", "musulmans", "juifs", "mujeres",
    "hombres", "musulmanes", "judíos",
)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features and the document of each; a feature comes as often as it occurs."""
    words = Words(data, offsets, gaps=NO_LETTER)
    found, docs = [words.hashes], [words.doc]
    for stem in STEMS:
        long = words.end - words.start >= stem
        start = words.start[long]
        found.append(mix(words.spans(start, start + stem) + np.uint64(stem)))
        docs.append(words.doc[long])
    return (np.concatenate(found) % np.uint64(BUCKETS)).astype(np.int64), np.concatenate(docs)


def distinct_features(data: np.ndarray, offsets: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, feature) pairs among the wanted features (a flag per bucket)."""
    found, docs = features(data, offsets)
    keep = wanted[found]
    pairs = np.unique(docs[keep] * BUCKETS + found[keep])
    return pairs // BUCKETS, pairs % BUCKETS


def text_features(text: str) -> set[int]:
    data = np.frombuffer(text.encode(), np.uint8)
    return set(features(data, np.array([0, len(data)]))[0].tolist())


@dataclass(frozen=True)
class ToxicityModel:
    """Weight per bucket and intercept."""

    weights: np.ndarray
    intercept: float

    def score_texts(self, texts: Sequence[str | None]) -> np.ndarray:
        batch = pa.record_batch([pa.array(texts, pa.string())], ["text"])
        return np.concatenate([self.score(data, offsets) for _, _, data, offsets in pieces(batch)] or [np.zeros(0)])

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        doc, feature = distinct_features(data, offsets, self.weights != 0)
        total = self.intercept + np.bincount(doc, self.weights[feature], len(offsets) - 1)
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def swapped_sentences(text: str, terms: Sequence[str] = IDENTITY_TERMS) -> Iterator[tuple[str, str]]:
    """Sentences that name a group, each with a copy for the group two and seven places on."""
    place = {t: i for i, t in enumerate(terms)}
    named = re.compile(r"\b(" + "|".join(map(re.escape, terms)) + r")\b", re.IGNORECASE)
    if not named.search(text):
        return
    for sentence in SENTENCE.findall(text):
        if named.search(sentence):
            for step in (2, 7):
                yield sentence, named.sub(lambda m: terms[(place[m[1].lower()] + step) % len(terms)], sentence)


def fit_weights(
    rows: list[np.ndarray], toxic: np.ndarray, weight: np.ndarray, swaps: list[tuple[np.ndarray, np.ndarray]], size: int,
    ridge: float | np.ndarray = 0.5, counterfactual: float = 5.0, steps: int = 400,
) -> tuple[np.ndarray, float]:
    """Accelerated gradient descent on weighted logistic loss + ridge + counterfactual penalty.

    ``rows`` holds the feature numbers (below ``size``) present in each row, ``swaps`` the features that a
    swapped sentence loses and gains. The penalty is ``counterfactual`` times the sum of squared changes.
    """
    col = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    s_col = np.concatenate([np.concatenate(s) for s in swaps] or [np.zeros(0)]).astype(np.int64)
    s_row = np.repeat(np.arange(len(swaps)), [len(a) + len(b) for a, b in swaps])
    s_sign = np.concatenate([np.concatenate([-np.ones(len(a)), np.ones(len(b))]) for a, b in swaps] or [np.zeros(0)])
    n, total = len(rows), weight.sum()

    def gradient(w: np.ndarray, b: float) -> tuple[np.ndarray, float]:
        p = 1 / (1 + np.exp(-np.clip(b + np.bincount(row, w[col], n), -50, 50)))
        slope = weight * (p - toxic)
        change = np.bincount(s_row, s_sign * w[s_col], len(swaps)) if len(swaps) else np.zeros(0)
        g = np.bincount(col, slope[row], size) + ridge * w
        if len(swaps):
            g += 2 * counterfactual * np.bincount(s_col, s_sign * change[s_row], size)
        return g, slope.sum()

    # curvature per weight bounds the steps: a diagonal preconditioner for rows with very many features
    per_row = np.bincount(row, minlength=n) + 1
    curve = 0.25 * np.bincount(col, (weight * per_row)[row], size) + ridge
    if len(swaps):
        curve += 2 * counterfactual * np.bincount(s_col, np.bincount(s_row, minlength=len(swaps))[s_row], size)
    curve_b = 0.25 * (weight * per_row).sum() + 1e-9
    share = np.clip((weight * toxic).sum() / max(total, 1e-9), 1e-4, 1 - 1e-4)
    w, b = np.zeros(size), float(np.log(share / (1 - share)))
    v, vb, speed = w.copy(), b, 1.0
    for _ in range(steps):
        g, gb = gradient(v, vb)
        new, new_b = v - g / curve, vb - gb / curve_b
        faster = (1 + (1 + 4 * speed**2) ** 0.5) / 2
        v, vb = new + (speed - 1) / faster * (new - w), new_b + (speed - 1) / faster * (new_b - b)
        w, b, speed = new, new_b, faster
    return w, b


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, per_class: int = 8000, keep: int = 8192, terms: Sequence[str] = IDENTITY_TERMS, counterfactual: float = 5.0, strength: float = 0.1, power: float = 1.0
) -> ToxicityModel:
    """Fit on at most ``per_class`` labelled rows of each class, the first by a hash of ``doc_id``.

    Of a class with more rows the sampled ones weigh more, so scores follow the true shares. The ``keep``
    features with the highest information about the label are used, and those of the identity terms.
    NULL labels and ids are left out, of repeated labels the highest counts, and repeated documents count once
    each. Without rows of both classes every text scores the share of toxic rows (0 without labels).
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if not counts.get(0) or not counts.get(1):
        return ToxicityModel(np.zeros(BUCKETS), -500.0 if not counts.get(1) else 500.0)
    parts = [known.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)]
    chosen = parts[0].union(parts[1])  # at most 2 * per_class rows, so small enough for a broadcast
    sample = cut_lineage(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"))

    def statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False)
            for row, _, data, offsets in pieces(batch):
                doc, feature = distinct_features(data, offsets, np.ones(BUCKETS, bool))
                for c in (0, 1):
                    seen[c] += np.bincount(feature[toxic[row + doc] == c], minlength=BUCKETS)
        at = np.flatnonzero(seen.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[0, at]), pa.array(seen[1, at])], ["feature", "clean", "toxic"])

    n = [min(counts[c], per_class) for c in (0, 1)]
    seen = sample.select("text", "toxic").mapInArrow(statistics, "feature long, clean long, toxic long").groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    p, q = (F.col("toxic") + 0.5) / (n[1] + 1.0), (F.col("clean") + 0.5) / (n[0] + 1.0)
    gain = F.abs(p * F.log(p / q) + (1 - p) * F.log((1 - p) / (1 - q))) + F.abs(q * F.log(q / p) + (1 - q) * F.log((1 - q) / (1 - p)))
    top = seen.where(F.col("clean") + F.col("toxic") >= 3).orderBy(gain.desc(), "feature").limit(keep).select("feature", gain.alias("gain")).toPandas()
    named = sorted(set().union(*(text_features(t) for t in terms)) if terms else [])
    chosen_features = np.unique(np.concatenate([top["feature"].to_numpy(np.int64), np.array(named, np.int64)]))
    evidence = np.ones(BUCKETS)  # twice the log-likelihood ratio of a feature alone; weak features pay more for their weight
    evidence[top["feature"]] = np.maximum(top["gain"] * 2 * min(n), 1)
    ridge = strength * (20 / evidence[chosen_features]) ** power
    number = np.full(BUCKETS, -1, np.int64)
    number[chosen_features] = np.arange(len(chosen_features))

    def rows_and_swaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("toxic", pa.int32()), ("has", pa.binary()), ("gains", pa.binary())])
        for batch in batches:
            toxic, texts, out = batch.column("toxic").to_pylist(), batch.column("text"), []
            for row, end, data, offsets in pieces(batch):
                doc, feature = distinct_features(data, offsets, number >= 0)
                cuts = np.searchsorted(doc, np.arange(end - row + 1))
                out += [(toxic[row + k], number[feature[a:b]].astype(np.int32).tobytes(), None) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:]))]
            for text in texts:
                for plain, swapped in swapped_sentences(text.as_py() or "", terms):
                    a, b = ({int(number[f]) for f in text_features(s) if number[f] >= 0} for s in (plain, swapped))
                    out.append((None, np.array(sorted(a - b), np.int32).tobytes(), np.array(sorted(b - a), np.int32).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], f.type) for k, f in enumerate(schema)], schema=schema)

    fit = sample.select("text", "toxic").mapInArrow(rows_and_swaps, "toxic int, has binary, gains binary").toPandas()
    rows = fit[fit.gains.isna()]
    swaps = [(np.frombuffer(a, np.int32), np.frombuffer(b, np.int32)) for a, b in zip(*(fit[fit.gains.notna()][c] for c in ("has", "gains")))]
    toxic = rows.toxic.to_numpy().astype(np.int64)
    weight = np.array([counts[c] / n[c] for c in (0, 1)])[toxic]
    weight *= len(weight) / max(weight.sum(), 1e-9)
    w, b = fit_weights([np.frombuffer(h, np.int32) for h in rows.has], toxic, weight, swaps, len(chosen_features), ridge, counterfactual)
    weights = np.zeros(BUCKETS, np.float32)
    weights[chosen_features] = w
    return ToxicityModel(weights, b)


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``docs`` with ``_toxicity`` (0 to 1) for every whole text; NULL and empty texts score the intercept.

    Text columns are not touched; repeated rows stay; an empty table stays empty.
    """
    names = docs.columns

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            scores = np.concatenate([model.score(data, offsets) for _, _, data, offsets in pieces(batch)] or [np.zeros(0)])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], [*names, "_toxicity"])

    schema = type(docs.schema)([*docs.schema.fields]).add("_toxicity", "double")
    return docs.mapInArrow(batches, schema)


def labelled_for_training(labels: DataFrame) -> DataFrame:
    """Labels outside the held-out third (crc32 of the id as text, modulo 3, is 1)."""
    return labels.where(~held_out("doc_id"))


def held_out(doc_id: str):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def judge_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` per document (a NULL id is not held out)."""
    model = fit_toxicity(docs, labelled_for_training(labels))
    scored = score_toxicity(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), F.col("_toxicity").alias("score"), (F.col("_toxicity") >= threshold).cast("int").alias("predicted"))
