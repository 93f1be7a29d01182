"""PII: base patterns, and candidate spans judged by gradient-boosted trees.

Base spans are found by four stated patterns and always stay. High-recall generators propose further spans
that look like an address or number in another form; they may overlap. Trees learn from evidence: candidates
that a base span confirms are positive, and so are base spans rewritten into the wider forms; candidates that fail
the check of their kind or lie in a base span of another kind are negative. A candidate that touches no base span and
passes its check is not labelled, as it may be what the base patterns miss. The features are shape, digits, separators, checks of the kind and the words around. So a number that a base pattern misses
because it runs on into the next one is found if it looks like those that are confirmed. A threshold per
kind, calibrated on candidates that took no part in the fit, selects further spans. DataFrame operations only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sirenlake.functions.session import cut_lineage

KINDS = ("email", "ip", "card", "phone")

# Possessive loops and the looks behind skip starts that cannot match, so long runs take linear time.
# The matches are those of the plain patterns.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

# Generators: wider forms of each kind.
WIDE = {
    "email": r"(?<![^\s<(\[\"',;:])[A-Za-z0-9._%+-]{1,64}+\s?(?:@|\(at\)|\[at\]|\{at\})\s?[A-Za-z0-9-]{1,63}+(?:\s?(?:\.|\(dot\)|\[dot\]|\{dot\})\s?[A-Za-z0-9-]{1,63}+)++",
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?:\s?(?:\.|\[\.\]|\(\.\))\s?[0-9]{1,3}+){3}(?![0-9.])",
    "card": r"(?<![0-9A-Za-z])[0-9]{4}[\x20./_-]{0,2}[0-9]{4,6}[\x20./_-]{0,2}[0-9]{4,5}(?:[\x20./_-]{0,2}[0-9]{1,4})?(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z+])(?:\+|00)?\(?[0-9]{1,4}\)?[\x20./-]{0,2}\(?[0-9]{2,4}\)?[\x20./-]{1,2}[0-9]{3,4}(?:[\x20./-]{0,2}[0-9]{2,4})?(?![0-9A-Za-z])",
}

FEATURES = ("kind_no", "length", "digits", "letters", "separators", "groups", "longest_group", "marks", "digit_before", "cue", "upper_next", "line_start", "checks")
CUES = r"(?i)(?:e-?mail|mail|contact|write|tel|phone|call|fax|mobile|card|visa|credit|iban|account|ip|host|server|address)[^\n]{0,12}$"


def luhn(number: Column) -> Column:
    """Does a text of digits pass the Luhn check?"""
    digits = F.transform(F.split(F.reverse(number), ""), lambda d: d.cast("int"))
    double = lambda d: F.when(d > 4, 2 * d - 9).otherwise(2 * d)
    total = F.aggregate(F.transform(digits, lambda d, i: F.when(i % 2 == 1, double(d)).otherwise(d)), F.lit(0), lambda a, d: a + d)
    return total % 10 == 0


def valid(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return F.forall(F.regexp_extract_all(match, F.lit("[0-9]+"), 0), lambda p: F.coalesce(F.regexp_replace(p, "^0+(?=.)", "").try_cast("int"), F.lit(256)) <= 255)
    if kind == "card":
        return F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _matches(text: Column, pattern: str, kind: str, base: bool) -> Column:
    """One struct per leftmost non-overlapping match: its number, the code points since the last one, text around."""
    found = F.regexp_extract_all(text, F.lit(pattern), 0)
    gaps = F.split(text, pattern, -1)
    after = F.slice(gaps, 2, F.greatest(F.size(gaps) - 1, F.lit(0)))
    item = lambda x, i: F.struct(
        F.lit(base).alias("base"), F.lit(kind).alias("kind"), i.alias("no"), F.length(x["gap"]).alias("gap"), x["match"].alias("match"),
        F.right(x["gap"], F.lit(30)).alias("before"), F.left(x["after"], F.lit(3)).alias("after"),
    )
    zipped = F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("gap"), found.alias("match"), after.alias("after"))
    none = F.array().cast("array<struct<base:boolean,kind:string,no:int,gap:int,match:string,before:string,after:string>>")
    return F.when(text.rlike(pattern), F.transform(zipped, item)).otherwise(none)


def find_spans(docs: DataFrame) -> DataFrame:
    """Matches of all base patterns and generators: ``doc_id``, ``copy``, ``base``, ``kind``, ``start``, ``end``, ``match``, ``before``, ``after``, ``valid``.

    Positions are code points. ``copy`` is a hash of the text; repeated rows give each match once.
    """
    text = F.col("text")
    both = [_matches(text, pattern, kind, base) for base, patterns in ((True, BASE), (False, WIDE)) for kind, pattern in patterns.items()]
    rows = docs.select("doc_id", F.xxhash64("text").alias("copy"), F.inline(F.concat(*both)))
    rows = rows.dropDuplicates(["doc_id", "copy", "base", "kind", "no"])
    order = Window.partitionBy("doc_id", "copy", "base", "kind").orderBy("no")
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.length("match")).over(order)).withColumn("start", F.col("end") - F.length("match"))
    passes = F.lit(True)
    for kind in KINDS:
        passes = F.when(F.col("kind") == kind, valid(kind, F.col("match"))).otherwise(passes)
    return rows.withColumn("valid", passes).where(~F.col("base") | F.col("valid")).drop("no", "gap")


def evident(rows: DataFrame) -> Column:
    """Does a span pass the check of its kind? Addresses end in letters and do not run over the end of a sentence."""
    address = F.col("match").rlike(r"[A-Za-z]{2}$") & ~F.col("match").rlike(r"\s\.|\.\s")
    return F.when(F.col("kind") == "email", F.col("base") | address).otherwise(F.col("valid"))


def rewritten(rows: DataFrame) -> DataFrame:
    """Base spans in the wider forms, as positive candidates with the features of their new shape."""
    match = F.col("match")
    host = F.substring_index(match, "@", -1)
    digits = F.regexp_replace(match, "[^0-9]", "")
    name = F.substring_index(match, "@", 1)
    forms = {
        "email": [F.concat(name, F.lit(f" {a} "), F.replace(host, F.lit("."), F.lit(f" {d} "))) for a, d in (("(at)", "(dot)"), ("[at]", "[dot]"))],
        "ip": [F.replace(match, F.lit("."), F.lit("[.]"))],
        "card": [F.regexp_replace(digits, "^(....)(....)(....)", "$1.$2.$3.")],
        "phone": [F.regexp_replace(match, r"^\+", "")],
    }
    forms = {kind: F.array(*of) for kind, of in forms.items()}
    every = F.lit(None).cast("array<string>")
    for kind, of in forms.items():
        every = F.when(F.col("kind") == kind, of).otherwise(every)
    spans = rows.where("base").withColumn("match", F.explode(every)).withColumns({"base": F.lit(False), "touches": F.lit(True), "confirmed": F.lit(True)})
    return shapes(spans)


def shapes(rows: DataFrame) -> DataFrame:
    """Format and context of every span."""
    match, size = F.col("match"), F.length("match")
    digits = F.length(F.regexp_replace(match, "[^0-9]", ""))
    letters = F.length(F.regexp_replace(match, "[^A-Za-z]", ""))
    groups = F.regexp_extract_all(match, F.lit("[0-9]+"), 0)
    number = {
        "kind_no": F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")),
        "length": size,
        "digits": digits,
        "letters": letters,
        "separators": size - digits - letters,
        "groups": F.size(groups),
        "longest_group": F.coalesce(F.array_max(F.transform(groups, F.length)), F.lit(0)),
        "marks": match.rlike(r"[()\[\]{}]").cast("int"),
        "digit_before": F.col("before").rlike("[0-9]$").cast("int"),
        "cue": F.col("before").rlike(CUES).cast("int"),
        "upper_next": F.col("after").rlike(r"^\s?\p{Lu}").cast("int"),
        "line_start": F.col("before").rlike(r"(^|\n)\s*$").cast("int"),
        "checks": evident(rows).cast("int"),
    }
    return rows.withColumns({name: value.cast("double") for name, value in number.items()})


def candidate_features(rows: DataFrame) -> DataFrame:
    """Format and context of every span, and how it lies to the base spans of its document."""
    by_start = Window.partitionBy("doc_id", "copy").orderBy("start", "end")
    end_before = F.max(F.when(F.col("base"), F.col("end"))).over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    start_after = F.min(F.when(F.col("base"), F.col("start"))).over(by_start.rowsBetween(1, Window.unboundedFollowing))
    of_kind = by_start.partitionBy("doc_id", "copy", "kind")
    kind_before = F.max(F.when(F.col("base"), F.col("end"))).over(of_kind.rowsBetween(Window.unboundedPreceding, -1))
    kind_after = F.min(F.when(F.col("base"), F.col("start"))).over(of_kind.rowsBetween(1, Window.unboundedFollowing))
    touches = lambda low, high: F.coalesce(low > F.col("start"), F.lit(False)) | F.coalesce(high < F.col("end"), F.lit(False))
    rows = rows.withColumn("touches", touches(end_before, start_after)).withColumn("confirmed", touches(kind_before, kind_after))
    return shapes(rows)


@dataclass(frozen=True)
class SpanModel:
    """Trees and the threshold per kind; None where the data allow no fit."""

    trees: GBTClassificationModel | None
    thresholds: dict[str, float]


def _scored(candidates: DataFrame, trees: GBTClassificationModel) -> DataFrame:
    packed = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(candidates)
    return trees.transform(packed).withColumn("score", vector_to_array("probability")[1])


def fit_spans(candidates: DataFrame, precision: float = 0.95, floor: float = 0.5, seed: int = 1) -> SpanModel:
    """Fit on all labelled candidates but a quarter, by a hash of document and place, on which to calibrate.

    A candidate is positive if a base span of its kind confirms it or if it is a rewritten base span, negative if
    it fails its check or lies in a base span of another kind; others are not labelled. A
    kind's threshold is the least score, ``floor`` or more, from which on at least ``precision`` of its
    calibration candidates are positive; kinds without such a score get no further spans.
    """
    known = candidates.where(~F.col("base") & (F.col("confirmed") | F.col("touches") | (F.col("checks") == 0)))
    known = known.unionByName(rewritten(candidates)).withColumn("label", F.col("confirmed").cast("double"))
    turn = F.xxhash64(F.lit(seed), "doc_id", "copy", "kind", "start")
    # dealt and sorted by the hash, as the trees draw their bins from rows in their order
    labelled = cut_lineage(known.select("kind", "label", turn.alias("turn"), *FEATURES).repartition("turn").sortWithinPartitions("turn", "kind", "label", *FEATURES))
    fit, check = labelled.where(F.pmod("turn", F.lit(4)) != 0), labelled.where(F.pmod("turn", F.lit(4)) == 0)
    if fit.select("label").distinct().count() < 2:
        return SpanModel(None, {})
    packed = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(fit)
    trees = GBTClassifier(maxIter=12, maxDepth=3, stepSize=0.3, maxBins=32, seed=seed, labelCol="label").fit(packed)
    return SpanModel(trees, span_thresholds(_scored(check, trees), precision, floor))


def span_thresholds(scored: DataFrame, precision: float, floor: float) -> dict[str, float]:
    """The least score of every kind from which on the share of positive rows reaches ``precision``; equal scores are counted first."""
    scores = scored.groupBy("kind", "score").agg(F.count("*").alias("n"), F.sum("label").alias("positive"))
    up = Window.partitionBy("kind").orderBy(F.col("score").desc())
    level = scores.withColumn("share", F.sum("positive").over(up) / F.sum("n").over(up)).where((F.col("share") >= precision) & (F.col("score") >= floor))
    return {r["kind"]: r["t"] for r in level.groupBy("kind").agg(F.min("score").alias("t")).collect()}


def find_personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_email``, ``n_ip``, ``n_card``, ``n_phone``, ``base_sha256``, ``spans`` per document.

    Counts and digest are those of the base spans; ``spans`` lists base and added spans, ``kind:start:end``
    by start and kind. Added spans touch no base span. NULL and empty texts have none. Repeated rows give
    repeated rows, rows of one id with different texts are told apart, NULL ids are documents of their own
    text. Other columns are not read; an empty table gives an empty one.
    """
    rows = cut_lineage(candidate_features(find_spans(docs.select("doc_id", "text"))))
    model = fit_spans(rows)
    chosen = rows.where("base").select("doc_id", "copy", "base", "kind", "start", "end")
    if model.thresholds:
        limit = F.lit(None).cast("double")
        for kind, least in model.thresholds.items():
            limit = F.when(F.col("kind") == kind, F.lit(least)).otherwise(limit)
        added = _scored(rows.where(~F.col("base") & ~F.col("touches")), model.trees).where(F.col("score") >= limit)
        chosen = chosen.union(added.select(*chosen.columns))
    place = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    name = F.concat_ws(":", "kind", "start", "end")
    listed = lambda items: F.array_join(F.transform(F.array_sort(items), lambda s: s["name"]), ",")
    item = F.struct(F.col("start").alias("start"), place.alias("place"), name.alias("name"))
    found = chosen.groupBy("doc_id", "copy").agg(
        *[F.count(F.when(F.col("base") & (F.col("kind") == k), 1)).alias(f"n_{k}") for k in KINDS],
        listed(F.collect_list(F.when(F.col("base"), item))).alias("listed"), listed(F.collect_list(item)).alias("spans"),
    ).withColumnsRenamed({"doc_id": "_doc", "copy": "_copy"})
    given = docs.select("doc_id", F.xxhash64("text").alias("copy"))
    joined = given.join(found, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("copy") == F.col("_copy")), "left")
    counts = [F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS]
    return joined.select("doc_id", *counts, F.sha2(F.coalesce("listed", F.lit("")), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"))
