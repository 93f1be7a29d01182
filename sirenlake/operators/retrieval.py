"""Batch retrieval, citations and retrieval evaluation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranking import interpolate, interpolated_ranks, order_statistics
from ..functions.session import cut_lineage
from ..functions.semantics import clamp, col, round_even, strip, unnest

TOP_K = 5
SNIPPET_CHARS = 260
BULLET_CHARS = 220
GRAM = 3
LEADING = 3

# Words that never count as search terms (shorter words are dropped by length).
STOPWORDS = (
    "about", "against", "answer", "could", "does", "from", "have", "into", "that", "the", "this",
    "what", "when", "where", "which", "with", "would", "your",
)
NO_ANSWER = "No answer was found in the indexed documents."

# Metadata keys that may name a document, and file endings to drop.
ID_KEYS = ("source_id", "source", "source_file", "file_name", "title", "category")
FILE_ENDINGS = (".md", ".txt", ".pdf", ".json", ".jsonl")

# Evaluation targets.
PRECISION_TARGET = 0.6
FAITHFULNESS_TARGET = 1.5
P50_TARGET_S = 3.0
P95_TARGET_S = 8.0


# Keyword search


def query_terms(queries: DataFrame, query_id: str, question: str) -> DataFrame:
    """(query, term, times, lead, leads): search terms, how often each occurs, whether it is among
    the first three, and how many different terms those three are."""
    tokens = F.regexp_extract_all(F.lower(question), F.lit("[a-z0-9]+"), F.lit(0))
    terms = F.filter(tokens, lambda t: (F.length(t) > 2) & ~t.isin(*STOPWORDS))
    kept = queries.select(F.col(query_id).alias("query_id"), terms.alias("terms"))
    kept = kept.withColumn("leads", F.size(F.array_distinct(F.slice("terms", 1, LEADING))))
    placed = unnest(kept, ["query_id", "leads"], "terms", "term", "pos")
    return placed.groupBy("query_id", "term").agg(
        F.count("*").alias("times"), (F.min("pos") < LEADING).alias("lead"), F.max("leads").alias("leads")
    )


def _grams(c: Column) -> Column:
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - (GRAM - 1)), lambda i: F.substring(c, i, GRAM)))


def keyword_rank(
    queries: DataFrame, documents: DataFrame, query_id: str, question: str, doc_id: str, fields: Sequence[str], k: int = TOP_K
) -> DataFrame:
    """Top ``k`` documents per query by non-overlapping substring counts of its terms, plus 5 when
    the first three terms all occur; ties go to the lower document id.

    A term is plain letters and digits, so it can only occur inside a token of the text. Terms
    are matched against the vocabulary (joined on three-letter pieces), not against every text,
    and documents meet the matches on the token. The matches then go by document, where everything up to the
    top-k inside each task happens without another shuffle; terms are numbered and written, so Spark knows how small they are.
    """
    terms = cut_lineage(query_terms(queries, query_id, question))
    numbered = cut_lineage(terms.select("term").distinct().withColumn("term_no", F.monotonically_increasing_id()))
    text = F.lower(F.concat_ws(" ", *fields))

    def tokens(texts: DataFrame) -> DataFrame:
        return unnest(texts, ["doc_id"], F.regexp_extract_all("text", F.lit("[a-z0-9]{3,}"), F.lit(0)), "token").drop("position")

    texts = documents.select(F.col(doc_id).alias("doc_id"), text.alias("text"))
    vocabulary = unnest(tokens(texts).select("token").distinct(), ["token"], _grams(F.col("token")), "gram").drop("position")
    wanted = numbered.withColumn("gram", F.substring("term", 1, GRAM))
    times = (F.length("token") - F.length(F.replace(F.col("token"), F.col("term"), F.lit("")))) / F.length("term")
    matches = cut_lineage(
        vocabulary.join(wanted, "gram")
        .where(F.contains("token", "term"))
        .select("token", "term_no", times.cast("bigint").alias("hits"))
    )
    found = (
        tokens(texts.repartition("doc_id")).groupBy("doc_id", "token").agg(F.count("*").alias("tf"))
        .join(matches, "token")
        .select("doc_id", "term_no", (F.col("tf") * F.col("hits")).alias("hits"))
        .repartition("doc_id")
        .groupBy("doc_id", "term_no")
        .agg(F.sum("hits").alias("hits"))
    )
    scored = (
        found.join(cut_lineage(terms.join(numbered, "term").drop("term")), "term_no")
        .groupBy("query_id", "doc_id")
        .agg(F.sum(F.col("hits") * F.col("times")).alias("hits"), F.count_if("lead").alias("leads_found"), F.max("leads").alias("leads"))
        .withColumn("score", F.col("hits") + F.when(F.col("leads_found") == F.col("leads"), 5).otherwise(0))
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    return (
        scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "doc_id", "score", "rank")
    )


# Vector search


def squared_l2(a: Column, b: Column) -> Column:
    gaps = F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return F.aggregate(gaps, F.lit(0.0), lambda s, d: s + d)


MAX_QUERY_BATCH = 10_000


def vector_topk(queries: DataFrame, vectors: DataFrame, query_id: str, vec_id: str, embedding: str = "embedding", k: int = TOP_K, batch: int = MAX_QUERY_BATCH) -> DataFrame:
    """Exact ``k`` nearest vectors per query by squared Euclidean distance.

    The batch of queries is packed into array values of at most ``batch`` queries, so a vector
    row meets it without a join of rows. A bigger set of queries is simply more packs. Vectors are dealt
    to blocks that each meet all packs, so no key holds more than a block. The rank filter lets every task
    keep its own top ``k`` before anything is shuffled.
    """
    blocks = int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packs = queries.groupBy(F.pmod(F.xxhash64(query_id), F.greatest(F.lit(1), F.ceil(queries.agg(F.count("*")).scalar() / batch))).alias("pack")).agg(
        F.collect_list(F.struct(F.col(query_id).alias("query_id"), F.col(embedding).alias("q"))).alias("batch")
    )
    n_packs = packs.agg(F.max("pack")).scalar()
    block = F.pmod(F.xxhash64(vec_id), F.lit(blocks)).alias("block")
    candidates = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("v"), block).withColumn(
        "pack", F.explode(F.sequence(F.lit(0).cast("bigint"), n_packs))
    )
    packs = packs.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))))
    pairs = candidates.join(packs, ["pack", "block"]).select("vec_id", "v", F.explode("batch").alias("b")).select(
        "b.query_id", "vec_id", squared_l2(F.col("b.q"), F.col("v")).alias("distance")
    )
    best = Window.partitionBy("query_id").orderBy("distance", "vec_id")
    return pairs.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def vector_topk_lsh(
    queries: DataFrame, vectors: DataFrame, query_id: str, vec_id: str, embedding: str = "embedding", k: int = TOP_K, radius: float = 1.5, bucket: float = 2.0, tables: int = 4, seed: int = 42
) -> DataFrame:
    """Approximate form: hashed candidates within ``radius``, re-ranked exactly.

    Queries that find fewer than ``k`` candidates are searched exactly, so every query gets its k rows.
    """
    dense = lambda df, i, name: df.select(F.col(i).alias(name), F.col(embedding).alias(f"{name}_e"), array_to_vector(F.col(embedding).cast("array<double>")).alias("vector"))
    q, v = dense(queries, query_id, "query_id"), dense(vectors, vec_id, "vec_id")
    model = BucketedRandomProjectionLSH(inputCol="vector", outputCol="hashes", bucketLength=bucket, numHashTables=tables, seed=seed).fit(v)
    near = model.approxSimilarityJoin(q, v, radius, distCol="approx").select(
        "datasetA.query_id", "datasetB.vec_id", squared_l2(F.col("datasetA.query_id_e"), F.col("datasetB.vec_id_e")).alias("distance")
    )
    best = Window.partitionBy("query_id").orderBy("distance", "vec_id")
    ranked = cut_lineage(near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k))
    full = ranked.where(F.col("rank") == k).select(F.col("query_id").alias(query_id))
    rest = cut_lineage(queries.join(full, query_id, "left_anti"))
    short = vector_topk(rest, vectors, query_id, vec_id, embedding, k)
    return ranked.join(full, F.col("query_id") == full[query_id], "left_semi").unionByName(short.select(*ranked.columns))


def store_integrity(vectors: DataFrame, vec_id: str, embedding: str = "embedding") -> DataFrame:
    """Rows, dimensions, missing vectors, and whether a probe (the first vector) finds another one."""
    dims = F.size(embedding)
    probe = vectors.where(F.col(embedding).isNotNull()).agg(F.min_by(embedding, F.col(vec_id))).scalar()
    first = vectors.where(F.col(embedding).isNotNull()).agg(F.min(vec_id)).scalar()
    probed = vectors.withColumn("_probe", probe).where(F.col(vec_id) != first)
    nearest = probed.agg(F.min(squared_l2(F.col(embedding), F.col("_probe")))).scalar()
    out = vectors.agg(
        F.count("*").alias("rows"), F.count_if(F.col(embedding).isNull()).alias("missing"), F.min(dims).alias("min_dim"), F.max(dims).alias("max_dim")
    )
    hit = F.coalesce(nearest >= 0, F.lit(False))
    sound = (F.col("rows") > 0) & (F.col("missing") == 0) & (F.col("min_dim") == F.col("max_dim")) & hit
    return out.withColumns({"probe_hit": hit, "is_sound": F.coalesce(sound, F.lit(False))})


# Citations and extractive answers (input: retrieved rows per query with a rank)


def optional_int(c: Column | str) -> Column:
    return strip(col(c).cast("string")).try_cast("int")


def snippet(c: Column | str, limit: int = SNIPPET_CHARS) -> Column:
    one_line = strip(F.regexp_replace(F.coalesce(col(c), F.lit("")), r"\s+", " "))
    cut = F.concat(F.rtrim(F.substring(one_line, 1, limit - 3)), F.lit("..."))
    return F.when(F.length(one_line) <= limit, one_line).otherwise(cut)


def _citation(df: DataFrame) -> DataFrame:
    source = F.coalesce("source_id", F.lit(""))
    return df.withColumns(
        {"source_id": source, "title": F.coalesce(F.nullif("title", F.lit("")), source), "chunk_index": optional_int("chunk_index")}
    )


def dedupe_citations(retrieved: DataFrame, query_id: str = "query_id") -> DataFrame:
    """The best-ranked citation per (source, title, chunk index) with its label and snippet."""
    rest = [c for c in retrieved.columns if c not in (query_id, "source_id", "title", "chunk_index")]
    first = (
        _citation(retrieved)
        .groupBy(query_id, "source_id", "title", "chunk_index")
        .agg(F.min_by(F.struct(*rest), F.col("rank")).alias("r"))
        .select(query_id, "source_id", "title", "chunk_index", "r.*")
    )
    chunk = F.coalesce(F.concat(F.lit("; chunk: "), F.col("chunk_index").cast("string")), F.lit(""))
    name = F.coalesce(F.nullif("title", F.lit("")), F.lit("unknown source"))
    return first.withColumns(
        {"citation": F.concat(F.lit("[source: "), name, chunk, F.lit("]")), "snippet": snippet("text")}
    )


def source_summary(retrieved: DataFrame, query_id: str = "query_id", limit: int = 3) -> DataFrame:
    """The first distinct titles per query joined by "; " (at most ``limit`` reach the string)."""
    named = _citation(retrieved).withColumn("name", strip("title")).where(F.col("name") != "")
    firsts = named.groupBy(query_id, "name").agg(F.min("rank").alias("rank"))
    top = firsts.withColumn("r", F.row_number().over(Window.partitionBy(query_id).orderBy("rank", "name"))).where(F.col("r") <= limit)
    listed = F.transform(F.array_sort(F.collect_list(F.struct("r", "name"))), lambda s: s["name"])
    return top.groupBy(query_id).agg(F.array_join(listed, "; ").alias("summary"))


def displayable_sources(retrieved: DataFrame, query_id: str = "query_id") -> DataFrame:
    """One row per query and source among the rows that carry a link."""
    key = F.nullif(strip(F.coalesce(F.nullif("source_id", F.lit("")), F.col("title"), F.lit(""))), F.lit(""))
    linked = retrieved.withColumn("source_key", key).where(F.col("source_key").isNotNull() & (strip("url") != ""))
    rest = [c for c in linked.columns if c not in (query_id, "source_key")]
    return linked.groupBy(query_id, "source_key").agg(F.min_by(F.struct(*rest), F.col("rank")).alias("r")).select(query_id, "source_key", "r.*")


def extractive_answer(questions: DataFrame, retrieved: DataFrame, query_id: str = "query_id", bullets: int = 2) -> DataFrame:
    """Best snippets as bullets plus the source summary; a fixed sentence when nothing was found."""
    best = retrieved.withColumn("r", F.row_number().over(Window.partitionBy(query_id).orderBy("rank"))).where(F.col("r") <= bullets)
    lines = F.transform(F.array_sort(F.collect_list(F.struct("r", F.concat(F.lit("- "), snippet("text", BULLET_CHARS)).alias("line")))), lambda s: s["line"])
    body = best.groupBy(query_id).agg(F.array_join(lines, "\n").alias("body"))
    joined = questions.select(query_id).distinct().join(body, query_id, "left").join(source_summary(retrieved, query_id), query_id, "left")
    tail = F.coalesce(F.concat(F.lit("\n\nSources: "), F.col("summary")), F.lit(""))
    answer = F.concat(F.lit("Based on the retrieved documents:\n\n"), F.col("body"), tail)
    return joined.select(query_id, F.coalesce(answer, F.lit(NO_ANSWER)).alias("answer"))


def answer_text(answers: DataFrame, citations: DataFrame, query_id: str = "query_id") -> DataFrame:
    """The answer followed by its citation list, for plain-text output."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("rank", "citation"))), lambda s: F.concat(F.lit("- "), s["citation"]))
    listed = citations.groupBy(query_id).agg(F.array_join(ordered, "\n").alias("lines"))
    tail = F.coalesce(F.concat(F.lit("\n\nSources:\n"), F.col("lines")), F.lit(""))
    return answers.join(listed, query_id, "left").select(query_id, F.concat("answer", tail).alias("answer_text"))


def strip_markers(c: Column | str) -> Column:
    return strip(F.regexp_replace(col(c), r"(?i)\s*\[source:[^\]]*\]\s*", " "))


# Evaluation


def normalise_source_id(c: Column | str) -> Column:
    """Last path part without a known file ending, as a slug; empty text for nothing."""
    text = F.regexp_replace(F.lower(strip(F.coalesce(col(c), F.lit("")))), r"\\", "/")
    name = F.element_at(F.split(text, "/"), -1)
    endings = "|".join(e[1:] for e in FILE_ENDINGS)
    slug = F.regexp_replace(F.regexp_replace(name, rf"\.({endings})$", ""), "[^a-z0-9]+", "_")
    return F.btrim(slug, F.lit("_"))


def metadata_ids(df: DataFrame, name: str = "candidate_ids", keys: Sequence[str] = ID_KEYS) -> DataFrame:
    """Distinct normalised document ids found under any of the metadata keys, sorted."""
    ids = F.array(*[normalise_source_id(c) for c in keys if c in df.columns])
    return df.withColumn(name, F.array_sort(F.array_distinct(F.filter(ids, lambda i: i != ""))))


def precision_at_k(retrieved: DataFrame, expected: DataFrame, query_id: str = "query_id", k: int = TOP_K) -> DataFrame:
    """Relevant results among the first ``k``, divided by ``k`` even when fewer came back.

    ``retrieved`` holds rank and candidate_ids, ``expected`` the relevant ids per query.
    """
    top = retrieved.where(F.col("rank") <= k).select(query_id, "rank", "candidate_ids")
    relevant = F.count_if(F.arrays_overlap("expected_ids", "candidate_ids"))
    per = expected.join(top, query_id, "left").groupBy(query_id).agg(F.count("rank").alias("retrieved"), relevant.alias("relevant"))
    return per.withColumn("precision_at_k", F.col("relevant") / F.lit(float(k)))


def precision_summary(per_query: DataFrame, target: float = PRECISION_TARGET) -> DataFrame:
    mean = F.coalesce(F.avg("precision_at_k"), F.lit(0.0))
    return per_query.agg(F.count("*").alias("queries"), round_even(mean, 6).alias("mean_precision"), (round_even(mean, 6) >= target).alias("passes"))


# How a score stands in loose text, and the note on a reply that holds none.
LOOSE_SCORE = r'(?i)score["\s:]+(-?\d+(?:\.\d+)?)'
UNREAD = "Could not parse judge response: "


def judge_parse(df: DataFrame, response: str = "response") -> DataFrame:
    """Score (0 to 3) and reasoning from a judge's reply.

    A JSON object anywhere in the reply wins; else a number after the word "score"; else 0.
    """
    text = F.col(response)
    blob = F.regexp_extract(text, r"(?s)\{.*\}", 0)
    doc = F.try_parse_json(F.nullif(blob, F.lit("")))
    given = F.try_variant_get(doc, "$.score", "string")
    number = F.when(doc.isNotNull(), F.coalesce(given, F.lit("0")).try_cast("double"))
    loose = F.regexp_extract(text, LOOSE_SCORE, 1).try_cast("double")
    limit = lambda c: F.when(c.isNotNull(), clamp(c, 0.0, 3.0))
    unread = F.concat(F.lit(UNREAD), F.substring(text, 1, 200))
    return df.withColumns(
        {
            "score": F.coalesce(limit(number), limit(loose), F.lit(0.0)),
            "reasoning": F.when(number.isNotNull(), F.coalesce(F.try_variant_get(doc, "$.reasoning", "string"), F.lit("")))
            .when(loose.isNotNull(), strip(text))
            .otherwise(unread),
        }
    )


def faithfulness_summary(judged: DataFrame, error: str = "is_error", target: float = FAITHFULNESS_TARGET) -> DataFrame:
    mean = F.coalesce(F.avg(F.when(~F.col(error), F.col("score"))), F.lit(0.0))
    return judged.agg(
        F.count_if(~F.col(error)).alias("scored"), round_even(mean, 6).alias("mean_faithfulness"), (round_even(mean, 6) >= target).alias("passes")
    )


def latency_percentiles(df: DataFrame, seconds: str = "latency_s", success: str = "success") -> DataFrame:
    """p50 (interpolated), nearest-rank p95, mean, min, max and count of the successful calls.

    Without any success the percentiles are infinite.
    """
    ok = df.where(F.col(success))
    found = order_statistics(ok, seconds, interpolated_ranks("p50", 0.5) | {"p95": lambda n: -(-n * 95 // 100)})
    never = lambda c: F.coalesce(c.cast("double"), F.lit(float("inf")))
    return ok.agg(
        F.count(seconds).alias("n"),
        never(round_even(F.lit(interpolate(found, "p50", 0.5)).cast("double"), 6)).alias("p50"),
        never(F.lit(found["p95"])).alias("p95"),
        never(round_even(F.avg(seconds), 6)).alias("mean"),
        F.min(seconds).alias("min"),
        F.max(seconds).alias("max"),
    ).withColumn("passes", (F.col("p50") <= P50_TARGET_S) & (F.col("p95") <= P95_TARGET_S))


def eval_summary(components: Sequence[DataFrame]) -> DataFrame:
    """Overall verdict: every component that ran has passed; false when none ran.

    Each component is a one-row table with a column ``passes``.
    """
    verdicts = components[0].select("passes")
    for c in components[1:]:
        verdicts = verdicts.unionByName(c.select("passes"))
    return verdicts.agg(F.count("passes").alias("components"), F.coalesce(F.bool_and("passes"), F.lit(False)).alias("all_pass"))
