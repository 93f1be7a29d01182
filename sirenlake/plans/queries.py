"""One entry per operator: key -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import json
from collections.abc import Callable
from html.entities import html5

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.semantics import round_even, unnest
from ..functions.session import cut_lineage, scratch_path
from ..operators import aggregates as A
from ..operators import anomaly as N
from ..operators import boosting
from ..operators import classify as C
from ..operators import clean as P
from ..operators import features as W
from ..operators import forecast as S
from ..operators import joins as J
from ..operators import mapping as M
from ..operators import quality as V
from ..operators import retrieval as R
from ..operators import spatial as K
from ..operators import splits as D
from ..operators import text as T
from ..operators import vector_index
from ..sources import readers, writers
from . import fixtures as X

Query = Callable[[SparkSession, str], DataFrame]
EPS, MIN_SAMPLES = 0.0125, 3
FOREST = {"numTrees": 10, "maxDepth": 5}


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: round_even(F.col(c), digits) for c in columns})


# Sources and sinks


def read_csv_dispatch(s, d):
    path = scratch_path(s, "calls-csv")
    X.dispatch_raw(s, d).write.option("header", True).csv(path)
    return readers.read_csv_dispatch(s, path, "EMS")


def read_census(s, d):
    path = scratch_path(s, "census") + ".csv"
    X.census(s, d).write.option("header", True).csv(path)
    return J.standardise_census(readers.read_census(s, path).withColumn("ord", F.col("ord").cast("bigint")), "ord")


def _chunks(s, d):
    docs = X.documents(s, d).withColumn("pieces", T.chunk_text("text"))
    built = T.build_chunks(docs, "pieces", keep=["doc_id", "title"])
    meta = F.struct(
        F.col("source_id"), F.col("title"), F.lit("doc.txt").alias("file_name"), F.col("chunk_chars"),
        F.struct(F.col("chunk_chars").alias("chars"), F.lit(True).alias("passes")).alias("quality"),
    )
    return built.withColumn("metadata", meta)


def write_chunks_jsonl(s, d):
    path = scratch_path(s, "chunks")
    writers.write_chunks_jsonl(_chunks(s, d).drop("doc_id", "chunk_chars"), path)
    return readers.read_chunks_jsonl(s, path).select("chunk_id", "source_id", "title", "chunk_index", "text", "quality_chars")


def read_chunks_jsonl(s, d):
    return write_chunks_jsonl(s, d).groupBy("source_id").agg(F.count("*").alias("chunks"), F.sum("quality_chars").alias("chars"))


def read_documents(s, d):
    path = scratch_path(s, "documents")
    docs = X.documents(s, d)
    writers.write_documents(docs.select("source_id", F.concat("title", F.lit("\n\n"), "text").alias("value")), path, ["source_id"])
    return readers.read_documents(s, path).select("category", "chars", "passes")


def write_fact_parquet(s, d):
    path = scratch_path(s, "fact")
    writers.write_fact_parquet(X.dispatch(s, d), path)
    return s.read.parquet(path).groupBy("year").agg(F.count("*").alias("rows"))


def write_tables(s, d):
    agg = A.overview_agg(X.dispatch(s, d))
    where = writers.write_tables({"overview": agg, "totals": A.kpi_totals(agg)}, scratch_path(s, "tables"), csv=["totals"])
    return s.read.parquet(where["overview"])


# Cleaning


def _parsed(s, d):
    return P.parse_datetime(X.dispatch_raw(s, d))


def event_time_resolve(s, d):
    calls = X.dispatch(s, d)
    variants = {
        "timestamp": calls,
        "month": calls.withColumn("month", F.month("call_create_time")).drop("call_create_time"),
        "quarter": calls.drop("call_create_time"),
    }
    return J.union_by_name(
        [P.event_time_resolve(v).select("incident_id", F.lit(name).alias("variant"), "ds") for name, v in variants.items()]
    )


def canonicalise_aliases(s, d):
    raw = X.dispatch_raw(s, d).select(
        F.col("call_id_hash").alias("incident_id"), F.col("year_text").alias("year"), F.col("call_year_text").alias("CALL_YEAR"),
        F.col("quarter_text").alias("quarter"), F.lit(None).cast("string").alias("service_type"), "service",
    )
    return P.canonicalise_aliases(raw).select("incident_id", F.col("year").cast("int").alias("year"), "quarter", "service_type")


def apply_dtypes(s, d):
    typed = P.apply_dtypes(X.dispatch_raw(s, d).withColumnsRenamed({"call_year_text": "call_year"}))
    return typed.select(
        "call_id_hash", "call_year", "census_block_group_center__x", "response_time_sec", "geoid"
    )


# Mapping


def _mapped(s, d):
    return M.map_call_group(X.dispatch(s, d), X.call_map(s), X.CALL_RULES)


def _splits(s, d, label="mpds_group"):
    return D.stratified_split(_mapped(s, d), ["incident_id"], label)


def collapse_long_tail(s, d):
    parts = _splits(s, d)
    train = parts.where(F.col("split") == "train")
    return M.collapse_long_tail(train, [parts], "mpds_group", 4)[0].groupBy("split", "mpds_group").agg(F.count("*").alias("n"))


def rare_label_group(s, d):
    labelled = X.dispatch(s, d).withColumn("label", F.concat_ws("/", "city_code", "call_type", "year"))
    return M.rare_label_group(labelled, "label").groupBy("label").agg(F.count("*").alias("n"))


def label_encode(s, d):
    m = _mapped(s, d)
    return M.label_encode(m, M.label_map(m, "mpds_group"), "mpds_group").select("incident_id", "mpds_group", "label_code")


def align_label_space(s, d):
    parts = _splits(s, d)
    train = M.collapse_long_tail(parts.where(F.col("split") == "train"), [parts.where(F.col("split") == "train")], "mpds_group", 4)[0]
    return M.align_label_space(parts, M.label_map(train, "mpds_group"), "mpds_group").groupBy("mpds_group").agg(F.count("*").alias("n"))


# Validation


def _violations(s, d):
    return V.validate_rules(X.dispatch_dirty(s, d)).select("incident_id", F.array_join("violations", ",").alias("violations"))


def quarantine_split(s, d):
    valid, failing = V.quarantine_split(X.dispatch_dirty(s, d))
    tables = valid.select("incident_id", F.lit("").alias("reasons")), failing.select("incident_id", F.array_join("violations", ",").alias("reasons"))
    return tables[0].unionByName(tables[1])


def quarantine_write(s, d):
    """The measures observed while valid and failing rows are written."""
    seen = V.quarantine_write(X.dispatch_dirty(s, d), scratch_path(s, "quarantine"))
    return s.createDataFrame([seen], "valid_count long, invalid_count long, total_count long, mean_completeness double")


def many_to_one_guard(s, d):
    return V.many_to_one_guard(J.standardise_census(X.census(s, d), "ord"), J.KEY)


# Joins


def normalise_geoid(s, d):
    return X.census(s, d).select(F.col("GEOID").alias("geoid"), J.normalise_geoid("GEOID").alias("census_block_group")).distinct()


def standardise_census(s, d):
    out = J.standardise_census(X.census(s, d), "ord")
    return rounded(out, "population_density_per_sq_km", *J.SHARES)


def join_demographics(s, d):
    out = J.join_demographics(X.dispatch(s, d), J.standardise_census(X.census(s, d), "ord"))
    return rounded(out.select("incident_id", "census_block_group", "census_name", "population", "poverty_rate"), "poverty_rate")


def _cells(s, d):
    return A.count_by(A.temporal_heatmap_agg(X.dispatch(s, d)), ["year", "quarter"], measure="call_count")


def join_stats_back(s, d):
    cells = _cells(s, d)
    return rounded(J.join_stats_back(cells, cells, "quarter", "call_count"), "mean", "std")


def join_anomaly_flags(s, d):
    cells = _cells(s, d)
    flags = cells.where(F.col("call_count") > cells.agg(F.avg("call_count")).scalar()).select("year", "quarter", F.lit(True).alias("is_anomaly"))
    return J.join_anomaly_flags(cells, flags)


def code_to_name(s, d):
    names = X.table(s, d, "nation").select(F.concat(F.lit("C"), F.col("n_nationkey").cast("string")).alias("city_code"), F.col("n_name").alias("looked_up"))
    return J.code_to_name(X.dispatch(s, d), names, "city_code").select("incident_id", "city_code", "looked_up")


def union_by_name(s, d):
    calls = X.dispatch(s, d)
    ems = calls.where(F.col("service_type") == "EMS").select("incident_id", "service_type", "city_name")
    fire = calls.where(F.col("service_type") == "Fire").select("incident_id", "service_type", "call_type")
    return J.union_by_name([ems, fire])


def set_intersection_ids(s, d):
    joined = X.retrieved_ids(s, d).join(X.expected_ids(s, d), "query_id")
    return joined.select("query_id", "rank", F.array_join(F.array_sort(J.matched_ids("expected_ids", "candidate_ids")), ",").alias("matched"))


def set_difference_split(s, d):
    parts = D.stratified_split(X.dispatch(s, d), ["incident_id"])
    return parts.select("incident_id", (F.col("split") == "train").alias("in_train"))


# Aggregates


def _overview(s, d):
    return A.overview_agg(X.dispatch(s, d))


def _density(s, d):
    return A.geo_density_agg(X.dispatch(s, d))


def _city(s, d):
    return A.geo_city_agg(X.dispatch(s, d))


def _centroids(s, d):
    return A.cbg_centroids(_density(s, d))


def geo_kpis(s, d):
    clustered = K.dbscan(_centroids(s, d), EPS, MIN_SAMPLES, "census_block_group")
    return A.geo_kpis(_density(s, d), _city(s, d), K.cluster_count(clustered))


def confidence_histogram(s, d):
    return A.histogram(X.predictions(s, d), "max_confidence", 50, 0.0, 1.0, ["is_correct"])


# Features


def cyclical_features(s, d):
    out = W.cyclical_features(X.events_feat(s, d), "ts").select("event_id", "hour", "day_of_week", "month", "hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos")
    return rounded(out, "hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos")


def geo_target_encoding(s, d):
    out = W.geo_target_encoding(X.events_feat(s, d), "user_id", "value")
    return rounded(out.select("event_id", "user_id", "user_id_target_enc"), "user_id_target_enc", digits=9)


def lag_features(s, d):
    out = W.lag_features(X.events_feat(s, d), "value", ["ts", "event_id"], groups=["event_type"])
    return out.select("event_id", "event_type", "value_lag_1", "value_lag_2", "value_lag_3")


def series_features(s, d):
    out = W.series_features(X.series(s, d))
    return rounded(out, "month_sin", "month_cos", "rolling_mean_3", "rolling_mean_6")


def row_share_normalise(s, d):
    return W.row_share_normalise(C.confusion_long(X.predictions(s, d)))


def zscore_scale(s, d):
    out = W.zscore_scale(X.points(s, d), ["latitude", "longitude"])
    return rounded(out.select("census_block_group", "latitude_z", "longitude_z"), "latitude_z", "longitude_z")


# Forecasts


def series_validate(s, d):
    return S.series_validate(X.series(s, d), ["series_id"])


def trend_seasonal_forecast(s, d):
    return rounded(S.trend_seasonal_forecast(X.series(s, d)), "yhat", "yhat_lower", "yhat_upper")


def gbt_lag_forecast(s, d):
    return S.gbt_lag_forecast(X.series(s, d), iterations=10)[1]


def recursive_forecast(s, d):
    ts = cut_lineage(X.series(s, d))
    return S.recursive_forecast(S.gbt_lag_forecast(ts, iterations=10)[0], ts)


def forecast_finalise(s, d):
    trend, _ = X.forecasts(s, d)
    return S.forecast_finalise(X.series(s, d), trend)


def mape(s, d):
    trend, _ = X.forecasts(s, d)
    return S.mape(X.series(s, d).join(trend, ["series_id", "ds"]), keys=["series_id"])


# Classifier


def geo_bitmap_distinct(s, d):
    """Exact distinct block groups of selections that no row of the aggregate holds on its own."""
    fact = X.dispatch(s, d)
    path = scratch_path(s, "bitmaps")
    A.geo_bitmap_agg(fact, A.block_group_positions(fact)).write.parquet(path)
    bitmaps = s.read.parquet(path)
    null = lambda t: F.lit(None).cast(t)
    by_service = A.distinct_block_groups(bitmaps, ["service"]).select("service", null("int").alias("year"), "total_calls", "unique_cbg_count")
    by_year = A.distinct_block_groups(bitmaps, ["year"]).select(null("string").alias("service"), F.col("year").cast("int"), "total_calls", "unique_cbg_count")
    some = A.distinct_block_groups(bitmaps.where("service = 'EMS' AND year >= 1995")).select(F.lit("EMS since").alias("service"), F.lit(1995).alias("year"), "total_calls", "unique_cbg_count")
    return by_service.unionByName(by_year).unionByName(some)


def classifier_frame(s, d):
    return D.classifier_frame(X.dispatch(s, d), ["incident_id"]).select("incident_id", "call_type", "label_code", "quarter", "city_code")


def _modelled(s, d):
    """(train, validation, test) frames with coded labels."""
    coded = D.classifier_frame(_mapped(s, d).drop("call_type"), ["incident_id"], "mpds_group")
    parts = D.split_frames(cut_lineage(D.stratified_split(coded, ["incident_id"], "label_code")))
    return parts["train"], parts["validation"], parts["test"]


def feature_prep(s, d):
    train, _, test = _modelled(s, d)
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    prep = Pipeline(stages=C.feature_prep()).fit(C.as_numbers(train))
    return prep.transform(C.as_numbers(test)).select("incident_id", vector_to_array("features").alias("features"))


def train_classifier(s, d):
    train, validation, _ = _modelled(s, d)
    model = C.train_classifier(train, balanced=True, **FOREST)
    scored = C.predict_confidence(model, validation)
    return C.rounded_class_metrics(C.confusion_long(scored, "label_code", "predicted_code"))


def boosted_classifier(s, d):
    """Metrics by class of boosted trees that stop early by the validation rows."""
    train, validation, test = _modelled(s, d)
    model = boosting.fit_boosted(train, validation, balanced=True, rounds=12, depth=4, rate=0.3, patience=3)
    scored = C.predict_confidence(model, test)
    return C.rounded_class_metrics(C.confusion_long(scored, "label_code", "predicted_code"))


def tune_classifier(s, d):
    train, validation, _ = _modelled(s, d)
    return C.tune_classifier(train, validation, trials=2)


def halve_classifier(s, d):
    train, validation, _ = _modelled(s, d)
    return C.halve_classifier(train, validation, trials=4, rungs=2, keep=0.5)


def predict_confidence(s, d):
    train, _, test = _modelled(s, d)
    scored = C.predict_confidence(C.train_classifier(train, **FOREST), test)
    return scored.select("incident_id", "label_code", "predicted_code", "max_confidence", "is_correct")


def feature_importance(s, d):
    train, _, _ = _modelled(s, d)
    return C.feature_importance(C.train_classifier(train, **FOREST), s)


def model_io(s, d):
    train, _, test = _modelled(s, d)
    path = scratch_path(s, "model")
    writers.save_model(C.train_classifier(train, **FOREST), path)
    model: PipelineModel = writers.load_model(path)
    return C.predict_confidence(model, test).select("incident_id", "predicted_code", "max_confidence")


def score_saved_model(s, d):
    train, _, test = _modelled(s, d)
    path = scratch_path(s, "model")
    writers.save_model(C.train_classifier(train, **FOREST), path)
    return C.score_saved_model(path, test)


def _flagged(s, d):
    return C.flag_disagreements(X.predictions(s, d))


def _injected(s, d):
    return C.inject_label_errors(X.predictions(s, d), "truth_code", 3, ["rid"])


def _class_table(s, d):
    return C.per_class_metrics(C.confusion_long(X.predictions(s, d)))


def metric_gates(s, d):
    f1 = C.overall_metrics(_class_table(s, d)).select(F.lit("macro_f1").alias("metric"), F.col("macro_f1").alias("value"))
    trend, _ = X.forecasts(s, d)
    error = S.mape(X.series(s, d).join(trend, ["series_id", "ds"])).select(F.lit("avg_mape").alias("metric"), F.col("mape").alias("value"))
    recall = N.recall_top_share(X.scored(s, d), "anomaly_score", ["incident_id"]).select(F.lit("iso_forest_recall_20").alias("metric"), F.col("recall").alias("value"))
    return C.metric_gates(f1.unionByName(error).unionByName(recall))


def completeness_trend(s, d):
    return C.completeness_trend(X.predictions(s, d))


def qa_kpis(s, d):
    return C.qa_kpis(P.filter_by(_flagged(s, d), years=[1997, 1998, 1999], services=["EMS"]))


# Spatial and anomaly


def _clustered(s, d):
    return K.dbscan(X.points(s, d), EPS, MIN_SAMPLES, "census_block_group")


def _events_model(s, d):
    """Hour, weekday and month of every event plus its value as the features of the forest."""
    return W.cyclical_features(X.events_feat(s, d), "ts").select(
        "event_id", "event_type", F.col("value").alias("latitude"), F.col("user_id").cast("double").alias("longitude"), "hour", "day_of_week", "month"
    )


def isolation_forest_fit(s, d):
    return N.isolation_forest_fit(_events_model(s, d), ["event_id"])


def isolation_forest_score(s, d):
    frame = _events_model(s, d)
    nodes = cut_lineage(N.isolation_forest_fit(frame, ["event_id"]))
    return N.isolation_forest_score(frame, nodes).select("event_id", round_even(F.col("anomaly_score"), 6).alias("anomaly_score"), "is_anomaly")


# Text and retrieval


def character_references(s, d):
    """References made from the ids of the pages, resolved."""
    names = F.from_json(F.lit(json.dumps(sorted(html5))), "array<string>")
    name = lambda k: F.get(names, (F.col("page_id") * k % len(html5)).cast("int"))
    number = F.col("page_id").cast("string")
    raw = F.concat(
        F.lit("&"), name(7), F.lit(" &"), F.rtrim(name(11), F.lit(";")), number, F.lit(" &#"), number, F.lit(" &#x"), F.hex(F.col("page_id") * 977),
        F.lit(";&#0"), (F.col("page_id") + 55200).cast("string"), F.lit(";&# &; &#xg && &amp;lt;"),
    )
    return X.table(s, d, "pages").select("page_id", T.unescape(raw, exact=True).alias("text"))


def build_chunks(s, d):
    return T.build_chunks(X.doc_lines(s, d), "pieces", keep=["doc_id"])


def paragraph_pack(s, d):
    packs = unnest(X.documents(s, d), ["doc_id"], T.paragraph_pack("text"), "paragraph")
    return packs.select("doc_id", "position", F.length("paragraph").alias("chars"))


def split_long_text(s, d):
    return unnest(X.documents(s, d), ["doc_id"], T.split_long_text("text"), "piece")


def keyword_rank(s, d):
    return R.keyword_rank(X.table(s, d, "benchmark"), X.documents(s, d), "item_id", "text", "doc_id", ["title", "source_id", "text"])


def vector_topk(s, d):
    return rounded(R.vector_topk(X.query_vectors(s, d), X.table(s, d, "embeddings"), "label", "vec_id"), "distance")


def vector_topk_lsh(s, d):
    return rounded(R.vector_topk_lsh(X.query_vectors(s, d), X.table(s, d, "embeddings"), "label", "vec_id"), "distance")


def vector_index_search(s, d):
    """The exact search over a freshly written index."""
    index = vector_index.build_index(X.table(s, d, "embeddings"), "vec_id", scratch_path(s, "index"))
    return rounded(index.search(X.query_vectors(s, d), "label", exact=True), "distance")


def strip_markers(s, d):
    marked = F.concat_ws(" ", "title", F.concat(F.lit("[Source: "), "file_name", F.lit("; chunk: "), "chunk_index", F.lit("]")), "category", F.lit("[source:]"))
    return X.retrieved(s, d).select("chunk_id", R.strip_markers(marked).alias("answer"))


def metadata_match(s, d):
    return X.retrieved_ids(s, d).select("query_id", "rank", F.array_join("candidate_ids", ",").alias("candidate_ids"))


def normalise_source_id(s, d):
    urls = X.table(s, d, "pages").select(F.col("url").alias("raw"))
    files = X.retrieved(s, d).select(F.concat(F.lit("C:\\"), "file_name").alias("raw"))
    return urls.unionByName(files).distinct().select("raw", R.normalise_source_id("raw").alias("source_id"))


def _precision(s, d):
    return R.precision_at_k(X.retrieved_ids(s, d), X.expected_ids(s, d))


def _judged(s, d):
    return R.judge_parse(X.judge_raw(s, d))


def eval_summary(s, d):
    parts = [R.precision_summary(_precision(s, d)), R.faithfulness_summary(_judged(s, d)), R.latency_percentiles(X.latency(s, d))]
    return R.eval_summary(parts)


QUERIES: dict[str, Query] = {
    # sources and sinks
    "read_csv_dispatch": read_csv_dispatch,
    "read_parquet_projected": lambda s, d: readers.read_parquet_projected(s, f"{d}/orders.parquet", ["o_orderkey", "o_orderpriority"]),
    "read_census": read_census,
    "read_chunks_jsonl": read_chunks_jsonl,
    "read_documents": read_documents,
    "write_fact_parquet": write_fact_parquet,
    "write_tables": write_tables,
    "write_chunks_jsonl": write_chunks_jsonl,
    "model_io": model_io,
    # cleaning, projection, predicates
    "normalise_headers": lambda s, d: P.normalise_headers(
        X.dispatch_raw(s, d).withColumnsRenamed({"call_id_hash": " Call_ID_Hash ", "service": "SERVICE_TYPE", "city_name": "City_Name", "priority": "Initial_Priority"})
    ),
    "rename_canonical": lambda s, d: P.rename_canonical(X.dispatch_raw(s, d)).select("incident_id", "service_type", "call_type", "census_block_group"),
    "parse_datetime": lambda s, d: _parsed(s, d).select(
        "call_id_hash", "call_create_time", F.col("call_year").cast("int").alias("call_year"), F.col("call_quarter").cast("int").alias("call_quarter")
    ),
    "clean_priority": lambda s, d: P.clean_priority(X.dispatch_raw(s, d)).select("call_id_hash", "priority", "priority_desc"),
    "clean_description": lambda s, d: P.clean_description(X.dispatch_raw(s, d)).select("call_id_hash", "description_short"),
    "clean_geography": lambda s, d: P.clean_geography(X.dispatch_raw(s, d)).select(
        "call_id_hash", "city_name", "city_code", "geoid", "census_block_group_center__x", "census_block_group_center__y"
    ),
    "clean_response_time": lambda s, d: P.clean_response_time(X.dispatch_raw(s, d)).select(
        "call_id_hash", F.col("response_time_sec").alias("given_sec")
    ).unionByName(
        P.clean_response_time(X.dispatch_raw(s, d).drop("response_time_sec")).select("call_id_hash", F.col("response_time_sec").alias("derived_sec")),
        allowMissingColumns=True,
    ),
    "ensure_columns": lambda s, d: P.ensure_columns(X.dispatch_raw(s, d).drop("geoid"), P.STORAGE_TYPES),
    "apply_dtypes": apply_dtypes,
    "drop_exact_duplicates": lambda s, d: P.drop_exact_duplicates(X.dispatch_raw(s, d)),
    "duplicate_report": lambda s, d: P.duplicate_report(X.dispatch_raw(s, d)),
    "completeness_score": lambda s, d: X.dispatch(s, d).select("incident_id", "completeness_score"),
    "quarter_label": lambda s, d: X.dispatch_raw(s, d).select("call_id_hash", P.quarter_label("quarter_text").alias("quarter")),
    "canonicalise_aliases": canonicalise_aliases,
    "global_filter": lambda s, d: P.filter_by(X.dispatch(s, d), years=[1996, 1998], services=["EMS"], call_types=["SICK", "FALL"]).select(
        "incident_id", "year", "service_type", "call_type"
    ),
    "service_filter_ci": lambda s, d: P.service_filter_ci(X.dispatch(s, d), services=["fire"]).select("incident_id", "service_type", "year"),
    "priority_level": lambda s, d: X.dispatch(s, d).select("incident_id", P.priority_level("priority_description").alias("priority_level")),
    "with_flags": lambda s, d: P.with_flags(X.dispatch(s, d)).select("incident_id", "with_coords", "high_completeness"),
    "drop_null_subset": lambda s, d: P.drop_null_subset(X.dispatch(s, d), ["latitude", "longitude", "census_block_group", "call_type"]).select("incident_id"),
    "blank_to_unknown": lambda s, d: X.dispatch(s, d).select("incident_id", P.blank_to_unknown("call_type").alias("call_type")),
    "event_time_resolve": event_time_resolve,
    # mapping
    "map_call_group": lambda s, d: _mapped(s, d).select("incident_id", "call_type", "mpds_group"),
    "mapping_coverage": lambda s, d: rounded(M.mapping_coverage(_mapped(s, d)), "coverage"),
    "mapping_report": lambda s, d: M.mapping_report(_mapped(s, d)),
    "collapse_long_tail": collapse_long_tail,
    "rare_label_group": rare_label_group,
    "label_encode": label_encode,
    "align_label_space": align_label_space,
    # validation
    "validate_rules": _violations,
    "validation_summary": lambda s, d: V.validation_summary(X.dispatch_dirty(s, d)),
    "validation_errors": lambda s, d: V.validation_errors(X.dispatch_dirty(s, d)).select("incident_id", F.array_join("violations", ",").alias("violations")),
    "data_completeness_pct": lambda s, d: V.data_completeness_pct(X.dispatch_dirty(s, d)).select("incident_id", "data_completeness_pct"),
    "null_profile": lambda s, d: V.null_profile(X.dispatch(s, d), ["incident_id", "priority_description", "call_type", "census_block_group", "latitude"]),
    "many_to_one_guard": many_to_one_guard,
    "quarantine_split": quarantine_split,
    "quarantine_write": quarantine_write,
    # joins and set operations
    "normalise_geoid": normalise_geoid,
    "standardise_census": standardise_census,
    "join_demographics": join_demographics,
    "join_forecasts": lambda s, d: J.join_forecasts(*X.forecasts(s, d)),
    "join_stats_back": join_stats_back,
    "join_anomaly_flags": join_anomaly_flags,
    "code_to_name": code_to_name,
    "semi_top_n": lambda s, d: J.semi_top_n(X.dispatch(s, d), "city_name", 5).select("incident_id", "city_name"),
    "union_by_name": union_by_name,
    "set_difference_split": set_difference_split,
    "set_intersection_ids": set_intersection_ids,
    "distinct_sorted_options": lambda s, d: J.distinct_sorted_options(X.dispatch(s, d), ["year", "service_type", "call_type"]),
    # aggregations
    "overview_agg": _overview,
    "temporal_heatmap_agg": lambda s, d: A.temporal_heatmap_agg(X.dispatch(s, d)),
    "temporal_slope_agg": lambda s, d: A.temporal_slope_agg(X.dispatch(s, d)),
    "geo_density_agg": lambda s, d: rounded(_density(s, d), "latitude", "longitude"),
    "geo_city_agg": lambda s, d: rounded(_city(s, d), "completeness_sum"),
    "geo_bitmap_distinct": geo_bitmap_distinct,
    "geo_call_type_cbg_agg": lambda s, d: A.geo_call_type_cbg_agg(X.dispatch(s, d)),
    "kpi_totals": lambda s, d: rounded(A.kpi_totals(_overview(s, d)), "avg_per_quarter"),
    "service_share": lambda s, d: A.count_by(_overview(s, d), ["service"], measure="call_count"),
    "top_categories": lambda s, d: A.top_categories(_overview(s, d)),
    "yearly_by_service": lambda s, d: A.count_by(_overview(s, d), ["year", "service"], measure="call_count"),
    "triage_flow": lambda s, d: A.triage_flow(_overview(s, d)),
    "priority_funnel": lambda s, d: A.priority_funnel(_overview(s, d)),
    "quality_pipeline": lambda s, d: A.quality_pipeline(_overview(s, d)),
    "quarter_year_matrix": lambda s, d: A.quarter_year_matrix(X.dispatch(s, d)),
    "slope_first_last": lambda s, d: A.slope_first_last(A.temporal_slope_agg(X.dispatch(s, d))),
    "quarter_anomaly": lambda s, d: A.quarter_anomaly(_cells(s, d), _cells(s, d)),
    "cbg_centroids": lambda s, d: rounded(_centroids(s, d), "latitude", "longitude"),
    "geo_kpis": geo_kpis,
    "city_service_top": lambda s, d: A.city_service_top(_city(s, d)),
    "equity_scatter": lambda s, d: A.equity_scatter(_city(s, d)),
    "equity_rank": lambda s, d: A.equity_rank(_city(s, d)),
    "call_type_spread": lambda s, d: A.call_type_spread(A.geo_call_type_cbg_agg(X.dispatch(s, d))),
    "bubble_scale": lambda s, d: rounded(A.bubble_scale(_centroids(s, d)).select("census_block_group", "call_count", "bubble_size"), "bubble_size"),
    "grid_density": lambda s, d: rounded(A.grid_density(rounded(_centroids(s, d), "latitude", "longitude"), "call_count"), "latitude", "longitude"),
    "cluster_summary": lambda s, d: rounded(A.cluster_summary(_clustered(s, d)), "centre_lat", "centre_lon", "map_lat", "map_lon", digits=9),
    "value_counts_top": lambda s, d: A.value_counts_top(X.dispatch(s, d), "priority_code", 15),
    "describe_column": lambda s, d: A.describe_column(X.dispatch(s, d), "response_time_sec"),
    "histogram": lambda s, d: A.histogram(X.dispatch(s, d), "completeness_score", 20),
    "confidence_histogram": confidence_histogram,
    "quarterly_trend": lambda s, d: A.quarterly_trend(X.dispatch(s, d), ["service_type"]),
    "priority_over_time": lambda s, d: A.priority_over_time(X.dispatch(s, d)),
    "period_extremes": lambda s, d: A.period_extremes(A.quarterly_trend(X.dispatch(s, d))),
    "geo_coverage": lambda s, d: A.geo_coverage(X.dispatch(s, d)),
    "missing_geo_by_city": lambda s, d: rounded(A.missing_geo_by_city(X.dispatch(s, d)), "missing_pct"),
    "blockgroup_profile": lambda s, d: A.blockgroup_profile(X.dispatch(s, d)),
    "distinct_summary": lambda s, d: A.distinct_summary(X.dispatch(s, d)),
    "city_service_breakdown": lambda s, d: A.city_service_breakdown(X.dispatch(s, d)),
    # windows and features
    "cyclical_features": cyclical_features,
    "geo_target_encoding": geo_target_encoding,
    "lag_features": lag_features,
    "series_features": series_features,
    "quarter_lag_features": lambda s, d: rounded(W.quarter_lag_features(X.series(s, d)), "q_sin", "q_cos"),
    "yoy_growth": lambda s, d: W.yoy_growth(X.dispatch(s, d)),
    "period_rank": lambda s, d: W.period_rank(X.dispatch(s, d)),
    "row_share_normalise": row_share_normalise,
    "zscore_scale": zscore_scale,
    # series and forecasts
    "monthly_series": lambda s, d: S.monthly_series(X.dispatch(s, d), ["service_type"], "call_create_time"),
    "quarterly_series": lambda s, d: S.quarterly_series(X.dispatch(s, d), services=["EMS"], call_types=["SICK"], densify=True),
    "series_validate": series_validate,
    "future_periods": lambda s, d: S.future_periods(X.series(s, d), 4).select("series_id", "step", "ds"),
    "trend_seasonal_forecast": trend_seasonal_forecast,
    "gbt_lag_forecast": gbt_lag_forecast,
    "recursive_forecast": recursive_forecast,
    "ensemble_combine": lambda s, d: rounded(S.ensemble_combine(*X.forecasts(s, d), weights=(0.4, 0.6)), "yhat"),
    "forecast_finalise": forecast_finalise,
    "walk_forward_cv": lambda s, d: S.walk_forward_cv(X.series(s, d)),
    "mape": mape,
    # splits, classification, evaluation
    "stratified_split": lambda s, d: _splits(s, d).select("incident_id", "mpds_group", "split"),
    "classifier_frame": classifier_frame,
    "forecaster_split": lambda s, d: D.forecaster_split(X.dispatch(s, d)),
    "fit_eval_split": lambda s, d: D.fit_eval_split(P.drop_null_subset(X.dispatch(s, d), ["longitude", "latitude"]), ["incident_id"]).select("incident_id", "split"),
    "feature_prep": feature_prep,
    "train_classifier": train_classifier,
    "boosted_classifier": boosted_classifier,
    "tune_classifier": tune_classifier,
    "halve_classifier": halve_classifier,
    "predict_confidence": predict_confidence,
    "flag_disagreements": lambda s, d: _flagged(s, d).select("rid", "is_disagreement"),
    "confusion_matrix": lambda s, d: C.confusion_matrix(X.predictions(s, d), ["A", "N", "R"]),
    "per_class_metrics": lambda s, d: C.rounded_class_metrics(C.confusion_long(X.predictions(s, d))),
    "overall_metrics": lambda s, d: C.overall_metrics(_class_table(s, d)),
    "feature_importance": feature_importance,
    "inject_label_errors": lambda s, d: _injected(s, d).select("rid", "truth_code", "label_after", "is_injected"),
    "threshold_sweep": lambda s, d: C.threshold_sweep(_injected(s, d), "predicted_code"),
    "agreement_status": lambda s, d: C.agreement_status(X.predictions(s, d)).groupBy("status").agg(F.count("*").alias("n")),
    "agreement_by_group": lambda s, d: C.agreement_by_group(_flagged(s, d), "mpds_group"),
    "completeness_trend": completeness_trend,
    "metric_gates": metric_gates,
    "qa_kpis": qa_kpis,
    "score_saved_model": score_saved_model,
    "class_weights": lambda s, d: rounded(C.class_weights(X.predictions(s, d), "mpds_group"), "weight"),
    # spatial clustering and anomalies
    "hotspot_input": lambda s, d: rounded(X.points(s, d), "latitude", "longitude"),
    "neighbour_count": lambda s, d: K.neighbour_count(X.points(s, d), EPS).select("census_block_group", "neighbours"),
    "core_points": lambda s, d: K.core_points(X.points(s, d), EPS, MIN_SAMPLES).select("census_block_group"),
    "dbscan": lambda s, d: _clustered(s, d).select("census_block_group", "cluster"),
    "silhouette_exact": lambda s, d: rounded(
        K.silhouette_exact(X.points(s, d).withColumn("cluster", F.floor(F.col("latitude") * 2).cast("int"))), "silhouette"
    ),
    "isolation_forest_fit": isolation_forest_fit,
    "isolation_forest_score": isolation_forest_score,
    "recall_top_share": lambda s, d: N.recall_top_share(X.scored(s, d), "anomaly_score", ["incident_id"]),
    "assign_clusters": lambda s, d: K.assign_clusters(_clustered(s, d)),
    # text, documents, retrieval
    "html_visible_text": lambda s, d: X.table(s, d, "pages").select("page_id", T.html_visible_text("html").alias("text")),
    "character_references": character_references,
    "html_visible_text_exact": lambda s, d: X.table(s, d, "pages").select("page_id", T.html_visible_text("html", exact=True).alias("text")),
    "clean_text": lambda s, d: X.documents(s, d).select("doc_id", T.clean_text("text").alias("text")),
    "slugify": lambda s, d: X.documents(s, d).select("doc_id", T.slugify(F.concat_ws(" / ", "title", "text")).alias("slug")),
    "doc_quality": lambda s, d: T.doc_quality(X.documents(s, d)).select("doc_id", "chars", "alpha_ratio", "readable_ratio", "passes"),
    "paragraph_pack": paragraph_pack,
    "split_long_text": split_long_text,
    "garble_detect": lambda s, d: T.garble_detect(X.documents(s, d)).drop("text", "title", "lang", "source_id"),
    "validate_chunk": lambda s, d: T.validate_chunk(X.documents(s, d)).select("doc_id", F.array_join("reasons", ",").alias("reasons"), "passes"),
    "quality_report": lambda s, d: T.quality_report(X.documents(s, d)),
    "rejected_samples": lambda s, d: T.rejected_samples(X.documents(s, d), "doc_id").withColumn("reasons", F.array_join("reasons", ",")),
    "build_chunks": build_chunks,
    "keyword_rank": keyword_rank,
    "vector_topk": vector_topk,
    "vector_topk_lsh": vector_topk_lsh,
    "vector_index_search": vector_index_search,
    "store_integrity": lambda s, d: R.store_integrity(X.table(s, d, "embeddings"), "vec_id"),
    "dedupe_citations": lambda s, d: R.dedupe_citations(X.retrieved(s, d)).drop("category", "text"),
    "snippet": lambda s, d: X.documents(s, d).select("doc_id", R.snippet("text").alias("snippet")),
    "source_summary": lambda s, d: R.source_summary(X.retrieved(s, d)),
    "displayable_sources": lambda s, d: R.displayable_sources(X.retrieved(s, d)).select("query_id", "source_key", "rank", "url"),
    "extractive_answer": lambda s, d: R.extractive_answer(X.retrieved(s, d), X.retrieved(s, d)),
    "answer_text": lambda s, d: R.answer_text(R.extractive_answer(X.retrieved(s, d), X.retrieved(s, d)), R.dedupe_citations(X.retrieved(s, d))),
    "strip_markers": strip_markers,
    "normalise_source_id": normalise_source_id,
    "precision_at_k": _precision,
    "precision_summary": lambda s, d: R.precision_summary(_precision(s, d)),
    "judge_parse": lambda s, d: _judged(s, d).select("judge_id", "score", "reasoning"),
    "faithfulness_summary": lambda s, d: R.faithfulness_summary(_judged(s, d)),
    "latency_percentiles": lambda s, d: R.latency_percentiles(X.latency(s, d)),
    "eval_summary": eval_summary,
    "metadata_match": metadata_match,
}
