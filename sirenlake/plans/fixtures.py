"""Views that give the driver tables the shape of dispatch data (whole tables, no subsets)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.ranking import hash_int
from ..operators.clean import completeness_score
from ..operators.forecast import quarterly_series
from ..operators.retrieval import metadata_ids
from ..operators.spatial import hotspot_input

CALL_TYPES = [
    "SICK", "FALL", "Breathing ", "CHEST PAIN", "OVERDOSE", "EMS ASSIST", "TRAFFIC - INJURIES", "INACCESSIBLE - ENTRAPMENT",
    "COMMERCIAL FIRE ALARM", "UNCONSCIOUS", "PSYCH", "WELFARE CHECK",
]
PRIORITIES = ["Life Threatening", "Advanced Life Support", "Basic Life Support", "Non Emergency Assist"]
CALL_MAP = [
    ("SICK", "Sick Person"), ("FALL", "Falls"), ("BREATHING", "Breathing Problems"), ("CHEST PAIN", "Chest Pain"),
    ("OVERDOSE", "Overdose"), ("UNCONSCIOUS", "Unconscious"), ("PSYCH", "Psychiatric"), ("EMS ASSIST", "Unknown Problem"),
]
CALL_RULES = [(["TRAFFIC"], "Traffic Accident"), (["INACCESS", "ENTRAP"], "Unknown Problem"), (["FIRE"], "Fire")]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def nth(index: Column, values: list[str]) -> Column:
    """values[index], NULL beyond the end."""
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def text(c: Column) -> Column:
    return c.cast("string")


def bucket(seed: str, key: Column, n: int) -> Column:
    return hash_int(F.md5(F.concat(F.lit(f"{seed}|"), key))) % n


def dispatch(spark: SparkSession, sf: str) -> DataFrame:
    o, c, n = (table(spark, sf, t) for t in ("orders", "customer", "nation"))
    k, cust, nation = F.col("o_orderkey"), F.col("o_custkey"), F.col("n_nationkey")
    ems = k % 10 < 7
    level = F.substring("o_orderpriority", 1, 1)
    located = k % 25 != 0
    joined = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    out = joined.select(
        k.alias("k"),
        cust.alias("custkey"),
        F.concat(F.lit("I"), text(k)).alias("incident_id"),
        F.when(ems, "EMS").otherwise("Fire").alias("service_type"),
        F.concat(F.when(ems, "E").otherwise("F"), level).alias("priority_code"),
        nth(level.cast("int") - 1, PRIORITIES).alias("priority_description"),
        F.col("o_orderdate").alias("call_create_time"),
        F.year("o_orderdate").alias("year"),
        F.concat(F.lit("Q"), text(F.quarter("o_orderdate"))).alias("quarter"),
        nth(k % 13, CALL_TYPES).alias("call_type"),
        F.concat(F.lit("C"), text(nation)).alias("city_code"),
        F.col("n_name").alias("city_name"),
        F.when(k % 20 != 0, F.lpad(text(cust), 12, "0")).alias("census_block_group"),
        F.when(located, (-80200 + 500 * (nation % 5) + 4 * (cust % 23)).cast("double") / 1e3).alias("longitude"),
        F.when(located, (40200 + 500 * F.floor(nation / 5) + 4 * (cust % 29)).cast("double") / 1e3).alias("latitude"),
        (k * 37 % 9000 - 300).cast("double").alias("response_time_sec"),
    )
    return completeness_score(out)


def dispatch_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Raw headers, untidy text, numbers as text, a few exact duplicates."""
    d, k = dispatch(spark, sf), F.col("k")
    stamp = "yyyy-MM-dd HH:mm:ss"
    quarter = F.substring("quarter", 2, 1)
    blank = lambda c: F.concat(F.lit(" "), c, F.lit(" "))
    on_scene = F.col("call_create_time") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), k % 9000)
    raw = d.select(
        F.col("incident_id").alias("call_id_hash"),
        F.when(k % 11 != 0, F.col("service_type")).alias("service"),
        F.when(k % 5 == 0, blank(F.lower("priority_code"))).when(k % 5 == 1, "nan").when(k % 5 == 2, "None").when(k % 5 == 3, "")
        .otherwise(F.col("priority_code")).alias("priority"),
        F.when(k % 6 == 0, "nan").when(k % 6 == 1, "  ").otherwise(blank(F.upper("priority_description"))).alias("priority_desc"),
        F.when(k % 41 == 0, "not a date").otherwise(F.date_format("call_create_time", stamp)).alias("call_create_time"),
        F.when(k % 7 == 0, "None").otherwise(blank(F.lower("call_type"))).alias("description_short"),
        blank(F.lower("city_code")).alias("city_code"),
        F.when(k % 9 == 0, F.concat(F.lit("o'hara-"), F.lower("city_name"))).when(k % 9 == 1, F.lit(None)).otherwise(blank(F.col("city_name")))
        .alias("city_name"),
        F.when(k % 53 == 0, F.concat(F.lit("4200300010010"), text(k))).otherwise(text(F.col("custkey"))).alias("geoid"),
        F.when(k % 43 == 0, "abc").otherwise(text(F.col("longitude"))).alias("census_block_group_center__x"),
        F.when(k % 43 == 1, "abc").otherwise(text(F.col("latitude"))).alias("census_block_group_center__y"),
        F.when(k % 47 == 0, "abc").otherwise(text(F.col("response_time_sec").cast("bigint"))).alias("response_time_sec"),
        F.date_format("call_create_time", stamp).alias("unit_dispatch_time"),
        F.date_format(on_scene, stamp).alias("unit_on_scene_time"),
        F.when(k % 4 == 0, F.concat(F.lit("Quarter "), quarter)).when(k % 4 == 1, quarter).when(k % 4 == 2, F.concat(quarter, F.lit(".0")))
        .otherwise(F.concat(F.lit("q"), quarter)).alias("quarter_text"),
        F.when(k % 3 != 0, text(F.col("year"))).alias("year_text"),
        text(F.col("year")).alias("call_year_text"),
        F.explode(F.array_repeat(F.lit(0), F.when(k % 97 == 0, 2).otherwise(1))).alias("copy"),
    )
    return raw.drop("copy")


def dispatch_dirty(spark: SparkSession, sf: str) -> DataFrame:
    """Canonical rows of which some break the row contract."""
    k = F.col("k")
    return dispatch(spark, sf).withColumns(
        {
            "service_type": F.when(k % 17 == 0, "Police").otherwise(F.col("service_type")),
            "quarter": F.when(k % 19 == 0, "Q5").otherwise(F.col("quarter")),
            "year": F.when(k % 23 == 0, 1900).otherwise(F.col("year") + 5),
            "city_name": F.when(k % 29 == 0, "  ").otherwise(F.col("city_name")),
            "longitude": F.when(k % 31 == 0, 200.0).otherwise(F.col("longitude")),
            "latitude": F.when(k % 37 == 0, -95.5).otherwise(F.col("latitude")),
        }
    )


def call_map(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CALL_MAP, "call_key string, call_group string")


def census(spark: SparkSession, sf: str) -> DataFrame:
    """Two survey vintages per block group; some keys are unknown to the calls, some totals are 0."""
    k = F.col("c_custkey")
    base = table(spark, sf, "customer").withColumn("vintage", F.explode(F.array(F.lit(0), F.lit(1))))
    key = text(F.when(k % 50 == 3, k + 9_000_000).otherwise(k))
    v = F.col("vintage")
    return base.select(
        F.when(k % 7 == 0, F.concat(key, F.lit(".0"))).when(k % 7 == 1, F.concat(F.lit("BG-"), key)).otherwise(key).alias("GEOID"),
        F.concat(F.lit("Block "), text(k)).alias("NAME"),
        text(F.when(k % 13 == 0, 0).otherwise(500 + k % 2000 + v)).alias("B01003_001E"),
        text(F.when(k % 17 == 0, 0).otherwise(400 + k % 1500)).alias("B17001_001E"),
        F.when(k % 31 == 0, "abc").otherwise(text(k * 3 % 300)).alias("B17001_002E"),
        text(k % 500).alias("B02001_002E"),
        text(k % 90).alias("B02001_003E"),
        text(k % 40).alias("B02001_005E"),
        text(k % 70).alias("B03003_003E"),
        text(F.col("c_acctbal")).alias("B19013_001E"),
        text(k % 50 * 100000).alias("ALAND"),
        (k * 2 + v).alias("ord"),
    )


def series(spark: SparkSession, sf: str) -> DataFrame:
    """Quarterly calls per service and city."""
    d = dispatch(spark, sf).withColumn("series_id", F.concat_ws("|", "service_type", "city_code"))
    return quarterly_series(d, ["series_id"])


def forecasts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Two deterministic forecasts over the known periods (the second skips first quarters)."""
    s = series(spark, sf)
    y = F.col("y").cast("double")
    trend = s.select("series_id", "ds", (y + 2).alias("yhat"), (y - 1).alias("yhat_lower"), (y + 5).alias("yhat_upper"))
    return trend, s.where(F.quarter("ds") != 1).select("series_id", "ds", (y * 3 / 2).alias("yhat"))


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    others = [c for c in li.columns if c not in ("l_orderkey", "l_linenumber")]
    rn = F.row_number().over(Window.partitionBy("l_orderkey", "l_linenumber").orderBy(*others))
    keyed = li.withColumn("rid", F.concat_ws("-", text(F.col("l_orderkey")), text(F.col("l_linenumber")), text(rn)))
    hit, sure = bucket("hit", F.col("rid"), 100), bucket("sure", F.col("rid"), 100)
    code = F.array_position(F.array(F.lit("A"), F.lit("N"), F.lit("R")), F.col("l_returnflag")).cast("int") - 1
    moved = (F.col("truth_code") + F.when(hit < 60, 0).otherwise(1 + hit % 2)) % 3
    return (
        keyed.withColumn("truth_code", code)
        .withColumn("predicted_code", moved.cast("int"))
        .select(
            "rid",
            "truth_code",
            "predicted_code",
            F.col("l_returnflag").alias("truth"),
            nth(F.col("predicted_code"), ["A", "N", "R"]).alias("predicted"),
            F.concat("l_returnflag", "l_linestatus").alias("mpds_group"),
            F.year("l_shipdate").alias("year"),
            F.when(F.col("l_linestatus") == "F", "Fire").otherwise("EMS").alias("service_type"),
            ((3000 + 70 * sure).cast("double") / 1e4).alias("max_confidence"),
            (F.col("truth_code") == F.col("predicted_code")).alias("is_correct"),
            ((F.lit(60) + hit % 40).cast("double") / 1e2).alias("completeness_score"),
        )
    )


def points(spark: SparkSession, sf: str) -> DataFrame:
    return hotspot_input(dispatch(spark, sf))


def events_feat(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", "ts", "event_type", "user_id", "value")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents")
    return d.select("doc_id", F.col("source").alias("source_id"), F.concat(F.lit("Report "), text(F.col("doc_id"))).alias("title"), "lang", "text")


def doc_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The lines of each document as candidate chunks."""
    return documents(spark, sf).withColumn("pieces", F.split("text", "\n", -1))


def retrieved(spark: SparkSession, sf: str) -> DataFrame:
    """Ranked results per query: conversations are queries, their turns the ranks."""
    q, t = F.col("conv_id"), F.col("turn")
    src = F.concat(F.lit("src"), text((q * 7 + t * 3) % 5))
    return table(spark, sf, "conversations").select(
        q.alias("query_id"),
        (t + 1).alias("rank"),
        F.when(t % 4 == 3, "").otherwise(src).alias("source_id"),
        F.when(t % 3 == 1, "").otherwise(F.concat(F.lit("Guide "), text((q + t) % 4))).alias("title"),
        F.when(t % 6 == 5, "abc").otherwise(text(t % 3)).alias("chunk_index"),
        F.concat_ws("-", text(q), text(t)).alias("chunk_id"),
        F.when((q + t) % 3 == 0, "").otherwise(F.concat(F.lit("https://example.org/"), src)).alias("url"),
        F.concat(F.lit("docs/"), F.upper(src), F.lit(".md")).alias("file_name"),
        F.col("role").alias("category"),
        "text",
    )


def expected_ids(spark: SparkSession, sf: str) -> DataFrame:
    q = F.col("conv_id")
    ids = F.array(F.concat(F.lit("src"), text(q % 5)), F.concat(F.lit("src"), text((q + 1) % 5)))
    return table(spark, sf, "conversations").select(q.alias("query_id"), ids.alias("expected_ids")).distinct()


def retrieved_ids(spark: SparkSession, sf: str) -> DataFrame:
    return metadata_ids(retrieved(spark, sf))


def judge_raw(spark: SparkSession, sf: str) -> DataFrame:
    q, t = F.col("conv_id"), F.col("turn")
    s = F.when(t % 5 == 4, "-1.5").otherwise(F.concat(text(t % 4), F.lit(".25")))
    kind = (q + t) % 6
    reply = (
        F.when(kind == 0, F.concat(F.lit('{"score": '), s, F.lit(', "reasoning": "'), F.col("role"), F.lit('"}')))
        .when(kind == 1, F.concat(F.lit('```json\n{"score": '), s, F.lit(', "reasoning": "fenced"}\n```')))
        .when(kind == 2, F.lit('I think {"score": 7, "reasoning": "too high"} is right'))
        .when(kind == 3, F.concat(F.lit("Score: "), s, F.lit(" because it is grounded")))
        .when(kind == 4, F.lit("no verdict"))
        .otherwise(F.lit('{"score": "high", "reasoning": "bad type"}'))
    )
    return table(spark, sf, "conversations").select(
        F.concat_ws("-", text(q), text(t)).alias("judge_id"), reply.alias("response"), (F.col("role") == "system").alias("is_error")
    )


def latency(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id", (F.col("value") / 100).alias("latency_s"), (F.col("event_type") != "error").alias("success")
    )


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Calls with a stand-in anomaly score with many ties."""
    k = F.col("k")
    return dispatch(spark, sf).select("incident_id", "priority_code", (-(300 + k * 7919 % 500).cast("double") / 1e3).alias("anomaly_score"))


def query_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """One query per label: the mean vector of its members (rounded, so sums may be in any order)."""
    e = table(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("i", "x"))
    means = e.groupBy("label", "i").agg(F.round(F.avg(F.col("x").cast("double")), 5).alias("x"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda p: p["x"])
    return means.groupBy("label").agg(ordered.alias("embedding"))
