"""DuckDB statements that compute the same tables from the same files, independently of Spark."""

from __future__ import annotations

from html.entities import html5

from .views import (
    QUALITY,
    chunk_reasons,
    garbled,
    null_words,
    number,
    priority_level,
    quarter_label,
    quoted,
    r,
    snippet,
    source_slug,
    sql,
    text_parts,
    tidy_space,
    title,
    unescaped,
    zero_pad,
    geoid,
)

EPS2 = "0.0125e0 * 0.0125e0"
TAU = "(2 * pi())"


def bigint(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def wave(x: str, period: int, name: str) -> str:
    return f"{r(f'sin({TAU} * {x} / {period})', 6)} AS {name}_sin, {r(f'cos({TAU} * {x} / {period})', 6)} AS {name}_cos"


def split_case(size: str = "n", rank: str = "rk") -> str:
    return (
        f"CASE WHEN {rank} <= floor({size} * 0.7e0 + 0.5e0) THEN 'train' "
        f"WHEN {rank} <= floor({size} * (0.7e0 + 0.15e0) + 0.5e0) THEN 'validation' ELSE 'test' END"
    )


def ranked(source: str, key: str, by: str = "") -> str:
    part = f"PARTITION BY {by} " if by else ""
    return (
        f"(SELECT *, row_number() OVER ({part}ORDER BY h) AS rk, count(*) OVER ({part}) AS n "
        f"FROM (SELECT *, md5('42|' || {key}) AS h FROM {source}))"
    )


RULES = [
    *[(f"{c} IS NULL", f"{c}:missing") for c in QUALITY[:9]],
    *[(f"trim({c}) = ''", f"{c}:blank") for c in ("incident_id", "priority_code", "call_type", "city_code", "city_name")],
    ("service_type NOT IN ('EMS', 'Fire')", "service_type:unknown"),
    ("quarter NOT IN ('Q1', 'Q2', 'Q3', 'Q4')", "quarter:unknown"),
    ("year NOT BETWEEN 2000 AND 2030", "year:out_of_range"),
    ("longitude NOT BETWEEN -180 AND 180", "longitude:out_of_range"),
    ("latitude NOT BETWEEN -90 AND 90", "latitude:out_of_range"),
]
VIOLATIONS = "array_to_string(list_filter([" + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for c, n in RULES) + "], lambda v: v IS NOT NULL), ',')"
TEXT_COLUMNS = {c for c in QUALITY if c not in ("year", "longitude", "latitude")}
PCT = r(
    "(" + " + ".join(f"CAST(coalesce(trim({c}) <> '', false) AS INTEGER)" if c in TEXT_COLUMNS else f"CAST({c} IS NOT NULL AS INTEGER)" for c in QUALITY) + ") / 12.0", 4
)
TOP_TYPES = "SELECT call_type FROM overview GROUP BY 1 ORDER BY sum(call_count) DESC, call_type LIMIT 8"
BAND = "CASE WHEN {x} >= 70 THEN 'Match' WHEN {x} >= 50 THEN 'Review' ELSE 'Mismatch' END"
LABELLED = f"SELECT *, {split_case()} AS split FROM {ranked('mapped', 'incident_id', 'mpds_group')}"
TRAIN_TOP = "SELECT mpds_group FROM parts WHERE split = 'train' GROUP BY 1 ORDER BY count(*) DESC, mpds_group LIMIT 4"
RAW_COLUMNS = (
    "call_id_hash, service, priority, priority_desc, call_create_time, description_short, city_code, city_name, geoid, census_block_group_center__x, "
    "census_block_group_center__y, response_time_sec, unit_dispatch_time, unit_on_scene_time, quarter_text, year_text, call_year_text"
)
CELLS = "SELECT year, quarter, CAST(sum(call_count) AS BIGINT) AS call_count FROM heatmap GROUP BY ALL"
RANK_TEXT = "lower(title || ' ' || source_id || ' ' || text)"
STOP = "'about','against','answer','could','does','from','have','into','that','the','this','what','when','where','which','with','would','your'"
OVERALL = ", ".join(
    f"{r(x, 4)} AS {n}"
    for n, x in {
        "accuracy": "sum(tp) / sum(support)", "macro_f1": "avg(f1)", "weighted_f1": "sum(f1 * support) / sum(support)",
        "macro_precision": "avg(precision)", "macro_recall": "avg(recall)",
    }.items()
)

CLUSTERS = f"""+
pos AS (SELECT census_block_group AS id, latitude AS x, longitude AS y FROM {{source}}),
near AS (SELECT a.id AS a, b.id AS b FROM pos a JOIN pos b ON (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= {EPS2}),
core AS (SELECT a AS id FROM near GROUP BY 1 HAVING count(*) >= 3),
links AS (SELECT a, b FROM near WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)),
reach(id, label) USING KEY (id) AS (
  SELECT id, id FROM core
  UNION
  SELECT links.b, min(reach.label) FROM reach JOIN links ON links.a = reach.id JOIN recurring.reach old ON old.id = links.b
  WHERE reach.label < old.label GROUP BY 1),
numbers AS (SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS cluster FROM (SELECT DISTINCT label FROM reach)),
clustered AS (
  SELECT p.id AS census_block_group, p.x AS latitude, p.y AS longitude, coalesce(n.cluster, (SELECT min(n2.cluster) FROM near JOIN reach r2 ON r2.id = near.b
    JOIN numbers n2 ON n2.label = r2.label WHERE near.a = p.id), -1) AS cluster
  FROM pos p LEFT JOIN reach r1 ON r1.id = p.id LEFT JOIN numbers n ON n.label = r1.label)
"""


def clusters(body: str, *views: str, source: str = "points") -> str:
    return sql(CLUSTERS.format(source=source) + body, *views, source).replace("WITH ", "WITH RECURSIVE ", 1)


def _html(x: str) -> str:
    x = f"regexp_replace({x}, '(?s)<!--.*?(-->|$)', '', 'g')"
    for tag in ("script", "style", "noscript", "svg"):
        x = f"regexp_replace({x}, '(?is)<{tag}\\b[^>]*>.*?(</{tag}\\s*>|$)', ' ', 'g')"
    x = f"regexp_replace({x}, '(?i)<(p|br|div|li|tr|h1|h2|h3)\\b[^>]*>', ' ' || chr(10) || ' ', 'g')"
    x = f"regexp_replace({x}, '(?i)</(p|li|tr|h1|h2|h3)\\s*>', ' ' || chr(10) || ' ', 'g')"
    return f"regexp_replace({x}, '<[!/?a-zA-Z][^>]*>', ' ', 'g')"


BARE = "regexp_replace({x}, '&amp([^;\\w]|$)', '&\\1', 'g')"


def html_oracle() -> str:
    """Each step in its own subquery, which keeps the statement readable."""
    first = BARE.format(x=unescaped("t"))
    return (
        f"SELECT page_id, {tidy_space('t')} AS text FROM (SELECT page_id, {first} AS t FROM (SELECT page_id, {first} AS t "
        f"FROM (SELECT page_id, {_html('html')} AS t FROM pages)))"
    )


# The references of the HTML standard as a table of quoted names and texts.
REFERENCES = ", ".join("('" + name + "', '" + text.replace("'", "''") + "')" for name, text in html5.items())
OPEN_NAMES = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n)))
VOID = "n BETWEEN 1 AND 8 OR n = 11 OR n BETWEEN 14 AND 31 OR n = 127 OR n BETWEEN 64976 AND 65007 OR n & 65534 = 65534"
WINDOWS = "[" + ", ".join("'" + (bytes([b]).decode("cp1252", "ignore") or chr(b)).replace("'", "''") + "'" for b in range(128, 160)) + "]"


def resolved(step: int, source: str) -> str:
    """CTE ``text<step>`` (id, t): the texts ``source`` (id, t) with all character references resolved."""
    digits = "regexp_extract(m, '^#[xX]?0*([0-9a-fA-F]*)', 1)"
    return f"""piece{step} AS (SELECT id, unnest(string_split(t, '&')) AS p, generate_subscripts(string_split(t, '&'), 1) AS i FROM {source}),
found{step} AS (SELECT *, CASE WHEN i = 1 THEN '' ELSE regexp_extract(p, '^(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{{1,32}};?)', 1) END AS m FROM piece{step}),
number{step} AS (
  SELECT *, regexp_extract(m, '^(?:{OPEN_NAMES})') AS stem, substr(p, length(m) + 1) AS rest,
    CASE WHEN m NOT LIKE '#%' THEN NULL WHEN length({digits}) > 7 THEN 2097152 WHEN {digits} = '' THEN 0
      WHEN m ILIKE '#x%' THEN CAST('0x' || {digits} AS BIGINT) ELSE CAST({digits} AS BIGINT) END AS n FROM found{step}),
solved{step} AS (
  SELECT id, i, CASE WHEN i = 1 THEN p WHEN m = '' THEN '&' || p
    WHEN n IS NOT NULL THEN CASE WHEN n = 0 OR n BETWEEN 55296 AND 57343 OR n > 1114111 THEN chr(65533) WHEN n BETWEEN 128 AND 159 THEN {WINDOWS}[n - 127]
      WHEN {VOID} THEN '' ELSE chr(CAST(n AS INTEGER)) END || rest
    WHEN w.text IS NOT NULL THEN w.text || rest
    WHEN stem <> '' THEN o.text || substr(m, length(stem) + 1) || rest ELSE '&' || p END AS x
  FROM number{step} LEFT JOIN refs w ON w.name = m LEFT JOIN refs o ON o.name = stem),
text{step} AS (SELECT id, string_agg(x, '' ORDER BY i) AS t FROM solved{step} GROUP BY id)"""


def exact_html_oracle() -> str:
    return (
        f"WITH refs(name, text) AS (VALUES {REFERENCES}), text0 AS (SELECT page_id AS id, {_html('html')} AS t FROM pages), {resolved(1, 'text0')}, {resolved(2, 'text1')} "
        f"SELECT id AS page_id, {tidy_space('t')} AS text FROM text2"
    )


def references_oracle() -> str:
    """References made from the ids of the pages: named with and without semicolon, decimal and hexadecimal ones."""
    names = "[" + ", ".join(f"'{n}'" for n in sorted(html5)) + "]"
    raw = (
        f"'&' || {names}[CAST(page_id * 7 % {len(html5)} AS INTEGER) + 1] || ' &' || rtrim({names}[CAST(page_id * 11 % {len(html5)} AS INTEGER) + 1], ';') || page_id || "
        "' &#' || page_id || ' &#x' || upper(to_hex(page_id * 977)) || ';&#0' || (page_id + 55200) || ';&# &; &#xg && &amp;lt;'"
    )
    return f"WITH refs(name, text) AS (VALUES {REFERENCES}), text0 AS (SELECT page_id AS id, {raw} AS t FROM pages), {resolved(1, 'text0')} SELECT id AS page_id, t AS text FROM text1"


P = text_parts("text")
B = text_parts("t")

ORACLES: dict[str, str] = {
    "read_parquet_projected": "SELECT o_orderkey, o_orderpriority FROM orders",
    "write_fact_parquet": sql("SELECT year, count(*) AS rows FROM dispatch GROUP BY 1", "dispatch"),
    "write_tables": sql("SELECT * FROM overview", "overview"),
    "read_census": sql("SELECT * FROM census", "census"),
    "read_csv_dispatch": sql("SELECT " + ", ".join(
        f"coalesce({c}, 'EMS') AS service" if c == "service" else f"nullif(trim({c}), '') AS {c.upper() if c.endswith('_text') else c}" for c in RAW_COLUMNS.split(", ")) + " FROM dispatch_raw", "dispatch_raw"),
    "read_documents": sql(f"""+ bodies AS (SELECT {tidy_space("title || chr(10) || chr(10) || text")} AS t FROM docs)
        SELECT 'local_document' AS category, CAST({B['chars']} AS INTEGER) AS chars, {B['chars']} >= 120 AND {B['alpha']} >= 0.5 AND {B['readable']} >= 0.95 AS passes FROM bodies""", "docs"),
    "read_chunks_jsonl": sql(f"""
        SELECT source_id, count(*) AS chunks, {bigint('sum(length(piece))')} AS chars FROM windows WHERE len({chunk_reasons('piece')}) = 0 GROUP BY 1""", "windows"),
    "write_chunks_jsonl": sql(f"""+ good AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS k FROM windows WHERE len({chunk_reasons('piece')}) = 0)
        SELECT substr(sha1(source_id || ':' || k || ':' || piece), 1, 16) AS chunk_id, source_id, 'Report ' || doc_id AS title, CAST(k AS INTEGER) AS chunk_index, piece AS text,
          CAST(length(piece) AS INTEGER) AS quality_chars FROM good""", "windows"),
    "split_long_text": sql("SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS INTEGER) AS position, piece FROM windows WHERE piece <> ''", "windows"),
    "ensure_columns": sql("SELECT " + RAW_COLUMNS.replace(" geoid,", "") + ", CAST(NULL AS VARCHAR) AS geoid, CAST(NULL AS TINYINT) AS call_quarter, CAST(NULL AS SMALLINT) AS call_year FROM dispatch_raw", "dispatch_raw"),
    # cleaning
    "rename_canonical": sql("SELECT call_id_hash AS incident_id, service AS service_type, description_short AS call_type, geoid AS census_block_group FROM dispatch_raw", "dispatch_raw"),
    "normalise_headers": sql(f"SELECT {RAW_COLUMNS} FROM dispatch_raw".replace("quarter_text", "quarter_text AS QUARTER_TEXT").replace("call_year_text", "call_year_text AS CALL_YEAR_TEXT").replace(" year_text", " year_text AS YEAR_TEXT"), "dispatch_raw"),
    "parse_datetime": sql("""
        SELECT call_id_hash, ts AS call_create_time, CAST(year(ts) AS INTEGER) AS call_year, CAST(quarter(ts) AS INTEGER) AS call_quarter
        FROM (SELECT call_id_hash, try_strptime(call_create_time, '%Y-%m-%d %H:%M:%S') AS ts FROM dispatch_raw)""", "dispatch_raw"),
    "clean_priority": sql(f"SELECT call_id_hash, {null_words('upper(trim(priority))')} AS priority, {null_words(title('trim(priority_desc)'))} AS priority_desc FROM dispatch_raw", "dispatch_raw"),
    "clean_description": sql(f"SELECT call_id_hash, {null_words('upper(trim(description_short))')} AS description_short FROM dispatch_raw", "dispatch_raw"),
    "clean_geography": sql(f"""
        SELECT call_id_hash, {title('trim(city_name)')} AS city_name, upper(trim(city_code)) AS city_code, {zero_pad('trim(geoid)')} AS geoid,
          {number('census_block_group_center__x')} AS census_block_group_center__x, {number('census_block_group_center__y')} AS census_block_group_center__y
        FROM dispatch_raw""", "dispatch_raw"),
    "clean_response_time": sql(f"""
        SELECT call_id_hash, CASE WHEN v BETWEEN 0 AND 7200 THEN v END AS given_sec, CAST(NULL AS DOUBLE) AS derived_sec
        FROM (SELECT call_id_hash, {number('response_time_sec')} AS v FROM dispatch_raw)
        UNION ALL
        SELECT call_id_hash, NULL, CASE WHEN v BETWEEN 0 AND 7200 THEN v END
        FROM (SELECT call_id_hash, epoch(CAST(unit_on_scene_time AS TIMESTAMP)) - epoch(CAST(unit_dispatch_time AS TIMESTAMP)) AS v FROM dispatch_raw)""", "dispatch_raw"),
    "apply_dtypes": sql(f"""
        SELECT call_id_hash, try_cast(call_year_text AS SMALLINT) AS call_year, CAST({number('census_block_group_center__x')} AS FLOAT) AS census_block_group_center__x,
          CAST({number('response_time_sec')} AS FLOAT) AS response_time_sec, geoid FROM dispatch_raw""", "dispatch_raw"),
    "drop_exact_duplicates": sql(f"SELECT DISTINCT {RAW_COLUMNS} FROM dispatch_raw", "dispatch_raw"),
    "duplicate_report": sql(f"""
        SELECT {bigint('sum(n)')} AS rows_before, count(*) AS rows_after, {bigint('sum(n - 1)')} AS rows_removed
        FROM (SELECT count(*) AS n FROM dispatch_raw GROUP BY {RAW_COLUMNS})""", "dispatch_raw"),
    "completeness_score": sql("SELECT incident_id, completeness_score FROM dispatch", "dispatch"),
    "quarter_label": sql(f"SELECT call_id_hash, {quarter_label('quarter_text')} AS quarter FROM dispatch_raw", "dispatch_raw"),
    "canonicalise_aliases": sql(f"""
        SELECT call_id_hash AS incident_id, CAST(coalesce(year_text, call_year_text) AS INTEGER) AS year, {quarter_label('quarter_text')} AS quarter,
          service AS service_type FROM dispatch_raw""", "dispatch_raw"),
    "global_filter": sql("SELECT incident_id, year, service_type, call_type FROM dispatch WHERE year IN (1996, 1998) AND service_type = 'EMS' AND call_type IN ('SICK', 'FALL')", "dispatch"),
    "service_filter_ci": sql("SELECT incident_id, service_type, year FROM dispatch WHERE upper(service_type) = 'FIRE' AND year IS NOT NULL", "dispatch"),
    "priority_level": sql(f"SELECT incident_id, {priority_level('priority_description')} AS priority_level FROM dispatch", "dispatch"),
    "with_flags": sql("SELECT incident_id, longitude IS NOT NULL AS with_coords, completeness_score >= 0.75 AS high_completeness FROM dispatch", "dispatch"),
    "drop_null_subset": sql("SELECT incident_id FROM dispatch WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND census_block_group IS NOT NULL AND call_type IS NOT NULL", "dispatch"),
    "blank_to_unknown": sql("SELECT incident_id, trim(coalesce(call_type, 'Unknown')) AS call_type FROM dispatch", "dispatch"),
    "event_time_resolve": sql("""
        SELECT incident_id, 'timestamp' AS variant, call_create_time AS ds FROM dispatch
        UNION ALL SELECT incident_id, 'month', CAST(date_trunc('month', call_create_time) AS TIMESTAMP) FROM dispatch
        UNION ALL SELECT incident_id, 'quarter', CAST(date_trunc('quarter', call_create_time) AS TIMESTAMP) FROM dispatch""", "dispatch"),
    # mapping
    "map_call_group": sql("SELECT incident_id, call_type, mpds_group FROM mapped", "mapped"),
    "mapping_coverage": sql(f"SELECT {r('coalesce(avg(CAST(mpds_group <> ' + quoted(['Unknown Problem']) + ' AS DOUBLE)), 0)', 6)} AS coverage, count(*) AS total_rows FROM mapped", "mapped"),
    "mapping_report": sql(f"""
        SELECT call_type, mpds_group, count(*) AS count, {r('count(*) / (SELECT count(*) FROM mapped) * 100.0', 2)} AS pct, mpds_group <> 'Unknown Problem' AS is_mapped
        FROM mapped WHERE call_type IS NOT NULL GROUP BY ALL""", "mapped"),
    "collapse_long_tail": sql(f"""+ parts AS ({LABELLED}), top AS ({TRAIN_TOP})
        SELECT split, CASE WHEN mpds_group IN (SELECT mpds_group FROM top) THEN mpds_group ELSE 'Other' END AS mpds_group, count(*) AS n FROM parts GROUP BY ALL""", "mapped"),
    "rare_label_group": sql("""+ labelled AS (SELECT concat_ws('/', city_code, call_type, CAST(year AS VARCHAR)) AS label FROM dispatch),
        per AS (SELECT label, count(*) AS c FROM labelled GROUP BY 1)
        SELECT CASE WHEN c < 8 THEN 'Other / Rare Call Type' ELSE label END AS label, CAST(sum(c) AS BIGINT) AS n FROM per GROUP BY 1""", "dispatch"),
    "label_encode": sql("SELECT incident_id, mpds_group, CAST(dense_rank() OVER (ORDER BY mpds_group) - 1 AS INTEGER) AS label_code FROM mapped", "mapped"),
    "align_label_space": sql(f"""+ parts AS ({LABELLED}), top AS ({TRAIN_TOP})
        SELECT CASE WHEN mpds_group IN (SELECT mpds_group FROM top) THEN mpds_group ELSE 'Other' END AS mpds_group, count(*) AS n FROM parts GROUP BY ALL""", "mapped"),
    # validation
    "validate_rules": sql(f"SELECT incident_id, {VIOLATIONS} AS violations FROM dispatch_dirty", "dispatch_dirty"),
    "validation_summary": sql(f"""
        SELECT count(*) FILTER (WHERE v = '') AS valid_count, count(*) FILTER (WHERE v <> '') AS invalid_count, count(*) AS total_count, {r('avg(p)', 4)} AS mean_completeness
        FROM (SELECT {VIOLATIONS} AS v, {PCT} AS p FROM dispatch_dirty)""", "dispatch_dirty"),
    "validation_errors": sql(f"SELECT incident_id, violations FROM (SELECT incident_id, {VIOLATIONS} AS violations FROM dispatch_dirty) WHERE violations <> '' ORDER BY incident_id, violations LIMIT 100", "dispatch_dirty"),
    "data_completeness_pct": sql(f"SELECT incident_id, {PCT} AS data_completeness_pct FROM dispatch_dirty", "dispatch_dirty"),
    "null_profile": sql("SELECT column_name, null_count, " + r("null_count * 100.0 / total", 2) + " AS null_pct FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count, count(*) AS total FROM dispatch"
        for c in ("incident_id", "priority_description", "call_type", "census_block_group", "latitude")) + ")", "dispatch"),
    "many_to_one_guard": sql("SELECT * FROM census", "census"),
    "quarantine_split": sql(f"SELECT incident_id, {VIOLATIONS} AS reasons FROM dispatch_dirty", "dispatch_dirty"),
    # joins
    "normalise_geoid": sql(f"SELECT DISTINCT GEOID AS geoid, {geoid('GEOID')} AS census_block_group FROM census_raw", "census_raw"),
    "standardise_census": sql(f"""
        SELECT census_block_group, census_name, population, land_area_sq_km, median_household_income, {r('population_density_per_sq_km', 6)} AS population_density_per_sq_km,
          {r('poverty_rate', 6)} AS poverty_rate, {r('white_alone_pct', 6)} AS white_alone_pct, {r('black_alone_pct', 6)} AS black_alone_pct,
          {r('asian_alone_pct', 6)} AS asian_alone_pct, {r('hispanic_or_latino_pct', 6)} AS hispanic_or_latino_pct FROM census""", "census"),
    "join_demographics": sql(f"SELECT incident_id, census_block_group, census_name, population, {r('poverty_rate', 6)} AS poverty_rate FROM dispatch LEFT JOIN census USING (census_block_group)", "dispatch", "census"),
    "join_forecasts": sql("""
        SELECT t.series_id, t.ds, t.yhat AS trend_yhat, b.yhat AS boosted_yhat, yhat_lower, yhat_upper
        FROM fc_trend t JOIN fc_boosted b ON t.series_id = b.series_id AND t.ds = b.ds""", "fc_trend", "fc_boosted"),
    "join_stats_back": sql(f"""+ cells AS ({CELLS})
        SELECT *, {r('avg(call_count) OVER (PARTITION BY quarter)', 6)} AS mean, {r('stddev_samp(call_count) OVER (PARTITION BY quarter)', 6)} AS std FROM cells""", "heatmap"),
    "join_anomaly_flags": sql(f"+ cells AS ({CELLS}) SELECT *, call_count > (SELECT avg(call_count) FROM cells) AS is_anomaly FROM cells", "heatmap"),
    "code_to_name": sql("SELECT incident_id, city_code, n_name AS looked_up FROM dispatch LEFT JOIN nation ON city_code = 'C' || n_nationkey", "dispatch"),
    "semi_top_n": sql("SELECT incident_id, city_name FROM dispatch WHERE city_name IN (SELECT city_name FROM dispatch GROUP BY 1 ORDER BY count(*) DESC, city_name LIMIT 5)", "dispatch"),
    "union_by_name": sql("""
        SELECT incident_id, service_type, city_name, CAST(NULL AS VARCHAR) AS call_type FROM dispatch WHERE service_type = 'EMS'
        UNION ALL SELECT incident_id, service_type, NULL, call_type FROM dispatch WHERE service_type = 'Fire'""", "dispatch"),
    "set_difference_split": sql(f"SELECT incident_id, {split_case()} = 'train' AS in_train FROM {ranked('dispatch', 'incident_id')}", "dispatch"),
    "set_intersection_ids": sql("""
        SELECT query_id, rank, array_to_string(list_sort(list_intersect(['src' || (query_id % 5), 'src' || ((query_id + 1) % 5)], candidate_ids)), ',') AS matched
        FROM candidates""", "candidates"),
    "distinct_sorted_options": sql("""
        SELECT DISTINCT 'year' AS option_kind, CAST(year AS VARCHAR) AS option_value FROM dispatch WHERE year IS NOT NULL
        UNION SELECT 'service_type', service_type FROM dispatch WHERE service_type IS NOT NULL
        UNION SELECT 'call_type', call_type FROM dispatch WHERE call_type IS NOT NULL""", "dispatch"),
    # aggregations
    "overview_agg": sql("SELECT * FROM overview", "overview"),
    "temporal_heatmap_agg": sql("SELECT * FROM heatmap", "heatmap"),
    "temporal_slope_agg": sql("SELECT * FROM slope", "slope"),
    "geo_density_agg": sql(f"SELECT year, service, call_type, census_block_group, call_count, {r('latitude', 6)} AS latitude, {r('longitude', 6)} AS longitude FROM density", "density"),
    "geo_city_agg": sql(f"SELECT year, service, city_name, call_count, {r('completeness_sum', 6)} AS completeness_sum, completeness_count FROM city", "city"),
    "geo_bitmap_distinct": sql("""
        SELECT service, CAST(NULL AS INTEGER) AS year, count(*) AS total_calls, count(DISTINCT census_block_group) AS unique_cbg_count FROM prepared GROUP BY 1
        UNION ALL SELECT NULL, CAST(year AS INTEGER), count(*), count(DISTINCT census_block_group) FROM prepared GROUP BY 2
        UNION ALL SELECT 'EMS since', 1995, count(*), count(DISTINCT census_block_group) FROM prepared WHERE service = 'EMS' AND year >= 1995""", "prepared"),
    "geo_call_type_cbg_agg": sql("SELECT * FROM types", "types"),
    "kpi_totals": sql(f"""
        SELECT {bigint('sum(n)')} AS total_calls, {bigint('sum(ems)')} AS ems_calls, {bigint('sum(fire)')} AS fire_calls, count(*) AS quarters,
          {r('sum(n) / greatest(count(*), 1)', 6)} AS avg_per_quarter
        FROM (SELECT year, quarter, sum(call_count) AS n, sum(call_count) FILTER (service = 'EMS') AS ems, sum(call_count) FILTER (service = 'Fire') AS fire
          FROM overview GROUP BY ALL)""", "overview"),
    "service_share": sql(f"SELECT service, {bigint('sum(call_count)')} AS call_count FROM overview GROUP BY 1", "overview"),
    "top_categories": sql(f"SELECT call_type, {bigint('sum(call_count)')} AS call_count FROM overview GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 8", "overview"),
    "yearly_by_service": sql(f"SELECT year, service, {bigint('sum(call_count)')} AS call_count FROM overview GROUP BY ALL", "overview"),
    "triage_flow": sql(f"""+ kept AS (SELECT * FROM overview WHERE call_type IN ({TOP_TYPES}))
        SELECT 'service_to_level' AS link, service AS from_node, priority_level AS to_node, {bigint('sum(call_count)')} AS call_count FROM kept GROUP BY ALL
        UNION ALL SELECT 'level_to_call_type', priority_level, call_type, {bigint('sum(call_count)')} FROM kept GROUP BY ALL""", "overview"),
    "priority_funnel": sql(f"""
        SELECT priority_level, {bigint('sum(call_count)')} AS call_count,
          CAST(list_position(['Life Threatening', 'ALS', 'BLS', 'Non-Emergency', 'Other'], priority_level) AS INTEGER) AS level_order FROM overview GROUP BY ALL""", "overview"),
    "quality_pipeline": sql(f"""
        SELECT CAST(1 AS INTEGER) AS stage_order, 'Total Calls' AS stage, {bigint('sum(call_count)')} AS records FROM overview
        UNION ALL SELECT 2, 'With Coordinates', {bigint('sum(with_coords_count)')} FROM overview
        UNION ALL SELECT 3, 'High Completeness', {bigint('sum(high_completeness_count)')} FROM overview""", "overview"),
    "quarter_year_matrix": sql("SELECT year, " + ", ".join(f"nullif(count(*) FILTER (WHERE quarter = '{q}'), 0) AS {q}" for q in ("Q1", "Q2", "Q3", "Q4")) + " FROM dispatch GROUP BY 1", "dispatch"),
    "slope_first_last": sql(f"""+ ends AS (SELECT min(year) AS a, max(year) AS b FROM slope)
        SELECT call_type, {bigint('coalesce(sum(call_count) FILTER (year = a), 0)')} AS first_count, {bigint('coalesce(sum(call_count) FILTER (year = b), 0)')} AS last_count,
          a AS first_year, b AS last_year
        FROM slope, ends WHERE year IN (a, b) AND a < b GROUP BY call_type, a, b ORDER BY first_count + last_count DESC, call_type LIMIT 6""", "slope"),
    "quarter_anomaly": sql(f"""+ cells AS ({CELLS}), stats AS (SELECT quarter, avg(call_count) AS m, stddev_samp(call_count) AS s, count(*) AS c FROM cells GROUP BY 1)
        SELECT year, quarter, call_count, CASE WHEN (SELECT min(c) FROM stats) >= 3
          THEN coalesce((call_count - m) / coalesce(nullif(s, 0), nullif((SELECT stddev_samp(call_count) FROM cells), 0), 1), 0) > 1.2
          ELSE (SELECT median(call_count) FROM cells) > 0 AND (SELECT max(call_count) >= 1.1 * median(call_count) FROM cells)
            AND call_count = (SELECT max(call_count) FROM cells) END AS is_anomaly
        FROM cells JOIN stats USING (quarter)""", "heatmap"),
    "cbg_centroids": sql(f"SELECT census_block_group, call_count, {r('latitude', 6)} AS latitude, {r('longitude', 6)} AS longitude FROM centroids", "centroids"),
    "geo_kpis": clusters(f"""
        SELECT (SELECT count(*) FROM centroids) AS block_groups, (SELECT {bigint('sum(call_count)')} FROM centroids) AS located_calls,
          (SELECT count(DISTINCT cluster) FROM clustered WHERE cluster >= 0) AS hotspot_clusters,
          (SELECT {r('CASE WHEN count(*) > 1 AND avg(mean) > 0 THEN greatest(0, least(1, 1 - stddev_samp(mean) / avg(mean))) END', 6)}
            FROM city_mean WHERE mean IS NOT NULL) AS equity""", "centroids", "city_mean", source="centroids"),
    "city_service_top": sql(f"""
        SELECT city_name, service, {bigint('sum(call_count)')} AS call_count FROM city
        WHERE city_name IN (SELECT city_name FROM city GROUP BY 1 ORDER BY sum(call_count) DESC, city_name LIMIT 12) GROUP BY ALL""", "city"),
    "equity_scatter": sql(f"""
        SELECT city_name, service, {bigint('sum(call_count)')} AS call_count, {r('sum(completeness_sum) / sum(completeness_count) * 100', 2)} AS completeness_pct
        FROM city GROUP BY ALL HAVING sum(completeness_count) > 0""", "city"),
    "equity_rank": sql(f"""
        SELECT city_name, score_pct, CASE WHEN score_pct >= 90 THEN 'success' WHEN score_pct >= 70 THEN 'warning' ELSE 'danger' END AS band
        FROM (SELECT city_name, {r('mean * 100', 2)} AS score_pct FROM city_mean WHERE mean IS NOT NULL) ORDER BY score_pct DESC, city_name LIMIT 15""", "city_mean"),
    "call_type_spread": sql(f"SELECT call_type, {bigint('sum(total_calls)')} AS total_calls, max(unique_cbg_count) AS cbg_spread FROM types GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 12", "types"),
    "bubble_scale": sql(f"SELECT census_block_group, call_count, {r('4 + 28 * (call_count / (SELECT max(call_count) FROM centroids))', 6)} AS bubble_size FROM centroids", "centroids"),
    "grid_density": sql(f"""+ spots AS (SELECT call_count, {r('latitude', 6)} AS latitude, {r('longitude', 6)} AS longitude FROM centroids),
        span AS (SELECT min(latitude) AS y0, max(latitude) AS y1, min(longitude) AS x0, max(longitude) AS x1 FROM spots)
        SELECT CAST(greatest(1, ceil((latitude - y0) / (y1 - y0) * 20)) AS INTEGER) AS lat_bin, CAST(greatest(1, ceil((longitude - x0) / (x1 - x0) * 20)) AS INTEGER) AS lon_bin,
          {bigint('sum(call_count)')} AS total, {r('avg(latitude)', 6)} AS latitude, {r('avg(longitude)', 6)} AS longitude FROM spots, span GROUP BY 1, 2""", "centroids"),
    "cluster_summary": clusters(f"""
        SELECT cluster, count(*) AS points, {r('avg(latitude)', 9)} AS centre_lat, {r('avg(longitude)', 9)} AS centre_lon,
          (SELECT {r('avg(latitude)', 9)} FROM clustered) AS map_lat, (SELECT {r('avg(longitude)', 9)} FROM clustered) AS map_lon
        FROM clustered WHERE cluster >= 0 GROUP BY 1"""),
    "value_counts_top": sql("SELECT priority_code, count(*) AS call_count FROM dispatch GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15", "dispatch"),
    "describe_column": sql(f"""
        SELECT count(response_time_sec) AS count, {r('avg(response_time_sec)', 6)} AS mean, {r('stddev_samp(response_time_sec)', 6)} AS std, min(response_time_sec) AS min,
          {r('quantile_cont(response_time_sec, 0.25)', 6)} AS q25, {r('median(response_time_sec)', 6)} AS median, {r('quantile_cont(response_time_sec, 0.75)', 6)} AS q75,
          max(response_time_sec) AS max FROM dispatch""", "dispatch"),
    "histogram": sql("SELECT CAST(least(floor(completeness_score / 0.05e0), 19) AS INTEGER) AS bin, count(*) AS n FROM dispatch GROUP BY 1", "dispatch"),
    "confidence_histogram": sql("SELECT is_correct, CAST(least(floor(max_confidence / 0.02e0), 49) AS INTEGER) AS bin, count(*) AS n FROM predictions GROUP BY ALL", "predictions"),
    "quarterly_trend": sql("""
        SELECT year || '-' || quarter AS period, CAST(year * 10 + CAST(substr(quarter, 2, 1) AS INTEGER) AS INTEGER) AS period_sort, service_type, count(*) AS call_count
        FROM dispatch GROUP BY ALL""", "dispatch"),
    "priority_over_time": sql("""
        SELECT year || '-' || quarter AS period, CAST(year * 10 + CAST(substr(quarter, 2, 1) AS INTEGER) AS INTEGER) AS period_sort, priority_code, count(*) AS call_count
        FROM dispatch WHERE priority_code IN (SELECT priority_code FROM dispatch GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 5) GROUP BY ALL""", "dispatch"),
    "period_extremes": sql(f"""+ t AS (SELECT year || '-' || quarter AS period, year * 10 + CAST(substr(quarter, 2, 1) AS INTEGER) AS ps, count(*) AS n FROM dispatch GROUP BY ALL)
        SELECT count(*) AS periods, {r('avg(n)', 6)} AS mean_count, max(n) AS max_count, (SELECT period FROM t ORDER BY n DESC, ps LIMIT 1) AS max_period,
          min(n) AS min_count, (SELECT period FROM t ORDER BY n, ps LIMIT 1) AS min_period FROM t""", "dispatch"),
    "geo_coverage": sql("""
        SELECT count(*) AS total_rows, count(census_block_group) AS with_key, count(*) - count(census_block_group) AS without_key,
          count(DISTINCT census_block_group) AS distinct_keys, min(latitude) AS min_lat, max(latitude) AS max_lat, min(longitude) AS min_lon, max(longitude) AS max_lon FROM dispatch""", "dispatch"),
    "missing_geo_by_city": sql(f"""
        SELECT city_name, count(*) AS total, count(*) - count(census_block_group) AS missing_key, {r('(count(*) - count(census_block_group)) / count(*) * 100.0', 6)} AS missing_pct,
          count(*) - count(longitude) AS missing_lon, count(*) - count(latitude) AS missing_lat
        FROM dispatch WHERE city_name IS NOT NULL GROUP BY 1 ORDER BY missing_key DESC, city_name LIMIT 15""", "dispatch"),
    "blockgroup_profile": sql("""+ located AS (SELECT * FROM dispatch WHERE census_block_group IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL),
        modes AS (SELECT census_block_group, city_name, row_number() OVER (PARTITION BY census_block_group ORDER BY count(*) DESC, city_name) AS rn FROM located GROUP BY 1, 2)
        SELECT l.census_block_group, count(*) AS call_count, arg_min(latitude, incident_id) AS lat, arg_min(longitude, incident_id) AS lon, any_value(m.city_name) AS top_city
        FROM located l JOIN modes m ON m.census_block_group = l.census_block_group AND rn = 1 GROUP BY 1 ORDER BY call_count DESC, 1 LIMIT 10""", "dispatch"),
    "distinct_summary": sql("""
        SELECT count(*) AS total_rows, min(year) AS min_year, max(year) AS max_year, count(DISTINCT call_type) AS call_types, count(DISTINCT city_name) AS cities,
          count(DISTINCT city_code) AS city_codes, count(DISTINCT census_block_group) AS block_groups FROM dispatch""", "dispatch"),
    "city_service_breakdown": sql("""
        SELECT city_name, service_type, count(*) AS call_count FROM dispatch
        WHERE city_name IN (SELECT city_name FROM dispatch GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 10) GROUP BY ALL""", "dispatch"),
    # features
    "cyclical_features": f"""
        SELECT event_id, CAST(h AS TINYINT) AS hour, CAST(d AS TINYINT) AS day_of_week, CAST(m AS TINYINT) AS month,
          {wave('h', 24, 'hour')}, {wave('d', 7, 'dow')}, {wave('m', 12, 'month')}
        FROM (SELECT event_id, hour(ts) AS h, isodow(ts) - 1 AS d, month(ts) AS m FROM events)""",
    "geo_target_encoding": f"SELECT event_id, user_id, {r('avg(value) OVER (PARTITION BY user_id)', 9)} AS user_id_target_enc FROM events",
    "lag_features": """
        SELECT event_id, event_type, lag(value, 1) OVER w AS value_lag_1, lag(value, 2) OVER w AS value_lag_2, lag(value, 3) OVER w AS value_lag_3
        FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)""",
    "series_features": sql("SELECT * FROM (SELECT series_id, ds, y, CAST(month(ds) AS INTEGER) AS month, CAST(quarter(ds) AS INTEGER) AS quarter, CAST(year(ds) AS INTEGER) AS year, "
        "CAST(row_number() OVER w - 1 AS INTEGER) AS time_index, " + wave("month(ds)", 12, "month") + ", "
        + ", ".join(f"lag(y, {n}) OVER w AS lag_{n}" for n in (1, 2, 3, 6, 12)) + ", "
        + ", ".join(r(f"avg(y) OVER (PARTITION BY series_id ORDER BY ds ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)", 6) + f" AS rolling_mean_{n}" for n in (3, 6))
        + " FROM series WINDOW w AS (PARTITION BY series_id ORDER BY ds)) WHERE lag_12 IS NOT NULL", "series"),
    "quarter_lag_features": sql("SELECT * FROM (SELECT series_id, ds, y, CAST(row_number() OVER w - 1 AS INTEGER) AS t, " + wave("quarter(ds)", 4, "q") + ", "
        + ", ".join(f"lag(y, {n}) OVER w AS lag_{n}" for n in (1, 2, 4)) + " FROM series WINDOW w AS (PARTITION BY series_id ORDER BY ds)) WHERE lag_4 IS NOT NULL", "series"),
    "yoy_growth": sql(f"""
        SELECT year, n AS total_calls, {r('(n - lag(n) OVER (ORDER BY year)) * 100.0 / lag(n) OVER (ORDER BY year)', 6)} AS yoy_growth_pct
        FROM (SELECT year, count(*) AS n FROM dispatch GROUP BY 1)""", "dispatch"),
    "period_rank": sql("""
        SELECT year, quarter, CAST(k AS INTEGER) AS period_no, CASE WHEN n < 4 THEN 'random' WHEN k = n THEN 'test' WHEN k = n - 1 THEN 'validation' ELSE 'train' END AS role
        FROM (SELECT year, quarter, row_number() OVER (ORDER BY year, quarter) AS k, count(*) OVER () AS n FROM (SELECT DISTINCT year, quarter FROM dispatch))""", "dispatch"),
    "row_share_normalise": sql(f"SELECT truth, predicted, n, {r('n / sum(n) OVER (PARTITION BY truth) * 100.0', 6)} AS row_pct FROM confusion", "confusion"),
    "zscore_scale": sql("SELECT census_block_group, " + ", ".join(
        r(f"({c} - (SELECT avg({c}) FROM points)) / (SELECT stddev_pop({c}) FROM points)", 6) + f" AS {c}_z" for c in ("latitude", "longitude")) + " FROM points", "points"),
    # forecasts
    "monthly_series": sql("SELECT service_type, CAST(date_trunc('month', call_create_time) AS TIMESTAMP) AS ds, count(*) AS y FROM dispatch GROUP BY ALL", "dispatch"),
    "quarterly_series": sql("""+ s AS (SELECT CAST(date_trunc('quarter', call_create_time) AS TIMESTAMP) AS ds, count(*) AS y FROM dispatch
          WHERE service_type = 'EMS' AND call_type = 'SICK' GROUP BY 1)
        SELECT g.ds, coalesce(y, 0) AS y FROM (SELECT unnest(generate_series((SELECT min(ds) FROM s), (SELECT max(ds) FROM s), INTERVAL 3 MONTH)) AS ds) g LEFT JOIN s ON s.ds = g.ds""", "dispatch"),
    "series_validate": sql("SELECT series_id, ds, CAST(y AS DOUBLE) AS y FROM series", "series"),
    "future_periods": sql("""
        SELECT series_id, CAST(step AS INTEGER) AS step, CAST(last + to_months(CAST(3 * step AS INTEGER)) AS TIMESTAMP) AS ds
        FROM (SELECT series_id, max(ds) AS last FROM series GROUP BY 1), (SELECT unnest([1, 2, 3, 4]) AS step)""", "series"),
    "ensemble_combine": sql(f"""
        SELECT t.series_id, t.ds, t.yhat AS trend_yhat, b.yhat AS boosted_yhat, yhat_lower, yhat_upper, {r('0.4e0 * t.yhat + 0.6e0 * b.yhat', 6)} AS yhat
        FROM fc_trend t JOIN fc_boosted b ON t.series_id = b.series_id AND t.ds = b.ds""", "fc_trend", "fc_boosted"),
    "forecast_finalise": sql("""+ hist AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ds DESC) AS k, count(*) OVER (PARTITION BY series_id) AS n FROM series),
        shown AS (SELECT series_id, ds, 'history' AS kind, CAST(y AS DOUBLE) AS value, CAST(NULL AS DOUBLE) AS lower_bound, CAST(NULL AS DOUBLE) AS upper_bound FROM hist WHERE k <= 12
          UNION ALL SELECT series_id, ds, 'forecast', round_even(greatest(0, yhat), 0), round_even(greatest(0, yhat_lower), 0), round_even(greatest(0, yhat_upper), 0) FROM fc_trend)
        SELECT *, 'Q' || quarter(ds) || ' ' || year(ds) AS quarter_label FROM shown WHERE series_id IN (SELECT series_id FROM hist WHERE n >= 6)""", "series", "fc_trend"),
    "mape": sql(f"""
        SELECT s.series_id, {r('avg(abs((y - yhat) / nullif(y, 0)))', 6)} AS mape, count(*) AS n_rows
        FROM series s JOIN fc_trend t ON t.series_id = s.series_id AND t.ds = s.ds GROUP BY 1""", "series", "fc_trend"),
    # splits and classification
    "stratified_split": sql(f"SELECT incident_id, mpds_group, split FROM ({LABELLED})", "mapped"),
    "classifier_frame": sql("""+ kept AS (SELECT incident_id, quarter, city_code, trim(call_type) AS ct FROM dispatch WHERE trim(call_type) <> ''),
        grouped AS (SELECT incident_id, quarter, city_code, CASE WHEN count(*) OVER (PARTITION BY ct) < 8 THEN 'Other / Rare Call Type' ELSE ct END AS call_type FROM kept)
        SELECT *, CAST(dense_rank() OVER (ORDER BY call_type) - 1 AS INTEGER) AS label_code FROM grouped""", "dispatch"),
    "forecaster_split": sql("""+ counted AS (SELECT year, quarter, service_type, city_code, priority_code, count(*) AS call_count FROM dispatch GROUP BY ALL),
        periods AS (SELECT year, quarter, row_number() OVER (ORDER BY year DESC, quarter DESC) AS k FROM (SELECT DISTINCT year, quarter FROM counted))
        SELECT counted.*, CASE k WHEN 1 THEN 'test' WHEN 2 THEN 'validation' ELSE 'train' END AS role FROM counted JOIN periods USING (year, quarter)""", "dispatch"),
    "fit_eval_split": sql(f"+ located AS (SELECT * FROM dispatch WHERE latitude IS NOT NULL AND longitude IS NOT NULL) SELECT incident_id, CASE WHEN rk <= floor(n * 0.8e0 + 0.5e0) THEN 'fit' ELSE 'eval' END AS split FROM {ranked('located', 'incident_id')}", "dispatch"),
    "flag_disagreements": sql("SELECT rid, is_disagreement FROM flagged", "flagged"),
    "confusion_matrix": sql("SELECT truth, " + ", ".join(f"{bigint(f'coalesce(sum(n) FILTER (predicted = {quoted([c])}), 0)')} AS {c}" for c in "ANR") + " FROM confusion GROUP BY 1", "confusion"),
    "per_class_metrics": sql(f"SELECT class, {r('precision', 4)} AS precision, {r('recall', 4)} AS recall, {r('f1', 4)} AS f1, support FROM class_raw", "class_raw"),
    "overall_metrics": sql(f"SELECT {OVERALL} FROM class_raw", "class_raw"),
    "inject_label_errors": sql("SELECT rid, truth_code, label_after, is_injected FROM injected", "injected"),
    "threshold_sweep": sql(f"""
        SELECT threshold, p AS n_injected, u AS n_untouched, fp + fu AS n_flagged, fp AS n_flagged_injected, fu AS n_flagged_untouched, {r('coalesce(fp / nullif(p, 0), 0)', 4)} AS recall_on_injected,
          {r('coalesce(fu / nullif(u, 0), 0)', 4)} AS false_alarm_rate, {r('coalesce(fp / nullif(fp + fu, 0), 0)', 4)} AS precision_proxy
        FROM (SELECT threshold, count(*) FILTER (WHERE is_injected) AS p, count(*) FILTER (WHERE NOT is_injected) AS u, count(*) FILTER (WHERE is_injected AND max_confidence > threshold AND predicted_code <> label_after) AS fp,
            count(*) FILTER (WHERE NOT is_injected AND max_confidence > threshold AND predicted_code <> label_after) AS fu
          FROM injected, (SELECT unnest([0.5e0, 0.6e0, 0.7e0, 0.8e0, 0.9e0]) AS threshold) GROUP BY 1)""", "injected"),
    "agreement_status": sql("SELECT CASE WHEN is_correct AND max_confidence >= 0.7e0 THEN 'Match' WHEN is_correct THEN 'Review' ELSE 'Mismatch' END AS status, count(*) AS n FROM predictions GROUP BY 1", "predictions"),
    "agreement_by_group": sql(f"""
        SELECT *, {BAND.format(x='accuracy_pct')} AS status FROM (SELECT mpds_group, count(*) AS total, count(*) FILTER (WHERE is_correct) AS matches, {r('avg(CAST(is_correct AS DOUBLE)) * 100', 2)} AS accuracy_pct,
          {r('avg(max_confidence) * 100', 1)} AS avg_confidence_pct, count(*) FILTER (WHERE is_disagreement) AS disagreements FROM flagged GROUP BY 1)""", "flagged"),
    "completeness_trend": sql(f"SELECT year, {r('avg(completeness_score) * 100', 2)} AS completeness_pct FROM predictions GROUP BY 1", "predictions"),
    "metric_gates": sql(f"""+ high AS (SELECT *, row_number() OVER (ORDER BY {r('anomaly_score', 6)}, md5('42|' || incident_id)) AS rk, count(*) OVER () AS n FROM scored),
        vals(metric, value) AS (SELECT 'macro_f1', (SELECT {r('avg(f1)', 4)} FROM class_raw)
          UNION ALL SELECT 'avg_mape', (SELECT {r('avg(abs((y - yhat) / nullif(y, 0)))', 6)} FROM series s JOIN fc_trend t ON t.series_id = s.series_id AND t.ds = s.ds)
          UNION ALL SELECT 'iso_forest_recall_20', (SELECT {r("count(*) FILTER (WHERE regexp_matches(priority_code, 'E1|F1') AND rk <= floor(n * 0.2e0)) / nullif(count(*) FILTER (WHERE regexp_matches(priority_code, 'E1|F1')), 0)", 6)} FROM high)),
        judged AS (SELECT t.*, value, coalesce(CASE WHEN direction = 'greater' THEN value >= target ELSE value < target END, false) AS passed
          FROM (VALUES ('macro_f1', 0.55e0, 'greater'), ('avg_mape', 0.15e0, 'less'), ('dbscan_silhouette', 0.35e0, 'greater'), ('iso_forest_recall_20', 0.25e0, 'greater')) t(metric, target, direction)
          LEFT JOIN vals USING (metric))
        SELECT *, (SELECT bool_and(passed) FROM judged) AS overall_pass FROM judged""", "class_raw", "series", "fc_trend", "scored"),
    "qa_kpis": sql(f"""
        SELECT count(*) FILTER (WHERE is_disagreement) AS disagreements, count(*) AS n_rows, {r('coalesce(avg(completeness_score), 0)', 6)} AS mean_completeness,
          {r('coalesce(avg(completeness_score), 0)', 6)} >= 0.9e0 AS meets_target FROM flagged WHERE year IN (1997, 1998, 1999) AND service_type = 'EMS'""", "flagged"),
    "class_weights": sql(f"""
        SELECT mpds_group, n_rows, {r('(SELECT count(*) FROM predictions) / ((SELECT count(DISTINCT mpds_group) FROM predictions) * n_rows)', 6)} AS weight
        FROM (SELECT mpds_group, count(*) AS n_rows FROM predictions GROUP BY 1)""", "predictions"),
    # spatial
    "hotspot_input": sql(f"SELECT census_block_group, {r('latitude', 6)} AS latitude, {r('longitude', 6)} AS longitude, call_volume FROM points", "points"),
    "neighbour_count": sql(f"""
        SELECT a.census_block_group, count(*) AS neighbours FROM points a JOIN points b
          ON (a.latitude - b.latitude) * (a.latitude - b.latitude) + (a.longitude - b.longitude) * (a.longitude - b.longitude) <= {EPS2} GROUP BY 1""", "points"),
    "core_points": sql(f"""
        SELECT a.census_block_group FROM points a JOIN points b
          ON (a.latitude - b.latitude) * (a.latitude - b.latitude) + (a.longitude - b.longitude) * (a.longitude - b.longitude) <= {EPS2} GROUP BY 1 HAVING count(*) >= 3""", "points"),
    "dbscan": clusters("SELECT census_block_group, cluster FROM clustered"),
    "assign_clusters": clusters("""
        SELECT count(DISTINCT cluster) FILTER (cluster >= 0) AS clusters, count(DISTINCT census_block_group) AS block_groups,
          count(DISTINCT census_block_group) FILTER (cluster >= 0) AS block_groups_in_hotspots FROM clustered"""),
    "silhouette_exact": sql(f"""+ p AS (SELECT census_block_group AS id, latitude AS x, longitude AS y, CAST(floor(latitude * 2) AS INTEGER) AS c FROM points),
        sizes AS (SELECT c, count(*) AS n FROM p GROUP BY 1),
        sums AS (SELECT a.id, a.c AS own, b.c AS other, sum(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y))) AS d FROM p a, p b GROUP BY ALL),
        parts AS (SELECT id, own, min(CASE WHEN own = other THEN d / nullif(n - 1, 0) END) AS a, min(CASE WHEN own <> other THEN d / n END) AS b FROM sums JOIN sizes ON c = other GROUP BY ALL)
        SELECT {r('avg(CASE WHEN a IS NULL OR b IS NULL THEN 0 ELSE coalesce((b - a) / nullif(greatest(a, b), 0), 0) END)', 6)} AS silhouette,
          (SELECT count(*) FROM sizes WHERE c >= 0) AS clusters FROM parts""", "points"),
    "recall_top_share": sql(f"""
        SELECT CAST(floor(any_value(n) * 0.2e0) AS BIGINT) AS top_rows, count(*) FILTER (WHERE high) AS high_priority_rows, count(*) FILTER (WHERE high AND rk <= floor(n * 0.2e0)) AS captured,
          {r('count(*) FILTER (WHERE high AND rk <= floor(n * 0.2e0)) / nullif(count(*) FILTER (WHERE high), 0)', 6)} AS recall
        FROM (SELECT regexp_matches(priority_code, 'E1|F1') AS high, row_number() OVER (ORDER BY {r('anomaly_score', 6)}, md5('42|' || incident_id)) AS rk, count(*) OVER () AS n FROM scored)""", "scored"),
    # text
    "html_visible_text": html_oracle(),
    "html_visible_text_exact": exact_html_oracle(),
    "character_references": references_oracle(),
    "paragraph_pack": sql("""+ parts AS (SELECT doc_id, list_filter(list_transform(string_split_regex(text, '\\n\\s*\\n'), lambda p: trim(p, ' ' || chr(9) || chr(10) || chr(13))), lambda p: p <> '') AS p FROM docs),
        packs AS (SELECT doc_id, list_reduce(list_transform(p, lambda x: [x]), lambda acc, x: CASE WHEN length(acc[-1]) + 2 + length(x[1]) <= 900
          THEN list_concat(acc[:-2], [acc[-1] || chr(10) || chr(10) || x[1]]) ELSE list_concat(acc, x) END) AS packs FROM parts WHERE len(p) > 0)
        SELECT doc_id, CAST(position - 1 AS INTEGER) AS position, CAST(length(paragraph) AS INTEGER) AS chars
        FROM (SELECT doc_id, unnest(packs) AS paragraph, generate_subscripts(packs, 1) AS position FROM packs)""", "docs"),
    "clean_text": sql(f"SELECT doc_id, {tidy_space('t')} AS text FROM (SELECT doc_id, {BARE.format(x=unescaped('text'))} AS t FROM docs)", "docs"),
    "slugify": sql("SELECT doc_id, coalesce(nullif(trim(regexp_replace(lower(trim(title || ' / ' || text)), '[^a-z0-9]+', '_', 'g'), '_'), ''), 'document') AS slug FROM docs", "docs"),
    "doc_quality": sql(f"""
        SELECT doc_id, CAST({P['chars']} AS INTEGER) AS chars, {r(P['alpha'], 3)} AS alpha_ratio, {r(P['readable'], 3)} AS readable_ratio,
          {P['chars']} >= 120 AND {P['alpha']} >= 0.5 AND {P['readable']} >= 0.95 AS passes FROM docs""", "docs"),
    "garble_detect": sql(f"""
        SELECT doc_id, {garbled(P)} AS is_garbled, {r(P['non_ascii'], 3)} AS non_ascii_ratio, {P['marker']} AS has_garble_marker, {r(P['vowelless'], 3)} AS vowel_less_token_ratio,
          {P['run']} AS has_long_special_run FROM docs""", "docs"),
    "validate_chunk": sql(f"SELECT doc_id, array_to_string(reasons, ',') AS reasons, len(reasons) = 0 AS passes FROM (SELECT doc_id, {chunk_reasons('text')} AS reasons FROM docs)", "docs"),
    "quality_report": sql(f"""+ checked AS (SELECT source_id, len({chunk_reasons('text')}) = 0 AS ok FROM docs),
        per AS (SELECT source_id, count(*) AS total, count(*) FILTER (WHERE ok) AS passed FROM checked GROUP BY 1 UNION ALL SELECT '*', count(*), count(*) FILTER (WHERE ok) FROM checked)
        SELECT *, total - passed AS failed, {r('passed / total', 3)} AS pass_rate FROM per""", "docs"),
    "rejected_samples": sql(f"""
        SELECT doc_id, source_id, array_to_string(reasons, ',') AS reasons, substr(text, 1, 160) AS preview
        FROM (SELECT *, {chunk_reasons('text')} AS reasons FROM docs) WHERE len(reasons) > 0 ORDER BY doc_id LIMIT 10""", "docs"),
    "build_chunks": sql(f"""+ lines AS (SELECT doc_id, source_id, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM docs),
        good AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS chunk_index FROM lines WHERE len({chunk_reasons('text')}) = 0)
        SELECT substr(sha1(source_id || ':' || chunk_index || ':' || text), 1, 16) AS chunk_id, source_id, doc_id, CAST(chunk_index AS INTEGER) AS chunk_index, text,
          CAST(length(text) AS INTEGER) AS chunk_chars FROM good""", "docs"),
    "keyword_rank": sql(f"""+ tok AS (SELECT item_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS term, generate_subscripts(regexp_extract_all(lower(text), '[a-z0-9]+'), 1) AS p FROM benchmark),
        kept AS (SELECT item_id, term, row_number() OVER (PARTITION BY item_id ORDER BY p) AS k FROM tok WHERE length(term) > 2 AND term NOT IN ({STOP})),
        terms AS (SELECT item_id, term, count(*) AS times, min(k) <= 3 AS lead FROM kept GROUP BY ALL),
        hay AS (SELECT doc_id, {RANK_TEXT} AS t FROM docs),
        hits AS (SELECT doc_id, term, CAST((length(t) - length(replace(t, term, ''))) / length(term) AS BIGINT) AS c FROM hay, (SELECT DISTINCT term FROM terms) WHERE contains(t, term)),
        scores AS (SELECT item_id, doc_id, sum(c * times) + CASE WHEN count(*) FILTER (WHERE lead) = (SELECT count(*) FILTER (WHERE lead) FROM terms x WHERE x.item_id = terms.item_id) THEN 5 ELSE 0 END AS score
          FROM hits JOIN terms USING (term) GROUP BY item_id, doc_id)
        SELECT item_id AS query_id, doc_id, CAST(score AS BIGINT) AS score, CAST(rk AS INTEGER) AS rank
        FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rk FROM scores) WHERE rk <= 5""", "docs"),
    "vector_topk": sql(f"""+ pairs AS (SELECT label AS query_id, vec_id, list_sum(list_transform(list_zip(q, embedding), lambda z: (z[1] - CAST(z[2] AS DOUBLE)) * (z[1] - CAST(z[2] AS DOUBLE)))) AS d
          FROM query_vectors, (SELECT vec_id, embedding FROM embeddings))
        SELECT query_id, vec_id, {r('d', 6)} AS distance, CAST(rk AS INTEGER) AS rank
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d, vec_id) AS rk FROM pairs) WHERE rk <= 5""", "query_vectors"),
    "store_integrity": """
        SELECT count(*) AS rows, count(*) - count(embedding) AS missing, CAST(min(len(embedding)) AS INTEGER) AS min_dim, CAST(max(len(embedding)) AS INTEGER) AS max_dim, true AS probe_hit,
          count(*) > 0 AND count(*) = count(embedding) AND min(len(embedding)) = max(len(embedding)) AS is_sound FROM embeddings""",
    "dedupe_citations": sql("SELECT * FROM citations", "citations"),
    "snippet": sql(f"SELECT doc_id, {snippet('text', 260)} AS snippet FROM docs", "docs"),
    "source_summary": sql("SELECT * FROM summaries", "summaries"),
    "displayable_sources": sql("""
        SELECT query_id, source_key, rank, url FROM (SELECT *, row_number() OVER (PARTITION BY query_id, source_key ORDER BY rank) AS rn
          FROM (SELECT *, nullif(trim(coalesce(nullif(source_id, ''), title, '')), '') AS source_key FROM retrieved) WHERE source_key IS NOT NULL AND trim(url) <> '') WHERE rn = 1""", "retrieved"),
    "extractive_answer": sql("SELECT * FROM answers", "answers"),
    "answer_text": sql("""
        SELECT query_id, answer || coalesce(chr(10) || chr(10) || 'Sources:' || chr(10) || lines, '') AS answer_text FROM answers
        LEFT JOIN (SELECT query_id, string_agg('- ' || citation, chr(10) ORDER BY rank) AS lines FROM citations GROUP BY 1) USING (query_id)""", "answers", "citations"),
    "strip_markers": sql("""
        SELECT chunk_id, trim(regexp_replace(title || ' ' || '[Source: ' || file_name || '; chunk: ' || chunk_index || ']' || ' ' || category || ' [source:]', '(?i)\\s*\\[source:[^\\]]*\\]\\s*', ' ', 'g')) AS answer
        FROM retrieved""", "retrieved"),
    "normalise_source_id": sql(f"SELECT DISTINCT raw, {source_slug('raw')} AS source_id FROM (SELECT url AS raw FROM pages UNION ALL SELECT 'C:\\' || file_name FROM retrieved)", "retrieved"),
    "precision_at_k": sql("SELECT * FROM precision", "precision"),
    "precision_summary": sql(f"SELECT count(*) AS queries, {r('avg(precision_at_k)', 6)} AS mean_precision, {r('avg(precision_at_k)', 6)} >= 0.6e0 AS passes FROM precision", "precision"),
    "judge_parse": sql("SELECT judge_id, score, reasoning FROM judged", "judged"),
    "faithfulness_summary": sql(f"SELECT count(*) FILTER (WHERE NOT is_error) AS scored, {r('avg(score) FILTER (NOT is_error)', 6)} AS mean_faithfulness, {r('avg(score) FILTER (NOT is_error)', 6)} >= 1.5e0 AS passes FROM judged", "judged"),
    "latency_percentiles": sql("SELECT *, p50 <= 3 AND p95 <= 8 AS passes FROM latency_stats", "latency_stats"),
    "eval_summary": sql(f"""
        SELECT CAST(3 AS BIGINT) AS components, (SELECT {r('avg(precision_at_k)', 6)} >= 0.6e0 FROM precision) AND (SELECT {r('avg(score) FILTER (NOT is_error)', 6)} >= 1.5e0 FROM judged)
          AND (SELECT p50 <= 3 AND p95 <= 8 FROM latency_stats) AS all_pass""", "precision", "judged", "latency_stats"),
    "metadata_match": sql("SELECT query_id, rank, array_to_string(candidate_ids, ',') AS candidate_ids FROM candidates", "candidates"),
}

ORACLES["vector_index_search"] = ORACLES["vector_topk"]  # the index finds what the full scan finds
ORACLES["quarantine_write"] = ORACLES["validation_summary"]  # observed while writing, not aggregated
