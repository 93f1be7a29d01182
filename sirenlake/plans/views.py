"""The same views in the oracle's SQL dialect; ``sql(body, *views)`` puts them before a query."""

from __future__ import annotations

from ..operators.text import ENTITIES
from .fixtures import CALL_MAP, CALL_RULES, CALL_TYPES, PRIORITIES


def r(expr: str, digits: int) -> str:
    """Round half to even the way the operators do."""
    return f"(round_even(({expr}) * 1e{digits}, 0) / 1e{digits})"


def quoted(values: list[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def pick(index: str, values: list[str]) -> str:
    return f"[{quoted(values)}][{index} + 1]"


def title(x: str) -> str:
    pieces = f"regexp_extract_all(lower({x}), '\\p{{L}}+|[^\\p{{L}}]+')"
    return f"array_to_string(list_transform({pieces}, lambda p: upper(p[1]) || p[2:]), '')"


def null_words(x: str) -> str:
    return f"CASE WHEN upper({x}) NOT IN ('NAN', 'NONE', '') THEN {x} END"


def hash_int(key: str, start: int = 1) -> str:
    return f"CAST('0x' || substr({key}, {start}, 8) AS BIGINT)"


def quarter_label(x: str) -> str:
    t = f"replace(replace(upper({x}), 'QUARTER ', 'Q'), ' ', '')"
    return f"CASE WHEN try_cast({t} AS DOUBLE) IS NOT NULL THEN 'Q' || CAST(CAST(try_cast({t} AS DOUBLE) AS INTEGER) AS VARCHAR) ELSE {t} END"


def priority_level(x: str) -> str:
    def has(*words: str) -> str:
        return "(" + " OR ".join(f"contains(lower({x}), '{w}')" for w in words) + ")"

    return (
        f"CASE WHEN {has('life threatening')} THEN 'Life Threatening' WHEN {has('advanced life support', 'als')} THEN 'ALS' "
        f"WHEN {has('basic life support', 'bls')} THEN 'BLS' "
        f"WHEN {has('assist', 'admin', 'non emergency', 'no immediate threat', 'mark out')} THEN 'Non-Emergency' ELSE 'Other' END"
    )


def number(x: str) -> str:
    return f"try_cast(trim({x}) AS DOUBLE)"


def zero_pad(x: str) -> str:
    return f"CASE WHEN length({x}) < 12 THEN lpad({x}, 12, '0') ELSE {x} END"


def geoid(x: str) -> str:
    digits = f"nullif(regexp_replace(regexp_replace(trim({x}), '\\.0$', ''), '\\D', '', 'g'), '')"
    return zero_pad(digits)


QUALITY = [
    "incident_id", "service_type", "priority_code", "priority_description", "quarter", "year", "call_type", "city_code", "city_name",
    "census_block_group", "longitude", "latitude",
]


def filled(columns: list[str]) -> str:
    return "(" + " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in columns) + ")"


def unescaped(x: str) -> str:
    for name, char in ENTITIES.items():
        quoted_char = char.replace("'", "''")
        x = f"replace({x}, '{name}', '{quoted_char}')"
    return x


def tidy_space(x: str) -> str:
    x = f"regexp_replace(replace({x}, chr(0), ' '), '[ \\t]+', ' ', 'g')"
    x = f"regexp_replace({x}, '\\n{{3,}}', chr(10) || chr(10), 'g')"
    return f"trim(regexp_replace({x}, ' *\\n *', chr(10), 'g'), ' ' || chr(9) || chr(10) || chr(13))"


def one_line(x: str) -> str:
    return f"trim(regexp_replace(coalesce({x}, ''), '\\s+', ' ', 'g'))"


def snippet(x: str, limit: int) -> str:
    t = one_line(x)
    return f"CASE WHEN length({t}) <= {limit} THEN {t} ELSE rtrim(substr({t}, 1, {limit - 3})) || '...' END"


def source_slug(x: str) -> str:
    name = f"string_split(replace(lower(trim(coalesce({x}, ''))), '\\', '/'), '/')[-1]"
    return f"trim(regexp_replace(regexp_replace({name}, '\\.(md|txt|pdf|json|jsonl)$', ''), '[^a-z0-9]+', '_', 'g'), '_')"



def text_parts(x: str) -> dict[str, str]:
    words = f"regexp_extract_all({x}, '[A-Za-z]{{2,}}')"
    vowelless = f"len(list_filter({words}, lambda w: NOT regexp_matches(w, '[AEIOUaeiou]')))"
    unreadable = "[\\x00-\\x08\\x0e-\\x1b\\x7f-\\x84\\x86-\\x9f\\p{Cf}\\p{Co}]"
    return {
        "chars": f"length({x})",
        "alpha": f"(length(regexp_replace({x}, '[^\\p{{L}}]', '', 'g')) / nullif(length({x}), 0))",
        "readable": f"(length(regexp_replace({x}, '{unreadable}', '', 'g')) / nullif(length({x}), 0))",
        "words": f"len({words})",
        "non_ascii": f"coalesce(length(regexp_replace({x}, '[\\x00-\\x7f]', '', 'g')) / nullif(length({x}), 0), 0.0)",
        "marker": f"(contains({x}, chr(65533)) OR contains({x}, 'ÿþ') OR contains({x}, 'þÿ'))",
        "vowelless": f"CASE WHEN len({words}) = 0 THEN 1.0 ELSE CAST({vowelless} AS DOUBLE) / len({words}) END",
        "run": f"regexp_matches({x}, '[^\\x00-\\x7f]{{4,}}')",
    }


def garbled(p: dict[str, str]) -> str:
    return f"({p['marker']} OR {p['non_ascii']} > 0.10 OR {p['vowelless']} > 0.30 OR {p['run']})"


def chunk_reasons(x: str) -> str:
    """List of reasons (NULL entries removed)."""
    p = text_parts(x)
    items = [
        (f"{p['chars']} < 120", "too_short"), (f"{p['alpha']} < 0.50", "low_alpha_ratio"), (f"{p['readable']} < 0.95", "low_readable_ratio"),
        (f"{p['words']} < 8", "too_few_words"), (garbled(p), "garbled_ocr"),
    ]
    cases = ", ".join(f"CASE WHEN {cond} THEN '{name}' END" for cond, name in items)
    return f"CASE WHEN coalesce({x}, '') = '' THEN ['empty'] ELSE list_filter([{cases}], lambda v: v IS NOT NULL) END"


def group_case(x: str) -> str:
    """Exact lookup, rules in order, default."""
    exact = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CALL_MAP)
    rules = " ".join("WHEN " + " AND ".join(f"contains(upper(trim({x})), '{w}')" for w in words) + f" THEN '{g}'" for words, g in CALL_RULES)
    return f"coalesce(CASE upper(trim({x})) {exact} END, CASE {rules} END, 'Unknown Problem')"


VIEWS: dict[str, tuple[list[str], str]] = {
    "dispatch0": ([], f"""
        SELECT o_orderkey AS k, o_custkey AS custkey, 'I' || o_orderkey AS incident_id,
          CASE WHEN o_orderkey % 10 < 7 THEN 'EMS' ELSE 'Fire' END AS service_type,
          CASE WHEN o_orderkey % 10 < 7 THEN 'E' ELSE 'F' END || substr(o_orderpriority, 1, 1) AS priority_code,
          {pick("CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 1", PRIORITIES)} AS priority_description,
          o_orderdate AS call_create_time, CAST(year(o_orderdate) AS INTEGER) AS year, 'Q' || quarter(o_orderdate) AS quarter,
          {pick("o_orderkey % 13", CALL_TYPES)} AS call_type,
          'C' || n_nationkey AS city_code, n_name AS city_name,
          CASE WHEN o_orderkey % 20 <> 0 THEN lpad(CAST(o_custkey AS VARCHAR), 12, '0') END AS census_block_group,
          CASE WHEN o_orderkey % 25 <> 0 THEN CAST(-80200 + 500 * (n_nationkey % 5) + 4 * (o_custkey % 23) AS DOUBLE) / 1e3 END AS longitude,
          CASE WHEN o_orderkey % 25 <> 0 THEN CAST(40200 + 500 * (n_nationkey // 5) + 4 * (o_custkey % 29) AS DOUBLE) / 1e3 END AS latitude,
          CAST(o_orderkey * 37 % 9000 - 300 AS DOUBLE) AS response_time_sec
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""),
    "dispatch": (["dispatch0"], f"SELECT *, {r(filled(QUALITY) + ' / 12.0', 3)} AS completeness_score FROM dispatch0"),
    "dispatch_raw": (["dispatch"], """
        SELECT incident_id AS call_id_hash, CASE WHEN k % 11 <> 0 THEN service_type END AS service,
          CASE k % 5 WHEN 0 THEN ' ' || lower(priority_code) || ' ' WHEN 1 THEN 'nan' WHEN 2 THEN 'None' WHEN 3 THEN '' ELSE priority_code END AS priority,
          CASE k % 6 WHEN 0 THEN 'nan' WHEN 1 THEN '  ' ELSE ' ' || upper(priority_description) || ' ' END AS priority_desc,
          CASE WHEN k % 41 = 0 THEN 'not a date' ELSE strftime(call_create_time, '%Y-%m-%d %H:%M:%S') END AS call_create_time,
          CASE WHEN k % 7 = 0 THEN 'None' ELSE ' ' || lower(call_type) || ' ' END AS description_short,
          ' ' || lower(city_code) || ' ' AS city_code,
          CASE k % 9 WHEN 0 THEN 'o''hara-' || lower(city_name) WHEN 1 THEN NULL ELSE ' ' || city_name || ' ' END AS city_name,
          CASE WHEN k % 53 = 0 THEN '4200300010010' || k ELSE CAST(custkey AS VARCHAR) END AS geoid,
          CASE WHEN k % 43 = 0 THEN 'abc' ELSE CAST(longitude AS VARCHAR) END AS census_block_group_center__x,
          CASE WHEN k % 43 = 1 THEN 'abc' ELSE CAST(latitude AS VARCHAR) END AS census_block_group_center__y,
          CASE WHEN k % 47 = 0 THEN 'abc' ELSE CAST(CAST(response_time_sec AS BIGINT) AS VARCHAR) END AS response_time_sec,
          strftime(call_create_time, '%Y-%m-%d %H:%M:%S') AS unit_dispatch_time,
          strftime(call_create_time + to_seconds(k % 9000), '%Y-%m-%d %H:%M:%S') AS unit_on_scene_time,
          CASE k % 4 WHEN 0 THEN 'Quarter ' || substr(quarter, 2, 1) WHEN 1 THEN substr(quarter, 2, 1) WHEN 2 THEN substr(quarter, 2, 1) || '.0'
            ELSE 'q' || substr(quarter, 2, 1) END AS quarter_text,
          CASE WHEN k % 3 <> 0 THEN CAST(year AS VARCHAR) END AS year_text, CAST(year AS VARCHAR) AS call_year_text
        FROM (SELECT *, unnest(range(CASE WHEN k % 97 = 0 THEN 2 ELSE 1 END)) AS copy FROM dispatch)"""),
    "dispatch_dirty": (["dispatch"], """
        SELECT * REPLACE (
          CASE WHEN k % 17 = 0 THEN 'Police' ELSE service_type END AS service_type, CASE WHEN k % 19 = 0 THEN 'Q5' ELSE quarter END AS quarter,
          CASE WHEN k % 23 = 0 THEN 1900 ELSE year + 5 END AS year, CASE WHEN k % 29 = 0 THEN '  ' ELSE city_name END AS city_name,
          CASE WHEN k % 31 = 0 THEN 200e0 ELSE longitude END AS longitude, CASE WHEN k % 37 = 0 THEN -95.5e0 ELSE latitude END AS latitude)
        FROM dispatch"""),
    "mapped": (["dispatch"], f"SELECT *, {group_case('call_type')} AS mpds_group FROM dispatch"),
    "census_raw": ([], """
        SELECT CASE c_custkey % 7 WHEN 0 THEN key || '.0' WHEN 1 THEN 'BG-' || key ELSE key END AS GEOID, 'Block ' || c_custkey AS NAME,
          CAST(CASE WHEN c_custkey % 13 = 0 THEN 0 ELSE 500 + c_custkey % 2000 + v END AS VARCHAR) AS B01003_001E,
          CAST(CASE WHEN c_custkey % 17 = 0 THEN 0 ELSE 400 + c_custkey % 1500 END AS VARCHAR) AS B17001_001E,
          CASE WHEN c_custkey % 31 = 0 THEN 'abc' ELSE CAST(c_custkey * 3 % 300 AS VARCHAR) END AS B17001_002E,
          CAST(c_custkey % 500 AS VARCHAR) AS B02001_002E, CAST(c_custkey % 90 AS VARCHAR) AS B02001_003E,
          CAST(c_custkey % 40 AS VARCHAR) AS B02001_005E, CAST(c_custkey % 70 AS VARCHAR) AS B03003_003E,
          CAST(c_acctbal AS VARCHAR) AS B19013_001E, CAST(c_custkey % 50 * 100000 AS VARCHAR) AS ALAND, c_custkey * 2 + v AS ord
        FROM (SELECT *, CAST(CASE WHEN c_custkey % 50 = 3 THEN c_custkey + 9000000 ELSE c_custkey END AS VARCHAR) AS key FROM customer),
          (SELECT unnest([0, 1]) AS v)"""),
    "census_num": (["census_raw"], f"""
        SELECT {geoid('GEOID')} AS census_block_group, NAME AS census_name, ord, {number('B01003_001E')} AS population,
          {number('B17001_001E')} AS pov_universe, {number('B17001_002E')} AS pov, {number('B02001_002E')} AS white, {number('B02001_003E')} AS black,
          {number('B02001_005E')} AS asian, {number('B03003_003E')} AS hisp, {number('B19013_001E')} AS median_household_income,
          {number('ALAND')} / 1e6 AS land_area_sq_km
        FROM census_raw"""),
    "census": (["census_num"], """
        SELECT census_block_group, arg_min(census_name, ord) AS census_name, arg_min(population, ord) AS population,
          arg_min(land_area_sq_km, ord) AS land_area_sq_km,
          arg_min_null(population / nullif(land_area_sq_km, 0), ord) AS population_density_per_sq_km,
          arg_min_null(pov / nullif(pov_universe, 0), ord) AS poverty_rate, arg_min_null(white / nullif(population, 0), ord) AS white_alone_pct,
          arg_min_null(black / nullif(population, 0), ord) AS black_alone_pct, arg_min_null(asian / nullif(population, 0), ord) AS asian_alone_pct,
          arg_min_null(hisp / nullif(population, 0), ord) AS hispanic_or_latino_pct,
          arg_min(median_household_income, ord) AS median_household_income
        FROM census_num GROUP BY 1"""),
    "prepared": (["dispatch"], f"""
        SELECT year, {quarter_label('quarter')} AS quarter, trim(service_type) AS service, {priority_level('priority_description')} AS priority_level,
          trim(coalesce(call_type, 'Unknown')) AS call_type, trim(city_name) AS city_name, census_block_group, latitude, longitude,
          completeness_score, longitude IS NOT NULL AS with_coords, coalesce(completeness_score, 0) >= 0.75 AS high_completeness
        FROM dispatch"""),
    "overview": (["prepared"], """
        SELECT year, quarter, service, priority_level, call_type, count(*) AS call_count, count(*) FILTER (WHERE with_coords) AS with_coords_count,
          count(*) FILTER (WHERE high_completeness) AS high_completeness_count
        FROM prepared WHERE year IS NOT NULL AND quarter IS NOT NULL AND service IS NOT NULL GROUP BY ALL"""),
    "heatmap": (["prepared"], "SELECT year, quarter, service, count(*) AS call_count FROM prepared GROUP BY ALL"),
    "slope": (["prepared"], "SELECT year, service, call_type, count(*) AS call_count FROM prepared GROUP BY ALL"),
    "density": (["prepared"], """
        SELECT year, service, call_type, census_block_group, count(*) AS call_count, avg(latitude) AS latitude, avg(longitude) AS longitude
        FROM prepared WHERE census_block_group IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY ALL"""),
    "city": (["prepared"], """
        SELECT year, service, city_name, count(*) AS call_count, sum(completeness_score) AS completeness_sum,
          count(completeness_score) AS completeness_count
        FROM prepared WHERE city_name IS NOT NULL GROUP BY ALL"""),
    "types": (["prepared"], """
        SELECT year, service, call_type, count(*) AS total_calls, count(DISTINCT census_block_group) AS unique_cbg_count FROM prepared GROUP BY ALL"""),
    "city_mean": (["city"], """
        SELECT city_name, sum(call_count) AS call_count, sum(completeness_sum) / nullif(sum(completeness_count), 0) AS mean FROM city GROUP BY 1"""),
    "centroids": (["density"], """
        SELECT census_block_group, CAST(sum(call_count) AS BIGINT) AS call_count, avg(latitude) AS latitude, avg(longitude) AS longitude
        FROM density GROUP BY 1"""),
    "series": (["dispatch"], """
        SELECT service_type || '|' || city_code AS series_id, CAST(make_date(year, 3 * CAST(substr(quarter, 2, 1) AS INTEGER) - 2, 1) AS TIMESTAMP) AS ds,
          count(*) AS y FROM dispatch GROUP BY ALL"""),
    "fc_trend": (["series"], "SELECT series_id, ds, y + 2e0 AS yhat, y - 1e0 AS yhat_lower, y + 5e0 AS yhat_upper FROM series"),
    "fc_boosted": (["series"], "SELECT series_id, ds, CAST(y AS DOUBLE) * 3 / 2 AS yhat FROM series WHERE quarter(ds) <> 1"),
    "keyed_lines": ([], """
        SELECT *, l_orderkey || '-' || l_linenumber || '-' || row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey,
          l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS rid FROM lineitem"""),
    "bucketed": (["keyed_lines"], f"""
        SELECT *, {hash_int("md5('hit|' || rid)")} % 100 AS hit, {hash_int("md5('sure|' || rid)")} % 100 AS sure,
          CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 WHEN 'R' THEN 2 END AS truth_code FROM keyed_lines"""),
    "predictions": (["bucketed"], """
        SELECT rid, truth_code, predicted_code, l_returnflag AS truth, ['A', 'N', 'R'][predicted_code + 1] AS predicted,
          l_returnflag || l_linestatus AS mpds_group, CAST(year(l_shipdate) AS INTEGER) AS year,
          CASE WHEN l_linestatus = 'F' THEN 'Fire' ELSE 'EMS' END AS service_type, CAST(3000 + 70 * sure AS DOUBLE) / 1e4 AS max_confidence,
          truth_code = predicted_code AS is_correct, CAST(60 + hit % 40 AS DOUBLE) / 1e2 AS completeness_score
        FROM (SELECT *, CAST((truth_code + CASE WHEN hit < 60 THEN 0 ELSE 1 + hit % 2 END) % 3 AS INTEGER) AS predicted_code FROM bucketed)"""),
    "flagged": (["predictions"], "SELECT *, max_confidence > 0.7 AND NOT is_correct AS is_disagreement FROM predictions"),
    "confusion": (["predictions"], "SELECT truth, predicted, count(*) AS n FROM predictions GROUP BY ALL"),
    "class_raw": (["confusion"], """
        SELECT class, CAST(sum(s) AS BIGINT) AS support, CAST(sum(tp) AS BIGINT) AS tp, coalesce(sum(tp) / nullif(sum(p), 0), 0) AS precision,
          coalesce(sum(tp) / nullif(sum(s), 0), 0) AS recall, coalesce(2 * sum(tp) / nullif(sum(p) + sum(s), 0), 0) AS f1
        FROM (SELECT truth AS class, n AS s, 0 AS p, CASE WHEN truth = predicted THEN n ELSE 0 END AS tp FROM confusion
          UNION ALL SELECT predicted, 0, n, 0 FROM confusion) GROUP BY 1"""),
    "injected": (["predictions"], f"""
        SELECT *, CAST(CASE WHEN is_injected THEN (truth_code + 1 + {hash_int('h', 9)} % 2) % 3 ELSE truth_code END AS INTEGER) AS label_after
        FROM (SELECT *, row_number() OVER (ORDER BY h) <= greatest(1, CAST(round_even(0.05 * count(*) OVER (), 0) AS BIGINT)) AS is_injected
          FROM (SELECT *, md5('42|' || rid) AS h FROM predictions))"""),
    "points": (["dispatch"], """
        SELECT census_block_group, avg(latitude) AS latitude, avg(longitude) AS longitude, count(incident_id) AS call_volume
        FROM dispatch WHERE census_block_group IS NOT NULL GROUP BY 1 HAVING avg(latitude) IS NOT NULL AND avg(longitude) IS NOT NULL"""),
    "docs": ([], "SELECT doc_id, source AS source_id, 'Report ' || doc_id AS title, lang, text FROM documents"),
    "windows": (["docs"], """
        WITH RECURSIVE steps(doc_id, source_id, body, pos, start, stop) AS (
          SELECT doc_id, source_id, body, CAST(0 AS INTEGER), 0, CASE WHEN length(body) <= 900 THEN length(body) WHEN cut > 120 THEN cut + 1 ELSE 900 END
          FROM (SELECT doc_id, source_id, body, greatest(
              CASE WHEN strpos(reverse(body[1:900]), ' .') > 0 THEN 900 - strpos(reverse(body[1:900]), ' .') - 1 ELSE -1 END,
              CASE WHEN strpos(reverse(body[1:900]), chr(10)) > 0 THEN 900 - strpos(reverse(body[1:900]), chr(10)) ELSE -1 END) AS cut
            FROM (SELECT doc_id, source_id, text AS body FROM docs WHERE length(text) > 0))
          UNION ALL
          SELECT doc_id, source_id, body, pos + 1, nxt, CASE WHEN length(body) <= nxt + 900 THEN length(body) WHEN cut > 120 THEN nxt + cut + 1 ELSE nxt + 900 END
          FROM (SELECT *, greatest(CASE WHEN strpos(reverse(win), ' .') > 0 THEN 900 - strpos(reverse(win), ' .') - 1 ELSE -1 END,
              CASE WHEN strpos(reverse(win), chr(10)) > 0 THEN 900 - strpos(reverse(win), chr(10)) ELSE -1 END) AS cut
            FROM (SELECT *, body[nxt + 1:nxt + 900] AS win FROM (SELECT *, greatest(stop - 150, start + 1) AS nxt FROM steps WHERE stop < length(body)))))
        SELECT doc_id, source_id, pos, CASE WHEN length(body) <= 900 THEN body ELSE trim(body[start + 1:stop], ' ' || chr(10)) END AS piece FROM steps"""),
    "retrieved": ([], """
        SELECT conv_id AS query_id, turn + 1 AS rank, CASE WHEN turn % 4 = 3 THEN '' ELSE 'src' || ((conv_id * 7 + turn * 3) % 5) END AS source_id,
          CASE WHEN turn % 3 = 1 THEN '' ELSE 'Guide ' || ((conv_id + turn) % 4) END AS title,
          CASE WHEN turn % 6 = 5 THEN 'abc' ELSE CAST(turn % 3 AS VARCHAR) END AS chunk_index, conv_id || '-' || turn AS chunk_id,
          CASE WHEN (conv_id + turn) % 3 = 0 THEN '' ELSE 'https://example.org/src' || ((conv_id * 7 + turn * 3) % 5) END AS url,
          'docs/SRC' || ((conv_id * 7 + turn * 3) % 5) || '.md' AS file_name, role AS category, text
        FROM conversations"""),
    "cited": (["retrieved"], """
        SELECT * REPLACE (coalesce(source_id, '') AS source_id, coalesce(nullif(title, ''), source_id, '') AS title,
          try_cast(trim(chunk_index) AS INTEGER) AS chunk_index) FROM retrieved"""),
    "citations": (["cited"], f"""
        SELECT query_id, source_id, title, chunk_index, rank, chunk_id, url, file_name,
          '[source: ' || coalesce(nullif(title, ''), 'unknown source') || coalesce('; chunk: ' || chunk_index, '') || ']' AS citation,
          {snippet('text', 260)} AS snippet
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id, source_id, title, chunk_index ORDER BY rank) AS rn FROM cited) WHERE rn = 1"""),
    "summaries": (["cited"], """
        SELECT query_id, string_agg(name, '; ' ORDER BY rank, name) AS summary
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rank, name) AS rn
          FROM (SELECT query_id, trim(title) AS name, min(rank) AS rank FROM cited WHERE trim(title) <> '' GROUP BY ALL)) WHERE rn <= 3 GROUP BY 1"""),
    "answers": (["retrieved", "summaries"], f"""
        SELECT q.query_id, coalesce('Based on the retrieved documents:' || chr(10) || chr(10) || body || coalesce(chr(10) || chr(10) || 'Sources: ' || summary, ''),
          'No answer was found in the indexed documents.') AS answer
        FROM (SELECT DISTINCT query_id FROM retrieved) q
        LEFT JOIN (SELECT query_id, string_agg('- ' || {snippet('text', 220)}, chr(10) ORDER BY rank) AS body
          FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rank) AS rn FROM retrieved) WHERE rn <= 2 GROUP BY 1) b USING (query_id)
        LEFT JOIN summaries USING (query_id)"""),
    "candidates": (["retrieved"], f"""
        SELECT *, list_sort(list_distinct(list_filter([{source_slug('source_id')}, {source_slug('file_name')}, {source_slug('title')}, {source_slug('category')}],
          lambda i: i <> ''))) AS candidate_ids FROM retrieved"""),
    "precision": (["candidates"], """
        SELECT e.query_id, count(rank) AS retrieved, count(*) FILTER (WHERE list_has_any(expected_ids, candidate_ids)) AS relevant,
          count(*) FILTER (WHERE list_has_any(expected_ids, candidate_ids)) / 5e0 AS precision_at_k
        FROM (SELECT DISTINCT conv_id AS query_id, ['src' || (conv_id % 5), 'src' || ((conv_id + 1) % 5)] AS expected_ids FROM conversations) e
        LEFT JOIN (SELECT * FROM candidates WHERE rank <= 5) c USING (query_id) GROUP BY 1"""),
    "judge_raw": ([], """
        SELECT conv_id || '-' || turn AS judge_id, role = 'system' AS is_error,
          CASE (conv_id + turn) % 6 WHEN 0 THEN '{"score": ' || s || ', "reasoning": "' || role || '"}'
            WHEN 1 THEN '```json' || chr(10) || '{"score": ' || s || ', "reasoning": "fenced"}' || chr(10) || '```'
            WHEN 2 THEN 'I think {"score": 7, "reasoning": "too high"} is right' WHEN 3 THEN 'Score: ' || s || ' because it is grounded'
            WHEN 4 THEN 'no verdict' ELSE '{"score": "high", "reasoning": "bad type"}' END AS response
        FROM (SELECT *, CASE WHEN turn % 5 = 4 THEN '-1.5' ELSE (turn % 4) || '.25' END AS s FROM conversations)"""),
    "judged": (["judge_raw"], """
        SELECT judge_id, is_error, response, CASE WHEN coalesce(given, loose) IS NULL THEN 0e0 ELSE least(3e0, greatest(0e0, coalesce(given, loose))) END AS score,
          CASE WHEN given IS NOT NULL THEN regexp_extract(blob, '"reasoning": "([^"]*)"', 1) WHEN loose IS NOT NULL THEN trim(response)
            ELSE 'Could not parse judge response: ' || substr(response, 1, 200) END AS reasoning
        FROM (SELECT *, try_cast(nullif(regexp_extract(blob, '"score": "?([^",}]*)', 1), '') AS DOUBLE) AS given,
            try_cast(nullif(regexp_extract(response, '(?i)score["\\s:]+(-?\\d+(?:\\.\\d+)?)', 1), '') AS DOUBLE) AS loose
          FROM (SELECT *, regexp_extract(response, '(?s)\\{.*\\}') AS blob FROM judge_raw))"""),
    "latency": ([], "SELECT event_id, value / 100 AS latency_s, event_type <> 'error' AS success FROM events"),
    "latency_stats": (["latency"], f"""
        SELECT count(*) AS n, {r('median(latency_s)', 6)} AS p50, quantile_disc(latency_s, 0.95) AS p95, {r('avg(latency_s)', 6)} AS mean,
          min(latency_s) AS min, max(latency_s) AS max FROM latency WHERE success"""),
    "scored": (["dispatch"], "SELECT incident_id, priority_code, -CAST(300 + k * 7919 % 500 AS DOUBLE) / 1e3 AS anomaly_score FROM dispatch"),
    "query_vectors": ([], """
        SELECT label, list(x ORDER BY i) AS q FROM (SELECT label, i, round(avg(CAST(x AS DOUBLE)), 5) AS x
          FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY ALL) GROUP BY 1"""),
}


def sql(body: str, *views: str) -> str:
    """``body`` with the views it needs (and those they need) as common table expressions."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name not in order:
            for needed in VIEWS[name][0]:
                visit(needed)
            order.append(name)

    for v in views:
        visit(v)
    if not order:
        return body.strip()
    ctes = ",\n".join(f"{v} AS ({VIEWS[v][1].strip()})" for v in order)
    body = body.strip()
    glue = ",\n" if body.startswith("+") else "\n"
    return f"WITH {ctes}{glue}{body.lstrip('+').strip()}"
