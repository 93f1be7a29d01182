"""DuckDB statements for the queries that SQL can express."""

OP6 = r"""
WITH parsed AS (
  SELECT page_id, coalesce(CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END, '') AS rest FROM pages),
split AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parsed),
outcome AS (
  SELECT doc_id AS page_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 WHEN quality IS NOT NULL OR toxic IS NOT NULL THEN 0 END) AS bad
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
hosts AS (
  SELECT host, regexp_extract(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '[^.]*(\.[^.]*)?$') AS domain,
         count(bad) AS n, coalesce(sum(bad), 0) AS x FROM split LEFT JOIN outcome USING (page_id) GROUP BY 1, 2),
domains AS (SELECT domain, regexp_extract(domain, '[^.]*$') AS suffix, sum(n) AS n, sum(x) AS x FROM hosts GROUP BY 1, 2),
s0 AS (SELECT suffix, sum(n) AS n, sum(x) AS x FROM domains GROUP BY 1),
total AS (SELECT CASE WHEN sum(n) > 0 THEN (sum(x) + 0.5e0) / (sum(n) + 1e0) ELSE 0.5e0 END AS prior FROM s0),
s1 AS (SELECT s0.*, prior FROM s0, total),
sw AS (SELECT sum(n * pow(x / n - prior, 2)) - sum(prior * (1 - prior)) AS e, sum(prior * (1 - prior) * (n - 1)) AS m FROM s1 WHERE n > 0),
s2 AS (SELECT suffix, n, x, prior, CASE WHEN m > 0 THEN least(greatest(e / m, 0.001e0), 0.999e0) ELSE 0.001e0 END AS w FROM s1, sw),
s3 AS (SELECT suffix, (prior * (1 - w) / w + x) / ((1 - w) / w + n) AS prior FROM s2),
d1 AS (SELECT d.*, prior FROM domains d JOIN s3 USING (suffix)),
dw AS (SELECT sum(n * pow(x / n - prior, 2)) - sum(prior * (1 - prior)) AS e, sum(prior * (1 - prior) * (n - 1)) AS m FROM d1 WHERE n > 0),
d2 AS (SELECT domain, n, x, prior, CASE WHEN m > 0 THEN least(greatest(e / m, 0.001e0), 0.999e0) ELSE 0.001e0 END AS w FROM d1, dw),
d3 AS (SELECT domain, (prior * (1 - w) / w + x) / ((1 - w) / w + n) AS prior FROM d2),
h1 AS (SELECT h.*, prior FROM hosts h JOIN d3 USING (domain)),
hw AS (SELECT sum(n * pow(x / n - prior, 2)) - sum(prior * (1 - prior)) AS e, sum(prior * (1 - prior) * (n - 1)) AS m FROM h1 WHERE n > 0),
h2 AS (SELECT host, n, x, prior, CASE WHEN m > 0 THEN least(greatest(e / m, 0.001e0), 0.999e0) ELSE 0.001e0 END AS w FROM h1, hw),
h3 AS (SELECT host, prior * (1 - w) / w + x AS a, (1 - prior) * (1 - w) / w + n - x AS b FROM h2),
h4 AS (SELECT host, greatest(a / (a + b) - 1.645e0 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))), 0) AS low FROM h3),
ruled AS (
  SELECT page_id, host, path, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule FROM split)
SELECT page_id, r.host, path, rule, CASE
    WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
    WHEN low > 0.5 THEN 'block' ELSE 'allow' END AS verdict
FROM ruled r LEFT JOIN h4 USING (host)
"""

OP10 = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, [3e0, 1e0, 2e0][((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1)::INT] AS weight, source_size * 2e0 AS cap FROM sources),
levels AS (
  SELECT *, (sum(source_size) OVER () * 1.5e0 - coalesce(sum(cap) OVER (ORDER BY cap / weight, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY cap / weight, encode(source) NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed),
fits AS (SELECT coalesce(arg_min(level, cap / weight) FILTER (WHERE level * weight <= cap), max(level)) AS fit FROM levels),
targets AS (SELECT source, source_size, least(cap, fit * weight) AS target FROM levels, fits),
placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY md5('mix|' || doc_id::VARCHAR), doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place FROM sized)
SELECT doc_id, size, source_size, target,
  (greatest(0, least(size, floor(target) - place)) + greatest(0, least(size, floor(target) - place - source_size)))::BIGINT AS taken
FROM placed p JOIN targets t ON p.source IS NOT DISTINCT FROM t.source
"""

OP12 = r"""
WITH docs AS (SELECT row_number() OVER () AS row_no, doc_id, text FROM documents),
words AS (
  SELECT row_no, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
tf AS (SELECT row_no, doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
lengths AS (SELECT row_no, sum(tf)::BIGINT AS n FROM tf GROUP BY row_no),
corpus AS (SELECT count(*) AS nd, sum(n)::BIGINT AS total FROM lengths),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
weighed AS (SELECT item_id, term, floor(1000 * ln((2 * nd + 2) / (2 * df + 1)))::BIGINT AS w FROM asked JOIN df USING (term), corpus),
scored AS (
  SELECT item_id, row_no, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nd) // total))))::BIGINT AS score
  FROM weighed JOIN tf USING (term) JOIN lengths USING (row_no), corpus GROUP BY ALL),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank, doc_id, score FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

LLM_ORACLES: dict[str, str] = {"op6_url_reputation": OP6, "op10_source_mix": OP10, "op12_max_sketch_search": OP12}
