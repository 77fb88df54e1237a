r"""DuckDB SQL for the text queries that SQL can express."""

# Positions: every text is split by each pattern, and lengths of gaps and matches are summed up.
_SECRETS = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, source, lang, coalesce(text, '') AS t FROM documents
), patterns(k, kind, pattern) AS (VALUES
    (0, 'assign', '(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)'),
    (1, 'access', 'AKIA[A-Z0-9]+'),
    (2, 'hex', '[0-9a-f]+'),
    (3, 'token', '[A-Za-z0-9+/_-]{20,}')
), parts AS (
    SELECT r, source, lang, 0 AS k, regexp_extract_all(t, (SELECT pattern FROM patterns WHERE k = 0)) AS m,
        string_split_regex(t, '(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)') AS g FROM docs
    UNION ALL SELECT r, source, lang, 1, regexp_extract_all(t, 'AKIA[A-Z0-9]+'), string_split_regex(t, 'AKIA[A-Z0-9]+') FROM docs
    UNION ALL SELECT r, source, lang, 2, regexp_extract_all(t, '[0-9a-f]+'), string_split_regex(t, '[0-9a-f]+') FROM docs
    UNION ALL SELECT r, source, lang, 3, regexp_extract_all(t, '[A-Za-z0-9+/_-]{20,}'),
        string_split_regex(t, '[A-Za-z0-9+/_-]{20,}') FROM docs
), each AS (
    SELECT r, source, lang, k, generate_subscripts(m, 1) AS i, unnest(m) AS m, unnest(list_slice(g, 1, len(m))) AS g
    FROM parts WHERE len(m) > 0
), placed AS (
    SELECT *, CAST(sum(length(g) + length(m)) OVER (PARTITION BY r, k ORDER BY i) AS BIGINT) AS stop,
        CASE WHEN k = 0 THEN regexp_extract(m, '(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2)
            ELSE m END AS v FROM each
), good AS (
    SELECT *, stop - length(m) AS start FROM placed
    WHERE CASE k WHEN 0 THEN length(v) >= 6 WHEN 1 THEN length(v) >= 20 WHEN 2 THEN length(v) >= 24
        ELSE regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Z]') AND
            (regexp_matches(v, '[a-z]') OR regexp_full_match(v, '[0-9A-F]{24,}')) END
), owned AS (
    SELECT v, count(DISTINCT coalesce('=' || source, 'null')) AS owners,
        count(DISTINCT {'s': coalesce('=' || source, 'null'), 'l': coalesce('=' || lang, 'null')}) AS repositories FROM good GROUP BY v
), judged AS (
    SELECT good.*, owners, repositories, owners <= 2 AND repositories <= 4 AS live,
        CASE WHEN k = 3 AND NOT (owners <= 2 AND repositories <= 4) THEN 'copied' ELSE patterns.kind END AS kind
    FROM good JOIN owned USING (v) JOIN patterns USING (k)
), spans AS (
    SELECT r, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
        coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, k) FILTER (k < 3), '') AS base,
        string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, k) AS spans,
        count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_copied, max(owners) AS max_owners,
        max(repositories) AS max_repositories
    FROM judged GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live,
    coalesce(n_copied, 0) AS n_copied, coalesce(max_owners, 0) AS max_owners, coalesce(max_repositories, 0) AS max_repositories
FROM docs LEFT JOIN spans USING (r)"""

_NEAR = r"""
WITH RECURSIVE docs AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents
), grams AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS g FROM docs
), sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
links AS (
    SELECT a.doc_id AS x, b.doc_id AS y FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id
    JOIN sizes s ON s.doc_id = a.doc_id JOIN sizes t ON t.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, s.n, t.n HAVING 100 * count(*) >= 85 * (s.n + t.n - count(*))
), both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached(x, y) AS (
    SELECT x, y FROM both_ways UNION SELECT reached.x, both_ways.y FROM reached JOIN both_ways ON reached.y = both_ways.x
), least AS (SELECT x AS doc_id, min(y) AS y FROM reached GROUP BY x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(y, doc_id)) AS component_id
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)"""

_EXACT = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, length(coalesce(text, '')) AS chars,
        regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t FROM documents
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY t ORDER BY chars DESC, doc_id, r) AS place,
        first_value(doc_id) OVER (PARTITION BY t ORDER BY chars DESC, doc_id, r) AS keep_id,
        count(*) OVER (PARTITION BY t) AS group_size FROM docs
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(t) AS text_sha256 FROM ranked"""

_LINES = r"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents
), pairs AS (
    SELECT doc_id, i, x, lead(x) OVER (PARTITION BY doc_id ORDER BY i) AS y FROM lines
), places AS (
    SELECT doc_id, i, min({'d': doc_id, 'i': i}) OVER (PARTITION BY x, y) AS first FROM pairs
    WHERE y IS NOT NULL AND regexp_matches(x || y, '[^\x20\x09-\x0D]')
), gone AS (
    SELECT doc_id, i + 1 AS i FROM places WHERE first <> {'d': doc_id, 'i': i}
    UNION SELECT doc_id, i FROM places WHERE first <> {'d': doc_id, 'i': i} AND first <> {'d': doc_id, 'i': i - 1}
), kept AS (
    SELECT doc_id, string_agg(x, chr(10) ORDER BY i) AS t, count(*) AS n FROM lines ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
), counted AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, coalesce(counted.n, 0) AS removed_lines, length(coalesce(t, text)) AS kept_chars, sha256(coalesce(t, text)) AS text_sha256
FROM documents LEFT JOIN kept USING (doc_id) LEFT JOIN counted USING (doc_id)"""

_MIX = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
        CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(coalesce(text, ''))), 1, 15) AS BIGINT) AS place
    FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 2.0::DOUBLE * sum(size) AS most,
        (ARRAY[3.0, 1.0, 2.0])[1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3]::DOUBLE AS weight
    FROM docs GROUP BY source
), levels AS (
    SELECT most / weight AS full_at, (1.5 * sum(source_size) OVER () - coalesce(sum(most) OVER before, 0)) / sum(weight) OVER after AS level
    FROM sources WINDOW before AS (ORDER BY most / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
        after AS (ORDER BY most / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), level AS (SELECT coalesce(arg_min(level, full_at) FILTER (level <= full_at), 0.0) AS level FROM levels
), targets AS (SELECT source, source_size, least(weight * level, most) AS target FROM sources, level
), placed AS (
    SELECT doc_id, docs.source, size, source_size, target,
        coalesce(sum(size) OVER (PARTITION BY docs.source ORDER BY place, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM docs JOIN targets ON docs.source IS NOT DISTINCT FROM targets.source
)
SELECT doc_id, size, source, source_size, target, CAST(size * (
    CASE WHEN target >= source_size OR 2 * before + size <= 2 * target THEN 1 ELSE 0 END +
    CASE WHEN target - source_size >= source_size OR 2 * before + size <= 2 * (target - source_size) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM placed"""

_AUDIT = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), groups AS (SELECT DISTINCT lang, source FROM docs
), found AS (
    SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
), kept AS (SELECT lang, term FROM found GROUP BY lang, term HAVING count(DISTINCT r) >= 10
), vocabulary AS (SELECT lang, count(term) AS v FROM (SELECT DISTINCT lang FROM docs) LEFT JOIN kept USING (lang) GROUP BY lang
), counts AS (SELECT lang, source, term, count(*) AS n FROM found JOIN kept USING (lang, term) GROUP BY lang, source, term
), totals AS (
    SELECT lang, source, v, coalesce(s, 0) + 2 * v AS total FROM groups JOIN vocabulary USING (lang)
    LEFT JOIN (SELECT lang, source, sum(n) AS s FROM counts GROUP BY lang, source) USING (lang, source)
), shares AS (
    SELECT lang, source, term, coalesce(n, 0) AS n, CAST(1 + (1000000000::HUGEINT * (coalesce(n, 0) + 2)) // total AS BIGINT) AS p
    FROM totals JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)
), overall AS (
    SELECT lang, term, CAST(1 + (1000000000::HUGEINT * (n + 2)) // (s + 2 * v) AS BIGINT) AS q
    FROM (SELECT lang, term, sum(n) AS n FROM counts GROUP BY lang, term) JOIN
        (SELECT lang, sum(n) AS s FROM counts GROUP BY lang) USING (lang) JOIN vocabulary USING (lang)
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, CAST(sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS BIGINT) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source
), terms AS (
    SELECT lang, source, term AS item, ((p - q) * (p - q)) // (p + q) AS value FROM shares JOIN overall USING (lang, term) WHERE n > 0 AND p > q
), ranked AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value,
        row_number() OVER (PARTITION BY a.lang, a.source ORDER BY coalesce(value, 0) DESC, b.source) AS rank
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
    UNION ALL
    SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) FROM terms
)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 10"""

ORACLE = {
    "op1_secret_scan": _SECRETS,
    "op7_ngram_join": _NEAR,
    "op8_exact_dedup": _EXACT,
    "op9_line_dedup": _LINES,
    "op11_source_mix": _MIX,
    "op13_source_audit": _AUDIT,
}
