"""DuckDB SQL for the numbered queries; every constant is written out here, none is imported."""

_UP, _DOWN = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOW = f"translate({{}}, '{_UP}', '{_DOWN}')"
_BLANK = r"[\x20\x09-\x0D]"


def line_dedup_sql(documents: str = "documents") -> str:
    """(doc_id, text, n_lines, n_dropped) with the kept lines as text."""
    return rf"""
WITH src AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM {documents}),
ln AS (SELECT r, doc_id, unnest(string_split(text, chr(10))) AS line,
              generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM src),
keyed AS (SELECT *, {_LOW.format(f"regexp_replace(regexp_replace(line, '^{_BLANK}+', ''), '{_BLANK}+$', '')")} AS k FROM ln),
held AS (SELECT k, min(doc_id) AS owner FROM keyed WHERE length(k) >= 10
         GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
marked AS (SELECT keyed.*, owner IS NOT NULL AND doc_id <> owner AS lost FROM keyed LEFT JOIN held USING (k))
SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '') AS text,
       count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped
FROM marked GROUP BY r, doc_id
"""

_LETTER_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SPACED_WORD = r"[^\x20\x09-\x0D]+"


def contamination_sql(documents: str = "documents", benchmark: str = "benchmark") -> str:
    """(r, doc_id, text, n_words, n_hit, n_items, items, contaminated) by all windows of 13 words."""
    words = f"regexp_extract_all({_LOW.format("coalesce(text, '')")}, '{_LETTER_WORD}')"
    cut = "array_to_string(w[i:i + {n} - 1], ' ')"
    return rf"""
WITH src AS (SELECT row_number() OVER () AS r, doc_id, text, {words} AS w FROM {documents}),
item AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {words} AS w FROM {benchmark}),
win AS (SELECT DISTINCT item, least(len(w), 13) AS n, {cut.format(n="least(len(w), 13)")} AS win
        FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM item WHERE len(w) > 0)),
spot AS (SELECT r, i, n, {cut.format(n="n")} AS win
       FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
             FROM src, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS (SELECT DISTINCT r, i, n, item FROM spot JOIN win USING (n, win)),
per AS (SELECT r, count(DISTINCT p) AS n_hit
        FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM hit)) GROUP BY r),
its AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hit GROUP BY r)
SELECT r, doc_id, text, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items, '') AS items, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM src LEFT JOIN per USING (r) LEFT JOIN its USING (r)
"""


def jaccard_sql(documents: str = "documents") -> str:
    """(r, doc_id, text, n_shingles, component_id) from all pairs that share a shingle."""
    words = f"regexp_extract_all({_LOW.format("coalesce(text, '')")}, '{_SPACED_WORD}')"
    return rf"""
WITH RECURSIVE src AS (SELECT row_number() OVER () AS r, doc_id, text, {words} AS w FROM {documents}),
shingle AS (SELECT DISTINCT r, array_to_string(w[i:i + 3], ' ') AS s
            FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM src WHERE len(w) > 0)),
size AS (SELECT r, count(*) AS n FROM shingle GROUP BY r),
pair AS MATERIALIZED (SELECT a.r AS a, b.r AS b, count(*) AS k FROM shingle a JOIN shingle b ON a.s = b.s AND a.r < b.r GROUP BY 1, 2),
link AS MATERIALIZED (SELECT a, b FROM pair JOIN size x ON x.r = a JOIN size y ON y.r = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
edge AS MATERIALIZED (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT r, r AS t FROM src UNION SELECT reach.r, edge.b FROM reach JOIN edge ON edge.a = reach.t),
low AS (SELECT reach.r, min(doc_id) AS c FROM reach JOIN src ON src.r = reach.t GROUP BY reach.r)
SELECT r, doc_id, text, coalesce(n, 0)::BIGINT AS n_shingles, c AS component_id
FROM src LEFT JOIN size USING (r) LEFT JOIN low USING (r)
"""


def quality_sql(documents: str = "documents", labels: str = "labels") -> str:
    """(r, doc_id, text, lang, counts, base_failed, kept); thresholds by the exact binomial tail."""
    return rf"""
WITH src AS (SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS lang, text, coalesce(text, '') AS t FROM {documents}),
cut AS (SELECT *, regexp_extract_all(t, '{_SPACED_WORD}') AS w,
               list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_SPACED_WORD}')) AS l FROM src),
win AS (SELECT r, i, array_to_string(w[i:i + 4], chr(1)) AS g FROM
        (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM cut WHERE len(w) >= 5)),
twice AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS k FROM win),
rep AS (SELECT r, count(DISTINCT p) AS n_repeat_words
        FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM twice WHERE k > 1) GROUP BY r),
f AS (SELECT r, doc_id, lang, text, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
             len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
             length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_capitals, len(l) AS n_lines
      FROM cut LEFT JOIN rep USING (r)),
based AS MATERIALIZED (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f),
score AS (SELECT r, doc_id, lang, base_failed, rule, CASE WHEN d > 0 THEN least(1000, 1000 * c // d) ELSE 0 END AS s
          FROM (SELECT *, unnest(['symbols', 'capitals', 'repeated', 'lines']) AS rule,
                       unnest([n_symbols, n_capitals, n_repeat_words, n_dup_lines]) AS c,
                       unnest([word_chars, word_chars, n_words, n_lines]) AS d FROM based)),
lab AS (SELECT doc_id, min(quality) AS q FROM {labels} GROUP BY doc_id),
hist AS (SELECT lang, rule, s, sum(q) AS g, sum(1 - q) AS b FROM score JOIN lab USING (doc_id)
         WHERE NOT base_failed AND q IN (0, 1) GROUP BY ALL),
own AS (SELECT lang, sum(g) AS n FROM hist WHERE rule = 'symbols' GROUP BY lang),
pool AS (SELECT lang, CASE WHEN n >= ln(0.05 / (4 * (SELECT count(*) FROM own))) / ln(0.98) THEN '=' || lang ELSE '' END AS pool FROM own),
pools AS (SELECT 0.05 / (4 * count(DISTINCT pool)) AS e FROM pool),
cum AS (SELECT pool, rule, s, sum(sum(g)) OVER (PARTITION BY pool, rule) AS n,
               sum(sum(g)) OVER (PARTITION BY pool, rule ORDER BY s DESC) AS k,
               sum(sum(b)) OVER (PARTITION BY pool, rule ORDER BY s DESC) AS b FROM hist JOIN pool USING (lang) GROUP BY pool, rule, s),
part AS (SELECT *, 0.02 / m AS p FROM
         (SELECT *, greatest(1, len(list_filter([1, 2, 3, 4], lambda x: n >= ln(e) / ln(1 - 0.02 / x)))) AS m FROM cum, pools)),
tail AS (SELECT *, CASE WHEN k >= p * n THEN 1 ELSE list_sum(list_transform(range(0, k::BIGINT + 1),
           lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(p) + (n - i) * ln(1 - p)))) END AS q
         FROM part WHERE s > 0),
best AS (SELECT pool, rule, any_value(m) AS m, max(b - 10 * k) AS gain, arg_max(s, (b - 10 * k) * 10000 + s) AS t FROM tail
         WHERE q <= e AND b - 10 * k > 0 GROUP BY pool, rule),
lim AS (SELECT lang, rule, t FROM (SELECT * FROM best QUALIFY row_number() OVER (PARTITION BY pool ORDER BY gain DESC, rule) <= m)
        JOIN pool USING (pool)),
broke AS (SELECT DISTINCT r FROM score JOIN lim USING (lang, rule) WHERE s >= t)
SELECT based.*, NOT base_failed AND broke.r IS NULL AS kept FROM based LEFT JOIN broke USING (r)
"""

_HOST = _LOW.format(r"regexp_extract(u, '(?s)^.*?://([^/?#]*)', 1)")
_PATH = r"regexp_extract(u, '(?s)^.*?://[^/?#]*([^?#]*)', 1)"
_STRICT = "['casino', 'porn', 'xxx', 'viagra', 'warez', 'escort', 'malware', 'phishing']"
_SOFT = "['adult', 'ads', 'bet', 'bets', 'cheap', 'click', 'farm', 'free', 'pills', 'promo', 'spam', 'track', 'win', 'x']"
_FOUND = "len(list_filter({}, lambda t: regexp_matches(low, '(^|[^a-z0-9])' || t || '([^a-z0-9]|$)')))"
URL_SQL = rf"""
WITH p AS (SELECT page_id, coalesce(url, '') AS u FROM pages),
q AS (SELECT page_id, {_LOW.format("u")} AS low, {_HOST} AS host, {_PATH} AS path FROM p),
r AS (SELECT *, {_FOUND.format(_STRICT)} AS n_strict, {_FOUND.format(_SOFT)} AS n_soft,
             CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
                  WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
                  WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
                  WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM q)
SELECT page_id, host, path, rule, n_strict, n_soft,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN 2 * n_strict + n_soft >= 2 THEN 'block' ELSE 'allow' END AS verdict FROM r
"""

_NOTICES = """(VALUES
 ('agpl-3.0', 'it under the terms of the gnu affero general public license as published by the free software foundation'),
 ('apache-2.0', 'licensed under the apache license version 2 0'),
 ('bsd', 'redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met'),
 ('cc-by-nc-4.0', 'licensed under cc by nc 4 0'),
 ('gpl-3.0', 'licensed under the gnu general public license version 3'),
 ('gpl-notice', 'this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation'),
 ('isc', 'permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted'),
 ('mit-notice', 'released under the mit license'),
 ('mit-text', 'permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files'),
 ('mpl-2.0', 'this source code form is subject to the terms of the mozilla public license v 2 0')) n (label, t)"""
_PHRASES = """(VALUES ('gnu general public license', 'gpl'), ('apache license', 'apache'), ('cc by', 'cc-by'), ('mit license', 'mit')) n (t, label)"""
LICENSE_SQL = rf"""
WITH src AS (SELECT row_number() OVER () AS r, doc_id,
                    regexp_extract_all({_LOW.format("coalesce(text, '')")}, '{_LETTER_WORD}') AS w FROM documents),
spot AS (SELECT r, w, unnest(range(0, len(w))) AS p FROM src),
phrase AS (SELECT string_split(t, ' ') AS ph, label FROM {_PHRASES}),
base AS (SELECT r, p, label FROM spot, phrase WHERE w[p + 1:p + len(ph)] = ph),
per AS (SELECT r, count(*) AS n, min(p) AS lo, max(p) AS hi, list(DISTINCT label) AS ls FROM base GROUP BY r),
notice AS (SELECT label, string_split(t, ' ') AS nw FROM {_NOTICES}),
mark AS (SELECT label, len(nw) - 2 AS size, q, nw[q + 1:q + 3] AS g FROM (SELECT *, unnest(range(0, len(nw) - 2)) AS q FROM notice)),
hit AS (SELECT r, label, size, p, q, p - q AS diag FROM spot JOIN mark ON w[p + 1:p + 3] = g),
vote AS (SELECT r, label, size, diag, min(p) AS lo, max(p) AS hi, list(q) AS qs FROM hit GROUP BY ALL),
fresh AS (SELECT *, coalesce((diag - lag(diag) OVER (PARTITION BY r, label ORDER BY diag) > 3)::INT, 1) AS f FROM vote),
grp AS (SELECT *, sum(f) OVER (PARTITION BY r, label ORDER BY diag) AS s FROM fresh),
span AS (SELECT r, label, size, min(lo) AS a, max(hi) + 2 AS b, len(list_distinct(flatten(list(qs)))) AS met FROM grp GROUP BY r, label, size, s),
good AS (SELECT r, list(DISTINCT label) AS ls, max(met / size) AS score FROM span
         WHERE met >= 0.6 * size AND b - a + 1 <= 1.5 * (size + 2) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_base, lo AS first_word, hi AS last_word,
       coalesce(array_to_string(list_sort(per.ls), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(per.ls, good.ls))), ','), '') AS labels,
       coalesce(score, 0) AS score
FROM src LEFT JOIN per USING (r) LEFT JOIN good USING (r)
"""

_ESCAPED = r"length(regexp_replace({}, '([<\[\\])', '\1\\', 'g'))"
CHAT_SQL = rf"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(32 + {_ESCAPED.format("role")} + {_ESCAPED.format("text")})::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""

COLLOCATION_SQL = rf"""
WITH piece AS (SELECT coalesce(lang, 'und') AS lang,
                      unnest(string_split_regex({_LOW.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
cut AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM piece),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM cut GROUP BY lang),
spot AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM cut, (VALUES (1), (2), (3), (4)) v(k) WHERE len(w) >= k),
f AS MATERIALIZED (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS g, count(*) AS n FROM spot GROUP BY ALL HAVING count(*) >= 30),
part AS (SELECT lang, g, k, n AS a, string_split(g, ' ') AS w, unnest(range(1, k)) AS c FROM f WHERE k > 1),
score AS (SELECT part.*, x.n AS l, y.n AS r, (2000000::HUGEINT * a // (x.n::HUGEINT + y.n))::BIGINT AS s FROM part
          JOIN f x ON x.lang = part.lang AND x.g = array_to_string(part.w[1:c], ' ')
          JOIN f y ON y.lang = part.lang AND y.g = array_to_string(part.w[c + 1:part.k], ' ')),
low AS (SELECT * FROM score QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY s, c) = 1),
sub AS (SELECT lang, n, string_split(g, ' ') AS w, m, unnest(range(1, k - m + 2)) AS i FROM f, (VALUES (2), (3)) v(m) WHERE k > m),
around AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS g, max(n) AS n FROM sub GROUP BY ALL),
free AS (SELECT low.* FROM low LEFT JOIN around USING (lang, g) WHERE around.n IS NULL OR 100 * around.n < 80 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY s DESC, a DESC, g) AS rank FROM free)
SELECT lang, rank, g AS phrase, a, l, r, total.n AS n, s AS score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""


SQL = {
    "op13_collocations": COLLOCATION_SQL,
    "op6_license_scan": LICENSE_SQL,
    "op8_chat_format": CHAT_SQL,
    "op4_url_filter": URL_SQL,
    "op2_decontaminate": f"""
SELECT doc_id, n_words, n_hit, n_items, sha256(items) AS items_sha256, contaminated FROM ({contamination_sql()})""",
    "op3_jaccard_join": f"SELECT doc_id, n_shingles, component_id FROM ({jaccard_sql()})",
    "op5_quality_rules": f"""
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM ({quality_sql()})""",
    "op7_line_dedup": f"SELECT doc_id, n_lines, n_dropped, sha256(text) AS kept_sha256 FROM ({line_dedup_sql()})",
}
