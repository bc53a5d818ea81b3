"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

from .secrets import PATTERNS

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Sites of any size, a line on two pages or more; whole pages may go.
LINE_DEDUP = r"""
WITH pages AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents),
totals AS (SELECT source, count(*) AS pages FROM pages WHERE source IS NOT NULL GROUP BY source),
each AS (
  SELECT source, line, count(*) AS n
  FROM (SELECT source, unnest(list_distinct(list_filter(list_transform(lines, lambda s: trim(s, ' ' || chr(9) || chr(13))), lambda s: s <> ''))) AS line
        FROM pages WHERE source IS NOT NULL AND text IS NOT NULL)
  GROUP BY source, line),
bad AS (SELECT source, list(line) AS bad FROM each JOIN totals USING (source) WHERE n >= 2 AND n > 0.05 * pages GROUP BY source),
cut AS (
  SELECT doc_id, p.source, text, lines,
    CASE WHEN bad IS NULL THEN lines ELSE list_filter(lines, lambda s: trim(s, ' ' || chr(9) || chr(13)) = '' OR NOT list_contains(bad, trim(s, ' ' || chr(9) || chr(13)))) END AS kept
  FROM pages p LEFT JOIN bad ON p.source = bad.source)
SELECT doc_id, source,
  CASE WHEN len(kept) < len(lines) THEN array_to_string(kept, chr(10)) ELSE text END AS text,
  CAST(coalesce(len(lines) - len(kept), 0) AS BIGINT) AS n_dropped,
  coalesce(len(kept) < len(lines) AND len(list_filter(kept, lambda s: trim(s, ' ' || chr(9) || chr(13)) <> '')) = 0, false) AS all_boilerplate
FROM cut
"""

SECRET_SCAN = (
    r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, chr(1)) AS owner, coalesce(text, '') AS t FROM documents),
c AS ("""
    + " UNION ALL ".join(
        f"""
  SELECT r, doc_id, owner, '{kind}' AS kind, {rank} AS rank, regexp_extract_all(t, $re${p}$re$) AS m,
    regexp_extract_all(t, $re${p}$re$, {2 if kind == "assign" else 0}) AS v, string_split_regex(t, $re${p}$re$) AS b FROM t"""
        for rank, (kind, p) in enumerate(PATTERNS.items())
    )
    + r"""),
u AS (SELECT r, doc_id, owner, kind, rank, unnest(m) AS m, unnest(v) AS v, unnest(b[1:len(m)]) AS b, unnest(range(1, len(m) + 1)) AS i FROM c WHERE len(m) > 0),
z AS (SELECT *, sum(length(b) + length(m)) OVER (PARTITION BY r, kind ORDER BY i) AS z FROM u),
s AS (SELECT r, doc_id, owner, kind, rank, v, CAST(z - length(m) AS BIGINT) AS a, CAST(z AS BIGINT) AS z FROM z WHERE kind <> 'assign' OR length(v) >= 8),
o AS (SELECT v, count(DISTINCT (owner, doc_id)) > 3 OR count(DISTINCT owner) > 1 AS example FROM s GROUP BY v),
j AS (SELECT s.*, example, NOT example AND len(list_distinct(string_split(v, ''))) >= 8 AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]') AS live FROM s JOIN o USING (v)),
p AS (
  SELECT r, kind || ':' || a || ':' || z AS span, a, rank, z FROM j
  UNION ALL SELECT r, 'live:' || (z - length(v)) || ':' || z, z - length(v), 3, z FROM j WHERE live),
n AS (
  SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(kind || ':' || a || ':' || z, ',' ORDER BY a, rank) AS base, count(*) FILTER (live) AS n_live, count(*) FILTER (example) AS n_example
  FROM j GROUP BY r),
q AS (SELECT r, string_agg(span, ',' ORDER BY a, rank, z) AS spans FROM p GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM t LEFT JOIN n USING (r) LEFT JOIN q USING (r)
"""
)

_WORDS = r"regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
DECONTAMINATION = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
b AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
bw AS (SELECT DISTINCT item_id, n, array_to_string(ws[i:i + n - 1], ' ') AS win
  FROM (SELECT item_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM (SELECT item_id, ws, least(10, len(ws)) AS n FROM b WHERE len(ws) > 0))),
dw AS (SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(ws) >= n)),
h AS (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (n, win)),
hit AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM h) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""

_BLANK_WORDS = r"regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + r", '[^\x20\x09-\x0D]+')"
NEAR_DEDUP = rf"""
WITH RECURSIVE w AS (SELECT doc_id, {_BLANK_WORDS} AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, sh FROM (
  SELECT doc_id, unnest(CASE WHEN len(ws) = 1 THEN ws ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS sh FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS z, count(*) AS k FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id < y.doc_id GROUP BY ALL),
l AS (SELECT a, z FROM p JOIN n na ON na.doc_id = a JOIN n nz ON nz.doc_id = z WHERE 100 * k >= 80 * (na.n + nz.n - k)),
e AS (SELECT a, z FROM l UNION ALL SELECT z, a FROM l),
r(doc_id, reach) AS (SELECT doc_id, doc_id FROM w UNION SELECT r.doc_id, e.z FROM r JOIN e ON r.reach = e.a),
c AS (SELECT doc_id, min(reach) AS component_id FROM r GROUP BY doc_id)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, component_id = w.doc_id AS kept
FROM w LEFT JOIN n USING (doc_id) JOIN c USING (doc_id)
"""

#: CRC-32 by its table of 256 values, for each distinct word; runs of one word.
IMPORTANCE = rf"""
WITH tab AS (SELECT list(list_reduce(range(8)::UBIGINT[], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i::UBIGINT) ORDER BY i) AS tab FROM range(256) AS r(i)),
d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS ws FROM documents),
w AS (SELECT r, unnest(ws) AS word FROM d),
bw AS (SELECT unnest({_WORDS}) AS word FROM benchmark),
v AS (SELECT word, hex(encode(word)) AS x FROM (SELECT word FROM w UNION SELECT word FROM bw)),
k AS (SELECT word, xor(list_reduce(list_transform(range(len(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::UBIGINT),
    lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255)::BIGINT + 1]), 4294967295::UBIGINT), 4294967295) % 10000 AS bucket FROM v, tab),
s AS (SELECT bucket, count(*) AS n FROM w JOIN k USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM bw JOIN k USING (word) GROUP BY bucket),
g AS (SELECT bucket, floor(1000 * ln(((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s) + 10000)::DOUBLE)
    / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + 10000)::DOUBLE)))::BIGINT AS gain FROM s FULL JOIN t USING (bucket)),
f AS (SELECT r, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM w JOIN k USING (word) JOIN g USING (bucket) GROUP BY r),
p AS (SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::UBIGINT::DOUBLE + 0.5) / 4294967296.0)))::BIGINT AS score
  FROM d LEFT JOIN f USING (r)),
o AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place, count(*) FILTER (n_features >= 20) OVER () AS able FROM p)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * able // 100 THEN place END AS rank FROM o
"""

#: The tables' pages all mark their article; its blocks are p and h1.
HTML_TEXT = r"""
WITH a AS (SELECT page_id, url, replace(regexp_extract(coalesce(html, ''), '<article>(.*?)</article>', 1, 's'), '<br>', ' ') AS a FROM pages),
b AS (SELECT page_id, url, list_transform(regexp_split_to_array(a, '</?(?:p|h1)>'), lambda b: regexp_replace(b, '<[^>]*>', '', 'g')) AS bs FROM a),
c AS (SELECT page_id, url, list_transform(bs, lambda b: regexp_replace(replace(replace(replace(b, '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g')) AS bs FROM b),
t AS (SELECT page_id, url, array_to_string(list_filter(list_transform(bs, lambda b: trim(regexp_replace(b, '\s+', ' ', 'g'))), lambda b: b <> ''), chr(10)) AS text FROM c)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM t
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_line_dedup": LINE_DEDUP,
        "op1_line_dedup_all": LINE_DEDUP,
        "op4_secret_scan": SECRET_SCAN,
        "op7_decontamination": DECONTAMINATION,
        "op10_near_dedup": NEAR_DEDUP,
        "op12_importance": IMPORTANCE,
        "op13_html_text": HTML_TEXT,
    }
