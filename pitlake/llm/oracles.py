"""DuckDB SQL of the operators that SQL can express on whole tables."""

from __future__ import annotations

#: Words are maximal runs without space and the controls 9 to 13; A-Z are lower-cased.
_WORDS = r"list_filter(regexp_split_to_array(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

OP3 = f"""WITH RECURSIVE w AS (SELECT doc_id, coalesce({_WORDS.format(text="text")}, []) AS w FROM documents),
 s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' '))) END AS s FROM w),
 n AS (SELECT doc_id, len(s) AS n, list_sort(s) AS s FROM s),
 class AS (SELECT min(doc_id) AS rep, s, any_value(n) AS n FROM n WHERE n > 0 GROUP BY s),
 u AS (SELECT rep, n, unnest(s) AS g FROM class),
 pair AS (SELECT a.rep AS a, b.rep AS b FROM u a JOIN u b ON a.g = b.g AND a.rep < b.rep GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
 edge AS (SELECT a, b FROM pair UNION ALL SELECT b, a FROM pair),
 reach AS (SELECT rep AS v, rep AS r FROM class UNION SELECT e.b, reach.r FROM reach JOIN edge e ON e.a = reach.v),
 comp AS (SELECT v, min(r) AS c FROM reach GROUP BY v)
 SELECT n.doc_id, n.n AS n_shingles, coalesce(comp.c, n.doc_id) AS component_id, n.doc_id = coalesce(comp.c, n.doc_id) AS kept FROM n LEFT JOIN class ON class.s = n.s AND n.n > 0 LEFT JOIN comp ON comp.v = class.rep"""

_LOOSE = r"list_filter(string_split(regexp_replace(lower({text}), '[\x00-\x2F:-@\[-`{{-\x7F]+', ' ', 'g'), ' '), lambda x: x <> '')"

OP9 = f"""WITH b AS (SELECT item_id, {_LOOSE.format(text="text")} AS w FROM benchmark WHERE text IS NOT NULL),
 i AS (SELECT item_id, least(5, len(w)) AS width, list_distinct(list_transform(range(1, len(w) - least(5, len(w)) + 2), lambda k: array_to_string(w[k:k + least(5, len(w)) - 1], ' '))) AS s FROM b WHERE len(w) > 0),
 g AS (SELECT item_id, width, len(s) AS n, unnest(s) AS g FROM i),
 d AS (SELECT doc_id, {_LOOSE.format(text="text")} AS w FROM documents WHERE text IS NOT NULL),
 p AS (SELECT DISTINCT doc_id, width, unnest(list_transform(range(1, len(w) - width + 2), lambda k: array_to_string(w[k:k + width - 1], ' '))) AS g FROM d, (SELECT DISTINCT width FROM i) WHERE len(w) >= width)
 SELECT doc_id, item_id, n AS n_item_shingles, count(*) AS n_shared, count(*) / n AS containment FROM p JOIN g USING (width, g) GROUP BY doc_id, item_id, n HAVING 100 * count(*) >= 80 * n"""

#: Bytes as hexadecimal digits, two for each.
OP10 = """WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents), n AS (SELECT doc_id, h, len(h) // 2 AS n FROM d),
 w AS (SELECT doc_id, i, substr(h, CAST(2 * i + 1 AS BIGINT), 200) AS s FROM (SELECT doc_id, h, unnest(range(0, n - 99)) AS i FROM n WHERE n >= 100)),
 later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM w) WHERE k > 1),
 starts AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS new FROM later),
 nr AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM starts),
 span AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS z FROM nr GROUP BY doc_id, k),
 cut AS (SELECT span.doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY span.doc_id ORDER BY a), 0) AS before, h FROM span JOIN n USING (doc_id)),
 part AS (SELECT doc_id, count(*) AS n_spans, sum(z - a) AS n_removed, max(z) AS stop, string_agg(substr(h, CAST(2 * before + 1 AS BIGINT), CAST(2 * (a - before) AS BIGINT)), '' ORDER BY a) AS kept FROM cut GROUP BY doc_id)
 SELECT n.doc_id, n.n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept || substr(h, CAST(2 * stop + 1 AS BIGINT)), h))) AS kept_sha256 FROM n LEFT JOIN part USING (doc_id)"""

ORACLES = {"op3_near_dedup": OP3, "op9_decontamination": OP9, "op10_suffix_dedup": OP10}
