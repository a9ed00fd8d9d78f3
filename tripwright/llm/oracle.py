"""DuckDB SQL for the operators that SQL can express, over all rows of the same tables."""

from __future__ import annotations

from tripwright.llm.dice_licenses import TEMPLATES

_FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP4 = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_FOLD}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), i AS (
  SELECT item_id, regexp_extract_all({_FOLD}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), iw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS m, w[k:k + least(13, len(w)) - 1] AS win
  FROM i, unnest(range(1, len(w) - least(13, len(w)) + 2)) t(k) WHERE len(w) > 0
), dw AS (
  SELECT doc_id, k, m, w[k:k + m - 1] AS win
  FROM d, (SELECT DISTINCT m FROM iw) s, unnest(range(1, len(w) - m + 2)) t(k) WHERE len(w) >= m
), h AS (
  SELECT doc_id, k, dw.m, item_id FROM dw JOIN iw ON dw.m = iw.m AND dw.win = iw.win
), c AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM h, unnest(range(k, k + m)) t(p) GROUP BY 1
), x AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
    array_to_string(list_sort(list(DISTINCT CAST(item_id AS VARCHAR))), ',') AS items
  FROM h GROUP BY 1
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN x USING (doc_id)
"""

_OP8 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({_FOLD}, '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN w ELSE w[k:k + 4] END AS sh
  FROM d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) t(k) WHERE len(w) > 0
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY 1
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2
), e AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * c >= 80 * (x.n + y.n - c)
), r AS (
  SELECT doc_id, doc_id AS o FROM d UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.o = e.a
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM d LEFT JOIN n USING (doc_id)
JOIN (SELECT doc_id, min(o) AS component_id FROM r GROUP BY 1) USING (doc_id)
"""

_NORMAL = (
    r"trim(regexp_replace(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    r"'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'))"
)
_TEMPLATE_ROWS = ", ".join(
    "('{}', '{}')".format(name, body.replace("'", "''")) for name, body in TEMPLATES.items()
)

_OP9 = rf"""
WITH u AS (
  SELECT doc_id, 0 AS kind, k - 1 AS unit, string_split(text, chr(10))[k] AS body
  FROM documents, unnest(range(1, len(string_split(text, chr(10))) + 1)) t(k)
  UNION ALL
  SELECT doc_id, 1, k - 1, p[k]
  FROM (SELECT doc_id, regexp_split_to_array(text, '\n[ \t\r]*\n') AS p FROM documents) q,
    unnest(range(1, len(p) + 1)) t(k) WHERE len(p) > 1
  UNION ALL
  SELECT doc_id, 2, 0, text FROM documents WHERE contains(text, chr(10))
), b AS (
  SELECT doc_id, kind, unit, string_split({_NORMAL.format("body")}, ' ') AS w FROM u
), g AS (
  SELECT DISTINCT doc_id, kind, unit, w[k] || ' ' || w[k + 1] AS pair
  FROM b, unnest(range(1, len(w))) t(k)
), size AS (
  SELECT doc_id, kind, unit, count(*) AS n FROM g GROUP BY ALL
), tw AS (
  SELECT license, string_split({_NORMAL.format("body")}, ' ') AS w
  FROM (VALUES {_TEMPLATE_ROWS}) v(license, body)
), tg AS (
  SELECT DISTINCT license, w[k] || ' ' || w[k + 1] AS pair FROM tw, unnest(range(1, len(w))) t(k)
), tn AS (
  SELECT license, count(*) AS m FROM tg GROUP BY 1
), both_have AS (
  SELECT doc_id, license, kind, unit, count(*) AS c FROM g JOIN tg USING (pair) GROUP BY ALL
), f AS (
  SELECT doc_id, license, kind, unit, 2.0::DOUBLE * c / (n + m) AS dice
  FROM both_have JOIN size USING (doc_id, kind, unit) JOIN tn USING (license)
), held AS (  -- texts with too few of a template's pairs have no run that matches
  SELECT doc_id, license, m, len(w) * 1.5 AS most
  FROM both_have JOIN tn USING (license) JOIN tw USING (license) WHERE kind = 2 AND 3 * c >= 2 * m
), tok AS (
  SELECT doc_id, unit, w[k] AS word, row_number() OVER (PARTITION BY doc_id ORDER BY unit, k) AS p
  FROM b, unnest(range(1, len(w) + 1)) t(k)
  WHERE kind = 0 AND w[k] <> '' AND doc_id IN (SELECT doc_id FROM held)
), pr AS (
  SELECT doc_id, p, word || ' ' || lead(word) OVER (PARTITION BY doc_id ORDER BY p) AS pair FROM tok
), ln AS (
  SELECT doc_id, unit, min(p) AS a, max(p) AS e FROM tok GROUP BY ALL
), run AS (
  SELECT h.doc_id, h.license, m, i.unit, i.a, j.e
  FROM held h JOIN ln i ON i.doc_id = h.doc_id
    JOIN ln j ON j.doc_id = h.doc_id AND j.unit > i.unit AND j.e - i.a + 1 <= most
), rd AS (
  SELECT run.doc_id, run.license, m, run.unit, e, count(DISTINCT pr.pair) AS n,
    count(DISTINCT tg.pair) AS c
  FROM run JOIN pr ON pr.doc_id = run.doc_id AND pr.p >= a AND pr.p < e
    LEFT JOIN tg ON tg.license = run.license AND tg.pair = pr.pair
  GROUP BY ALL
), every AS (
  SELECT * FROM f WHERE dice >= 0.8
  UNION ALL
  SELECT doc_id, license, 3, unit, 2.0::DOUBLE * c / (n + m) FROM rd
  WHERE 2.0::DOUBLE * c / (n + m) >= 0.8
)
SELECT doc_id, license, dice,
  CASE kind WHEN 0 THEN 'line' WHEN 1 THEN 'paragraph' WHEN 2 THEN 'text' ELSE 'run' END AS kind,
  CAST(unit AS INTEGER) AS unit, others + (kind = 3)::BIGINT AS n_units
FROM (
  SELECT *, count(*) FILTER (kind < 3) OVER (PARTITION BY doc_id, license) AS others,
    row_number() OVER (PARTITION BY doc_id, license
      ORDER BY dice DESC, kind, CASE kind WHEN 3 THEN -unit ELSE unit END) AS r
  FROM every
) WHERE r = 1
"""

_OP10 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM s)
WHERE r <= 5
"""

#: The byte table of CRC-32, from its polynomial.
_CRC_TABLE = """
  SELECT list(list_reduce(list_concat([i], range(8)), lambda c, k:
    xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)) ORDER BY i) AS crc
  FROM range(256) r(i)
"""


def _crc32(text: str) -> str:
    """CRC-32 of a text, where ``crc`` is the byte table."""
    digits = f"hex(encode({text}))"
    digit = "(instr('0123456789ABCDEF', {0}[{1}]) - 1)"
    data = (
        f"list_transform(range(1, len({digits}), 2), lambda p:"
        f" 16 * {digit.format(digits, 'p')} + {digit.format(digits, 'p + 1')})"
    )
    return (
        f"xor(list_reduce(list_concat([4294967295], {data}), lambda c, b:"
        " xor(c >> 8, crc[xor(c & 255, b) + 1])), 4294967295)"
    )


_OP11 = f"""
WITH RECURSIVE t AS ({_CRC_TABLE}), r AS (
  SELECT CAST(doc_id AS VARCHAR) AS d, unnest(regexp_extract_all({_FOLD}, '[A-Za-zÀ-ÿ]+')) AS r
  FROM documents
), c AS (
  SELECT d, r, count(*) AS n FROM r WHERE len(r) >= 5 GROUP BY 1, 2
), h AS (
  SELECT r, n, {_crc32("coalesce(d, '') || ':' || r")} AS h FROM c, t
), v AS (
  SELECT CASE WHEN h % 97 = 0 THEN r[1:h % len(r)] || r[h % len(r) + 2:] ELSE r END AS word,
    CAST(sum(n) AS BIGINT) AS n
  FROM h GROUP BY 1 HAVING len(word) >= 5 AND sum(n) >= 3
), g AS (
  SELECT word, n, p, word[1:p - 1] || word[p + 1:] AS gap FROM v, unnest(range(1, len(word) + 1)) u(p)
), e AS (
  SELECT a.word, b.word AS near, b.n FROM g a JOIN g b ON a.p = b.p AND a.gap = b.gap AND a.word <> b.word
  UNION SELECT g.word, v.word, v.n FROM g JOIN v ON g.gap = v.word
  UNION SELECT v.word, g.word, g.n FROM g JOIN v ON g.gap = v.word
), k AS (
  SELECT word, count(*) AS n_near, max(n) AS top FROM e GROUP BY 1
), b AS (
  SELECT word, min(near) AS near, any_value(top) AS top FROM e JOIN k USING (word) WHERE e.n = top GROUP BY 1
), f AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN b.top >= 2 * v.n THEN near END AS form, CASE WHEN b.top >= 2 * v.n THEN b.top END AS form_n
  FROM v LEFT JOIN k USING (word) LEFT JOIN b USING (word)
), w AS (
  SELECT word, form AS far, form_n AS far_n FROM f WHERE form IS NOT NULL
  UNION SELECT w.word, f.form, f.form_n FROM w JOIN f ON w.far = f.word WHERE f.form IS NOT NULL
)
SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n
FROM f LEFT JOIN (SELECT word, arg_max(far, far_n) AS root FROM w GROUP BY 1) USING (word)
"""

_OP13 = f"""
WITH t AS ({_CRC_TABLE}), s AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, {_crc32("CAST(conv_id AS VARCHAR)")} % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL) q, t
), m AS (
  SELECT c.conv_id, s.p, s.role, s.text FROM c JOIN s ON s.conv_id = c.conv_id - c.conv_id % 100 AND s.p <= h
  UNION ALL SELECT c.conv_id, h + s.p, s.role, s.text FROM c JOIN s USING (conv_id) WHERE s.p > h
), o AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY p) AS d, role, text FROM m
), w AS (
  SELECT conv_id, list(struct_pack(role := role, text := text) ORDER BY d) AS turns FROM o GROUP BY 1
), z AS (
  SELECT conv_id, coalesce(turns, []) AS turns FROM c LEFT JOIN w USING (conv_id)
), x AS (
  SELECT conv_id, d, len(turns) AS size, turns[1:d] AS node, len(coalesce(turns[d].text, '')) AS chars
  FROM z, unnest(range(0, len(turns) + 1)) u(d)
), n AS (
  SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE size = d), '')) AS ends_sha256
  FROM x GROUP BY 1, 2
), k AS (
  SELECT node[1:d - 1] AS node, d - 1 AS d, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1, 2
), l AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (node, d)
), a AS (
  SELECT node[1:u.e] AS node, u.e AS d, sum(CAST(n_children = 0 AS INT)) AS n_leaves, sum((n_convs - 1) * chars) AS saved
  FROM l, unnest(range(0, d + 1)) u(e) GROUP BY 1, 2
)
SELECT l.conv_id, l.d AS depth, p.conv_id AS parent_conv_id, l.n_convs, l.n_children,
  CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, l.ends_sha256
FROM l JOIN a USING (node, d) LEFT JOIN n p ON p.d = l.d - 1 AND p.node = l.node[1:l.d - 1]
"""

ORACLE = {
    "op4_winnowing": _OP4,
    "op8_set_relations": _OP8,
    "op9_dice_licenses": _OP9,
    "op10_mtree_topk": _OP10,
    "op11_trie_frontier": _OP11,
    "op13_prefix_bitmaps": _OP13,
}
