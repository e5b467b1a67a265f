"""DuckDB SQL of operators whose results SQL can express."""

from __future__ import annotations


def _crc_table() -> list[int]:
    """The reversed CRC-32 polynomial's remainders of four bits."""
    table = []
    for value in range(16):
        for _ in range(4):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    return table


def crc32(text: str) -> str:
    """Check sum of an expression's UTF-8 bytes; its code points are below U+0800."""
    point = "unicode(c)"
    each = f"CASE WHEN {point} < 128 THEN [{point}] ELSE [192 + ({point} >> 6), 128 + ({point} & 63)] END"
    octets = f"flatten(list_transform(string_split({text}, ''), lambda c: {each}))"
    half = lambda c: f"xor(({c}) >> 4, {_crc_table()}[(({c}) & 15) + 1])"
    low = half("xor(s, o)")
    steps = f"list_reduce({octets}, lambda s, o: {half(low)}, 4294967295::BIGINT)"
    return f"xor({steps}, 4294967295)"


OP13 = f"""
WITH RECURSIVE runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
    unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run
  FROM documents
),
counted AS (
  SELECT id, run, count(*) AS k FROM runs WHERE length(run) >= 7 GROUP BY ALL
),
summed AS (
  SELECT run, k, {crc32("id || ':' || run")} AS h FROM counted
),
cut AS (
  SELECT k, CASE WHEN h % 31 = 0 THEN run[1 : h % length(run)] || run[h % length(run) + 2 :] ELSE run END AS word
  FROM summed
),
words AS MATERIALIZED (
  SELECT word, CAST(sum(k) AS BIGINT) AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2
),
holes AS MATERIALIZED (
  SELECT word, n, gap, word[1 : gap] AS front, word[gap + 2 :] AS back
  FROM (SELECT word, n, unnest(range(length(word))) AS gap FROM words)
),
near AS (
  SELECT a.word, b.word AS other, b.n FROM holes a JOIN holes b USING (gap, front, back) WHERE a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM holes a JOIN words b ON b.word = a.front || a.back
  UNION SELECT b.word, a.word, a.n FROM holes a JOIN words b ON b.word = a.front || a.back
),
best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, other) AS other, max(n) AS most FROM near GROUP BY word
),
forms AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 10 * w.n THEN other END AS form,
    CASE WHEN most >= 10 * w.n THEN most END AS form_n
  FROM words w LEFT JOIN best USING (word)
),
walk AS (
  SELECT word, word AS here FROM forms
  UNION ALL SELECT walk.word, forms.form FROM walk JOIN forms ON walk.here = forms.word WHERE forms.form IS NOT NULL
),
roots AS (
  SELECT walk.word, walk.here AS root FROM walk JOIN forms ON walk.here = forms.word WHERE forms.form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)
"""


def _words(text: str) -> str:
    lowered = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"regexp_extract_all({lowered}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


OP11 = f"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, {_words("text")} AS w FROM documents
),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, {_words("text")} AS w FROM benchmark WHERE item_id IS NOT NULL
),
windows AS MATERIALIZED (
  SELECT DISTINCT item, size, w[s : s + size - 1] AS held
  FROM (
    SELECT item, w, least(len(w), 10) AS size, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s
    FROM items WHERE len(w) > 0
  )
),
places AS (
  SELECT r, size, s, w[s : s + size - 1] AS held
  FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM d, (SELECT DISTINCT size FROM windows))
),
hits AS MATERIALIZED (
  SELECT r, s, size, item FROM places JOIN windows USING (size, held)
),
covered AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + size)) AS p FROM hits) GROUP BY r
),
named AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""


#: Rows of one turn, which the tables don't have, would be in the order of role and text here.
OP12 = f"""
WITH turns AS MATERIALIZED (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations)
  WHERE conv_id IS NOT NULL
),
heads AS (
  SELECT conv_id, conv_id - conv_id % 20 AS source, {crc32("CAST(conv_id AS VARCHAR)")} % 4 AS lead
  FROM (SELECT DISTINCT conv_id FROM turns)
),
rebuilt AS (
  SELECT h.conv_id, 0 AS part, pos, role, text FROM heads h JOIN turns t ON t.conv_id = h.source AND pos <= lead
  UNION ALL SELECT h.conv_id, 1, pos, role, text FROM heads h JOIN turns t ON t.conv_id = h.conv_id AND pos > lead
),
sequences AS MATERIALIZED (
  SELECT h.conv_id, coalesce(seq, []) AS seq
  FROM heads h LEFT JOIN
    (SELECT conv_id, list([role, text] ORDER BY part, pos) AS seq FROM rebuilt GROUP BY conv_id) USING (conv_id)
),
members AS MATERIALIZED (
  SELECT conv_id, seq[1 : d] AS prefix, d, d = len(seq) AS ends
  FROM (SELECT conv_id, seq, unnest(range(len(seq) + 1)) AS d FROM sequences)
),
nodes AS MATERIALIZED (
  SELECT prefix, d, min(conv_id) AS conv_id, count(*) AS n_convs,
    string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends) AS ended,
    CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * len(regexp_extract_all(prefix[d][2], '[^\\x20\\x09-\\x0D]+')) END AS saved
  FROM members GROUP BY prefix, d
),
children AS (
  SELECT prefix[1 : d - 1] AS prefix, d - 1 AS d, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL
),
known AS MATERIALIZED (
  SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (prefix, d)
),
subtrees AS (
  SELECT prefix[1 : up] AS prefix, up AS d, CAST(sum(saved) AS BIGINT) AS saved_tokens,
    count(*) FILTER (n_children = 0) AS n_leaves
  FROM (SELECT *, unnest(range(d + 1)) AS up FROM known) GROUP BY ALL
)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves, saved_tokens,
  sha256(coalesce(n.ended, '')) AS ends_sha256
FROM known n JOIN subtrees USING (prefix, d)
  LEFT JOIN known p ON n.d > 0 AND p.d = n.d - 1 AND p.prefix = n.prefix[1 : n.d - 1]
"""
