"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from obsflow.llm.license_scan import TEMPLATES

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM_WORDS = rf"regexp_extract_all({_LOWER}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')"

OP1 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
), sh AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
  FROM w
), n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM common JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)
), reach(x, y) AS (
  SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y
), low AS (SELECT x, min(y) AS y FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(low.y, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(low.y, d.doc_id)) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN low ON low.x = d.doc_id
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_TEMPLATE_ROWS = ", ".join(f"({_quoted(k)}, {_quoted(v)})" for k, v in sorted(TEMPLATES.items()))
_FIVE = """unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)"""

OP4 = f"""
WITH t(license_id, text) AS (VALUES {_TEMPLATE_ROWS}),
ts AS (SELECT DISTINCT license_id, {_FIVE} AS s FROM (SELECT license_id, {_ALNUM_WORDS} AS w FROM t)),
tn AS (SELECT license_id, count(*) AS n FROM ts GROUP BY 1),
ds AS (SELECT DISTINCT doc_id, {_FIVE} AS s FROM (SELECT doc_id, {_ALNUM_WORDS} AS w FROM documents)),
c AS (SELECT doc_id, license_id, count(*) AS k FROM ds JOIN ts USING (s) GROUP BY 1, 2)
SELECT doc_id, license_id, k AS n_shared, n AS n_template, k / n AS containment FROM c JOIN tn USING (license_id) WHERE k >= 0.8 * n
"""

OP6 = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9
), reach(x, y) AS (
  SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y
), n AS (SELECT x, count(*) AS n FROM links GROUP BY 1),
low AS (SELECT x, min(y) AS y FROM reach GROUP BY 1)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(low.y, e.vec_id)) AS component_id,
       e.vec_id = least(e.vec_id, coalesce(low.y, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN n ON n.x = e.vec_id LEFT JOIN low ON low.x = e.vec_id
"""

OP8 = f"""
WITH d AS (SELECT doc_id, {_ALNUM_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_ALNUM_WORDS} AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 10 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 8), lambda i: array_to_string(w[i:i + 9], ' ')) END) AS s
  FROM b
), sizes AS (SELECT DISTINCT len(string_split(s, ' ')) AS size FROM item_windows),
doc_windows AS (
  SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS pos, w FROM d, sizes WHERE len(w) >= size
), hits AS (
  SELECT doc_id, pos, size, item_id FROM (SELECT doc_id, pos, size, array_to_string(w[pos:pos + size - 1], ' ') AS s FROM doc_windows) JOIN item_windows USING (s)
), places AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + size)) AS p FROM hits),
n_hit AS (SELECT doc_id, count(*) AS n FROM places GROUP BY 1),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n, list_sort(list_distinct(list(item_id::VARCHAR))) AS ids FROM hits GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(items.ids, ','), '')) AS items_sha256, coalesce(n_hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN n_hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP10 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), s AS (
  SELECT *, length(text) + length(regexp_replace(text, '[^<\[\\]', '', 'g')) AS shown,
    CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
      ELSE 25 + length(role) + length(regexp_replace(role, '[^<\[\\]', '', 'g')) END AS marks
  FROM t
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(shown + marks)::BIGINT AS formatted_chars
FROM s GROUP BY conv_id
"""

_CRC32 = """xor(list_reduce(list_transform(range(1, len(k) + 1), lambda i: ascii(k[i])::BIGINT), lambda c, b:
    list_reduce(range(8), lambda d, _: xor(d >> 1, (d & 1) * 3988292384), xor(c, b)), 4294967295), 4294967295)"""


def _least(*choices: str) -> str:
    """The cheapest of (cost, audit) structs, ties by audit."""
    return f"list_sort(list_filter([{', '.join(choices)}], lambda x: x IS NOT NULL))[1]"


def _edit(letter: str, cost: str, state: str) -> str:
    return f"{{'c': {cost} + {state}.c, 'a': '{letter}' || {state}.a}}"


_TO = {0: 2, 1: 2, 2: 3, 3: 2}
_KEEPS = {0: "CASE g WHEN 's' THEN q1 WHEN 'u' THEN q2 END", 1: "CASE g WHEN 'u' THEN q2 END", 2: "CASE g WHEN 'a' THEN q3 END", 3: "CASE g WHEN 'u' THEN q2 END"}
_ROW_EDITS = ", ".join(
    _least(
        _edit("D", "2", f"q{s}"),
        f"CASE WHEN fault IN ('', 'truncated') THEN {_edit('R', '1 + late', f'q{to}')} END",
        f"CASE WHEN fault IN ('', 'truncated') AND ({_KEEPS[s]}) IS NOT NULL THEN {_edit('K', 'late', f'({_KEEPS[s]})')} END",
    )
    + f" AS b{s}"
    for s, to in _TO.items()
)
_ONE_INSERT = ", ".join(_least(f"b{s}", _edit("I", "5", f"b{to}")) + f" AS i{s}" for s, to in _TO.items())
_TWO_INSERTS = ", ".join(_least(f"i{s}", _edit("I", "5", f"i{to}")) + f" AS q{s}" for s, to in _TO.items())

OP11 = rf"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k
  FROM conversations
), fated AS (SELECT *, {_CRC32} % 20 AS fate FROM keyed),
hurt AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
    CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE fate WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM fated
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, left(text, 64), sha256(text), copy) AS i, left(role, 1) AS g,
    NOT regexp_matches(text, '[^ 	-]') AS empty, NOT regexp_matches(text, '[.!?][ 	-]*\z') AS cut
  FROM hurt
), r AS (
  SELECT *, CASE WHEN empty THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate' WHEN cut THEN 'truncated' ELSE '' END AS fault,
    lag(g) OVER (PARTITION BY conv_id ORDER BY i) || g AS pair
  FROM numbered
), told AS (
  SELECT conv_id, max(i) AS n, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (i > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal,
    coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps
  FROM r GROUP BY conv_id
), best(conv_id, i, q0, q1, q2, q3) AS (
  SELECT conv_id, n, {{'c': 0::BIGINT, 'a': ''}}, {{'c': 10::BIGINT, 'a': 'II'}}, {{'c': 5::BIGINT, 'a': 'I'}}, {{'c': 0::BIGINT, 'a': ''}} FROM told
  UNION ALL
  SELECT conv_id, i, {_TWO_INSERTS} FROM (
    SELECT conv_id, i, {_ONE_INSERT} FROM (
      SELECT conv_id, i, {_ROW_EDITS} FROM (
        SELECT b.conv_id, b.i - 1 AS i, q0, q1, q2, q3, g, fault, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END AS late
        FROM best b JOIN r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.i = b.i
      )
    )
  )
), audits AS (SELECT conv_id, q0.c AS cost, q0.a AS audit FROM best WHERE i = 0),
edits AS (
  SELECT conv_id, k, audit[k] AS e, k - len(replace(left(audit, k), 'I', '')) AS added, k - len(replace(left(audit, k), 'D', '')) AS dropped
  FROM (SELECT *, unnest(range(1, len(audit) + 1)) AS k FROM audits)
), lines AS (
  SELECT e.conv_id, e.k, e.e, e.k - e.dropped AS place, r.role, r.g, r.text
  FROM edits e LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM e.conv_id AND r.i = e.k - e.added AND e.e <> 'I' WHERE e.e <> 'D'
), headed AS (
  SELECT *, max(CASE WHEN place = 1 AND e = 'K' AND g = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS headed FROM lines
), fixed AS (
  SELECT conv_id, sha256(string_agg((CASE WHEN e = 'K' THEN role WHEN (place - headed) % 2 = 1 THEN 'user' ELSE 'assistant' END) || ':' || (CASE WHEN e = 'I' THEN '' ELSE text END), chr(10) ORDER BY k)) AS h
  FROM headed GROUP BY conv_id
)
SELECT c.conv_id, coalesce(t.gaps, 0)::BIGINT AS gaps, coalesce(t.blank, 0)::BIGINT AS blank, coalesce(t.duplicate, 0)::BIGINT AS duplicate,
  coalesce(t.truncated, 0)::BIGINT AS truncated, coalesce(t.illegal, 0)::BIGINT AS illegal, coalesce(a.cost, 0)::BIGINT AS cost,
  coalesce(a.audit, '') AS audit, coalesce(f.h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN told t ON t.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN audits a ON a.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN fixed f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
"""

OP12 = """
WITH v AS (
  SELECT row_number() OVER () AS k, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.k AS ak, a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, b.k, list_dot_product(a.e, b.e)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.k <> b.k AND len(a.e) = len(b.e)
), positives AS (
  SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY ak ORDER BY score DESC, vec_id, k) <= 5
), negatives AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, row_number() OVER (PARTITION BY p.ak, p.k ORDER BY n.score DESC, n.vec_id, n.k) AS r,
    n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
  FROM positives p JOIN scored n ON n.ak = p.ak AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
)
SELECT anchor_id, positive_id, r::INTEGER AS rank, negative_id, positive_score, negative_score FROM negatives WHERE r <= 3
"""

SQL = {
    "op1_minhash_near_dedup": OP1,
    "op4_license_scan": OP4,
    "op6_embedding_near_dedup": OP6,
    "op8_benchmark_decontamination": OP8,
    "op10_chat_format": OP10,
    "op11_conversation_repair": OP11,
    "op12_hard_negatives": OP12,
}
