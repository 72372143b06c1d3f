"""DuckDB SQL of the llm queries that SQL can express on whole tables.

Op 6 compares every window of words with every window of the benchmark, op 8
every pair of lines that share a shingle, op 10 formats conversation by
conversation, op 11 scores all pairs, op 13 folds rows one by one over four
states; none of them follows the operators' methods.  The others need
functions that SQL lacks (XXH64, CRC32, learned models, a tokenizer, a
packing) and are held against brute force in tests.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}

_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE["op6_decontamination"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS}, []) AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item, array_to_string(w[i:i + 12], ' ') AS win, least(13, len(w)) AS size
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0) t),
sizes AS (SELECT DISTINCT size FROM item_windows),
doc_windows AS (
  SELECT r, i, size, array_to_string(w[i:i + size - 1], ' ') AS win
  FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size) t),
hits AS (SELECT r, i, w.size, item FROM doc_windows w JOIN item_windows USING (win, size)),
covered AS (SELECT r, count(DISTINCT word) AS n_hit
            FROM (SELECT r, unnest(range(i, i + size)) AS word FROM (SELECT DISTINCT r, i, size FROM hits) h) c GROUP BY r),
found AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM hits) f GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN found USING (r)"""

ORACLE["op8_line_dedup"] = f"""
WITH l AS (
  SELECT doc_id, i - 1 AS line, lines[i] AS text
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents) s) t),
w AS (SELECT doc_id, line, {_WORDS} AS w FROM l),
sets AS (
  SELECT doc_id, line, list_sort(list_distinct(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ') || '/' || len(w)]
         ELSE list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' ')) END)) AS s
  FROM w WHERE len(w) > 0),
classes AS (SELECT s, min(doc_id * 1000000 + line) AS first, row_number() OVER () AS c FROM sets GROUP BY s),
tokens AS (SELECT c, first, len(s) AS n, unnest(s) AS t FROM classes),
shared AS (SELECT t FROM tokens GROUP BY t HAVING count(*) > 1),
live AS (SELECT * FROM tokens SEMI JOIN shared USING (t)),
matched AS (
  SELECT DISTINCT c FROM (
    SELECT b.c, a.c AS other, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS common
    FROM live a JOIN live b ON a.t = b.t AND a.first < b.first GROUP BY b.c, a.c) p
  WHERE 9 * common >= 4 * (na + nb)),
gone AS (
  SELECT doc_id, line FROM sets JOIN classes USING (s) LEFT JOIN (SELECT c, true AS hit FROM matched) m USING (c)
  WHERE coalesce(hit, false) OR doc_id * 1000000 + line <> first)
SELECT d.doc_id, CAST(coalesce(len(g.lines), 0) AS INTEGER) AS n_removed,
       coalesce(array_to_string(g.lines, ','), '') AS removed_lines,
       coalesce(k.text, CASE WHEN g.lines IS NULL THEN d.text ELSE '' END) AS text
FROM documents d
LEFT JOIN (SELECT doc_id, list(line ORDER BY line) AS lines FROM gone GROUP BY doc_id) g USING (doc_id)
LEFT JOIN (SELECT doc_id, string_agg(text, chr(10) ORDER BY line) AS text FROM l ANTI JOIN gone USING (doc_id, line) GROUP BY doc_id) k
  USING (doc_id)"""

_MARKS = "</s>[INST] ok [/INST]"
_ESCAPE = (r"regexp_replace(replace({}, '\', '\\'), '([<\[])(\||/?s>|/?INST\]|<?/?SYS>)', '\1\\\2', 'g')")
ORACLE["op10_chat"] = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{_MARKS}' UNION ALL SELECT -7, 1, 'assistant', '{_MARKS}')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(23 + length({_ESCAPE.format('role')}) + length({_ESCAPE.format('text')})) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id"""

ORACLE["op11_negatives"] = """
WITH u AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM u a JOIN u b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, id, score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.id AS positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, n.id AS negative_id,
       p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score
WINDOW w AS (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id)
QUALIFY row_number() OVER w <= 5"""


def _turn(state: str, cost: str, letter: str, line: str) -> str:
    """A parse state after one more edit; null stays null."""
    return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': {state}.a || {letter}, 'o': {state}.o || {line}}} END"


def _insert(state: str, role: str) -> str:
    return _turn(state, "3", "'I'", f"chr(10) || '{role}:'")


def _row(state: str, symbol: str, role: str) -> str:
    """Keep or rerole the row as ``symbol``."""
    fits = f"initial = '{symbol}'"
    moved = _turn(state, f"(CASE WHEN {fits} THEN 0 ELSE 3 END + CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END)", f"CASE WHEN {fits} THEN 'K' ELSE 'R' END",
                  f"chr(10) || CASE WHEN {fits} THEN role ELSE '{role}' END || ':' || text")
    allowed = "coalesce(fault, '') NOT IN ('blank', 'duplicate')" + ("" if role else f" AND {fits}")
    return f"CASE WHEN {allowed} THEN {moved} END"


def _drop(state: str) -> str:
    return _turn(state, "4", "'D'", "''")


# States: 0 nothing, 1 a system turn, 2 after a user, 3 after an assistant.  op13's order and edits, one row at a time.
ORACLE["op13_repair"] = f"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), '') AS key FROM conversations),
fates AS (
  SELECT conv_id, turn, role, text,
         xor(list_reduce([CAST(4294967295 AS BIGINT)] || flatten(list_transform(key, lambda k: [CAST(ascii(k) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
                         lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, (c & 1) * 3988292384) END), 4294967295) % 20 AS fate FROM given),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
         CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN fate = 3 THEN 2 ELSE 1 END)) AS copy
  FROM fates WHERE fate <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i, left(role, 1) AS initial,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM damaged),
r AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                 WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair FROM placed),
fold AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, {{'c': CAST(0 AS BIGINT), 'a': '', 'o': ''}} AS p0, CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, o VARCHAR)) AS p1,
         CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, o VARCHAR)) AS p2, CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, o VARCHAR)) AS p3
  FROM (SELECT DISTINCT conv_id FROM r) c
  UNION ALL
  SELECT conv_id, i, {_drop('q0')}, list_min([{_drop('q1')}, {_row('q0', 's', '')}]),
         list_min([{_drop('q2')}, {_row('q0', 'u', 'user')}, {_row('q1', 'u', 'user')}, {_row('q3', 'u', 'user')}]),
         list_min([{_drop('q3')}, {_row('q2', 'a', 'assistant')}])
  FROM (SELECT x.*, r.i, r.role, r.text, r.initial, r.fault
        FROM (SELECT conv_id, i AS done, p0 AS q0, p1 AS q1, q2, list_min([p3, {_insert('q2', 'assistant')}]) AS q3
              FROM (SELECT *, list_min([p2, {_insert('p0', 'user')}, {_insert('p1', 'user')}, {_insert('p3', 'user')}]) AS q2 FROM fold) y) x
        JOIN r ON r.conv_id IS NOT DISTINCT FROM x.conv_id AND r.i = x.done + 1) z),
ended AS (
  SELECT conv_id, list_min([p0, p3, {_insert('q2', 'assistant')}]) AS best
  FROM (SELECT *, list_min([p2, {_insert('p0', 'user')}, {_insert('p1', 'user')}]) AS q2 FROM fold
        QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1) e),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
         count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id)
SELECT g.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost,
       coalesce(best.a, '') AS audit, sha256(coalesce(substr(best.o, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) g
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM g.conv_id LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM g.conv_id"""
