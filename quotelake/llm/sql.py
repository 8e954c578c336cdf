"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _folded(text: str) -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{upper}', '{upper.lower()}'), '{_ALNUM}')"


OP2 = f"""
WITH RECURSIVE heads AS (
  SELECT text, min(doc_id) AS head, count(*) AS n_copies FROM documents WHERE text IS NOT NULL GROUP BY text),
listed AS (SELECT head, regexp_extract_all(text, '{_WORD}') AS words FROM heads),
shingles AS (
  SELECT DISTINCT head, array_to_string(words[p:p + 4], ' ') AS key
  FROM (SELECT head, words, unnest(range(1, greatest(len(words) - 3, 2))) AS p FROM listed WHERE len(words) > 0)),
sizes AS (SELECT head, count(*) AS n FROM shingles GROUP BY head),
common AS (
  SELECT a.head AS x, b.head AS y, count(*) AS n
  FROM shingles a JOIN shingles b ON a.key = b.key AND a.head < b.head GROUP BY ALL),
links AS (
  SELECT x, y FROM common JOIN sizes p ON p.head = x JOIN sizes q ON q.head = y
  WHERE 5 * common.n >= 4 * (p.n + q.n - common.n)),
ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached AS (
  SELECT head AS a, head AS b FROM heads
  UNION SELECT reached.a, ways.y FROM reached JOIN ways ON ways.x = reached.b),
classes AS (SELECT a AS head, min(b) AS class_id FROM reached GROUP BY a),
degrees AS (SELECT x AS head, count(*) AS n_links FROM ways GROUP BY x)
SELECT doc_id, class_id, head AS text_id, n_copies, coalesce(n_links, 0) AS n_links
FROM documents JOIN heads USING (text) JOIN classes USING (head) LEFT JOIN degrees USING (head)
UNION ALL SELECT doc_id, doc_id, doc_id, 1, 0 FROM documents WHERE text IS NULL"""

OP3 = f"""
WITH listed AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS words FROM documents),
windows AS (
  SELECT doc_id, p, array_to_string(words[p:p + 49], ' ') AS key
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS p FROM listed WHERE len(words) >= 50)),
firsts AS (SELECT key, min(doc_id) AS head FROM windows GROUP BY key),
gone AS (
  SELECT DISTINCT doc_id, p + k AS pos FROM windows JOIN firsts USING (key) CROSS JOIN range(0, 50) AS steps(k)
  WHERE head < doc_id),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id),
placed AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM listed),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS text
  FROM placed ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM listed LEFT JOIN lost USING (doc_id) LEFT JOIN kept USING (doc_id)"""

OP4 = f"""
WITH listed AS (SELECT doc_id, {_folded("text")} AS words FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_folded("text")} AS words FROM benchmark),
phrases AS (
  SELECT DISTINCT item, size, array_to_string(words[p:p + size - 1], ' ') AS key
  FROM (SELECT item, words, least(len(words), 10) AS size, unnest(range(1, greatest(len(words) - 8, 2))) AS p
        FROM items WHERE len(words) > 0)),
found AS (
  SELECT doc_id, p, spans.size, item
  FROM (SELECT doc_id, size, p, array_to_string(words[p:p + size - 1], ' ') AS key
        FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS p
              FROM listed CROSS JOIN (SELECT DISTINCT size FROM phrases) WHERE len(words) >= size)) AS spans
  JOIN phrases USING (size, key)),
hits AS (
  SELECT doc_id, count(DISTINCT p + k) AS n_hit FROM found CROSS JOIN range(0, 10) AS steps(k)
  WHERE k < size GROUP BY doc_id),
named AS (SELECT doc_id, list_sort(list(DISTINCT item)) AS names FROM found WHERE item IS NOT NULL GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(names), 0) AS n_items,
  sha256(coalesce(array_to_string(names, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM listed LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)"""

_MARK = " OR ".join(f"contains(text, '{mark}')" for mark in ("<P>", "<S>", "<M>"))
OP13 = f"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
    [CAST('0x' || substr(sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')), p, 8) AS BIGINT)
     FOR p IN [1, 9, 17, 25]] AS h
  FROM documents),
cuts AS (
  SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
    CASE WHEN n = 0 OR {_MARK} OR h[3] % 100 >= 90 THEN 'plain' WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
parts AS (
  SELECT *, substring(text, 1, a) AS prefix, substring(text, a + 1, b - a) AS middle, substring(text, b + 1) AS suffix
  FROM cuts)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts"""

_LINE_KEY = (r"translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),"
             " 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")
OP11 = rf"""
WITH listed AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
placed AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM listed),
keyed AS (SELECT doc_id, pos, line, {_LINE_KEY} AS key FROM placed),
common AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
judged AS (
  SELECT doc_id, pos, line, coalesce(doc_id <> last, FALSE) AS gone FROM keyed LEFT JOIN common USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""
