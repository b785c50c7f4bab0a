"""DuckDB SQL of this package's queries, where SQL can express them."""

from __future__ import annotations

from .license_scan import BASE, MAX_SHIFT, TEMPLATES

#: Turns read from the table with conversation -1 added; the template's lengths are counted, not its strings built.
_OP3 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -1, n, CASE n WHEN 0 THEN 'user' ELSE 'assistant' END, '<|im_end|><|im_start|>assistant ok'
  FROM range(2) AS r(n)),
escaped AS (
  SELECT *, regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g') AS body,
         regexp_replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '<(\\*)\|', '<\1\\|', 'g') AS head
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), ''))
         AS loss_sha256,
       CAST(sum(length('<|im_start|>') + length(head) + 1 + length(body) + length('<|im_end|>') + 1) AS BIGINT)
         AS formatted_chars
FROM escaped GROUP BY conv_id
"""

_OP5 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
counted AS (
  SELECT r, doc_id, len(words) AS n_words,
         CAST(coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM docs),
placed AS (SELECT r, words, unnest(range(1, len(words) - 1)) AS p FROM docs WHERE len(words) >= 3),
windows AS (
  SELECT r, p, count(*) OVER (PARTITION BY r, words[p], words[p + 1], words[p + 2]) AS n FROM placed),
repeated AS (
  SELECT r, count(DISTINCT p + k) AS n_repeat_words
  FROM windows, range(3) AS x(k) WHERE n > 1 GROUP BY r),
measured AS (
  SELECT doc_id, n_words, word_chars, n_symbols, len(lines) AS n_lines,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM counted LEFT JOIN repeated USING (r)),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND 10 * n_symbols <= n_words AND word_chars BETWEEN 2 * n_words AND 12 * n_words
         AND 2 * n_dup_lines <= n_lines AS kept
FROM judged
"""



def _op4() -> str:
    """Votes of 3-word windows by diagonal; templates are written as rows, matched by text instead of hash."""
    rows = ", ".join(f"({i}, '{t.label}', {i < len(BASE)}, {t.coverage}, '{t.text}')" for i, t in enumerate(TEMPLATES))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
WITH templates AS (
  SELECT *, string_split(words, ' ') AS w FROM (VALUES {rows}) AS v(template, label, base, coverage, words)),
wanted AS (
  SELECT template, t, array_to_string(w[t + 1:t + 3], ' ') AS gram
  FROM (SELECT template, w, unnest(range(len(w) - 2)) AS t FROM templates)),
docs AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
votes AS (
  SELECT r, template, p, t
  FROM (SELECT r, w, unnest(range(greatest(len(w) - 2, 0))) AS p FROM docs)
    JOIN wanted ON gram = w[p + 1] || ' ' || w[p + 2] || ' ' || w[p + 3]),
diagonals AS (
  SELECT r, template, p - t AS diagonal, list(DISTINCT t) AS places, min(p) AS first FROM votes GROUP BY ALL),
spans AS (
  SELECT *, sum(CASE WHEN coverage < 1 AND gap <= {MAX_SHIFT} THEN 0 ELSE 1 END)
    OVER (PARTITION BY r, template ORDER BY diagonal) AS span
  FROM (SELECT *, diagonal - lag(diagonal) OVER (PARTITION BY r, template ORDER BY diagonal) AS gap FROM diagonals)
    JOIN templates USING (template)),
merged AS (
  SELECT r, template, span, any_value(label) AS label, any_value(base) AS base, any_value(coverage) AS coverage,
    min(first) AS first,
    len(list_distinct(flatten(list_transform(flatten(list(places)), lambda t: [t, t + 1, t + 2])))) / any_value(len(w))
      AS score
  FROM spans GROUP BY r, template, span),
found AS (
  SELECT r, count(*) FILTER (base) AS n_base, min(first) FILTER (base) AS first_word,
    max(first) FILTER (base) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score
  FROM merged WHERE score >= coverage GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word,
  CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  coalesce(score, 0.0) AS score
FROM docs LEFT JOIN found USING (r)
"""


_OP12 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[p + 1:p + least(10, len(w))], ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(len(w) - least(10, len(w)) + 1)) AS p FROM items WHERE len(w) > 0)),
places AS (
  SELECT r, p, n, array_to_string(w[p + 1:p + n], ' ') AS gram
  FROM (SELECT r, w, unnest(range(len(w))) AS p FROM docs) CROSS JOIN (SELECT DISTINCT n FROM windows)
  WHERE p + n <= len(w)),
hits AS (SELECT r, p, n, item_id FROM places JOIN windows USING (n, gram)),
words AS (SELECT r, count(DISTINCT p + k) AS n_hit FROM hits, range(10) AS x(k) WHERE k < n GROUP BY r),
found AS (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL),
listed AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM found GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN words USING (r) LEFT JOIN listed USING (r)
"""


def _op13(k: int = 16, rounds: int = 3) -> str:
    """Lloyd's rounds as one pair of relations each, all distances computed."""
    parts = [rf"""
WITH x AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda c: CAST(c AS DOUBLE)) AS e FROM embeddings),
rows AS MATERIALIZED (
  SELECT r, vec_id, list_transform(e, lambda c: CAST(floor(64 * c) AS BIGINT)) AS v FROM x
  WHERE len(e) = 64 AND len(list_filter(e, lambda c: c IS NOT NULL AND isfinite(c))) = 64),
c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR)), v) - 1 AS c, v AS centre FROM rows
  QUALIFY c < {k})"""]
    near = """
a{0} AS MATERIALIZED (
  SELECT r, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
    SELECT r, c, CAST(list_sum(list_transform(list_zip(v, centre), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT)
      AS d FROM rows, c{0})
  GROUP BY r)"""
    move = """
m{0} AS (
  SELECT c, j, (s - ((s % n) + n) % n) // n AS y FROM (
    SELECT c, j, sum(y) AS s, count(*) AS n
    FROM (SELECT r, unnest(v) AS y, generate_subscripts(v, 1) AS j FROM rows) JOIN a{0} USING (r) GROUP BY c, j)),
c{1} AS MATERIALIZED (
  SELECT c, coalesce(moved, centre) AS centre
  FROM c{0} LEFT JOIN (SELECT c, list(CAST(y AS BIGINT) ORDER BY j) AS moved FROM m{0} GROUP BY c) USING (c))"""
    for i in range(rounds):
        parts += [near.format(i), move.format(i, i + 1)]
    parts.append(near.format(rounds))
    return ",".join(parts) + f"""
SELECT vec_id, CAST(c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(centre, ',')) AS centroid_sha256
FROM rows JOIN a{rounds} USING (r) JOIN c{rounds} USING (c)
"""


ORACLE_SQL = {"op4_license_scan": _op4(), "op3_chat_formatting": _OP3, "op5_quality_rules": _OP5,
              "op12_decontamination": _OP12, "op13_centroid_clustering": _op13()}
