"""DuckDB SQL for the queries that SQL can express on whole tables."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _components(links: str, nodes: str) -> str:
    """CTEs ``ways`` and ``smallest`` (id, component) from ``links`` (a, b) over ``nodes`` (id)."""
    return f"""
ways AS (SELECT a, b FROM {links} UNION ALL SELECT b, a FROM {links}),
reach(id, c) AS (SELECT id, id FROM {nodes} UNION SELECT ways.b, reach.c FROM reach JOIN ways ON ways.a = reach.id),
smallest AS (SELECT id, MIN(c) AS component FROM reach GROUP BY id)"""


def quality(limits) -> str:
    """Counts and verdicts of the quality rules."""
    lengths = sorted({3, *(n for n, _ in limits.ngrams)})
    grams = "".join(f""",
g{n} AS (
  SELECT doc_id, unnest(range(i, i + {n})) AS j FROM (
    SELECT doc_id, i, COUNT(*) OVER (PARTITION BY doc_id, gram) AS times FROM (
      SELECT doc_id, i, array_to_string(ws[i:i + {n - 1}], ' ') AS gram
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {n - 2})) AS i FROM texts WHERE len(ws) >= {n})))
  WHERE times > 1),
c{n} AS (SELECT doc_id, COUNT(*) AS n, SUM(size) AS chars FROM (SELECT DISTINCT doc_id, j FROM g{n}) JOIN words USING (doc_id, j) GROUP BY doc_id)""" for n in lengths)
    joins = " ".join(f"LEFT JOIN c{n} USING (doc_id)" for n in lengths)
    over = " OR ".join([f"COALESCE(c{n}.chars, 0) > {share} * COALESCE(sizes.chars, 0)" for n, share in limits.ngrams]
                       + [f"COALESCE(line_chars, 0) > {limits.lines} * COALESCE(sizes.chars, 0)", f"symbols > {limits.symbols} * len(ws)"])
    return rf"""
WITH texts AS (
  SELECT doc_id, COALESCE(text, '') AS text, regexp_extract_all(COALESCE(text, ''), '{_WORD}') AS ws,
         length(regexp_replace(COALESCE(text, ''), '[^#*$%&|<>]', '', 'g')) AS symbols FROM documents),
words AS (SELECT doc_id, j, length(ws[j]) AS size FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS j FROM texts)),
sizes AS (SELECT doc_id, SUM(size) AS chars FROM words GROUP BY doc_id),
lines AS (
  SELECT doc_id, length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS size, row_number() OVER (PARTITION BY doc_id, line) AS k
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM texts) WHERE regexp_matches(line, '{_WORD}')),
again AS (SELECT doc_id, COUNT(*) AS n, SUM(size) AS line_chars FROM lines WHERE k > 1 GROUP BY doc_id){grams},
counts AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(COALESCE(sizes.chars, 0) AS BIGINT) AS word_chars,
         CAST(symbols AS BIGINT) AS n_symbols, CAST(COALESCE(again.n, 0) AS BIGINT) AS n_dup_lines,
         CAST(COALESCE(c3.n, 0) AS BIGINT) AS n_repeat_words, {over} AS over_limit
  FROM texts LEFT JOIN sizes USING (doc_id) LEFT JOIN again USING (doc_id) {joins})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {limits.min_words} OR 100 * n_repeat_words > {round(100 * limits.repeat_words)} * n_words AS base_failed,
       NOT (n_words < {limits.min_words} OR 100 * n_repeat_words > {round(100 * limits.repeat_words)} * n_words OR over_limit) AS kept
FROM counts"""


def jaccard(n: int, percent: int) -> str:
    """Components of documents by Jaccard similarity of their word n-grams."""
    return f"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}') AS ws FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) <= {n} THEN [array_to_string(ws, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(ws) - {n - 2}), lambda i: array_to_string(ws[i:i + {n - 1}], ' '))) END AS s
  FROM texts),
grams AS (SELECT doc_id, len(s) AS size, unnest(s) AS g FROM sets),
links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id < y.doc_id
  GROUP BY x.doc_id, y.doc_id, x.size, y.size HAVING 100 * COUNT(*) >= {percent} * (x.size + y.size - COUNT(*))),
nodes AS (SELECT doc_id AS id FROM documents),{_components('links', 'nodes')}
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component AS component_id FROM sets JOIN smallest ON smallest.id = sets.doc_id"""


CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS t FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
sized AS (
  SELECT *, length(t) + length(t) - length(replace(replace(replace(t, '\', ''), '<', ''), '#', '')) AS escaped,
         length(role) + length(role) - length(replace(replace(replace(replace(role, '\', ''), '<', ''), '#', ''), chr(10), '')) AS role_size
  FROM turns)
SELECT conv_id, CAST(COUNT(*) AS BIGINT) AS n_turns, sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn, role, t)) AS turns_sha256,
       CAST(SUM(CASE WHEN role = 'assistant' THEN length(t) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN t ELSE '' END, '' ORDER BY turn, role, t)) AS loss_sha256,
       CAST(SUM(4 + role_size + 2 + escaped + 8) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id"""

def ranked_search(k: int) -> str:
    """The k best documents of each benchmark item."""
    terms = rf"regexp_extract_all(translate(COALESCE(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return f"""
WITH docs AS (SELECT doc_id, {terms} AS ts FROM documents),
sizes AS (SELECT doc_id, CAST(len(ts) AS BIGINT) AS n FROM docs),
totals AS (SELECT CAST(COUNT(*) FILTER (n > 0) AS BIGINT) AS docs_n, CAST(SUM(n) AS BIGINT) AS terms_n FROM sizes),
asked AS (SELECT DISTINCT item_id, unnest({terms}) AS t FROM benchmark),
held AS (SELECT doc_id, t, COUNT(*) AS tf FROM (SELECT doc_id, unnest(ts) AS t FROM docs) WHERE t IN (SELECT t FROM asked) GROUP BY doc_id, t),
weights AS (
  SELECT t, CAST(floor(1000 * ln((2 * docs_n + 2) / CAST(2 * COUNT(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM held, totals GROUP BY t, docs_n),
worth AS (
  SELECT doc_id, t, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs_n) // terms_n))) AS v
  FROM held JOIN sizes USING (doc_id) JOIN weights USING (t), totals),
scores AS (SELECT item_id, doc_id, CAST(SUM(v) AS BIGINT) AS score FROM asked JOIN worth USING (t) GROUP BY item_id, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM scores WHERE score > 0)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= {k}"""


EMBEDDINGS = f"""
WITH RECURSIVE good AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM good x JOIN good y ON x.vec_id < y.vec_id AND len(x.v) = len(y.v)
  WHERE list_cosine_similarity(x.v, y.v) >= 0.9),
nodes AS (SELECT vec_id AS id FROM embeddings),{_components('links', 'nodes')},
degree AS (SELECT a AS id, COUNT(*) AS n FROM ways GROUP BY a)
SELECT id AS vec_id, CAST(COALESCE(n, 0) AS BIGINT) AS n_links, component AS component_id, id = component AS kept
FROM smallest LEFT JOIN degree USING (id)"""
