"""DuckDB SQL of the queries that SQL can express, over the same tables."""

from __future__ import annotations

from stationlake.llm import chat_format, decontaminate, turn_trie
from stationlake.llm.near_dedup import PERCENT
from stationlake.llm.quality_rules import (DUP_LINE_PERCENT, MAX_HOST_RATE, MIN_WORDS, REPEAT_PERCENT, REPEAT_WINDOW,
                                           SYMBOL_PERCENT)

TOPK = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM (SELECT * FROM e WHERE vec_id % 50 = 0) q JOIN e c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5
"""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

NEAR = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(ws, i, i + 4), ' ') AS shingle
  FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(1, len(ws) - 4))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS inter
  FROM sh a JOIN sh b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * inter >= {PERCENT} * (x.n + y.n - inter)),
both_ways AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (SELECT doc_id, doc_id AS other FROM n UNION SELECT r.doc_id, e.b FROM reach r JOIN both_ways e ON e.a = r.other),
c AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id,
       coalesce(c.component_id, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""

QUALITY = rf"""
WITH w AS (
  SELECT doc_id, source, {_WORDS} AS ws, coalesce(text, '') AS t,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(list_slice(ws, i, i + {REPEAT_WINDOW - 1}), ' ') AS body
  FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - {REPEAT_WINDOW - 1})) AS i FROM w WHERE len(ws) >= {REPEAT_WINDOW})),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, body) AS n FROM win) WHERE n > 1),
rep AS (
  SELECT doc_id, count(DISTINCT place) AS n
  FROM (SELECT doc_id, unnest(generate_series(i, i + {REPEAT_WINDOW - 1})) AS place FROM twice) GROUP BY 1),
m AS (
  SELECT w.doc_id, source, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         coalesce(rep.n, 0) AS n_repeat_words
  FROM w LEFT JOIN rep USING (doc_id)),
b AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed FROM m),
f AS (
  SELECT *, base_failed OR 100 * n_symbols > {SYMBOL_PERCENT} * word_chars
            OR 100 * n_dup_lines > {DUP_LINE_PERCENT} * n_lines AS failed FROM b),
h AS (SELECT source, count(*) AS n, count(*) FILTER (WHERE failed) AS k FROM f WHERE source IS NOT NULL GROUP BY 1),
g AS (SELECT sum(k) / sum(n) AS mean, var_pop(k / n) AS v, avg(1 / n) AS inv FROM h),
st AS (
  SELECT least(greatest(mean, 1e-9), 1 - 1e-9) AS mean,
         least(greatest(CASE WHEN v - mean * (1 - mean) * inv > 1e-12 AND mean > 0 AND mean < 1
                             THEN mean * (1 - mean) / (v - mean * (1 - mean) * inv) - 1 ELSE 1e9 END, 1e-3), 1e9) AS strength
  FROM g),
verdict AS (SELECT source, (k + mean * strength) / (n + strength) > {MAX_HOST_RATE} AS host_failed FROM h, st)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(host_failed, false) AS kept
FROM f LEFT JOIN verdict USING (source)
"""

ORACLE = {"op1_topk_search": TOPK, "op2_near_dedup": NEAR, "op3_chat_format": chat_format.ORACLE,
          "op4_quality_rules": QUALITY, "op12_decontaminate": decontaminate.ORACLE,
          "op13_turn_trie": turn_trie.ORACLE}
