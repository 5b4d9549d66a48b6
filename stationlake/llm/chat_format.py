"""Chat formatting with rotated perspectives. DataFrame functions only.

For every participant of a conversation the whole dialogue is rendered with that
speaker as the assistant and all others as named users; system turns stay system
turns. ``spans`` are the [start, stop) character ranges that a loss would count:
the assistant's texts with their end marker.

A turn is ``<|assistant|>``, ``<|user name=NAME|>`` or ``<|system|>``, a newline,
the text, ``<|end|>`` and a newline. ``<|`` inside a text becomes ``< |``, so no
turn can forge a marker; runs of other characters than letters, digits, ``_``,
``.`` and ``-`` in a name become one ``_``.

A conversation of more than ``part_turns`` turns is rendered in parts of as many,
each a row of its own; in order of ``part`` they join to the whole dialogue, and
spans count from the part's start. Turns of long conversations are numbered by a
distributed rank, whatever their turn numbers are (repeated, null), so no group is
larger than a part.

Defined results: turns are in order of number (null first), then role, then text;
a null text is empty, a null role is ``unknown``; repeated turns are all rendered;
a null conv_id is a conversation; one without any speaker gives no row; an empty
table gives an empty result. Only conv_id, turn, role and text are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import hinted, numbered, stored

PART_TURNS = 512
END = "<|end|>"

_SEGMENT = """transform(turns, t -> named_struct(
    'mine', t.role = perspective,
    'head', CASE WHEN t.role = perspective THEN '<|assistant|>\n' WHEN t.role = 'system' THEN '<|system|>\n'
            ELSE concat('<|user name=', regexp_replace(t.role, r'[^\\p{L}\\p{N}_.-]+', '_'), '|>\n') END,
    'body', concat(replace(t.text, '<|', '< |'), '<|end|>')))"""

_SPANS = """aggregate(segments, named_struct('at', 0, 'spans', CAST(array() AS ARRAY<STRUCT<start: INT, stop: INT>>)),
    (a, s) -> named_struct('at', a.at + length(s.head) + length(s.body) + 1,
        'spans', IF(s.mine, array_append(a.spans, named_struct('start', a.at + length(s.head),
                                                               'stop', a.at + length(s.head) + length(s.body))), a.spans)),
    a -> a.spans)"""


def rotate(turns: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """conv_id, perspective, part, n_turns, text, spans: a row for each participant and part."""
    t = turns.select("conv_id", "turn", F.coalesce("role", F.lit("unknown")).alias("role"),
                     F.coalesce("text", F.lit("")).alias("text"))
    long = hinted(stored(t.groupBy(F.col("conv_id").alias("_long")).agg(F.count(F.lit(1)).alias("n"))
                         .where(F.col("n") > part_turns).select("_long"), "chat-long"))
    is_long = F.col("conv_id").eqNullSafe(F.col("_long"))
    ranked = numbered(t.join(long, is_long, "left_semi"), ["conv_id"], ["turn", "role", "text"], "chat-order")
    placed = (t.join(long, is_long, "left_anti").withColumn("part", F.lit(0).cast("bigint"))
              .unionByName(ranked.withColumn("part", F.floor(F.col("nth") / part_turns).cast("bigint")).drop("nth")))
    parts = (placed.groupBy("conv_id", "part")
             .agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")))
    speakers = t.where("role <> 'system'").select(F.col("conv_id").alias("_c"), F.col("role").alias("perspective")).distinct()
    seen = (parts.join(speakers, F.col("conv_id").eqNullSafe(F.col("_c")))
            .select("conv_id", "part", "turns", "perspective")
            .withColumn("segments", F.expr(_SEGMENT)))
    return seen.select("conv_id", "perspective", "part", F.size("turns").alias("n_turns"),
                       F.expr("concat_ws('', transform(segments, s -> concat(s.head, s.body, '\n')))").alias("text"),
                       F.expr(_SPANS).alias("spans"))


#: The digest columns in DuckDB, over ``conversations``.
ORACLE = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text,
         CAST((row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'), coalesce(text, ''))
               - 1) // 512 AS BIGINT) AS part
  FROM conversations),
s AS (SELECT DISTINCT conv_id, role AS perspective FROM t WHERE role <> 'system'),
g AS (
  SELECT t.conv_id, s.perspective, t.part, t.turn, t.role, t.text, t.role = s.perspective AS mine,
         CASE WHEN t.role = s.perspective THEN '<|assistant|>' || chr(10)
              WHEN t.role = 'system' THEN '<|system|>' || chr(10)
              ELSE '<|user name=' || regexp_replace(t.role, '[^\p{L}\p{N}_.-]+', '_', 'g') || '|>' || chr(10) END AS head,
         replace(t.text, '<|', '< |') || '<|end|>' AS body
  FROM t JOIN s ON t.conv_id IS NOT DISTINCT FROM s.conv_id),
o AS (
  SELECT *, coalesce(sum(length(head) + length(body) + 1) OVER (
           PARTITION BY conv_id, perspective, part ORDER BY turn NULLS FIRST, role, text
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off
  FROM g)
SELECT conv_id, perspective, part, count(*) AS n_turns,
       CAST(sum(length(head) + length(body) + 1) AS BIGINT) AS n_chars,
       CAST(coalesce(sum(length(body)) FILTER (WHERE mine), 0) AS BIGINT) AS n_target_chars,
       sha256(string_agg(head || body || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS text_sha256,
       coalesce(string_agg(CAST(CAST(off + length(head) AS BIGINT) AS VARCHAR) || '-'
                           || CAST(CAST(off + length(head) + length(body) AS BIGINT) AS VARCHAR), ',' ORDER BY off)
                FILTER (WHERE mine), '') AS spans
FROM o GROUP BY conv_id, perspective, part
"""
