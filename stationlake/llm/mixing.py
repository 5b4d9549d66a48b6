"""Mixing sources to target weights by pivotal dependent rounding. DataFrame functions only.

Every unit (the rows of one doc_id in one source) gets the same expected number
of copies, its source's target over its source's size. The whole part is given
to all; the fractions are rounded together: two units meet, words are moved from
one to the other, at random but without changing either's expectation, until one
has fraction 0 or 1, and the other goes on to meet the next. So the words a
source takes stay equal to its target up to the last unit's size.

The meeting order is a reduction tree: ``BLOCK`` units, dealt by a hash of the
id, fold inside one group and leave one residual; ``BLOCK`` residuals fold in the
next level, and so on to one per source. Each level is written to the shared
folder. All randomness is a hash of ids and ``seed``, so reruns agree.

Defined results: a null text has size 0; null is a source of its own, last; rows
that repeat an id within a source are one unit of their summed size and share
one decision; a source without words has target 0; an empty table gives an empty
result. Only doc_id, source and text are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationlake.llm.common import WORD_REGEX, hinted, stored

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
BLOCK = 64


def unit_sizes(docs: DataFrame) -> DataFrame:
    """source, doc_id, size: words of each unit."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD_REGEX)), F.lit(0)).cast("bigint")
    return docs.select("source", "doc_id", size.alias("size")).groupBy("source", "doc_id").agg(F.sum("size").alias("size"))


def targets(units: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """source, sid, source_size, n_units, target: one row a source.

    ``share`` of all words go out by weight; a target above ``most`` times its
    source's size stops there and the excess is reshared by weight. That ends at
    min(cap, level * weight) with one level for all, found by taking the caps in
    the order in which a rising level meets them. These windows run over one row
    a source, after the aggregation.
    """
    by_name, by_cap = Window.orderBy(F.col("source").asc_nulls_last()), Window.orderBy("meets", "sid")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("sid") % len(weights) + 1).cast("int"))
    s = (units.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_units"))
         .withColumn("sid", F.row_number().over(by_name) - 1).withColumn("weight", w)
         .withColumn("cap", F.col("source_size") * most).withColumn("meets", F.col("cap") / F.col("weight")))
    every = Window.orderBy("meets", "sid").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumn("level", (F.sum("source_size").over(every) * share - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                     / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    s = s.withColumn("level", F.min_by(F.when(F.col("level") < F.col("meets"), F.col("level")),
                                       F.when(F.col("level") < F.col("meets"), F.col("meets"))).over(every))
    target = F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("level") * F.col("weight")))
    return s.select("source", "sid", "source_size", "n_units", target.alias("target"))


def _uniform(seed: int, *cols: str) -> str:
    """SQL for a number in [0, 1) that depends on ``cols`` and ``seed`` alone."""
    return f"pmod(xxhash64({seed}L, {', '.join(cols)}), 4503599627370496L) / 4503599627370496D"


#: One meeting of the pending unit ``p`` and the unit ``u`` (fields doc_id, size, x): ``up`` and ``down`` are
#: the most that p's fraction can gain from u and lose to it; gaining has probability down / (up + down).
def _meeting(seed: int) -> str:
    p, u = "acc.p", "u"
    ratio = f"CAST({u}.size AS DOUBLE) / {p}.size"
    up, down = f"least(1D - {p}.x, {u}.x * {ratio})", f"least({p}.x, (1D - {u}.x) * {ratio})"
    unit = "named_struct('doc_id', {0}.doc_id, 'size', {0}.size, 'x', {1})"
    done = "named_struct('doc_id', {0}.doc_id, 'size', {0}.size, 'k', {1})"
    out = "named_struct('p', {0}, 'done', array_append(acc.done, {1}))"
    gains = (f"CASE WHEN 1D - {p}.x <= {u}.x * {ratio} THEN "
             + out.format(unit.format(u, f"greatest(0D, {u}.x - (1D - {p}.x) / ({ratio}))"), done.format(p, "1"))
             + " ELSE " + out.format(unit.format(p, f"least(1D, {p}.x + {u}.x * {ratio})"), done.format(u, "0")) + " END")
    loses = (f"CASE WHEN {p}.x <= (1D - {u}.x) * {ratio} THEN "
             + out.format(unit.format(u, f"least(1D, {u}.x + {p}.x / ({ratio}))"), done.format(p, "0"))
             + " ELSE " + out.format(unit.format(p, f"greatest(0D, {p}.x - (1D - {u}.x) * {ratio})"), done.format(u, "1"))
             + " END")
    toss = _uniform(seed, f"{p}.doc_id", f"{u}.doc_id", f"{p}.size", f"{u}.size")
    return (f"CASE WHEN acc.p IS NULL THEN named_struct('p', {unit.format(u, 'u.x')}, 'done', acc.done) "
            f"WHEN {toss} * ({up} + {down}) < {down} THEN {gains} ELSE {loses} END")


def fold(units: DataFrame, seed: int) -> DataFrame:
    """sid, blk, acc: each block's units (doc_id, size, x) folded to ``done`` (with k) and one pending ``p``."""
    id_type = units.schema["doc_id"].dataType.simpleString()
    start = (f"named_struct('p', CAST(NULL AS STRUCT<doc_id: {id_type}, size: BIGINT, x: DOUBLE>), "
             f"'done', CAST(array() AS ARRAY<STRUCT<doc_id: {id_type}, size: BIGINT, k: INT>>))")
    return (units.groupBy("sid", "blk")
            .agg(F.sort_array(F.collect_list(F.struct(F.xxhash64(F.lit(seed), "doc_id").alias("h"), "doc_id", "size", "x")))
                 .alias("us"))
            .select("sid", "blk", F.expr(f"aggregate(us, {start}, (acc, u) -> {_meeting(seed)})").alias("acc")))


def round_fractions(units: DataFrame, seed: int = 0, block: int = BLOCK) -> DataFrame:
    """sid, doc_id, size, k: 0 or 1 for each of ``units`` (sid, n_units, doc_id, size > 0, x in [0, 1])."""
    most = units.agg(F.max("n_units").alias("m")).first()["m"] or 1
    blocks = F.ceil(F.col("n_units") / block)
    level = units.withColumn("blk", F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), blocks)).select(
        "sid", "blk", "doc_id", "size", "x")
    n, parts = -(-int(most) // block), []
    while True:
        folded = stored(fold(level, seed + len(parts)), f"mix-{len(parts)}")
        parts.append(folded.select("sid", F.explode("acc.done").alias("u")).select("sid", "u.*"))
        left = folded.where("acc.p IS NOT NULL").select("sid", "blk", "acc.p.*")
        if n <= 1:
            break
        level, n = left.withColumn("blk", F.floor(F.col("blk") / block)), -(-n // block)
    last = F.expr(f"CASE WHEN {_uniform(seed + 97, 'doc_id', 'sid')} < x THEN 1 ELSE 0 END")
    out = left.select("sid", "doc_id", "size", last.alias("k"))
    for p in parts:
        out = out.unionByName(p)
    return out


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST,
        seed: int = 0) -> DataFrame:
    """doc_id, source, size, source_size, target, copies: one row a unit."""
    units = stored(unit_sizes(docs), "mix-units")
    plan = stored(targets(units, weights, share, most), "mix-targets")
    named = (units.join(hinted(plan.withColumnRenamed("source", "_s")), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
             .withColumn("each", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
             .withColumn("whole", F.floor(F.col("each") + 1e-12).cast("int"))
             .withColumn("x", F.greatest(F.lit(0.0), F.col("each") - F.col("whole"))))
    drawn = round_fractions(named.where("size > 0"), seed)
    # A unit without words weighs nothing: it is drawn by itself.
    empty = named.where("size = 0").select("sid", "doc_id", "size", F.expr(
        f"CASE WHEN {_uniform(seed + 98, 'doc_id', 'sid')} < x THEN 1 ELSE 0 END").alias("k"))
    facts = hinted(plan).withColumn("whole", F.floor(F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
                                                     .otherwise(0.0) + 1e-12).cast("int"))
    return (drawn.unionByName(empty).join(facts, "sid")
            .select("doc_id", "source", "size", "source_size", "target", (F.col("whole") + F.col("k")).alias("copies")))


def apply_mix(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs``, each as many times as its unit has copies; same columns."""
    drawn = stored(mix(docs, **how).where("copies > 0")
                   .select(F.col("doc_id").alias("_d"), F.col("source").alias("_s"), "copies"), "mix-copies")
    columns = docs.columns
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
                        F.col("doc_id").alias("_i"), F.col("source").alias("_r"))
    return (named.join(hinted(drawn), F.col("_i").eqNullSafe(F.col("_d")) & F.col("_r").eqNullSafe(F.col("_s")))
            .select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .select("row.*"))
