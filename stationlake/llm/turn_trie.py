"""Prefix trie of conversations by truncation peeling.

A node of depth d is a distinct sequence of d turns (role, text) with which
conversations begin; the root has none. Turns are numbered by a distributed rank and
kept as 128-bit hashes; the hash of a prefix joins its turns' hashes with their places,
so the hashes of all prefixes come from a running xor, cut into blocks of ``BLOCK``
turns so that a long conversation is no single group.

Conversations of equal sequences are one unit. What a unit shares with no other, its
tail, is a chain of nodes with the unit's members alone and is written out at once. The
rest is peeled from the deepest shared turn up: a round takes the units that end their
shared part at this depth and the nodes that survived from below, regroups them by
their path, and adds up what they bring: members, children, leaves, saved code points.
Each group is a node. Its last turn is stripped; so are those above it that no other
unit joins, at once, as they form a chain of the same members; it comes back at the
depth where the next unit joins. So there is one round for each depth at which units
meet, not one for each turn, and every round writes its nodes once. A group is an
aggregate with map-side combination: a first turn that a third of all conversations
have costs a row a task.

Defined results: turns are in order of number (null first), then role, then text; null
role or text is empty; repeated turns all count; rows without a conv_id take no part; an
empty table has no node, not even a root. Only conv_id, turn, role and text are read.
A conversation id minus its remainder is rounded toward zero (``rebuilt``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stationlake.llm.common import numbered, small_batches, stored
from stationlake.session import table_path

#: Turns of a conversation that one window may hold.
BLOCK = 4096
#: Members of a unit up to which their ids are joined in one row; more are packed in runs of as many.
RUN = 100
_PATH = "array<struct<p1: bigint, p2: bigint, len: bigint, first: bigint, units: bigint>>"


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, nth (from 0), h1, h2 (the turn's hash), len (code points of its text)."""
    t = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    t = t.withColumns({"h1": F.xxhash64("role", "text"), "h2": F.xxhash64("text", F.lit(1), "role"),
                       "len": F.length("text").cast("bigint")})
    return stored(numbered(t, ["conv_id"], ["turn", "role", "text"], "trie-order", drop=["turn", "role", "text"])
                  .select("conv_id", "nth", "h1", "h2", "len"), "trie-turns")


def sequences(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations as they are: (conv_id, size) and (conv_id, depth, h1, h2, len)."""
    sizes = stored(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("size")), "trie-sizes")
    return sizes, turns.select("conv_id", (F.col("nth") + 1).alias("depth"), "h1", "h2", "len")


def rebuilt(turns: DataFrame, every: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """The same for conversation c's first h turns taken from conversation c - c % ``every`` (fewer if it has fewer, none if
    it is absent), then c's own behind its first h; h is crc32(c as text) % ``most``."""
    head = F.crc32(F.col("conv_id").cast("string")) % most
    own = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own")).withColumn("head", head)
    own = stored(own.withColumn("base", F.col("conv_id") - F.col("conv_id") % every), "trie-own")
    lent = own.select(F.col("conv_id").alias("base"), F.col("own").alias("lent"))
    convs = stored(own.join(lent, "base", "left").withColumn("taken", F.least("head", F.coalesce("lent", F.lit(0)))),
                   "trie-taken")
    sizes = convs.select("conv_id", (F.col("taken") + F.greatest(F.col("own") - F.col("head"), F.lit(0))).alias("size"))
    first = turns.where(F.col("nth") < most).select(F.col("conv_id").alias("base"), "nth", "h1", "h2", "len")
    heads = (convs.where("taken > 0").select("conv_id", "base", "taken").join(first, "base").where("nth < taken")
             .select("conv_id", (F.col("nth") + 1).alias("depth"), "h1", "h2", "len"))
    rest = (turns.join(convs.select("conv_id", "head", "taken"), "conv_id").where("nth >= head")
            .select("conv_id", (F.col("nth") - F.col("head") + F.col("taken") + 1).alias("depth"), "h1", "h2", "len"))
    return sizes, heads.unionByName(rest)


def prefixes(sizes: DataFrame, rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """conv_id, depth, p1, p2 (hash of the first ``depth`` turns), len, upto (code points of these turns)."""
    placed = rows.select("conv_id", "depth", F.xxhash64("depth", "h1", "h2").alias("x1"),
                         F.xxhash64("h2", "depth", "h1").alias("x2"), "len",
                         F.floor((F.col("depth") - 1) / block).alias("block"))
    longest = sizes.agg(F.max("size").alias("m")).first()["m"] or 0
    w = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    if longest > block:
        placed = stored(placed, "trie-placed")
    local = placed.select("conv_id", "block", "depth", F.bit_xor("x1").over(w).alias("p1"),
                          F.bit_xor("x2").over(w).alias("p2"), "len", F.sum("len").over(w).alias("upto"))
    if longest > block:  # the same hashes, from the blocks' own and the sum of those before
        above = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        totals = placed.groupBy("conv_id", "block").agg(F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"),
                                                        F.sum("len").alias("len"))
        zero = F.lit(0).cast("bigint")
        before = totals.select("conv_id", "block", F.coalesce(F.bit_xor("x1").over(above), zero).alias("b1"),
                               F.coalesce(F.bit_xor("x2").over(above), zero).alias("b2"),
                               F.coalesce(F.sum("len").over(above), zero).alias("b"))
        local = local.join(before, ["conv_id", "block"]).select(
            "conv_id", "depth", F.col("p1").bitwiseXOR(F.col("b1")).alias("p1"),
            F.col("p2").bitwiseXOR(F.col("b2")).alias("p2"), "len", (F.col("upto") + F.col("b")).alias("upto"))
    return stored(local.drop("block"), "trie-prefixes")


def member_digests(members: DataFrame, large: DataFrame, run: int = RUN) -> DataFrame:
    """size, p1, p2, ends: SHA-256 of the members' ids in ascending order, comma-joined, for the ``large`` units.

    Sorted runs of ids are packed over all tasks; the digest of one unit, one hash over all of its ids by
    definition, then streams over its packed runs in order.
    """
    unit = ["size", "p1", "p2"]
    small_batches(members.sparkSession)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, at = list(zip(*(b.column(i).to_pylist() for i in range(4)))), 0
            out = []
            for i in range(1, len(rows) + 1):
                if i == len(rows) or rows[i][:3] != rows[at][:3]:
                    out.append((*rows[at], ",".join(str(r[3]) for r in rows[at:i])))
                    at = i
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate([pa.int64()] * 4 + [pa.string()])],
                                             names=[*unit, "least", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, h, out = None, None, []
        for b in batches:
            for *key, ids in zip(*(b.column(i).to_pylist() for i in (0, 1, 2, 4))):
                if key == now:
                    h.update(b"," + ids.encode())
                else:
                    out += [(*now, h.hexdigest())] if now else []
                    now, h = key, hashlib.sha256(ids.encode())
        out += [(*now, h.hexdigest())] if now else []
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate([pa.int64()] * 3 + [pa.string()])],
                                         names=[*unit, "ends"])

    some = members.join(large.select(*unit), unit, "left_semi").select(*unit, "conv_id")
    packed = stored(some.repartitionByRange(*unit, "conv_id").sortWithinPartitions(*unit, "conv_id")
                    .mapInArrow(pack, "size bigint, p1 bigint, p2 bigint, least bigint, ids string"), "trie-runs")
    return (packed.repartition(*unit).sortWithinPartitions(*unit, "least")
            .mapInArrow(digest, "size bigint, p1 bigint, p2 bigint, ends string"))


def units_of(sizes: DataFrame, rows: DataFrame, run: int = RUN) -> DataFrame:
    """size, p1, p2, conv_id (smallest), n (members), upto (code points), ends: the distinct sequences."""
    last = rows.groupBy("conv_id").agg(F.max_by(F.struct("p1", "p2", "upto"), "depth").alias("z"))
    zero = F.lit(0).cast("bigint")
    members = stored(sizes.join(last, "conv_id", "left").select(
        "conv_id", F.col("size").cast("bigint").alias("size"),
        *[F.coalesce(F.col(f"z.{c}"), zero).alias(c) for c in ("p1", "p2", "upto")]), "trie-members")
    unit = ["size", "p1", "p2"]
    counted = stored(members.groupBy(*unit).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n"),
                                                F.min("upto").alias("upto")), "trie-counted")
    few, many = counted.where(F.col("n") <= run), counted.where(F.col("n") > run)
    lone = F.sha2(F.col("conv_id").cast("string"), 256)
    listed = (members.join(few.where("n > 1").select(*unit), unit, "left_semi").groupBy(*unit).agg(F.sha2(F.array_join(
        F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ","), 256).alias("ends")))
    out = few.where("n = 1").withColumn("ends", lone).unionByName(few.where("n > 1").join(listed, unit))
    if not many.isEmpty():
        out = out.unionByName(many.join(member_digests(members, many, run), unit))
    return stored(out, "trie-units")


def trie(sizes: DataFrame, rows: DataFrame, block: int = BLOCK, run: int = RUN) -> DataFrame:
    """conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256: one row
    for each node. ``sizes`` and ``rows`` are the sequences, as ``sequences`` or ``rebuilt`` give them."""
    spark = sizes.sparkSession
    sizes = stored(sizes, "trie-lengths")
    hashed = prefixes(sizes, rows, block)
    units = units_of(sizes, hashed, run)
    top = units.agg(F.min("conv_id").alias("c")).first()["c"]
    facts = units.select("conv_id", "size", "n", F.col("upto").alias("all"), "ends")
    own = hashed.join(facts, "conv_id")
    shared = (hashed.join(facts.select("conv_id"), "conv_id", "left_semi").groupBy("depth", "p1", "p2")
              .agg(F.count(F.lit(1)).alias("units"), F.min("conv_id").alias("first")).where("units > 1"))
    own = stored(own.join(stored(shared, "trie-shared"), ["depth", "p1", "p2"], "left"), "trie-own-rows")

    # The shared part of each unit, from the first turn on; with no other unit it is empty.
    parts = own.where("units > 1").groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("depth", "p1", "p2", "len", "first", "units", "upto"))).alias("parts"))
    level = F.coalesce(F.size("parts"), F.lit(0))
    met = (facts.join(parts, "conv_id", "left").withColumn("level", F.when(F.col("parts").isNull(), 0).otherwise(level))
           .withColumn("below", F.col("all") - F.when(F.col("level") > 0, F.element_at("parts", -1)["upto"]).otherwise(0))
           .withColumn("path", F.coalesce(F.transform("parts", lambda x: F.struct(
               *[x[f].alias(f) for f in ("p1", "p2", "len", "first", "units")])), F.array()).cast(_PATH)).drop("parts"))
    met = stored(met, "trie-met")

    deeper = F.col("size") > F.col("level")
    entering = met.select("level", "path", F.col("n").alias("n_convs"), deeper.cast("bigint").alias("kids"),
                          deeper.cast("bigint").alias("leaves"), ((F.col("n") - 1) * F.col("below")).alias("saved"),
                          F.when(~deeper, F.col("ends")).alias("ends"))
    where_units_meet = F.expr("filter(sequence(0, level), i -> i = level OR i > 0 AND path[i - 1].units > path[i].units)")
    depths = {r["d"] for r in met.select(F.explode(where_units_meet).alias("d")).distinct().collect()}
    if not met.isEmpty():
        depths |= {0}
    peeled = _peel(spark, entering, sorted(depths, reverse=True))

    tails = (own.where("units IS NULL")
             .join(met.select("conv_id", "level", F.when(F.col("level") > 0, F.element_at("path", -1)["first"])
                              .otherwise(F.lit(top)).alias("above")), "conv_id")
             .select("conv_id", "depth", F.when(F.col("depth") == F.col("level") + 1, F.col("above")).otherwise(F.col("conv_id"))
                     .alias("parent_conv_id"), F.col("n").alias("n_convs"),
                     (F.col("depth") < F.col("size")).cast("bigint").alias("n_children"),
                     F.lit(1).cast("bigint").alias("n_leaves"),
                     ((F.col("n") - 1) * (F.col("all") - F.col("upto") + F.col("len"))).alias("saved_tokens"),
                     F.when(F.col("depth") == F.col("size"), F.col("ends")).alias("ends")))
    out = tails if peeled is None else tails.unionByName(_chains(peeled, top))
    return out.withColumn("ends_sha256", F.coalesce("ends", F.sha2(F.lit(""), 256))).drop("ends")


def _peel(spark: SparkSession, entering: DataFrame, depths: list[int]) -> DataFrame | None:
    """level, path, n_convs, kids, leaves, saved, ends, back, saved_up: the nodes at which units meet, deepest first.

    ``back`` is the depth at which the node meets others again, -1 for the root, and ``saved_up`` what its chain up
    to there brings along.
    """
    place = table_path(spark, "llm-trie-peeled")
    schema = None
    for k, depth in enumerate(depths):
        here = entering.where(F.col("level") == depth).drop("level")
        if schema is not None:
            back = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(place).where(F.col("back") == depth)
            here = here.unionByName(back.select(
                F.slice("path", 1, F.col("back")).alias("path"), "n_convs", F.lit(1).cast("bigint").alias("kids"),
                "leaves", F.col("saved_up").alias("saved"), F.lit(None).cast("string").alias("ends")))
        nodes = here.groupBy("path").agg(*[F.sum(c).alias(c) for c in ("n_convs", "kids", "leaves", "saved")],
                                         F.max("ends").alias("ends"))
        last = F.when(F.size("path") > 0, F.element_at("path", -1)["len"]).otherwise(0)
        nodes = (nodes.withColumn("level", F.lit(depth))
                 .withColumn("leaves", F.when(F.col("kids") == 0, F.lit(1).cast("bigint")).otherwise(F.col("leaves")))
                 .withColumn("saved", F.col("saved") + (F.col("n_convs") - 1) * last)
                 .withColumn("back", F.lit(-1) if depth == 0 else F.expr(
                     "coalesce(array_max(filter(sequence(0, level - 1), i -> i > 0 AND path[i - 1].units > path[level - 1].units)), 0)"))
                 .withColumn("saved_up", F.col("saved") if depth == 0 else F.expr(
                     "saved + (n_convs - 1) * aggregate(slice(path, back + 1, level - 1 - back), 0L, (a, x) -> a + x.len)")))
        nodes.write.parquet(f"{place}/round-{k:06d}")
        schema = nodes.schema
    return None if schema is None else spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(place)


def _chains(peeled: DataFrame, top: int) -> DataFrame:
    """The nodes of every peeled chain: the node where units meet, and those above it with the same members."""
    each = peeled.select("*", F.explode(F.expr("sequence(level, greatest(back + 1, 0), -1)")).alias("depth"))
    between = F.expr("aggregate(IF(depth < level, slice(path, greatest(depth, 1), level - depth), slice(path, 1, 0)), 0L, "
                     "(a, x) -> a + x.len)")
    at = lambda i: F.when(i > 0, F.try_element_at("path", i)["first"]).otherwise(F.lit(top))
    meets = F.col("depth") == F.col("level")
    return each.select(at(F.col("depth")).alias("conv_id"), F.col("depth").cast("bigint").alias("depth"),
                       F.when(F.col("depth") > 0, at(F.col("depth") - 1)).alias("parent_conv_id"), "n_convs",
                       F.when(meets, F.col("kids")).otherwise(1).alias("n_children"), F.col("leaves").alias("n_leaves"),
                       (F.col("saved") + (F.col("n_convs") - 1) * between).alias("saved_tokens"),
                       F.when(meets, F.col("ends")).alias("ends"))


ORACLE = r"""
WITH t AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
c AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base,
         xor(list_reduce(flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
                                                lambda x: [CAST(ord(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
                         lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END,
                         CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT)) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
s AS (
  SELECT c.conv_id, 0 AS own, k, role, text FROM c JOIN t ON t.conv_id = c.base AND k <= h
  UNION ALL SELECT c.conv_id, 1, k, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND k > h),
q AS (
  SELECT c.conv_id, coalesce(list({'r': role, 'x': text} ORDER BY own, k) FILTER (WHERE k IS NOT NULL), []) AS seq
  FROM c LEFT JOIN s USING (conv_id) GROUP BY 1),
p AS (SELECT conv_id, seq, unnest(generate_series(0, len(seq))) AS d FROM q),
n AS (
  SELECT d, list_slice(seq, 1, d) AS key, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len(seq) = d), '')) AS ends_sha256
  FROM p GROUP BY 1, 2),
x AS (
  SELECT *, CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * length(key[d].x) END AS own,
         CASE WHEN d > 0 THEN list_slice(key, 1, d - 1) END AS up FROM n),
k AS (SELECT up AS key, count(*) AS n_children FROM x WHERE d > 0 GROUP BY 1),
y AS (SELECT x.*, coalesce(n_children, 0) AS n_children FROM x LEFT JOIN k USING (key)),
z AS (
  SELECT above, sum(own) AS saved, count(*) FILTER (WHERE n_children = 0) AS n_leaves
  FROM (SELECT own, n_children, list_slice(key, 1, a) AS above FROM (SELECT *, unnest(generate_series(0, d)) AS a FROM y)) GROUP BY 1)
SELECT y.conv_id, CAST(y.d AS BIGINT) AS depth, o.conv_id AS parent_conv_id, y.n_convs, y.n_children, z.n_leaves,
       CAST(z.saved AS BIGINT) AS saved_tokens, y.ends_sha256
FROM y JOIN z ON z.above = y.key LEFT JOIN n o ON o.key = y.up
"""
