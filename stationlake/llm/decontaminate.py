"""Benchmark decontamination by a prefix-filtered set join. DataFrame functions only.

Every item is cut into windows of ``window`` words (a shorter item is one window), and
a window into its shingles of ``shingle`` words. Each window is held against the
document windows of its own size: it is found where at least ``share`` of its shingles
stand in the document window at their places (with 1, where all words agree).

Prefix filter: shingles are ordered by rarity, their number of places in all documents.
A document window that has ``need`` of a window's n shingles has one of its n - need + 1
rarest, so only these go into the join; of a window with share 1 only the rarest one.
A window of which fewer than ``need`` shingles occur in the documents at all (length
bound) is let go. A met shingle fixes the place of the document window; one that would
begin before the text or end behind it is let go (positional bound). The rest are
compared word by word.

Windows of equal words are one, whatever the number of items. The table of prefix
shingles is broadcast if its measured size allows; the documents are then spread,
joined and verified without a shuffle. Beyond it, places are joined by a shuffle first,
and only the matched places of each document meet the table again.

Defined results: a null or empty text has no words; an item without words has no
windows; rows that share an item_id are one item with the windows of all its texts; an
item without an id marks words but is not counted or named; every row of the documents
gives one row, whatever its doc_id (null, repeated); only ``doc_id``, ``item_id`` and
``text`` are read, so other columns may have any name; empty tables give no hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import BROADCAST_BYTES, measured_bytes, stored

WINDOW = 10
SHINGLE = 3
#: A word, before A-Z are lowered: neither ASCII punctuation, nor white space, nor a control character.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_KEY = ["doc_id", "t1", "t2"]


def words(text: Column) -> Column:
    """The words of a text, A-Z lowered (a word of ASCII only takes the quick way)."""
    return F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0)), lambda w: F.when(
        F.octet_length(w) == F.length(w), F.lower(w)).otherwise(F.translate(w, _UPPER, _LOWER)))


def item_windows(items: DataFrame, window: int, shingle: int, share: float) -> DataFrame:
    """win (words), m, s (words of a shingle), n (shingles), need, items (sorted ids as strings): distinct windows."""
    found = (items.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("ws"))
             .where(F.size("ws") > 0)
             .withColumn("m", F.least(F.lit(window), F.size("ws")))
             .select("item", "ws", "m", F.explode(F.sequence(F.lit(1), F.size("ws") - F.col("m") + 1)).alias("at"))
             .groupBy(F.slice("ws", F.col("at"), F.col("m")).alias("win"))
             .agg(F.sort_array(F.collect_set("item")).alias("items")))
    sized = found.withColumn("m", F.size("win")).withColumn("s", F.least(F.lit(shingle), F.col("m")))
    return (sized.withColumn("n", F.col("m") - F.col("s") + 1)
            .withColumn("need", F.greatest(F.lit(1), F.ceil(F.lit(share) * F.col("n") - 1e-9))))


def window_shingles(windows: DataFrame, shingle: int) -> DataFrame:
    """``windows`` with h (the hash of a shingle) and o (its place in the window)."""
    each = windows.select("*", F.explode(F.expr("sequence(0, m - s)")).alias("o"))
    parts = [F.when(F.col("s") > j, F.get("win", F.col("o") + j)) for j in range(shingle)]
    return each.withColumn("h", F.xxhash64(*parts))


def spread(docs: DataFrame, shingle: int, sizes: list[int], places: bool = False) -> DataFrame:
    """doc_id, t1, t2 (the text's hash), n_words, ws, pos, h: a row for the shingle of each size at each word.

    Word i has ``pos`` i + 1. One more row a text, ``pos`` 0, stands for the text itself; its h is an arbitrary
    hash, so that a shuffle deals these rows evenly. With ``places`` only the words listed there get rows.
    """
    ws = words(F.col("text")).alias("ws")
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select("doc_id", F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2"), ws,
                       *(["places"] if places else []))
    base = base.withColumn("n_words", F.size("ws").cast("bigint"))
    first = F.array(F.lit(None).cast("string"))
    ahead = [F.concat(first, F.col("ws"))] + [F.slice(F.concat(first, F.col("ws")), j + 1, F.size("ws") + 1)
                                              for j in range(1, shingle)]
    names = [f"w{j}" for j in range(shingle)]
    if places:
        at = F.explode(F.concat(F.array(F.lit(0)), F.coalesce("places", F.array().cast("array<int>")))).alias("pos")
        rows = base.select(*_KEY, "n_words", "ws", at)
        parts = [F.when(F.col("pos") > 0, F.get("ws", F.col("pos") - 1 + j)) for j in range(shingle)]
    else:
        rows = (base.select(*_KEY, "n_words", "ws", *(a.alias(n) for a, n in zip(ahead, names)))
                .select(*_KEY, "n_words", "ws", F.posexplode(F.arrays_zip(*names)).alias("pos", "gram")))
        parts = [F.col(f"gram.{n}") for n in names]
    hashes = [F.xxhash64(*parts[:size]) for size in sizes]
    own = F.xxhash64(F.lit(2), "doc_id", "t1", "t2")
    if len(sizes) == 1:
        return rows.withColumn("h", F.when(F.col("pos") > 0, hashes[0]).otherwise(own)).drop("gram")
    several = F.when(F.col("pos") > 0, F.array(*hashes)).otherwise(F.array(own))
    return rows.withColumn("h", F.explode(several)).drop("gram")


def prefix_table(docs: DataFrame, windows: DataFrame, shingle: int, sizes: list[int], limit: int) -> DataFrame:
    """h, entries (win, m, s, need, o, items): the windows whose prefix holds the shingle h at place o."""
    shingles = stored(window_shingles(windows, shingle), "leak-shingles")
    every = _hint(stored(shingles.select("h").distinct(), "leak-hashes"), limit)
    seen = (spread(docs, shingle, sizes).where("pos > 0").select("h").join(every, "h", "left_semi")
            .groupBy("h").agg(F.count(F.lit(1)).alias("places")))
    # by rarity; the hash and the place make the order total
    ranked = (shingles.join(stored(seen, "leak-rarity"), "h")
              .groupBy("win", "m", "s", "n", "need", "items")
              .agg(F.sort_array(F.collect_list(F.struct("places", "h", "o"))).alias("rare"))
              .where(F.size("rare") >= F.col("need")))
    # shingles that occur nowhere are the rarest and need no join
    prefix = ranked.withColumn("rare", F.expr("slice(rare, 1, CAST(size(rare) - need + 1 AS INT))"))
    return stored(prefix.select("win", "m", "s", "need", "items", F.explode("rare").alias("r"))
                  .groupBy(F.col("r.h").alias("h"))
                  .agg(F.collect_list(F.struct("win", "m", "s", "need", F.col("r.o").alias("o"), "items")).alias("entries")),
                  "leak-prefixes")


def _hint(small: DataFrame, limit: int) -> DataFrame:
    return F.broadcast(small) if measured_bytes(small) <= limit else small


def find(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, share: float = 1.0,
         limit: int = BROADCAST_BYTES) -> DataFrame:
    """doc_id, n_words, hits (from, to: found windows as places of words, [from, to), in order), n_hit (words inside
    any), items (ids of the items with found windows, sorted as strings): one row for each row of ``docs``."""
    if not 1 <= shingle <= window or not 0 < share <= 1:
        raise ValueError("1 <= shingle <= window and 0 < share <= 1")
    windows = stored(item_windows(items, window, shingle, share), "leak-windows")
    sizes = sorted(r["s"] for r in windows.select("s").distinct().collect()) or [shingle]  # at most ``shingle`` rows
    table = prefix_table(docs, windows, shingle, sizes, limit)
    if measured_bytes(table) <= limit:
        places, table = spread(docs, shingle, sizes), F.broadcast(table)
    else:
        at = (spread(docs, shingle, sizes).where("pos > 0").select(*_KEY, "pos", "h")
              .join(table.select("h"), "h", "left_semi").groupBy(*_KEY).agg(F.collect_set("pos").alias("places")))
        text = F.coalesce(F.col("text"), F.lit(""))
        keyed = docs.select("doc_id", "text", F.xxhash64(text).alias("x1"), F.xxhash64(F.lit(1), text).alias("x2"))
        at = at.withColumnRenamed("doc_id", "d")
        same = keyed["doc_id"].eqNullSafe(at["d"]) & (keyed["x1"] == at["t1"]) & (keyed["x2"] == at["t2"])
        places = spread(keyed.join(at, same, "left").select("doc_id", "text", "places"), shingle, sizes, places=True)
    # of a matched place only the words around it go on, not the whole text
    behind = F.greatest(F.col("pos") - window, F.lit(0))
    met = (places.join(table, "h", "left").where("pos = 0 OR entries IS NOT NULL")
           .select(*_KEY, "n_words", "pos", behind.alias("behind"),
                   F.slice("ws", behind + 1, F.when(F.col("pos") > 0, F.lit(2 * window - 1)).otherwise(0)).alias("near"),
                   F.when(F.col("pos") > 0, F.col("entries")).alias("entries"))
           .select(*_KEY, "n_words", "pos", "behind", "near", F.explode_outer("entries").alias("e"))
           .withColumn("begin", F.col("pos") - 1 - F.col("e.o")))
    inside = (F.col("begin") >= 0) & (F.col("begin") + F.col("e.m") <= F.col("n_words"))
    place = F.greatest(F.col("begin") - F.col("behind"), F.lit(0)) + 1
    here = F.slice("near", place, F.coalesce("e.m", F.lit(0)))
    if share == 1:
        agree = here == F.col("e.win")
    else:
        met = met.withColumn("here", here)
        agree = F.expr("aggregate(sequence(0, e.m - e.s), 0, (k, o) -> k + IF(slice(here, o + 1, e.s) = "
                       "slice(e.win, o + 1, e.s), 1, 0)) >= e.need")
    hit = (F.col("pos") > 0) & inside & agree
    rows = (met.withColumn("hit", F.coalesce(hit, F.lit(False))).where("pos = 0 OR hit").groupBy(*_KEY, "n_words")
            .agg(F.count_if(F.col("pos") == 0).cast("int").alias("copies"),
                 F.sort_array(F.collect_set(F.when(F.col("hit"), F.struct(
                     F.col("begin").cast("bigint").alias("from"), (F.col("begin") + F.col("e.m")).cast("bigint").alias("to"))))).alias("found"),
                 F.collect_set(F.when(F.col("hit"), F.col("e.items"))).alias("lists")))
    covered = F.expr("""aggregate(found, named_struct('end', 0L, 'n', 0L), (a, x) -> named_struct(
        'end', greatest(a.end, x.to), 'n', a.n + greatest(0L, x.to - greatest(a.end, x.from))), a -> a.n)""")
    return (rows.select("doc_id", "n_words", F.col("found").alias("hits"), covered.alias("n_hit"),
                        F.sort_array(F.array_distinct(F.flatten("lists"))).alias("items"),
                        F.explode(F.expr("sequence(1, copies)")).alias("copy")).drop("copy"))


ORACLE = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{WORD}') AS ws FROM documents),
i AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{WORD}') AS ws
  FROM benchmark),
iw AS (
  SELECT DISTINCT item, m, array_to_string(list_slice(ws, k, k + m - 1), ' ') AS w
  FROM (SELECT item, ws, least({WINDOW}, len(ws)) AS m, unnest(generate_series(1, greatest(1, len(ws) - {WINDOW - 1}))) AS k
        FROM i WHERE len(ws) > 0)),
dw AS (
  SELECT doc_id, m, k, array_to_string(list_slice(ws, k, k + m - 1), ' ') AS w
  FROM (SELECT doc_id, ws, m, unnest(generate_series(1, len(ws) - m + 1)) AS k
        FROM d JOIN (SELECT DISTINCT m FROM iw) ON len(ws) >= m)),
h AS (SELECT DISTINCT doc_id, item, dw.m, k FROM dw JOIN iw ON dw.w = iw.w AND dw.m = iw.m),
p AS (
  SELECT doc_id, count(DISTINCT place) AS n
  FROM (SELECT doc_id, unnest(generate_series(k, k + m - 1)) AS place FROM h) GROUP BY 1),
t AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY 1)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(p.n, 0) AS n_hit, coalesce(t.n, 0) AS n_items,
       sha256(coalesce(t.s, '')) AS items_sha256, coalesce(p.n, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN t USING (doc_id)
"""
