"""Line dedup by a suffix array over line ids. DataFrame functions only.

The lines with a word of every document, in order, are one sequence; its suffixes
are sorted by distributed prefix doubling. Round k gives every suffix the rank of
its first 2**k lines: the pair (rank here, rank 2**(k-1) lines on) is range
partitioned and sorted, and its place is the new rank. Only prefixes found twice
or more go on, so a round costs what still repeats, and the last one is the
longest repeated run. A rank class is an interval of the suffix array whose
longest common prefix is 2**k lines at least; its smallest (doc_id, line) is the
original and the others are later copies.

A later copy is deleted when the run has ``min_lines`` lines (a power of two), is
one line of ``min_chars`` characters, or has fewer lines that are all shorter but
have ``min_chars`` together. Every longer run is covered by such windows, so the
deletion is whole whatever the run's length. ``reaches`` goes from the longest
2**k lines of a place down the lower ranks to the longest run that any earlier
place has too; a run that isn't the rest of the one before it is maximal.

Defined results: a null text has no lines; lines without a word are never part
of a run and stay where they are; order is by doc_id (null first), a hash of the
text where ids repeat, then line; rows that repeat id and text are treated
alike; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationlake.llm.common import stored

MIN_LINES = 4
MIN_CHARS = 40
_WORDY = r"[^\x20\x09-\x0D]"
_AT = ["d", "th", "pos"]


def keyed(docs: DataFrame) -> DataFrame:
    """d, th (the document's place in the order) and its lines."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63))).alias("d"),
                       F.xxhash64(text).alias("th"), F.split(text, "\n", -1).alias("lines"))


def line_ids(docs: DataFrame) -> DataFrame:
    """d, th, pos, a, b (128 bits of the line's hash), chars: one row for each line with a word."""
    worded = F.filter("lines", lambda x: x.rlike(_WORDY))
    return (keyed(docs).select("d", "th", F.posexplode(worded).alias("pos", "line"))
            .select(*_AT, F.xxhash64("line").alias("a"), F.xxhash64(F.lit(1), "line").alias("b"),
                    F.length("line").alias("chars")))


def ranked(pairs: DataFrame, name: str) -> DataFrame:
    """a, b, rank, n, first: the pairs found twice or more, in order of (a, b)."""
    classes = (pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*_AT)).alias("first"))
               .where("n > 1").repartitionByRange("a", "b").sortWithinPartitions("a", "b")
               .withColumn("rank", F.monotonically_increasing_id()))
    return stored(classes, f"{name}-ranks")


def suffix_levels(docs: DataFrame, last: int | None = None) -> list[DataFrame]:
    """For k = 0, 1, ... (``last`` at most): d, th, pos, rank, first, later, chars of each suffix whose first 2**k lines
    repeat."""
    pairs, levels, k = line_ids(docs), [], 0
    while last is None or k <= last:
        names = ranked(pairs, f"lines-{k}")
        if names.isEmpty():
            return levels
        found = pairs.join(names, ["a", "b"]).select(
            *_AT, "rank", "first", (F.col("first") < F.struct(*_AT)).alias("later"), "chars")
        if k == 0:
            found = found.dropDuplicates(_AT)
        levels.append(stored(found, f"lines-{k}"))
        ahead = Window.partitionBy("d", "th").orderBy("pos").rangeBetween(1 << k, 1 << k)
        pairs = (levels[-1].select(*_AT, F.col("rank").alias("a"), F.max("rank").over(ahead).alias("b"), "chars")
                 .where("b IS NOT NULL"))
        k += 1
    return levels


def short_runs(places: DataFrame, min_lines: int, min_chars: int) -> list[DataFrame]:
    """d, th, pos, n_lines: later copies of less than ``min_lines`` lines, each below ``min_chars`` but not all together;
    ``places`` is the level of single lines."""
    out = []
    for n in range(2, min_lines):
        ahead = Window.partitionBy("d", "th").orderBy("pos").rangeBetween(0, n - 1)
        windows = (places.select(*_AT, F.collect_list("rank").over(ahead).alias("key"), F.max("chars").over(ahead).alias("most"),
                                 F.sum("chars").over(ahead).alias("all"))
                   .where((F.size("key") == n) & (F.col("most") < min_chars) & (F.col("all") >= min_chars)))
        first = windows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*_AT)).alias("first")).where("n > 1")
        out.append(windows.join(first, "key").where(F.col("first") < F.struct(*_AT)).select(*_AT, F.lit(n).alias("n_lines")))
    return out


def removed_lines(levels: list[DataFrame], min_lines: int = MIN_LINES, min_chars: int = MIN_CHARS) -> DataFrame | None:
    """d, th, gone (sorted places of the lines to delete); None if nothing repeats."""
    if min_lines < 1 or min_lines & (min_lines - 1):
        raise ValueError("min_lines must be a power of two")
    if not levels:
        return None
    marks = levels[0].where(F.col("later") & (F.col("chars") >= min_chars)).select(*_AT)
    k = min_lines.bit_length() - 1
    windows = short_runs(levels[0], min_lines, min_chars)
    if k < len(levels):
        windows.append(levels[k].where("later").select(*_AT, F.lit(min_lines).alias("n_lines")))
    for w in windows:
        marks = marks.unionByName(w.select("d", "th", F.explode(F.expr("sequence(pos, pos + n_lines - 1)")).alias("pos")))
    return marks.groupBy("d", "th").agg(F.sort_array(F.collect_set("pos")).alias("gone"))


def reaches(levels: list[DataFrame]) -> DataFrame | None:
    """d, th, pos, len, first: the longest run from each place that an earlier place has too, and the first such place.

    A class holds all places with the same ``len`` lines; a place is open in the class of the longest run known to
    occur earlier. Step k tries 2**k lines more on every class that has an open place."""
    if not levels:
        return None
    place = F.struct(*_AT)
    tops = [x.where("later").select(*_AT, F.lit(k).alias("k"), "first") for k, x in enumerate(levels)]
    every = tops[0]
    for t in tops[1:]:
        every = every.unionByName(t)
    top = stored(every.groupBy(*_AT).agg(F.max(F.struct("k", "first")).alias("m"))
                 .select(*_AT, "m.k", "m.first"), "lines-tops")
    state = None  # d, th, pos, len, x, y (the class), first, open
    for k in range(len(levels) - 1, -1, -1):
        if state is not None:
            ahead = levels[k].select("d", "th", F.col("pos").alias("to"), F.col("rank").alias("b"))
            longer = (state.withColumn("to", F.col("pos") + F.col("len")).join(ahead, ["d", "th", "to"])
                      .select(*_AT, "len", F.xxhash64("x", "y", "b").alias("nx"), F.xxhash64("y", "b", "x").alias("ny"), "open"))
            again = (longer.groupBy("nx", "ny", "len").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"),
                                                           F.max(F.when(F.col("open"), place)).alias("last"))
                     .where("n > 1 AND first < last").drop("n", "last"))
            longer = stored(longer.join(again, ["nx", "ny", "len"]).select(
                *_AT, (F.col("len") + (1 << k)).alias("len"), F.col("nx").alias("x"), F.col("ny").alias("y"), "first",
                (F.col("open") & (F.col("first") < place)).alias("open")), f"lines-longer-{k}")
            went = longer.where("open").select(*_AT, F.lit(True).alias("went"))
            state = (state.join(went, _AT, "left").withColumn("open", F.col("open") & F.col("went").isNull()).drop("went")
                     .unionByName(longer))
        here = top.where(F.col("k") == k)
        if k == 0:
            ended = here.select(*_AT, F.lit(1).alias("len"), "first")
            return ended if state is None else ended.unionByName(state.where("open").select(*_AT, "len", "first"))
        members = (levels[k].join(here.select(*_AT, F.lit(True).alias("open")), _AT, "left")
                   .select(*_AT, F.lit(1 << k).alias("len"), F.col("rank").alias("x"), F.lit(k).cast("bigint").alias("y"),
                           "first", F.coalesce("open", F.lit(False)).alias("open")))
        state = members if state is None else state.unionByName(members)
        state = stored(state, f"lines-state-{k}")
        tried = state.where("open").select("x", "y", "len").distinct()
        state = stored(state.join(tried, ["x", "y", "len"], "left_semi"), f"lines-open-{k}")


def runs(levels: list[DataFrame], min_lines: int = 2) -> DataFrame | None:
    """d, th, start, n_lines, src (place of the original's first line): maximal later copies of ``min_lines`` lines."""
    found = reaches(levels)
    if found is None:
        return None
    w = Window.partitionBy("d", "th").orderBy("pos")
    stop = F.col("pos") + F.col("len")
    return (found.withColumn("before", F.lag(stop).over(w))
            .where((F.col("before").isNull() | (stop > F.col("before"))) & (F.col("len") >= min_lines))
            .select("d", "th", F.col("pos").alias("start"), F.col("len").alias("n_lines"), F.col("first").alias("src")))


def _shortened(docs: DataFrame, min_lines: int, min_chars: int, with_runs: bool = True) -> DataFrame:
    """row (all columns of ``docs``), new_text and the counts; those of the runs only ``with_runs``."""
    levels = suffix_levels(docs, None if with_runs else min_lines.bit_length() - 1)
    gone = removed_lines(levels, min_lines, min_chars)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    base = docs.select(row, F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63))).alias("d"),
                       F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("th"))
    if gone is None:
        found = base.withColumns({"gone": F.lit(None).cast("array<int>"), "n_runs": F.lit(0), "longest_run": F.lit(0)})
    elif not with_runs:
        found = base.join(stored(gone, "lines-gone"), ["d", "th"], "left").withColumns({"n_runs": F.lit(0), "longest_run": F.lit(0)})
    else:
        each = runs(levels, 1).groupBy("d", "th").agg(F.count(F.lit(1)).alias("n_runs"),
                                                      F.max("n_lines").alias("longest_run"))
        facts = stored(each.join(gone, ["d", "th"], "left"), "lines-gone")
        found = base.join(facts, ["d", "th"], "left")
    lines = F.split(F.coalesce(F.col("row.text"), F.lit("")), "\n", -1)
    found = found.withColumn("lines", lines).withColumn("worded", F.expr(
        f"filter(sequence(0, size(lines) - 1), i -> lines[i] rlike r'{_WORDY}')"))
    text = F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(F.expr(
        "array_join(transform(array_except(sequence(0, size(lines) - 1), transform(gone, p -> worded[p])), "
        "i -> lines[i]), '\n')"))
    return found.select("row", text.alias("new_text"),
                        F.size("worded").cast("bigint").alias("n_lines"),
                        F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_removed"),
                        F.coalesce("n_runs", F.lit(0)).cast("bigint").alias("n_runs"),
                        F.coalesce("longest_run", F.lit(0)).cast("bigint").alias("longest_run"))


_COUNTS = ["n_lines", "n_removed", "n_runs", "longest_run"]


def _columns(docs: DataFrame, without: list[str] = ()) -> list:
    return [(F.col("new_text") if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns if c not in without]


def dedup_lines(docs: DataFrame, min_lines: int = MIN_LINES, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with the later copies deleted from ``text``, and n_lines, n_removed, n_runs, longest_run
    (n_lines counts the lines with a word before the deletion; input columns of these names are replaced)."""
    return _shortened(docs, min_lines, min_chars).select(*_columns(docs, _COUNTS), *_COUNTS)


def keep_lines(docs: DataFrame, min_lines: int = MIN_LINES, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` without the later copies, same columns; a document of which no line with a word is left is dropped."""
    out = _shortened(docs, min_lines, min_chars, with_runs=False)
    return out.where("n_removed = 0 OR n_removed < n_lines").select(*_columns(docs))
