"""Language-model scores by context-tree weighting over bytes.

A byte is eight binary decisions, the node of a decision being the bits decided
before it. Each decision has a tree of contexts: the last 0, 1, ... ``DEPTH``
bytes. Every tree node keeps Krichevsky-Trofimov counts, and its weighted
probability is half its own estimate and half the product of its children's, so
all depths are mixed by how well they explain the training corpus. A byte's
probability walks the path: at each depth the node's own estimate counts with
its posterior chance of being a leaf. The sum over a text is its code length.

The jobs: one pass over the texts counts (context, byte) grams of the training
documents and words for the base score (summed inside a task, then shuffled);
contexts that share their last two bytes are weighted together, one group of a
bounded number of grams; the two upper levels (256 contexts, then one) are
finished from their sums. A second pass scores: grams and words found ``COMMON``
times or more, at most the ``HOT_ROWS`` commonest of each, travel as a broadcast
of proven size; the rare ones are joined by shuffle, at every size of corpus, so
the result doesn't depend on that bound.

Defined results: a null text is empty (one end token, no bytes); a null doc_id
counts as the empty text in the fold; repeated rows count each time; without
training documents every estimate is 1/2 and the base score is null; an empty
table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import small_batches, stored, text_bytes

DEPTH = 4
#: Entries of a broadcast table, 16 bytes each; a task looks them up in a table of 34 to 68 bytes an entry.
HOT_ROWS = 1_000_000
#: Rarer grams and words are joined, not broadcast (a power of two, less one).
COMMON = 3
#: Distinct grams held by a task before its runs are merged.
MERGE_ROWS = 1_000_000
#: Bytes of text that a task works on at a time (one text at least), and table entries that it puts in at a time.
PIECE_BYTES = 1 << 19
PUT_ROWS = 1 << 17
GRAM, WORD, DOCS = 0, 1, 2


def gram_codes(texts: list[bytes], depth: int) -> np.ndarray:
    """For every byte of the texts, in order: the ``depth`` bytes before it (zero before the start) and itself."""
    gap = b"\0" * depth
    joined = np.frombuffer(gap + gap.join(texts), np.uint8)
    n = len(joined) - depth
    if n <= 0:
        return np.empty(0, np.int64)
    code = np.zeros(n, np.int64)
    for k in range(depth + 1):
        code = (code << 8) | joined[k:k + n]
    real = np.ones(n, bool)
    ends = np.cumsum([len(t) + depth for t in texts])[:-1]
    for k in range(depth):
        real[ends - depth + k] = False  # the gap in front of the next text
    return code[real]


def pieces(texts: list[bytes], most: int | None = None) -> Iterator[tuple[int, int]]:
    """Ranges of texts with ``most`` bytes together at most, or one longer text."""
    most, start, size = most or PIECE_BYTES, 0, 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > most:
            yield start, i
            start, size = i, 0
        size += len(t)
    if texts:
        yield start, len(texts)


def word_codes(text: bytes) -> np.ndarray:
    words = text.lower().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)).view(np.int64)


class Tally:
    """Summed counts of 64-bit keys, merged now and then."""

    def __init__(self):
        self.keys, self.sums, self.rows = [], [], 0

    def add(self, keys: np.ndarray, each: int) -> None:
        k, n = np.unique(keys, return_counts=True)
        self.keys.append(k), self.sums.append(n * each)
        self.rows += len(k)
        if self.rows > MERGE_ROWS:
            self.merge()
            self.rows = len(self.keys[0]) // 2  # merging again must be worth it

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.keys:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        k, at = np.unique(np.concatenate(self.keys), return_inverse=True)
        n = np.bincount(at, np.concatenate(self.sums), len(k)).astype(np.int64)
        self.keys, self.sums = [k], [n]
        return k, n


def with_fold(docs: DataFrame, folds: int = 10) -> DataFrame:
    """doc_id, text, held_out (crc32 of the id as text, modulo ``folds``, is 0)."""
    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return docs.select("doc_id", "text", (crc % folds == 0).alias("held_out"))


def corpus_counts(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """kind, key, n: training counts of grams, words and documents. Grams that only held-out texts have are there with 0."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, words, n_docs = Tally(), Tally(), 0
        for b in batches:
            texts, out = text_bytes(b.column(1)), b.column(2).to_pylist()
            for held in (False, True):
                some = [t for t, h in zip(texts, out) if h == held]
                for i, j in pieces(some):
                    grams.add(gram_codes(some[i:j], depth), 0 if held else 1)
                    if not held:
                        n_docs += j - i
                        words.add(np.concatenate([word_codes(t) for t in some[i:j]]), 1)
        for kind, (k, n) in ((GRAM, grams.merge()), (WORD, words.merge()),
                             (DOCS, (np.zeros(1, np.int64), np.array([n_docs])))):
            for i in range(0, len(k), 100_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(k[i:i + 100_000]), kind, np.int32)), pa.array(k[i:i + 100_000]),
                     pa.array(n[i:i + 100_000])], names=["kind", "key", "n"])

    parts = docs.mapInArrow(run, "kind int, key bigint, n bigint")
    return parts.groupBy("kind", "key").agg(F.sum("n").alias("n"))


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln of the gamma function for x >= 0.5: Stirling's series eight places further up."""
    p = np.ones_like(x)
    for k in range(8):
        p = p * (x + k)
    y = x + 8
    r = 1 / (y * y)
    series = (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r * (1 / 1680 - r / 1188)))) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - np.log(p)


def kt_log(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of a sequence with so many zeros and ones."""
    a, b = zeros.astype(np.float64), ones.astype(np.float64)
    return np.where(a + b > 0, log_gamma(a + 0.5) + log_gamma(b + 0.5) - math.log(math.pi) - log_gamma(a + b + 1), 0.0)


HALF = math.log(0.5)


def weighted(own: np.ndarray, children: np.ndarray) -> np.ndarray:
    return np.logaddexp(HALF + own, HALF + children)


def tree_nodes(code: np.ndarray, n: np.ndarray, bit: int, depths: list[int]) -> dict[int, dict[str, np.ndarray]]:
    """The nodes of decision ``bit`` at ``depths`` (deepest first) over complete contexts of the least depth.

    Each has ``key`` (context, then node), ``at`` (row of ``code`` to node), ``zeros``,
    ``ones``, ``own`` and ``all`` (ln of KT and weighted probability)."""
    byte = code & 255
    node = (1 << bit) | (byte >> (8 - bit))
    one = ((byte >> (7 - bit)) & 1).astype(bool)
    out: dict[int, dict[str, np.ndarray]] = {}
    for d in depths:
        key, first, at = np.unique((((code >> 8) & ((1 << (8 * d)) - 1)) << 8) | node, return_index=True, return_inverse=True)
        zeros, ones = np.bincount(at, n * ~one, len(key)), np.bincount(at, n * one, len(key))
        own = kt_log(zeros, ones)
        if out:
            below = out[prev]
            up = np.zeros(len(below["key"]), np.int64)
            up[below["at"]] = at
            all_ = weighted(own, np.bincount(up, below["all"], len(key)))
        else:
            all_ = own
        out[d] = {"key": key, "at": at, "zeros": zeros, "ones": ones, "own": own, "all": all_}
        prev = d
    return out


def upper_levels(sums: list, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """stop and chance of a one at depth 0 (row 256) and 1 (row: the byte before), by node.

    ``sums``: (byte before, node, zeros, ones, ln of the product of the children)."""
    zeros, ones, kids = (np.zeros((257, 256)) for _ in range(3))
    for c, node, z, o, k in sums:
        zeros[c, node], ones[c, node], kids[c, node] = z, o, k
    own = kt_log(zeros[:256], ones[:256])
    all_ = weighted(own, kids[:256])
    zeros[256], ones[256], kids[256] = zeros[:256].sum(0), ones[:256].sum(0), all_.sum(0)
    own = np.vstack([own, kt_log(zeros[256], ones[256])[None]])
    all_ = np.vstack([all_, weighted(own[256], kids[256])[None]])
    stop = np.exp(HALF + own - all_)
    return stop, (ones + 0.5) / (zeros + ones + 1)


def group_stream(batches: Iterator[pa.RecordBatch], least: int = 300_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """key and n of sorted batches, cut only where the group (last two context bytes) changes."""
    keys, counts = np.empty(0, np.int64), np.empty(0, np.int64)
    for b in batches:
        keys = np.r_[keys, b.column("key").to_numpy(zero_copy_only=False)]
        counts = np.r_[counts, b.column("n").to_numpy(zero_copy_only=False)]
        if len(keys) >= least:
            group = (keys >> 8) & 0xFFFF
            cut = int(np.flatnonzero(group != group[-1])[-1]) + 1 if (group != group[-1]).any() else 0
            if cut:
                yield keys[:cut], counts[:cut]
                keys, counts = keys[cut:], counts[cut:]
    if len(keys):
        yield keys, counts


def gram_scores(counts: DataFrame, depth: int = DEPTH) -> DataFrame:
    """key, n, lp: ln of the weighted probability of every gram's byte in its context."""
    if depth < 2:
        raise ValueError("depth must be 2 or more")
    grams = counts.where(F.col("kind") == GRAM).select("key", "n")
    pair = F.shiftright("key", 8).bitwiseAND(F.lit(0xFFFF))
    grouped = grams.withColumn("pair", pair).repartition("pair").sortWithinPartitions("pair").select("key", "n")
    depths = list(range(depth, 1, -1))

    def climb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for code, n in group_stream(batches):
            for bit in range(8):
                x = tree_nodes(code, n, bit, depths)[2]
                before = (x["key"] >> 8) & 255
                key, at = np.unique(before << 8 | x["key"] & 255, return_inverse=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((key >> 8).astype(np.int32)), pa.array((key & 255).astype(np.int32)),
                     *(pa.array(np.bincount(at, x[f], len(key))) for f in ("zeros", "ones", "all"))],
                    names=["c", "node", "zeros", "ones", "kids"])

    # at most 256 * 255 rows, whatever the corpus
    sums = (grouped.mapInArrow(climb, "c int, node int, zeros double, ones double, kids double")
            .groupBy("c", "node").agg(F.sum("zeros"), F.sum("ones"), F.sum("kids")).collect())
    stop01, one01 = upper_levels([tuple(r) for r in sums], depth)

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for code, n in group_stream(batches):
            total = np.zeros(len(code))
            byte, before = code & 255, (code >> 8) & 255
            for bit in range(8):
                levels = tree_nodes(code, n, bit, depths)
                one = None
                for d in depths:
                    x = levels[d]
                    kt = ((x["ones"] + 0.5) / (x["zeros"] + x["ones"] + 1))[x["at"]]
                    if one is None:
                        one = kt
                    else:
                        s = np.exp(HALF + x["own"] - x["all"])[x["at"]]
                        one = s * kt + (1 - s) * one
                node = (1 << bit) | (byte >> (8 - bit))
                for row in (before, np.full(len(code), 256)):
                    s = stop01[row, node]
                    one = s * one01[row, node] + (1 - s) * one
                is_one = ((byte >> (7 - bit)) & 1).astype(bool)
                total += np.log(np.where(is_one, one, 1 - one))
            yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(n), pa.array(total)], names=["key", "n", "lp"])

    return grouped.mapInArrow(descend, "key bigint, n bigint, lp double")


class Lookup:
    """Open-addressed table of 64-bit keys to doubles."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(len(keys) * 2).bit_length())
        size = 1 << self.bits
        self.keys, self.values, self.full = np.zeros(size, np.int64), np.zeros(size), np.zeros(size, bool)
        for i in range(0, len(keys), PUT_ROWS):
            self.put(keys[i:i + PUT_ROWS], values[i:i + PUT_ROWS])

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        at, left = self.slot(keys), np.arange(len(keys))
        while len(left):
            free = left[~self.full[at[left]]]
            slots, who = np.unique(at[free], return_index=True)
            put = free[who]
            self.keys[slots], self.values[slots], self.full[slots] = keys[put], values[put], True
            left = np.setdiff1d(left, put, assume_unique=True)
            at[left] = (at[left] + 1) & (len(self.keys) - 1)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values, and whether each key is there."""
        at = self.slot(keys)
        hit = self.full[at] & (self.keys[at] == keys)
        value = np.where(hit, self.values[at], 0.0)
        left = np.flatnonzero(~hit & self.full[at])
        at = at[left]
        while len(left):
            at = (at + 1) & (len(self.keys) - 1)
            match = self.keys[at] == keys[left]
            match &= self.full[at]
            value[left[match]], hit[left[match]] = self.values[at[match]], True
            go = self.full[at] & ~match
            left, at = left[go], at[go]
        return value, hit


def hottest(table: DataFrame, value: str, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and values of the common rows of a written table, at most ``limit``, the commonest first by powers of two."""
    power = F.log2(F.col("n") + 1).cast("int")
    total, least = 0, 64
    for r in table.groupBy(power.alias("e")).count().orderBy(F.desc("e")).collect():
        total += r["count"]
        if total > limit or 2 ** r["e"] <= COMMON:
            break
        least = r["e"]
    got = table.where(power >= least).select("key", value).toArrow()
    return got.column(0).to_numpy().astype(np.int64), got.column(1).to_numpy().astype(np.float64)


def score(docs: DataFrame, depth: int = DEPTH, folds: int = 10, hot_rows: int = HOT_ROWS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10), n_bytes, bits_per_byte."""
    spark = docs.sparkSession
    small_batches(spark)
    folded = with_fold(docs, folds)
    counts = stored(corpus_counts(folded, depth), "ctw-counts")
    totals = {r["kind"]: r for r in counts.groupBy("kind").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()}
    n_docs = totals[DOCS]["n"] if DOCS in totals else 0
    n_words, vocabulary = (totals[WORD]["n"], totals[WORD]["v"]) if WORD in totals else (0, 0)
    train_tokens, kinds = n_words + n_docs, vocabulary + (1 if n_docs else 0)
    norm = train_tokens + 0.1 * (kinds + 1)
    grams = stored(gram_scores(counts, depth), "ctw-grams")
    words = counts.where(F.col("kind") == WORD).select("key", "n")
    tables = spark.sparkContext.broadcast({"gram": hottest(grams, "lp", hot_rows), "word": hottest(words, "n", hot_rows)})
    end = math.log10((n_docs + 0.1) / norm)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = tables.value
        if "look" not in shared:
            shared["look"] = Lookup(*shared.pop("gram")), Lookup(*shared.pop("word"))
        gram_table, word_table = shared["look"]
        row = (TaskContext.get().partitionId() << 33) - 1
        for b in batches:
            whole = text_bytes(b.column(1))
            for i, j in pieces(whole):
                texts = whole[i:j]
                rids = np.arange(row + 1, row + 1 + len(texts))
                row += len(texts)
                sizes = np.array([len(t) for t in texts])
                code = gram_codes(texts, depth)
                lp, hit = gram_table.get(code)
                of = np.repeat(np.arange(len(texts)), sizes)
                scores = np.bincount(of, lp, len(texts))
                codes = [word_codes(t) for t in texts]
                n_of = np.array([len(x) for x in codes])
                word = np.concatenate(codes)
                w_of = np.repeat(np.arange(len(texts)), n_of)
                n, seen = word_table.get(word)
                base = np.bincount(w_of, np.where(seen, np.log10((n + 0.1) / norm), 0.0), len(texts)) + end
                known = np.bincount(w_of, seen, len(texts)).astype(np.int64) + (1 if n_docs else 0)
                yield batch(GRAM - 1, rids, b.column(0).slice(i, j - i), b.column(2).slice(i, j - i), n_of + 1, known, base, scores,
                            sizes)
                for kind, key, rows, miss in ((GRAM, code, of, ~hit), (WORD, word, w_of, ~seen)):
                    if miss.any():
                        pairs, times = np.unique(np.stack([rows[miss], key[miss]]), axis=1, return_counts=True)
                        yield batch(kind, rids[pairs[0]], None, None, times, pairs[1], None, None, None)

    def batch(kind, rid, doc, held, a, b, x, y, size):
        n = len(rid)
        null = lambda t: pa.nulls(n, t)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, kind, np.int32)), pa.array(rid), null(doc_type) if doc is None else doc,
             null(pa.bool_()) if held is None else held, pa.array(a.astype(np.int64)), pa.array(b.astype(np.int64)),
             null(pa.float64()) if x is None else pa.array(x), null(pa.float64()) if y is None else pa.array(y),
             null(pa.int64()) if size is None else pa.array(size.astype(np.int64))],
            names=["kind", "rid", "doc_id", "held_out", "a", "b", "x", "y", "size"])

    from pyspark.sql.pandas.types import to_arrow_type

    doc_type = to_arrow_type(folded.schema["doc_id"].dataType)
    id_type = folded.schema["doc_id"].dataType.simpleString()
    rows = stored(folded.mapInArrow(run, f"kind int, rid bigint, doc_id {id_type}, held_out boolean, a bigint, b bigint, "
                                         "x double, y double, size bigint"), "ctw-rows")
    heads = rows.where(F.col("kind") == GRAM - 1)
    rare = rows.where(F.col("kind") >= GRAM).select("kind", "rid", F.col("a").alias("times"), F.col("b").alias("key"))
    g = rare.where(F.col("kind") == GRAM).join(grams.select("key", "lp"), "key").select(
        "rid", (F.col("times") * F.col("lp")).alias("lp"), F.lit(0.0).alias("base"), F.lit(0).cast("bigint").alias("known"))
    c = F.coalesce(F.col("n"), F.lit(0))
    w = rare.where(F.col("kind") == WORD).join(words, "key", "left").select(
        "rid", F.lit(0.0).alias("lp"), (F.col("times") * F.log10((c + 0.1) / F.lit(norm))).alias("base"),
        F.when(c > 0, F.col("times")).otherwise(0).cast("bigint").alias("known"))
    more = g.unionByName(w).groupBy("rid").agg(*[F.sum(x).alias(f"more_{x}") for x in ("lp", "base", "known")])
    summed = heads.join(more, "rid", "left").withColumns(
        {o: F.col(i) + F.coalesce(f"more_{o}", F.lit(0)) for o, i in (("known", "b"), ("base", "x"), ("lp", "y"))})
    log10 = F.col("lp") / F.lit(math.log(10))
    return summed.select(
        "doc_id", "held_out", F.col("a").alias("n_tokens"), F.col("known").cast("bigint").alias("n_known"),
        F.lit(train_tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") if train_tokens else F.lit(None).cast("double")).alias("base_score"), log10.alias("score"),
        F.col("size").alias("n_bytes"),
        F.when(F.col("size") > 0, -F.col("lp") / F.lit(math.log(2)) / F.col("size")).alias("bits_per_byte"))
