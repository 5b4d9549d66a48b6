"""Near-duplicate documents by b-bit MinHash.

A document is its set of ``width``-word shingles (64-bit hashes of words, chained
over the window). Equal sets become one class, so an exact copy costs nothing
further. Each class gets ``bands * rows`` minima of permuted hashes; the full
minima make the band keys, and only ``BITS`` low bits of each are kept, packed
into a signature. Classes that share a band key are candidates; the share of
equal lanes, counted in bits and corrected for the 2**-BITS chance of a match,
estimates the similarity, and only a pair far below the threshold is let go.
Every other link is confirmed on the full sets.

No bucket is expanded into all its pairs. First each bucket's members meet its
smallest one. The confirmed links give components. Then the members of all buckets
with the same smallest one are a group, dealt into blocks; only members of another
component than that smallest one meet the group's blocks, and only across
components, since a link inside a component changes nothing. Blocks first compare
signatures, then, for the members with a possible partner, the full sets; a task
holds two blocks and emits at most one link a member and component.

With 32 bands of 4 a pair at the threshold 0.75 is missed with probability
0.684**32 = 5e-6, above it with less.

Defined results: a text without words (or null) has an empty set and is linked
with nothing; repeated rows are one class; rows that share a doc_id are one node;
a null doc_id takes no part in links, has a null component and is kept; an empty
table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import hinted, small_batches, stored, text_bytes

WIDTH = 5
PERCENT = 75
BANDS = 32
ROWS = 4
BITS = 4
#: A candidate is let go if its estimate is this many standard errors below the threshold.
ERRORS = 5.0
#: Shingles permuted at a time.
STEP = 2048


def shingle_set(text: bytes, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct shingles of a text as 64-bit hashes; the whole sequence if it has fewer words."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(1, len(h) - width + 1)
    out = np.full(n, min(len(h), width), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(min(len(h), width)):
            out = (out ^ h[k:k + n]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(32)
    return np.unique(out)


def permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(20240229))
    return rng.integers(0, 1 << 63, n, np.uint64), rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1)


def minima(shingles: np.ndarray, flip: np.ndarray, factor: np.ndarray) -> np.ndarray:
    best = None
    for i in range(0, len(shingles), STEP):
        low = ((shingles[i:i + STEP, None] ^ flip) * factor).min(axis=0)
        best = low if best is None else np.minimum(best, low)
    return best


def packed_bits(mins: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The low ``bits`` of each minimum, packed into signed 64-bit words."""
    per = 64 // bits
    # the low bits of a product depend on few bits of the hash: take them after a mix
    mixed = (mins ^ (mins >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    lanes = (mixed >> np.uint64(64 - bits)).reshape(-1, per)
    shift = (np.arange(per, dtype=np.uint64) * np.uint64(bits))
    return np.bitwise_or.reduce(lanes << shift, axis=1).view(np.int64)


def sketch(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, bits: int = BITS) -> DataFrame:
    """doc_id, n_shingles, set_a, set_b (hash of the set), keys (band keys), sig (packed low bits)."""
    if 64 % bits or bands * rows * bits % 64:
        raise ValueError("signatures must fill whole 64-bit words")
    small_batches(docs.sparkSession)
    flip, factor = permutations(bands * rows)
    band_no = (np.arange(bands, dtype=np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        for b in batches:
            n, sets, keys, sigs = [], [], [], []
            for text in text_bytes(b.column(1)):
                s = shingle_set(text)
                n.append(len(s))
                if not len(s):
                    sets.append((0, 0)), keys.append([]), sigs.append([])
                    continue
                whole = xxhash.xxh3_128_intdigest(s.tobytes())
                sets.append((whole >> 64, whole & 0xFFFFFFFFFFFFFFFF))
                m = minima(s, flip, factor)
                key = band_no.copy()
                for c in m.reshape(bands, rows).T:
                    key = (key ^ c) * np.uint64(0x9E3779B97F4A7C15)
                    key ^= key >> np.uint64(31)
                keys.append(key.view(np.int64)), sigs.append(packed_bits(m, bits))
            ab = np.array(sets, np.uint64).reshape(-1, 2).view(np.int64)
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(ab[:, 0]), pa.array(ab[:, 1]),
                 pa.array(keys, longs), pa.array(sigs, longs)],
                names=["doc_id", "n_shingles", "set_a", "set_b", "keys", "sig"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, keys array<bigint>, sig array<bigint>")


def shingles(docs: DataFrame) -> DataFrame:
    """id, s: the full shingle sets."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = [shingle_set(t).view(np.int64) for t in text_bytes(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.list_(pa.int64()))], names=["id", "s"])

    return docs.select(F.col("doc_id").cast("bigint").alias("id"), "text").mapInArrow(run, "id bigint, s array<bigint>")


def estimate(a: str, b: str, bits: int = BITS, lanes: int = BANDS * ROWS) -> str:
    """SQL for the similarity estimated from two packed signatures."""
    low = sum(1 << i for i in range(0, 64, bits))
    low = low - (1 << 64) if low >> 63 else low
    folded = "x"
    width = 1
    while width < bits:
        folded = f"({folded} | shiftrightunsigned({folded}, {width}))"
        width *= 2
    differ = (f"aggregate(zip_with({a}, {b}, (p, q) -> p ^ q), 0, (n, x) -> n + CAST(bit_count({folded} & {low}L) AS INT))")
    chance = 2.0 ** -bits
    return f"((1D - {differ} / {lanes}D - {chance}D) / {1 - chance}D)"


def least_estimate(percent: int = PERCENT, bits: int = BITS, lanes: int = BANDS * ROWS, errors: float = ERRORS) -> float:
    chance = 2.0 ** -bits
    match = chance + (1 - chance) * percent / 100
    return percent / 100 - errors * (match * (1 - match) / lanes) ** 0.5 / (1 - chance)


def similar(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` (a, b) whose sizes and signatures allow a link."""
    facts = sketches.select("id", "n_shingles", "sig")
    x = facts.select(F.col("id").alias("a"), F.col("n_shingles").alias("na"), F.col("sig").alias("sa"))
    y = facts.select(F.col("id").alias("b"), F.col("n_shingles").alias("nb"), F.col("sig").alias("sb"))
    allowed = (f"100 * least(na, nb) >= {percent} * greatest(na, nb) AND {estimate('sa', 'sb')} >= {least_estimate(percent)}")
    return pairs.join(x, "a").join(y, "b").where(F.expr(allowed)).select("a", "b")


def sets_of(ids: DataFrame, docs: DataFrame, name: str) -> DataFrame:
    """id, s: the full shingle sets of the documents ``ids`` (doc_id), written to the shared folder."""
    ids = hinted(stored(ids.distinct(), f"{name}-ids"))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(ids, "doc_id", "left_semi")
    return stored(shingles(texts), f"{name}-sets")


def confirmed(pairs: DataFrame, docs: DataFrame, percent: int, name: str) -> DataFrame:
    """The ``pairs`` (a, b) with ``percent`` * union <= 100 * intersection of the full sets."""
    pairs = stored(pairs, f"{name}-pairs")
    sets = sets_of(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")), docs, name)
    met = (pairs.join(sets.select(F.col("id").alias("a"), F.col("s").alias("s1")), "a")
           .join(sets.select(F.col("id").alias("b"), F.col("s").alias("s2")), "b")
           .withColumn("both", F.size(F.array_intersect("s1", "s2"))))
    return met.where(100 * F.col("both") >= percent * (F.size("s1") + F.size("s2") - F.col("both"))).select("a", "b")


#: A block holds about so many members, or shingles.
BLOCK_ROWS = 256
BLOCK_SHINGLES = 1 << 18


def block_pairs(members: DataFrame, payload: list[str], name: str) -> DataFrame:
    """low, l, r: every block of minor members of a group beside every block of the group.

    ``members``: low (the group), id, root, minor, n and ``payload``; l and r are
    arrays of structs. Blocks are dealt by a hash of the id, and the pairs of
    blocks by group and block, so a large group is spread over many tasks.
    """
    sizes = (members.groupBy("low").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("all_n"),
                                        F.count_if("minor").alias("minors")).where("minors > 0")
             .select("low", F.ceil(F.greatest(F.col("rows") / BLOCK_ROWS, F.col("all_n") / BLOCK_SHINGLES)).alias("n_blocks")))
    dealt = members.join(sizes, "low").withColumn("block", F.pmod(F.xxhash64("id"), F.col("n_blocks")))
    blocks = stored(dealt.groupBy("low", "n_blocks", "block").agg(
        F.collect_list(F.struct("id", "root", "n", "minor", *payload)).alias("r")), f"{name}-blocks")
    left = (blocks.select("low", "n_blocks", F.filter("r", lambda x: x["minor"]).alias("l")).where(F.size("l") > 0)
            .select("low", "l", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_blocks") - 1)).alias("block")))
    return left.join(blocks.select("low", "block", "r"), ["low", "block"]).select("low", "l", "r")


def _may_link(a: pa.StructArray, b: pa.StructArray, percent: int) -> np.ndarray:
    """Pairs (rows of a, rows of b) of different components whose sizes allow a link."""
    col = lambda x, f: x.field(f).to_numpy(zero_copy_only=False)
    na, nb = col(a, "n")[:, None], col(b, "n")[None, :]
    return (col(a, "root")[:, None] != col(b, "root")[None, :]) & (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb))


def with_partner(members: DataFrame, percent: int, bits: int = BITS, lanes: int = BANDS * ROWS) -> DataFrame:
    """low, id: members that the signatures leave a possible link to another component."""
    least, chance = least_estimate(percent), 2.0 ** -bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lows, ids = [], []
            for i in range(batch.num_rows):
                a, b = batch.column(1)[i].values, batch.column(2)[i].values
                x, y = (np.asarray(z.field("sig").flatten(), np.int64).reshape(len(z), -1).view(np.uint8) for z in (a, b))
                same = np.zeros((len(a), len(b)), np.int32)
                for k in range(0, len(a), 32):
                    differ = x[k:k + 32, None, :] ^ y[None, :, :]
                    for shift in range(0, 8, bits):
                        same[k:k + 32] += ((differ >> shift) & ((1 << bits) - 1) == 0).sum(axis=2, dtype=np.int32)
                may = _may_link(a, b, percent) & ((same / lanes - chance) / (1 - chance) >= least)
                for z, hit in ((a, may.any(axis=1)), (b, may.any(axis=0))):
                    found = z.field("id").to_numpy(zero_copy_only=False)[hit]
                    ids.append(found), lows.append(np.full(len(found), batch.column(0)[i].as_py()))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c) if c else [], pa.int64()) for c in (lows, ids)],
                                             names=["low", "id"])

    return block_pairs(members, ["sig"], "near-sig").mapInArrow(run, "low bigint, id bigint").distinct()


def linked_across(members: DataFrame, percent: int) -> DataFrame:
    """a, b: links between components, confirmed on the full sets (``s``); one for each member and other component."""
    def common(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
        """Intersection sizes of two blocks of sets, by products of 0/1 matrices over slices of the shared shingles."""
        shared = np.intersect1d(np.unique(np.concatenate(x)), np.unique(np.concatenate(y)), assume_unique=True)
        both = np.zeros((len(x), len(y)))
        for k in range(0, len(shared), 8192):
            part = shared[k:k + 8192]
            u, v = np.zeros((len(x), len(part)), np.float32), np.zeros((len(y), len(part)), np.float32)
            for m, sets in ((u, x), (v, y)):
                for row, s in enumerate(sets):
                    at = np.searchsorted(part, s)
                    at = at[part[np.minimum(at, len(part) - 1)] == s]
                    m[row, at] = 1
            both += u @ v.T
        return both

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int]] = []
            for i in range(batch.num_rows):
                a, b = batch.column(1)[i].values, batch.column(2)[i].values
                x, y = ([r.values.to_numpy(zero_copy_only=False) for r in z.field("s")] for z in (a, b))
                both = common(x, y)
                every = np.array([len(s) for s in x])[:, None] + np.array([len(s) for s in y])[None, :] - both
                ids, roots = (b.field(f).to_numpy(zero_copy_only=False) for f in ("id", "root"))
                for row, hit in zip(a.field("id").to_pylist(), _may_link(a, b, percent) & (100 * both >= percent * every)):
                    _, first = np.unique(roots[hit], return_index=True)
                    out.extend((row, int(other)) for other in ids[hit][first])
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in out], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return block_pairs(members, ["s"], "near-set").mapInArrow(run, "a bigint, b bigint")


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """id, root (smallest id reachable): nodes of ``links`` (a, b), by alternating large and small stars.

    Each pass rewrites the links in the shared folder; it ends when a pass changes
    none. A node of many links is aggregated map-side and joined by its one minimum.
    """
    links = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                   .where("u <> v").distinct(), name)
    mark = None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        links = stored(large.join(small, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                              F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*")
            .where("u <> v").distinct(), name)
        r = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
                      F.sum("v").cast("string")).first()
        if tuple(r) == mark:
            return links.select(F.col("u").alias("id"), F.col("v").alias("root"))
        mark = tuple(r)


def near_duplicates(docs: DataFrame, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row for each row of ``docs``."""
    sketches = stored(sketch(docs, bands, rows), "near-sketch")
    linkable = sketches.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = stored(linkable.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("rep")), "near-classes")
    # rows that share an id tie their classes together
    ties = (linkable.select("doc_id", "set_a", "set_b").join(classes, ["set_a", "set_b"])
            .where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    reps = stored(linkable.join(classes.select("set_a", "set_b", F.col("rep").alias("id")), ["set_a", "set_b"])
                  .where("doc_id = id").dropDuplicates(["set_a", "set_b"]).select("id", "n_shingles", "keys", "sig"),
                  "near-reps")
    members = reps.select("id", F.explode("keys").alias("key"))
    buckets = members.groupBy("key").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = stored(members.join(buckets.select("key", "low"), "key"), "near-buckets")
    star = shared.where("id <> low").select(F.col("low").alias("a"), F.col("id").alias("b")).distinct()
    links = stored(confirmed(similar(star, reps, percent), docs, percent, "near-star"), "near-links")

    # Groups that the stars left in several components: what is not with the smallest member meets the rest.
    roots = components(links, "near-first")
    low_roots = roots.select(F.col("id").alias("low"), F.col("root").alias("low_root"))
    placed = (shared.where("id <> low").select("low", "id").distinct().join(roots, "id", "left").join(low_roots, "low", "left")
              .select("low", "id", F.coalesce("root", "id").alias("root"), F.coalesce("low_root", "low").alias("low_root")))
    facts = reps.select("id", F.col("n_shingles").alias("n"), "sig")
    placed = stored(placed.withColumn("minor", F.col("root") != F.col("low_root")).drop("low_root"), "near-placed")
    open_groups = placed.where("minor").select("low").distinct()
    members = stored(placed.join(open_groups, "low", "left_semi").join(facts, "id"), "near-members")
    some = stored(with_partner(members, percent), "near-partners")
    left = members.drop("sig").join(some, ["low", "id"], "left_semi")
    sets = sets_of(some.select(F.col("id").alias("doc_id")), docs, "near-late")
    late = linked_across(left.join(sets, "id"), percent)
    tied = ties.join(sketches.groupBy("doc_id").agg(F.count_distinct("set_a", "set_b").alias("sets")).where("sets > 1")
                     .select(F.col("doc_id").alias("a")), "a", "left_semi")
    final = components(links.unionByName(late).unionByName(tied.select("a", "b")), "near-final")

    own = sketches.select("doc_id", "n_shingles", "set_a", "set_b")
    placed_docs = (own.join(classes, ["set_a", "set_b"], "left").withColumn(
        "rep", F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("rep")).otherwise(F.col("doc_id")))
        .join(final.select(F.col("id").alias("rep"), "root"), "rep", "left"))
    return (placed_docs.select("doc_id", "n_shingles", F.coalesce("root", "rep").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def keep_first(docs: DataFrame, **how) -> DataFrame:
    """One row of ``docs`` for each component (the smallest doc_id), same columns; rows without an id stay."""
    kept = stored(near_duplicates(docs, **how).where("kept AND doc_id IS NOT NULL").groupBy("doc_id")
                  .agg(F.count(F.lit(1)).alias("n")), "near-kept")
    once, twice = kept.where("n = 1").select("doc_id"), kept.where("n > 1").select("doc_id")
    out = docs.join(hinted(once), "doc_id", "left_semi").select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))
    if twice.isEmpty():
        return out
    return out.unionByName(docs.join(hinted(twice), "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(*docs.columns))
