"""Byte-level BPE by overlapping chunk encoding.

A text is cut into chunks that start every ``chunk_chars`` characters and reach
``overlap`` characters into the next one. Chunks are pre-tokenised on their own,
in parallel. The pattern only looks ahead, so two tokenisations that share one
boundary agree from there on: a chunk hands over to the next at the first
boundary both have past the next chunk's start (``stitch``). Where none lies in
the overlap (one run of letters, digits or white space longer than it), the
chunk's span runs on to the end of the text. The pieces between hand-overs are merged by rank; a document's ids are the concatenation.
Decoding concatenates the raw bytes of the ids.

Defined results: a null or empty text has no ids; a repeated row yields a row
each time; a null doc_id is kept; only ``doc_id`` and ``text`` of the input are
read, so other columns may have any name; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import small_batches

CHUNK_CHARS = 1 << 15
OVERLAP = 512
#: Characters behind a place that the pattern may look at to end a piece there.
AHEAD = 4
#: Pieces after which a worker's cache is emptied.
CACHE_PIECES = 250_000


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of base64 token and rank a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the adjacent pair of least rank is joined, leftmost first, until none has a rank."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    if len(piece) > 400:
        return merge_long(piece, ranks)
    parts = [piece[i:i + 1] for i in range(len(piece))]
    get, none = ranks.get, 1 << 60
    pair = [get(parts[i] + parts[i + 1], none) for i in range(len(parts) - 1)]
    while pair:
        low = min(pair)
        if low == none:
            break
        i = pair.index(low)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
        del pair[i]
        if i < len(pair):
            pair[i] = get(parts[i] + parts[i + 1], none)
        if i:
            pair[i - 1] = get(parts[i - 1] + parts[i], none)
    return [ranks[p] for p in parts]


def merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same for a long pre-token: a heap of pairs over a linked list, n log n instead of n squared."""
    import heapq

    n = len(piece)
    end = list(range(1, n + 1))  # part that starts at i ends at end[i]; 0 marks a part joined into an earlier one
    before = list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = end[i]
        if not j or j >= n or end[j] != stop:
            continue  # one of the two parts has changed since
        end[i], end[j] = stop, 0
        if stop < n:
            before[stop] = i
            r = ranks.get(piece[i:end[stop]])
            if r is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        k = before[i]
        if k >= 0:
            r = ranks.get(piece[k:stop])
            if r is not None:
                heapq.heappush(heap, (r, k, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = end[i]
    return out


class PieceIds(dict):
    """Pre-token (str) to its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks

    def __missing__(self, piece: str) -> bytes:
        ids = merge_piece(piece.encode("utf-8"), self.ranks)
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        if len(self) >= CACHE_PIECES:
            self.clear()
        if len(piece) <= 64:
            self[piece] = packed
        return packed


def handover(left: list[int], right: list[int], least: int) -> int | None:
    """First boundary, at ``least`` or later, that both sorted lists have."""
    have = set(right)
    return next((b for b in left if b >= least and b in have), None)


def _state(shared: dict) -> tuple:
    """Compiled pattern and piece cache of this worker (kept in the broadcast value)."""
    import regex

    if "cache" not in shared:
        shared["find"] = regex.compile(shared["pattern"])
        shared["cache"] = PieceIds(shared["ranks"])
        shared["bytes"] = {v: k for k, v in shared["ranks"].items()}
    return shared["find"], shared["cache"], shared["bytes"]


def encode(docs: DataFrame, ranks_path: str, pattern: str, chunk_chars: int = CHUNK_CHARS,
           overlap: int = OVERLAP, decoded: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids (binary, little-endian unsigned 32-bit): one row for each row of ``docs``.

    With ``decoded`` also the bytes that the ids decode to, made in the same pass
    (a second one would need as many Python workers again).

    Texts of one chunk are encoded where they are read. Longer ones become chunk
    rows that are dealt out over the cluster twice: for the boundaries of the
    overlaps, and for the pieces. ``ranks_path`` is a file of the vocabulary
    (bounded by its size, a parameter); the driver reads it and broadcasts it.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast({"ranks": load_ranks(ranks_path), "pattern": pattern})
    base = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, cache, token = _state(shared.value)
        for b in batches:
            ids = [b"".join(map(cache.__getitem__, find.findall(t))) for t in b.column(1).to_pylist()]
            raw = [bytes_of(x, token) if decoded else None for x in ids]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()),
                 pa.array(raw, pa.binary())], names=["doc_id", "n_tokens", "ids", "decoded"])

    id_type = base.schema["doc_id"].dataType.simpleString()
    result = f"doc_id {id_type}, n_tokens bigint, ids binary, decoded binary"
    short = base.where(F.length("text") <= chunk_chars).mapInArrow(whole, result)
    long = base.where(F.length("text") > chunk_chars)
    # Rows of equal id and text are interchangeable: one is encoded, and counted.
    key = ["doc_id", "h"]
    long = (long.withColumn("h", F.sha2("text", 256)).groupBy(*key)
            .agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies")))
    starts = F.sequence(F.lit(0), F.length("text") - 1, F.lit(chunk_chars))
    chunks = (long.select(*key, "copies", F.col("text"), F.posexplode(starts).alias("k", "start"))
              .select(*key, "copies", "k", "start",
                      F.expr(f"substring(text, start + 1, {chunk_chars + overlap})").alias("part"),
                      (F.col("start") + chunk_chars >= F.length("text")).alias("last"))
              .repartition(F.col("h"), F.col("k")))

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Boundaries (text offsets) in the chunk's first and last ``overlap`` characters."""
        find, _, _ = _state(shared.value)
        for b in batches:
            rows = b.select(["start", "part", "last"]).to_pylist()
            head, tail = [], []
            for r in rows:
                s, n = r["start"], len(r["part"])
                at = [m.start() for m in find.finditer(r["part"])]
                # a piece that reaches the cut may go on behind it, and a contraction can be cut in two
                head.append([s + x for x in at if x <= overlap])
                tail.append([] if r["last"] else [s + x for x in at if chunk_chars <= x < n - AHEAD])
            names = [n for n in b.schema.names if n != "part"]
            yield pa.RecordBatch.from_arrays(
                [b.column(n) for n in names] + [pa.array(x, pa.list_(pa.int64())) for x in (head, tail)],
                names=names + ["head", "tail"])

    cut = chunks.mapInArrow(edges, f"doc_id {id_type}, h string, copies bigint, k int, start int, last boolean, "
                                   "head array<bigint>, tail array<bigint>")

    def stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Spans [start, stop) between hand-overs; stop -1 is the end of the text."""
        for b in batches:
            rows = b.to_pylist()
            out = {n: [] for n in ("doc_id", "h", "copies", "span", "from", "to")}
            for r in rows:
                parts = sorted(r["parts"], key=lambda x: x["k"])
                begin = 0
                for x, nxt in zip(parts, parts[1:] + [None]):
                    to = None if nxt is None else handover(x["tail"], nxt["head"], nxt["start"])
                    for n, v in (("doc_id", r["doc_id"]), ("h", r["h"]), ("copies", r["copies"]),
                                 ("span", x["k"]), ("from", begin), ("to", -1 if to is None else to)):
                        out[n].append(v)
                    if to is None:
                        break  # the end, or no common boundary: later hand-overs prove nothing about this span
                    begin = to
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["doc_id"], b.schema.field("doc_id").type), pa.array(out["h"], pa.string()),
                 pa.array(out["copies"], pa.int64()), pa.array(out["span"], pa.int32()),
                 pa.array(out["from"], pa.int64()), pa.array(out["to"], pa.int64())],
                names=["doc_id", "h", "copies", "span", "start", "stop"])

    spans = (cut.groupBy(*key, "copies")
             .agg(F.collect_list(F.struct("k", "start", "head", "tail")).alias("parts"))
             .mapInArrow(stitch, f"doc_id {id_type}, h string, copies bigint, span int, start bigint, stop bigint"))
    pieces = (spans.alias("s").join(long.select(F.col("doc_id").alias("d"), F.col("h").alias("g"), "text").alias("t"),
                                    F.col("s.doc_id").eqNullSafe(F.col("t.d")) & (F.col("s.h") == F.col("t.g")))
              .select("doc_id", "h", "copies", "span",
                      F.expr("CASE WHEN stop < 0 THEN substring(text, CAST(start AS INT) + 1) "
                             "ELSE substring(text, CAST(start AS INT) + 1, CAST(stop - start AS INT)) END").alias("part"),
                      F.expr(f"CASE WHEN stop < 0 THEN '' ELSE substring(text, CAST(stop AS INT) + 1, {AHEAD}) END")
                      .alias("ahead"))
              .repartition(F.col("h"), F.col("span")))

    def encode_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, cache, token = _state(shared.value)
        for b in batches:
            ids = []
            for part, ahead in zip(b.column("part").to_pylist(), b.column("ahead").to_pylist()):
                # what follows is needed by the look-ahead only; a boundary lies between the two
                out, n = [], len(part)
                for m in find.finditer(part + ahead):
                    if m.start() >= n:
                        break
                    out.append(cache[m.group()])
                ids.append(b"".join(out))
            yield pa.RecordBatch.from_arrays(
                [b.column(n) for n in ("doc_id", "h", "copies", "span")]
                + [pa.array(ids, pa.binary()), pa.array([bytes_of(x, token) if decoded else None for x in ids], pa.binary())],
                names=["doc_id", "h", "copies", "span", "ids", "decoded"])

    coded = pieces.mapInArrow(encode_pieces, f"doc_id {id_type}, h string, copies bigint, span int, ids binary, decoded binary")
    joined = (coded.groupBy(*key, "copies").agg(F.sort_array(F.collect_list(F.struct("span", "ids", "decoded"))).alias("p"))
              .select("doc_id", "copies", F.expr("aggregate(p, X'', (a, x) -> a || x.ids)").alias("ids"),
                      F.expr("aggregate(p, X'', (a, x) -> a || x.decoded)").alias("decoded"))
              .select("doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), "ids", "decoded",
                      F.explode(F.expr("sequence(1, CAST(copies AS INT))")).alias("copy")).drop("copy"))
    both = short.unionByName(joined)
    return both if decoded else both.drop("decoded")


def bytes_of(ids: bytes, token: dict[int, bytes]) -> bytes:
    """The raw bytes of packed ids, one token after another."""
    return b"".join(map(token.__getitem__, memoryview(ids).cast("I"))) if ids else b""


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``encoded`` (with ``ids``) and ``decoded``: the raw bytes of the ids, one after another."""
    small_batches(encoded.sparkSession)
    shared = encoded.sparkSession.sparkContext.broadcast({"ranks": load_ranks(ranks_path), "pattern": ""})
    at = encoded.columns.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        if "bytes" not in table:
            table["bytes"] = {v: k for k, v in table["ranks"].items()}
        for b in batches:
            raw = [bytes_of(x or b"", table["bytes"]) for x in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(b.columns + [pa.array(raw, pa.binary())], names=b.schema.names + ["decoded"])

    return encoded.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
                              + ", decoded binary")


def digests(docs: DataFrame, ranks_path: str, pattern: str, **how) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row (the round trip as digests)."""
    return (encode(docs, ranks_path, pattern, decoded=True, **how)
            .select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                    F.sha2("decoded", 256).alias("decoded_sha256")))


def reference_ids(text: str, ranks: dict[bytes, int], pattern: str) -> list[int]:
    """Ids of one text in one pass, for tests."""
    import regex

    return [i for p in regex.findall(pattern, text) for i in merge_piece(p.encode("utf-8"), ranks)]
