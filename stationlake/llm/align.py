"""Cross-tokenizer alignment by lockstep vectorised merging.

Every text is encoded by tokenizer A (byte-level BPE, a JSON vocabulary) as space +
text, and by tokenizer B (sentence pieces with byte fallback), which adds the space
itself. Both give byte offsets where their tokens end. A link is a pair of tokens, one
of each side, that end together; the offset is a cut, and the tokens between two cuts
are a group: the least stretch that both sides cover with whole tokens.

``lockstep`` finds all links of a batch at once. Documents are dealt into lanes of at
most ``LANE`` tokens of A, so that a long text doesn't outlast the rest alone; one
NumPy state vector holds each lane's pointers into A and B. A step compares the two
ends of every lane, emits the links (and so the cuts) where they agree, and moves the
pointer of the smaller end, or both. Finished lanes are compacted away.

``link_counts`` counts each id pair over the whole corpus, and ``scored`` joins the
counts back to every text. The counts are one row an id pair; they are broadcast only
if their measured size allows, else joined by a shuffle that may split hot pairs.

Defined results: a text that is null or empty, or whose tokens of A or B don't spell
space + text byte for byte, has no tokens, zeros and an empty digest; the strings of
special tokens inside a text are ordinary text; every row of the input gives one row,
whatever its doc_id (null, repeated); only ``doc_id`` and ``text`` are read, so other
columns may have any name; an empty table gives an empty result. Long texts are
encoded whole; a worker holds ``BATCH_BYTES`` of text, or one longer text, at a time.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import hinted, small_batches, stored

#: Tokens of A in a lane of the lockstep.
LANE = 64
#: Bytes of text that are encoded and aligned at a time.
BATCH_BYTES = 1 << 18


def byte_alphabet() -> dict[str, int]:
    """Characters of a byte-level vocabulary to bytes: printable Latin-1 stands for itself, the rest from U+0100 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class ByteLevel:
    """Tokenizer A from its JSON file: ``spelt`` (bytes of each id) and ``encode``.

    Where the file's merges make the ids in order, rank merges give the same ids, and
    the faster rank encoder runs; for any other file the file's own library does.
    """

    def __init__(self, file: bytes, pattern: str):
        import tiktoken
        import tokenizers

        spec = json.loads(file)
        alphabet, model = byte_alphabet(), spec["model"]
        special = {x["id"]: x["content"].encode() for x in spec["added_tokens"]}
        ids = {bytes(alphabet[c] for c in token): i for token, i in model["vocab"].items() if i not in special}
        self.spelt = [b""] * (1 + max([*ids.values(), *special]))
        for token, i in [*ids.items(), *((t, i) for i, t in special.items())]:
            self.spelt[i] = token
        self.library = tokenizers.Tokenizer.from_str(file.decode())
        self.library.encode_special_tokens = True
        pairs = (x.split(" ") if isinstance(x, str) else x for x in model["merges"])
        made = [model["vocab"][a + b] for a, b in pairs]
        as_ranks = (made == list(range(256, 256 + len(made))) and len(ids) == 256 + len(made)
                    and not spec["normalizer"] and spec["pre_tokenizer"] == {
                        "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True})
        self.ranks = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ids, special_tokens={}) if as_ranks else None

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if self.ranks is not None:
            return [np.asarray(self.ranks.encode_ordinary(t), np.int32) for t in texts]
        return [np.asarray(e.ids, np.int32) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]


class Pieces:
    """Tokenizer B: ``spelt`` and ``encode``."""

    def __init__(self, file: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=file)
        self.spelt = [bytes([int(piece[3:-1], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()
                      for i, piece in ((i, self.model.id_to_piece(i)) for i in range(self.model.vocab_size()))]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.asarray(x, np.int32) for x in self.model.encode(texts, num_threads=1)]


def lockstep(a_ends: np.ndarray, b_ends: np.ndarray, a_from: np.ndarray, a_to: np.ndarray,
             lane: int = LANE) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a_ends`` and ``b_ends`` (rising) of the ends that both have, in order.

    Document d has the tokens [a_from[d], a_to[d]) of A; both sides' documents end at the same offsets.
    """
    n_lanes = -(-(a_to - a_from) // lane)
    doc = np.repeat(np.arange(len(a_from)), n_lanes)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(n_lanes) - n_lanes, n_lanes)
    at_a = a_from[doc] + nth * lane
    stop = np.minimum(at_a + lane, a_to[doc])
    # a lane goes on behind the last end of the lane before it
    at_b = np.searchsorted(b_ends, np.where(at_a > 0, a_ends[at_a - 1], 0), side="right")
    found_a, found_b = [], []
    while len(at_a):
        ea, eb = a_ends[at_a], b_ends[at_b]
        both = ea == eb
        found_a.append(at_a[both])
        found_b.append(at_b[both])
        at_a = at_a + (ea <= eb)
        at_b = at_b + (eb <= ea)
        going = at_a < stop
        at_a, at_b, stop = at_a[going], at_b[going], stop[going]
    if not found_a:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    a, b = np.concatenate(found_a), np.concatenate(found_b)
    order = np.argsort(a, kind="stable")
    return a[order], b[order]


def align_batch(a_ids: list[np.ndarray], b_ids: list[np.ndarray], a_len: np.ndarray, b_len: np.ndarray) -> dict:
    """Flat ids of both sides and their links for documents whose sides spell the same bytes.

    a, b: flat ids; a_end, b_end: flat place behind each document's last token; link_a, link_b: flat places of the
    linked tokens; link_end: the number of links up to each document's end.
    """
    a = np.concatenate(a_ids) if a_ids else np.empty(0, np.int32)
    b = np.concatenate(b_ids) if b_ids else np.empty(0, np.int32)
    a_end = np.cumsum([len(x) for x in a_ids], dtype=np.int64)
    b_end = np.cumsum([len(x) for x in b_ids], dtype=np.int64)
    link_a, link_b = lockstep(np.cumsum(a_len[a]), np.cumsum(b_len[b]), np.r_[0, a_end[:-1]].astype(np.int64), a_end)
    return {"a": a, "b": b, "a_end": a_end, "b_end": b_end, "link_a": link_a, "link_b": link_b,
            "link_end": np.searchsorted(link_a, a_end)}


class Spelling:
    """The text ``a1,a2|b1;a3|b2,b3`` of a batch's groups, as one digest a document."""

    def __init__(self, n_a: int, n_b: int):
        self.n_a, self.n_b = n_a, n_b
        self.words = ([b"%d," % i for i in range(n_a)] + [b"%d|" % i for i in range(n_a)]
                      + [b"%d," % i for i in range(n_b)] + [b"%d;" % i for i in range(n_b)])

    def digests(self, x: dict) -> list[str]:
        n, m = len(x["a"]), len(x["b"])
        ends_a, ends_b = np.zeros(n, np.int64), np.zeros(m, np.int64)
        ends_a[x["link_a"]], ends_b[x["link_b"]] = 1, 1
        group_a, group_b = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b
        before_a = np.r_[0, x["link_b"] + 1]  # tokens of B in the groups before one
        upto_b = x["link_a"] + 1  # tokens of A in the groups up to one
        word = np.empty(n + m, np.int64)
        word[np.arange(n) + before_a[group_a]] = x["a"] + self.n_a * ends_a
        word[np.arange(m) + upto_b[group_b]] = 2 * self.n_a + x["b"] + self.n_b * ends_b
        parts = [self.words[i] for i in word.tolist()]
        out, begin = [], 0
        for end in (x["a_end"] + x["b_end"]).tolist():
            out.append(hashlib.sha256(b"".join(parts[begin:end])[:-1]).hexdigest())
            begin = end
        return out


def _of(texts: list[str | None]) -> Iterator[list[int]]:
    """Places of the texts that are neither null nor empty, ``BATCH_BYTES`` at a time."""
    some, size = [], 0
    for i, t in enumerate(texts):
        if not t:
            continue
        if some and size + len(t) > BATCH_BYTES:
            yield some
            some, size = [], 0
        some.append(i)
        size += len(t)
    if some:
        yield some


def align(docs: DataFrame, a_path: str, b_path: str, pattern: str, tokens: bool = True, digest: bool = False) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, link_a and link_b (the ids of each linked
    pair, in order of the text); with ``tokens`` also a_ids, b_ids, a_sizes and b_sizes (tokens of each side in each
    group) and cuts (byte offsets in space + text); with ``digest`` also groups_sha256.

    The paths and ``pattern`` (which splits texts before A's merges) are parameters; the driver reads the two files,
    whose size bounds the broadcast. A worker keeps what it makes of them beside the broadcast value.
    """
    spark = docs.sparkSession
    small_batches(spark)
    with open(a_path, "rb") as f, open(b_path, "rb") as g:
        shared = spark.sparkContext.broadcast({"files": (f.read(), g.read())})
    base = docs.select("doc_id", "text")
    fields = [("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
              ("link_a", pa.list_(pa.int32())), ("link_b", pa.list_(pa.int32()))]
    if tokens:
        fields += [("a_ids", pa.list_(pa.int32())), ("b_ids", pa.list_(pa.int32())), ("a_sizes", pa.list_(pa.int32())),
                   ("b_sizes", pa.list_(pa.int32())), ("cuts", pa.list_(pa.int64()))]
    if digest:
        fields += [("groups_sha256", pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = shared.value
        if "a" not in state:
            a, b = ByteLevel(state["files"][0], pattern), Pieces(state["files"][1])
            state.update(a=a, b=b, a_len=np.array([len(x) for x in a.spelt], np.int64),
                         b_len=np.array([len(x) for x in b.spelt], np.int64),
                         spelling=Spelling(len(a.spelt), len(b.spelt)) if digest else None)
        a, b = state["a"], state["b"]
        none = np.empty(0, np.int32)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            out = {n: [0 if t == pa.int64() else "" if t == pa.string() else none] * len(texts) for n, t in fields}
            for places in _of(texts):
                lines = [" " + texts[i] for i in places]
                a_ids, b_ids = a.encode(lines), b.encode([texts[i] for i in places])
                good = [k for k, (x, y) in enumerate(zip(a_ids, b_ids))
                        if (raw := lines[k].encode()) == b"".join([a.spelt[t] for t in x.tolist()])
                        and raw == b"".join([b.spelt[t] for t in y.tolist()])]
                if not good:
                    continue
                x = align_batch([a_ids[k] for k in good], [b_ids[k] for k in good], state["a_len"], state["b_len"])
                pair_a, pair_b = x["a"][x["link_a"]], x["b"][x["link_b"]]
                sums = state["spelling"].digests(x) if digest else None
                begin, link = 0, 0
                for g, k in enumerate(good):
                    i, to = places[k], int(x["link_end"][g])
                    out["n_a"][i], out["n_b"][i] = len(a_ids[k]), len(b_ids[k])
                    out["n_groups"][i] = out["n_links"][i] = to - link
                    out["link_a"][i], out["link_b"][i] = pair_a[link:to], pair_b[link:to]
                    if digest:
                        out["groups_sha256"][i] = sums[g]
                    if tokens:
                        ends = x["link_a"][link:to] - begin
                        out["a_ids"][i], out["b_ids"][i] = a_ids[k], b_ids[k]
                        out["a_sizes"][i] = np.diff(ends, prepend=-1).astype(np.int32)
                        out["b_sizes"][i] = np.diff(x["link_b"][link:to], prepend=x["b_end"][g] - len(b_ids[k]) - 1).astype(np.int32)
                        out["cuts"][i] = np.cumsum(state["a_len"][a_ids[k]])[ends]
                    begin, link = int(x["a_end"][g]), to
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(out[n], t) for n, t in fields)],
                                             names=["doc_id", *out])

    kinds = {pa.int64(): "bigint", pa.string(): "string", pa.list_(pa.int32()): "array<int>", pa.list_(pa.int64()): "array<bigint>"}
    id_type = base.schema["doc_id"].dataType.simpleString()
    return base.mapInArrow(run, f"doc_id {id_type}, " + ", ".join(f"{n} {kinds[t]}" for n, t in fields))


def link_counts(aligned: DataFrame) -> DataFrame:
    """a, b, n (links of the pair over the corpus), best (no id of A is linked with this id of B more often)."""
    pairs = (aligned.select(F.explode(F.arrays_zip("link_a", "link_b")).alias("p"))
             .groupBy(F.col("p.link_a").alias("a"), F.col("p.link_b").alias("b")).agg(F.count(F.lit(1)).alias("n")))
    pairs = stored(pairs, "align-pairs")
    most = pairs.groupBy("b").agg(F.max("n").alias("most"))
    return stored(pairs.join(most, "b").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best")), "align-counts")


def scored(docs: DataFrame, a_path: str, b_path: str, pattern: str, **limits) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256: one row for each row of ``docs``."""
    aligned = align(docs, a_path, b_path, pattern, tokens=False, digest=True)
    aligned = stored(aligned.withColumn("row", F.monotonically_increasing_id()), "align-docs")
    counts = hinted(link_counts(aligned), **limits)
    facts = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    links = (aligned.where("n_links > 0").select("row", F.explode(F.arrays_zip("link_a", "link_b")).alias("p"))
             .select("row", F.col("p.link_a").alias("a"), F.col("p.link_b").alias("b")))
    sums = (links.join(counts, ["a", "b"]).groupBy("row")
            .agg(F.count_if("best").alias("n_best"), F.sum("n").alias("count_sum")))
    zero = F.lit(0).cast("bigint")
    return (aligned.select(*facts).join(sums, "row", "left")
            .select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
                    F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256"))
