"""Exact top-k inner products with an impact-ordered, score-at-a-time index.

Vectors are dealt into shards of about ``SHARD_ROWS`` rows. In a shard, each
dimension's values fall into ``LEVELS`` ranges; a (dimension, range) is a posting
segment: the rows whose value lies there, with the least and largest such value.
For a query a segment's impact is the most it can add to a score, above the least
that any segment of its dimension can. Segments are taken in descending impact;
after each layer, the best rows so far are scored exactly, which gives a floor,
and a row is a possible member while its sum plus the largest impact left in each
dimension reaches that floor. Processing stops when few rows remain possible, or
all segments are done; the possible members are scored exactly. Nothing is
dropped without that proof, so the result is exact for any data.

Queries travel in blocks of about ``QUERY_ROWS``. A first pass takes each block to
one shard; the score of rank ``k`` + 1 there is a floor for the whole search. It goes
along to every other shard, which proves its rows out against it from the start and
returns only rows that reach it. A ranked window merges them.

Defined results: vectors that are null or hold a null or non-finite component,
and rows without an id, take no part; a vector is compared with those of its own
length; every query row is answered, also where rows share an id; a row of the
query's own id and vector is left out once (the query's own row), other rows of that
id are candidates; repeated rows each count; ties go to the smaller id; with fewer
candidates than ``k`` all return; an empty table gives an empty result. Rows are dealt
by a hash of id and row, so an id that many rows share is spread. Only the id and
vector columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationlake.llm.common import stored

SHARD_ROWS = 4096
QUERY_ROWS = 256
LEVELS = 16
LAYERS = 8
SCALE = 256


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, v (array of long), dim: rows that take part."""
    good = F.expr("vec_id IS NOT NULL AND embedding IS NOT NULL AND "
                  "NOT exists(embedding, x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity'))")
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    return (vectors.where(good).select(F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("v"))
            .withColumn("dim", F.size("v")))


def packed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, ids and values (packed 64-bit integers): one row for each group of vectors."""
    sets = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("vec_id", "v"))).alias("rows"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, values = [], []
            col = b.column(len(keys))
            for i in range(b.num_rows):
                one = col[i].values
                ids.append(np.asarray(one.field(0), np.int64).tobytes())
                flat = one.field(1).flatten() if len(one) else pa.array([], pa.int64())
                values.append(np.asarray(flat, np.int64).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(k) for k in range(len(keys))]
                                             + [pa.array(ids, pa.binary()), pa.array(values, pa.binary())],
                                             names=keys + ["ids", "vals"])

    fields = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys)
    return sets.mapInArrow(run, f"{fields}, ids binary, vals binary")


class Shard:
    """Posting segments of one shard."""

    def __init__(self, ids: bytes, values: bytes, dim: int):
        self.ids = np.frombuffer(ids, np.int64)
        self.v = np.frombuffer(values, np.int64).reshape(len(self.ids), dim)
        n = len(self.ids)
        low, high = self.v.min(axis=0), self.v.max(axis=0)
        level = (self.v - low) * LEVELS // (high - low + 1)
        seg = (level + np.arange(dim) * LEVELS).T.ravel()  # dimension by dimension
        order = np.argsort(seg, kind="stable")
        flat = self.v.T.ravel()[order]
        seg = seg[order]
        self.begin = np.flatnonzero(np.r_[True, seg[1:] != seg[:-1]]) if len(seg) else np.empty(0, np.int64)
        self.end = np.r_[self.begin[1:], len(seg)]
        self.rows = order % n if n else order
        self.dim_of = seg[self.begin] // LEVELS
        self.low = np.minimum.reduceat(flat, self.begin) if len(seg) else flat
        self.high = np.maximum.reduceat(flat, self.begin) if len(seg) else flat
        self.dim = dim

    def best(self, q: np.ndarray, k: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the ``k`` best rows that reach ``floor``, best first."""
        possible = np.arange(len(self.ids))
        if len(possible) > 4 * k and self.dim:
            possible = self.possible(q, k, floor)
        score = self.v[possible] @ q
        reach = score >= floor
        possible, score = possible[reach], score[reach]
        order = np.lexsort((self.ids[possible], -score))[:k]
        return possible[order], score[order]

    def possible(self, q: np.ndarray, k: int, floor_: float) -> np.ndarray:
        """Rows that can be among the ``k`` best and reach ``floor_``."""
        at = q[self.dim_of]
        most, least = np.maximum(at * self.low, at * self.high), np.minimum(at * self.low, at * self.high)
        base = np.full(self.dim, np.iinfo(np.int64).max)
        np.minimum.at(base, self.dim_of, least)
        impact = most - base[self.dim_of]
        order = np.argsort(-impact, kind="stable")
        done = np.cumsum((self.end - self.begin)[order])
        cuts = np.unique(np.searchsorted(done, np.arange(1, LAYERS + 1) * (done[-1] / LAYERS)))
        left = impact.astype(np.float64)  # exact: far below 2**53
        sums = np.zeros(len(self.ids))
        start = 0
        rest = np.zeros(self.dim)
        np.maximum.at(rest, self.dim_of, left)
        if rest.sum() + base.sum() < floor_:
            return order[:0]  # no row of this shard can reach it
        for stop in np.minimum(cuts + 1, len(order)):
            layer = order[start:stop]
            rows = np.concatenate([self.rows[b:e] for b, e in zip(self.begin[layer], self.end[layer])])
            sums += np.bincount(rows, np.repeat(left[layer], self.end[layer] - self.begin[layer]), len(sums))
            start = stop
            rest = np.zeros(self.dim)
            np.maximum.at(rest, self.dim_of[order[start:]], left[order[start:]])
            some = np.argpartition(sums, -2 * k)[-2 * k:]
            floor_ = max(floor_, np.sort(self.v[some] @ q)[-k])
            can = sums + (rest.sum() + base.sum()) >= floor_
            if can.sum() <= 8 * k:
                break
        return np.flatnonzero(can)


def search(queries: DataFrame, vectors: DataFrame, k: int = 5, scale: int = SCALE, shard_rows: int = SHARD_ROWS,
           query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` best of ``vectors`` for each row of ``queries``."""
    n_shards = max(1, -(-vectors.count() // shard_rows))
    n_blocks = max(1, -(-queries.count() // query_rows))

    def dealt(df: DataFrame, name: str, n: int) -> DataFrame:
        # a written table's row numbers, so that an executor's loss can't deal a row twice
        rows = stored(quantised(df, scale).withColumn("row", F.monotonically_increasing_id()), f"topk-{name}-rows")
        rows = rows.withColumn(name, F.pmod(F.xxhash64("vec_id", "row"), F.lit(n)).cast("int"))
        return stored(packed(rows, [name, "dim"]), f"topk-{name}")

    index = dealt(vectors, "shard", n_shards)
    blocks = (dealt(queries, "block", n_blocks).withColumnRenamed("ids", "q_ids").withColumnRenamed("vals", "q_vals")
              .withColumn("floors", F.lit(None).cast("binary")))
    best = k + 1  # the query's own row may be among them

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, shard = None, None
        for b in batches:
            for r in b.to_pylist():
                if key != (r["shard"], r["dim"]):
                    key, shard = (r["shard"], r["dim"]), Shard(r["ids"], r["vals"], r["dim"])
                ids = np.frombuffer(r["q_ids"], np.int64)
                floors = np.full(len(ids), -np.inf) if r["floors"] is None else np.frombuffer(r["floors"])
                place, asked, found, score, same, high = [], [], [], [], [], []
                for i, (own, q, least) in enumerate(zip(ids, np.frombuffer(r["q_vals"], np.int64).reshape(len(ids), r["dim"]), floors)):
                    at, points = shard.best(q, best, least)
                    place.append(np.full(len(at), i, np.int32)), asked.append(np.full(len(at), own)), found.append(shard.ids[at]), score.append(points)
                    same.append((shard.ids[at] == own) & (shard.v[at] == q).all(axis=1))
                    high.append(points[k] if len(points) > k else least)
                flat = [np.concatenate(x) if x else [] for x in (place, asked, found, score, same)]
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["block"]], pa.int32()), pa.array([r["dim"]], pa.int32()), pa.array([np.array(high, float).tobytes()])]
                    + [pa.array([x], pa.list_(t)) for x, t in zip(flat, kinds)],
                    names=["block", "dim", "floors", "place", "query_id", "found", "score", "same"])

    columns = ["shard", "dim", "ids", "vals", "block", "q_ids", "q_vals", "floors"]
    result = ("block int, dim int, floors binary, place array<int>, query_id array<bigint>, found array<bigint>, "
              "score array<bigint>, same array<boolean>")

    def searched(sent: DataFrame) -> DataFrame:
        return sent.join(index, ["shard", "dim"]).select(*columns).mapInArrow(run, result)

    # each block's first shard; where that shard has no vector of this length there is no floor
    first = F.pmod(F.col("block"), F.lit(n_shards))
    pilot = stored(searched(blocks.withColumn("shard", first)), "topk-pilot")
    floors = pilot.select("block", "dim", F.col("floors").alias("least"))
    rest = (blocks.join(floors, ["block", "dim"], "left").withColumn("floors", F.col("least")).drop("least")
            .withColumn("shard", F.explode(F.expr(f"filter(sequence(0, {n_shards - 1}), s -> s != pmod(block, {n_shards}))"))))
    near = pilot.unionByName(searched(rest)) if n_shards > 1 else pilot
    rows = near.select("block", "dim", F.explode(F.arrays_zip("place", "query_id", "found", "score", "same")).alias("r")).select("block", "dim", "r.*")
    of_query = Window.partitionBy("block", "dim", "place").orderBy(F.desc("score"), "found", F.desc("same"))
    rows = rows.withColumn("n", F.row_number().over(of_query)).where(F.col("n") <= best)
    own = F.sum(F.col("same").cast("int")).over(of_query.rowsBetween(Window.unboundedPreceding, 0))
    kept = rows.withColumn("own", own).where(~(F.col("same") & (F.col("own") == 1)))
    rank = F.col("n") - F.least("own", F.lit(1))
    return kept.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", F.col("found").alias("vec_id"), "score")
