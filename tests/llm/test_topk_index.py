import math
import random

from pyspark.sql import functions as F

from stationlake.llm import topk_index as t


def by_hand(rows, queries, k):
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (q, v) in enumerate(good):
        if queries(q):
            others = [(i, w) for m, (i, w) in enumerate(good) if m != n and len(w) == len(v)]
            found = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in others)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found)]
    return sorted(out)


def run(docs, k, **how):
    out = t.search(docs.where(F.col("vec_id") % 50 == 0), docs, k=k, **how)
    return sorted(map(tuple, out.select("query_id", "rank", "vec_id", "score").collect()))


def test_equals_brute_force(spark):
    rng = random.Random(1)
    centre = [[rng.gauss(0, 1) for _ in range(16)] for _ in range(5)]
    rows = [(i, [c + rng.gauss(0, 0.3) for c in centre[i % 5]]) for i in range(900)]
    rows += [(1000 + i, rows[3][1]) for i in range(60)]  # one vector many times: ties
    rows += [(2000, None), (2050, [1.0, None] + [0.0] * 14), (2100, [float("nan")] * 16), (2150, [float("inf")] * 16),
             (2200, [0.5] * 3), (2201, [0.25] * 3), (2250, []), (2251, []), (2300, [0.0] * 16), (None, [1.0] * 16)]
    docs = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("score", F.lit("clash")).repartition(4)
    want = by_hand(rows, lambda i: i % 50 == 0, 5)
    assert run(docs, 5) == want
    assert run(docs, 5, shard_rows=100, query_rows=3) == want


def test_fewer_candidates_than_k_and_none(spark):
    docs = spark.createDataFrame([(0, [1.0, 2.0]), (1, [2.0, 1.0])], "vec_id bigint, embedding array<float>")
    assert run(docs, 5) == [(0, 1, 1, 2 * 256 * 256 * 2)]
    assert run(docs.where("false"), 5) == []


def test_sf(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in docs.collect()]
    assert run(docs, 5) == by_hand(rows, lambda i: i % 50 == 0, 5)


def test_rows_that_share_an_id(spark):
    """Every query row is answered; only its own row is left out, of equal rows one."""
    rows = [(0, [1.0, 0.0]), (0, [3.0, 1.0]), (1, [2.0, 0.5]), (2, [0.0, 9.0]), (50, [1.0, 1.0]), (50, [1.0, 1.0]), (50, [1.0, 1.0])]
    docs = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    want = by_hand(rows, lambda i: i % 50 == 0, 3)
    assert run(docs, 3) == want == run(docs, 3, shard_rows=2, query_rows=2) and len(want) == 15


def test_floors_across_shards_with_hot_ids(spark):
    rng = random.Random(4)
    rows = [(100 if i % 3 == 0 else i, [rng.gauss(0, 1 + (i % 7)) for _ in range(8)]) for i in range(600)]
    docs = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    want = by_hand(rows, lambda i: i % 50 == 0, 5)
    assert run(docs, 5, shard_rows=64, query_rows=16) == want
