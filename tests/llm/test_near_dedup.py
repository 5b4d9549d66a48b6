import random
import re

from stationlake.llm import near_dedup as nd


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}


def by_hand(rows):
    sets = [(d, shingles(t)) for d, t in rows]
    root = {d: d for d, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return [(d, len(s), find(d)) for d, s in sets]


def key(r):
    return tuple(-1 if v is None else v for v in r)


def test_components_equal_brute_force(awkward, pairs_of):
    out = nd.near_duplicates(awkward).collect()
    want = sorted((key(r) for r in by_hand(pairs_of)))
    assert sorted(key((r["doc_id"], r["n_shingles"], r["component_id"])) for r in out) == want
    assert all(r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"]) for r in out)
    kept = nd.keep_first(awkward)
    assert kept.columns == awkward.columns
    assert sorted(key((r["doc_id"],)) for r in kept.collect()) == sorted(
        {key((r["doc_id"],)) for r in out if r["kept"]})


def test_chains_and_hot_groups_equal_brute_force(spark):
    """Near copies in chains whose ends are unlike, and many texts around one shared passage."""
    rng = random.Random(3)
    word = lambda: f"v{rng.randrange(5000)}"
    rows, step = [], [word() for _ in range(90)]
    for i in range(40):  # each differs from the one before by a few words
        rows.append((i, " ".join(step)))
        for _ in range(2):
            step[rng.randrange(90)] = word()
    shared = [word() for _ in range(60)]
    rows += [(100 + i, " ".join(shared + [word() for _ in range(rng.randrange(5, 60))])) for i in range(80)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in nd.near_duplicates(docs).collect())
    assert got == sorted(by_hand(rows))


def test_estimate_is_collision_corrected(spark):
    import numpy as np

    flip, factor = nd.permutations(nd.BANDS * nd.ROWS)
    np.seterr(over="ignore")
    rng = np.random.default_rng(1)
    for want in (0.3, 0.6, 0.9):
        got = []
        for _ in range(20):
            both, only = rng.integers(0, 1 << 63, int(1000 * want), np.uint64), rng.integers(0, 1 << 63, 1000 - int(1000 * want), np.uint64)
            half = len(only) // 2
            a, b = np.r_[both, only[:half]], np.r_[both, only[half:]]
            x, y = (nd.packed_bits(nd.minima(s, flip, factor)).tolist() for s in (a, b))
            row = spark.createDataFrame([(x, y)], "x array<bigint>, y array<bigint>").selectExpr(f"{nd.estimate('x', 'y')} AS e")
            got.append(row.first()["e"])
        assert abs(sum(got) / len(got) - want) < 0.04


def test_empty_table(no_rows):
    assert nd.near_duplicates(no_rows).count() == 0 and nd.keep_first(no_rows).count() == 0
