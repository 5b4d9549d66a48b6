import hashlib
import random
import zlib

import pytest

from stationlake.llm import turn_trie


def by_hand(rows, rebuild):
    """Node rows with dictionaries of whole sequences."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in own.items()}
    seqs = own
    if rebuild:
        seqs = {}
        for c, v in own.items():
            h = zlib.crc32(str(c).encode()) % 6
            base = c - (c % 100 if c >= 0 else -(-c % 100))
            seqs[c] = own.get(base, [])[:h] + v[h:]
    members = {}
    for c, v in seqs.items():
        for d in range(len(v) + 1):
            members.setdefault(tuple(v[:d]), []).append(c)
    kids = {}
    for key in members:
        if key:
            kids.setdefault(key[:-1], []).append(key)
    leaves, saved = {}, {}
    for key in sorted(members, key=len, reverse=True):
        own_saved = (len(members[key]) - 1) * len(key[-1][1]) if key else 0
        leaves[key] = sum(leaves[k] for k in kids.get(key, [])) or 1
        saved[key] = own_saved + sum(saved[k] for k in kids.get(key, []))
    return sorted((min(m), len(key), min(members[key[:-1]]) if key else -1, len(m), len(kids.get(key, [])), leaves[key], saved[key],
                   hashlib.sha256(",".join(str(c) for c in sorted(m) if len(seqs[c]) == len(key)).encode()).hexdigest())
                  for key, m in members.items())


def nodes(spark, rows, rebuild=False, extra=False, **how):
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(3)
    if extra:
        df = df.selectExpr("conv_id", "turn", "role", "text", "'x' AS depth", "1 AS nth", "2 AS size", "3 AS h1")
    turns = turn_trie.numbered_turns(df)
    out = turn_trie.trie(*(turn_trie.rebuilt if rebuild else turn_trie.sequences)(turns), **how)
    return sorted(tuple(-1 if v is None else v for v in r) for r in out.collect())


def talk(rng, n, words=4):
    return [(rng.choice(["user", "assistant"]), " ".join(rng.choice("abé日") for _ in range(rng.randrange(words)))) for _ in range(n)]


def rows_of(convs):
    return [(c, k, r, t) for c, v in convs.items() for k, (r, t) in enumerate(v)]


@pytest.fixture(scope="module")
def convs():
    """Shared beginnings, copies, truncations and long chains that part late; negative and far ids."""
    rng = random.Random(5)
    out = {100 * k + j: talk(rng, rng.randrange(1, 8)) for k in range(4) for j in rng.sample(range(100), 12)}
    for c in list(out)[:15]:
        out[1000 + c] = out[c][:rng.randrange(1, 9)] + talk(rng, rng.randrange(3))
    long = talk(rng, 60)
    out |= {5000: long, 5001: long, 5002: long[:59] + talk(rng, 3), 5003: long[:40], 5004: long[:7] + talk(rng, 30), -250: long[:20], -205: talk(rng, 2)}
    return out


AWKWARD = [(None, 0, "user", "lost"), (7000, None, None, None), (7000, None, "user", ""), (7000, 3, "user", "x"), (7000, 3, "user", "x"),
           (7000, 3, "a", "y"), (7001, -5, "", ""), (7001, 9, "user", None), (7002, 1, "user", "z" * 30_000), (7003, 1, "user", "z" * 30_000)]


@pytest.mark.parametrize("rebuild", [False, True])
def test_nodes_equal_brute_force(spark, convs, rebuild):
    """With small blocks and runs too: long conversations over several windows, members packed in runs."""
    rows = rows_of(convs) + AWKWARD
    random.Random(1).shuffle(rows)
    want = by_hand(rows, rebuild)
    assert nodes(spark, rows, rebuild, extra=True) == want
    assert nodes(spark, rows, rebuild, block=8, run=1) == want


def test_hot_sequence_and_truncations(spark):
    """Many equal conversations, and one cut after every turn: a node for each turn, each with an end."""
    rng = random.Random(2)
    line = talk(rng, 12)
    convs = {c: line for c in range(1500)} | {2000 + d: line[:d] for d in range(1, 13)}
    rows = rows_of(convs)
    assert nodes(spark, rows) == by_hand(rows, False)


def test_one_conversation_none_and_turnless(spark):
    one = [(3, 0, "user", "hello"), (3, 1, "assistant", "hi")]
    assert nodes(spark, one) == by_hand(one, False)
    c = next(c for c in range(1, 100) if zlib.crc32(b"%d" % c) % 6 >= 2)  # gives up both turns to an absent one
    gone = [(c, 0, "user", "hello"), (c, 1, "assistant", "hi")]
    assert nodes(spark, gone, rebuild=True) == by_hand(gone, True) == [
        (c, 0, -1, 1, 0, 1, 0, hashlib.sha256(b"%d" % c).hexdigest())]
    assert nodes(spark, []) == nodes(spark, [(None, 1, "user", "x")]) == []


def test_numbering_spreads_a_group(spark):
    from stationlake.llm.common import numbered

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = spark.range(4000).selectExpr("IF(id % 3 = 0, NULL, 1) AS g", "id % 50 AS o", "id")
    try:
        out = numbered(df, ["g"], ["o"], "numbered-test").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for g in (None, 1):
        mine = sorted((r["nth"], r["o"]) for r in out if r["g"] == g)
        assert [n for n, _ in mine] == list(range(len(mine))) and [o for _, o in mine] == sorted(o for _, o in mine)
