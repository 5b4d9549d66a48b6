import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest

from stationlake.llm import align

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def by_hand():
    """text -> (A ids, B ids, links as places, cuts), with the two libraries and one dictionary of ends."""
    import sentencepiece
    import tokenizers

    t = tokenizers.Tokenizer.from_file(A)
    t.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = align.byte_alphabet()

    def one(text):
        if not text:
            return [], [], [], []
        e, b = t.encode(" " + text, add_special_tokens=False), sp.encode(text)
        spelt_a = [bytes(letters[c] for c in tok) for tok in e.tokens]
        spelt_b = [bytes([int(sp.id_to_piece(i)[3:-1], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode()
                   for i in b]
        if not b"".join(spelt_a) == b"".join(spelt_b) == (" " + text).encode():
            return [], [], [], []
        ends, at = {}, 0
        for i, x in enumerate(spelt_a):
            at += len(x)
            ends[at] = i
        links, cuts, at = [], [], 0
        for k, x in enumerate(spelt_b):
            at += len(x)
            if at in ends:
                links.append((ends[at], k))
                cuts.append(at)
        return e.ids, b, links, cuts

    return one


def groups_of(a, b, links):
    out, i, k = [], 0, 0
    for x, y in links:
        out.append((a[i:x + 1], b[k:y + 1]))
        i, k = x + 1, y + 1
    return out


def wanted(texts, one):
    seen, counts, most = [], Counter(), defaultdict(int)
    for text in texts:
        a, b, links, _ = one(text)
        pairs = [(a[i], b[k]) for i, k in links]
        counts.update(pairs)
        spelt = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups_of(a, b, links))
        seen.append((len(a), len(b), len(links), pairs, hashlib.sha256(spelt.encode()).hexdigest() if links else ""))
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return [(na, nb, n, n, sum(counts[p] == most[p[1]] for p in pairs), sum(counts[p] for p in pairs), h)
            for na, nb, n, pairs, h in seen]


EXTRA = ["a▁b", "<0x41> <s> <unk> <|endoftext|>", "tabs\t\tand  spaces   \r\n\n", "\x00 nul", "x" * 3000, " " * 900 + "z",
         "emoji 👩‍👩‍👧 ﬁ ǆ é ​﻿", "\U0010ffff"]


@pytest.mark.parametrize("limit", [32 << 20, 0])
def test_query_columns_equal_both_libraries(spark, awkward, pairs_of, by_hand, limit):
    """Broadcast and shuffled counts; nulls, repeated rows and ids, bytes that don't match, clashing columns."""
    rows = pairs_of + [(900 + i, t) for i, t in enumerate(EXTRA)]
    docs = awkward.unionByName(spark.createDataFrame(rows[len(pairs_of):], "doc_id bigint, text string"), allowMissingColumns=True)
    docs = docs.withColumnRenamed("n_words", "n_links")
    out = align.scored(docs, A, B, P.PATTERN, limit=limit).collect()
    want = [(d, *w) for (d, _), w in zip(rows, wanted([t for _, t in rows], by_hand))]
    key = lambda r: tuple((v is None, v or 0 if not isinstance(v, str) else v) for v in r)
    assert sorted(map(key, (tuple(r) for r in out))) == sorted(map(key, want))
    empty = next(r for r in out if r["doc_id"] == 900)
    assert empty["n_a"] == empty["count_sum"] == 0 and empty["groups_sha256"] == ""


def test_tokens_groups_and_cuts(awkward, by_hand):
    out = align.align(awkward, A, B, P.PATTERN).collect()
    texts = defaultdict(list)
    for r in awkward.collect():
        texts[r["doc_id"]].append(r["text"])
    for r in out:
        a, b, links, cuts = next(x for x in map(by_hand, texts[r["doc_id"]]) if len(x[0]) == r["n_a"])
        assert (list(r["a_ids"]), list(r["b_ids"]), list(r["cuts"])) == (list(a), list(b), cuts)
        assert list(zip(r["link_a"], r["link_b"])) == [(a[i], b[k]) for i, k in links]
        sizes = [(len(x), len(y)) for x, y in groups_of(a, b, links)]
        assert list(zip(r["a_sizes"], r["b_sizes"])) == sizes


@pytest.mark.parametrize("lane", [1, 3, 64])
def test_lockstep_equals_intersection(lane):
    rng = np.random.default_rng(lane)
    for _ in range(50):
        ends, sides, first = 0, ([], []), [0]
        for _ in range(rng.integers(1, 6)):
            n = int(rng.integers(1, 60))
            for s in sides:
                s.extend(ends + np.unique(np.r_[rng.integers(1, n + 1, rng.integers(1, 40)), n]))
            ends += n
            first.append(len(sides[0]))
        a, b = map(np.array, sides)
        x, y = align.lockstep(a, b, np.array(first[:-1]), np.array(first[1:]), lane)
        assert (a[x] == b[y]).all() and a[x].tolist() == np.intersect1d(a, b).tolist()


def test_empty_table(no_rows):
    assert align.scored(no_rows, A, B, P.PATTERN).count() == 0
    assert align.align(no_rows, A, B, P.PATTERN).count() == 0
