import re

import pytest

from stationlake.llm import decontaminate

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def by_hand(docs, items, window=10, shingle=3, share=1.0):
    """(doc_id, n_words, n_hit, item ids) with every item window against every place."""
    out = []
    for doc_id, text in docs:
        ws, hit, named = words(text), set(), set()
        for item_id, body in items:
            q = words(body)
            m = min(window, len(q))
            s = min(shingle, m)
            for k in range(len(q) - m + 1 if q else 0):
                w = q[k:k + m]
                need = max(1, -(-(share * (m - s + 1) - 1e-9) // 1))
                for p in range(len(ws) - m + 1):
                    d = ws[p:p + m]
                    same = d == w if share == 1 else sum(d[o:o + s] == w[o:o + s] for o in range(m - s + 1)) >= need
                    if same:
                        hit.update(range(p, p + m))
                        if item_id is not None:
                            named.add(str(item_id))
        out.append((doc_id, len(ws), len(hit), tuple(sorted(named))))
    return out


def key(r):
    return tuple((v is None, 0 if v is None else v) for v in r)


@pytest.fixture(scope="module")
def items(awkward, pairs_of):
    texts = dict(pairs_of)
    passage = texts[9].split()[40:75]
    return [(1, " ".join(passage)), (2, "One, TWO three!"), (3, None), (4, ""), (5, " .,; "), (None, texts[13][100:400]),
            (2, " ".join(texts[13].split()[5000:5030])), (30, " ".join(passage)), (7, "日本語 テキスト ünïcode"), (8, "tail"),
            (9, " ".join(texts[11].replace("\n", " ").split()[3:25])), (10, "W1 w2"), (11, "never seen words at all here"),
            (12, " ".join(passage[:9] + ["other"] + passage[10:20]))]


@pytest.mark.parametrize("how", [{}, {"limit": 0}, {"window": 4, "shingle": 2}, {"share": 0.5}, {"share": 0.5, "limit": 0}])
def test_hits_equal_brute_force(spark, awkward, pairs_of, items, how):
    """Broadcast and shuffled tables, exact and partial windows; items with nulls, repeats, one to many words."""
    bench = spark.createDataFrame([(*r, "x") for r in items], "item_id bigint, text string, ws string")
    out = decontaminate.find(awkward, bench, **how).collect()
    got = [(r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in out]
    args = {k: v for k, v in how.items() if k != "limit"}
    assert sorted(map(key, got)) == sorted(map(key, by_hand(pairs_of, items, **args)))
    for r in out:
        places = {p for x in r["hits"] for p in range(x["from"], x["to"])}
        assert len(places) == r["n_hit"] and list(r["hits"]) == sorted(r["hits"])


def test_a_text_of_one_word_many_times(spark):
    """A hot shingle in a long text: linear in its places."""
    docs = spark.createDataFrame([(1, "the " * 60_000), (2, "the cat")], "doc_id bigint, text string")
    bench = spark.createDataFrame([("b", "the"), ("a", "The the the the the the the the the the the the")], "item_id string, text string")
    out = {r["doc_id"]: (r["n_words"], r["n_hit"], list(r["items"])) for r in decontaminate.find(docs, bench).collect()}
    assert out == {1: (60_000, 60_000, ["a", "b"]), 2: (2, 1, ["b"])}


def test_empty_tables(spark, awkward, no_rows):
    bench = spark.createDataFrame([(1, "one two three")], "item_id bigint, text string")
    assert decontaminate.find(no_rows, bench).count() == 0
    out = decontaminate.find(awkward, bench.where("false"))
    assert out.count() == awkward.count() and out.where("n_hit > 0 OR size(items) > 0").count() == 0


def test_no_shuffle_of_texts(spark, sf_dir):
    """One exchange after the stored tables: the rows of a document, without its words."""
    from stationlake.llm.registry import op12_decontaminate

    plan = op12_decontaminate(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in plan
    assert "Python" not in plan and "Arrow" not in plan
