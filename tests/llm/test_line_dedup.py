import random
import re

from stationlake.llm import line_dedup as ld


def worded(text):
    return [i for i, x in enumerate((text or "").split("\n")) if re.search(r"[^\x20\x09-\x0D]", x)]


def by_hand(rows, min_lines, min_chars):
    """Text of every (doc_id, text) after deletion of the lines inside a window that occurs earlier."""
    docs = sorted({(d, t) for d, t in rows}, key=lambda r: (r[0] is not None, r[0] or 0))
    first, out = {}, {}
    gone = {}
    for d, t in docs:
        lines = (t or "").split("\n")
        at = worded(t)
        for width in {1, min_lines}:
            for i in range(len(at) - width + 1):
                w = tuple(lines[at[k]] for k in range(i, i + width))
                if width == 1 and min_lines != 1 and len(w[0]) < min_chars:
                    continue
                if w in first:
                    gone.setdefault((d, t), set()).update(at[i:i + width])
                else:
                    first[w] = (d, i)
    for d, t in docs:
        out[(d, t)] = None if t is None else "\n".join(
            x for i, x in enumerate(t.split("\n")) if i not in gone.get((d, t), ()))
    return out, gone


def check(docs, min_lines, min_chars):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want, gone = by_hand(rows, min_lines, min_chars)
    tagged = docs.selectExpr("*", "text AS before")
    got = ld.dedup_lines(tagged, min_lines=min_lines, min_chars=min_chars).collect()
    assert len(got) == len(rows)
    for r in got:
        k = (r["doc_id"], r["before"])
        assert r["text"] == want[k], k[0]
        assert r["n_removed"] == len(gone.get(k, ())) and r["n_lines"] == len(worded(r["before"]))


def test_deletions_equal_brute_force(awkward):
    check(awkward.select("doc_id", "text"), 4, 40)


def test_short_lines_in_runs(spark):
    rng = random.Random(5)
    rows = []
    for d in range(60):
        lines = [rng.choice(["a", "b", "c", "d d", "", "  ", "e" * 50, "f" * 45]) for _ in range(rng.randrange(0, 14))]
        rows.append((d, "\n".join(lines)))
    run = "\n".join(f"line {i}" for i in range(37))
    rows += [(100, run), (101, "x\n" + run + "\ny"), (102, run + "\n" + run), (103, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for width in (1, 2, 4, 8):
        check(docs, width, 40 if width > 1 else 0)


def test_longest_run_is_maximal(spark):
    run = "\n".join(f"line {i}" for i in range(37))
    docs = spark.createDataFrame([(1, "p\n" + run), (2, "q\nr\n" + run + "\ns")], "doc_id bigint, text string")
    levels = ld.suffix_levels(docs)
    assert len(levels) == 6  # 2**5 <= 37 < 2**6
    found = ld.runs(levels).collect()
    assert [(r["d"], r["start"], r["n_lines"], r["src"]["d"], r["src"]["pos"]) for r in found] == [(2, 2, 37, 1, 1)]


def test_ranks_are_in_suffix_order(spark):
    docs = spark.createDataFrame([(1, "b\na\nb\na\nc"), (2, "a\nb\na\nb")], "doc_id bigint, text string")
    levels = ld.suffix_levels(docs)
    pairs = {(r["d"], r["pos"]): r["rank"] for r in levels[1].collect()}
    single = {(r["d"], r["pos"]): r["rank"] for r in levels[0].collect()}
    order = sorted(pairs, key=lambda k: (single[k], single[(k[0], k[1] + 1)]))
    ranks = [pairs[k] for k in order]
    assert ranks == sorted(ranks)


def test_keep_lines_and_empty_table(awkward, no_rows):
    out = ld.keep_lines(awkward)
    assert out.columns == awkward.columns
    left = {r["doc_id"] for r in out.collect()}
    assert {4, 5, 6, 1} - left <= {1} and 2 not in left  # an exact copy loses all its lines
    assert ld.dedup_lines(no_rows).count() == 0 and ld.keep_lines(no_rows).count() == 0


def test_clashing_columns_stay(spark):
    docs = spark.createDataFrame([(1, "same line, long enough to count as a run", 7), (2, "same line, long enough to count as a run", 8),
                                  (3, "other", 9)], "doc_id bigint, text string, n_removed int")
    assert sorted(map(tuple, ld.keep_lines(docs).collect())) == [(1, docs.first()["text"], 7), (3, "other", 9)]
    assert sorted((r["doc_id"], r["n_removed"]) for r in ld.dedup_lines(docs).collect()) == [(1, 0), (2, 1), (3, 0)]


def maximal_runs(rows):
    """(doc, start, lines) of the runs that an earlier place has too and that are no part of a longer one, by brute force."""
    places = [(d, i) for d, lines in rows for i in range(len(lines))]
    of = dict(rows)
    out = []
    for d, lines in rows:
        before = 0
        for i in range(len(lines)):
            most = 0
            for e, j in places:
                if (e, j) >= (d, i):
                    break
                n = 0
                while i + n < len(lines) and j + n < len(of[e]) and lines[i + n] == of[e][j + n]:
                    n += 1
                most = max(most, n)
            if most and i + most > before:
                out.append((d, i, most))
            before = i + most
    return out


def test_runs_equal_brute_force_on_overlapping_copies(spark):
    rng = random.Random(11)
    rows = [(1, list("bcde")), (2, list("abcdex")), (3, list("abcde"))]
    long = [f"l{i}" for i in range(60)]
    for d in range(4, 60):
        lines = []
        for _ in range(rng.randrange(1, 5)):
            i = rng.randrange(50)
            lines += long[i:i + rng.randrange(1, 30)] if rng.random() < 0.6 else [rng.choice("abcde") for _ in range(rng.randrange(6))]
        rows.append((d, lines))
    docs = spark.createDataFrame([(d, "\n".join(x)) for d, x in rows], "doc_id bigint, text string")
    want = maximal_runs(rows)
    assert [r for r in want if r[0] == 3] == [(3, 0, 5)]
    found = ld.runs(ld.suffix_levels(docs), 1).collect()
    assert sorted((r["d"], r["start"], r["n_lines"]) for r in found) == want
    of = dict(rows)
    for r in found:
        e, j = r["src"]["d"], r["src"]["pos"]
        assert (e, j) < (r["d"], r["start"])
        assert of[e][j:j + r["n_lines"]] == of[r["d"]][r["start"]:r["start"] + r["n_lines"]]
    for r in ld.dedup_lines(docs).collect():
        own = [n for d, _, n in want if d == r["doc_id"]]
        assert (r["n_runs"], r["longest_run"]) == (len(own), max(own, default=0))


def test_runs_of_few_short_lines_go_by_their_characters(spark):
    menu = "Home and news pages\nContact and imprint"
    sign = "Kind regards to all\nA. N. Other\nphone 123 456"
    docs = spark.createDataFrame([(1, f"x\n{menu} \ny"), (2, f"p\n{menu} \n{sign}"), (3, f"{sign}\nHome and news pages\nq"),
                                  (4, "A. N. Other\nphone 123 456\nend")], "doc_id bigint, text string")
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in ld.dedup_lines(docs, min_chars=39).collect()}
    assert got == {1: (f"x\n{menu} \ny", 0), 2: (f"p\n{sign}", 2), 3: ("Home and news pages\nq", 3),
                   4: ("A. N. Other\nphone 123 456\nend", 0)}
