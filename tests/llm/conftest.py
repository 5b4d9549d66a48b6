import os
import random

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    return SF


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with nulls, ties, repeated rows, empty and very long texts and a column that clashes."""
    rng = random.Random(7)
    vocab = [f"w{i}" for i in range(400)]

    def prose(n):
        return " ".join(rng.choice(vocab) for _ in range(n))

    base = prose(120)
    words = base.split()
    near = " ".join(words[:60] + ["changed"] + words[61:])
    passage = prose(70)
    lines = "\n".join(prose(12) for _ in range(6))
    rows = [
        (1, base, "en", "a", 0, "x"), (2, base, "en", "a", 0, "x"), (3, near, "en", "b", 0, "x"),
        (4, None, "en", "a", 0, "x"), (5, "", None, None, None, None), (6, "   \n\t ", "en", "b", 0, "x"),
        (7, "one two three", "en", "b", 0, "x"), (8, "One TWO three", "en", None, 0, "x"),
        (9, prose(40) + " " + passage + " " + prose(35), "en", "c", 0, "x"),
        (10, prose(25) + " " + passage + " " + prose(50), "en", "a", 0, "x"),
        (11, lines, "en", "b", 0, "x"), (12, prose(30) + "\n" + lines, "en", "b", 0, "x"),
        (13, prose(6000), "en", "a", 0, "x"), (14, "x" * 70_000 + " tail 's don't  \n\n end", "en", "c", 0, "x"),
        (None, base, "en", "a", 0, "x"), (15, "# # $ | <a> " * 9, "de", "c", 0, "x"),
        (16, prose(8) * 4, "de", "c", 0, "x"), (11, lines, "en", "b", 0, "x"),
        (17, "日本語 テキスト ünïcode Straße " * 12, "ja", "c", 0, "x"),
    ]
    rows += [(100 + i, prose(30 + i % 17), "en", "abc"[i % 3], 0, "x") for i in range(60)]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words string").repartition(3)


@pytest.fixture(scope="session")
def no_rows(awkward):
    return awkward.where("false")


@pytest.fixture(scope="session")
def pairs_of(awkward):
    return [(r["doc_id"], r["text"]) for r in awkward.collect()]
