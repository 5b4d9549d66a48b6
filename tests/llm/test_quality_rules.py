import re

from pyspark.sql import functions as F

from stationlake.llm import quality_rules as q


def by_hand(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i:i + 8]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered),
            n < 20 or 100 * len(covered) > 30 * n)


def test_counts_equal_brute_force(awkward):
    rows = q.measure(awkward).collect()
    for r in rows:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"],
                r["base_failed"]) == by_hand(r["text"]), r["doc_id"]


def test_hosts_shrink_and_reject(spark):
    good, bad = " ".join(f"word{i}" for i in range(50)), "short"
    rows = [(i, good, "fine") for i in range(200)] + [(1000 + i, bad, "junk") for i in range(200)]
    rows += [(2000 + i, bad if i % 20 == 0 else good, "mixed") for i in range(200)] + [(3000, good, "junk"), (3001, good, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    out = {r["doc_id"]: r for r in q.quality(docs).collect()}
    assert len(out) == len(rows)
    assert not out[3000]["kept"] and not out[3000]["base_failed"]  # its host fails
    assert out[3001]["kept"] and out[0]["kept"] and out[2001]["kept"] and not out[2000]["kept"]
    assert 0 < out[0]["host_rate"] < 0.05 and out[1000]["host_rate"] > 0.95
    kept = q.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(d for d, r in out.items() if r["kept"])


def test_one_bad_page_does_not_fail_a_small_host(spark):
    good = " ".join(f"word{i}" for i in range(50))
    rows = [(i, good if i % 10 else "x", f"h{i % 7}") for i in range(700)] + [(9000, "x", "tiny")]
    rows += [(10_000 + i, good if i % 2 else "x", "half") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    rate = {r["source"]: r["host_rate"] for r in q.quality(docs).select("source", "host_rate").distinct().collect()}
    assert rate["tiny"] < 0.95


def test_clashing_columns_and_empty_table(awkward, no_rows):
    out = q.keep_good(awkward)
    assert out.columns == awkward.columns and dict(out.dtypes)["n_words"] == "string"
    assert out.where(F.col("n_words") != "x").count() == 0
    assert q.keep_good(no_rows).count() == 0 and q.quality(no_rows).count() == 0
