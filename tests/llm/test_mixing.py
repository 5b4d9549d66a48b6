import re

import pytest

from stationlake.llm import mixing as m


def water(sizes):
    """Targets by repeated resharing, as the contract words it."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, target, free = 1.5 * sum(sizes.values()), {}, list(order)
    while free:
        level = (total - sum(target.values())) / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > 2 * sizes[s]]
        if not over:
            target.update({s: level * weight[s] for s in free})
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            free.remove(s)
    return target


def test_targets_and_copies(awkward, pairs_of):
    rows = m.mix(awkward).collect()
    size, seen = {}, {}
    for r in awkward.collect():
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
        size[(r["doc_id"], r["source"])] = size.get((r["doc_id"], r["source"]), 0) + n
        seen[r["source"]] = seen.get(r["source"], 0) + n
    want = water(seen)
    assert {(r["doc_id"], r["source"]): r["size"] for r in rows} == size and len(rows) == len(size)
    for s in want:
        mine = [r for r in rows if r["source"] == s]
        assert all(r["target"] == pytest.approx(want[s]) and r["source_size"] == seen[s] for r in mine)
        assert all(0 <= r["copies"] <= 2 for r in mine)
        taken = sum(r["copies"] * r["size"] for r in mine)
        assert abs(taken - want[s]) <= max(r["size"] for r in mine) + 1e-6
    again = m.mix(awkward.repartition(5)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_the_tree_keeps_totals_over_levels(spark):
    docs = spark.range(5000).selectExpr("id AS doc_id", "repeat('w ', CAST(1 + id % 23 AS INT)) AS text",
                                        "concat('s', CAST(id % 4 AS STRING)) AS source")
    units = m.unit_sizes(docs)
    plan = m.targets(units).collect()
    rows = m.mix(docs)
    took = {r["source"]: r["t"] for r in rows.groupBy("source").agg({"source": "max"}).selectExpr("source", "0 AS t").collect()}
    took = {r["source"]: r["t"] for r in rows.selectExpr("source", "copies * size AS t").groupBy("source").agg(
        {"t": "sum"}).withColumnRenamed("sum(t)", "t").collect()}
    for p in plan:
        assert abs(took[p["source"]] - p["target"]) <= 23


def test_expectation_holds(spark):
    docs = spark.createDataFrame([(i, "w " * s, "a") for i, s in enumerate((1, 2, 3, 5, 8, 13))]
                                 + [(100, "w " * 400, "b"), (200, "w " * 90, "c")], "doc_id bigint, text string, source string")
    units = m.unit_sizes(docs)
    plan = {r["source"]: r for r in m.targets(units).collect()}
    runs = [{r["doc_id"]: r["copies"] for r in m.mix(docs, seed=1000 * s).collect()} for s in range(12)]
    each = plan["a"]["target"] / plan["a"]["source_size"]
    assert {c for run in runs for c in run.values()} <= {0, 1, 2}
    assert abs(sum(run[i] for run in runs for i in range(6)) / 72 - each) < 0.35


def test_apply_repeats_rows(awkward, no_rows):
    out = m.apply_mix(awkward)
    assert out.columns == awkward.columns
    copies = {(r["doc_id"], r["source"]): r["copies"] for r in m.mix(awkward).collect()}
    want = sum(copies[(r["doc_id"], r["source"])] for r in awkward.collect())
    assert out.count() == want
    assert m.mix(no_rows).count() == 0 and m.apply_mix(no_rows).count() == 0
