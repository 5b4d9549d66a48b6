"""Summarise the physical plan of every registered query into PLANS.md.

usage: python tools/plan_report.py [sf_dir] > PLANS.md

Per query: shuffle exchanges (with their keys), join strategies, aggregate
kinds, window/top-k nodes, Python nodes and the filters pushed into scans.
Queries that write a table or fit a model while they are built show the plan of their final step.
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

BUILD_RUNS_JOBS = {"fit_linear", "linear_scores", "linear_coefficients", "fit_gbt", "feature_importance",
                   "write_roundtrip", "bulk_load", "load_counts", "parse_fixed_width", "ingest_union", "snapshot_load",
                   "tree_root", "station_columns", "prediction_sink", "score_upsert"}
NODES = ["BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin", "HashAggregate",
         "ObjectHashAggregate", "SortAggregate", "WindowGroupLimit", "Window", "Generate", "FlatMapGroupsInPandas",
         "MapInPandas", "BatchEvalPython", "ArrowEvalPython"]


def _balanced(text: str, start: int, open_ch: str = "(", close_ch: str = ")") -> str:
    """The text between the bracket at ``start`` and its matching closing bracket."""
    depth = 0
    for i in range(start, len(text)):
        if text[i] == open_ch:
            depth += 1
        elif text[i] == close_ch:
            depth -= 1
            if depth == 0:
                return text[start + 1:i]
    return text[start + 1:]


def _top_level_split(text: str) -> list[str]:
    """Split on commas that are not nested in brackets."""
    parts, depth, cur = [], 0, []
    for ch in text:
        if ch in "([":
            depth += 1
        elif ch in ")]":
            depth -= 1
        if ch == "," and depth == 0:
            parts.append("".join(cur).strip())
            cur = []
        else:
            cur.append(ch)
    if cur:
        parts.append("".join(cur).strip())
    return parts


def _clean(expr: str) -> str:
    return re.sub(r"#[0-9]+L?", "", expr)


def exchange_keys(plan: str) -> list[str]:
    """One entry per (non-reused) shuffle: its partitioning with the full key list."""
    out = []
    for m in re.finditer(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)",
                         plan):
        kind = m.group(1)
        if kind == "SinglePartition":
            out.append(kind)
            continue
        args = _top_level_split(_balanced(plan, m.end()))
        keys = args[:-1] if args and args[-1].isdigit() else args  # last argument: partition count
        out.append(f"{kind}({', '.join(_clean(k) for k in keys)})")
    return out


def pushed_filters(plan: str) -> list[str]:
    found = set()
    for m in re.finditer(r"PushedFilters: ", plan):
        found.add(_clean(_balanced(plan, m.end(), "[", "]")))
    return sorted(f for f in found if f)


def summarise(plan: str) -> str:
    reused = len(re.findall(r"ReusedExchange", plan))
    fresh = "\n".join(line for line in plan.splitlines() if "ReusedExchange" not in line)
    keys = exchange_keys(fresh)
    counts = Counter(n for n in NODES for _ in re.finditer(rf"\b{n}\b", plan))
    pushed = pushed_filters(plan)
    parts = [f"exchanges {len(keys)}: {'; '.join(keys) or '-'}" + (f" (+{reused} reused)" if reused else ""),
             "nodes: " + ", ".join(f"{n}x{c}" for n, c in counts.items())]
    if pushed:
        parts.append("pushed: " + "; ".join(pushed))
    return " | ".join(part.replace("|", "\\|") for part in parts)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from stationlake.plans.registry import QUERIES
    from stationlake.session import get_spark

    spark = get_spark()
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `tools/plan_report.py` on `{sf_dir}` (local mode; broadcast choices depend on sizes).\n")
    print("| query | plan summary |\n| --- | --- |")
    for name, fn in QUERIES.items():
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        note = " (plan of the final read; building it wrote a table or fitted a model first)" \
            if name in BUILD_RUNS_JOBS else ""
        print(f"| `{name}` | {summarise(plan)}{note} |")


if __name__ == "__main__":
    main()
