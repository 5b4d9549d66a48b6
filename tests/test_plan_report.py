"""The plan summariser behind PLANS.md: full key lists, nested brackets, reused exchanges."""

import os
import sys

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from plan_report import exchange_keys, pushed_filters, summarise  # noqa: E402

PLAN = """AdaptiveSparkPlan isFinalPlan=false
+- HashAggregate(keys=[year#1, station_name#2], functions=[sum(n#3L)])
   +- Exchange hashpartitioning(year#1, station_name#2, 8), ENSURE_REQUIREMENTS, [plan_id=10]
      +- Exchange hashpartitioning(CASE WHEN isnull(qflag#4) THEN station_id#5 END, obs_date#6, 8), ENSURE_REQUIREMENTS
         +- Exchange SinglePartition, ENSURE_REQUIREMENTS, [plan_id=12]
            +- FileScan parquet [a#7] PushedFilters: [In(event_type, [click,view]), IsNotNull(a)], ReadSchema: struct<a:int>
            +- ReusedExchange [x#8], Exchange hashpartitioning(year#1, 8)
"""


def test_exchange_keys_keep_every_key_and_drop_the_partition_count():
    fresh = "\n".join(line for line in PLAN.splitlines() if "ReusedExchange" not in line)
    assert exchange_keys(fresh) == [
        "hashpartitioning(year, station_name)",
        "hashpartitioning(CASE WHEN isnull(qflag) THEN station_id END, obs_date)",
        "SinglePartition",
    ]


def test_pushed_filters_keep_nested_lists():
    assert pushed_filters(PLAN) == ["In(event_type, [click,view]), IsNotNull(a)"]


def test_summary_counts_reused_exchanges_separately():
    s = summarise(PLAN)
    assert s.startswith("exchanges 3: ") and "(+1 reused)" in s
    assert "HashAggregatex1" in s
