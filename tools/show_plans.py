"""Print the physical plans of the headline operators (shuffles, joins, aggregates,
windows and scans only), for reviewing partitioning and pushdown.

Usage: python tools/show_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KEEP = ("Exchange", "Join", "Aggregate", "Window", "Scan", "Union", "Sort ", "BroadcastExchange", "ReusedExchange")


def compact(df) -> str:
    plan = df._jdf.queryExecution().executedPlan().toString()
    out = []
    for line in plan.splitlines():
        if any(k in line for k in KEEP):
            line = line.split(", DataFilters")[0] if "FileScan" in line else line
            out.append(line[:160])
    return "\n".join(out)


def main(argv) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from starloom.operators import conform, facts, scd2
    from starloom.plans.context import Scenario
    from starloom.session import build_session
    from starloom.sources.derived import BATCH1_DATE

    spark = build_session()
    s = Scenario(spark, sf_dir)
    frames = {
        "latest customers (dedupe-first conform)": s.customers(2),
        "product validity (range-split lead)": conform.product_validity(s.feed("product_info", 2)),
        "SCD2 classification against current versions": scd2.classify_current(
            s.customers(2), s.customer_snapshot_1, scd2.CUSTOMER
        ),
        "SCD2 next snapshot": s.customer_delta_2.merged,
        "fact rows (lookups)": facts.build_fact_sales(
            s.feed("sales_details", 1),
            s.customer_snapshot_1,
            s.product_snapshot_1,
            s.dim_date_1,
            BATCH1_DATE,
            with_keys=False,
        ),
        "date dimension rows": conform.dim_date_rows(s.feed("sales_details", 2)),
    }
    for title, df in frames.items():
        print(f"### {title}\n{compact(df)}\n")


if __name__ == "__main__":
    main(sys.argv)
