"""Print the executed (final, adaptive) physical plans of key queries in the serving setup.

Usage: python tools/show_plans.py [sf_dir] > PLANS.md
Each query runs once (so AQE's final plan is shown), then its plan is printed with the lines
that matter at scale: scans (pushed/partition filters, read schema), exchanges, joins,
aggregates, windows.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from channelwise import queries as Q  # noqa: E402
from channelwise.plans.facts import message_fact  # noqa: E402
from channelwise.session import local_session, scratch_path  # noqa: E402

SHOW = ["q_daily_trends", "q_top_products", "q_posting_hours", "q_product_mart", "q_quality_suite",
        "q_search_messages", "q_image_engagement", "q_visual_channels", "q_dedupe"]
KEEP = re.compile(r"(Exchange|Join|Aggregate|Window|Scan|TakeOrdered|PartitionFilters|PushedFilters|"
                  r"ReadSchema|ReusedExchange|AQEShuffleRead|Filter \()")


def final_plan(df) -> str:
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("+- == Initial Plan ==")[0]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8)
    ctx = Q.materialized_context(spark, sf_dir, scratch_path(spark, "plans"))
    print(f"# Final physical plans (serving setup, {os.path.basename(sf_dir)}, local[8])\n")
    print("Generated by `python tools/show_plans.py`. Lines kept: scans, filters, exchanges, joins, "
          "aggregates, windows.\n")
    w = ctx.w
    items = [("fact build from written staging and dimensions", message_fact(w.stg, w.dim_channels, w.dim_dates))]
    items += [(name, Q.REPORTS[name](ctx)) for name in SHOW]
    items += [("registered q_fct_messages (from the test tables; dimensions written first)",
               Q.queries()["q_fct_messages"](spark, sf_dir))]
    for title, df in items:
        lines = [ln for ln in final_plan(df).splitlines() if KEEP.search(ln)]
        print(f"## {title}\n\n```")
        for ln in lines:
            ln = re.sub(r"file:/\S+/", ".../", ln)
            print(ln[:200])
            if "FileScan" in ln:
                pad = " " * (len(ln) - len(ln.lstrip()) + 4)
                for key in ("PartitionFilters", "PushedFilters", "ReadSchema"):
                    m = re.search(key + r": (\[[^\]]*\]|struct<[^>]*>)", ln)
                    if m and m.group(1) not in ("[]",):
                        print(f"{pad}{key}: {m.group(1)[:160]}")
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main()
