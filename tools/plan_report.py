"""Summarize the final (adaptive) physical plans of the headline queries into markdown.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import re
import sys
from collections import Counter

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from innsight.plans.queries import QUERIES  # noqa: E402
from innsight.session import build_session  # noqa: E402

NAMES = ("report_wide", "room_nights_daily", "room_nights_by_channel", "realization_by_channel", "supply_by_status",
         "exclusive_tax_by_booking", "policy_resolution", "latest_live_date", "first_booking")


KEY_TEXT = """How to read `report_wide` below:

- `(property_code, d, hotel_status)`: the first-level supply aggregate (one scan of the daily supply fact).
- `(property_code, date, booking_source)` x 2: the first-level demand and realization aggregates, fed by the
  stay-night `Generate`. Partial aggregates sit below them, so raw nights are never shuffled.
- `(property_code, date)` REPARTITION_BY_COL: narrow supply rows and narrow per-channel rows, co-partitioned
  before the contracted-rooms window and the pivots. All (property, day) joins then reuse that partitioning.
- `(property_code, date)` ENSURE_REQUIREMENTS: the supply rows again, after the per-property joins.
- `(property_code)`: per-property aggregates (first booking, live date) and per-property joins onto the
  narrow supply rows.
- `(id)` x 2: tax documents joined to bookings and the tax lookup. The bucketed layout removes both.
- The rest: small dimension-side aggregates (distinct restrictions, policy rows, observed channels).
"""


def clean(s: str) -> str:
    return re.sub(r"#\d+L?", "", s)


def summarize(name: str, plan: str) -> str:
    exchanges = Counter(clean(m) for m in re.findall(r"Exchange (?:hashpartitioning|rangepartitioning|SinglePartition)"
                                                         r"[^,\n]*(?:,[^,\n]*?)*?, [A-Z_]+", plan))
    joins = Counter(m for m in re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|"
                                          r"CartesianProduct)", plan))
    gens = len(re.findall(r"Generate explode", plan))
    partial = len(re.findall(r"HashAggregate\(keys=\[[^\]]*\], functions=\[partial_", plan))
    reused = plan.count("ReusedExchange")
    scans = Counter()
    for line in plan.splitlines():
        if "FileScan parquet" not in line:
            continue
        table = re.search(r"/([a-z_]+)(?:\.parquet)?\]", line)
        pushed = re.search(r"PushedFilters: \[(.*?)\]?, ReadSchema", line)
        schema = re.search(r"ReadSchema: (struct<.*>)", line)
        scans[(table.group(1) if table else "?", clean(pushed.group(1))[:120] if pushed else "",
               schema.group(1)[:120] if schema else "")] += 1
    lines = [f"### `{name}`", "", f"- joins: {dict(joins) or 'none'}; generators: {gens}; partial aggregates: {partial}; "
             f"reused exchanges: {reused}", "- exchanges:"]
    lines += [f"  - {n} x `{e}`" for e, n in exchanges.most_common()] or ["  - none"]
    lines.append("- parquet scans (table, pushed filters, read schema):")
    lines += [f"  - {n} x `{t}` filters `[{f}]` schema `{s}`" for (t, f, s), n in sorted(scans.items())]
    return "\n".join(lines) + "\n"


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session()
    print(f"# Physical plans (final adaptive plans, {sf_dir}, local[8], 8 shuffle partitions)\n")
    print("Generated by `tools/plan_report.py`. Exchanges are listed with their partitioning keys; joins are the\n"
          "strategies AQE settled on after measuring stage outputs.\n")
    print(KEY_TEXT)
    names = NAMES + tuple(n for n in QUERIES if n not in NAMES)
    for name in names:
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        print(summarize(name, df._jdf.queryExecution().executedPlan().toString()))


if __name__ == "__main__":
    main()
