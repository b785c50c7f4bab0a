"""Benchmark: run the headline queries and print one JSON line.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default 8).

Every query derives the lodging tables from the driver tables itself (as the driver's ``queries()`` do), and
its time includes building the plan. Each query is executed in full through the ``noop`` sink (no rows reach
the driver). Each query is run once untimed first (JVM warm-up: JIT and generated-code caches), then timed.
``stored`` gives the same queries on lodging tables written once as Parquet, so the difference is what deriving them costs.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from innsight.plans.queries import OPERATORS  # noqa: E402
from innsight.session import build_session  # noqa: E402
from innsight.sources.fixtures import LodgingSources  # noqa: E402
from innsight.sources.stored import store_sources  # noqa: E402

HEADLINE = (
    "report_wide",
    "report_narrow",
    "room_nights_daily",
    "room_nights_by_channel",
    "realization_by_channel",
    "channel_pivot",
    "cancellation_pivot",
    "channel_group_rollup",
    "supply_by_status",
    "contracted_rooms",
    "exclusive_tax_by_booking",
    "stay_nights_by_property",
    "policy_resolution",
    "effective_live_date",
    "first_booking",
)


def timed(df) -> float:
    t0 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus, app="innsight-bench")
    times = {}
    for name in HEADLINE:
        timed(OPERATORS[name](LodgingSources(spark, sf_dir)))  # warm-up, not counted
        t0 = time.perf_counter()
        timed(OPERATORS[name](LodgingSources(spark, sf_dir)))
        times[name] = round(time.perf_counter() - t0, 3)
    tables = store_sources(LodgingSources(spark, sf_dir), tempfile.mkdtemp(prefix="innsight-bench-"))
    stored = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        timed(OPERATORS[name](tables))
        stored[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "stored": stored}))
    spark.stop()


if __name__ == "__main__":
    main()
