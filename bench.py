"""Time the headline queries; prints one JSON line.

Each query is run to completion into the no-op sink (every column of every row is
computed, nothing is collected), once to warm up and then three times; the median
is reported.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tillbook.checks.queries import queries  # noqa: E402
from tillbook.session import local_session  # noqa: E402

HEADLINE = [
    "staged_item_discount_summary",
    "raw_orders_load",
    "raw_expenses_load",
    "union_orders",
    "union_expenses",
    "stg_orders",
    "stg_expenses",
    "verify_orders",
    "verify_expenses",
    "profile_null_counts",
    "profile_price_stats",
    "dq_orders",
    "dq_expenses",
    "sequence_number",
    "fct_orders",
    "order_surrogate_key",
    "fct_profit",
    "dim_customers",
    "top_customers",
    "synth_orders",
    "recurring_schedule",
]
RUNS = 3


def _scale(sf_dir: str) -> float | str:
    name = Path(sf_dir).name.removeprefix("sf")
    try:
        return float(name)
    except ValueError:
        return name


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, app="bench")
    registered = queries()
    seconds = {}
    for name in names:
        taken = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": _scale(sf_dir),
            }
        )
    )


if __name__ == "__main__":
    main()
