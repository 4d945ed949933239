"""Headline timings: one JSON line.

The first query that needs a stored table pays for building it from the input tables (q02: the account months;
q05: bureau and data set); later ones read it. The total covers both.
BENCH_SF_DIR, BENCH_CPUS and BENCH_QUERIES (comma-separated names) change the run.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lendlake.plans import catalog  # noqa: E402
from lendlake.session import local_session  # noqa: E402

HEADLINE = [
    "q02_scenario_risk",
    "q03_payment_behavior",
    "q05_product_risk",
    "q15_portfolio_composition",
    "q17_scenario_comparison",
    "q18_default_trend",
    "q22_band_series",
    "q24_spotlight",
    "d23_stress_projection",
    "d27_customer_month",
    "m11_auc",
    "m24_psi",
    "s12_surrogate_key",
]


def run(df) -> None:
    """Compute every column of every row without moving rows to the driver."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="bench")
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    run(queries["q15_portfolio_composition"](spark, folder))  # start the executors
    times = {}
    for name in names:
        start = time.perf_counter()
        run(queries[name](spark, folder))
        times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
