"""Time the headline queries at one scale factor and print ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_QUERIES (comma list, default HEADLINE), BENCH_DRIVER_MEMORY (default 16g).
Each query is fully executed into Spark's ``noop`` sink (every row produced, nothing
collected to the driver); the time includes planning. A short warm-up runs first.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "monthly_features",      # scan + join + aggregate + window: the feature stage
    "unpivot_days_monthly",  # pivot -> unpivot -> calendar join -> monthly roll-up
    "unpivot_measures",      # wide-to-long over the whole fact table
    "join_diff_keys",        # fact-to-dimension join, full output
    "group_avg",             # grouped aggregate over the fact table
    "group_forecast",        # per-store tuning, refit and forecast (one job per stage)
    "forecast_export",       # all SQL-expressible models scored, selected and exported
    "rf_forecast",           # random forest, time-ordered tuning of 5 candidates
    "gbt_forecast",          # boosted trees, the same tuning
    "group_fit_fourier",     # sparse piecewise trend from Gram aggregates, one row of coefficients per store
    "category_index",        # label index over the checkpointed feature frame
    "month_spine",           # month gaps filled, then calendar lags
    "boost_two_trees",       # second-order boosting: one aggregate a level
    "parzen_proposals",      # every store's next candidates from its trial losses
]
# Run once before the clock starts: JVM start-up, code generation and Python workers.
WARM_UP = ["group_avg", "fourier_trend_only"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [q for q in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if q]

    from almanac.queries import REGISTRY
    from almanac.session import get_session

    # local mode: the driver heap is all the memory the "cluster" has
    spark = get_session(f"local[{cpus}]", cpus, app_name="almanac-bench",
                        driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
    for name in WARM_UP:
        REGISTRY[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    timings: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        df = REGISTRY[name].build(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
    spark.stop()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_time", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings,
                      "sf": float(m.group(1)) if m else sf_dir}))


if __name__ == "__main__":
    main()
