"""Benchmark: time the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query runs to completion into Spark's ``noop`` sink (full execution,
nothing collected to the driver) and cold: it builds its own panel and fits its
own models, as nothing is kept between queries. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from demandgrid.plans.queries import QUERIES  # noqa: E402
from demandgrid.session import get_spark  # noqa: E402

HEADLINE = (
    "panel_nation",              # facts -> dense daily panel
    "features_default",          # 23-feature table
    "features_sql_table",        # lags, trailing means, SQL rolling deviation
    "backtest_metrics",          # 2 baselines x 4 folds, metrics
    "gain_by_fold",              # cost ratios x 18-point multiplier search
    "gain_in_events",
    "conformal_coverage_by_calibration",  # 5 calibration lengths, holdout coverage
    "batch_scoring",             # requests -> scored forecast rows
    "table_checks",              # contract checks over the fact tables
    "column_profile",
    "events_panel_features",
    "decomposition_backtest_metrics",    # grouped ridge fits, 4 folds
    "gbt_holdout_eval",          # tree fit + 91-day recursive forecast
    "gbt_gain_by_fold",          # cost analysis: trees vs seasonal naive, 4 folds
    "gbt_search",                # Parzen search: 6 trials of up to 8 rounds, folds 1-3
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or list(HEADLINE)
    spark = get_spark(f"local[{cpus}]", app="demandgrid-bench", shuffle_partitions=cpus,
                      extra={"spark.driver.memory": "16g"})
    # Warm-up: JVM start, class loading, codegen caches.
    QUERIES["panel_summary"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
