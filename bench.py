"""Time the headline queries and print one JSON line.

BENCH_SF_DIR picks the tables (default sf0.1), BENCH_CPUS the local cores.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from barloom import build_session  # noqa: E402
from barloom.plans.registry import QUERIES  # noqa: E402

HEADLINE = [
    "flagship_report", "bars_from_ticks", "resample_ticks", "upsert_cells", "business_day_align",
    "sma", "ewma", "rsi", "macd", "bbands", "sar", "rolling_corr", "enriched_all", "chart_series_main",
    "ridge", "gaussian_nb", "decision_tree", "summary", "analysed_240",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(os.path.normpath(sf)),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
