"""Time the panel queries and print one JSON line.

BENCH_SF_DIR: folder with the tables (default sf0.1). BENCH_CPUS: cores (default 8).
Each query is run to its last row with a no-op sink.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from panelkit.plans.queries import REGISTERED
from panelkit.session import local_session

# whole studies repeat what other queries time, the text operators are timed over larger tables elsewhere
LEFT_OUT = {"fixed_study", "replicate_study", "search_study"}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds: dict[str, float] = {}
    every = REGISTERED
    timed = [n for n in every if n not in LEFT_OUT]
    every[timed[0]](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    for name in timed:
        start = time.perf_counter()
        every[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr)
    found = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "panel_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(found.group(1)) if found else sf_dir,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
