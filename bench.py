"""Time every registered query on one folder and print one JSON line.

The stored lines and headers, the stored fact, the bitmaps and the two segment tables are built first and timed under their
own names; queries that read them are timed without the build.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable
from pathlib import Path

from salescope.plans.catalog import catalog, order_parts, performance, stored_sales
from salescope.session import local_session


def timed(action: Callable[[], object]) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), name="bench")
    spark.read.parquet(f"{folder}/nation.parquet").count()
    seconds = {
        "build_order_parts": timed(lambda: order_parts(spark, folder)),
        "build_sales": timed(lambda: stored_sales(spark, folder)),
        "build_bitmaps": timed(lambda: performance(spark, folder).bitmaps),
        "build_segment_history": timed(lambda: performance(spark, folder).history),
        "build_segment_yoy": timed(lambda: performance(spark, folder).yoy),
    }
    for name, query in catalog().items():
        seconds[name] = timed(lambda: query(spark, folder).write.format("noop").mode("overwrite").save())
        print(f"{name} {seconds[name]}", file=sys.stderr)
    total = round(sum(seconds.values()), 3)
    scale = Path(folder).name.removeprefix("sf")
    print(json.dumps({"metric": "total_time", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))


if __name__ == "__main__":
    main()
