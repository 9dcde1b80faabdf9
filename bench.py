"""Time every registered query; prints one JSON line.

``BENCH_SF_DIR``: table folder; ``BENCH_CPUS``: cores; ``BENCH_QUERIES``: names, comma-separated (default all);
``BENCH_DETAIL=1`` prints each time to stderr as it comes.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from farelens.plans import catalog
from farelens.session import local_session


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n]
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, memory="12g")
    queries = catalog.queries()
    # One unmeasured query starts the executor threads and loads the code paths.
    queries["dq_scorecard"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name, query in queries.items():
        if wanted and name not in wanted:
            continue
        start = time.perf_counter()
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        if os.environ.get("BENCH_DETAIL"):
            print(name, times[name], file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
