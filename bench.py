"""Headline queries, timed; prints one JSON line.

Seconds per query: the median of the runs after one warm-up run, writing to the no-op
sink so that every row is produced. ``BENCH_SF_DIR``, ``BENCH_CPUS`` and ``BENCH_RUNS``
override the defaults.
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from decreta.queries import documents, relational, scalar, tables  # noqa: E402
from decreta.session import local_session  # noqa: E402

HEADLINE = {
    "source_stats": relational, "search_rows": relational, "nested_export": relational,
    "daily_throughput": relational, "page_fingerprint": scalar, "new_links": documents,
    "readability": scalar, "document_assembly": documents, "fuzzy_match": tables,
    "extract_assignments": documents, "stream_throughput": tables,
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = local_session("bench", cpus, spark__driver__memory="20g")
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name, group in HEADLINE.items():
        took = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            group.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - start)
        times[name] = round(statistics.median(took[1:]), 3)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
