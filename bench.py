"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line with per-query wall-clock seconds.

Each query runs to completion through the ``noop`` sink (full execution, no
rows pulled to the driver). One untimed warm-up query runs first so JVM
start-up and code generation of the first stage are not charged to a query.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallgrass.plans.registry import load_all  # noqa: E402
from tallgrass.session import get_session  # noqa: E402

HEADLINE = [
    "wordcount_ws", "wordcount_nonword", "wordcount_strip", "top_long_words",
    "kv_join", "kv_reduce_fold", "kv_group_list", "cogroup",
    "clf_parse", "code_percentage", "gold_access", "ip_day_counts",
    "top_distinct", "json_props",
    "popular_places", "terminal_trends",
    "triplets", "vertex_degrees", "triangle_count", "connected_components",
    "pagerank_pregel", "pagerank_rounds", "pagerank_tol",
    "stream_popular_places", "stream_running_wordcount",
    "sink_tsv_roundtrip",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = sys.argv[1:]
    spark = get_session(f"local[{cpus}]", shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", 2 * cpus)),
                        extra={"spark.driver.memory": "16g"})
    reg = load_all()
    names = only or [n for n in HEADLINE if n in reg]
    reg["line_count"].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        reg[name].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
