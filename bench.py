"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line with seconds per query.

Each query is executed in full through the ``noop`` sink (every row is
computed, nothing is shipped to the driver). A warm-up run of a small query
absorbs JVM start-up so the first timed query is not penalised.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from footlink.plans.catalog import QUERIES  # noqa: E402
from footlink.session import get_spark  # noqa: E402

HEADLINE = [
    "diff_latest", "diff_dates", "diff_upsert", "typed_cast", "links_merge_labels",
    "links_drop_destroyed", "geom_measures", "pairs_intersect", "match_similar",
    "match_contained", "match_dissolved", "unmatchable", "job_registry_change",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=cpus)
    QUERIES["dup_keys"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        t = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
