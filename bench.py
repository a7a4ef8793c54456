"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Every query runs completely: its result is written to Spark's ``noop`` sink, so nothing is skipped and
nothing travels to the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from medalith.session import local_session  # noqa: E402
from medalith.workload.queries import QUERIES  # noqa: E402

# The plans over derived tables, the checks, and those of the storing and streaming queries that read whole tables.
HEADLINE = [
    *[q for q in QUERIES if q.startswith(("silver_", "gold_", "old_", "notebook_", "lookup_", "latest_", "dq_"))],
    "surrogate_keys", "upsert_composite", "upsert_stats", "preview_sort_nulls_last", "runs_rollup", "runs_last_n",
    "ledger_new_files", "json_flatten", "array_explode_parent", "source_delimited_auto", "source_delimited_encoding",
    "source_preamble_rows", "ingest_incremental", "full_run_catalog", "stream_upsert_latest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), "bench")
    QUERIES["gold_rent_by_commune"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds,
                      "sf": os.path.basename(sf_dir).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
