"""Headline queries at one scale; prints one JSON line.

Steps that start from a stored index (incremental, selective, near-real-time) are timed without the full run
that sets it up; the time of each whole query, set-up included, stands under ``whole``.

BENCH_SF_DIR   folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from docloom import build_session  # noqa: E402
from docloom.suite import QUERIES  # noqa: E402
from docloom.suite import base  # noqa: E402

HEADLINE = (
    "full_index",
    "incremental_index",
    "selective_index",
    "near_realtime_index",
    "bulk_upsert",
    "delete_by_ids",
    "stream_changes_kafka",
    "dedupe_changes_latest",
    "override_bulk",
    "sort_modified_desc",
    "page_by_modified",
    "results_envelope",
    "json_numeric",
    "map_string_to_long_array",
    "map_custom_attributes",
    "index_query_join",
    "index_query_aggregate",
    "index_query_window",
    "status_inventory",
    "search_page",
)


def set_up_seconds(work, log: list[float]):
    """``work`` with the seconds it takes added to ``log``."""

    def timed(*args, **kwargs):
        start = time.time()
        try:
            return work(*args, **kwargs)
        finally:
            log.append(time.time() - start)

    return timed


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["count_hits"](spark, folder).write.format("noop").mode("overwrite").save()
    set_ups: list[float] = []
    base.index_of_old_orders = set_up_seconds(base.index_of_old_orders, set_ups)
    timings, whole = {}, {}
    for name in HEADLINE:
        start = time.time()
        set_ups.clear()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        took = time.time() - start
        timings[name] = round(took - sum(set_ups), 3)
        if set_ups:
            whole[name] = round(took, 3)
    found = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "whole": whole,
                "sf": float(found.group(1)) if found else None,
            }
        )
    )


if __name__ == "__main__":
    main()
