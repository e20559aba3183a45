"""

Usage: python tools/measure.py [folder]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from docloom import IndexSet, build_session  # noqa: E402
from docloom.operators import search as se  # noqa: E402
from docloom.suite import base as b  # noqa: E402


def timed(label: str, work) -> None:
    start = time.time()
    result = work()
    print(f"{label}: {time.time() - start:.1f} s {result or ''}", flush=True)


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session(
        "measure", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="16g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    jobs = b.indexer(spark, folder, IndexSet((b.ORDER,)))
    jobs.full(run_ts=1)
    timed("full", lambda: [r.rows_in for r in jobs.full(run_ts=1)])
    orders = b.table(spark, folder, "orders")
    mark = orders.select(F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("t"))
    bound = int(mark.approxQuantile("t", [0.99], 0.0)[0])
    for label in ("first", "second"):
        jobs.full(run_ts=bound)
        timed(f"incremental, 1 % changed, {label}", lambda: [r.rows_in for r in jobs.incremental(run_ts=bound)])
    log = b.changes(spark, folder).where("object_code = 'order' AND seq < 1500")
    for label in ("first", "second"):
        timed(f"near-real-time batch of 500, {label}", lambda: jobs.near_realtime(log).count())
    rows = b.rows_of(spark, folder, b.DOCUMENT, "documents")
    page = se.search_page(se.search(rows, "the when", text=F.col("text")), 0, 20)
    timed("search, first", lambda: len(page.collect()))
    timed("search, second", lambda: len(page.collect()))


if __name__ == "__main__":
    main()
