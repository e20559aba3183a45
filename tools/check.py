"""Compare every query with its SQL text on DuckDB.

Usage: python tools/check.py [folder] [query ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from docloom import build_session  # noqa: E402
from docloom.suite import ORACLE, QUERIES  # noqa: E402


def plain(value):
    if isinstance(value, float):
        return "NaN" if value != value else format(value, ".10g")
    if isinstance(value, bytes | bytearray):
        return bytes(value).hex()
    return str(value)


def rows_of(table):
    names = sorted(table.column_names)
    columns = [table.column(name).to_pylist() for name in names]
    return names, sorted(tuple(plain(v) for v in row) for row in zip(*columns)), [
        str(table.schema.field(name).type) for name in names
    ]


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session("check", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    db = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    failed = []
    for name in names:
        start = time.time()
        try:
            got = rows_of(QUERIES[name](spark, folder).toArrow())
            took = time.time() - start
            if name not in ORACLE:
                print(f"rows  {name} {len(got[1])} rows {took:.1f}s")
                continue
            want = rows_of(db.execute(ORACLE[name]).to_arrow_table())
        except Exception as error:
            failed.append(name)
            print(f"ERROR {name}: {str(error)[:1500]}")
            if os.environ.get("TRACE"):
                traceback.print_exc()
            continue
        if got[:2] == want[:2]:
            kinds = "" if got[2] == want[2] else f" types {list(zip(got[0], got[2], want[2]))}"
            print(f"ok    {name} {len(got[1])} rows {took:.1f}s{kinds}")
        else:
            failed.append(name)
            only_got = [r for r in got[1] if r not in set(want[1])][:3]
            only_want = [r for r in want[1] if r not in set(got[1])][:3]
            print(f"DIFF  {name} {got[0]} {want[0]} {len(got[1])} vs {len(want[1])}\n  spark {only_got}\n  sql   {only_want}")
        sys.stdout.flush()
    print(f"{len(names) - len(failed)} of {len(names)} good; failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
