"""Run queries next to their SQL and compare the rows.

    python -m workload.check /root/testdata/sf0.01 [name …]
"""

from __future__ import annotations

import glob
import os
import sys
import time
from collections import Counter

import duckdb

from workload.oracles import ORACLES
from workload.queries import QUERIES


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def compare(spark, con: duckdb.DuckDBPyConnection, name: str, sf_dir: str) -> str | None:
    """None where rows, columns and values agree, else what differs."""
    got = QUERIES[name](spark, sf_dir)
    want = con.execute(ORACLES[name])
    columns = sorted(got.columns)
    names = [d[0] for d in want.description]
    if columns != sorted(names):
        return f"columns {columns} != {sorted(names)}"
    order = [names.index(c) for c in columns]
    expected = Counter(tuple(row[i] for i in order) for row in want.fetchall())
    actual = Counter(tuple(row) for row in got.select(*columns).collect())
    if actual == expected:
        return None
    return (
        f"{sum(actual.values())} rows, expected {sum(expected.values())}\n"
        f"  only here:  {list((actual - expected).items())[:3]}\n"
        f"  only there: {list((expected - actual).items())[:3]}"
    )


def main(argv: list[str]) -> int:
    from workload.session import local_session

    sf_dir, names = argv[0], argv[1:] or list(QUERIES)
    spark, con, failed = local_session(), oracle_connection(sf_dir), 0
    for name in names:
        began = time.perf_counter()
        try:
            problem = compare(spark, con, name, sf_dir)
        except Exception as exc:  # report and go on
            problem = f"{type(exc).__name__}: {str(exc)[:1500]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.perf_counter() - began:.1f}s {problem or ''}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
