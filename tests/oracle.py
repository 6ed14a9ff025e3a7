"""Run registered queries and their SQL side by side.

    python -m tests.oracle [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return db


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, bool):
        return str(int(value))
    if isinstance(value, float):
        return repr(value)
    return str(value)


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, db, sf_dir: str, query, sql: str) -> str | None:
    """None when equal, otherwise a description of the first difference."""
    frame = query(spark, sf_dir)
    mine = _rows(frame.columns, frame.collect())
    result = db.execute(sql)
    names = [d[0] for d in result.description]
    theirs = _rows(names, result.fetchall())
    if sorted(frame.columns) != sorted(names):
        return f"columns {frame.columns} / {names}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} / {len(theirs)}"
    for a, b in zip(mine, theirs):
        if a != b:
            return f"{a} / {b}"
    return None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from tillhouse.session import local_session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark, db, failed = local_session(), connect(sf_dir), []
    checks = oracle_sql()
    for name, run in queries().items():
        if args and name not in args:
            continue
        start = time.time()
        try:
            if name in checks:
                problem = compare(spark, db, sf_dir, run, checks[name])
            else:
                problem = None if run(spark, sf_dir).count() else "no rows"
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
        if problem:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
