"""Run queries and their SQL on the same tables and compare all rows."""

import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


def tables(folder):
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def text(value):
        if value is None:
            return "\0null"
        if isinstance(value, bool):
            return str(value).lower()
        if isinstance(value, float):
            return f"{value:.9g}"
        if isinstance(value, Decimal):
            return f"{value:.6f}"
        return str(value)

    return sorted(tuple(text(row[i]) for i in order) for row in rows)


def compare(spark, con, folder, name, query, sql):
    """``(equal, rows, message)``"""
    frame = query(spark, folder)
    got = canonical(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = canonical(names, cursor.fetchall())
    if sorted(frame.columns) != sorted(names):
        return False, len(got), f"columns {sorted(frame.columns)} != {sorted(names)}"
    if got != want:
        extra = [r for r in got if r not in set(want)][:2]
        lacking = [r for r in want if r not in set(got)][:2]
        return False, len(got), f"{len(got)} rows against {len(want)}: {extra} / {lacking}"
    return True, len(got), ""


if __name__ == "__main__":
    import __spark_entry__ as e
    from claimworks.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark, con, sqls = local_session(8), tables(folder), e.oracle_sql()
    for name, query in e.queries().items():
        if name not in sqls or only and name not in only:
            continue
        started = time.perf_counter()
        try:
            equal, rows, message = compare(spark, con, folder, name, query, sqls[name])
        except Exception as error:
            equal, rows, message = False, -1, f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok  ' if equal else 'FAIL'} {name:28s} {rows:7d} rows {time.perf_counter() - started:6.2f} s {message}", flush=True)
