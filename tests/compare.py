"""Registered queries beside their SQL: row counts, columns and values, in any row order.

    python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from datetime import date, datetime
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

import __spark_entry__ as contract  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def plain(value):
    if isinstance(value, float):
        return float(f"{value:.9g}")
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def expected(sf_dir: str, name: str):
    with duckdb.connect() as db:
        for table in TABLES:
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
        result = db.execute(contract.oracle_sql()[name])
        names = [c[0] for c in result.description]
        return names, [str(c[1]) for c in result.description], result.fetchall()


def difference(spark, sf_dir: str, name: str) -> str | None:
    """What is not the same, or None."""
    got = contract.queries()[name](spark, sf_dir)
    got_rows = rows_of(got.columns, got.collect())
    if name not in contract.oracle_sql():
        return None if got_rows else "no rows"
    names, _, rows = expected(sf_dir, name)
    if sorted(names) != sorted(got.columns):
        return f"columns {sorted(got.columns)} against {sorted(names)}"
    want_rows = rows_of(names, rows)
    if len(got_rows) != len(want_rows):
        return f"{len(got_rows)} rows against {len(want_rows)}"
    for got_row, want_row in zip(got_rows, want_rows):
        if got_row != want_row:
            return f"{got_row} against {want_row}"
    return None


def types(spark, sf_dir: str, name: str):
    got = contract.queries()[name](spark, sf_dir)
    names, kinds, _ = expected(sf_dir, name)
    spark_types = {f.name: f.dataType.simpleString() for f in got.schema}
    return {n: (spark_types[n], k) for n, k in zip(names, kinds)}


if __name__ == "__main__":
    from riverglass import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(contract.queries())
    session = build_session(master="local[8]", spark__sql__shuffle__partitions="8",
                            spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
                            spark__driver__memory="8g")
    session.sparkContext.setLogLevel("OFF")
    for query in chosen:
        begun = time.time()
        try:
            problem = difference(session, folder, query)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        kind = "" if query in contract.oracle_sql() else " (rows only)"
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - begun:6.1f}s {query}{kind}"
              f"{'' if problem is None else ': ' + problem}", flush=True)
