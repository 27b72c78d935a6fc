"""Compare every query with its SQL: ``python -m verification.check [folder] [name ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from partylens.session import build_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return value


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def compare(df, con, sql: str) -> str | None:
    """What differs, or None."""
    got_names = df.columns
    relation = con.sql(sql)
    want_names = relation.columns
    if sorted(got_names) != sorted(want_names):
        return f"columns {sorted(got_names)} / {sorted(want_names)}"
    types, want_types = dict(df.dtypes), dict(zip(want_names, map(str, relation.types)))
    for name, kind in types.items():
        if TYPES.get(kind) != want_types[name]:
            return f"type of {name}: {kind} / {want_types[name]}"
    left, right = _rows(got_names, df.collect()), _rows(want_names, relation.fetchall())
    if len(left) != len(right):
        return f"rows {len(left)} / {len(right)}"
    for x, y in zip(left, right):
        if x != y:
            return f"{sorted(got_names)}: {x} / {y}"
    return None


def main(argv: list[str]) -> int:
    from verification import QUERIES, SQL

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    names = [n for n in QUERIES if len(argv) < 2 or any(n.startswith(a) for a in argv[1:])]
    spark = build_session(master="local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8",
                          spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("OFF")
    con, bad = connect(folder), 0
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, folder)
            note = compare(df, con, SQL[name]) if name in SQL else f"rows only: {df.count()}"
        except Exception as error:  # report and go on
            note = f"{type(error).__name__}: {str(error)[:400]}"
        wrong = note is not None and not note.startswith("rows only")
        bad += wrong
        print(f"{'BAD' if wrong else 'ok '} {name} {time.time() - start:.1f}s {note or ''}", flush=True)
    print(f"{len(names)} queries, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]) > 0)
