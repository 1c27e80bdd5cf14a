"""Run a query and its SQL on the same folder and compare the rows.

As a script: ``python -m tests.compare [folder] [query ...]``.
"""

from __future__ import annotations

import math
import sys
import time
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Type families that must agree between both results.
FAMILIES = {
    "tinyint": "int", "smallint": "int", "int": "int", "integer": "int", "bigint": "int",
    "double": "float", "float": "float", "string": "text", "varchar": "text",
    "boolean": "bool", "timestamp_ntz": "time", "timestamp": "time", "date": "date",
}


def connect(folder: str):
    con = duckdb.connect()
    for table in TABLES:
        path = Path(folder) / f"{table}.parquet"
        con.execute(f"create view {table} as select * from read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        assert not math.isnan(value) and not math.isinf(value), value
        return round(value, 9) + 0.0
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _sorted(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    relation = con.sql(sql)
    theirs = {name: str(kind).lower() for name, kind in zip(relation.columns, relation.types)}
    ours = dict(df.dtypes)
    names = sorted(ours)
    if names != sorted(theirs):
        return f"columns {sorted(set(ours) ^ set(theirs))}"
    for name in names:
        a, b = FAMILIES.get(ours[name], ours[name]), FAMILIES.get(theirs[name], theirs[name])
        if a != b:
            return f"type of {name}: {ours[name]} / {theirs[name]}"
    left = _sorted(tuple(_plain(row[n]) for n in names) for row in df.collect())
    place = [relation.columns.index(n) for n in names]
    right = _sorted(tuple(_plain(row[i]) for i in place) for row in relation.fetchall())
    if left == right:
        return None
    extra = [row for row in left if row not in set(right)][:2]
    lacking = [row for row in right if row not in set(left)][:2]
    return f"{len(left)} / {len(right)} rows; {names}; only here {extra}; only there {lacking}"


def main() -> None:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry
    from storelens.session import build_session

    args = sys.argv[1:]
    folder = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark = build_session("compare", "local[8]", **{"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in args or queries:
        start = time.time()
        try:
            df = queries[name](spark, folder)
            if name in oracles:
                difference = compare(df, con, oracles[name])
                count = len(con.sql(oracles[name]).fetchall())
            else:
                difference, count = None, df.count()
        except Exception as error:  # report and go on with the next query
            difference, count = f"{type(error).__name__}: {str(error)[:1500]}", -1
        bad += difference is not None
        state = "ok" if difference is None else "DIFF"
        print(f"{state:5}{name:32}{count:8} rows {time.time() - start:6.1f}s {difference or ''}", flush=True)
    print(f"{bad} differ")


if __name__ == "__main__":
    main()
