"""Run every registered query and its SQL twin and compare names, row counts and values.

    python -m checks.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

from .oracle import ORACLE
from .queries import QUERIES


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return value + 0.0
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def difference(spark, con, name: str, sf_dir: str) -> str | None:
    """None when both sides agree, else what differs."""
    df = QUERIES[name](spark, sf_dir)
    mine = rows_of(df.columns, df.collect())
    result = con.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(set(columns) ^ set(df.columns))}"
    theirs = rows_of(columns, result.fetchall())
    if not mine and not theirs:
        return "no rows"  # both agree, but nothing was compared
    if mine != theirs:
        a, b = mine - theirs, theirs - mine
        return f"{sum(a.values())} of {sum(mine.values())} rows differ\n    {sorted(df.columns)}\n    " + (
            "\n    ".join(f"{s} {x}" for s, c in (("spark", a), ("sql", b)) for x in sorted(c, key=str)[:3])
        )
    return None


def main() -> int:
    from .session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, con, bad = local_session("compare"), connect(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            problem = difference(spark, con, name, sf_dir) if name in ORACLE else "no SQL"
        except Exception as e:  # report and go on to the next query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
