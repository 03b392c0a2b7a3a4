"""Run the registered queries beside their oracle SQL and report differences.

    python -m contract.compare /root/testdata/sf0.01 [key ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb

from cellstar.session import build_session
from contract.oracle import ORACLE
from contract.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def difference(spark, con, folder: str, key: str) -> str | None:
    """None when both engines return the same columns and the same rows."""
    found = QUERIES[key](spark, folder)
    ours = rows_of(found.columns, found.collect())
    cursor = con.execute(ORACLE[key])
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(found.columns):
        return f"columns {sorted(found.columns)} against {sorted(names)}"
    theirs = rows_of(names, cursor.fetchall())
    if ours == theirs:
        return None
    extra, missing = ours - theirs, theirs - ours
    return (
        f"{sum(ours.values())} rows against {sum(theirs.values())}; "
        f"only ours {list(extra.items())[:2]}; only theirs {list(missing.items())[:2]}"
    )


def main(folder: str, keys: list[str]) -> int:
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(str(Path(folder)))
    bad = 0
    for key in keys or QUERIES:
        if key not in ORACLE:
            print(f"{key:24s} no oracle")
            continue
        started = time.time()
        try:
            problem = difference(spark, con, folder, key)
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:500]}"
        bad += problem is not None
        print(f"{key:24s} {time.time() - started:6.2f}s {'ok' if problem is None else 'DIFFERS ' + problem}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(min(main(sys.argv[1], sys.argv[2:]), 1))
