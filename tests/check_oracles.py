"""Run registered queries against their oracle SQL: ``python tests/check_oracles.py [names…]``."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def plain(value):
    """Comparable form that still tells 1 from '1' and int from float."""
    if isinstance(value, float):
        return "nan" if math.isnan(value) else ("f", value + 0.0)
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int):
        return ("i", value)
    return str(value)


def compare(df, con, sql: str) -> str:
    """Empty when equal, else what differs."""
    names = sorted(df.columns)
    got = [tuple(plain(row[n]) for n in names) for row in df.collect()]
    relation = con.sql(sql)
    if sorted(relation.columns) != names:
        return f"columns {names} != {sorted(relation.columns)}"
    order = [relation.columns.index(n) for n in names]
    want = [tuple(plain(row[i]) for i in order) for row in relation.fetchall()]
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    extra, missing = Counter(got) - Counter(want), Counter(want) - Counter(got)
    if extra or missing:
        return f"{sum(extra.values())} rows differ; e.g. {names}\n   got  {sorted(extra, key=str)[:2]}\n   want {sorted(missing, key=str)[:2]}"
    return ""


def main(names: list[str]) -> int:
    import __spark_entry__ as entry

    from touchline.session import build_session

    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = build_session(
        "oracles", spark__master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, failed = duck(sf), entry.oracle_sql(), []
    for name, run in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = compare(run(spark, sf), con, oracles[name])
            else:
                problem = "" if run(spark, sf).count() else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{'ok  ' if not problem else 'FAIL'} {time.time() - start:6.1f}s {name} {problem}", flush=True)
        if problem:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
    spark.stop()
    return len(failed)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
