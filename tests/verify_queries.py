"""Run the named queries beside their SQL and report differences.

Usage: python tests/verify_queries.py [folder] [name prefix ...]
VERIFY_CONF="name=value,..." adds Spark settings.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = """region nation customer supplier part orders lineitem events documents embeddings
    pages benchmark labels conversations""".split()


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        if not os.path.exists(f"{folder}/{name}.parquet"):
            continue
        con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return con


def difference(df, con, sql: str) -> str | None:
    """None if rows, column names and values agree, else what differs."""
    expected = con.execute(sql)
    names = [column[0] for column in expected.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(set(names) ^ set(df.columns))}"
    order = sorted(names)
    at = [names.index(name) for name in order]
    wanted = sorted((tuple(row[i] for i in at) for row in expected.fetchall()), key=repr)
    given = sorted((tuple(row[name] for name in order) for row in df.collect()), key=repr)
    if len(wanted) != len(given):
        return f"rows: {len(given)} given, {len(wanted)} wanted"
    for mine, theirs in zip(given, wanted):
        for name, a, b in zip(order, mine, theirs):
            if a != b or (a is not None and type(a) is not type(b)):
                return f"column {name}: {a!r} given, {b!r} wanted"
    return None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from tests.sessions import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:])
    extra = dict(pair.split("=") for pair in os.environ.get("VERIFY_CONF", "").split(",") if pair)
    spark = local_session(**extra)
    con, oracle, failed = connect(folder), entry.oracle_sql(), 0
    queries = entry.queries()
    print("without SQL:", sorted(set(queries) - set(oracle)), "without query:", sorted(set(oracle) - set(queries)))
    for name, query in queries.items():
        if name not in oracle or prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            found = difference(query(spark, folder), con, oracle[name])
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:600]}"
        failed += found is not None
        print(f"{name}: {'ok' if found is None else found} ({time.time() - start:.1f}s)", flush=True)
    print("failed:", failed)
    sys.exit(failed > 0)
