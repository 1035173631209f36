"""Run registered queries and their SQL side by side: python tests/compare.py SF_DIR [name …]."""

import datetime
import os
import sys
import time
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir):
    con = duckdb.connect()
    for table in TABLES.split():
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def plain(value):
    """A sortable stand-in that keeps type, scale of money and exact doubles apart."""
    if isinstance(value, datetime.datetime):
        return ("datetime", value.isoformat())
    return (type(value).__name__, str(value) if isinstance(value, (Decimal, datetime.date)) else repr(value))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def difference(spark_df, con, sql):
    """None when both give the same rows, else a short account of what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    expected = rows_of(names, result.fetchall())
    actual = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if expected == actual:
        return None
    missing = [r for r in expected if r not in actual][:2] if len(expected) < 5000 else "…"
    surplus = [r for r in actual if r not in expected][:2] if len(actual) < 5000 else "…"
    first = next(((a, e) for a, e in zip(actual, expected) if a != e), None)
    return f"rows {len(actual)} vs {len(expected)}; missing {missing}; surplus {surplus}; first {first}"


def main():
    import __spark_entry__ as entry
    from almsbook.session import local_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = local_session(8)
    con = connect(sf_dir)
    oracles = entry.oracle_sql()
    failed = []
    for name, run in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            problem = difference(run(spark, sf_dir), con, oracles[name])
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
        if problem:
            failed.append(name)
    print("failed:", failed)


if __name__ == "__main__":
    main()
