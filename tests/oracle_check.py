"""Compare registered queries with their SQL: ``python tests/oracle_check.py sf_dir [names]``."""

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
import __spark_entry__ as entry  # noqa: E402
from causal_logs.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    con.execute("SET TimeZone = 'UTC'")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def compare(spark, con, name, sf_dir):
    """(spark columns, sql columns, spark rows, sql rows), rows in one order."""
    df = entry.queries()[name](spark, sf_dir)
    mine = _rows(df.columns, df.collect())
    cur = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    return sorted(df.columns), sorted(columns), mine, _rows(columns, cur.fetchall())


if __name__ == "__main__":
    sf = sys.argv[1]
    session = local_session(8, spark__sql__shuffle__partitions="8", spark__driver__memory="12g")
    session.sparkContext.setLogLevel("ERROR")
    db = duck(sf)
    names = sys.argv[2:] or list(entry.queries())
    for n in names:
        t = time.time()
        if n not in entry.oracle_sql():
            print(f"{n}: {entry.queries()[n](session, sf).count()} rows, no SQL, {time.time() - t:.1f}s", flush=True)
            continue
        a, b, x, y = compare(session, db, n, sf)
        verdict = "ok" if a == b and x == y else "DIFFERS"
        print(f"{n}: {verdict} {len(x)} {len(y)} {time.time() - t:.1f}s", flush=True)
        if verdict != "ok":
            print("  ", a, b)
            for p, q in [(p, q) for p, q in zip(x, y) if p != q][:3]:
                print("  ", p, "|", q)
