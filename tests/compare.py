"""Run registered queries beside their SQL in DuckDB and report differences."""

import datetime
import decimal
import math
import sys
import time
import os

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

took = {}
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return db


def plain(value):
    if isinstance(value, decimal.Decimal):
        return ("n", float(value))
    if isinstance(value, bool) or value is None:
        return ("b", str(value))
    if isinstance(value, (int, float)):
        return ("n", float(value)) if not (isinstance(value, float) and math.isnan(value)) else ("n", "nan")
    if isinstance(value, (datetime.date, datetime.datetime)):
        return ("d", value.isoformat())
    return ("s", str(value))


def table_of(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(plain(r[i]) for i in order) for r in found), key=repr
    )


def compare(spark, db, sf_dir, query, sql):
    """None when equal, else a description of the first differences."""
    df = query(spark, sf_dir)
    began = time.time()
    ours = table_of(df.columns, [tuple(r) for r in df.collect()])
    took["spark"] = time.time() - began
    cursor = db.execute(sql)
    theirs = table_of([d[0] for d in cursor.description], cursor.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} vs {theirs[0]}"
    if ours[1] != theirs[1]:
        left = [r for r in ours[1] if r not in set(theirs[1])][:3]
        right = [r for r in theirs[1] if r not in set(ours[1])][:3]
        return f"{len(ours[1])} vs {len(theirs[1])} rows\n  ours only   {left}\n  theirs only {right}"
    return None if ours[1] or not sql else f"no rows (equal)"


if __name__ == "__main__":
    import __spark_entry__ as entry
    from jobtide.session import local_session

    sf = sys.argv[1]
    wanted = sys.argv[2:]
    spark, db = local_session("8", 8), connect(sf)
    sqls = entry.oracle_sql()
    for name, query in entry.queries().items():
        if wanted and not any(x in name for x in wanted):
            continue
        began = time.time()
        try:
            if name in sqls:
                verdict = compare(spark, db, sf, query, sqls[name]) or "ok"
            else:
                verdict = f"no SQL, {query(spark, sf).count()} rows"
        except Exception as error:
            verdict = f"ERROR {str(error)[:1500]}"
        print(f"{time.time() - began:6.1f}s (collect {took.get('spark', 0):.1f}) {name}: {verdict}", flush=True)
