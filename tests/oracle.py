"""Compare registered queries with their SQL oracles in DuckDB.

Run as a script: python tests/oracle.py [query names...]
"""

import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


def connect(sf_dir=SF_DIR):
    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "\0null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)):
        return repr(float(v) + 0.0)
    return str(v)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted([tuple(_cell(r[i]) for i in order) for r in rows])


def compare(spark, con, fn, sql, sf_dir=SF_DIR):
    """None when equal, else a description of the first difference."""
    df = fn(spark, sf_dir)
    ours = table(df.columns, [tuple(r) for r in df.collect()])
    rel = con.execute(sql)
    theirs = table([d[0] for d in rel.description], rel.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} vs {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"{len(ours[1])} rows vs {len(theirs[1])}"
    bad = [(a, b) for a, b in zip(ours[1], theirs[1]) if a != b]
    if bad:
        return f"{len(bad)} rows differ, first:\n  {dict(zip(ours[0], bad[0][0]))}\n  {dict(zip(ours[0], bad[0][1]))}"
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    kinds = {d[0]: str(d[1]).lower() for d in rel.description}
    same = {"bigint": "bigint", "int": "integer", "double": "double", "string": "varchar", "boolean": "boolean",
            "timestamp_ntz": "timestamp", "timestamp": "timestamp", "date": "date"}
    odd = {c: (types[c], kinds[c]) for c in types if same.get(types[c]) != kinds[c]}
    return f"types {odd}" if odd else None


def main(names):
    import __spark_entry__ as entry
    from conftest import make_session

    spark, con = make_session(), connect()
    failed = 0
    for name, fn in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        sql = entry.oracle_sql().get(name)
        try:
            if sql is None:
                note = f"rows only: {len(fn(spark, SF_DIR).collect())}"
                ok = True
            else:
                note = compare(spark, con, fn, sql)
                ok = note is None
        except Exception as e:  # report and go on with the next query
            note, ok = f"{type(e).__name__}: {str(e)[:1500]}", False
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s {note or ''}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(set(sys.argv[1:])) else 0)
