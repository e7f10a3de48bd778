"""Run every registered query next to its DuckDB oracle and compare.

    python tests/oracle_check.py [sf_dir] [name ...]

Compares row count, column names and the multiset of rows (columns sorted by
name, values normalised to comparable Python values). Prints one line per
query and exits non-zero on any mismatch.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, bool):
        return int(v)
    return v


# Spark type label -> DuckDB type name, for the schema part of the check.
SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "tinyint": "TINYINT",
    "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
    "binary": "BLOB", "array<float>": "FLOAT[]", "array<string>": "VARCHAR[]", "array<bigint>": "BIGINT[]",
}


def type_mismatches(spark_schema, duck_types: dict) -> list:
    out = []
    for f in spark_schema.fields:
        want = SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
        got = duck_types.get(f.name)
        if got is not None and str(got).upper() != want:
            out.append((f.name, f.dataType.simpleString(), str(got)))
    return out


def rows_key(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, name, fn, sql, sf_dir, con):
    t0 = time.time()
    df = fn(spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    scols = df.columns
    secs = time.time() - t0
    if sql is None:
        return True, f"{name}: rows-only {len(srows)} rows ({secs:.1f}s)"
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    if sorted(scols) != sorted(dcols):
        return False, f"{name}: COLUMNS spark={sorted(scols)} duck={sorted(dcols)}"
    dtypes = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    bad_types = type_mismatches(df.schema, dtypes)
    if bad_types:
        return False, f"{name}: TYPES {bad_types}"
    if len(srows) != len(drows):
        return False, f"{name}: ROWCOUNT spark={len(srows)} duck={len(drows)}"
    a, b = rows_key(scols, srows), rows_key(dcols, drows)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"{name}: VALUES differ, first: {diff}"
    return True, f"{name}: ok {len(srows)} rows ({secs:.1f}s)"


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    import __spark_entry__ as entry
    from quarry.session import local_session

    spark = local_session()
    qs, oracles = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        try:
            ok, msg = compare(spark, name, fn, oracles.get(name), sf_dir, con)
        except Exception as e:  # report and go on
            ok, msg = False, f"{name}: ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(msg, flush=True)
    print(f"{bad} mismatches", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
