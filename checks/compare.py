"""Run registered queries against their SQL: ``python -m checks.compare [sf_dir] [names...]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

from checks.oracles import ORACLES
from checks.queries import QUERIES
from registry_spark.session import local_session


SAME_TYPE = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def cell(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else round(value, 9)
    return str(value) if value is not None else None


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(cell(r[i]) for i in order) for r in data), key=lambda r: tuple(map(str, r)))


def compare(spark, con, sf_dir: str, name: str) -> tuple[bool, str]:
    started = time.time()
    got = QUERIES[name](spark, sf_dir)
    left = rows(got.columns, got.collect())
    took = time.time() - started
    want = con.execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    kinds = {d[0]: str(d[1]) for d in want.description}
    right = rows(columns, want.fetchall())
    if sorted(got.columns) != sorted(columns):
        return False, f"columns {sorted(got.columns)} <> {sorted(columns)}"
    if left != right:
        only_left = [r for r in left if r not in set(right)][:3]
        only_right = [r for r in right if r not in set(left)][:3]
        return False, f"{len(left)} <> {len(right)} rows\n   spark {only_left}\n   sql   {only_right}"
    types = {f.name: f.dataType.simpleString() for f in got.schema.fields}
    odd = [f"{c}:{types[c]}/{kinds[c]}" for c in columns if SAME_TYPE.get(types[c]) != kinds[c]]
    return True, f"{len(left)} rows, {took:.2f}s {' '.join(odd)}"


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or list(QUERIES)
    spark = local_session("compare", 8)
    con = connect(sf_dir)
    bad = 0
    for name in names:
        try:
            good, note = compare(spark, con, sf_dir, name)
        except Exception as error:
            good, note = False, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += not good
        print("ok  " if good else "FAIL", name, note, flush=True)
    print(f"{len(names) - bad} of {len(names)} match")
    return bad


if __name__ == "__main__":
    sys.exit(main())
