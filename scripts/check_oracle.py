"""Run every registered query in Spark and its oracle SQL in DuckDB; compare.

    python scripts/check_oracle.py [sf_dir] [name ...]

Compares row count, column names and types, and the multiset of rows (columns
sorted by name, doubles compared to 1e-9 relative). Prints one line per query and
exits non-zero on any mismatch.
"""

from __future__ import annotations

import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import duckdb  # noqa: E402

from dockwise.plans import catalog  # noqa: E402
from dockwise.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

SPARK_TO_DUCK = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def duck_connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.12g}")
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare(spark, con, sf_dir: str, name: str) -> tuple[bool, str]:
    q = catalog.REGISTRY[name]
    t0 = time.time()
    df = q.build(spark, sf_dir)
    s_rows = [tuple(r) for r in df.collect()]
    s_names = df.columns
    s_types = [SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields]
    t_spark = time.time() - t0
    if q.sql is None:
        return True, f"rows={len(s_rows)} (no oracle) spark={t_spark:.2f}s"
    rel = con.sql(q.sql)
    d_names = rel.columns
    d_types = [str(t) for t in rel.types]
    d_rows = rel.fetchall()
    problems = []
    if sorted(s_names) != sorted(d_names):
        problems.append(f"columns spark={s_names} duck={d_names}")
    else:
        st = dict(zip(s_names, s_types))
        dt = dict(zip(d_names, d_types))
        bad = {c: (st[c], dt[c]) for c in s_names if st[c] != dt[c]}
        if bad:
            problems.append(f"types {bad}")
    if len(s_rows) != len(d_rows):
        problems.append(f"rows spark={len(s_rows)} duck={len(d_rows)}")
    elif not problems and canonical(s_rows, s_names) != canonical(d_rows, d_names):
        a, b = canonical(s_rows, s_names), canonical(d_rows, d_names)
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        problems.append(f"values differ, e.g. {diff}")
    status = "; ".join(problems) if problems else "ok"
    return not problems, f"rows={len(s_rows)} spark={t_spark:.2f}s {status}"


def main(argv: list[str]) -> int:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(catalog.REGISTRY)
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck_connect(sf_dir)
    failed = 0
    for n in names:
        try:
            ok, msg = compare(spark, con, sf_dir, n)
        except Exception as e:  # report and go on
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e).splitlines()[0][:300]}"
        failed += not ok
        print(f"{'PASS' if ok else 'FAIL'} {n}: {msg}", flush=True)
    print(f"{len(names) - failed}/{len(names)} passed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
