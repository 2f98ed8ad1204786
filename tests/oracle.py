"""Compare a registered query with its SQL, values and all. Also a command line tool."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(root: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{root}/{name}.parquet'")
    return con


def _norm(v):
    if v is None or isinstance(v, (str, bool)):
        return v
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.12g}") + 0.0
    return v


def _table(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), v) if v is not None else (True, "", 0) for v in r))


def compare(df, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    kinds = {d[0]: str(d[1]) for d in rel.description}
    want = _table(rel.fetchall(), names)
    got = _table([tuple(r) for r in df.collect()], df.columns)
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows vs {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"{g!r} vs {w!r}"[:600]
    pairs = [(c, t, kinds[c]) for c, t in df.dtypes]
    plain = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    odd = [p for p in pairs if plain.get(p[1], p[2]) != p[2]]
    return f"types {odd}" if odd else None


def main(root: str, only: list[str]) -> None:
    from tamarack.plans import REGISTRY
    from tamarack.session import local_session

    spark = local_session(8)
    con = connect(root)
    failed = []
    for name, q in REGISTRY.items():
        if only and not any(o in name for o in only):
            continue
        start = time.time()
        try:
            df = q.run(spark, root)
            problem = compare(df, con, q.sql) if q.sql else f"rows only: {len(df.collect())}"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:700]}"
        mark = "ok  " if problem is None or problem.startswith("rows only") else "FAIL"
        if mark == "FAIL":
            failed.append(name)
        print(f"{mark} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
