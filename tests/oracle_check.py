"""Run registered queries in Spark and their oracle SQL in DuckDB, and compare
(row count, column names, order-insensitive values).

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if hasattr(v, "isoformat"):
        return str(v)[:10] if len(str(v)) >= 10 and str(v)[10:].strip() in ("", "00:00:00") else str(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    try:
        import numpy as np

        if isinstance(v, np.generic):
            return _norm(v.item())
    except Exception:
        pass
    return v


def rows_of(records, cols):
    return sorted(
        (tuple(_norm(r[c]) for c in cols) for r in records),
        key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t),
    )


def compare(spark_df, sql: str, con) -> tuple[bool, str]:
    s_cols = sorted(spark_df.columns)
    s_rows = [r.asDict() for r in spark_df.collect()]
    d = con.execute(sql).fetchdf()
    d_cols = sorted(d.columns)
    if s_cols != d_cols:
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    d_rows = d.astype(object).where(pd.notna(d), None).to_dict("records")
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} duck={len(d_rows)}"
    a, b = rows_of(s_rows, s_cols), rows_of(d_rows, d_cols)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return False, f"{len(bad)} rows differ, e.g. spark={bad[0][0]} duck={bad[0][1]}"
    return True, f"{len(a)} rows"


def main(argv):
    from souk.session import local_session

    import __spark_entry__ as E

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = local_session()
    con = duck(sf_dir)
    qs, orc = E.queries(), E.oracle_sql()
    failed = 0
    for name in names or list(qs):
        t = time.time()
        df = qs[name](spark, sf_dir)
        if name not in orc:
            n = df.count()
            print(f"ROWS  {name}: {n} rows ({time.time() - t:.1f}s)", flush=True)
            continue
        ok, msg = compare(df, orc[name], con)
        failed += not ok
        print(f"{'OK  ' if ok else 'FAIL'}  {name}: {msg} ({time.time() - t:.1f}s)", flush=True)
    print(f"failed={failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
