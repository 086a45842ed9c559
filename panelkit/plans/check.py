"""Spark-vs-DuckDB comparison of registered queries (the correctness gate).

Usage: ``python -m panelkit.plans.check [sf_dir] [name ...]``
"""

from __future__ import annotations

import math
import sys
import time

import pandas as pd

from panelkit.sources.tables import TABLES


def duckdb_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = [tuple(_norm(v) for v in rec) for rec in pdf[cols].itertuples(index=False, name=None)]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark_pdf: pd.DataFrame, sql_pdf: pd.DataFrame) -> tuple[bool, str]:
    if sorted(spark_pdf.columns) != sorted(sql_pdf.columns):
        return False, f"columns differ: {sorted(spark_pdf.columns)} vs {sorted(sql_pdf.columns)}"
    if len(spark_pdf) != len(sql_pdf):
        return False, f"row count {len(spark_pdf)} vs {len(sql_pdf)}"
    a, b = _rows(spark_pdf), _rows(sql_pdf)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return False, f"{len(bad)} rows differ, first: {bad[0]}"
    return True, f"{len(a)} rows equal"


def check(spark, sf_dir: str, names: list[str] | None = None, verbose: bool = True) -> dict:
    from panelkit.plans.catalog import all_queries
    reg = all_queries()
    con = duckdb_connection(sf_dir)
    results = {}
    for name, q in reg.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            sdf = q.fn(spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            results[name] = (False, f"spark error: {str(e)[:400]}")
            if verbose:
                print(f"FAIL {name}: {results[name][1]}", flush=True)
            continue
        t1 = time.time()
        if q.sql is None:
            results[name] = (True, f"rows-only: {len(sdf)} rows")
        else:
            try:
                odf = con.execute(q.sql).fetchdf()
                results[name] = compare(sdf, odf)
            except Exception as e:  # noqa: BLE001
                results[name] = (False, f"oracle error: {str(e)[:400]}")
        if verbose:
            ok, msg = results[name]
            print(f"{'ok  ' if ok else 'FAIL'} {name} ({t1 - t0:.1f}s): {msg}", flush=True)
    return results


def main(argv: list[str]) -> int:
    from panelkit.config import local_session
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or None
    spark = local_session()
    res = check(spark, sf_dir, names)
    bad = [n for n, (ok, _) in res.items() if not ok]
    print(f"{len(res) - len(bad)}/{len(res)} ok; failing: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
