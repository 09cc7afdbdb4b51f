"""Run registered queries against their oracle SQL: python check.py [sf_dir] [name prefix ...]."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd

from gustline.plans.catalog import ORACLE, QUERIES
from gustline.session import build_session


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for c in frame.columns:
        kind = frame[c].dtype.kind
        if kind in "iub":
            frame[c] = frame[c].astype("int64" if kind != "b" else "bool")
        elif kind == "M":
            frame[c] = frame[c].astype("datetime64[us]")
        elif kind == "O":
            frame[c] = frame[c].map(lambda v: None if v is None or v != v else (
                str(v.tolist()) if hasattr(v, "tolist") else str(v)))
    if len(frame.columns) and len(frame):
        frame = frame.sort_values(list(frame.columns), na_position="last")
    return frame.reset_index(drop=True)


def compare(mine: pd.DataFrame, theirs: pd.DataFrame) -> str:
    if sorted(mine.columns) != sorted(theirs.columns):
        return f"COLUMNS {sorted(set(mine.columns) ^ set(theirs.columns))}"
    if len(mine) != len(theirs):
        return f"ROWS {len(mine)} vs {len(theirs)}"
    a, b = normal(mine), normal(theirs)
    bad = []
    for c in a.columns:
        if a[c].dtype.kind != b[c].dtype.kind:
            bad.append(f"{c}: type {a[c].dtype} vs {b[c].dtype}")
            continue
        diff = ~((a[c] == b[c]) | (a[c].isna() & b[c].isna()))
        if diff.any():
            i = diff[diff].index[0]
            bad.append(f"{c}: {int(diff.sum())} differ, e.g. {a[c][i]!r} vs {b[c][i]!r}")
    widths = [f"{c} {mine[c].dtype}/{theirs[c].dtype}" for c in a.columns if mine[c].dtype != theirs[c].dtype]
    return "; ".join(bad) or ("ok" if not widths else f"ok, widths {widths}")


def main() -> None:
    args = sys.argv[1:]
    sf = args[0] if args else "/root/testdata/sf0.01"
    names = [n for n in QUERIES if len(args) < 2 or any(n.startswith(p) for p in args[1:])]
    spark = build_session(
        "check", os.environ.get("CHECK_MASTER", "local[8]"),
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    db = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        table = os.path.basename(path)[:-8]
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    failed = []
    for name in names:
        begin = time.time()
        try:
            mine = QUERIES[name](spark, sf).toPandas()
            took = time.time() - begin
            if name in ORACLE:
                begin = time.time()
                result = compare(mine, db.execute(ORACLE[name]).df())
                oracle = time.time() - begin
            else:
                result, oracle = "ok (rows only)", 0.0
        except Exception as error:  # report and go on with the next query
            took, oracle, result = time.time() - begin, 0.0, f"ERROR {str(error)[:600]}"
            mine = pd.DataFrame()
        if not result.startswith("ok"):
            failed.append(name)
        print(f"{name:42s} {took:6.2f}s {oracle:5.2f}s rows={len(mine):7d} {result}", flush=True)
    print(f"{len(names) - len(failed)}/{len(names)} ok; failed: {failed}")


if __name__ == "__main__":
    main()
