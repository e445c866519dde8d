"""Run registered queries next to their SQL: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _sorted(df: pd.DataFrame) -> list[tuple]:
    """Rows in one order, cells as text, so that equal results compare equal."""
    columns = sorted(df.columns)
    cells = [[None if pd.isna(v) else repr(v) for v in df[c].tolist()] for c in columns]
    return sorted(zip(*cells), key=lambda r: tuple((v is None, v or "") for v in r))


def difference(ours: pd.DataFrame, theirs: pd.DataFrame) -> str | None:
    """What differs, or None."""
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} against {sorted(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    for c in ours.columns:
        kinds = {ours[c].dtype.kind, theirs[c].dtype.kind}
        if kinds == {"i", "f"} and not (ours[c].isna().any() or theirs[c].isna().any()):
            return f"type of {c}: {ours[c].dtype} against {theirs[c].dtype}"
    left, right = ours.copy(), theirs.copy()
    for c in ours.columns:  # a nullable integer column arrives as float on one side only
        if left[c].dtype.kind != right[c].dtype.kind and {left[c].dtype.kind, right[c].dtype.kind} <= {"i", "f"}:
            left[c], right[c] = left[c].astype("float64"), right[c].astype("float64")
    for a, b in zip(_sorted(left), _sorted(right)):
        if a != b:
            return f"{a}\n   against {b}"
    return None


def main(argv: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    from checks.catalogue import QUERIES, SQL
    from slatecraft.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = argv[1:] or list(QUERIES)
    names = [n for n in QUERIES if any(n == w or n.startswith(w) for w in wanted)]
    spark = build_session("compare", "local[8]", **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = []
    for name in names:
        start = time.perf_counter()
        try:
            ours = QUERIES[name](spark, sf_dir).toPandas()
            took = time.perf_counter() - start
            found = difference(ours, con.execute(SQL[name]).df()) if name in SQL else "rows only"
        except Exception as error:  # report every query of the run
            took, found = time.perf_counter() - start, f"{type(error).__name__}: {str(error)[:1500]}"
            ours = pd.DataFrame()
        ok = found in (None, "rows only")
        if not ok:
            failed.append(name)
        print(f"{'ok  ' if ok else 'FAIL'} {name} rows={len(ours)} {took:.2f}s {found or ''}", flush=True)
    print(f"{len(names) - len(failed)} of {len(names)} agree; failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
