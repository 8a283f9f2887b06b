"""Run registered queries next to their SQL and compare.

python scripts/compare.py [--layout=CORES,PARTITIONS] [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
import numpy as np
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def canonical(df: pd.DataFrame) -> list[tuple]:
    """Rows as sorted tuples of plain values, columns by name."""
    df = df[sorted(df.columns)]
    columns = []
    for c in df.columns:
        values = []
        for v in df[c].tolist():
            if isinstance(v, (list, np.ndarray)):
                values.append(str([None if x is None else x for x in list(v)]))
            elif v is None or pd.isna(v):
                values.append(None)
            elif isinstance(v, (float, np.floating)):
                values.append(float(v) + 0.0)
            elif isinstance(v, (bool, np.bool_)):
                values.append(bool(v))
            elif isinstance(v, (int, np.integer)):
                values.append(int(v))
            else:
                values.append(str(v))
        columns.append(values)
    return sorted(zip(*columns), key=lambda row: tuple((x is not None, str(x)) for x in row))


def close(x, y) -> bool:
    if isinstance(x, float) and isinstance(y, float):
        return math.isclose(x, y, rel_tol=2e-5, abs_tol=1.1e-6)
    return x == y


def difference(spark_df: pd.DataFrame, sql_df: pd.DataFrame, exact: bool = True) -> str | None:
    """None when equal, else what differs. `exact=False` lets a value that lies on a rounding boundary
    differ in its last place."""
    if sorted(spark_df.columns) != sorted(sql_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(sql_df.columns)}"
    if len(spark_df) != len(sql_df):
        return f"rows {len(spark_df)} != {len(sql_df)}"
    for c in spark_df.columns:
        a, b = spark_df[c].dropna(), sql_df[c].dropna()
        if len(a) and len(b) and a.dtype.kind != b.dtype.kind and {a.dtype.kind, b.dtype.kind} != {"i", "f"}:
            return f"type of {c}: {a.dtype} != {b.dtype}"
    left, right = canonical(spark_df), canonical(sql_df)
    wrong = [(x, y) for x, y in zip(left, right) if x != y]
    if wrong and not exact:
        def coarse(row: tuple) -> tuple:
            stable = [(v is not None, str(v)) for v in row if not isinstance(v, float)]
            return stable, [float(f"{v:.3g}") for v in row if isinstance(v, float)]

        pairs = zip(sorted(left, key=coarse), sorted(right, key=coarse))
        wrong = [(x, y) for x, y in pairs if not all(close(a, b) for a, b in zip(x, y))]
    if wrong:
        return f"{len(wrong)} rows differ, first {wrong[0][0]} != {wrong[0][1]}"
    return None


def main() -> None:
    from fundloom.catalog import all_oracles, all_queries
    from fundloom.session import local_session

    args = sys.argv[1:]
    cores, partitions = 8, 8
    if args and args[0].startswith("--layout="):
        cores, partitions = map(int, args.pop(0).removeprefix("--layout=").split(","))
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    queries, oracles = all_queries(), all_oracles()
    names = args[1:] or list(queries)
    spark = local_session(cores, partitions)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names:
        begin = time.time()
        try:
            got = queries[name](spark, sf_dir).toPandas()
            took = time.time() - begin
            if name in oracles:
                verdict = difference(got, con.execute(oracles[name]).df())
            else:
                verdict = None
            state = "ok  " if verdict is None else "FAIL"
            note = "" if name in oracles else " (no SQL)"
            print(f"{state} {name} {len(got)} rows {took:.1f}s{note} {verdict or ''}", flush=True)
            failed += verdict is not None
        except Exception as e:  # report and go on with the next query
            failed += 1
            print(f"FAIL {name}: {type(e).__name__}: {str(e)[:1200]}", flush=True)
    print(f"{failed} failed of {len(names)}")


if __name__ == "__main__":
    main()
