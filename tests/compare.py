"""Spark results against DuckDB results of the same name."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "documents"]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        files = f"{path}/*.parquet" if path.is_dir() else path
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{files}'")
    return con


def _canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if pd.api.types.is_datetime64_any_dtype(df[c]):
            df[c] = df[c].astype("datetime64[us]")
        elif pd.api.types.is_bool_dtype(df[c]):
            df[c] = df[c].astype("boolean")
        elif pd.api.types.is_integer_dtype(df[c]) or pd.api.types.is_float_dtype(df[c]):
            df[c] = df[c].astype("float64")
        else:
            df[c] = df[c].astype("string")
    return df.sort_values(list(df.columns), na_position="last").reset_index(drop=True)


def compare(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both results hold the same rows, or the first difference."""
    ours, theirs = spark_df.toPandas(), con.execute(sql).df()
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} != {sorted(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    if not len(ours):
        return "no rows"
    ours, theirs = _canonical(ours), _canonical(theirs)
    for c in ours.columns:
        equal = (ours[c] == theirs[c]) | (ours[c].isna() & theirs[c].isna())
        if not equal.fillna(False).all():
            at = (~equal.fillna(False)).idxmax()
            return (f"{c}: {(~equal.fillna(False)).sum()} differ, first {ours[c][at]!r} !="
                    f" {theirs[c][at]!r}\n{ours.loc[at].to_dict()}\n{theirs.loc[at].to_dict()}")
    return None


if __name__ == "__main__":
    from __spark_entry__ import entry, oracle_sql, queries
    from gaugelake.session import get_session

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    session = get_session("compare", "local[8]", 8)
    session.sparkContext.setLogLevel("ERROR")
    con, oracle = connect(sf_dir), oracle_sql()
    bad = 0
    if not wanted:
        print("entry", len(entry(session).collect()))
        print("no oracle:", sorted(set(queries()) - set(oracle)), "no query:", sorted(set(oracle) - set(queries())))
    for name, run in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            difference = compare(run(session, sf_dir), con, oracle[name])
        except Exception as e:  # noqa: BLE001 - report and go on with the next query
            difference = f"{type(e).__name__}: {str(e)[-600:]}"
        bad += difference is not None
        print(f"{'OK  ' if difference is None else 'DIFF'} {name} {time.time() - start:.2f}s"
              + (f"\n     {difference}" if difference else ""), flush=True)
    print("differences:", bad)
