"""Run a query in Spark and its SQL in DuckDB and compare the rows.

    python -m checks.compare [sf_dir] [query ...]
"""

import sys
import time

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def normal(df: pd.DataFrame) -> pd.DataFrame:
    """Columns and rows in a common order, values as text that both engines write alike."""
    def text(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v) or v is pd.NA:
            return ""
        if isinstance(v, (pd.Timestamp,)):
            return v.isoformat()
        if hasattr(v, "isoformat"):
            return pd.Timestamp(v).isoformat()
        if isinstance(v, bool):
            return str(v)
        if isinstance(v, (int, float)) or hasattr(v, "dtype"):
            return repr(float(v) + 0.0) if str(getattr(v, "dtype", "")) != "bool" else str(bool(v))
        return str(v)

    out = df[sorted(df.columns)].map(text)
    return out.sort_values(list(out.columns)).reset_index(drop=True)


def differences(left: pd.DataFrame, right: pd.DataFrame) -> str:
    """Empty when equal, else what differs."""
    if sorted(left.columns) != sorted(right.columns):
        return f"columns {sorted(set(left.columns) ^ set(right.columns))}"
    if len(left) != len(right):
        return f"{len(left)} rows in Spark, {len(right)} in SQL"
    a, b = normal(left), normal(right)
    wrong = (a != b).any(axis=1)
    if wrong.any():
        i = wrong.idxmax()
        cells = {c: (a.at[i, c], b.at[i, c]) for c in a.columns if a.at[i, c] != b.at[i, c]}
        return f"{int(wrong.sum())} of {len(a)} rows differ, first {cells} at {a.loc[i].to_dict()}"
    return ""


def main() -> None:
    from checks.oracles import ORACLES
    from checks.queries import QUERIES
    from tickloom.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            ours = QUERIES[name](spark, sf_dir).toPandas()
            spent, start = time.time() - start, time.time()
            if name in ORACLES:
                found = differences(ours, con.execute(ORACLES[name]).fetch_df())
                state = f"DIFF {found}" if found else "ok"
            else:
                state = "rows only"
            bad += state.startswith("DIFF")
            print(f"{name}: {state} ({len(ours)} rows, spark {spent:.1f}s, sql {time.time() - start:.1f}s)", flush=True)
        except Exception as e:  # report and go on with the next query
            bad += 1
            print(f"{name}: ERROR {type(e).__name__}: {str(e)[:700]}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
