"""Compare every query with its SQL on one scale: ``python tests/oracle_check.py DIR [names]``."""

from __future__ import annotations

import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, every value as text, rows in order."""

    def text(value: object) -> str:
        if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and value != value):
            return "NULL"
        if isinstance(value, bool):
            return str(value)
        if isinstance(value, (int, float)):
            return repr(float(value) + 0.0)
        if hasattr(value, "isoformat"):
            return pd.Timestamp(value).isoformat()
        return str(value)

    df = df[sorted(df.columns)].astype(object)
    df = df.map(lambda v: text(v.item() if hasattr(v, "item") else v))
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def compare(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """None when equal, otherwise what differs."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    got, want = canonical(got), canonical(want)
    bad = (got != want).any(axis=1)
    if bad.any():
        i = bad.idxmax()
        diff = [c for c in got.columns if got.at[i, c] != want.at[i, c]]
        return f"{bad.sum()} rows differ, first in {[(c, got.at[i, c], want.at[i, c]) for c in diff]}"
    return None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries

    from candlemill.session import build_session

    sf_dir, only = sys.argv[1], sys.argv[2:]
    spark = build_session(
        "oracle-check",
        os.environ.get("MASTER", "local[8]"),
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed, sql, got = connect(sf_dir), 0, oracle_sql(), []
    for name, query in queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            got = query(spark, sf_dir).toPandas()
            problem = compare(got, con.execute(sql[name]).df()) if name in sql else "no SQL"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{name:28s} {time.time() - start:6.2f}s {len(got):8d} rows  {problem or 'equal'}", flush=True)
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(main())
