"""Compare a query with its SQL counterpart: columns, row count and values."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _text(value) -> str:
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return "NULL"
    if isinstance(value, (bool,)) or type(value).__name__ == "bool_":
        return str(bool(value))
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    if hasattr(value, "tolist"):
        value = value.tolist()
    if isinstance(value, float):
        return repr(value if value != 0 else 0.0)
    return str(value)


def rows_of(frame: pd.DataFrame) -> list[tuple[str, ...]]:
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(tuple(_text(v) for v in row) for row in frame.itertuples(index=False))


def differences(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} != {sorted(sql_frame.columns)}"
    a, b = rows_of(spark_frame), rows_of(sql_frame)
    if a == b:
        return None
    only_a = sorted(set(a) - set(b))[:2]
    only_b = sorted(set(b) - set(a))[:2]
    return f"{len(a)} rows vs {len(b)}\n  spark {only_a}\n  sql   {only_b}"


def kinds(spark_df, sql_frame: pd.DataFrame) -> str:
    """Column types side by side where they look different."""
    same = {"bigint": "int64", "int": "int32", "double": "float64", "string": "object",
            "timestamp_ntz": "datetime64[us]", "boolean": "bool"}
    out = []
    for name, kind in spark_df.dtypes:
        other = str(sql_frame[name].dtype)
        if same.get(kind) != other and not (kind == "string" and other in ("str", "object")):
            out.append(f"{name}: {kind}/{other}")
    return ", ".join(out)


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from tests.session import local_session

    import __spark_entry__ as entry

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = database(sf_dir)
    sqls = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            got = df.toPandas()
            took = time.time() - start
            if name not in sqls:
                print(f"rows  {name:32} {len(got):7} rows {took:6.2f}s", flush=True)
                continue
            start = time.time()
            want = con.execute(sqls[name]).df()
            sql_took = time.time() - start
            diff = differences(got, want)
            note = kinds(df, want)
        except Exception as error:
            diff, took, sql_took, note, got = f"{type(error).__name__}: {str(error)[:1500]}", 0, 0, "", []
        bad += diff is not None
        print(f"{'ok  ' if diff is None else 'DIFF'}  {name:32} {len(got):7} rows {took:6.2f}s sql {sql_took:5.2f}s  {note}", flush=True)
        if diff:
            print("   ", diff[:1800], flush=True)
    print("different:", bad)


if __name__ == "__main__":
    main()
