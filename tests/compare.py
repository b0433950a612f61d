"""Run queries and their SQL twins side by side: python -m tests.compare [sf] [name ...]"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def session(cores: int = int(os.environ.get("TEST_CORES", "8"))) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName("skygrid")
        .config("spark.sql.shuffle.partitions", str(cores)).config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g").config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    return con


def frame(con, text: str) -> pd.DataFrame:
    cur = con.execute(text)
    return pd.DataFrame(cur.fetchall(), columns=[d[0] for d in cur.description])


def tidy(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].astype(object).where(lambda d: d.notna(), None)
    rows = sorted(df.itertuples(index=False, name=None), key=lambda r: tuple((v is not None, str(v)) for v in r))
    return pd.DataFrame(rows, columns=df.columns, dtype=object)


def differences(got: pd.DataFrame, want: pd.DataFrame, places: int = 4) -> str | None:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} / {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}"
    a, b = tidy(got), tidy(want)
    same = (a == b) | (a.isna() & b.isna())
    if same.all().all():
        return None
    bad = ~same.all(axis=1)
    return f"{int(bad.sum())} of {len(a)} rows differ\n{a[bad].head(4).to_string()}\n--\n{b[bad].head(4).to_string()}"


def main(sf: str, names: list[str]) -> int:
    import __spark_entry__ as entry

    spark, con = session(), connect(sf)
    queries, texts = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in names or queries:
        t0 = time.time()
        try:
            got = queries[name](spark, sf).toPandas()
            t1 = time.time()
            note = f"{len(got)} rows"
            if name in texts:
                problem = differences(got, frame(con, texts[name]))
                note += " ok" if problem is None else f" DIFFERS: {problem}"
                failed += problem is not None
            else:
                note += " (rows only)"
            print(f"{name:28s} {t1 - t0:7.2f}s {time.time() - t1:6.2f}s {note}", flush=True)
        except Exception as e:  # noqa: BLE001
            failed += 1
            print(f"{name:28s} FAILED {type(e).__name__}: {str(e)[:1500]}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    sys.exit(1 if main(folder, sys.argv[2:]) else 0)
