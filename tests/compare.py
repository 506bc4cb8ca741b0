"""Run queries next to their SQL and report differences: ``python tests/compare.py [dir] [names...]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from __spark_entry__ import ALL_ORACLES as ORACLES  # noqa: E402
from __spark_entry__ import ALL_QUERIES as QUERIES  # noqa: E402


def oracle(sf_dir: str, sql: str) -> pd.DataFrame:
    con = duckdb.connect()
    for name in sorted(os.listdir(sf_dir)):
        con.execute(f"create view {name.split('.')[0]} as select * from '{sf_dir}/{name}'")
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    return pd.DataFrame(cursor.fetchall(), columns=names)


def normal(frame: pd.DataFrame) -> list[tuple]:
    def value(v):
        if v is None or v != v:
            return None
        return round(float(v), 10) + 0.0 if isinstance(v, (int, float)) and not isinstance(v, bool) else v

    columns = sorted(frame.columns)
    out = [tuple(value(v) for v in row) for row in frame[columns].astype(object).itertuples(index=False)]
    return sorted(out, key=lambda row: [(v is not None, str(v)) for v in row])


def differences(spark, sf_dir: str, name: str) -> str | None:
    """None when both sides hold the same rows."""
    got_df = QUERIES[name](spark, sf_dir)
    got = pd.DataFrame([tuple(r) for r in got_df.collect()], columns=got_df.columns, dtype=object)
    want = oracle(sf_dir, ORACLES[name])
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} and {sorted(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows, {len(want)} expected"
    a, b = normal(got), normal(want)
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(wrong)} of {len(a)} rows differ, first {wrong[0]}" if wrong else None


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    for query in sys.argv[2:] or ORACLES:
        start = time.time()
        try:
            result = differences(session, sf, query) or "ok"
        except Exception as error:
            result = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{query:28s} {time.time() - start:6.1f}s  {result}", flush=True)
