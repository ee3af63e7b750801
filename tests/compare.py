"""Runs queries next to their SQL in DuckDB and compares values. Also a command: python tests/compare.py [names]."""

from __future__ import annotations

import math
import os
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(v):
    if v is None:
        return ""
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{v + 0.0:.9g}" if v else "0"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return f"{v:.9g}" if abs(v) < 1e9 else str(v)
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def diff(df, con, sql_text) -> str | None:
    """None when equal, else a short account of the difference."""
    left = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql_text)
    right = rows_of([c[0] for c in cur.description], cur.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} != {right[0]}"
    if left[1] == right[1]:
        return None if left[1] else "both empty"
    only_left = [r for r in left[1] if r not in set(right[1])][:3]
    only_right = [r for r in right[1] if r not in set(left[1])][:3]
    return f"rows {len(left[1])} vs {len(right[1])}\n   cols {left[0]}\n   spark {only_left}\n   sql   {only_right}"


def main() -> None:
    from pyspark.sql import SparkSession

    from scoreloom.plans.catalog import ORACLES, QUERIES

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    wanted = sys.argv[1:]
    for name, build in QUERIES.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            if name in ORACLES:
                result = diff(build(spark, sf_dir), con, ORACLES[name])
                word = "ok" if result is None else f"DIFF {result}"
            else:
                word = f"rows {build(spark, sf_dir).count()} (no sql)"
        except Exception as e:  # noqa: BLE001
            word = f"FAIL {type(e).__name__}: {str(e)[:1500]}"
        print(f"{name:28s} {time.time() - start:6.2f}s {word}", flush=True)


if __name__ == "__main__":
    main()
