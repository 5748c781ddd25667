"""Compare every registered query with its DuckDB SQL: ``python -m tests.verify_oracles [sf] [name ...]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import oracle_sql, queries  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect(config={"temp_directory": "", "memory_limit": "8GB"})  # no spill beside the code
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def canonical(rows: list[tuple], names: list[str]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def compare(spark: SparkSession, con, name: str, sf_dir: str) -> str | None:
    """None when equal, else what differs."""
    df = queries()[name](spark, sf_dir)
    got = canonical([tuple(r) for r in df.collect()], df.columns)
    rel = con.sql(oracle_sql()[name])
    want = canonical(rel.fetchall(), rel.columns)
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} != {sorted(rel.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    if got != want:
        off = [(g, w) for g, w in zip(got, want) if g != w]
        return f"{len(off)} of {len(got)} rows differ, first {off[0]}"
    return None


def main() -> None:
    from tests.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    spark = local_session()
    con = duck(f"/root/testdata/sf{sf}")
    bad = 0
    for name in sys.argv[2:] or queries():
        if name not in oracle_sql():
            print(f"--  {name} has no SQL", flush=True)
            continue
        t0 = time.time()
        try:
            diff = compare(spark, con, name, f"/root/testdata/sf{sf}")
        except Exception as e:  # noqa: BLE001
            diff = f"{type(e).__name__}: {str(e)[:600]}"
        bad += diff is not None
        print(f"{'ok ' if diff is None else 'BAD'} {name} {time.time() - t0:.1f}s {diff or ''}", flush=True)
    print("differences:", bad)


if __name__ == "__main__":
    main()
