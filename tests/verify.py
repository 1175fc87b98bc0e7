"""Run registered queries beside their SQL equivalents: ``python tests/verify.py SF [query ...]``."""

from __future__ import annotations

import os
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
import __spark_entry__ as contract  # noqa: E402

DATA = Path("/root/testdata")


def session(cpus: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: Path) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(sf_dir.glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _rows(names: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(
        (tuple(r[i] for i in order) for r in rows), key=repr
    )


def difference(spark_result: tuple, sql_result: tuple) -> str | None:
    """None when equal, otherwise the first difference."""
    if spark_result[0] != sql_result[0]:
        return f"columns {spark_result[0]} != {sql_result[0]}"
    if len(spark_result[1]) != len(sql_result[1]):
        return f"rows {len(spark_result[1])} != {len(sql_result[1])}"
    for mine, theirs in zip(spark_result[1], sql_result[1]):
        if mine != theirs:
            return f"{str(mine)[:400]}\n  != {str(theirs)[:400]}"
        if [type(v) for v in mine] != [type(v) for v in theirs]:
            return f"types {mine} != {theirs}"
    return None


def main(sf: str, wanted: list[str]) -> int:
    sf_dir, failures = DATA / f"sf{sf}", 0
    spark, con = session(os.environ.get("BENCH_CPUS", "8")), duck(DATA / f"sf{sf}")
    queries, oracle = contract.queries(), contract.oracle_sql()
    for name in wanted or queries:
        start = time.perf_counter()
        df = queries[name](spark, str(sf_dir))
        mine = _rows(df.columns, [tuple(r) for r in df.collect()])
        spent = time.perf_counter() - start
        verdict = "rows only"
        if name in oracle:
            start = time.perf_counter()
            cur = con.execute(oracle[name])
            theirs = _rows([d[0] for d in cur.description], cur.fetchall())
            found = difference(mine, theirs)
            verdict = f"ok (sql {time.perf_counter() - start:.1f}s)" if found is None else found
            failures += found is not None
        print(f"{name:28s} {spent:7.2f}s {len(mine[1]):8d} rows  {verdict}", flush=True)
    return failures


if __name__ == "__main__":
    sys.exit(min(main(sys.argv[1], sys.argv[2:]), 100))
