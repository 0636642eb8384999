"""Run registered queries beside their check SQL and compare the rows.

    python tests/check.py FOLDER [QUERY ...]

CHECK_CONF adds session settings, such as "spark.sql.autoBroadcastJoinThreshold=-1".
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pyarrow as pa

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def _kind(t: pa.DataType) -> str:
    t = str(t)
    return "string" if "string" in t else t


def _rows(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    clean = lambda v: "nan" if isinstance(v, float) and math.isnan(v) else v
    return sorted((tuple(map(clean, r)) for r in zip(*columns)), key=lambda r: tuple(map(repr, r)))


def differences(spark_table: pa.Table, sql_table: pa.Table) -> list[str]:
    out = []
    left = {f.name: _kind(f.type) for f in spark_table.schema}
    right = {f.name: _kind(f.type) for f in sql_table.schema}
    if left != right:
        out.append(f"schema: {sorted(left.items() - right.items())} vs {sorted(right.items() - left.items())}")
    if spark_table.num_rows != sql_table.num_rows:
        out.append(f"rows: {spark_table.num_rows} vs {sql_table.num_rows}")
    if set(left) == set(right):
        a, b = _rows(spark_table), _rows(sql_table)
        if a != b:
            extra, lacking = set(a) - set(b), set(b) - set(a)
            out.append(f"values: {len(extra)} extra {sorted(extra, key=repr)[:2]} lacking {sorted(lacking, key=repr)[:2]}")
    return out


def main(sf: str, names: list[str]) -> int:
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    from __spark_entry__ import oracle_sql, queries
    from staylake.session import build_session

    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
        **dict(pair.split("=", 1) for pair in os.environ.get("CHECK_CONF", "").split(";") if pair),
    }
    spark = build_session(master="local[8]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = duck(sf), oracle_sql(), 0
    for name, run in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            got = run(spark, sf).toArrow()
            spent = time.time() - start
            start = time.time()
            found = differences(got, con.sql(oracles[name]).to_arrow_table()) if name in oracles else ["no SQL"]
            sql_spent = time.time() - start
        except Exception as error:  # noqa: BLE001
            found, spent, got, sql_spent = [f"{type(error).__name__}: {str(error)[:600]}"], time.time() - start, None, 0
        bad += bool(found) and found != ["no SQL"]
        print(f"{name:32} {spent:6.2f}s {sql_spent:6.2f}s {got.num_rows if got is not None else -1:8d} {'ok' if not found else found}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
