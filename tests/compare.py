"""Comparing a Spark result with the oracle's as bags of rows."""

from __future__ import annotations

import glob
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def differences(con, df, sql: str) -> dict:
    """What one side has and the other lacks; empty when they agree."""
    con.register("got", df.toArrow())
    con.execute(f"create or replace temp table want as {sql}")
    kinds = {}
    for name in ("got", "want"):
        rows = con.execute(f"describe select * from {name}").fetchall()
        kinds[name] = {r[0]: r[1] for r in rows}
    if kinds["got"] != kinds["want"]:
        return {"schema": set(kinds["got"].items()) ^ set(kinds["want"].items())}
    columns = ", ".join(f'"{c}"' for c in kinds["want"])

    def minus(a: str, b: str) -> int:
        return con.execute(
            f"select count(*) from (select {columns} from {a} except all select {columns} from {b})"
        ).fetchall()[0][0]

    counts = {"only got": minus("got", "want"), "only wanted": minus("want", "got")}
    return {k: n for k, n in counts.items() if n}
