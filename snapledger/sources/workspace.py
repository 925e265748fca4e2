"""Ad-hoc SQL over named tables."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession

from snapledger import fixed
from snapledger.functions.casting import void_to_string
from snapledger.operators.profile import profile
from snapledger.operators.sampling import preview, sample_rows
from snapledger.session import discard, stage
from snapledger.sources.files import load_files, load_folder
from snapledger.sources.sinks import export


class Workspace:
    """Named tables as temporary views; every answer is a DataFrame.

    ``last`` is the result of the latest query or sample, which ``save`` and
    ``export`` use unless given another. Saved results are tables of their own in
    the scratch folder. They belong to the workspace and end with it: on
    ``close``, at the end of a ``with`` block, or one by one by ``drop``.
    """

    def __init__(self, spark: SparkSession, tables: dict[str, DataFrame] | None = None):
        self.spark = spark
        self.names: list[str] = []
        self.last: DataFrame | None = None
        self.saved: dict[str, list[DataFrame]] = {}
        for name, df in (tables or {}).items():
            self.register(name, df)

    # -- tables -----------------------------------------------------------
    def register(self, name: str, df: DataFrame) -> DataFrame:
        df.createOrReplaceTempView(f"`{name}`")
        if name not in self.names:
            self.names.append(name)
        return df

    def load(self, paths: list[str], names: list[str] | None = None) -> list[str]:
        """Register files; a repeated name replaces the earlier table."""
        tables = load_files(self.spark, paths, names)
        for name, df in tables.items():
            self.register(name, df)
        return list(tables)

    def load_folder(self, folder: str) -> list[str]:
        tables = load_folder(self.spark, folder)
        for name, df in tables.items():
            self.register(name, df)
        return list(tables)

    def table(self, name: str) -> DataFrame:
        if name not in self.names:
            raise KeyError(f"unknown table {name!r}; available: {', '.join(self.names)}")
        return self.spark.table(f"`{name}`")

    # -- looking at tables --------------------------------------------------
    def tables(self) -> DataFrame:
        """Name, rows and columns of every table, counted in one job."""
        counts = None
        for name in self.names:
            df = self.table(name)
            one = df.selectExpr(
                f"'{name}' AS TABLE_NAME", "count(1) AS ROW_COUNT",
                f"{len(df.columns)} AS COLUMN_COUNT",
            )
            counts = one if counts is None else counts.unionByName(one)
        if counts is None:
            return self.spark.createDataFrame(
                [], "TABLE_NAME string, ROW_COUNT long, COLUMN_COUNT int"
            )
        return counts

    def schema(self, name: str) -> DataFrame:
        fields = self.table(name).schema
        return self.spark.createDataFrame(
            [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(fields)],
            "POSITION int, COLUMN_NAME string, DATA_TYPE string",
        )

    def count(self, name: str) -> DataFrame:
        return self.table(name).selectExpr("count(1) AS ROW_COUNT")

    def describe(self, name: str, exact: bool = True) -> DataFrame:
        return profile(self.table(name), exact)

    def sample(self, name: str, n: int = fixed.SAMPLE_ROWS, seed: int = 0) -> DataFrame:
        self.last = sample_rows(self.table(name), n, seed)
        return self.last

    # -- queries ------------------------------------------------------------
    def sql(self, query: str, args: dict[str, Any] | None = None) -> DataFrame:
        """Run one statement over the tables (a closing semicolon is allowed)."""
        text = query.strip().rstrip(";").strip()
        self.last = self.spark.sql(text, args=args) if args else self.spark.sql(text)
        return self.last

    def show(self, df: DataFrame | None = None, rows: int | None = fixed.DISPLAY_ROWS):
        """The rows to display: the first ``rows``, or all when ``None``."""
        return preview(self._result(df), rows)

    def save(self, name: str, df: DataFrame | None = None) -> DataFrame:
        """Make a result a queryable table of its own.

        Its rows are computed once and stored, so it stays as it is when its
        sources change or go. Saving under a name again replaces the table;
        results derived from the earlier one keep reading its rows until ``close``.
        """
        stored = stage(void_to_string(self._result(df)), "saved")
        self.saved.setdefault(name, []).append(stored)
        return self.register(name, stored)

    def drop(self, name: str) -> None:
        """End a table: its view, and its rows if it was saved here."""
        self.table(name)
        self.spark.catalog.dropTempView(name)
        self.names.remove(name)
        for stored in self.saved.pop(name, []):
            discard(stored)

    def close(self) -> None:
        """End the workspace: all its views, and the rows of all saved results."""
        for name in list(self.names):
            self.drop(name)
        self.last = None

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *error) -> None:
        self.close()

    def export(self, fmt: str, path: str, df: DataFrame | None = None) -> None:
        export(self._result(df), fmt, path)

    def _result(self, df: DataFrame | None) -> DataFrame:
        result = self.last if df is None else df
        if result is None:
            raise ValueError("no result yet: run a query first")
        return result
