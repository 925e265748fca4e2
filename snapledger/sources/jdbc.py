"""Relational sources through Spark's JDBC reader."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from snapledger.functions.casting import void_to_string


@dataclass(frozen=True)
class Split:
    """How a table is read in parallel: equal strides of a numeric, date or
    timestamp column. Bounds only place the strides; no row is left out."""

    column: str
    lower: str | int
    upper: str | int
    parts: int


@dataclass(frozen=True)
class JdbcSource:
    """``table`` is a table name or a parenthesised subquery with an alias.

    Column lists, filters, limits and aggregates put on the result are pushed to
    the database by Spark. Without ``split`` one task reads everything; with
    ``predicates`` each condition becomes one task, which suits tables whose rows
    crowd around few values of any one column.
    """

    url: str
    table: str
    split: Split | None = None
    predicates: list[str] | None = None
    options: dict[str, str] = field(default_factory=dict)

    def reader_options(self) -> dict[str, str]:
        opts = {"url": self.url, "dbtable": self.table, "preferTimestampNTZ": "true"}
        if self.split:
            opts |= {
                "partitionColumn": self.split.column,
                "lowerBound": str(self.split.lower),
                "upperBound": str(self.split.upper),
                "numPartitions": str(self.split.parts),
            }
        return opts | self.options

    def read(self, spark: SparkSession) -> DataFrame:
        opts = self.reader_options()
        if self.predicates:
            properties = {k: v for k, v in opts.items() if k not in ("url", "dbtable")}
            df = spark.read.jdbc(
                self.url, self.table, predicates=self.predicates, properties=properties
            )
        else:
            df = spark.read.format("jdbc").options(**opts).load()
        return void_to_string(df)
