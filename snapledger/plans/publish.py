"""Published tables under fixed names for ad-hoc SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from snapledger.sources.history import HistoryStore
from snapledger.sources.workspace import Workspace


def open_workspace(
    spark: SparkSession,
    reports: dict[str, DataFrame],
    stores: dict[str, HistoryStore] | None = None,
) -> Workspace:
    """Report tables under their names, stored history as ``<name>_history``.

    A store that holds nothing yet is left out.
    """
    workspace = Workspace(spark, reports)
    for name, store in (stores or {}).items():
        history = store.read()
        if history is not None:
            workspace.register(f"{name}_history", history)
    return workspace
