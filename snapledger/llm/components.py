"""Connected components of a graph whose components and stars may be very large."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from snapledger.session import stage


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """node, component: the least node reachable, for every node of an edge that joins two nodes.

    Nodes are integers. Loops, repeats and edges with a null end count as absent;
    no edges give no rows.

    Each round every node moves to the neighbour (or itself) that comes first in
    a random order, and the edges are carried over to the places moved to. The
    number of nodes left falls by a constant factor a round. Every round is
    written to the shared folder, so lineage stays short and a lost executor
    costs no more than the round. Moves are stored tables, so joins with a node
    that very many edges share are split by adaptive execution.
    """
    one = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u <> v")
    left = stage(one.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "edges")
    moves = []
    while not left.isEmpty():
        ends = left.select("u", "v").unionAll(left.select(F.col("v").alias("u"), F.col("u").alias("v")))
        first = lambda n: F.struct(F.xxhash64(n, F.lit(len(moves))).alias("h"), F.col(n).alias("id"))  # noqa: B023, E731
        move = stage(
            ends.groupBy("u").agg(F.min(first("v")).alias("to")).select(
                "u", F.least(first("u"), "to")["id"].alias("to")
            ),
            "moves",
        )
        moves.append(move)
        step = move.select(F.col("u").alias("x"), F.col("to").alias("x_to"))
        half = left.join(step, F.col("u") == F.col("x")).select(F.col("x_to").alias("u"), "v")
        whole = half.join(step, F.col("v") == F.col("x")).select("u", F.col("x_to").alias("v")).where("u <> v")
        left = stage(
            whole.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "edges"
        )
    if not moves:
        return left.select(F.col("u").alias("node"), F.col("v").alias("component"))
    # A node moved to in a round may move on in the next.
    place = moves[0].select(F.col("u").alias("node"), F.col("to").alias("at"))
    for move in moves[1:]:
        place = place.join(move, F.col("at") == F.col("u"), "left").select(
            "node", F.coalesce("to", "at").alias("at")
        )
    place = stage(place, "places") if len(moves) > 1 else place
    least = place.groupBy("at").agg(F.min("node").alias("component"))
    return place.join(stage(least, "least"), "at").select("node", "component")
