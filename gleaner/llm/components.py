"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.session import materialised


def components(links: DataFrame, rounds: int = 100) -> DataFrame:
    """(id, root) for every id with a link, apart from the roots: root is the smallest id reachable.

    ``links`` has the columns a and b. Every round replaces a neighbour by its own
    smallest neighbour and then ties all neighbours of an id to the smallest of
    them. Chains halve their length each time, no round gives more links than it
    got, and each is written to the shared folder, so nothing rests on one executor. Links of an id to
    itself are ignored; no links give no rows.
    """
    graph = materialised(
        links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    state = _state(graph)
    for _ in range(rounds):
        if not state[0]:
            break
        # Written, so that Spark may split the join below where one root has many ids.
        lowest = materialised(graph.groupBy("u").agg(F.min("v").alias("low")), "lowest")
        hops = graph.join(lowest.select(F.col("u").alias("v"), "low"), "v", "left").select(
            "u", F.coalesce("low", "v").alias("t")
        )
        best = hops.groupBy("u").agg(F.min("t").alias("v"))
        tied = hops.join(best, "u").where("t != v").select(F.col("t").alias("u"), "v")
        graph = materialised(best.unionByName(tied).distinct(), "links")
        before, state = state, _state(graph)
        if state == before:
            return graph.select(F.col("u").alias("id"), F.col("v").alias("root"))
    if state[0]:
        raise RuntimeError(f"links still change after {rounds} rounds")
    return graph.select(F.col("u").alias("id"), F.col("v").alias("root"))


def _state(graph: DataFrame) -> tuple:
    hashed = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(graph.agg(F.count("*"), F.coalesce(F.sum(hashed), F.lit(0))).first())
