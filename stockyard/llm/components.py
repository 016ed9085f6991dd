"""Connected components of a graph given as edges, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stockyard.llm.common import dropped, written


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest reachable node) of every node on an edge; ``edges`` has long ``a``, ``b``.

    Loops and nulls are ignored. Each round links every node's neighbours to its least neighbour, first the larger
    ones, then the smaller ones; the number of rounds grows with the logarithm of the longest path. No node's
    neighbours are gathered: only their minimum is, combined before the shuffle, and it is joined back.
    """
    now = written(
        edges.where("a is not null and b is not null and a <> b")
        .selectExpr("greatest(a, b) as u", "least(a, b) as v").distinct(), "edges",
    )
    state = None
    while True:
        both = now.unionByName(now.selectExpr("v as u", "u as v"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) as m")
        large = both.join(least, "u").where("v > u").selectExpr("v as u", "m as v").where("u <> v").distinct()
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(root, "u").selectExpr("v as u", "m as v").where("u <> v")
            .unionByName(root.selectExpr("u", "m as v")).distinct()
        )
        after = written(small.selectExpr("greatest(u, v) as u", "least(u, v) as v").distinct(), "edges")
        dropped(now)
        now = after
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state:
            break
        state = seen
    # stars now: every node but the centres has one edge, to its centre
    return now.selectExpr("u as node", "v as component").unionByName(now.selectExpr("v as node", "v as component").distinct())
