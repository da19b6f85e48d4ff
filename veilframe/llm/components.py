"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe.llm.common import cut, sweep, with_unique


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
    return row[0], row[1]


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(u, v)`` of longs -> ``(node, root)`` for every node with an edge, root the smallest.

    Alternates large-star and small-star until the edges stand still. A vertex's smallest neighbour
    comes from a pre-aggregated ``min`` and is joined back, so no neighbourhood is ever gathered; the
    edges of a hub are dealt to all tasks. Self loops are ignored.
    """
    e = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = _mark(e)
    while mark[0]:
        both = e.select("u", "v", F.lit(0).alias("up")).union(e.select("v", "u", F.lit(1)))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.sum("up").alias("n"))
        ups = e.select(F.col("v").alias("u"), F.col("u").alias("v"))
        large = with_unique(ups, low, ["u"], "n", mark[0], F.col("v")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))  # no more edges than before
        small = with_unique(large, low, ["u"], "n", mark[0], F.col("v")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = cut(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        mark, before = _mark(e), mark
        sweep(edges.sparkSession)  # the shuffles of rounds before
        if mark == before:
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
