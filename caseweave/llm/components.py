"""Connected components by alternating star contraction, in joins and sums that split hot nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from caseweave.session import discard, stored


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label`` (the smallest node of its component) for every node of ``edges`` (``a``, ``b``).

    Each round hangs the neighbours of a node under the smallest of them, first the larger ones, then the smaller
    ones; in the end every component is a star. Only a minimum per node is ever gathered.
    """
    edges = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges, older = stored(hung.unionByName(lowest.withColumnRenamed("m", "b")).where("a <> b").distinct(), "edges"), edges
        discard(older)
        state = edges.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.count_distinct("a")
        ).first()
        # A star forest that no round changes: every node but the centres has one edge.
        if state == before and state[0] == state[2]:
            break
        before = state
    centres = edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    labels = stored(edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(centres), "components")
    discard(edges)
    return labels
