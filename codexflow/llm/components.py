"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexflow.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` has long columns ``a`` and ``b``; returns ``node`` and ``label`` (the smallest node
    of its component) for every node but the labels themselves.

    Each round hangs every node below the least of its neighbours, so long chains shrink by half
    and stars stay as they are. Hubs only ever meet an aggregation or a join whose other side is stored and has one
    row for the hub, so that Spark can split the hub's. Every round is written to shared storage: a lost executor costs one round.
    Loops and repeated edges are allowed, an edge with a null is ignored, no edges give no rows.
    """
    linked = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, seen = stored(linked, "edges"), None
    while True:
        mark = now.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("x")).first()
        if mark == seen or mark["n"] == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("label"))
        seen = mark
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        large = stored(both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large")
        least = stored(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        moved = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stored(moved.union(least).distinct(), "edges")
