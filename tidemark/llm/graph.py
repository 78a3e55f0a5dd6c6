"""Connected components by alternating large-star and small-star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, spread_join


def components(edges: DataFrame) -> DataFrame:
    """(node, root): every node of ``edges`` (u, v) with the smallest node that it can reach.

    Nodes are longs.  Each round is a few shuffles of at most as many rows as there are edges, with
    partial aggregation in front, and the links of a hub are dealt to many tasks; nothing is collected but a count and a checksum.  Rounds grow
    with the logarithm of the longest path.  Self-loops and repeated edges do no harm; no edges, no rows.
    """
    e = cut(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
    before = None
    while True:
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).collect()[0]
        if now[0] == 0 or now == before:
            break
        before = now
        both = e.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(e.select(F.col("v").alias("x"), F.col("u").alias("y")))
        least = both.groupBy("x").agg(F.least(F.min("y"), F.first("x")).alias("m"), F.count("*").alias("n"))
        large = spread_join(both.where("y > x"), least, ["x"], "n", 2 * now[0]).select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()
        to = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = spread_join(large, to, ["u"], "n", now[0]).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        e = cut(small.unionByName(to.select("u", F.col("m").alias("v"))).distinct())
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
