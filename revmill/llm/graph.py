"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revmill.llm.shelf import remove, stage


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge (a, b) to another one; root is the component's smallest node.

    Alternates two steps until nothing changes: every node points its larger neighbours to the smallest node it knows,
    then its smaller ones. The number of rounds grows with the logarithm of a component's length. Each round is
    written to the shared folder. Minima are aggregates that combine before the exchange, and a node with
    very many edges meets its minimum in a join whose large partitions Spark splits.
    """
    now = stage(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    mark = _mark(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(smallest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        met = large.join(smallest, "u")
        small = met.select("u", F.col("m").alias("v")).unionByName(
            met.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        following = stage(small.distinct(), "edges")
        new_mark = _mark(following)
        remove(now)
        now = following
        if new_mark == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        mark = new_mark


def _mark(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
    )
