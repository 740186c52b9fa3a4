"""Connected components of an edge table, by Spark joins; nothing is collected but two counters a round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.llm.staging import Scratch


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``label``: the least node of each component, for every node of ``edges`` (``u``, ``v``, long).

    Alternates large-star and small-star rounds until the edges stay the same. Minima are combined
    before each shuffle, and a node with very many neighbours is one side of a join that Spark can
    split, so a hub does not collect in one task. Loops and repeated edges are allowed; an empty
    table has no components.
    """
    scratch = Scratch(edges.sparkSession, "components")
    now = scratch.write(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = scratch.write(large)
        scratch.drop(now)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        small = small.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        now = scratch.write(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        scratch.drop(large)
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if state == before:
            break
        before = state
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("label"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots.distinct())
