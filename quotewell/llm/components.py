"""Connected components by alternating stars, with aggregates and joins only.

No node's neighbours are ever gathered: a round takes each node's least neighbour by a (map-side combined) minimum and joins it
back. Hubs are one key with many rows; minima are written before they are joined, so that the adaptive join can split such keys. Rounds are written to
the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialise

#: Far beyond the logarithmic number that stars need; reaching it is an error, never a silent stop.
MAX_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """links (a, b) -> node, root: the least node of the component, for every node that has a link to another."""
    edges = materialise(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    for _ in range(MAX_ROUNDS):
        # large star: every larger neighbour moves to the least of the neighbourhood
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialise(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), "least")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: a node and its smaller neighbours move to the least of them
        large = materialise(large.where("u <> v").distinct(), "large-star")
        lower = materialise(large.groupBy("u").agg(F.min("v").alias("m")), "lower")
        small = large.join(lower, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        after = materialise(small.unionByName(lower.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        discard(edges, large, least, lower)
        edges = after
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == before:
            roots = edges.select("v").distinct()
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.select(F.col("v").alias("node"), F.col("v").alias("root")))
        before = state
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
