"""Connected components by alternating star contractions, on DataFrames only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def connected_components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, root): for every node of the undirected ``links`` the smallest node that it can reach.

    Each round hooks every node's larger neighbours to its smallest neighbour (large star) and then every
    node with its smaller neighbours to the smallest of them (small star), until the links are stars. Minima
    are aggregated before they are shuffled and joined back, so a node with many links is never gathered in
    one task. Each round ends in a checkpoint. Self links and null nodes are left out; repeated links count
    once; no links give no rows."""
    pairs = (links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
             .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct())
    pairs = pairs.checkpoint()
    state = _state(pairs)
    for _ in range(max_rounds):
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("p"))
        pairs = small.select("p.u", "p.v").where(F.col("u") != F.col("v")).distinct().checkpoint()
        now = _state(pairs)
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("connected components didn't settle")
    roots = pairs.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    tops = pairs.select(F.col("v").alias("node")).distinct().join(pairs.select(F.col("u").alias("node")), "node", "left_anti")
    return roots.unionByName(tops.select("node", F.col("node").alias("root")))


def _state(pairs: DataFrame) -> tuple:
    """A few numbers that change when the links do."""
    r = pairs.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
                  F.sum(F.col("v").cast("decimal(38,0)")).alias("s")).first()
    return r["n"], r["h"], r["s"]
