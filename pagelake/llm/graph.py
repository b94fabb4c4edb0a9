"""Connected components of an edge table, by alternating stars on DataFrames.

Each round points every node's larger neighbours at its smallest one, then every
node's smaller neighbours at the smallest of them.  Rounds are written to shared
storage, and end when an edge set does not change.  No component is ever gathered
in one place: all steps are joins and minimum aggregates with map-side combining.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelake.llm.common import forget, staged


def connected_components(edges: DataFrame, purpose: str, most_rounds: int = 40) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v) that is not its component's smallest node.

    Loops, repeated edges, edges in both directions and null ends are fine (nulls are ignored).
    """
    pairs = (edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
             .filter("u is not null and v is not null and u < v"))
    now = staged(pairs.distinct(), f"{purpose}-edges")
    before = None
    for _ in range(most_rounds):
        state = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"),
                        F.bit_xor(F.hash("v", "u")).alias("y")).first()
        if state.n == 0 or state == before:
            return now.select(F.col("v").alias("node"), F.col("u").alias("root"))
        before = state
        both = now.union(now.select("v", "u")).toDF("node", "other")
        least = both.groupBy("node").agg(F.min("other").alias("least"))
        large = (both.filter("other > node").join(least, "node")
                 .select(F.least("least", "node").alias("u"), F.col("other").alias("v"))
                 .union(least.filter("least < node").select("least", "node"))).distinct()
        lowest = large.groupBy("v").agg(F.min("u").alias("low"))
        small = (large.join(lowest, "v").filter("u > low").select(F.col("low").alias("u"), F.col("u").alias("v"))
                 .union(lowest.select("low", "v"))).distinct()
        then = staged(small, f"{purpose}-edges")
        forget(now)
        now = then
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
