"""Connected components by alternating star operations over an edge table.

Each round is two aggregations and two joins on the edges alone. Their results
are written to the shared folder, so lineage and plans stay short. A large
star's centre is a key that many edges have: such keys are counted beforehand and
broadcast, so no task gathers a star. Nothing is collected but two numbers that tell whether a round
changed anything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gleaner.llm.common import Scratch, join_counted


def components(edges: DataFrame, scratch: Scratch, name: str = "cc") -> DataFrame:
    """``edges(u, v)`` of longs -> ``(node, root)``: root is the least node of the component.

    Nodes without an edge to another node aren't returned. Nulls and loops are
    ignored. The number of rounds grows with the logarithm of the longest path.
    """
    now = scratch.table(
        edges.where("u is not null and v is not null and u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), f"{name}-0"
    )
    seen, k = None, 0
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first()
        if tuple(state) == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen, k = tuple(state), k + 1
        # large star: every larger neighbour of u, and u, point to u's least neighbour
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = scratch.table(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count_if(F.col("v") > F.col("u")).alias("n")).where("n > 0"), f"{name}-least-{k}")
        star = join_counted(both.where("v > u"), least, "u", "n").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        star = scratch.table(star.distinct(), f"{name}-star-{k}")
        # small star: u (the larger end of each edge) and its smaller neighbours point to the least of them
        lower = scratch.table(star.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), f"{name}-lower-{k}")
        moved = join_counted(star, lower, "u", "n").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = scratch.table(moved.union(lower.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), f"{name}-{k}")
        for used in (f"{name}-{k - 1}", f"{name}-least-{k}", f"{name}-star-{k}", f"{name}-lower-{k}"):
            scratch.drop(used)
