"""Walking reach on a directed graph: bounded shortest paths and the edges between reached nodes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.plans.lineage import cut, drop

WALK, LEAST_NODES = 375.0, 3
#: Tables of rounds that are read side by side before they become one.
ROUNDS = 8


def reach(seeds: DataFrame, edges: DataFrame, radius: float = WALK, least: int = LEAST_NODES) -> DataFrame:
    """stop_id, node_id, dist of all nodes within radius of each seed (stop_id, node_id), itself included, for seeds that
    reach at least so many nodes. edges: src, dst, length, directed; of parallel edges the shortest counts.

    A round extends only what the round before improved: of its steps the least for each node that is nearer than before
    is a small table of its own, so a round reads what is known but writes only what it found. Rounds end when nothing
    improves.
    """
    edges = cut(edges.groupBy(F.col("src").alias("node_id"), "dst").agg(F.min("length").alias("length")).filter(F.col("length") <= radius))
    keys = ["stop_id", "node_id"]
    new = cut(seeds.select(*keys, F.lit(0.0).alias("dist")).distinct())
    rounds = [new]

    def known() -> DataFrame:
        return reduce(DataFrame.unionByName, rounds).groupBy(*keys).agg(F.min("dist").alias("dist"))

    while True:
        step = new.join(edges, "node_id").select("stop_id", F.col("dst").alias("node_id"), (F.col("dist") + F.col("length")).alias("dist")).filter(F.col("dist") <= radius)
        step = step.groupBy(*keys).agg(F.min("dist").alias("dist"))
        before = known().withColumnRenamed("dist", "before")
        new = cut(step.join(before, keys, "left").filter("before IS NULL OR dist < before").select(*keys, "dist"))
        if new.isEmpty():
            drop(new)
            break
        rounds.append(new)
        if len(rounds) > ROUNDS:
            state = cut(known())
            drop(*rounds[:-1])
            rounds = [state, new]
    state = cut(known())
    drop(*rounds, edges)
    rows = state.select("stop_id", "node_id", "dist")
    enough = rows.groupBy("stop_id").count().filter(F.col("count") >= least).select("stop_id")
    return rows.join(enough, "stop_id", "left_semi")


def reached_edges(reached: DataFrame, edges: DataFrame) -> DataFrame:
    """stop_id, src, dst of every edge between nodes that a stop reaches, on a shortest path or not."""
    ends = reached.select("stop_id", "node_id")
    rows = ends.withColumnRenamed("node_id", "src").join(edges.select("src", "dst").distinct(), "src")
    return rows.join(ends.withColumnRenamed("node_id", "dst"), ["stop_id", "dst"], "left_semi").select("stop_id", "src", "dst")
