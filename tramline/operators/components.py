"""Connected components, and what rests on them: largest component, clusters of near points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.operators import spatial
from tramline.plans.lineage import cut, drop


def components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """v, component: the smallest vertex reachable, for vertices (v) and edges (a, b) taken in both directions.

    In a round each vertex takes the smallest label among its neighbours, then all vertices that shared a label take the
    smallest that any of them found, and then that label's own new label; so both scattered and sorted long paths need
    few rounds. Labels are written to the shared folder each round.
    """
    both = cut(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut(vertices.select("v", F.col("v").alias("component")).distinct())
    while True:
        near = both.join(labels.withColumnRenamed("v", "b"), "b").groupBy(F.col("a").alias("v")).agg(F.min("component").alias("low"))
        step = labels.withColumnRenamed("component", "was").join(near, "v", "left").select("v", "was", F.least("was", F.coalesce("low", "was")).alias("low"))
        step = cut(step)
        groups = cut(step.groupBy("was").agg(F.min("low").alias("low")))
        up = groups.select(F.col("was").alias("low"), F.col("low").alias("lower"))
        moved = groups.join(up, "low", "left").select("was", F.coalesce("lower", "low").alias("component"))
        changed = not groups.filter("low <> was").isEmpty()
        after = cut(step.select("v", "was").join(moved, "was").select("v", "component"))
        drop(step, groups, labels)
        labels = after
        if not changed:
            drop(both)
            return labels


def largest(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """v of the component with most vertices, the smallest label among equals."""
    found = components(vertices, edges)
    top = found.groupBy("component").count().orderBy(F.desc("count"), "component").limit(1)
    return found.join(top.select("component"), "component", "left_semi").select("v")


def clusters(points: DataFrame, eps: float) -> DataFrame:
    """id, cluster of points (id, x, y): density clusters where one point is enough, that is components of pairs at most
    eps apart; the label is the smallest id."""
    right = points.select(F.col("id").alias("rid"), F.col("x").alias("rx"), F.col("y").alias("ry"))
    pairs = spatial.near_pairs(points.select("id", "x", "y"), right, eps, eps)
    dx, dy = F.col("x") - F.col("rx"), F.col("y") - F.col("ry")
    pairs = pairs.filter((F.col("id") < F.col("rid")) & (dx * dx + dy * dy <= eps * eps))
    found = components(points.select(F.col("id").alias("v")), pairs.select(F.col("id").alias("a"), F.col("rid").alias("b")))
    return found.select(F.col("v").alias("id"), F.col("component").alias("cluster"))


def cluster_totals(stops: DataFrame) -> DataFrame:
    """cluster, trip_count, route_ids, unique_routes and centroid over distinct points, of stops (cluster, x, y,
    trip_count, route_ids as a comma list)."""
    routes = stops.select("cluster", F.explode(F.split(F.coalesce("route_ids", F.lit("")), ",")).alias("r")).filter("r <> ''")
    routes = routes.groupBy("cluster").agg(F.array_sort(F.collect_set("r")).alias("rs"))
    sums = stops.groupBy("cluster").agg(F.sum("trip_count").alias("trip_count"))
    centre = stops.select("cluster", "x", "y").distinct().groupBy("cluster").agg(F.avg("x").alias("x"), F.avg("y").alias("y"))
    rows = sums.join(centre, "cluster").join(routes, "cluster", "left")
    return rows.select("cluster", "x", "y", "trip_count", F.coalesce(F.array_join("rs", ","), F.lit("")).alias("route_ids"), F.coalesce(F.size("rs"), F.lit(0)).alias("unique_routes"))


def centroids(points: DataFrame, keys: list[str]) -> DataFrame:
    """Centroid of the distinct points (x, y) of each key."""
    return points.select(*keys, "x", "y").distinct().groupBy(*keys).agg(F.avg("x").alias("x"), F.avg("y").alias("y"), F.count(F.lit(1)).alias("points"))
