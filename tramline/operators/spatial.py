"""Spatial joins by grid cells, nearest nodes, tiles and extents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tramline.functions import geo

MAX_SNAP = 500.0
#: Metres of a degree, a little less than the least there is: of latitude, and of longitude at the equator.
DEGREE, EQUATOR = 110_400.0, 111_100.0
PAD, READ_PAD = 500.0, 1000.0


def cell(value: Column, size: float) -> Column:
    return F.floor(value / size)


def around(value: Column, size: float, reach: float) -> Column:
    """Cells within reach of a value, as an array."""
    return F.sequence(F.floor((value - reach) / size), F.floor((value + reach) / size))


def near_pairs(left: DataFrame, right: DataFrame, size: float, reach: float | Column) -> DataFrame:
    """Rows of left (with x, y) beside rows of right (with rx, ry) within reach on both axes: the right side, whose rows
    may have a reach each, goes to all cells that its reach touches, the left to its own, and the rest is an equi-join."""
    left = left.withColumns({"_cx": cell(F.col("x"), size), "_cy": cell(F.col("y"), size)})
    right = right.withColumn("_reach", reach if isinstance(reach, Column) else F.lit(reach))
    for axis in "xy":
        right = right.withColumn(f"_c{axis}", F.explode(around(F.col(f"r{axis}"), size, F.col("_reach"))))
    near = (F.abs(F.col("x") - F.col("rx")) <= F.col("_reach")) & (F.abs(F.col("y") - F.col("ry")) <= F.col("_reach"))
    return left.join(right, ["_cx", "_cy"]).filter(near).drop("_cx", "_cy", "_reach")


def nearest_node(stops: DataFrame, nodes: DataFrame, crs: str, max_snap: float = MAX_SNAP) -> DataFrame:
    """stop_id, node_id, snap_cm: the node nearest in degrees, ties to the smaller id, if it lies within max_snap metres.

    stops: stop_id, stop_lon, stop_lat. nodes: node_id, x, y in degrees. A node that snaps is at most as far in degrees as
    max_snap is along the parallel, so nodes farther than that on an axis can't be the nearest where any snaps; the
    reach follows from max_snap and the stop's latitude.
    """
    left = nodes.select("node_id", "x", "y")
    right = stops.select("stop_id", F.col("stop_lon").alias("rx"), F.col("stop_lat").alias("ry"))
    high = max_snap / DEGREE
    along = max_snap / (EQUATOR * F.cos(F.radians(F.least(F.lit(89.9), F.abs(F.col("ry")) + high))))
    pairs = near_pairs(left, right, 4 * high, F.greatest(F.lit(high), along))
    dx, dy = F.col("x") - F.col("rx"), F.col("y") - F.col("ry")
    best = pairs.groupBy("stop_id").agg(F.min_by(F.struct("node_id", "x", "y", "rx", "ry"), F.struct((dx * dx + dy * dy).alias("d"), "node_id")).alias("b"))
    e1, n1 = geo.project(F.col("b.rx"), F.col("b.ry"), crs)
    e2, n2 = geo.project(F.col("b.x"), F.col("b.y"), crs)
    far = F.sqrt((e1 - e2) * (e1 - e2) + (n1 - n2) * (n1 - n2))
    return best.select("stop_id", "b.node_id", geo.centimetres(far).alias("snap_cm")).filter(F.col("snap_cm") <= max_snap * 100)


def tiles(spark: SparkSession, south: float, west: float, north: float, east: float, n: int = 4) -> DataFrame:
    """tile, south, west, north, east of an n by n grid, rows from south, columns from west."""
    rows = spark.range(n * n).select((F.col("id") / n).cast("int").alias("i"), (F.col("id") % n).cast("int").alias("j"))
    high, wide = (north - south) / n, (east - west) / n
    return rows.select(
        F.concat_ws("_", F.col("i").cast("string"), F.col("j").cast("string")).alias("tile"), (south + F.col("i") * high).alias("south"), (west + F.col("j") * wide).alias("west"),
        (south + (F.col("i") + 1) * high).alias("north"), (west + (F.col("j") + 1) * wide).alias("east"),
    )


def dedup_tiles(features: DataFrame, key: str = "osm_id", order: tuple[str, ...] = ("tile",)) -> DataFrame:
    """The first row of each key over the union of tiles."""
    w = Window.partitionBy(key).orderBy(*order)
    return features.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def in_extent(features: DataFrame, xmin: float, xmax: float, ymin: float, ymax: float, pad: float = READ_PAD) -> DataFrame:
    """Features whose stored bounds (xmin, xmax, ymin, ymax) meet the padded extent; the filter reaches the scan."""
    return features.filter((F.col("xmax") >= xmin - pad) & (F.col("xmin") <= xmax + pad) & (F.col("ymax") >= ymin - pad) & (F.col("ymin") <= ymax + pad))
