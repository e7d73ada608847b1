"""Coverage: the cells within reach of stops, departures per cell with each route counted once, and regions of them.

A stop's area is all points within BUFFER of a walkable segment. It is sampled at the centres of a metric grid; the
frequency of a cell is the sum, over routes, of the largest count among the stops that reach it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tramline.functions import classes, geo
from tramline.operators import components, regions
from tramline.plans.lineage import cut

CELL, BUFFER = 25.0, 50.0
LEAST_AREA, MOST_AREA = 10.0, 5_000_000.0


def cells(segments: DataFrame, size: float = CELL, buffer: float = BUFFER) -> DataFrame:
    """stop_id, cx, cy, distinct, of segments (stop_id, ax, ay, bx, by) in metres.

    Many stops share a segment, so each distinct segment is rasterised once and its cells meet its stops afterwards.
    """
    ends = ["ax", "ay", "bx", "by"]
    span = lambda a, b: F.sequence(F.ceil((F.least(a, b) - buffer) / size - 0.5).cast("bigint"), F.floor((F.greatest(a, b) + buffer) / size - 0.5).cast("bigint"))
    shapes = segments.select(*ends).distinct()
    grid = shapes.withColumn("cx", F.explode(span("ax", "bx"))).withColumn("cy", F.explode(span("ay", "by")))
    far = geo.segment_distance2((F.col("cx") + 0.5) * size, (F.col("cy") + 0.5) * size, *map(F.col, ends))
    return segments.join(grid.filter(far <= buffer * buffer), ends).select("stop_id", "cx", "cy").distinct()


def area(cells_: DataFrame, size: float = CELL) -> DataFrame:
    """stop_id, cells and area_ha."""
    return cells_.groupBy("stop_id").agg(F.count(F.lit(1)).alias("cells")).withColumn("area_ha", F.col("cells") * (size * size / 10_000))


def frequency(cells_: DataFrame, route_counts: DataFrame) -> DataFrame:
    """cx, cy, deduped_trips, unique_routes: of each route the best stop counts. route_counts: stop_id, route_id, n."""
    best = cells_.join(route_counts.select("stop_id", "route_id", "n"), "stop_id").groupBy("cx", "cy", "route_id").agg(F.max("n").alias("n"))
    return best.groupBy("cx", "cy").agg(F.sum("n").alias("deduped_trips"), F.count(F.lit(1)).alias("unique_routes"))


def labelled(freq: DataFrame) -> DataFrame:
    """freq's cells with part, the smallest cell ("cx_cy") of their region: cells of equal frequency that share sides.

    Cells of one row that follow each other are one run, found by a window over the row; the regions are the components
    of runs, of which there are far fewer, and which take fewer rounds.
    """
    freq = cut(freq)  # read three times below
    row = Window.partitionBy("cy", "deduped_trips")
    packed = freq.withColumn("v", F.col("cx") * F.lit(1 << 32) + F.col("cy") + F.lit(1 << 31))
    packed = packed.withColumn("island", F.col("cx") - F.row_number().over(row.orderBy("cx")))
    packed = cut(packed.withColumn("run", F.min("v").over(Window.partitionBy("cy", "deduped_trips", "island"))).drop("island", "v"))
    here = packed.select("cx", "cy", "deduped_trips", "run")
    above = here.select("cx", (F.col("cy") - 1).alias("cy"), "deduped_trips", F.col("run").alias("b"))
    near = here.join(above, ["cx", "cy", "deduped_trips"]).select(F.col("run").alias("a"), "b")
    labels = components.components(packed.select(F.col("run").alias("v")).distinct(), near).withColumnRenamed("v", "run")
    cx = F.shiftright("component", 32)
    part = F.concat_ws("_", cx.cast("string"), (F.col("component") - F.shiftleft(cx, 32) - F.lit(1 << 31)).cast("string"))
    return packed.join(labels, "run").select("cx", "cy", "deduped_trips", "unique_routes", part.alias("part"))


def dissolve(freq: DataFrame, size: float = CELL, first_of_value: bool = True) -> DataFrame:
    """part (smallest cell of the region as "cx_cy"), deduped_trips, unique_routes, cells, area_ha of every connected
    region of equal frequency (cells that share a side), within the area limits.

    unique_routes is that of the first cell of all that frequency; without first_of_value, of the region's first cell.
    """
    return summed(labelled(freq), size, first_of_value)


def summed(rows: DataFrame, size: float = CELL, first_of_value: bool = True) -> DataFrame:
    """The regions (see dissolve) of labelled cells."""
    rows = rows.withColumn("at", F.struct("cx", "cy"))
    found = rows.groupBy("part", "deduped_trips").agg(F.min_by("unique_routes", "at").alias("unique_routes"), F.count(F.lit(1)).alias("cells"))
    if first_of_value:
        first = rows.groupBy("deduped_trips").agg(F.min_by("unique_routes", "at").alias("unique_routes"))
        found = found.drop("unique_routes").join(first, "deduped_trips")
    square = F.col("cells") * (size * size)
    found = found.filter((square > LEAST_AREA) & (square <= MOST_AREA))
    return found.select("part", "deduped_trips", "unique_routes", "cells", (square / 10_000).alias("area_ha"))


def outlined(rows: DataFrame, size: float = CELL, first_of_value: bool = True) -> DataFrame:
    """The regions of labelled cells with their polygons in metres."""
    rows = cut(rows)  # read twice
    found = cut(summed(rows, size, first_of_value))
    shapes = regions.outlines(rows.join(found.select("part"), "part", "left_semi"), "part", size)
    return found.join(shapes, "part")


def stop_areas(cells_: DataFrame, size: float = CELL) -> DataFrame:
    """stop_id, area_ha, polygons in metres of every stop's cells."""
    return regions.outlines(cells_, "stop_id", size).withColumn("area_ha", regions.area(F.col("polygons")) / 10_000)


def summary(parts: DataFrame) -> DataFrame:
    """One row over regions: how many, the largest frequency and route count, area in all and on average."""
    return parts.agg(F.count(F.lit(1)).alias("regions"), F.max("deduped_trips").alias("most_trips"), F.max("unique_routes").alias("most_routes"), F.sum("area_ha").alias("area_ha"), F.avg("area_ha").alias("mean_area_ha"))


def by_class(parts: DataFrame) -> DataFrame:
    """class, label, regions, area_ha."""
    rows = parts.withColumn("class", classes.frequency_class(F.col("deduped_trips")))
    return rows.groupBy("class").agg(F.count(F.lit(1)).alias("regions"), F.sum("area_ha").alias("area_ha")).withColumn("label", classes.class_label(F.col("class")))


def top_frequencies(parts: DataFrame, n: int = 15) -> DataFrame:
    """The n largest frequencies with their regions, area and the routes of the first region."""
    rows = parts.groupBy("deduped_trips").agg(F.count(F.lit(1)).alias("regions"), F.sum("area_ha").alias("area_ha"), F.min_by("unique_routes", "part").alias("unique_routes"))
    return rows.orderBy(F.desc("deduped_trips")).limit(n)
