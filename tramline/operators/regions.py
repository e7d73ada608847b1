"""Regions of grid cells as polygons: outlines, degrees, bounds, centroids, inner points and validity.

A polygon is an array of closed rings, the outer one first, a ring an array of structs x, y; a region is an array of
polygons. Outer rings run counterclockwise, holes clockwise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.functions import geo

POLYGONS = "array<array<array<struct<x:double,y:double>>>>"
#: The four sides of a cell, counterclockwise: the neighbour across, start and end of the side from the cell's corner.
SIDES = (((0, -1), (0, 0), (1, 0)), ((1, 0), (1, 0), (1, 1)), ((0, 1), (1, 1), (0, 1)), ((-1, 0), (0, 1), (0, 0)))

Point = tuple[int, int]


def parts(cells: set[Point]) -> list[set[Point]]:
    """Cells that hang together by sides, the part of the smallest cell first."""
    left, out = set(cells), []
    for first in sorted(cells):
        if first in left:
            left.remove(first)
            own, queue = {first}, [first]
            while queue:
                x, y = queue.pop()
                for (dx, dy), _, _ in SIDES:
                    if (near := (x + dx, y + dy)) in left:
                        left.remove(near)
                        own.add(near)
                        queue.append(near)
            out.append(own)
    return out


def outline(cells: set[Point]) -> list[list[Point]]:
    """Closed rings around cells that hang together by sides, the outer one first, with corners only. Where two of them
    touch at a corner only, a ring keeps to the cell that it came along."""
    ways: dict[Point, list[Point]] = {}
    for x, y in cells:
        for (dx, dy), (ax, ay), (bx, by) in SIDES:
            if (x + dx, y + dy) not in cells:
                ways.setdefault((x + ax, y + ay), []).append((x + bx, y + by))

    def onward(a: Point, b: Point) -> Point:
        if len(ways[b]) == 1:
            return ways[b][0]
        dx, dy = b[0] - a[0], b[1] - a[1]
        return (b[0] - dy, b[1] + dx)  # the left turn

    free = {(a, b) for a, ends in ways.items() for b in ends}
    rings = []
    for first in sorted(free):
        if first in free:
            ring, (a, b) = [], first
            while (a, b) in free:
                free.remove((a, b))
                c = onward(a, b)
                if (b[0] - a[0], b[1] - a[1]) != (c[0] - b[0], c[1] - b[1]):
                    ring.append(b)
                a, b = b, c
            rings.append([*ring, ring[0]])
    return rings  # the smallest side starts the outer ring


def outlines(cells: DataFrame, key: str, size: float) -> DataFrame:
    """key (as text) and polygons, in the unit of size, of cells (key, cx, cy). A group is one region, whose extent is
    bounded: a stop's area by the walking budget, a region of the map by its largest area."""

    def run(name: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        own = set(zip(pdf["cx"].tolist(), pdf["cy"].tolist(), strict=True))
        found = [[[{"x": x * size, "y": y * size} for x, y in ring] for ring in outline(part)] for part in parts(own)]
        return pd.DataFrame({key: [name[0]], "polygons": [found]})

    rows = cells.select(F.col(key).cast("string").alias(key), "cx", "cy")
    return rows.groupBy(key).applyInPandas(run, f"{key} string, polygons {POLYGONS}")


def every_point(polygons: Column, f) -> Column:
    """Polygons with f of each point's x and y (a struct x, y)."""
    return F.transform(polygons, lambda polygon: F.transform(polygon, lambda ring: F.transform(ring, lambda p: f(p["x"], p["y"]))))


def to_degrees(polygons: Column, crs: str) -> Column:
    """Polygons of a metric system in longitude (x) and latitude (y)."""

    def turn(x: Column, y: Column) -> Column:
        lon, lat = geo.unproject(x, y, crs)
        return F.struct(lon.alias("x"), lat.alias("y"))

    return every_point(polygons, turn)


def to_metres(polygons: Column, crs: str) -> Column:
    """Polygons in longitude and latitude in a metric system."""

    def turn(x: Column, y: Column) -> Column:
        e, n = geo.project(x, y, crs)
        return F.struct(e.alias("x"), n.alias("y"))

    return every_point(polygons, turn)


def rings(polygons: Column) -> Column:
    """All rings of all polygons."""
    return F.flatten(polygons)


def area(polygons: Column) -> Column:
    """Outer rings' area less that of the holes."""
    one = lambda polygon: F.aggregate(F.transform(polygon, lambda ring, k: F.when(k == 0, geo.ring_area(ring)).otherwise(-geo.ring_area(ring))), F.lit(0.0), lambda a, b: a + b)
    return F.aggregate(F.transform(polygons, one), F.lit(0.0), lambda a, b: a + b)


def length(polygons: Column) -> Column:
    """Length of all rings."""
    return F.aggregate(F.transform(rings(polygons), geo.line_length), F.lit(0.0), lambda a, b: a + b)


def bounds(points: Column) -> dict[str, Column]:
    """xmin, xmax, ymin, ymax of an array of points."""
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return {"xmin": F.array_min(xs), "xmax": F.array_max(xs), "ymin": F.array_min(ys), "ymax": F.array_max(ys)}


def with_bounds(regions: DataFrame) -> DataFrame:
    """regions with the bounds that spatial.in_extent filters on."""
    return regions.withColumns(bounds(F.flatten(F.flatten("polygons"))))


def valid(polygons: Column) -> Column:
    """Whether there are polygons, all of closed rings of four points or more that enclose an area."""
    ring_is = lambda ring: (F.size(ring) >= 4) & (F.get(ring, F.lit(0)) == F.element_at(ring, -1)) & (geo.ring_area(ring) > 0)
    return F.coalesce(polygons.isNotNull() & (F.size(polygons) > 0) & F.forall(polygons, lambda polygon: (F.size(polygon) > 0) & F.forall(polygon, ring_is)), F.lit(False))


def cleaned(regions: DataFrame, least: float, most: float) -> DataFrame:
    """Valid regions of more than least and at most most square units."""
    return regions.filter(valid(F.col("polygons"))).withColumn("_area", area(F.col("polygons"))).filter((F.col("_area") > least) & (F.col("_area") <= most)).drop("_area")


def inner_point(polygon: list[list[tuple[float, float]]]) -> tuple[float, float]:
    """A point inside a polygon: the middle of the widest stretch inside, on a level between two of its corners' levels."""
    levels = np.unique([y for ring in polygon for _, y in ring])
    best = (-1.0, 0.0, 0.0)
    for y in ((levels[:-1] + levels[1:]) / 2).tolist():
        cuts = sorted(x1 + (y - y1) * (x2 - x1) / (y2 - y1) for ring in polygon for (x1, y1), (x2, y2) in zip(ring, ring[1:], strict=False) if (y1 > y) != (y2 > y))
        best = max([best, *((b - a, (a + b) / 2, y) for a, b in zip(cuts[::2], cuts[1::2], strict=False))])
    return best[1], best[2]


def of_geopackage(features: DataFrame) -> DataFrame:
    """Features read from a GeoPackage (see files.read_geopackage) with polygons, and deduped_trips where they have it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from tramline.sources.files import wkb_polygons

        for pdf in batches:
            found = [[] if w is None else [[[{"x": x, "y": y} for x, y in ring] for ring in polygon] for polygon in wkb_polygons(bytes(w))] for w in pdf["wkb"]]
            yield pd.DataFrame({"layer": pdf["layer"], "fid": pdf["fid"], "deduped_trips": pdf["deduped_trips"], "polygons": found})

    trips = F.try_element_at("properties", F.lit("deduped_trips")).try_cast("double")
    return features.select("layer", "fid", trips.alias("deduped_trips"), "wkb").mapInPandas(run, f"layer string, fid long, deduped_trips double, polygons {POLYGONS}")
