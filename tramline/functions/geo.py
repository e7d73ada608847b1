"""Coordinates as columns: transverse Mercator and web Mercator forward, lengths, areas, distance to a segment."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The GRS 80 ellipsoid and the two metric systems (longitude of origin, scale, false easting and northing).
A, FLATTENING = 6_378_137.0, 1 / 298.257222101
N = FLATTENING / (2 - FLATTENING)
RADIUS = A / (1 + N) * (1 + N**2 / 4 + N**4 / 64)
ALPHA = (N / 2 - 2 * N**2 / 3 + 5 * N**3 / 16 + 41 * N**4 / 180, 13 * N**2 / 48 - 3 * N**3 / 5 + 557 * N**4 / 1440, 61 * N**3 / 240 - 103 * N**4 / 140, 49561 * N**4 / 161280)
BETA = (N / 2 - 2 * N**2 / 3 + 37 * N**3 / 96 - N**4 / 360, N**2 / 48 + N**3 / 15 - 437 * N**4 / 1440, 17 * N**3 / 480 - 37 * N**4 / 840, 4397 * N**4 / 161280)
DELTA = (2 * N - 2 * N**2 / 3 - 2 * N**3 + 116 * N**4 / 45, 7 * N**2 / 3 - 8 * N**3 / 5 - 227 * N**4 / 45, 56 * N**3 / 15 - 136 * N**4 / 35, 4279 * N**4 / 630)
ECCENTRICITY = 2 * math.sqrt(N) / (1 + N)


@dataclass(frozen=True)
class TransverseMercator:
    lon0: float
    scale: float
    easting: float
    northing: float


SYSTEMS = {"EPSG:2180": TransverseMercator(19.0, 0.9993, 500_000.0, -5_300_000.0), "EPSG:25833": TransverseMercator(15.0, 0.9996, 500_000.0, 0.0)}


def project(lon: Column, lat: Column, crs: str) -> tuple[Column, Column]:
    """Easting and northing in metres (four terms of the Krueger series)."""
    s = SYSTEMS[crs]
    phi, dl = F.radians(lat), F.radians(lon - s.lon0)
    t = F.sinh(F.atanh(F.sin(phi)) - ECCENTRICITY * F.atanh(ECCENTRICITY * F.sin(phi)))
    xi, eta = F.atan2(t, F.cos(dl)), F.atanh(F.sin(dl) / F.sqrt(1 + t * t))
    e, n = eta, xi
    for j, a in enumerate(ALPHA, 1):
        e = e + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        n = n + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return s.easting + s.scale * RADIUS * e, s.northing + s.scale * RADIUS * n


def unproject(easting: Column, northing: Column, crs: str) -> tuple[Column, Column]:
    """Longitude and latitude of metres (the same series backwards)."""
    s = SYSTEMS[crs]
    xi, eta = (northing - s.northing) / (s.scale * RADIUS), (easting - s.easting) / (s.scale * RADIUS)
    x, e = xi, eta
    for j, b in enumerate(BETA, 1):
        x = x - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        e = e - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(x) / F.cosh(e))
    phi = chi
    for j, d in enumerate(DELTA, 1):
        phi = phi + d * F.sin(2 * j * chi)
    return s.lon0 + F.degrees(F.atan2(F.sinh(e), F.cos(x))), F.degrees(phi)


def web_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    return A * F.radians(lon), A * F.log(F.tan(math.pi / 4 + F.radians(lat) / 2))


def centimetres(metres: Column) -> Column:
    """Whole centimetres, on which cells and hashes can rest."""
    return F.round(metres * 100).cast("bigint")


def segment_distance2(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Squared distance of a point to a segment."""
    dx, dy = bx - ax, by - ay
    length2 = dx * dx + dy * dy
    along = F.when(length2 == 0, F.lit(0.0)).otherwise(((px - ax) * dx + (py - ay) * dy) / length2)
    u = F.greatest(F.lit(0.0), F.least(F.lit(1.0), along))
    ex, ey = px - (ax + u * dx), py - (ay + u * dy)
    return ex * ex + ey * ey


def _pairs(line: Column) -> Column:
    """Neighbours a, b of a line's points."""
    return F.arrays_zip(F.slice(line, F.lit(1), F.greatest(F.lit(0), F.size(line) - 1)).alias("a"), F.slice(line, F.lit(2), F.greatest(F.lit(0), F.size(line) - 1)).alias("b"))


def line_length(line: Column) -> Column:
    return F.aggregate(_pairs(line), F.lit(0.0), lambda acc, p: acc + F.hypot(p["b"]["x"] - p["a"]["x"], p["b"]["y"] - p["a"]["y"]))


def line_centroid(line: Column) -> Column:
    """Mean point of a line (array of structs x, y) by length; the first point of one without length."""
    zero = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))

    def add(acc: Column, p: Column) -> Column:
        n = F.hypot(p["b"]["x"] - p["a"]["x"], p["b"]["y"] - p["a"]["y"])
        return F.struct((acc["n"] + n).alias("n"), (acc["x"] + n * (p["a"]["x"] + p["b"]["x"]) / 2).alias("x"), (acc["y"] + n * (p["a"]["y"] + p["b"]["y"]) / 2).alias("y"))

    first = F.get(line, F.lit(0))
    mean = lambda t: F.when(t["n"] == 0, first).otherwise(F.struct((t["x"] / t["n"]).alias("x"), (t["y"] / t["n"]).alias("y")))
    return F.aggregate(_pairs(line), zero, add, mean)


def ring_centroid(ring: Column) -> Column:
    """Centre of gravity of what a closed ring encloses; of one without area, that of its line."""
    zero = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    origin = F.get(ring, F.lit(0))  # near the numbers, so that large coordinates cost no digits

    def add(acc: Column, p: Column) -> Column:
        ax, ay, bx, by = p["a"]["x"] - origin["x"], p["a"]["y"] - origin["y"], p["b"]["x"] - origin["x"], p["b"]["y"] - origin["y"]
        n = ax * by - bx * ay
        return F.struct((acc["n"] + n).alias("n"), (acc["x"] + n * (ax + bx)).alias("x"), (acc["y"] + n * (ay + by)).alias("y"))

    mean = lambda t: F.when(t["n"] == 0, line_centroid(ring)).otherwise(F.struct((origin["x"] + t["x"] / (3 * t["n"])).alias("x"), (origin["y"] + t["y"] / (3 * t["n"])).alias("y")))
    return F.aggregate(_pairs(ring), zero, add, mean)


def box_text(south: Column, west: Column, north: Column, east: Column) -> Column:
    """"south,west,north,east", as map queries take it."""
    return F.concat_ws(",", *(x.cast("string") for x in (south, west, north, east)))


def box_of_text(text: Column) -> Column:
    """Struct south, west, north, east of such a text; a part that is no number is null."""
    return F.struct(*[F.get(F.split(text, ","), F.lit(k)).try_cast("double").alias(n) for k, n in enumerate(("south", "west", "north", "east"))])


def box_ring(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    """The closed ring of a box, counterclockwise."""
    corner = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    return F.array(corner(xmin, ymin), corner(xmax, ymin), corner(xmax, ymax), corner(xmin, ymax), corner(xmin, ymin))


def ring_area(ring: Column) -> Column:
    """Area enclosed by a closed ring (array of structs x, y) in the square of its unit."""
    twice = F.aggregate(_pairs(ring), F.lit(0.0), lambda acc, p: acc + p["a"]["x"] * p["b"]["y"] - p["b"]["x"] * p["a"]["y"])
    return F.when(F.size(ring) < 4, F.lit(0.0)).otherwise(F.abs(twice) / 2)
