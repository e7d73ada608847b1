"""Exact planar subdivision of areas, for a district at a time: noding, faces, repair and dissolving of polygons.

Coordinates are whole numbers of a small unit (UNIT metres). Where sides cross, both are split at the crossing, rounded to
the unit, and again until no two sides meet but at ends; the faces between them are found by turning left at every
vertex. The grid of coverage is for whole maps; this mode gives true boundaries where a district's areas fit a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import atan2

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.operators import osm, regions

UNIT, LEAST_AREA = 0.001, 10.0
#: Sides compared with all others at once.
BLOCK = 256

Ring = list[tuple[int, int]]
Polygon = list[Ring]
Side = tuple[tuple[int, int], tuple[int, int]]


def sides_of(rings: list[Ring]) -> set[Side]:
    """The sides of rings, each once whichever way it runs, without those of no length."""
    return {(min(a, b), max(a, b)) for ring in rings for a, b in zip(ring, ring[1:], strict=False) if a != b}


def noded(sides: set[Side]) -> set[Side]:
    """Sides split wherever they meet others."""
    while True:
        s = np.array(sorted(sides), np.int64).reshape(-1, 4)
        cuts: dict[int, set[tuple[int, int]]] = {}
        low, high = np.minimum(s[:, :2], s[:, 2:]), np.maximum(s[:, :2], s[:, 2:])
        for k in range(0, len(s), BLOCK):
            near = (low[k : k + BLOCK, None] <= high[None]).all(axis=2) & (high[k : k + BLOCK, None] >= low[None]).all(axis=2)
            i, j = np.nonzero(near)
            i += k
            i, j = i[i < j], j[i < j]
            a, b, c, d = s[i, :2], s[i, 2:], s[j, :2], s[j, 2:]
            turn = lambda p, q, r: (q[:, 0] - p[:, 0]) * (r[:, 1] - p[:, 1]) - (q[:, 1] - p[:, 1]) * (r[:, 0] - p[:, 0])
            within = lambda r, p, q: ((np.minimum(p, q) <= r) & (r <= np.maximum(p, q))).all(axis=1) & (r != p).any(axis=1) & (r != q).any(axis=1)
            abc, abd, cda, cdb = turn(a, b, c), turn(a, b, d), turn(c, d, a), turn(c, d, b)
            for on, which, point, p, q in ((abc, i, c, a, b), (abd, i, d, a, b), (cda, j, a, c, d), (cdb, j, b, c, d)):
                for n in np.flatnonzero((on == 0) & within(point, p, q)):
                    cuts.setdefault(int(which[n]), set()).add(tuple(point[n].tolist()))
            for n in np.flatnonzero((np.sign(abc) * np.sign(abd) < 0) & (np.sign(cda) * np.sign(cdb) < 0)):
                t = cda[n] / (cda[n] - cdb[n])
                x, y = (int(round(v)) for v in (a[n] + t * (b[n] - a[n])).tolist())
                for which in (i[n], j[n]):
                    if (x, y) not in (tuple(s[which, :2].tolist()), tuple(s[which, 2:].tolist())):
                        cuts.setdefault(int(which), set()).add((x, y))
        if not cuts:
            return sides
        out = set(sides)
        for k, points in cuts.items():
            a, b = tuple(s[k, :2].tolist()), tuple(s[k, 2:].tolist())
            out.discard((a, b))
            way = sorted({a, b, *points}, key=lambda p: ((p[0] - a[0]) * (b[0] - a[0]) + (p[1] - a[1]) * (b[1] - a[1]), p))
            out |= {(min(p, q), max(p, q)) for p, q in zip(way, way[1:], strict=False)}
        sides = out


def area2(ring: Ring) -> int:
    """Twice the area of a closed ring, positive if it runs counterclockwise."""
    return sum(x1 * y2 - x2 * y1 for (x1, y1), (x2, y2) in zip(ring, ring[1:], strict=False))


def cycles(sides: set[Side]) -> list[Ring]:
    """The closed ways that keep their face on the left, of noded sides; dead ends and bridges are left out."""
    while True:
        around: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for a, b in sides:
            around.setdefault(a, []).append(b)
            around.setdefault(b, []).append(a)
        dead = {(min(a, near[0]), max(a, near[0])) for a, near in around.items() if len(near) == 1}
        if dead:
            sides = sides - dead
            continue
        after = {}
        for a, near in around.items():
            near.sort(key=lambda b, a=a: atan2(b[1] - a[1], b[0] - a[0]))
            for k, b in enumerate(near):
                after[(b, a)] = (a, near[k - 1])  # the next one clockwise, seen from where it came
        out, owner, free = [], {}, dict.fromkeys(sorted(after))
        while free:
            first = way = next(iter(free))
            ring = []
            while way in free:
                del free[way]
                owner[way] = len(out)
                ring.append(way[0])
                way = after[way]
            out.append([*ring, first[0]])
        bridges = {(a, b) for a, b in sides if owner[(a, b)] == owner[(b, a)]}
        if not bridges:
            return out
        sides = sides - bridges


def faces(sides: set[Side]) -> list[Polygon]:
    """The smallest polygons between noded sides, each with its holes; a face that holds nothing else has none."""
    found = cycles(sides)
    outer = sorted((r for r in found if area2(r) > 0), key=area2)
    out: list[Polygon] = [[r] for r in outer]
    boxes = [(min(x for x, _ in r), max(x for x, _ in r), min(y for _, y in r), max(y for _, y in r)) for r in outer]
    for hole in (r for r in found if area2(r) < 0):
        x, y = hole[0]
        own = set(hole)
        for k, ring in enumerate(outer):  # the smallest first
            x1, x2, y1, y2 = boxes[k]
            if x1 < x < x2 and y1 < y < y2 and (x, y) not in ring and own.isdisjoint(ring) and osm.inside((x, y), ring):
                out[k].append(hole)
                break
    return out


def inside(point: tuple[float, float], polygon: list) -> bool:
    return sum(osm.inside(point, ring) for ring in polygon) % 2 == 1


def dissolved(polygons: list[Polygon]) -> list[Polygon]:
    """Faces of one subdivision put together where they share sides; those that share only a corner stay apart."""
    ways = {(a, b) for polygon in polygons for ring in polygon for a, b in zip(ring, ring[1:], strict=False)}
    ways = {(a, b) for a, b in ways if (b, a) not in ways}
    return [p for p in faces({(min(w), max(w)) for w in ways}) if (p[0][0], p[0][1]) in ways]


def repaired(polygons: list[Polygon], least: float = LEAST_AREA / UNIT**2) -> list[Polygon]:
    """The area that an odd number of rings encloses, as valid polygons; none if it is smaller than least."""
    rings = [ring for polygon in polygons for ring in polygon]
    own = [f for f in faces(noded(sides_of([[*r, r[0]] for r in rings if r]))) if inside(regions.inner_point(f), rings)]
    out = dissolved(own)
    return out if sum(area2(r) for p in out for r in p) / 2 >= least else []


# ---- on DataFrames


def _units(shape) -> list[Polygon]:
    return [[[(round(p["x"] / UNIT), round(p["y"] / UNIT)) for p in ring] for ring in polygon] for polygon in shape] if shape is not None else []


def _metres(polygons: list[Polygon]) -> list:
    return [[[{"x": x * UNIT, "y": y * UNIT} for x, y in ring] for ring in polygon] for polygon in polygons]


def repair(areas: DataFrame) -> DataFrame:
    """areas (id, polygons in metres) as valid polygons; those of less than LEAST_AREA drop out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(i, _metres(found)) for i, shape in zip(pdf["id"], pdf["polygons"], strict=True) if (found := repaired(_units(shape)))]
            yield pd.DataFrame(rows, columns=["id", "polygons"])

    return areas.select(F.col("id").cast("string").alias("id"), "polygons").mapInPandas(run, f"id string, polygons {regions.POLYGONS}")


def subdivide(areas: DataFrame) -> DataFrame:
    """district, piece, ids (areas that hold the piece), polygons of the pieces between all areas' boundaries, of areas
    (district, id, polygons in metres); pieces that no area holds drop out. A district meets in one task."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        own = [(i, _units(shape)) for i, shape in zip(pdf["id"], pdf["polygons"], strict=True)]
        boxes = [(i, p, np.array([q for r in p for ring in r for q in ring])) for i, p in own if p]
        boxes = [(i, p, q.min(axis=0), q.max(axis=0)) for i, p, q in boxes]
        rows = []
        for k, face in enumerate(faces(noded(sides_of([ring for _, p in own for polygon in p for ring in polygon])))):
            x, y = regions.inner_point(face)
            ids = sorted(i for i, p, low, high in boxes if low[0] <= x <= high[0] and low[1] <= y <= high[1] and any(inside((x, y), polygon) for polygon in p))
            if ids:
                rows.append((key[0], k, ids, _metres([face])))
        return pd.DataFrame(rows, columns=["district", "piece", "ids", "polygons"])

    rows = areas.select(F.col("district").cast("string").alias("district"), F.col("id").cast("string").alias("id"), "polygons")
    return rows.groupBy("district").applyInPandas(run, f"district string, piece int, ids array<string>, polygons {regions.POLYGONS}")


def frequency(pieces: DataFrame, route_counts: DataFrame) -> DataFrame:
    """pieces with deduped_trips and unique_routes: of each route the best stop counts. route_counts: stop_id, route_id, n."""
    rows = pieces.select("district", "piece", F.explode("ids").alias("stop_id")).join(route_counts.select("stop_id", "route_id", "n"), "stop_id")
    best = rows.groupBy("district", "piece", "route_id").agg(F.max("n").alias("n"))
    sums = best.groupBy("district", "piece").agg(F.sum("n").alias("deduped_trips"), F.count(F.lit(1)).alias("unique_routes"))
    return pieces.join(sums, ["district", "piece"])


def dissolve(pieces: DataFrame, least: float = LEAST_AREA, most: float = 5_000_000.0) -> DataFrame:
    """district, deduped_trips, unique_routes (of the first piece of that frequency), area_ha, polygons of every connected
    region of equal frequency, of more than least and at most most square metres."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for trips, own in pdf.sort_values("piece").groupby("deduped_trips"):
            for region in dissolved([p for shape in own["polygons"] for p in _units(shape)]):
                square = sum(map(area2, region)) / 2 * UNIT**2
                if least < square <= most:
                    rows.append((key[0], trips, own["unique_routes"].iloc[0], square / 10_000, _metres([region])))
        return pd.DataFrame(rows, columns=["district", "deduped_trips", "unique_routes", "area_ha", "polygons"])

    return pieces.groupBy("district").applyInPandas(run, f"district string, deduped_trips long, unique_routes long, area_ha double, polygons {regions.POLYGONS}")
