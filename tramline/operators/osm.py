"""Map elements: layer filters on tags, geometries from ways and relations, ring assembly, simplification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.functions import classes, geo

ELEMENT = (
    "type string, id bigint, lat double, lon double, geometry array<struct<lat:double,lon:double>>, "
    "members array<struct<type:string,role:string,geometry:array<struct<lat:double,lon:double>>>>, tags map<string,string>"
)
POLYGON = "array<array<array<double>>>"
GEOMETRY = f"osm_id bigint, osm_type string, kind string, polygons array<{POLYGON}>, lines {POLYGON}"
SNAP = 1e-5

#: The tags that make each layer: (element types, key, values), any of which may hold.
LAYERS: dict[str, list[tuple[tuple[str, ...], str, tuple[str, ...]]]] = {
    "water": [(("way", "relation"), "natural", ("water",))],
    "waterways": [(("way",), "waterway", ("river", "stream", "canal"))],
    "parks": [(("way", "relation"), "leisure", ("park",))],
    "leisure": [(("way",), "leisure", ("garden", "playground", "pitch", "sports_centre", "stadium", "track", "swimming_pool", "recreation_ground", "dog_park", "fitness_station", "golf_course"))],
    "leisure_relations": [(("relation",), "leisure", ("garden", "playground", "pitch", "sports_centre", "stadium", "golf_course"))],
    "forests": [(("way", "relation"), "landuse", ("forest",)), (("way", "relation"), "natural", ("wood",))],
    "grass": [(("way", "relation"), "landuse", ("grass",))],
    "meadow": [(("way", "relation"), "landuse", ("meadow",))],
    "allotments": [(("way", "relation"), "landuse", ("allotments",))],
    "cemeteries": [(("way", "relation"), "landuse", ("cemetery",)), (("way", "relation"), "amenity", ("grave_yard",))],
    "railways": [(("way",), "railway", ("rail", "light_rail", "subway", "tram"))],
    "roads": [(("way",), "highway", (*classes.ROADS, *(f"{x}_link" for x in classes.LINKED)))],
}
#: The tags that these layers keep; the others keep all.
COLUMNS = {
    "railways": ("railway", "name", "usage", "service", "bridge", "tunnel", "layer", "gauge", "electrified"),
    "roads": ("highway", "name", "lanes", "surface", "bridge", "tunnel", "layer"),
}


def read_elements(spark: SparkSession, uri: str) -> DataFrame:
    """ELEMENT of the answers of a map query in JSON, one object with elements a file; what isn't there is null."""
    struct = ", ".join(f"{name}:{kind}" for name, kind in (x.split(" ", 1) for x in _top_level(ELEMENT)))
    return spark.read.schema(f"elements array<struct<{struct}>>").option("multiLine", True).json(uri).select(F.inline("elements"))


def _top_level(schema: str) -> list[str]:
    """The fields of a schema text."""
    out, depth = [""], 0
    for c in schema:
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append("")
        else:
            out[-1] += c
    return [x.strip() for x in out]


def only_polygons(shapes: DataFrame) -> DataFrame:
    """Shapes with an area, as buildings have."""
    return shapes.filter(F.col("kind").isin("Polygon", "MultiPolygon"))


def heavy_rail(features: DataFrame) -> DataFrame:
    """What is drawn of the railways, where the kind is known."""
    return features.filter("railway = 'rail'") if "railway" in features.columns else features


def centre(shapes: DataFrame) -> DataFrame:
    """shapes with lon and lat: a node's point, the centre of gravity of a way's line or of the largest outer ring."""
    point = lambda line: F.transform(line, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))
    outer = F.transform(F.col("polygons"), lambda polygon: point(polygon[0]))
    largest = F.get(F.array_sort(outer, lambda a, b: (geo.ring_area(b) > geo.ring_area(a)).cast("int") - (geo.ring_area(b) < geo.ring_area(a)).cast("int")), F.lit(0))
    at = F.when(F.size("polygons") > 0, geo.ring_centroid(largest)).otherwise(geo.line_centroid(point(F.get("lines", F.lit(0)))))
    return shapes.withColumn("_at", at).withColumns({"lon": F.col("_at.x"), "lat": F.col("_at.y")}).drop("_at")


def tag(name: str) -> Column:
    return F.try_element_at("tags", F.lit(name))


def layer(elements: DataFrame, name: str) -> DataFrame:
    """Elements whose type and tags belong to a layer; "buildings" are those with any building tag."""
    if name == "buildings":
        return elements.filter(tag("building").isNotNull())
    holds = F.lit(False)
    for types, key, values in LAYERS[name]:
        holds = holds | (F.col("type").isin(*types) & tag(key).isin(*values))
    return elements.filter(F.coalesce(holds, F.lit(False)))


def project_tags(elements: DataFrame, names: list[str]) -> DataFrame:
    """osm_id, osm_type and the listed tags as columns."""
    return elements.select(F.col("id").alias("osm_id"), F.col("type").alias("osm_type"), *[tag(n).alias(n) for n in names])


def roads(features: DataFrame) -> DataFrame:
    """features with the rank of their class, and whether they are drawn as major; without a class they are minor."""
    kind = F.col(next((c for c in classes.ROAD_COLUMNS if c in features.columns), None) or "highway")
    return features.withColumn("hierarchy", classes.road_rank(kind)).withColumn("major", F.coalesce(kind.isin(*classes.MAJOR_ROADS), F.lit(False)))


def buildings(features: DataFrame) -> DataFrame:
    """osm_id, osm_type, name, building, levels, housenumber, street of features, without roofs and service buildings."""
    wanted = {"name": "name", "building": "building", "building:levels": "levels", "addr:housenumber": "housenumber", "addr:street": "street"}
    columns = [(F.col(f"`{a}`") if a in features.columns else F.lit(None).cast("string")).alias(b) for a, b in wanted.items()]
    out = features.select("osm_id", "osm_type", *columns).withColumn("levels", classes.building_levels(F.col("levels")))
    return out.filter(F.coalesce(~F.col("building").isin("roof", "service"), F.lit(True)))


def rail_stops(elements: DataFrame) -> DataFrame:
    """Elements with a railway kind, and the seconds of reach for it."""
    kind = classes.railway_kind(tag("railway"), {k: tag(k) for k in ("light_rail", "subway", "tram", "monorail", "train")})
    return elements.withColumn("railway", kind).filter("railway IS NOT NULL").withColumn("time_limit", classes.time_limit(F.col("railway")))


def stops_in(elements: DataFrame, south: float, west: float, north: float, east: float) -> DataFrame:
    """rail_stops with lon and lat whose centre lies in a box: nodes as they lie, ways by their centre."""
    found = rail_stops(elements)
    at = centre(geometries(found)).select(F.col("osm_id").alias("id"), F.col("osm_type").alias("type"), "lon", "lat")
    at = at.filter(F.col("lon").between(west, east) & F.col("lat").between(south, north))
    return found.drop("lon", "lat").join(at, ["id", "type"])


# ---- geometry kernels: order matters in them, so they run in Python on Arrow batches


def _closed(line: list) -> bool:
    return _gap(line[0], line[-1]) < SNAP


def _gap(a: tuple, b: tuple) -> float:
    return ((a[0] - b[0]) ** 2 + (a[1] - b[1]) ** 2) ** 0.5


def _shut(line: list) -> list:
    return line if line[0] == line[-1] else [*line, line[0]]


def assemble(ways: list[list]) -> list[list]:
    """Closed rings from way segments: a ring grows by the unused segment with the nearest end, either way round (its
    start is preferred on ties), until its ends meet; what is left over is closed by force."""
    parts = [list(map(tuple, w)) for w in ways]
    if len(parts) == 1:
        return [_shut(parts[0])] if parts[0] else []
    parts = [w for w in parts if len(w) >= 2]
    free, rings = dict.fromkeys(range(len(parts))), []
    while free:
        k = next(iter(free))
        del free[k]
        ring, turns = list(parts[k]), 2 * len(parts)
        while turns and not _closed(ring) and free:
            gap, j, turned = min((_gap(ring[-1], parts[j][-turned]), j, turned) for j in free for turned in (0, 1))
            del free[j]
            more = parts[j][::-1] if turned else parts[j]
            ring += more[1:] if gap < SNAP else more
            turns -= 1
        if turns or len(_shut(ring)) >= 4:
            rings.append(_shut(ring))
    return rings


def inside(point: tuple, ring: list) -> bool:
    """Whether a point lies in a ring, by crossings of a ray."""
    x, y = point
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:], strict=False):
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            odd = not odd
    return odd


def holds(outer: list, hole: list) -> bool:
    """Whether a ring holds another whole: all its corners and the middles of its sides, on the ring or inside."""
    middles = [((a[0] + b[0]) / 2, (a[1] + b[1]) / 2) for a, b in zip(hole, hole[1:], strict=False)]
    places = [inside(p, outer) or on_line(p, outer) for p in (*hole, *middles)]
    return all(places) and any(inside(p, outer) and not on_line(p, outer) for p in (*hole, *middles))


def on_line(point: tuple, line: list) -> bool:
    x, y = point
    for (ax, ay), (bx, by) in zip(line, line[1:], strict=False):
        cross = (bx - ax) * (y - ay) - (by - ay) * (x - ax)
        if abs(cross) <= 1e-12 * (abs(bx - ax) + abs(by - ay) + 1e-300) and min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by):
            return True
    return False


def shape(kind: str, geometry: list | None, members: list | None) -> tuple[str, list, list] | None:
    """(Polygon, LineString, MultiPolygon or MultiLineString, polygons, lines) of a way or relation; None for none."""
    if kind == "way":
        line = [(p["lon"], p["lat"]) for p in geometry if p is not None] if geometry is not None else []
        if len(line) < 2:
            return None
        return ("Polygon", [[line]], []) if len(line) > 3 and line[0] == line[-1] else ("LineString", [], [line])
    own: dict[str, list] = {"outer": [], "inner": [], "": []}
    for m in members if members is not None else []:
        line = [(p["lon"], p["lat"]) for p in m["geometry"] if p is not None] if m is not None and m["geometry"] is not None else []
        if line:
            own[m["role"] if m["role"] in ("outer", "inner") else ""].append(line)
    outer = [r for r in assemble(own["outer"]) if len(r) >= 4] if own["outer"] else []
    if outer:
        inner = [r for r in assemble(own["inner"]) if len(r) >= 4] if own["inner"] else []
        if len(outer) == 1:
            return "Polygon", [[outer[0], *inner]], []
        return "MultiPolygon", [[o, *(i for i in inner if holds(o, i))] for o in outer], []
    lines = [x for x in own[""] if len(x) >= 2]
    return ("MultiLineString", [], lines) if lines else None


def geometries(elements: DataFrame) -> DataFrame:
    """GEOMETRY of elements (ELEMENT); nodes are points at once, and what has no geometry drops out."""
    points = elements.filter("type = 'node' AND lat IS NOT NULL AND lon IS NOT NULL").select(
        F.col("id").alias("osm_id"), F.col("type").alias("osm_type"), F.lit("Point").alias("kind"), F.array().cast(f"array<{POLYGON}>").alias("polygons"), F.array(F.array(F.array("lon", "lat"))).alias("lines")
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for i, t, g, m in zip(pdf["id"], pdf["type"], pdf["geometry"], pdf["members"], strict=True):
                if (found := shape(t, g, m)) is not None:
                    rows.append((i, t, found[0], [[[list(p) for p in r] for r in poly] for poly in found[1]], [[list(p) for p in x] for x in found[2]]))
            yield pd.DataFrame(rows, columns=["osm_id", "osm_type", "kind", "polygons", "lines"])

    shapes = elements.filter("type IN ('way', 'relation')").select("id", "type", "geometry", "members").mapInPandas(run, GEOMETRY)
    return points.unionByName(shapes)


def simplify_line(line: np.ndarray, tolerance: float) -> np.ndarray:
    """Douglas-Peucker: points farther than tolerance from the chord stay, with the ends. Rings keep four points."""
    keep = np.zeros(len(line), bool)
    keep[[0, -1]] = True
    stack = [(0, len(line) - 1)]
    while stack:
        a, b = stack.pop()
        if b - a < 2:
            continue
        p, q, mid = line[a], line[b], line[a + 1 : b]
        d = q - p
        n2 = float(d @ d)
        u = np.clip(((mid - p) @ d) / n2, 0, 1) if n2 else np.zeros(len(mid))
        far = ((mid - (p + u[:, None] * d)) ** 2).sum(axis=1)
        k = int(far.argmax())
        if far[k] > tolerance**2:
            keep[a + 1 + k] = True
            stack += [(a, a + 1 + k), (a + 1 + k, b)]
    ring = len(line) > 3 and (line[0] == line[-1]).all()
    if ring and keep.sum() < 4:
        far = np.argsort(-((line[1:-1] - line[0]) ** 2).sum(axis=1), kind="stable")[: 4 - int(keep.sum())] + 1
        keep[far] = True
    return line[keep]


def crosses_itself(line: np.ndarray) -> bool:
    """Whether two sides of a line that aren't neighbours meet."""
    a, b = line[:-1], line[1:]
    n, ring = len(a), bool((line[0] == line[-1]).all())
    side = lambda p, q, r: (q[..., 0] - p[..., 0]) * (r[..., 1] - p[..., 1]) - (q[..., 1] - p[..., 1]) * (r[..., 0] - p[..., 0])
    for k in range(n - 2):
        rest = slice(k + 2, n - (ring and k == 0))
        c, d = a[rest], b[rest]
        apart = (np.minimum(c, d) > np.maximum(a[k], b[k])).any(axis=1) | (np.maximum(c, d) < np.minimum(a[k], b[k])).any(axis=1)
        meet = (np.sign(side(a[k], b[k], c)) * np.sign(side(a[k], b[k], d)) <= 0) & (np.sign(side(c, d, a[k])) * np.sign(side(c, d, b[k])) <= 0)
        if (meet & ~apart).any():
            return True
    return False


def simplified(line: np.ndarray, tolerance: float) -> np.ndarray:
    """simplify_line, with half the tolerance as long as that makes a line cross itself that didn't."""
    out = simplify_line(line, tolerance)
    if len(out) < len(line) and len(out) > 3 and crosses_itself(out) and not crosses_itself(line):
        for _ in range(20):
            tolerance /= 2
            out = simplify_line(line, tolerance)
            if not crosses_itself(out):
                return out
        return line
    return out


def simplify(lines: DataFrame, tolerance: float = 5.0) -> DataFrame:
    """lines (id, line array<array<double>>) with fewer points; lines that don't cross themselves still don't. A null or
    empty line stays as it is."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [x if x is None or not len(x) else simplified(np.array([np.asarray(p, float) for p in x]), tolerance).tolist() for x in pdf["line"]]
            yield pd.DataFrame({"id": pdf["id"], "line": out})

    return lines.select("id", "line").mapInPandas(run, "id bigint, line array<array<double>>")
