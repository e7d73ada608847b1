"""Outlines, projections, pictures and sinks of regions, and what reads them."""

import json
import random
import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tramline.functions import geo
from tramline.operators import coverage, osm, regions, spatial, styles
from tramline.plans import lineage, picture
from tramline.sources import files, shapefile
from tramline.streaming import resume

CELLS = st.sets(st.tuples(st.integers(-4, 4), st.integers(-4, 4)), min_size=1, max_size=60)


def area(ring):
    return sum(x1 * y2 - x2 * y1 for (x1, y1), (x2, y2) in zip(ring, ring[1:], strict=False)) / 2


@settings(max_examples=200, deadline=None)
@given(CELLS)
def test_outlines_enclose_the_cells(cells):
    parts = regions.parts(cells)
    assert sorted(c for p in parts for c in p) == sorted(cells)
    for part in parts:
        rings = regions.outline(part)
        areas = [area(r) for r in rings]
        assert areas[0] > 0 and all(a < 0 for a in areas[1:]) and sum(areas) == len(part)
        assert all(r[0] == r[-1] and all((a[0] == b[0]) != (a[1] == b[1]) for a, b in zip(r, r[1:], strict=False)) for r in rings)
        for x in range(-5, 6):
            for y in range(-5, 6):
                assert (sum(osm.inside((x + 0.5, y + 0.5), r) for r in rings) % 2 == 1) == ((x, y) in part)
        x, y = regions.inner_point(rings)
        assert sum(osm.inside((x, y), r) for r in rings) % 2 == 1


def test_regions_in_degrees(spark):
    cells = spark.createDataFrame([("a", 24_000 + x, 18_000 + y) for x in range(3) for y in range(3) if (x, y) != (1, 1)] + [("b", 24_100, 18_000)], "part string, cx long, cy long")
    shapes = regions.outlines(cells, "part", 25.0)
    p = F.col("polygons")
    got = {r.part: r for r in shapes.select("part", regions.area(p).alias("area"), regions.length(p).alias("length"), regions.valid(p).alias("valid"), F.size(regions.rings(p)).alias("rings")).collect()}
    assert (got["a"].area, got["a"].length, got["a"].valid, got["a"].rings) == (8 * 625.0, 16 * 25.0, True, 2)
    assert (got["b"].area, got["b"].rings) == (625.0, 1)
    assert [r.part for r in regions.cleaned(shapes, 625.0, 10_000.0).collect()] == ["a"]
    for crs in geo.SYSTEMS:
        turned = shapes.withColumn("polygons", regions.to_degrees(p, crs))
        back = {r.part: r.polygons for r in turned.withColumn("polygons", regions.to_metres(F.col("polygons"), crs)).collect()}
        for r in shapes.collect():
            for ring, other in zip(r.polygons[0], back[r.part][0], strict=True):
                assert np.allclose([(q.x, q.y) for q in ring], [(q.x, q.y) for q in other], atol=1e-5)


def test_odd_regions(spark):
    rows = [(1, None), (2, []), (3, [[[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]]]), (4, [[[(0.0, 0.0), (1.0, 0.0), (0.0, 0.0)]]]), (5, [[[(0.0, 0.0), (1.0, 0.0), (2.0, 0.0), (0.0, 0.0)]]]), (6, [[[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.5, 0.0)]]])]
    df = spark.createDataFrame(rows, f"id int, polygons {regions.POLYGONS}")
    assert [r.id for r in df.filter(regions.valid(F.col("polygons"))).collect()] == [3]


def test_centroids(spark):
    line = lambda *ps: F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ps])
    at = lambda c: tuple(spark.range(1).select(c.alias("c")).first().c)
    far = 1e7
    assert np.allclose(at(geo.ring_centroid(line((far, far), (far + 4, far), (far + 4, far + 2), (far, far + 2), (far, far)))), (far + 2, far + 1))
    assert at(geo.line_centroid(line((0, 0), (4, 0), (4, 4)))) == (3.0, 1.0)
    assert at(geo.line_centroid(line((3, 2)))) == (3.0, 2.0) and at(geo.ring_centroid(line((0, 0), (2, 0), (0, 0)))) == (1.0, 0.0)


def test_nearest_node_equals_brute_force(spark):
    rng = random.Random(3)
    for lat, snap in ((52.2, 500.0), (69.0, 500.0), (52.2, 4000.0)):
        stops = [(f"s{k}", 20.9 + rng.uniform(-0.1, 0.1), lat + rng.uniform(-0.05, 0.05)) for k in range(25)]
        nodes = [(k, 20.9 + rng.uniform(-0.12, 0.12), lat + rng.uniform(-0.06, 0.06)) for k in range(120)]
        df = spark.createDataFrame(nodes, "node_id long, x double, y double")
        got = {r.stop_id: (r.node_id, r.snap_cm) for r in spatial.nearest_node(spark.createDataFrame(stops, "stop_id string, stop_lon double, stop_lat double"), df, "EPSG:2180", snap).collect()}
        e, n = geo.project(F.col("x"), F.col("y"), "EPSG:2180")
        metres = {r.node_id: (r.e, r.n) for r in df.select("node_id", e.alias("e"), n.alias("n")).collect()}
        own = {r.stop: (r.e, r.n) for r in spark.createDataFrame(stops, "stop string, x double, y double").select("stop", e.alias("e"), n.alias("n")).collect()}
        want = {}
        for s, x, y in stops:
            node = min(nodes, key=lambda q: ((q[1] - x) ** 2 + (q[2] - y) ** 2, q[0]))[0]
            cm = round(100 * float(np.hypot(*np.subtract(metres[node], own[s]))))
            if cm <= snap * 100:
                want[s] = (node, cm)
        assert got == want and len(want) > 2


def test_simplified_lines(spark):
    rows = [(1, None), (2, []), (3, [[0.0, 0.0]]), (4, [[0.0, 0.0], [5.0, 1.0], [10.0, 0.0]])]
    got = {r.id: r.line for r in osm.simplify(spark.createDataFrame(rows, "id long, line array<array<double>>")).collect()}
    assert got == {1: None, 2: [], 3: [[0.0, 0.0]], 4: [[0.0, 0.0], [10.0, 0.0]]}
    # the plain rule cuts the hook's neck, so that the line would cross itself
    hook = np.array([(0, 0), (10, 0), (10, 4), (5, 4), (5, 1), (4, 1), (4, 8), (20, 8), (20, -3), (6, -3), (6, 3)], float)
    for line in (hook, hook[::-1].copy()):
        for tolerance in (1.0, 2.0, 3.0, 5.0):
            out = osm.simplified(line, tolerance)
            assert osm.crosses_itself(line) or not osm.crosses_itself(out)
    assert osm.crosses_itself(np.array([(0, 0), (2, 2), (2, 0), (0, 2)], float)) and not osm.crosses_itself(np.array([(0, 0), (2, 0), (2, 2), (0, 0)], float))


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), min_size=3, max_size=14, unique=True), st.integers(1, 6))
def test_simplified_lines_keep_from_crossing(points, tolerance):
    line = np.array(points, float)
    assert osm.crosses_itself(line) or not osm.crosses_itself(osm.simplified(line, tolerance))


def test_holes_lie_in_their_ring():
    square = lambda x, y, s: [(x, y), (x + s, y), (x + s, y + s), (x, y + s), (x, y)]
    assert osm.holds(square(0, 0, 10), square(2, 2, 3)) and osm.holds(square(0, 0, 10), square(0, 0, 3))
    assert not osm.holds(square(0, 0, 10), square(8, 8, 3)) and not osm.holds(square(0, 0, 10), square(20, 0, 3))


def test_elements_of_map_answers(spark, tmp_path):
    answer = {"version": 0.6, "elements": [{"type": "node", "id": 1, "lat": 52.0, "lon": 20.0, "tags": {"railway": "tram_stop"}}, {"type": "way", "id": 2, "geometry": [{"lat": 52.0, "lon": 20.0}, {"lat": 52.1, "lon": 20.0}], "tags": {"highway": "primary"}}, {"type": "relation", "id": 3, "members": [{"type": "way", "role": "outer", "ref": 9, "geometry": [{"lat": 1.0, "lon": 1.0}]}]}]}
    (tmp_path / "a.json").write_text(json.dumps(answer))
    (tmp_path / "b.json").write_text(json.dumps({"elements": []}))
    rows = osm.read_elements(spark, f"file://{tmp_path}/*.json")
    assert rows.count() == 3 and [r.id for r in osm.layer(rows, "roads").collect()] == [2]
    assert [r.members[0].role for r in rows.filter("type = 'relation'").collect()] == ["outer"]
    centres = {r.osm_id: (round(r.lon, 6), round(r.lat, 6)) for r in osm.centre(osm.geometries(rows)).collect()}
    assert centres == {1: (20.0, 52.0), 2: (20.0, 52.05)}


def test_rail_stops_in_a_box(spark):
    line = lambda x: [{"lat": 52.0, "lon": x}, {"lat": 52.0, "lon": x + 0.002}]
    rows = [("node", 1, 52.0, 20.0, None, None, {"railway": "tram_stop"}), ("node", 2, 53.0, 20.0, None, None, {"railway": "tram_stop"}), ("way", 3, None, None, line(20.0), None, {"subway": "yes"}), ("way", 4, None, None, line(20.1), None, {"subway": "yes"}), ("way", 5, None, None, line(20.0), None, {"highway": "primary"})]
    got = osm.stops_in(spark.createDataFrame(rows, osm.ELEMENT), 51.9, 19.99, 52.1, 20.01).collect()
    assert {r.id: (round(r.lon, 6), r.railway, r.time_limit) for r in got} == {1: (20.0, "tram", 480), 3: (20.001, "subway", 720)}


def test_appended_rows(spark, tmp_path):
    at = f"file://{tmp_path}/done"
    for n, total in ((3, 3), (5, 5), (4, 5)):
        resume.append_new(spark.range(n).withColumnRenamed("id", "k"), at, "k")
        assert spark.read.parquet(at).count() == total


def test_sinks_of_areas(spark, tmp_path):
    cells = spark.createDataFrame([(1, 0, 0), (1, 2, 2), (2, 5, 5)], "part int, cx long, cy long")
    rows = regions.outlines(cells, "part", 1.0).withColumn("deduped_trips", F.col("part").cast("int") * 10)
    empty = spark.createDataFrame([("3", None, 5)], rows.schema)
    assert files.write_geopackage(rows.unionByName(empty), f"file://{tmp_path}/map.gpkg", "coverage_map", srid=2180) == 3
    got = regions.of_geopackage(files.read_geopackage(spark, f"file://{tmp_path}/map.gpkg"))
    want = {r.deduped_trips: r.polygons for r in rows.collect()}
    assert {r.deduped_trips: r.polygons for r in got.collect()} == want | {5: []}
    assert files.read_geopackage(spark, f"file://{tmp_path}/map.gpkg").filter("xmax = 3 AND ymax = 3 AND xmin = 0").count() == 1
    assert files.write_feature_collection(files.geojson_areas(rows, "polygons", ["part"]), f"file://{tmp_path}/map.json") == 2
    found = json.loads((tmp_path / "map.json").read_text())
    assert found["type"] == "FeatureCollection" and {f["properties"]["part"] for f in found["features"]} == {"1", "2"}


def test_graph_forms(spark, tmp_path):
    nodes = spark.createDataFrame([(1, 20.5, 52.25), (2, 20.75, 52.5)], "node_id long, x double, y double")
    edges = spark.createDataFrame([(1, 2, 100.5)], "src long, dst long, length double")
    at = f"file://{tmp_path}/walk"
    assert files.load_graph(spark, at) is None
    files.write_text(files.graphml(nodes, edges), f"{at}/walk.graphml")
    for _ in range(2):
        a, b = files.load_graph(spark, at)
        assert sorted(map(tuple, a.collect())) == [(1, 20.5, 52.25), (2, 20.75, 52.5)] and [tuple(r) for r in b.collect()] == [(1, 2, 100.5)]
        files.write_graph(nodes, edges, at)


def test_deleted_rows_and_appended_shapes(spark, tmp_path):
    point = lambda x: [[(float(x), 1.0)]]
    out = shapefile.write_shapefile("Point", [(point(k), {"n": str(k)}) for k in range(3)])
    head, width = struct.unpack("<HH", out["dbf"][8:12])
    out["dbf"] = out["dbf"][: head + width] + b"*" + out["dbf"][head + width + 1 :]
    more = shapefile.append_shapefile(out, "Point", [(point(9), {"n": "9", "m": "x"})])
    for name, parts in (("one", out), ("two", more)):
        for suffix, content in parts.items():
            files.write_bytes(f"file://{tmp_path}/{name}.{suffix}", content)
    read = lambda name: [(r.parts[0][0][0], r.properties["n"]) for r in shapefile.read_shapefile(spark, f"file://{tmp_path}/{name}.shp").orderBy("record").collect()]
    assert read("one") == [(0.0, "0"), (2.0, "2")] and read("two") == [(0.0, "0"), (2.0, "2"), (9.0, "9")]


def pixels(data):
    width, height = struct.unpack(">2I", data[16:24])
    at, packed = 8, b""
    while at < len(data):
        n = struct.unpack(">I", data[at : at + 4])[0]
        if data[at + 4 : at + 8] == b"IDAT":
            packed += data[at + 8 : at + 8 + n]
        at += 12 + n
    return np.frombuffer(zlib.decompress(packed), np.uint8).reshape(height, 1 + 3 * width)[:, 1:].reshape(height, width, 3)


def test_pictures(spark):
    cells = {(x, y) for x in range(10) for y in range(6)} - {(3, 3), (4, 3)}
    df = spark.createDataFrame([(1, *c) for c in cells] + [(2, 12, 1)], "part int, cx long, cy long")
    rows = regions.outlines(df, "part", 25.0).withColumn("deduped_trips", F.when(F.col("part") == "1", 60).otherwise(5000))
    line = spark.createDataFrame([([[(0.0, 190.0), (375.0, 190.0)]],)], "lines array<array<struct<x:double,y:double>>>")
    frame = picture.Frame(0.0, 375.0, 0.0, 200.0, 15)
    found = pixels(picture.png(picture.draw(frame, {"coverage": rows, "railways": line})))
    assert found.shape == (8, 15, 3)
    shade = lambda rgb, a: tuple(np.round(np.array(picture.BACKGROUND) * (1 - a) + np.array(rgb) * a).astype(int))
    for x in range(15):
        for y in range(8):
            want = shade(picture.RAIL, 0.7) if y == 7 else shade(styles.classes.COLORS[3], 0.9) if (x, y) in cells else shade(styles.classes.COLORS[17], 0.9) if (x, y) == (12, 1) else picture.BACKGROUND
            assert tuple(found[7 - y, x]) == want


def test_styles_of_palettes(spark):
    texts = styles.documents()
    assert len([n for n in texts if n.startswith("light/")]) == 8 and all(len(c) == 18 for c in styles.PALETTES.values())
    assert texts["light/transit_frequency"] == texts["light/transit_frequency_glasgow"] and "54,18,56,255" in texts["light/transit_frequency"]
    rows = spark.createDataFrame([(0,), (1,), (9,), (10,), (9999,)], "deduped_trips int")
    assert sorted((r.deduped_trips, r["class"], r.r, r.opacity) for r in styles.coloured(rows).collect()) == [(1, 0, 0, 0.9), (9, 0, 0, 0.9), (10, 1, 0, 0.9), (9999, 17, 255, 0.9)]
    order = spark.createDataFrame([("railways",), ("water",), ("leisure",)], "layer string").select("layer", styles.draw_order(F.col("layer")).alias("k"))
    assert {r.layer: r.k for r in order.collect()} == {"railways": 12, "water": 8, "leisure": None}


def test_first_routes_of_a_frequency(spark):
    """Two regions of one frequency: the first cell's route count, or each region's own."""
    freq = spark.createDataFrame([(0, 0, 5, 2), (1, 0, 5, 3), (9, 0, 5, 4), (4, 4, 7, 1)], "cx long, cy long, deduped_trips long, unique_routes long")
    of = lambda **k: {r.part: r.unique_routes for r in coverage.dissolve(freq, **k).collect()}
    assert of() == {"0_0": 2, "9_0": 2, "4_4": 1} and of(first_of_value=False) == {"0_0": 2, "9_0": 4, "4_4": 1}


def test_labels_of_winding_regions(spark):
    rng = random.Random(2)
    cells = {(x, y): rng.choice([1, 2]) for x in range(-9, 9) for y in range(-9, 9)}
    want = {}
    for value in (1, 2):
        for part in regions.parts({c for c, v in cells.items() if v == value}):
            want |= dict.fromkeys(part, "{}_{}".format(*min(part)))
    freq = spark.createDataFrame([(x, y, v, 1) for (x, y), v in cells.items()], "cx long, cy long, deduped_trips long, unique_routes long")
    assert {(r.cx, r.cy): r.part for r in coverage.labelled(freq).collect()} == want


class Elsewhere:
    """A session on a cluster, as far as the shared folder goes."""

    def __init__(self, master, folder=None):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = type("Conf", (), {"get": staticmethod(lambda *_: folder)})


def test_shared_folder(spark):
    for master in ("spark://host:7077", "yarn", "k8s://host", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="checkpoint"):
            lineage.shared_dir(Elsewhere(master))
    assert lineage.shared_dir(Elsewhere("yarn", "hdfs://x/y/")) == "hdfs://x/y"
    path = lineage.fresh_path(spark, "cut")
    assert path.startswith(lineage.own_dir(spark)) and spark.sparkContext.applicationId in path
    spark.range(3).write.parquet(path)
    assert files.exists(spark, path)
    lineage.remove(spark, path)
    assert not files.exists(spark, path)
