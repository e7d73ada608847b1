"""Operators on small hand-made inputs."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tramline.operators import calendar, components, coverage, feeds, network, osm, spatial, styles, timetable


def test_calendar_merge(spark):
    weekly = spark.createDataFrame([("a", 1, 1, 1, 1, 1, 0, 0, 20260803, 20260809), ("b", 0, 0, 0, 0, 0, 1, 1, 20260809, 20260803)], "service_id string, " + ", ".join(f"{d} int" for d in calendar.WEEKDAYS) + ", start_date int, end_date int")
    changes = spark.createDataFrame([("a", 20260803, 2), ("a", 20260808, 1), ("a", 20260804, 1), ("c", 20260801, 1)], "service_id string, date int, exception_type int")
    got = {(r[0], r[1]) for r in calendar.effective(weekly, changes).collect()}
    assert got == {("a", d) for d in (20260804, 20260805, 20260806, 20260807, 20260808)} | {("c", 20260801)}
    assert calendar.effective(None, changes).count() == 4
    with pytest.raises(ValueError, match="neither"):
        calendar.effective(None, None)


def test_substring_and_exact_services(spark):
    trips = spark.createDataFrame([("t1", "2026:1"), ("t2", "10"), ("t3", None), ("t4", "1")], "trip_id string, service_id string")
    services = spark.createDataFrame([("1",), (None,)], "service_id string")
    assert {r[0] for r in timetable.trips_of_services(trips, services).collect()} == {"t1", "t2", "t4"}
    assert {r[0] for r in timetable.trips_of_services(trips, services, exact=True).select("trip_id").collect()} == {"t4"}


def test_frequencies_fall_back_to_all_services(spark):
    f = spark.createDataFrame([("t", "06:00:00", "06:10:00", 300), ("t", "07:00:00", "07:00:00", 300), ("t", "08:00:00", "09:00:00", 0)], "trip_id string, start_time string, end_time string, headway_secs int")
    trips = spark.createDataFrame([("t", "M1", "x")], "trip_id string, route_id string, service_id string")
    times = spark.createDataFrame([("t", "A"), ("t", "B")], "trip_id string, stop_id string")
    for service, n in (("2026-1", 4), ("x", 4), ("other", 0)):
        services = spark.createDataFrame([(service,)], "service_id string")
        assert timetable.expand_frequencies(f, trips, times, services).count() == n


def test_golden_city(spark):
    """Two stops that overlap and one apart: a route counts once where both reach, by its larger stop."""
    counts = spark.createDataFrame([("A", "10", 5), ("A", "M1", 2), ("B", "10", 8), ("C", "M1", 1)], "stop_id string, route_id string, n long")
    segments = spark.createDataFrame([("A", 0.0, 0.0, 150.0, 0.0), ("B", 100.0, 0.0, 300.0, 0.0), ("C", 2000.0, 0.0, 2000.0, 0.0)], "stop_id string, ax double, ay double, bx double, by double")
    freq = coverage.frequency(coverage.cells(segments), counts)
    by = {(r.cx, r.cy): (r.deduped_trips, r.unique_routes) for r in freq.collect()}
    assert by[(0, 0)] == (7, 2) and by[(11, 0)] == (8, 1) and by[(5, 0)] == (10, 2) and by[(80, 0)] == (1, 1)
    parts = coverage.dissolve(freq).collect()
    assert sorted(r.deduped_trips for r in parts) == [1, 7, 8, 10]
    assert abs(sum(r.area_ha for r in parts) - len(by) * 0.0625) < 1e-9


def test_reach_is_bounded_and_directed(spark):
    edges = spark.createDataFrame([(1, 2, 200.0), (2, 3, 175.0), (3, 4, 1.0), (2, 1, 200.0), (1, 3, 400.0), (1, 2, 300.0)], "src long, dst long, length double")
    seeds = spark.createDataFrame([("s", 1), ("u", 4)], "stop_id string, node_id long")
    got = {(r.stop_id, r.node_id): r.dist for r in network.reach(seeds, edges).collect()}
    assert got == {("s", 1): 0.0, ("s", 2): 200.0, ("s", 3): 375.0}
    ends = {(r.src, r.dst) for r in network.reached_edges(network.reach(seeds, edges), edges).collect()}
    assert ends == {(1, 2), (2, 1), (2, 3), (1, 3)}


def test_components_on_a_long_path(spark):
    n = 60
    order = random.Random(1).sample(range(n), n)
    edges = spark.createDataFrame([(order[k], order[k + 1]) for k in range(n - 1)], "a long, b long")
    vertices = spark.createDataFrame([(k,) for k in range(n + 1)], "v long")
    got = {r.v: r.component for r in components.components(vertices, edges).collect()}
    assert all(got[k] == 0 for k in range(n)) and got[n] == n
    assert components.largest(vertices, edges).count() == n


def test_nearest_node_cutoff_and_ties(spark):
    stops = spark.createDataFrame([("a", 20.9, 52.2), ("far", 20.92, 52.2)], "stop_id string, stop_lon double, stop_lat double")
    nodes = spark.createDataFrame([(2, 20.901, 52.2), (1, 20.899, 52.2)], "node_id long, x double, y double")
    got = spatial.nearest_node(stops, nodes, "EPSG:2180").collect()
    assert [r.stop_id for r in got] == ["a"]


def test_tiles_cover_the_box(spark):
    rows = {r.tile: r for r in spatial.tiles(spark, 0.0, 10.0, 4.0, 14.0, 4).collect()}
    assert len(rows) == 16 and rows["0_0"].south == 0.0 and rows["3_3"].east == 14.0 and rows["1_2"].west == 12.0


def test_feed_append_keeps_nulls(spark):
    base = spark.createDataFrame([("1", "x")], "a string, b string")
    more = spark.createDataFrame([(None, "z")], "a string, c string")
    assert [tuple(r) for r in feeds.append(base, feeds.prefix(more, ("a",), "p_")).collect()] == [("1", "x"), (None, None)]


def test_rings():
    square = [(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)]
    assert osm.assemble([]) == []
    assert osm.assemble([square[:4]]) == [[*square[:4], square[0]]]
    assert osm.assemble([[(0, 0), (1, 0)], [(1, 1), (1, 0)], [(1, 1), (0, 1)], [(0, 0), (0, 1)]]) == [square]
    assert osm.assemble([square, [(5, 5)]]) == [square]
    two = osm.assemble([square, [(9, 9), (10, 9), (10, 10), (9, 9)]])
    assert len(two) == 2


def test_geometries(spark):
    point = lambda x, y: {"lat": float(y), "lon": float(x)}
    ring = [point(0, 0), point(4, 0), point(4, 4), point(0, 0)]
    hole = [point(2, 1), point(3, 1), point(3, 2), point(2, 1)]
    member = lambda role, g: {"type": "way", "role": role, "geometry": g}
    rows = [
        ("node", 1, 52.0, 20.0, None, None, {}), ("way", 2, None, None, ring, None, {}), ("way", 3, None, None, ring[:2], None, {}), ("way", 4, None, None, ring[:1], None, {}),
        ("relation", 5, None, None, None, [member("outer", ring), member("inner", hole)], {}), ("relation", 6, None, None, None, [member("stop", ring)], {}), ("relation", 7, None, None, None, None, {}),
    ]
    got = {r.osm_id: r for r in osm.geometries(spark.createDataFrame(rows, osm.ELEMENT)).collect()}
    assert {k: r.kind for k, r in got.items()} == {1: "Point", 2: "Polygon", 3: "LineString", 5: "Polygon", 6: "MultiLineString"}
    assert len(got[5].polygons[0]) == 2


def test_layers(spark):
    rows = spark.createDataFrame([("way", 1, {"natural": "water"}), ("node", 2, {"natural": "water"}), ("relation", 3, {"leisure": "garden"}), ("way", 4, {"building": "yes"}), ("way", 5, {})], "type string, id long, tags map<string,string>")
    found = {name: [r.id for r in osm.layer(rows, name).collect()] for name in ("water", "leisure_relations", "leisure", "buildings")}
    assert found == {"water": [1], "leisure_relations": [3], "leisure": [], "buildings": [4]}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(-50, 50), st.integers(-50, 50)), min_size=2, max_size=25), st.integers(1, 20))
def test_simplified_line_stays_within_tolerance(points, tolerance):
    line = np.array(points, float)
    out = osm.simplify_line(line, tolerance)
    assert (out[0] == line[0]).all() and (out[-1] == line[-1]).all()
    for p in line:
        best = np.inf
        for a, b in zip(out, out[1:], strict=False):
            d = b - a
            n2 = float(d @ d)
            u = np.clip((p - a) @ d / n2, 0, 1) if n2 else 0
            best = min(best, float(((p - a - u * d) ** 2).sum()))
        assert best <= tolerance**2 + 1e-6


def test_styles_cover_all_layers():
    texts = styles.documents()
    assert texts["coverage_map"].count("<range ") == 18 and 'label="3500+"' in texts["coverage_map"]
    assert texts["roads"].count("<category ") == 21 and {"parks", "water", "railways"} <= set(texts)
