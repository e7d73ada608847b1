"""The exact subdivision against sampled points."""

import random

import pytest
from pyspark.sql import functions as F

from tramline.operators import exact, regions


def ring(draw, size):
    """A triangle, a box or a star, not always simple."""
    kind = draw.random()
    if kind < 0.4:
        x, y, w, h = (draw.randrange(size) for _ in range(4))
        points = [(x, y), (x + w + 1, y), (x + w + 1, y + h + 1), (x, y + h + 1)]
    else:
        points = [(draw.randrange(size), draw.randrange(size)) for _ in range(3 if kind < 0.8 else 5)]
    return [*points, points[0]]


@pytest.mark.parametrize("seed", range(25))
def test_faces_cover_and_are_disjoint(seed):
    draw = random.Random(seed)
    size = draw.choice([8, 1000, 1_000_000])
    rings = [ring(draw, size) for _ in range(draw.randrange(1, 9))]
    sides = exact.noded(exact.sides_of(rings))
    found = exact.faces(sides)
    for _ in range(60):
        p = (draw.uniform(0, 2 * size), draw.uniform(0, 2 * size))
        holders = [f for f in found if exact.inside(p, f)]
        assert len(holders) <= 1
        if size > 8 and any(exact.inside(p, [r]) for r in rings):
            assert holders  # but for the rounding of crossings, which is far finer than these points lie apart
    for f in found:
        assert exact.area2(f[0]) > 0 and all(exact.area2(h) < 0 for h in f[1:])
        assert exact.inside(regions.inner_point(f), f)


@pytest.mark.parametrize("seed", range(15))
def test_repair_keeps_what_odd_rings_enclose(seed):
    draw = random.Random(seed)
    size = 1_000_000
    rings = [ring(draw, size) for _ in range(draw.randrange(1, 5))]
    out = exact.repaired([rings], 0)
    sample = [(draw.uniform(0, 2 * size), draw.uniform(0, 2 * size)) for _ in range(200)]
    assert all(sum(exact.inside(p, [r]) for r in rings) % 2 == sum(exact.inside(p, f) for f in out) for p in sample)
    assert exact.noded(exact.sides_of([r for f in out for r in f])) == exact.sides_of([r for f in out for r in f])


def test_known_shapes():
    bow = [[(0, 0), (10, 10), (10, 0), (0, 10), (0, 0)]]
    assert sorted(sum(map(exact.area2, p)) / 2 for p in exact.repaired([bow], 0)) == [25, 25]
    assert exact.repaired([bow]) == [] and exact.repaired([]) == [] and exact.repaired([[]], 0) == []
    frame = [(0, 0), (9, 0), (9, 9), (0, 9), (0, 0)]
    hole = [(3, 3), (6, 3), (6, 6), (3, 6), (3, 3)]
    found = exact.faces(exact.noded(exact.sides_of([frame, hole, [(20, 20), (25, 20)]])))
    assert sorted(len(f) for f in found) == [1, 2] and sorted(sum(map(exact.area2, f)) / 2 for f in found) == [9, 72]
    assert [sum(map(exact.area2, f)) / 2 for f in exact.dissolved(found)] == [81]
    ends = exact.faces({((0, 0), (1, 0)), ((0, 0), (0, 1)), ((0, 1), (1, 0)), ((1, 0), (5, 0)), ((5, 0), (6, 0)), ((5, 0), (5, 1)), ((5, 1), (6, 0))})
    assert len(ends) == 2  # the bridge between the triangles is no part of either


def test_district(spark):
    """Overlapping squares: a route counts once where several reach, and equal neighbours become one region."""
    square = lambda x, y, s: [[[(float(a), float(b)) for a, b in ((x, y), (x + s, y), (x + s, y + s), (x, y + s), (x, y))]]]
    areas = spark.createDataFrame([("d", "A", square(0, 0, 100)), ("d", "B", square(50, 0, 100)), ("e", "C", square(0, 0, 10)), ("e", "D", None)], f"district string, id string, polygons {regions.POLYGONS}")
    counts = spark.createDataFrame([("A", "10", 5), ("A", "M1", 2), ("B", "10", 8), ("C", "M1", 1)], "stop_id string, route_id string, n long")
    pieces = exact.frequency(exact.subdivide(areas), counts)
    got = {tuple(r.ids): (r.deduped_trips, r.unique_routes, r.area) for r in pieces.select("ids", "deduped_trips", "unique_routes", regions.area(F.col("polygons")).alias("area")).collect()}
    assert got == {("A",): (7, 2, 5000.0), ("A", "B"): (10, 2, 5000.0), ("B",): (8, 1, 5000.0), ("C",): (1, 1, 100.0)}
    same = exact.dissolve(pieces.withColumn("deduped_trips", F.lit(3).cast("long"))).collect()
    assert sorted((r.district, r.area_ha, len(r.polygons[0])) for r in same) == [("d", 1.5, 1), ("e", 0.01, 1)]
    fixed = exact.repair(areas.select("id", "polygons")).select("id", regions.area(F.col("polygons")).alias("area")).collect()
    assert {r.id: r.area for r in fixed} == {"A": 10_000.0, "B": 10_000.0, "C": 100.0}
