"""Scalar functions, table by table."""

import math

import pytest
from pyspark.sql import functions as F

from tramline import cities
from tramline.functions import classes, geo, gtfs_time, vehicles


def values(spark, column, cases, kind="string"):
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(cases)], f"k int, v {kind}")
    return [r[1] for r in rows.select("k", column(F.col("v")).alias("x")).orderBy("k").collect()]


def test_clock_seconds(spark):
    cases = ["06:00:00", "30:10:00", "25:00:00", "9:05:07", "10:60:00", "10:00:60", "bad", None, "10:00", "", "10:00:00:00", "-1:00:00"]
    assert values(spark, gtfs_time.clock_seconds, cases) == [21600, 22200, 3600, 32707, None, None, None, None, None, None, 36000, 82800]


def test_one_day_back_takes_24_hours_once(spark):
    assert values(spark, gtfs_time.one_day_back, ["24:10:00", "5:00:00", "49:00:00"]) == ["00:10:00", "05:00:00", "25:00:00"]


def test_clock_text(spark):
    assert values(spark, gtfs_time.clock_text, [0, 86399, 90061, None], "int")[:3] == ["00:00:00", "23:59:59", "25:01:01"]


@pytest.mark.parametrize(("start", "end", "headway", "n"), [(18000, 25200, 600, 6), (21600, 22500, 600, 2), (80000, 90000, 60, 0), (21600, 22500, 0, None), (21600, 23100, 1000, 2)])
def test_headway_trips_round_half_to_even(spark, start, end, headway, n):
    assert spark.range(1).select(gtfs_time.headway_trips(F.lit(start), F.lit(end), F.lit(headway))).first()[0] == n


def test_city_rules(spark):
    cases = ["M1", "M", "9", "123", "1234", "S2", "R7", "KM_R1", "KM_R1_BUS", "wkd_1", "wkd_bus_1", " 17 ", "L3", None]
    assert values(spark, vehicles.warsaw, cases)[:-1] == ["metro", "bus", "tram", "bus", "bus", "train", "train", "train", "bus", "train", "bus", "tram", "bus"]
    assert values(spark, vehicles.poznan, ["99", "100", "kw5", "s1", "007"]) == ["tram", "bus", "train", "train", "tram"]
    assert values(spark, vehicles.gdansk, ["PKM1", "skm", "N1"]) == ["train", "train", "bus"]
    assert values(spark, vehicles.berlin, ["U6", "S41", "M10", "s1", "62", "162", "M"]) == ["metro", "train", "tram", "bus", "tram", "bus", "bus"]


def test_route_type_lookup(spark):
    assert values(spark, vehicles.by_route_type, ["0", " 1 ", "4", "700", "12", None]) == ["tram", "metro", None, None, "train", None]


def test_vehicle_by_trip_id(spark):
    cases = ["x/17/1", "x/523/1", "x/L-3/1", "x/S40/1", "x/N83/1", "x"]
    assert values(spark, vehicles.by_trip_id, cases) == ["tram", "bus", "bus", "train", "night_bus", "Unknown"]


def test_frequency_class_bounds(spark):
    assert values(spark, classes.frequency_class, [0, 1, 9, 10, 3499, 3500, 10**6], "long") == [0, 0, 0, 1, 16, 17, 17]
    assert values(spark, classes.class_label, [0, 17], "int") == ["1 - 10", "3500+"]


def test_route_counts(spark):
    got = values(spark, classes.route_counts, ["a:b:3,c:2", "x:1,x:9", "bad,ok:5,n:z", "", None])
    assert [[tuple(r) for r in x] for x in got] == [[("a:b", 3), ("c", 2)], [("x", 9)], [("ok", 5)], [], []]


def test_road_rank_and_levels(spark):
    assert values(spark, classes.road_rank, ["motorway", "trunk_link", "track", None]) == [1, 2, 99, 99]
    assert values(spark, classes.building_levels, ["3", "many", None, "2.5"]) == [3.0, 2.0, 2.0, 2.5]


def test_projection_known_corners(spark):
    def at(lon, lat, crs):
        e, n = geo.project(F.lit(lon), F.lit(lat), crs)
        return spark.range(1).select(e, n).first()

    e, n = at(16.73, 52.30, "EPSG:2180")
    assert (round(e, 1), round(n, 1)) == (345263.8, 495092.8)
    e, n = at(13.09, 52.34, "EPSG:25833")
    assert (round(e, 1), round(n, 1)) == (369879.3, 5800572.3)


def test_segment_distance_and_area(spark):
    d = geo.segment_distance2(*[F.lit(float(x)) for x in (5, 3, 0, 0, 10, 0)])
    p = geo.segment_distance2(*[F.lit(float(x)) for x in (3, 4, 0, 0, 0, 0)])
    assert tuple(spark.range(1).select(d, p).first()) == (9.0, 25.0)
    ring = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((0, 0), (4, 0), (4, 3), (0, 3), (0, 0))])
    assert spark.range(1).select(geo.ring_area(ring)).first()[0] == 12.0


def test_web_mercator_equator(spark):
    e, n = geo.web_mercator(F.lit(180.0), F.lit(0.0))
    row = spark.range(1).select(e, n).first()
    assert math.isclose(row[0], 20037508.342789244) and abs(row[1]) < 1e-6


def test_city_records():
    assert cities.get_city(" Warsaw ").name == "Warszawa"
    assert [k for k, _ in cities.list_cities()] == ["warsaw", "poznan", "krakow", "gdansk", "berlin"]
    with pytest.raises(KeyError, match="berlin"):
        cities.get_city("nowhere")
