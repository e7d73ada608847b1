"""Files in and out, a whole small city from CSV and GraphML to coverage, and resumable runs."""

import zipfile

import pytest

from tramline import cities
from tramline.__main__ import main
from tramline.plans import city as plans
from tramline.sources import files
from tramline.streaming import resume

FEED = {
    "stops": "﻿stop_id,stop_name,stop_lat,stop_lon\n1,A,52.2000,20.9000\n2,B,52.2000,20.9044\n3,C,52.2500,20.9500\n",
    "trips": "trip_id,route_id,service_id\n10,10,x\n11,M1,x\n12,10,y\n",
    "routes": "route_id,route_type\n10,0\n",
    "stop_times": "trip_id,stop_id,arrival_time\n10,1,06:00:00\n10,2,06:05:00\n11,2,30:00:00\n11,1,bad\n12,1,07:00:00\n",
    "calendar": "service_id,monday,tuesday,wednesday,thursday,friday,saturday,sunday,start_date,end_date\nx,1,1,0,0,0,0,0,20260803,20260804\ny,0,1,0,0,0,0,0,20260803,20260804\n",
}
GRAPH = """<?xml version='1.0' encoding='utf-8'?><graphml><key id="d0" for="node" attr.name="x" attr.type="string"/><key id="d1" for="node" attr.name="y" attr.type="string"/>
<key id="d2" for="edge" attr.name="length" attr.type="string"/><graph edgedefault="directed">%s</graph></graphml>"""


@pytest.fixture
def folder(tmp_path):
    for day in ("2026_08_01", "2026_08_03"):
        (tmp_path / "data" / day).mkdir(parents=True)
        for name, text in FEED.items():
            (tmp_path / "data" / day / f"{name}.txt").write_text(text)
    (tmp_path / "data" / "2026_08_09").mkdir()
    nodes = "".join(f'<node id="{k}"><data key="d0">{20.9 + k * 0.00146}</data><data key="d1">52.2</data></node>' for k in range(5))
    nodes += '<node id="9"><data key="d0">21.0</data><data key="d1">52.3</data></node>'
    edges = "".join(f'<edge source="{a}" target="{b}"><data key="d2">100.0</data></edge>' for k in range(4) for a, b in ((k, k + 1), (k + 1, k)))
    (tmp_path / "graph.graphml").write_text(GRAPH % (nodes + edges))
    return tmp_path


def test_city_from_files(spark, folder):
    at = files.latest_snapshot(spark, f"file://{folder}/data")
    assert at.endswith("2026_08_03")
    with pytest.raises(FileNotFoundError, match="isochrones"):
        files.latest_snapshot(spark, f"file://{folder}/data", "isochrones.gpkg")
    feed = files.read_feed(spark, at)
    assert "frequencies" not in feed and feed["stops"].columns[0] == "stop_id" and dict(feed["stops"].dtypes)["stop_lat"] == "double"
    city = cities.get_city("poznan")
    feed = plans.ingest(city, feed)
    assert plans.best_date(feed) == 20260804
    got = {r.stop_id: r for r in plans.stop_counts(city, feed, 20260803).collect()}
    assert {k: (r.tram, r.bus, r.trip_count, r.route_trip_counts) for k, r in got.items()} == {"1": (1, 0, 1, "10:1"), "2": (1, 1, 2, "10:1,M1:1")}
    nodes, edges = plans.walking_graph(*files.read_graph(spark, f"file://{folder}/graph.graphml"))
    assert nodes.count() == 5 and edges.count() == 8
    stops = feed["stops"]
    segments = plans.walking_segments(city, stops, nodes, edges)
    assert {r.stop_id for r in segments.collect()} == {"1", "2"}
    parts = plans.coverage_map(segments, plans.route_counts(city, feed, 20260804)).collect()
    assert [r.deduped_trips for r in parts] == sorted((r.deduped_trips for r in parts), reverse=True)
    assert max(r.deduped_trips for r in parts) == 3


def test_zip_and_csv(spark, folder, tmp_path):
    with zipfile.ZipFile(tmp_path / "feed.zip", "w") as z:
        for name, text in FEED.items():
            z.writestr(f"inner/{name}.txt", text)
    assert files.unzip(spark, f"file://{tmp_path}/feed.zip", f"file://{tmp_path}/out").count() == 5
    feed = files.read_feed(spark, f"file://{tmp_path}/out/feed")
    files.write_csv(feed["trips"], f"file://{tmp_path}/trips")
    assert spark.read.csv(f"file://{tmp_path}/trips", header=True).count() == 3
    assert files.write_once(feed["trips"], f"file://{tmp_path}/once") and not files.write_once(feed["trips"], f"file://{tmp_path}/once")
    row = files.geojson_features(feed["stops"], "stop_lon", "stop_lat", ["stop_id"]).first()
    assert row.feature == '{"type":"Feature","geometry":{"type":"Point","coordinates":[20.9,52.2]},"properties":{"stop_id":"1"}}'


def test_geopackage_round_trip(spark, tmp_path):
    wkb = files.polygon_wkb([[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]])
    files.write_bytes(f"file://{tmp_path}/map.gpkg", files.geopackage("coverage", [{"geom": wkb, "deduped_trips": 7}, {"geom": None, "deduped_trips": None}]))
    got = files.read_geopackage(spark, f"file://{tmp_path}/map.gpkg", "coverage").orderBy("fid").collect()
    assert [(r.fid, r.properties["deduped_trips"], r.wkb) for r in got] == [(1, "7", bytearray(wkb)), (2, None, None)]
    assert files.read_geopackage(spark, f"file://{tmp_path}/map.gpkg", "other").count() == 0


def test_resumable_run(spark, tmp_path):
    source, target, at = (f"file://{tmp_path}/{x}" for x in ("in", "out", "at"))
    spark.range(5).write.parquet(source)
    assert resume.run_available(spark, source, "id long", target, at) == 5
    assert resume.run_available(spark, source, "id long", target, at) == 0
    spark.range(5, 8).write.mode("append").parquet(source)
    assert resume.run_available(spark, source, "id long", target, at) == 3
    assert spark.read.parquet(target).count() == 8


def test_command_line(spark, folder, tmp_path, capsys):
    assert main(["cities"]) == 0 and "berlin\tBerlin" in capsys.readouterr().out
    assert main(["styles", str(tmp_path / "styles")]) == 0 and (tmp_path / "styles/roads.qml").exists()
    assert main(["trips", "--city", "poznan", f"file://{folder}/data", "--date", "20260803", "--out", f"file://{tmp_path}/counts"]) == 0
    assert spark.read.csv(f"file://{tmp_path}/counts", header=True).count() == 2
    graph = ["--graph", f"file://{folder}/graph.graphml"]
    assert main(["isochrones", "--city", "poznan", f"{folder}/data", "--out", f"{tmp_path}/stops.gpkg", "--sample", "1", *graph]) == 0
    got = files.read_geopackage(spark, f"file://{tmp_path}/stops.gpkg", "isochrones").collect()
    assert [(r.properties["stop_id"], r.properties["time_minutes"]) for r in got] == [("1", "5")] and 20.8 < got[0].xmin < 20.95 and 52.1 < got[0].ymin < 52.3
    assert main(["network", "--city", "poznan", f"{folder}/graph.graphml", "--out", f"{tmp_path}/walk"]) == 0
    assert main(["coverage", "--city", "poznan", f"{folder}/data", "--date", "20260804", "--out", f"{tmp_path}/map.gpkg", "--graph", f"{tmp_path}/walk"]) == 0
    got = files.read_geopackage(spark, f"file://{tmp_path}/map.gpkg", "coverage_map").collect()
    assert max(int(r.properties["deduped_trips"]) for r in got) == 3
    (tmp_path / "map.json").write_text('{"elements": [{"type": "way", "id": 1, "tags": {"highway": "primary"}, "geometry": [{"lat": 52.2, "lon": 20.7}, {"lat": 52.3, "lon": 20.9}]}]}')
    assert main(["basemap", "--city", "poznan", f"{tmp_path}/map.json", "--out", f"{tmp_path}/layers"]) == 0
    assert spark.read.parquet(f"file://{tmp_path}/layers/roads").select("osm_id", "major", "kind").collect() == [(1, True, "LineString")]
    assert main(["render", "--city", "poznan", f"{tmp_path}/map.gpkg", "--basemap", f"{tmp_path}/layers", "--out", f"{tmp_path}/map.png", "--width", "60"]) == 0
    assert (tmp_path / "map.png").read_bytes().startswith(b"\x89PNG")


def test_merge_command(spark, folder, tmp_path):
    assert main(["merge", "--city", "krakow", f"{folder}/data", f"{folder}/data", "--out", f"{tmp_path}/both"]) == 0
    feed = files.read_feed(spark, f"file://{tmp_path}/both")
    assert {r.trip_id for r in feed["trips"].collect()} == {"10", "11", "12", "tram_10", "tram_11", "tram_12"}
    assert {r.service_id for r in feed["calendar_dates"].collect()} == {"x", "y", "tram_x", "tram_y"}
