import pytest

from tramline.sources import files, shapefile

SQUARE = [[(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (0.0, 0.0)], [(0.2, 0.2), (0.4, 0.2), (0.4, 0.4), (0.2, 0.2)]]


@pytest.mark.parametrize(("kind", "parts"), [("Polygon", SQUARE), ("LineString", SQUARE[:1]), ("Point", [[(20.5, 52.25)]])])
def test_round_trip(spark, tmp_path, kind, parts):
    rows = [(parts, {"name": "Łódź", "trips": "7"}), (parts, {"name": None, "trips": "12"})]
    for suffix, content in shapefile.write_shapefile(kind, rows).items():
        files.write_bytes(f"file://{tmp_path}/map.{suffix}", content)
    got = shapefile.read_shapefile(spark, f"file://{tmp_path}/map.shp").orderBy("record").collect()
    assert [(r.kind, r.properties) for r in got] == [(kind, p) for _, p in rows]
    assert [[[tuple(p) for p in part] for part in r.parts] for r in got] == [parts, parts]


def test_no_rows():
    out = shapefile.write_shapefile("Point", [])
    assert len(out["shp"]) == 100 and list(shapefile.shapes(out["shp"])) == [] and list(shapefile.attributes(out["dbf"])) == []


def test_what_does_not_fit_is_an_error():
    point = [[(20.5, 52.25)]]
    out = shapefile.write_shapefile("Point", [(point, {"n" * 10: "x" * 254})])
    assert list(shapefile.attributes(out["dbf"])) == [{"n" * 10: "x" * 254}]
    for properties in ({"route_ids": "Łódź" * 37}, {"route_trip_counts": "1"}):
        with pytest.raises(ValueError, match="route_"):
            shapefile.write_shapefile("Point", [(point, properties)])
