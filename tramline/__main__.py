"""python -m tramline: the stages of a city from the command line, and its styles."""

from __future__ import annotations

import argparse
import os

from tramline import cities

STAGES = {
    "dates": "dates with most services of a feed",
    "merge": "the city's feed from its source feeds, as files",
    "trips": "departures by stop",
    "network": "the largest connected part of a walking network, as Parquet",
    "isochrones": "walking areas of the stops, as a GeoPackage",
    "coverage": "regions of equal frequency, as a GeoPackage",
    "basemap": "layers of map elements, as Parquet",
    "render": "a picture of the coverage and of basemap layers",
}


def uri(path: str) -> str:
    return path if "://" in path else "file://" + os.path.abspath(path)


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="tramline", description=__doc__)
    sub = out.add_subparsers(dest="command", required=True)
    sub.add_parser("cities", help="the supported cities")
    for name, text in STAGES.items():
        p = cities.add_city_argument(sub.add_parser(name, help=text))
        if name in ("network", "basemap"):
            p.add_argument("source", help="GraphML file" if name == "network" else "JSON files of map elements")
        elif name == "render":
            p.add_argument("source", help="GeoPackage of the coverage")
            p.add_argument("--basemap", help="folder of basemap layers")
            p.add_argument("--width", type=int, default=2000, help="pixels")
        else:
            p.add_argument("folders", nargs="+", help="folder with the timetable files, or of dated folders of them; one for each source feed, in the order of the city's merge rule")
        if name in ("trips", "isochrones", "coverage"):
            p.add_argument("--date", type=int, help="service day as YYYYMMDD; the one with most services if left out")
        if name in ("isochrones", "coverage"):
            p.add_argument("--graph", required=True, help="GraphML file of the walking network, or the folder that network wrote")
            p.add_argument("--sample", type=int, help="only so many stops, the first by identifier")
        if name != "dates":
            p.add_argument("--out", required=True, help="where the result goes")
    sub.add_parser("styles", help="style files of all layers").add_argument("out")
    return out


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    if args.command == "cities":
        for key, name in cities.list_cities():
            print(f"{key}\t{name}")
        return 0
    from tramline.sources import files

    if args.command == "styles":
        from tramline.operators import styles

        for name, text in styles.documents().items():
            files.write_bytes(f"{uri(args.out).rstrip('/')}/{name}.qml", text.encode())
        return 0
    from pyspark.sql import SparkSession

    from tramline.plans import lineage

    spark = SparkSession.builder.appName("tramline").getOrCreate()
    try:
        run(spark, cities.get_city(args.city), args, files)
    finally:
        lineage.clean(spark)
    return 0


def run(spark, city: cities.City, args: argparse.Namespace, files) -> None:
    from pyspark.sql import functions as F

    from tramline.operators import calendar, osm, regions, timetable
    from tramline.plans import city as plans
    from tramline.plans import picture
    from tramline.plans.lineage import cut

    degrees = lambda df: df.withColumn("polygons", regions.to_degrees(F.col("polygons"), city.crs))
    if args.command == "network":
        files.write_graph(*plans.walking_graph(*files.read_graph(spark, uri(args.source))), uri(args.out))
        return
    if args.command == "basemap":
        elements = osm.read_elements(spark, uri(args.source))
        for name in (*osm.LAYERS, "buildings"):
            plans.basemap(elements, city, name).write.mode("overwrite").parquet(f"{uri(args.out).rstrip('/')}/{name}")
        return
    if args.command == "render":
        shapes = regions.of_geopackage(files.read_geopackage(spark, uri(args.source)))
        layers = {"coverage": shapes.withColumn("polygons", regions.to_metres(F.col("polygons"), city.crs))}
        for name in (*osm.LAYERS, "buildings") if args.basemap else ():
            rows = spark.read.parquet(f"{uri(args.basemap).rstrip('/')}/{name}")
            if name == "roads":
                layers |= {"roads": rows.filter("NOT major"), "major_roads": rows.filter("major")}
            elif name in picture.ORDER:
                layers[name] = osm.heavy_rail(rows) if name == "railways" else rows
        frame = picture.Frame(*plans.extent(spark, city), args.width)
        files.write_bytes(uri(args.out), picture.png(picture.draw(frame, layers)))
        return
    folders = [f if files.exists(spark, f"{f}/stops.txt") else files.latest_snapshot(spark, f) for f in map(uri, args.folders)]
    sources = [files.read_feed(spark, f) for f in folders]
    feed = plans.ingest(city, *sources) if len(sources) > 1 or city.merge == "single" else plans.ingest_merged(sources[0])
    if args.command == "dates":
        calendar.extent(feed["calendar_dates"]).show()
        calendar.busiest(feed["calendar_dates"], 10).show()
    elif args.command == "merge":
        for name, rows in feed.items():
            files.write_csv(rows, f"{uri(args.out).rstrip('/')}/{name}.txt")
    elif args.command == "trips":
        files.write_csv(plans.stop_counts(city, feed, args.date), uri(args.out))
    else:
        counts = cut(plans.route_counts(city, feed, args.date))
        stops = timetable.stops_with_service(feed["stops"], counts)
        stops = cut(plans.sample(stops, args.sample) if args.sample else stops)
        graph = files.load_graph(spark, uri(args.graph)) or plans.walking_graph(*files.read_graph(spark, uri(args.graph)))
        segments = plans.walking_segments(city, stops, *graph)
        if args.command == "isochrones":
            files.write_geopackage(degrees(plans.isochrones(segments, stops)), uri(args.out), "isochrones")
        else:
            files.write_geopackage(degrees(plans.coverage_map(segments, counts)), uri(args.out), "coverage_map")


if __name__ == "__main__":
    raise SystemExit(main())
