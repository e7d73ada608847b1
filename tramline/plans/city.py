"""The stages of a city: feed to stop counts, stops to walking areas, areas to coverage. All lazy but for loop ends."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.cities import City
from tramline.functions import geo
from tramline.operators import calendar, components, coverage, feeds, network, osm, regions, spatial, timetable
from tramline.plans.lineage import cut


MINUTES = 5


def ingest(city: City, *sources: feeds.Feed) -> feeds.Feed:
    """The city's feed from its source feeds, merged by its rule."""
    return feeds.MERGES[city.merge](*sources)


def ingest_merged(feed: feeds.Feed) -> feeds.Feed:
    """A feed that was merged already, its calendars made effective."""
    return feeds.merge_single(feed)


def best_date(feed: feeds.Feed) -> int:
    """The date with most services, the earliest among equals."""
    return calendar.busiest(feed["calendar_dates"], 1).first()["date"]


def route_counts(city: City, feed: feeds.Feed, date: int | None = None) -> DataFrame:
    return timetable.departure_counts(feed, date or best_date(feed), city.classify, city.frequencies)


def stop_counts(city: City, feed: feeds.Feed, date: int | None = None) -> DataFrame:
    """Stops with their figures for a date."""
    return timetable.stops_with_service(feed["stops"], route_counts(city, feed, date))


def walking_graph(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The largest connected part of a graph."""
    ends = edges.select(F.col("src").alias("a"), F.col("dst").alias("b"))
    keep = cut(components.largest(nodes.select(F.col("node_id").alias("v")), ends))
    nodes = nodes.join(keep.withColumnRenamed("v", "node_id"), "node_id", "left_semi")
    return nodes, edges.join(keep.withColumnRenamed("v", "src"), "src", "left_semi").select("src", "dst", "length")


def walking_segments(city: City, stops: DataFrame, nodes: DataFrame, edges: DataFrame, radius: float = network.WALK) -> DataFrame:
    """stop_id, ax, ay, bx, by: the walkable segments of each stop in metres; their BUFFER is the stop's area."""
    seeds = spatial.nearest_node(stops, nodes, city.crs)
    reached = network.reach(seeds.select("stop_id", "node_id"), edges, radius)
    e, n = geo.project(F.col("x"), F.col("y"), city.crs)
    at = nodes.select("node_id", (geo.centimetres(e) / 100).alias("px"), (geo.centimetres(n) / 100).alias("py"))
    rows = network.reached_edges(reached, edges).join(at.select(F.col("node_id").alias("src"), F.col("px").alias("ax"), F.col("py").alias("ay")), "src")
    return rows.join(at.select(F.col("node_id").alias("dst"), F.col("px").alias("bx"), F.col("py").alias("by")), "dst").select("stop_id", "ax", "ay", "bx", "by")


def coverage_map(segments: DataFrame, counts: DataFrame, size: float = coverage.CELL, first_of_value: bool = True) -> DataFrame:
    """Regions of equal frequency with their polygons in metres, largest frequency first."""
    freq = coverage.frequency(coverage.cells(segments, size), counts)
    return coverage.outlined(coverage.labelled(freq), size, first_of_value).orderBy(F.desc("deduped_trips"), "part")


def isochrones(segments: DataFrame, stops: DataFrame, size: float = coverage.CELL) -> DataFrame:
    """The walking areas of stops (with their figures) as polygons in metres, with the walk's minutes and metres."""
    areas = coverage.stop_areas(coverage.cells(segments, size), size)
    rows = stops.join(areas, "stop_id").withColumns({"time_minutes": F.lit(MINUTES), "distance_m": F.lit(network.WALK)})
    return rows.select("stop_id", "stop_name", "trip_count", "unique_routes", "route_ids", "route_trip_counts", "bus", "tram", "train", "metro", "time_minutes", "distance_m", "area_ha", "polygons")


def sample(stops: DataFrame, n: int) -> DataFrame:
    """The first n stops by identifier."""
    return stops.orderBy("stop_id").limit(n)


def extent(spark: SparkSession, city: City) -> tuple[float, float, float, float]:
    """xmin, xmax, ymin, ymax of the city's picture: its own, or its bounds with PAD around."""
    if city.extent:
        return city.extent
    south, west, north, east = city.bbox
    (x1, y1), (x2, y2) = geo.project(F.lit(west), F.lit(south), city.crs), geo.project(F.lit(east), F.lit(north), city.crs)
    return tuple(spark.range(1).select(x1 - spatial.PAD, x2 + spatial.PAD, y1 - spatial.PAD, y2 + spatial.PAD).first())


def basemap(elements: DataFrame, city: City, name: str) -> DataFrame:
    """A layer of map elements: its columns and its shapes in metres (polygons, lines); areas and lines of buildings and
    roads with what is drawn of them."""
    chosen = osm.layer(elements, name)
    names = list(osm.COLUMNS.get(name, ("name", "building", "building:levels", "addr:housenumber", "addr:street") if name == "buildings" else ("name",)))
    tags = osm.project_tags(chosen, names)
    tags = osm.buildings(tags) if name == "buildings" else osm.roads(tags) if name == "roads" else tags
    shapes = osm.geometries(chosen).dropDuplicates(["osm_id", "osm_type"])
    shapes = osm.only_polygons(shapes) if name == "buildings" else shapes
    point = lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))
    polygons = regions.to_metres(F.transform("polygons", lambda polygon: F.transform(polygon, lambda ring: F.transform(ring, point))), city.crs)
    metres = lambda p: F.struct(*[c.alias(n) for c, n in zip(geo.project(p[0], p[1], city.crs), ("x", "y"), strict=True)])
    lines = F.transform("lines", lambda line: F.transform(line, metres))
    return tags.dropDuplicates(["osm_id", "osm_type"]).join(shapes.select("osm_id", "osm_type", "kind", polygons.alias("polygons"), lines.alias("lines")), ["osm_id", "osm_type"])
