"""The registered queries: each operator over the timetable-shaped views of the star-schema tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline import cities
from tramline.functions import classes, geo, gtfs_time, vehicles
from tramline.operators import calendar, components, coverage, exact, feeds, network, osm, regions, spatial, styles, timetable
from tramline.plans.lineage import cut
from tramline.sources.fixtures import spark_view
from tramline.streaming import resume

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
DATE, CRS, CELL = 20260803, "EPSG:2180", 25.0


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def views(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [spark_view(spark, sf_dir, n) for n in names]


def feed(spark: SparkSession, sf_dir: str) -> feeds.Feed:
    names = {"trips": "f_trips", "stop_times": "f_stop_times", "stops": "f_stops", "routes": "f_routes", "agency": "f_agency", "calendar_dates": "f_calendar_dates"}
    return {k: spark_view(spark, sf_dir, v) for k, v in names.items()}


# ---- service days


@query
def active_services(spark, sf_dir):
    return calendar.active(spark_view(spark, sf_dir, "f_calendar_dates"), DATE)


@query
def service_days_topk(spark, sf_dir):
    return calendar.busiest(spark_view(spark, sf_dir, "f_calendar_dates"), 10)


@query
def best_service_day(spark, sf_dir):
    return calendar.busiest(spark_view(spark, sf_dir, "f_calendar_dates"), 1).select("date", "services")


@query
def service_day_extent(spark, sf_dir):
    return calendar.extent(spark_view(spark, sf_dir, "f_calendar_dates"))


@query
def calendar_expand(spark, sf_dir):
    return calendar.expand(spark_view(spark, sf_dir, "f_calendar"))


@query
def calendar_effective(spark, sf_dir):
    return calendar.effective(*views(spark, sf_dir, "f_calendar", "f_exceptions"))


# ---- feeds


@query
def feed_prefix_union(spark, sf_dir):
    base, more = views(spark, sf_dir, "f_trips", "f_freq_trips")
    return feeds.append(base, feeds.prefix(more.withColumn("shape_id", F.lit("s")), ("trip_id", "service_id"), "tram_"))


@query
def feed_extract_operator(spark, sf_dir):
    out = feeds.extract_operator(feed(spark, sf_dir), "asia", "km_")
    return out["stop_times"].join(out["trips"], "trip_id").select("trip_id", "stop_id", "stop_sequence", "route_id", "service_id")


@query
def rail_prefix_routes(spark, sf_dir):
    return feeds.prefix_by_rail(*views(spark, sf_dir, "f_trips", "f_routes"))


@query
def merge_two_modes(spark, sf_dir):
    bus = feed(spark, sf_dir)
    tram = {"trips": spark_view(spark, sf_dir, "f_freq_trips"), "routes": bus["routes"], "calendar_dates": bus["calendar_dates"]}
    out = feeds.merge_two_modes({k: bus[k] for k in ("trips", "routes", "calendar_dates")}, tram)
    return out["trips"].join(out["calendar_dates"], "service_id").groupBy("route_id", "date").agg(F.count(F.lit(1)).alias("trips"))


# ---- trips and departures


@query
def trips_substring_semi(spark, sf_dir):
    trips, dates = views(spark, sf_dir, "f_trips", "f_calendar_dates")
    return timetable.trips_of_services(trips, calendar.active(dates, DATE))


@query
def stop_times_routed(spark, sf_dir):
    trips, dates, times = views(spark, sf_dir, "f_trips", "f_calendar_dates", "f_stop_times")
    rows = timetable.with_routes(times, timetable.trips_of_services(trips, calendar.active(dates, DATE)))
    return rows.select("trip_id", "stop_id", "stop_sequence", "arrival_time", "route_id")


@query
def gtfs_time_window(spark, sf_dir):
    return timetable.in_window(spark_view(spark, sf_dir, "f_stop_times"))


@query
def time_formats(spark, sf_dir):
    rows = spark_view(spark, sf_dir, "f_stop_times")
    t = F.col("arrival_time")
    found = F.filter(F.array(gtfs_time.elapsed_seconds(t)), lambda s: s.isNotNull())
    rows = rows.select("trip_id", "stop_id", "stop_sequence", gtfs_time.one_day_back(t).alias("adjusted"), F.explode(found).alias("elapsed"))
    return rows.withColumn("formatted", gtfs_time.clock_text(F.col("elapsed")))


@query
def frequency_expand(spark, sf_dir):
    frequencies, trips, times, dates = views(spark, sf_dir, "f_frequencies", "f_freq_trips", "f_freq_stop_times", "f_calendar_dates")
    return timetable.expand_frequencies(frequencies, trips, times, calendar.active(dates, DATE))


@query
def headway_counts(spark, sf_dir):
    return timetable.headway_totals(*views(spark, sf_dir, "f_frequencies", "f_freq_trips"))


@query
def calendar_inner(spark, sf_dir):
    trips, dates = views(spark, sf_dir, "f_trips", "f_calendar_dates")
    return trips.join(dates, "service_id").groupBy("route_id", "date").agg(F.count(F.lit(1)).alias("trips"))


@query
def stop_value_counts(spark, sf_dir):
    return spark_view(spark, sf_dir, "f_stop_times").groupBy("stop_id").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "stop_id")


@query
def vehicle_regex(spark, sf_dir):
    return spark_view(spark, sf_dir, "f_trip_names").select("trip_id", vehicles.by_trip_id(F.col("trip_id")).alias("vehicle"), F.split_part("trip_id", F.lit("/"), F.lit(1)).alias("route"), F.split_part("trip_id", F.lit("/"), F.lit(2)).alias("line"))


def _vehicle_class(city: str) -> Query:
    def run(spark, sf_dir):
        rows = spark_view(spark, sf_dir, "f_route_names").distinct()
        return timetable.with_vehicle(rows, spark_view(spark, sf_dir, "f_routes"), cities.get_city(city).classify)

    return run


for _city in ("warsaw", "poznan", "krakow", "gdansk", "berlin"):
    QUERIES[f"vehicle_class_{_city}"] = _vehicle_class(_city)


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Departures of the service day by stop and route: scheduled ones and those of headway services."""
    f = feed(spark, sf_dir)
    f["frequencies"], f["freq_trips"], f["freq_stop_times"] = views(spark, sf_dir, "f_frequencies", "f_freq_trips", "f_freq_stop_times")
    return timetable.departure_counts(f, DATE, vehicles.warsaw)


@query
def route_kinds_last(spark, sf_dir):
    """Of routes that two feeds have, the later feed's row counts where its type is mapped."""
    first = spark_view(spark, sf_dir, "f_routes")
    later = first.filter("route_type <> '1'").withColumn("route_type", F.concat(F.lit(" "), ((F.col("route_type").cast("int") + 1) % 9).cast("string")))
    return timetable.route_kinds(first.unionByName(later)).select(F.col("_route").alias("route_id"), F.col("_kind").alias("vehicle"))


@query
def stop_vehicle_pivot(spark, sf_dir):
    return timetable.stop_counts(counts(spark, sf_dir)).select("stop_id", "bus", "tram", "train", "metro")


@query
def stop_route_lists(spark, sf_dir):
    return timetable.stop_counts(counts(spark, sf_dir)).select("stop_id", "unique_routes", "route_ids", "route_trip_counts")


@query
def stop_trip_counts(spark, sf_dir):
    return timetable.stops_with_service(spark_view(spark, sf_dir, "f_stops"), counts(spark, sf_dir))


@query
def network_totals(spark, sf_dir):
    rows = cut(counts(spark, sf_dir))  # read twice
    stops = timetable.totals(timetable.stops_with_service(spark_view(spark, sf_dir, "f_stops"), rows))
    return stops.withColumn("routes", rows.agg(F.countDistinct("route_id")).scalar())


# ---- geometry


@query
def project_tm(spark, sf_dir):
    out = []
    for crs in geo.SYSTEMS:
        e, n = geo.project(F.col("x"), F.col("y"), crs)
        out.append(spark_view(spark, sf_dir, "f_nodes").select(F.lit(crs).alias("crs"), "node_id", geo.centimetres(e).alias("e_cm"), geo.centimetres(n).alias("n_cm")))
    return out[0].unionByName(out[1])


@query
def web_mercator_frame(spark, sf_dir):
    e, n = geo.web_mercator(F.col("x"), F.col("y"))
    rows = spark_view(spark, sf_dir, "f_nodes").select(geo.centimetres(e).alias("e"), geo.centimetres(n).alias("n"))
    return rows.agg(F.min("e").alias("xmin"), F.max("e").alias("xmax"), F.min("n").alias("ymin"), F.max("n").alias("ymax"))


@query
def city_extents(spark, sf_dir):
    rows = spark.createDataFrame([(c.key, c.crs, *c.bbox) for c in cities.CITIES.values()], "city string, crs string, south double, west double, north double, east double")
    out = None
    for crs in geo.SYSTEMS:
        (x1, y1), (x2, y2) = geo.project(F.col("west"), F.col("south"), crs), geo.project(F.col("east"), F.col("north"), crs)
        part = rows.filter(F.col("crs") == crs).select("city", *[geo.centimetres(v).alias(k) for k, v in {"xmin": x1 - spatial.PAD, "xmax": x2 + spatial.PAD, "ymin": y1 - spatial.PAD, "ymax": y2 + spatial.PAD}.items()])
        out = part if out is None else out.unionByName(part)
    return out


@query
def nearest_node(spark, sf_dir):
    return spatial.nearest_node(*views(spark, sf_dir, "f_stops", "f_nodes"), CRS)


def reached(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network.reach(*views(spark, sf_dir, "f_stop_node", "f_edges"))


@query
def reachable_nodes(spark, sf_dir):
    return reached(spark, sf_dir)


@query
def isochrone_edges(spark, sf_dir):
    return network.reached_edges(reached(spark, sf_dir), spark_view(spark, sf_dir, "f_edges"))


def isochrones(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = spark_view(spark, sf_dir, "f_nodes_m")
    edges = network.reached_edges(reached(spark, sf_dir), spark_view(spark, sf_dir, "f_edges"))
    a, b = nodes.select(F.col("id").alias("src"), F.col("mx").alias("ax"), F.col("my").alias("ay")), nodes.select(F.col("id").alias("dst"), F.col("mx").alias("bx"), F.col("my").alias("by"))
    return coverage.cells(edges.join(a, "src").join(b, "dst").select("stop_id", "ax", "ay", "bx", "by"), CELL)


@query
def isochrone_cells(spark, sf_dir):
    return coverage.area(isochrones(spark, sf_dir), CELL)


def frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.frequency(isochrones(spark, sf_dir), counts(spark, sf_dir))


@query
def coverage_cells(spark, sf_dir):
    return frequencies(spark, sf_dir)


@query
def coverage_dissolve(spark, sf_dir):
    return coverage.dissolve(frequencies(spark, sf_dir), CELL)


@query
def coverage_classes(spark, sf_dir):
    return coverage.by_class(coverage.dissolve(frequencies(spark, sf_dir), CELL))


@query
def coverage_topk(spark, sf_dir):
    return coverage.top_frequencies(coverage.dissolve(frequencies(spark, sf_dir), CELL))


@query
def coverage_own_routes(spark, sf_dir):
    return coverage.dissolve(frequencies(spark, sf_dir), CELL, first_of_value=False)


@query
def coverage_summary(spark, sf_dir):
    return coverage.summary(coverage.dissolve(frequencies(spark, sf_dir), CELL))


@query
def coverage_rings(spark, sf_dir):
    """Rings, corners, length and area of the regions' polygons."""
    rows = coverage.outlined(coverage.labelled(frequencies(spark, sf_dir)), CELL)
    p = F.col("polygons")
    points = F.aggregate(F.transform(regions.rings(p), lambda r: F.size(r)), F.lit(0), lambda a, b: a + b)
    return rows.select("part", "deduped_trips", F.size(p).alias("polygons"), F.size(regions.rings(p)).alias("rings"), points.alias("points"), regions.length(p).alias("length"), regions.area(p).alias("area"))


@query
def exact_pieces(spark, sf_dir):
    """Pieces between the boundaries of overlapping squares, by how many squares hold them; a row of ten is a district."""
    x, y = F.col("x"), F.col("y")
    ring = geo.box_ring(x - 100, y - 100, x + 100, y + 100)
    areas = spark_view(spark, sf_dir, "f_cluster_pts").select(F.expr("id div 10").alias("district"), "id", F.array(F.array(ring)).alias("polygons"))
    pieces = exact.subdivide(areas).select("district", F.size("ids").alias("stops"), regions.area(F.col("polygons")).alias("area"))
    return pieces.groupBy("district", "stops").agg(F.count(F.lit(1)).alias("pieces"), F.round(F.sum("area")).cast("bigint").alias("area"))


@query
def stop_area_rings(spark, sf_dir):
    """Walking areas as polygons, in degrees and back, with their bounds in metres."""
    areas = coverage.stop_areas(isochrones(spark, sf_dir), CELL)
    shift = lambda by: lambda x, y: F.struct((x + by * 600_000).alias("x"), (y + by * 450_000).alias("y"))
    back = regions.every_point(regions.to_metres(regions.to_degrees(regions.every_point(F.col("polygons"), shift(1)), CRS), CRS), shift(-1))
    rows = regions.with_bounds(areas.withColumn("polygons", back))
    return rows.select("stop_id", "area_ha", F.round(regions.area(F.col("polygons"))).cast("bigint").alias("square_metres"), *[F.round(c).cast("bigint").alias(c) for c in ("xmin", "xmax", "ymin", "ymax")])


@query
def stop_clusters(spark, sf_dir):
    points = spark_view(spark, sf_dir, "f_cluster_pts")
    return components.cluster_totals(points.join(components.clusters(points, 150.0), "id"))


@query
def name_centroids(spark, sf_dir):
    points = spark_view(spark, sf_dir, "f_nodes_m").select((F.col("id") % 37).alias("name"), (F.col("id") % 3).alias("layer"), F.col("mx").alias("x"), F.col("my").alias("y"))
    return components.centroids(points, ["name", "layer"])


# ---- map layers


@query
def tile_grid(spark, sf_dir):
    city = cities.get_city("warsaw")
    return spatial.tiles(spark, *city.bbox)


@query
def tile_dedup(spark, sf_dir):
    rows = spark_view(spark, sf_dir, "f_osm").select("osm_id", "highway", F.col("seen").alias("tile"))
    return spatial.dedup_tiles(rows)


@query
def road_hierarchy(spark, sf_dir):
    return osm.roads(spark_view(spark, sf_dir, "f_osm")).groupBy("highway", "hierarchy", "major").agg(F.count(F.lit(1)).alias("n"))


@query
def building_levels(spark, sf_dir):
    rows = spark_view(spark, sf_dir, "f_osm").select("osm_id", F.lit("way").alias("osm_type"), "building", F.col("levels").alias("building:levels"))
    return osm.buildings(rows)


@query
def osm_tags(spark, sf_dir):
    rows = spark_view(spark, sf_dir, "f_rail").select("id", F.lit("way").alias("type"), F.from_json("props", "map<string,string>").alias("tags"))
    return osm.project_tags(rows, ["k", "name"])


@query
def osm_layers(spark, sf_dir):
    rows = spark_view(spark, sf_dir, "f_osm").select(F.col("seen").alias("id"), F.lit("way").alias("type"), F.map_filter(F.create_map(F.lit("highway"), "highway", F.lit("building"), "building"), lambda k, v: v.isNotNull()).alias("tags"))
    out = [osm.layer(rows, name).groupBy(F.lit(name).alias("layer")).agg(F.count(F.lit(1)).alias("n")) for name in ("roads", "buildings")]
    return out[0].unionByName(out[1])


@query
def railway_type(spark, sf_dir):
    kinds = ["tram_stop", "station", "stop", "halt", "light_rail"]
    rows = spark_view(spark, sf_dir, "f_rail")
    yes = lambda k: F.when(F.col("id") % k == 0, "yes")
    tags = F.create_map(F.lit("railway"), F.element_at(F.array(*map(F.lit, kinds)), (F.col("id") % 5 + 1).cast("int")), F.lit("subway"), yes(7), F.lit("tram"), yes(11), F.lit("light_rail"), yes(13), F.lit("train"), yes(3))
    return osm.rail_stops(rows.select("id", F.lit("node").alias("type"), tags.alias("tags"))).select("id", "railway", "time_limit")


@query
def parse_route_counts(spark, sf_dir):
    return spark_view(spark, sf_dir, "f_routecounts").select("id", F.explode(classes.route_counts(F.col("route_trip_counts"))).alias("x")).select("id", "x.route_id", "x.n")


@query
def qml_ranges(spark, sf_dir):
    return styles.range_elements(spark)


@query
def osm_rings(spark, sf_dir):
    """A square of side 0.001 degrees for each part, from four segments of which some are turned round; with a hole."""
    at = lambda dx, dy: F.struct((F.lit(52.0) + (F.col("p_partkey") % 100) * 0.01 + dy).alias("lat"), (F.lit(20.0) + F.floor(F.col("p_partkey") / 100) * 0.01 + dx).alias("lon"))
    corners = [at(0, 0), at(0.001, 0), at(0.001, 0.001), at(0, 0.001)]
    member = lambda role, *points: F.struct(F.lit("way").alias("type"), F.lit(role).alias("role"), F.array(*points).alias("geometry"))
    outer = [member("outer", corners[0], corners[1]), member("outer", corners[3], corners[2]), member("outer", corners[2], corners[1]), member("outer", corners[3], corners[0])]
    hole = member("inner", at(0.0002, 0.0002), at(0.0004, 0.0002), at(0.0004, 0.0004), at(0.0002, 0.0002))
    rows = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", F.lit("relation").alias("type"), F.col("p_partkey").alias("id"), F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lon"), F.array(*outer, hole).alias("members"))
    rows = rows.withColumn("geometry", F.lit(None).cast("array<struct<lat:double,lon:double>>"))
    shapes = osm.geometries(rows)
    rings = F.get("polygons", F.lit(0))
    return shapes.select("osm_id", "kind", F.size(rings).alias("rings"), F.size(F.get(rings, F.lit(0))).alias("outer_points"), F.size(F.get(rings, F.lit(1))).alias("hole_points"))


@query
def simplify(spark, sf_dir):
    """A zigzag of ten points a line, steps of ten metres, of an amplitude below or above the tolerance."""
    rows = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").alias("id"), F.transform(F.sequence(F.lit(0), F.lit(9)), lambda k: F.array(k * 10.0, F.when(k % 2 == 1, (F.col("p_size") % 11).cast("double")).otherwise(F.lit(0.0)))).alias("line"))
    return osm.simplify(rows).select("id", F.size("line").alias("points"))


@query
def osm_holes(spark, sf_dir):
    """Two outer squares for each part, and a hole in the second or, for every third part, in neither."""
    p = F.col("p_partkey")
    at = lambda dx, dy: F.struct((52.0 + p % 100 * 0.01 + dy).alias("lat"), (20.0 + F.floor(p / 100) * 0.01 + dx).alias("lon"))
    square = lambda x, y, side: F.array(at(x, y), at(x + side, y), at(x + side, y + side), at(x, y + side), at(x, y))
    member = lambda role, line: F.struct(F.lit("way").alias("type"), F.lit(role).alias("role"), line.alias("geometry"))
    away = F.when(p % 3 == 0, 0.0015).otherwise(0.0)  # reaches over the second square's side
    hole = F.array(at(0.0032, 0.0002), at(F.lit(0.0034) + away, 0.0002), at(0.0034, 0.0004), at(0.0032, 0.0002))
    rows = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.lit("relation").alias("type"), p.alias("id"), F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lon"), F.lit(None).cast("array<struct<lat:double,lon:double>>").alias("geometry"), F.array(member("outer", square(0.0, 0.0, 0.001)), member("outer", square(0.003, 0.0, 0.001)), member("inner", hole)).alias("members"))
    shapes = osm.only_polygons(osm.geometries(rows))
    return shapes.select("osm_id", "kind", F.size("polygons").alias("polygons"), F.aggregate(F.transform("polygons", lambda x: F.size(x) - 1), F.lit(0), lambda a, b: a + b).alias("holes"))


@query
def osm_centres(spark, sf_dir):
    """Centres of closed squares, of open lines along two of their sides, and of nodes; in millionths of a degree."""
    p = F.col("p_partkey")
    lon, lat = 20.0 + F.floor(p / 100) * 0.01, 52.0 + p % 100 * 0.01
    at = lambda dx, dy: F.struct((lat + dy).alias("lat"), (lon + dx).alias("lon"))
    corners = [at(0, 0), at(0.002, 0), at(0.002, 0.002)]
    line = F.when(p % 3 == 0, F.array(*corners, at(0, 0.002), at(0, 0))).when(p % 3 == 1, F.array(*corners))
    rows = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.when(p % 3 == 2, "node").otherwise("way").alias("type"), p.alias("id"), lat.alias("lat"), lon.alias("lon"), line.alias("geometry"), F.lit(None).cast("array<struct<type:string,role:string,geometry:array<struct<lat:double,lon:double>>>>").alias("members"))
    shapes = osm.centre(osm.geometries(rows))
    return shapes.select("osm_id", "kind", *[F.round(F.col(c) * 1e6).cast("bigint").alias(c) for c in ("lon", "lat")])


# ---- small operators


@query
def merge_base_and_rail(spark, sf_dir):
    """A city's feed with one operator of a rail feed and a local railway: trips by service, and stops, of all three."""
    base = feed(spark, sf_dir)
    local = {"trips": spark_view(spark, sf_dir, "f_freq_trips"), "routes": base["routes"], "stop_times": spark_view(spark, sf_dir, "f_freq_stop_times"), "calendar_dates": base["calendar_dates"]}
    local["stops"] = base["stops"].filter("stop_id IN ('S1', 'S2', 'S3')")
    out = feeds.merge_base_and_rail(base, feed(spark, sf_dir), local, "asia")
    trips = out["trips"].groupBy("route_id", "service_id").agg(F.count(F.lit(1)).alias("n")).withColumn("of", F.lit("trips"))
    stops = out["stops"].groupBy(F.lit(None).cast("string").alias("route_id"), F.regexp_extract("stop_id", "^([a-z]+_)?", 0).alias("service_id")).agg(F.count(F.lit(1)).alias("n")).withColumn("of", F.lit("stops"))
    times = out["stop_times"].groupBy(F.lit(None).cast("string").alias("route_id"), F.regexp_extract("stop_id", "^([a-z]+_)?", 0).alias("service_id")).agg(F.count(F.lit(1)).alias("n")).withColumn("of", F.lit("times"))
    dates = out["calendar_dates"].groupBy(F.lit(None).cast("string").alias("route_id"), F.regexp_extract("service_id", "^([a-z]+_)?", 0).alias("service_id")).agg(F.count(F.lit(1)).alias("n")).withColumn("of", F.lit("dates"))
    return trips.unionByName(stops).unionByName(times).unionByName(dates)


@query
def calendar_load(spark, sf_dir):
    """Dates of some services: from the exceptions, and from the calendar where there are none."""
    weekly, changes = views(spark, sf_dir, "f_calendar", "f_exceptions")
    some = weekly.filter(F.col("service_id").cast("int") % 3 == 0).select("service_id")
    one, two = calendar.load(weekly, changes, some), calendar.load(weekly, None, some)
    return one.withColumn("source", F.lit("exceptions")).unionByName(two.withColumn("source", F.lit("calendar")))


@query
def features_in_extent(spark, sf_dir):
    rows = spark_view(spark, sf_dir, "f_nodes_m").select("id", F.col("mx").alias("xmin"), (F.col("mx") + 30).alias("xmax"), F.col("my").alias("ymin"), (F.col("my") + 50).alias("ymax"))
    return spatial.in_extent(rows, 500.0, 1500.0, 0.0, 250.0, pad=100.0)


@query
def feature_bounds(spark, sf_dir):
    """Bounds of each feature's points."""
    points = spark_view(spark, sf_dir, "f_nodes_m").groupBy((F.col("id") % 37).alias("feature")).agg(F.collect_list(F.struct(F.col("mx").alias("x"), F.col("my").alias("y"))).alias("line"))
    return points.select("feature", *[c.alias(n) for n, c in regions.bounds(F.col("line")).items()])


@query
def box_texts(spark, sf_dir):
    """Bounds of tiles as text and read back, and the area of their boxes."""
    rows = spatial.tiles(spark, 1.0, 2.0, 3.0, 4.0, 4).withColumn("box", geo.box_of_text(geo.box_text(*map(F.col, ("south", "west", "north", "east")))))
    ring = geo.box_ring(*map(F.col, ("west", "south", "east", "north")))
    return rows.select("tile", "box.south", "box.west", "box.north", "box.east", geo.ring_area(ring).alias("area"))


@query
def trips_by_text(spark, sf_dir):
    """Trips whose identifier holds a text, with constant columns."""
    rows = spark_view(spark, sf_dir, "f_trip_names").filter(F.contains("trip_id", F.lit("/17/")))
    return rows.select("trip_id", F.col("trip_id").alias("train"), F.lit(5).alias("time_minutes"), F.lit(375.0).alias("distance_m"))


@query
def filled_with_zero(spark, sf_dir):
    """No nulls: 0 in numbers, "0" in texts."""
    rows = spark_view(spark, sf_dir, "f_osm").select("seen", "levels", F.nullif(F.col("osm_id") % 4, F.lit(0)).alias("n"))
    return timetable.fill_zero(rows)


@query
def rows_after_cursor(spark, sf_dir):
    """Rows beyond the last one that an earlier run took."""
    rows = spark_view(spark, sf_dir, "f_cluster_pts").select("id", "trip_count")
    return resume.after(rows, rows.filter("id < 4 OR trip_count = 5"), "id").unionByName(resume.after(rows.filter("id < 3"), rows.filter("id < 0"), "id"))
