"""The same results in DuckDB's SQL, written apart from the operators; only the input views are shared."""

from __future__ import annotations

from tramline.sources.fixtures import duckdb_views

ORACLES: dict[str, str] = {}


def oracle(name: str, views: str, select: str, *steps: str) -> None:
    """views: names of input views; steps: "name AS (query)" before the final select."""
    ORACLES[name] = "WITH RECURSIVE " + ",\n".join([x for x in [duckdb_views(*views.split())] if x] + list(steps)) + "\n" + select


ACTIVE = "active AS (SELECT DISTINCT service_id FROM f_calendar_dates WHERE date = 20260803 AND exception_type = 1)"
TRIPS = "active_trips AS (SELECT * FROM f_trips t WHERE EXISTS (SELECT 1 FROM active a WHERE contains(t.service_id, a.service_id)))"
DAY = "strptime(CAST(date AS VARCHAR), '%Y%m%d')::DATE"


def clock(t: str) -> str:
    h, m, s = (f"TRY_CAST(split_part({t}, ':', {k}) AS INTEGER)" for k in (1, 2, 3))
    return f"CASE WHEN {m} BETWEEN 0 AND 59 AND {s} BETWEEN 0 AND 59 THEN ({h} % 24) * 3600 + {m} * 60 + {s} END"


def elapsed(t: str) -> str:
    return f"(TRY_CAST(split_part({t}, ':', 1) AS INTEGER) * 3600 + TRY_CAST(split_part({t}, ':', 2) AS INTEGER) * 60 + TRY_CAST(split_part({t}, ':', 3) AS INTEGER))"


def hms(s: str) -> str:
    return f"printf('%02d:%02d:%02d', CAST(({s}) // 3600 AS BIGINT), CAST((({s}) // 60) % 60 AS BIGINT), CAST(({s}) % 60 AS BIGINT))"


oracle("active_services", "f_calendar_dates", "SELECT * FROM active", ACTIVE)
BY_DATE = "by_date AS (SELECT date, count(DISTINCT service_id) AS services FROM f_calendar_dates WHERE exception_type = 1 GROUP BY date)"
oracle("service_days_topk", "f_calendar_dates", f"SELECT date, services, CAST(isodow({DAY}) - 1 AS INTEGER) AS weekday, dayname({DAY}) AS day_name FROM by_date ORDER BY services DESC, date LIMIT 10", BY_DATE)
oracle("best_service_day", "f_calendar_dates", "SELECT date, services FROM by_date ORDER BY services DESC, date LIMIT 1", BY_DATE)
oracle("service_day_extent", "f_calendar_dates", "SELECT count(DISTINCT date) AS dates, min(date) AS first_date, max(date) AS last_date FROM f_calendar_dates WHERE exception_type = 1")
EXPANDED = """expanded AS (SELECT service_id, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date, CAST(1 AS INTEGER) AS exception_type FROM (
  SELECT *, unnest(generate_series(strptime(CAST(start_date AS VARCHAR), '%Y%m%d'), strptime(CAST(end_date AS VARCHAR), '%Y%m%d'), INTERVAL 1 DAY)) AS d FROM f_calendar)
  WHERE CASE isodow(d) WHEN 1 THEN monday WHEN 2 THEN tuesday WHEN 3 THEN wednesday WHEN 4 THEN thursday WHEN 5 THEN friday WHEN 6 THEN saturday ELSE sunday END = 1)"""
oracle("calendar_expand", "f_calendar", "SELECT * FROM expanded", EXPANDED)
oracle(
    "calendar_effective", "f_calendar f_exceptions",
    "SELECT service_id, date, CAST(1 AS INTEGER) AS exception_type FROM (SELECT service_id, date FROM expanded x WHERE NOT EXISTS (SELECT 1 FROM f_exceptions e WHERE e.service_id = x.service_id AND e.date = x.date AND exception_type = 2) "
    "UNION SELECT service_id, date FROM f_exceptions WHERE exception_type = 1)", EXPANDED,
)
oracle("feed_prefix_union", "f_trips f_freq_trips", "SELECT trip_id, route_id, service_id FROM f_trips UNION ALL SELECT 'tram_' || trip_id, route_id, 'tram_' || service_id FROM f_freq_trips")
oracle(
    "feed_extract_operator", "f_trips f_routes f_agency f_stop_times",
    "SELECT 'km_' || s.trip_id AS trip_id, 'km_' || stop_id AS stop_id, stop_sequence, t.route_id, 'km_' || service_id AS service_id FROM f_stop_times s JOIN f_trips t USING (trip_id) "
    "WHERE t.route_id IN (SELECT route_id FROM f_routes WHERE agency_id = (SELECT min(agency_id) FROM f_agency WHERE agency_name ILIKE '%asia%'))",
)
oracle("rail_prefix_routes", "f_trips f_routes", "SELECT trip_id, CASE WHEN route_id IN (SELECT route_id FROM f_routes WHERE route_type IN ('0', '1', '2')) THEN 'wkd_' ELSE 'wkd_bus_' END || route_id AS route_id, service_id FROM f_trips")
oracle(
    "merge_two_modes", "f_trips f_freq_trips f_calendar_dates",
    "SELECT route_id, date, count(*) AS trips FROM (SELECT route_id, service_id FROM f_trips UNION ALL SELECT route_id, 'tram_' || service_id FROM f_freq_trips) t "
    "JOIN (SELECT service_id, date FROM f_calendar_dates UNION ALL SELECT 'tram_' || service_id, date FROM f_calendar_dates) c USING (service_id) GROUP BY ALL",
)
oracle("trips_substring_semi", "f_trips f_calendar_dates", "SELECT * FROM active_trips", ACTIVE, TRIPS)
oracle("stop_times_routed", "f_trips f_calendar_dates f_stop_times", "SELECT s.trip_id, s.stop_id, s.stop_sequence, s.arrival_time, t.route_id FROM f_stop_times s JOIN active_trips t USING (trip_id)", ACTIVE, TRIPS)
oracle("gtfs_time_window", "f_stop_times", f"SELECT * FROM (SELECT *, {clock('arrival_time')} AS seconds FROM f_stop_times) WHERE seconds >= 21600 AND seconds < 79200")
oracle(
    "time_formats", "f_stop_times",
    f"SELECT trip_id, stop_id, stop_sequence, lpad(CAST(CASE WHEN TRY_CAST(split_part(arrival_time, ':', 1) AS INT) >= 24 THEN TRY_CAST(split_part(arrival_time, ':', 1) AS INT) - 24 ELSE TRY_CAST(split_part(arrival_time, ':', 1) AS INT) END AS VARCHAR), 2, '0') "
    f"|| substr(arrival_time, 3) AS adjusted, {elapsed('arrival_time')} AS elapsed, {hms(elapsed('arrival_time'))} AS formatted FROM f_stop_times WHERE {elapsed('arrival_time')} IS NOT NULL",
)
FREQUENT = f"""frequent AS (SELECT f.trip_id || '__' || CAST(t AS VARCHAR) AS trip_id, s.stop_id, {hms('t')} AS arrival_time, {hms('t')} AS departure_time, g.route_id FROM (
  SELECT trip_id, unnest(generate_series({elapsed('start_time')}, {elapsed('end_time')} - 1, headway_secs)) AS t FROM f_frequencies) f
  JOIN f_freq_trips g USING (trip_id) JOIN f_freq_stop_times s USING (trip_id)
  WHERE g.service_id IN (SELECT service_id FROM active WHERE NOT starts_with(service_id, '20')) OR NOT EXISTS (SELECT 1 FROM active WHERE NOT starts_with(service_id, '20')))"""
oracle("frequency_expand", "f_frequencies f_freq_trips f_freq_stop_times f_calendar_dates", "SELECT * FROM frequent", ACTIVE, FREQUENT)
oracle(
    "headway_counts", "f_frequencies f_freq_trips",
    f"SELECT route_id, CAST(sum(n) AS BIGINT) AS total_trips, count(*) AS trips FROM (SELECT trip_id, CAST(sum(CAST(round_even(greatest(0, least({elapsed('end_time')}, 79200) - greatest({elapsed('start_time')}, 21600)) / headway_secs, 0) AS BIGINT)) AS BIGINT) AS n "
    "FROM f_frequencies GROUP BY trip_id) JOIN f_freq_trips USING (trip_id) GROUP BY route_id",
)
oracle("calendar_inner", "f_trips f_calendar_dates", "SELECT route_id, date, count(*) AS trips FROM f_trips JOIN f_calendar_dates USING (service_id) GROUP BY ALL")
oracle("stop_value_counts", "f_stop_times", "SELECT stop_id, count(*) AS n FROM f_stop_times GROUP BY stop_id")
oracle(
    "vehicle_regex", "f_trip_names",
    "SELECT trip_id, CASE WHEN regexp_matches(trip_id, '/\\d{1,2}/') THEN 'tram' WHEN regexp_matches(trip_id, '/\\d{3}/') THEN 'bus' WHEN regexp_matches(trip_id, '/(L|E|Z)[-\\w]{1,3}/') THEN 'bus' "
    "WHEN regexp_matches(trip_id, '/S\\d{1,2}/') THEN 'train' WHEN regexp_matches(trip_id, '/N\\d{1,2}/') THEN 'night_bus' ELSE 'Unknown' END AS vehicle, split_part(trip_id, '/', 1) AS route, split_part(trip_id, '/', 2) AS line FROM f_trip_names",
)

R = "trim(route_id)"
BELOW_100 = f"(regexp_full_match({R}, '[0-9]+') AND TRY_CAST({R} AS BIGINT) < 100)"
RULES = {
    "warsaw": f"CASE WHEN regexp_full_match({R}, 'M[0-9]+') THEN 'metro' WHEN regexp_full_match({R}, '[0-9]{{1,2}}') THEN 'tram' WHEN regexp_full_match({R}, '[0-9]{{3}}') THEN 'bus' "
    f"WHEN {R} LIKE 'S%' OR {R} LIKE 'R%' OR (starts_with({R}, 'KM_R') AND NOT contains({R}, '_BUS')) OR (starts_with({R}, 'wkd_') AND NOT contains({R}, 'bus')) THEN 'train' ELSE 'bus' END",
    "berlin": f"CASE WHEN regexp_matches({R}, '^U[0-9]') THEN 'metro' WHEN regexp_matches({R}, '^S[0-9]') THEN 'train' WHEN regexp_matches({R}, '^M[0-9]') OR {BELOW_100} THEN 'tram' ELSE 'bus' END",
} | {
    city: f"CASE WHEN {BELOW_100} THEN 'tram' WHEN " + " OR ".join(f"starts_with(upper({R}), '{p}')" for p in ("S", "R", *more)) + " THEN 'train' ELSE 'bus' END"
    for city, more in {"poznan": ("KW",), "krakow": ("SKA",), "gdansk": ("SKM", "PKM")}.items()
}
KINDS = "kinds AS (SELECT trim(route_id) AS id, max(CASE trim(route_type) WHEN '0' THEN 'tram' WHEN '1' THEN 'metro' WHEN '2' THEN 'train' WHEN '3' THEN 'bus' WHEN '5' THEN 'bus' WHEN '7' THEN 'bus' WHEN '11' THEN 'bus' WHEN '12' THEN 'train' END) AS kind FROM f_routes GROUP BY 1)"
for _city, _rule in RULES.items():
    oracle(f"vehicle_class_{_city}", "f_route_names f_routes", f"SELECT r.route_id, coalesce(kind, {_rule.replace('route_id', 'r.route_id')}) AS vehicle FROM (SELECT DISTINCT route_id FROM f_route_names) r LEFT JOIN kinds ON id = trim(r.route_id)", KINDS)

TIMETABLE = "f_trips f_calendar_dates f_stop_times f_routes f_frequencies f_freq_trips f_freq_stop_times"
DEPARTURES = (
    ACTIVE, TRIPS, FREQUENT, KINDS,
    "rows_ AS (SELECT stop_id, route_id, arrival_time FROM f_stop_times JOIN active_trips USING (trip_id) UNION ALL SELECT stop_id, route_id, arrival_time FROM frequent)",
    f"counts AS (SELECT stop_id, route_id, coalesce(kind, {RULES['warsaw']}) AS vehicle, count(*) AS n FROM (SELECT *, {clock('arrival_time')} AS seconds FROM rows_) LEFT JOIN kinds ON id = trim(route_id) "
    "WHERE seconds >= 21600 AND seconds < 79200 GROUP BY ALL)",
    "per_stop AS (SELECT stop_id, " + ", ".join(f"CAST(coalesce(sum(n) FILTER (vehicle = '{v}'), 0) AS BIGINT) AS {v}" for v in ("bus", "tram", "train", "metro"))
    + ", count(DISTINCT route_id) AS unique_routes, string_agg(route_id, ',' ORDER BY route_id) AS route_ids, string_agg(route_id || ':' || n, ',' ORDER BY route_id) AS route_trip_counts, CAST(sum(n) AS BIGINT) AS trip_count FROM counts GROUP BY stop_id)",
)
oracle(
    "route_kinds_last", "f_routes",
    "SELECT route_id, coalesce(CASE WHEN t <> 1 THEN k[(t + 1) % 9 + 1] END, k[t + 1]) AS vehicle FROM (SELECT route_id, CAST(route_type AS INTEGER) AS t, "
    "['tram', 'metro', 'train', 'bus', NULL, 'bus', NULL, 'bus', NULL, NULL, NULL, 'bus', 'train'] AS k FROM f_routes) WHERE coalesce(CASE WHEN t <> 1 THEN k[(t + 1) % 9 + 1] END, k[t + 1]) IS NOT NULL",
)
oracle("stop_vehicle_pivot", TIMETABLE, "SELECT stop_id, bus, tram, train, metro FROM per_stop", *DEPARTURES)
oracle("stop_route_lists", TIMETABLE, "SELECT stop_id, unique_routes, route_ids, route_trip_counts FROM per_stop", *DEPARTURES)
oracle("stop_trip_counts", TIMETABLE + " f_stops", "SELECT s.*, p.* EXCLUDE (stop_id) FROM f_stops s JOIN per_stop p USING (stop_id) WHERE trip_count > 0", *DEPARTURES)
oracle(
    "network_totals", TIMETABLE + " f_stops",
    "SELECT count(*) AS stops, " + ", ".join(f"CAST(sum({v}) AS BIGINT) AS {v}" for v in ("bus", "tram", "train", "metro", "trip_count")) + ", (SELECT count(DISTINCT route_id) FROM counts) AS routes FROM f_stops JOIN per_stop USING (stop_id) WHERE trip_count > 0",
    *DEPARTURES,
)


def cm(x: str) -> str:
    return f"CAST(round(({x}) * 100) AS BIGINT)"


#: Transverse Mercator by the same series, with the numbers of the ellipsoid and of the two systems written out.
TM = {"EPSG:2180": (19.0, 0.9993, 500000.0, -5300000.0), "EPSG:25833": (15.0, 0.9996, 500000.0, 0.0)}


def tm(lon: str, lat: str, crs: str) -> tuple[str, str]:
    lon0, scale, east, north = TM[crs]
    phi, dl = f"radians({lat})", f"radians(({lon}) - {lon0})"
    t = f"sinh(atanh(sin({phi})) - 0.08181919104281579e0 * atanh(0.08181919104281579e0 * sin({phi})))"
    xi, eta = f"atan2({t}, cos({dl}))", f"atanh(sin({dl}) / sqrt(1 + ({t}) * ({t})))"
    series = ((2, "0.0008377318247344344e0"), (4, "7.608527788826164e-07"), (6, "1.1976380191731537e-09"), (8, "2.443376242510368e-12"))
    e = " + ".join([eta, *(f"{a} * cos({k} * {xi}) * sinh({k} * {eta})" for k, a in series)])
    n = " + ".join([xi, *(f"{a} * sin({k} * {xi}) * cosh({k} * {eta})" for k, a in series)])
    return f"({east} + {scale} * 6367449.145771048e0 * ({e}))", f"({north} + {scale} * 6367449.145771048e0 * ({n}))"


_tm = []
for _crs in TM:
    _e, _n = tm("x", "y", _crs)
    _tm.append(f"SELECT '{_crs}' AS crs, node_id, {cm(_e)} AS e_cm, {cm(_n)} AS n_cm FROM f_nodes")
oracle("project_tm", "f_nodes", " UNION ALL ".join(_tm))
oracle("web_mercator_frame", "f_nodes", f"SELECT min(e) AS xmin, max(e) AS xmax, min(n) AS ymin, max(n) AS ymax FROM (SELECT {cm('6378137.0 * radians(x)')} AS e, {cm('6378137.0 * ln(tan(pi() / 4 + radians(y) / 2))')} AS n FROM f_nodes)")
_boxes = {
    "warsaw": (52.0977, 20.8519, 52.3690, 21.2711, "EPSG:2180"), "poznan": (52.30, 16.73, 52.50, 17.10, "EPSG:2180"), "krakow": (49.97, 19.79, 50.13, 20.13, "EPSG:2180"),
    "gdansk": (54.28, 18.45, 54.52, 18.82, "EPSG:2180"), "berlin": (52.34, 13.09, 52.68, 13.76, "EPSG:25833"),
}
_extents = []
for _city, (_s, _w, _nn, _ee, _crs) in _boxes.items():
    (_x1, _y1), (_x2, _y2) = tm(f"{_w}::DOUBLE", f"{_s}::DOUBLE", _crs), tm(f"{_ee}::DOUBLE", f"{_nn}::DOUBLE", _crs)
    _extents.append(f"SELECT '{_city}' AS city, {cm(_x1 + ' - 500')} AS xmin, {cm(_x2 + ' + 500')} AS xmax, {cm(_y1 + ' - 500')} AS ymin, {cm(_y2 + ' + 500')} AS ymax")
ORACLES["city_extents"] = " UNION ALL ".join(_extents)
_e1, _n1 = tm("stop_lon", "stop_lat", "EPSG:2180")
_e2, _n2 = tm("x", "y", "EPSG:2180")
oracle(
    "nearest_node", "f_stops f_nodes",
    f"SELECT stop_id, node_id, snap_cm FROM (SELECT stop_id, node_id, {cm(f'sqrt(({_e1} - {_e2}) * ({_e1} - {_e2}) + ({_n1} - {_n2}) * ({_n1} - {_n2}))')} AS snap_cm FROM ranked WHERE r = 1) WHERE snap_cm <= 50000",
    "ranked AS (SELECT *, row_number() OVER (PARTITION BY stop_id ORDER BY (stop_lon - x) * (stop_lon - x) + (stop_lat - y) * (stop_lat - y), node_id) AS r FROM f_stops JOIN f_nodes ON abs(stop_lon - x) < 0.02 AND abs(stop_lat - y) < 0.02)",
)

WALK = (
    "walk(stop_id, node_id, dist) AS (SELECT stop_id, node_id, CAST(0 AS DOUBLE) FROM f_stop_node UNION SELECT w.stop_id, e.dst, w.dist + e.length FROM walk w JOIN f_edges e ON w.node_id = e.src WHERE w.dist + e.length <= 375)",
    "every AS (SELECT stop_id, node_id, min(dist) AS dist FROM walk GROUP BY ALL)",
    "reached AS (SELECT * FROM every WHERE stop_id IN (SELECT stop_id FROM every GROUP BY stop_id HAVING count(*) >= 3))",
)
EDGES = ("own_edges AS (SELECT DISTINCT a.stop_id, e.src, e.dst FROM reached a JOIN f_edges e ON a.node_id = e.src JOIN reached b ON b.stop_id = a.stop_id AND b.node_id = e.dst)",)
CELLS = (
    "shapes AS (SELECT DISTINCT src, dst, a.mx AS ax, a.my AS ay, b.mx AS bx, b.my AS by_, b.mx - a.mx AS dx, b.my - a.my AS dy FROM own_edges JOIN f_nodes_m a ON a.id = src JOIN f_nodes_m b ON b.id = dst)",
    "xs AS (SELECT *, unnest(generate_series(CAST(floor((least(ax, bx) - 50) / 25) AS BIGINT), CAST(floor((greatest(ax, bx) + 50) / 25) AS BIGINT))) AS cx FROM shapes)",
    "xys AS (SELECT *, unnest(generate_series(CAST(floor((least(ay, by_) - 50) / 25) AS BIGINT), CAST(floor((greatest(ay, by_) + 50) / 25) AS BIGINT))) AS cy FROM xs)",
    "us AS (SELECT *, greatest(0.0, least(1.0, CASE WHEN dx * dx + dy * dy = 0 THEN 0.0 ELSE (((cx + 0.5) * 25 - ax) * dx + ((cy + 0.5) * 25 - ay) * dy) / (dx * dx + dy * dy) END))::DOUBLE AS u FROM xys)",
    "hits AS (SELECT src, dst, cx, cy FROM us WHERE pow((cx + 0.5) * 25 - (ax + u * dx), 2) + pow((cy + 0.5) * 25 - (ay + u * dy), 2) <= 2500)",
    "cells AS (SELECT DISTINCT stop_id, cx, cy FROM own_edges JOIN hits USING (src, dst))",
)
REACH = "f_stop_node f_edges"
oracle("reachable_nodes", REACH, "SELECT * FROM reached", *WALK)
oracle("isochrone_edges", REACH, "SELECT * FROM own_edges", *WALK, *EDGES)
oracle("isochrone_cells", REACH + " f_nodes_m", "SELECT stop_id, count(*) AS cells, count(*) * 0.0625::DOUBLE AS area_ha FROM cells GROUP BY stop_id", *WALK, *EDGES, *CELLS)
FREQ = (*DEPARTURES, *WALK, *EDGES, *CELLS, "freq AS (SELECT cx, cy, CAST(sum(n) AS BIGINT) AS deduped_trips, count(*) AS unique_routes FROM (SELECT cx, cy, route_id, max(n) AS n FROM cells JOIN counts USING (stop_id) GROUP BY ALL) GROUP BY ALL)")
COVERAGE = f"{TIMETABLE} {REACH} f_nodes_m"
oracle("coverage_cells", COVERAGE, "SELECT * FROM freq", *FREQ)
PARTS = (
    *FREQ,
    "near AS (SELECT a.cx AS ax, a.cy AS ay, b.cx AS bx, b.cy AS by2 FROM freq a JOIN freq b ON a.deduped_trips = b.deduped_trips AND b.cx BETWEEN a.cx - 1 AND a.cx + 1 AND abs(a.cx - b.cx) + abs(a.cy - b.cy) = 1 AND b.cy BETWEEN a.cy - 1 AND a.cy + 1)",
    "joined(sx, sy, cx, cy) AS (SELECT cx, cy, cx, cy FROM freq UNION SELECT j.sx, j.sy, n.bx, n.by2 FROM joined j JOIN near n ON n.ax = j.cx AND n.ay = j.cy)",
    "labelled AS (SELECT cx, cy, min(row(sx, sy)) AS first FROM joined GROUP BY cx, cy)",
    "grouped AS (SELECT first, deduped_trips, count(*) AS cells, arg_min(unique_routes, row(cx, cy)) AS unique_routes FROM labelled JOIN freq USING (cx, cy) GROUP BY first, deduped_trips)",
    "own AS (SELECT first[1] || '_' || first[2] AS part, deduped_trips, unique_routes, cells, cells * 0.0625::DOUBLE AS area_ha FROM grouped WHERE cells * 625 > 10 AND cells * 625 <= 5000000)",
    "firsts AS (SELECT deduped_trips, arg_min(unique_routes, row(cx, cy)) AS unique_routes FROM freq GROUP BY deduped_trips)",
    "parts AS (SELECT part, deduped_trips, f.unique_routes, cells, area_ha FROM own JOIN firsts f USING (deduped_trips))",
)
oracle("coverage_own_routes", COVERAGE, "SELECT * FROM own", *PARTS)
oracle("coverage_summary", COVERAGE, "SELECT count(*) AS regions, max(deduped_trips) AS most_trips, max(unique_routes) AS most_routes, sum(area_ha) AS area_ha, avg(area_ha) AS mean_area_ha FROM parts", *PARTS)
oracle(
    "coverage_rings", COVERAGE,
    "SELECT part, deduped_trips, 1::INTEGER AS polygons, CAST(2 - cells + sides - blocks AS INTEGER) AS rings, CAST(corners + 2 - cells + sides - blocks AS INTEGER) AS points, (4 * cells - 2 * sides) * 25::DOUBLE AS length, cells * 625::DOUBLE AS area "
    "FROM parts JOIN corners USING (part) LEFT JOIN sides USING (part) LEFT JOIN blocks USING (part)",
    *PARTS,
    "placed AS (SELECT cx, cy, part FROM labelled JOIN parts ON part = first[1] || '_' || first[2])",
    "right_ AS (SELECT a.part, a.cx, a.cy FROM placed a JOIN placed b ON a.part = b.part AND b.cx = a.cx + 1 AND b.cy = a.cy)",
    "above AS (SELECT a.part, a.cx, a.cy FROM placed a JOIN placed b ON a.part = b.part AND b.cx = a.cx AND b.cy = a.cy + 1)",
    "sides AS (SELECT part, count(r) AS sides FROM (SELECT part, NULL AS r FROM parts UNION ALL SELECT part, 1 FROM right_ UNION ALL SELECT part, 1 FROM above) GROUP BY part)",
    "blocks AS (SELECT p.part, count(u.part) AS blocks FROM parts p LEFT JOIN (SELECT a.part FROM right_ a JOIN right_ b ON a.part = b.part AND a.cx = b.cx AND b.cy = a.cy + 1 "
    "JOIN above c ON c.part = a.part AND c.cx = a.cx AND c.cy = a.cy) u ON u.part = p.part GROUP BY p.part)",
    "vertices AS (SELECT part, cx + dx AS x, cy + dy AS y, count(*) AS n, count(*) FILTER (dx = dy) AS same FROM placed, (VALUES (0), (1)) i(dx), (VALUES (0), (1)) j(dy) GROUP BY ALL)",
    "corners AS (SELECT part, sum(CASE WHEN n IN (1, 3) THEN 1 WHEN n = 2 AND same <> 1 THEN 2 ELSE 0 END) AS corners FROM vertices GROUP BY part)",
)
oracle(
    "stop_area_rings", REACH + " f_nodes_m",
    "SELECT stop_id, count(*) * 0.0625::DOUBLE AS area_ha, count(*) * 625 AS square_metres, min(cx) * 25 AS xmin, (max(cx) + 1) * 25 AS xmax, min(cy) * 25 AS ymin, (max(cy) + 1) * 25 AS ymax FROM cells GROUP BY stop_id", *WALK, *EDGES, *CELLS,
)
oracle("coverage_dissolve", COVERAGE, "SELECT * FROM parts", *PARTS)
_breaks = "[1, 10, 25, 50, 80, 120, 170, 250, 350, 450, 600, 800, 1000, 1300, 1700, 2200, 2800, 3500]"
_labels = (
    "['1 - 10', '10 - 25', '25 - 50', '50 - 80', '80 - 120', '120 - 170', '170 - 250', '250 - 350', '350 - 450', '450 - 600', '600 - 800', '800 - 1000', '1000 - 1300', '1300 - 1700', '1700 - 2200', '2200 - 2800', '2800 - 3500', '3500+']"
)
oracle(
    "coverage_classes", COVERAGE,
    f"SELECT class, count(*) AS regions, sum(area_ha) AS area_ha, {_labels}[class + 1] AS label FROM (SELECT *, CAST(greatest(0, len(list_filter({_breaks}, lambda b: b <= deduped_trips)) - 1) AS INTEGER) AS class FROM parts) GROUP BY class", *PARTS,
)
oracle("coverage_topk", COVERAGE, "SELECT deduped_trips, count(*) AS regions, sum(area_ha) AS area_ha, arg_min(unique_routes, part) AS unique_routes FROM parts GROUP BY deduped_trips ORDER BY deduped_trips DESC LIMIT 15", *PARTS)
oracle(
    "stop_clusters", "f_cluster_pts",
    "SELECT c.cluster, x, y, trip_count, coalesce(route_ids, '') AS route_ids, coalesce(unique_routes, 0) AS unique_routes FROM (SELECT cluster, CAST(sum(trip_count) AS BIGINT) AS trip_count FROM f_cluster_pts JOIN labels USING (id) GROUP BY cluster) c "
    "JOIN (SELECT cluster, avg(x) AS x, avg(y) AS y FROM (SELECT DISTINCT cluster, x, y FROM f_cluster_pts JOIN labels USING (id)) GROUP BY cluster) USING (cluster) "
    "LEFT JOIN (SELECT cluster, string_agg(r, ',' ORDER BY r) AS route_ids, count(*)::INTEGER AS unique_routes FROM (SELECT DISTINCT cluster, unnest(string_split(route_ids, ',')) AS r FROM f_cluster_pts JOIN labels USING (id)) WHERE r <> '' GROUP BY cluster) USING (cluster)",
    "same(a, b) AS (SELECT id, id FROM f_cluster_pts UNION SELECT s.a, q.id FROM same s JOIN f_cluster_pts p ON p.id = s.b JOIN f_cluster_pts q ON q.x BETWEEN p.x - 150 AND p.x + 150 AND pow(p.x - q.x, 2) + pow(p.y - q.y, 2) <= 22500)",
    "labels AS (SELECT b AS id, min(a) AS cluster FROM same GROUP BY b)",
)
oracle("name_centroids", "f_nodes_m", "SELECT name, layer, avg(x) AS x, avg(y) AS y, count(*) AS points FROM (SELECT DISTINCT id % 37 AS name, id % 3 AS layer, mx AS x, my AS y FROM f_nodes_m) GROUP BY ALL")
ORACLES["tile_grid"] = (
    "SELECT i || '_' || j AS tile, 52.0977::DOUBLE + i * h AS south, 20.8519::DOUBLE + j * w AS west, 52.0977::DOUBLE + (i + 1) * h AS north, 20.8519::DOUBLE + (j + 1) * w AS east "
    "FROM range(4) a(i), range(4) b(j), (SELECT (52.3690::DOUBLE - 52.0977::DOUBLE) / 4 AS h, (21.2711::DOUBLE - 20.8519::DOUBLE) / 4 AS w)"
)
oracle("tile_dedup", "f_osm", "SELECT osm_id, arg_min(highway, seen) AS highway, min(seen) AS tile FROM f_osm GROUP BY osm_id")
oracle(
    "road_hierarchy", "f_osm",
    "SELECT highway, CAST(CASE highway WHEN 'motorway' THEN 1 WHEN 'trunk' THEN 2 WHEN 'primary' THEN 3 WHEN 'secondary' THEN 4 WHEN 'tertiary' THEN 5 WHEN 'unclassified' THEN 6 WHEN 'residential' THEN 7 WHEN 'living_street' THEN 8 "
    "WHEN 'motorway_link' THEN 1 WHEN 'trunk_link' THEN 2 WHEN 'primary_link' THEN 3 WHEN 'secondary_link' THEN 4 WHEN 'tertiary_link' THEN 5 ELSE 99 END AS INTEGER) AS hierarchy, "
    "highway IN ('ekspresowa', 'glownaRuchuPrzyspieszonego', 'glowna', 'zbiorcza', 'motorway', 'trunk', 'primary', 'secondary') AS major, count(*) AS n FROM f_osm GROUP BY ALL",
)
oracle(
    "building_levels", "f_osm",
    "SELECT osm_id, 'way' AS osm_type, CAST(NULL AS VARCHAR) AS name, building, coalesce(TRY_CAST(levels AS DOUBLE), 2.0::DOUBLE) AS levels, CAST(NULL AS VARCHAR) AS housenumber, CAST(NULL AS VARCHAR) AS street FROM f_osm WHERE building IS NULL OR building NOT IN ('roof', 'service')",
)
oracle("osm_tags", "f_rail", "SELECT id AS osm_id, 'way' AS osm_type, props ->> '$.k' AS k, props ->> '$.name' AS name FROM f_rail")
oracle("osm_layers", "f_osm", "SELECT 'roads' AS layer, count(*) AS n FROM f_osm WHERE highway <> 'track' UNION ALL SELECT 'buildings', count(*) FROM f_osm WHERE building IS NOT NULL")
oracle(
    "railway_type", "f_rail",
    "SELECT id, railway, CAST(CASE railway WHEN 'tram' THEN 480 WHEN 'train' THEN 900 ELSE 720 END AS INTEGER) AS time_limit FROM (SELECT id, CASE WHEN id % 5 = 0 THEN 'tram' WHEN id % 13 = 0 THEN 'light_rail' WHEN id % 7 = 0 THEN 'subway' "
    "WHEN id % 11 = 0 THEN 'tram' WHEN id % 3 = 0 THEN 'train' END AS railway FROM f_rail) WHERE railway IS NOT NULL",
)
oracle(
    "parse_route_counts", "f_routecounts",
    "SELECT id, route_id, arg_max(n, k) AS n FROM (SELECT id, k, regexp_extract(p, '^(.*):([^:]*)$', 1) AS route_id, TRY_CAST(trim(regexp_extract(p, '^(.*):([^:]*)$', 2)) AS BIGINT) AS n FROM "
    "(SELECT id, unnest(string_split(route_trip_counts, ',')) AS p, unnest(range(len(string_split(route_trip_counts, ',')))) AS k FROM f_routecounts WHERE route_trip_counts <> '')) WHERE n IS NOT NULL GROUP BY id, route_id",
)
ORACLES["qml_ranges"] = (
    f"SELECT CAST(i AS INTEGER) AS class, printf('<range lower=\"%d\" upper=\"%d\" symbol=\"%d\" label=\"%s\" render=\"true\"/>', {_breaks}[i + 1], coalesce({_breaks}[i + 2], 100000), i, {_labels}[i + 1]) AS element FROM range(18) r(i)"
)
ORACLES["osm_rings"] = "SELECT p_partkey AS osm_id, 'Polygon' AS kind, 2::INTEGER AS rings, 5::INTEGER AS outer_points, 4::INTEGER AS hole_points FROM part"
FAR = lambda s: f"a * (8 - {s}) / (9 - {s}) * (10 * (9 - {s})) / sqrt(pow(10 * (9 - {s}), 2) + a * a) > 5"
ORACLES["simplify"] = (  # from a corner at the bottom to the line's end, the next corner is the farthest, and then the one after it
    f"SELECT id, CAST(2 + CASE WHEN NOT {FAR(0)} THEN 0 WHEN NOT {FAR(2)} THEN 2 WHEN NOT {FAR(4)} THEN 4 WHEN NOT {FAR(6)} THEN 6 ELSE 8 END AS INTEGER) AS points FROM (SELECT p_partkey AS id, (p_size % 11)::DOUBLE AS a FROM part)"
)
ORACLES["osm_holes"] = "SELECT p_partkey AS osm_id, 'MultiPolygon' AS kind, 2::INTEGER AS polygons, CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE 1 END::INTEGER AS holes FROM part"
ORACLES["osm_centres"] = (
    "SELECT osm_id, kind, CAST(round((20::DOUBLE + osm_id // 100 * 0.01::DOUBLE + dx) * 1e6) AS BIGINT) AS lon, CAST(round((52::DOUBLE + osm_id % 100 * 0.01::DOUBLE + dy) * 1e6) AS BIGINT) AS lat FROM (SELECT p_partkey AS osm_id, "
    "['Polygon', 'LineString', 'Point'][p_partkey % 3 + 1] AS kind, ([0.001, 0.0015, 0.0]::DOUBLE[])[p_partkey % 3 + 1] AS dx, ([0.001, 0.0005, 0.0]::DOUBLE[])[p_partkey % 3 + 1] AS dy FROM part)"
)
oracle(
    "merge_base_and_rail", "f_trips f_routes f_agency f_stop_times f_stops f_calendar_dates f_freq_trips f_freq_stop_times",
    "SELECT route_id, service_id, count(*) AS n, 'trips' AS of FROM (SELECT route_id, service_id FROM f_trips UNION ALL SELECT route_id, 'km_' || service_id FROM km "
    "UNION ALL SELECT CASE WHEN route_id IN (SELECT route_id FROM f_routes WHERE route_type IN ('0', '1', '2')) THEN 'wkd_' ELSE 'wkd_bus_' END || route_id, 'wkd_' || service_id FROM f_freq_trips) GROUP BY ALL "
    "UNION ALL SELECT NULL, p, count(*), 'stops' FROM (SELECT '' AS p FROM f_stops UNION ALL SELECT 'km_' FROM f_stops WHERE stop_id IN (SELECT stop_id FROM km_times) UNION ALL SELECT 'wkd_' FROM f_stops WHERE stop_id IN ('S1', 'S2', 'S3')) GROUP BY ALL "
    "UNION ALL SELECT NULL, p, count(*), 'times' FROM (SELECT '' AS p FROM f_stop_times UNION ALL SELECT 'km_' FROM km_times UNION ALL SELECT 'wkd_' FROM f_freq_stop_times) GROUP BY ALL "
    "UNION ALL SELECT NULL, p, count(*), 'dates' FROM (SELECT '' AS p FROM f_calendar_dates UNION ALL SELECT 'km_' FROM f_calendar_dates WHERE service_id IN (SELECT service_id FROM km) UNION ALL SELECT 'wkd_' FROM f_calendar_dates) GROUP BY ALL",
    "km AS (SELECT * FROM f_trips WHERE route_id IN (SELECT route_id FROM f_routes WHERE agency_id = (SELECT min(agency_id) FROM f_agency WHERE agency_name ILIKE '%asia%')))",
    "km_times AS (SELECT * FROM f_stop_times WHERE trip_id IN (SELECT trip_id FROM km))",
)
oracle(
    "calendar_load", "f_calendar f_exceptions",
    "SELECT service_id, date, exception_type, 'exceptions' AS source FROM f_exceptions WHERE CAST(service_id AS INTEGER) % 3 = 0 UNION ALL SELECT service_id, date, exception_type, 'calendar' FROM expanded WHERE CAST(service_id AS INTEGER) % 3 = 0", EXPANDED,
)
oracle("features_in_extent", "f_nodes_m", "SELECT * FROM (SELECT id, mx AS xmin, mx + 30 AS xmax, my AS ymin, my + 50 AS ymax FROM f_nodes_m) WHERE xmax >= 400 AND xmin <= 1600 AND ymax >= -100 AND ymin <= 350")
oracle("feature_bounds", "f_nodes_m", "SELECT id % 37 AS feature, min(mx) AS xmin, max(mx) AS xmax, min(my) AS ymin, max(my) AS ymax FROM f_nodes_m GROUP BY 1")
ORACLES["box_texts"] = (
    "SELECT i || '_' || j AS tile, 1 + i * 0.5::DOUBLE AS south, 2 + j * 0.5::DOUBLE AS west, 1.5 + i * 0.5::DOUBLE AS north, 2.5 + j * 0.5::DOUBLE AS east, 0.25::DOUBLE AS area FROM range(4) a(i), range(4) b(j)"
)
oracle("trips_by_text", "f_trip_names", "SELECT trip_id, trip_id AS train, 5::INTEGER AS time_minutes, 375::DOUBLE AS distance_m FROM f_trip_names WHERE contains(trip_id, '/17/')")
oracle("filled_with_zero", "f_osm", "SELECT seen, coalesce(levels, '0') AS levels, osm_id % 4 AS n FROM f_osm")
oracle(
    "exact_pieces", "f_cluster_pts",
    "SELECT CAST(d AS VARCHAR) AS district, CAST(stops AS INTEGER) AS stops, count(*) AS pieces, CAST(sum((b - a) * 200) AS BIGINT) AS area FROM (SELECT d, a, b, (SELECT count(*) FROM squares q WHERE q.d = s.d AND q.lo <= s.a AND q.hi >= s.b) AS stops FROM spans s WHERE b IS NOT NULL) "
    "WHERE stops > 0 GROUP BY ALL",
    "squares AS (SELECT id // 10 AS d, x - 100 AS lo, x + 100 AS hi FROM f_cluster_pts)",
    "cuts AS (SELECT d, lo AS p FROM squares UNION SELECT d, hi FROM squares)",
    "spans AS (SELECT d, p AS a, lead(p) OVER (PARTITION BY d ORDER BY p) AS b FROM cuts)",
)
oracle("rows_after_cursor", "f_cluster_pts", "SELECT id, trip_count FROM f_cluster_pts WHERE id > (SELECT max(id) FROM f_cluster_pts WHERE id < 4 OR trip_count = 5) UNION ALL SELECT id, trip_count FROM f_cluster_pts WHERE id < 3")
