"""Timetable-shaped views over the star-schema tables, in SQL that Spark and DuckDB both read.

In the texts, %div% is integer division and {name} a base table; view(name) is another view.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE = ("nation", "region", "customer", "supplier", "part", "orders", "lineitem", "events")


def route(k: str) -> str:
    s = f"CAST({k} AS STRING)"
    return f"CASE {k} % 5 WHEN 0 THEN {s} WHEN 1 THEN CAST(100 + {k} AS STRING) WHEN 2 THEN concat('M', {s}) WHEN 3 THEN concat('S', {s}) ELSE concat('L', {s}) END"


def hms(s: str) -> str:
    part = lambda x: f"lpad(CAST({x} AS STRING), 2, '0')"
    return f"concat({part(f'({s}) %div% 3600')}, ':', {part(f'(({s}) %div% 60) % 60')}, ':', {part(f'({s}) % 60')})"


_S = "(l_partkey * 61 + l_linenumber * 317 + l_orderkey * 29) % 108000"
_DAY = "(o_orderkey %div% 25) % 5"
_NAMES = ("", "0", "10", "M", "S", "R", "KM_R", "wkd_", "wkd_bus_", "U", "KW", "ska", "skm", "PKM", "L", " 1", "N")

VIEWS: dict[str, str] = {
    "f_stops": "SELECT concat('S', CAST(s_suppkey AS STRING)) AS stop_id, s_name AS stop_name, CAST(20.90 AS DOUBLE) + (s_suppkey % 10) * CAST(0.0030 AS DOUBLE) AS stop_lon, "
    "CAST(52.20 AS DOUBLE) + (s_suppkey %div% 10) * CAST(0.0018 AS DOUBLE) AS stop_lat FROM {supplier}",
    "f_routes": f"SELECT {route('n_nationkey')} AS route_id, CASE n_nationkey % 7 WHEN 0 THEN '0' WHEN 1 THEN '1' WHEN 2 THEN '2' WHEN 3 THEN '3' WHEN 4 THEN '4' WHEN 5 THEN '700' ELSE '11' END AS route_type, "
    "CAST(n_regionkey AS STRING) AS agency_id FROM {nation} WHERE n_nationkey < 18",
    "f_agency": "SELECT CAST(r_regionkey AS STRING) AS agency_id, concat('Koleje ', r_name) AS agency_name FROM {region}",
    "f_trips": f"SELECT CAST(o_orderkey AS STRING) AS trip_id, {route('(o_orderkey % 25)')} AS route_id, concat('2026-08-0', CAST(3 + {_DAY} AS STRING), ':', o_orderstatus) AS service_id FROM {{orders}}",
    "f_calendar_dates": f"SELECT DISTINCT CASE WHEN o_orderstatus = 'O' THEN concat('0', CAST(3 + {_DAY} AS STRING), ':O') ELSE concat('2026-08-0', CAST(3 + {_DAY} AS STRING), ':', o_orderstatus) END AS service_id, "
    f"CAST(20260803 + {_DAY} AS INT) AS date, CASE WHEN o_orderstatus = 'F' AND {_DAY} = 1 THEN 2 ELSE 1 END AS exception_type FROM {{orders}}",
    "f_stop_times": f"SELECT CAST(l_orderkey AS STRING) AS trip_id, concat('S', CAST(l_suppkey AS STRING)) AS stop_id, l_linenumber AS stop_sequence, "
    f"CASE WHEN l_partkey % 97 = 0 THEN 'bad' WHEN l_partkey % 89 = 0 THEN NULL ELSE {hms(_S)} END AS arrival_time FROM {{lineitem}}",
    "f_calendar": "SELECT CAST(s_suppkey AS STRING) AS service_id, " + ", ".join(f"CAST((s_suppkey %div% {1 << k}) % 2 AS INT) AS {d}" for k, d in enumerate(("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")))
    + ", CAST(20260801 AS INT) AS start_date, CAST(20260801 + s_suppkey % 28 AS INT) AS end_date FROM {supplier}",
    "f_exceptions": "SELECT CAST(s_suppkey AS STRING) AS service_id, CAST(20260801 + (s_suppkey * 7) % 28 AS INT) AS date, CAST(1 + s_suppkey % 2 AS INT) AS exception_type FROM {supplier} "
    "UNION ALL SELECT CAST(s_suppkey AS STRING), CAST(20260801 + (s_suppkey * 5) % 28 AS INT), CAST(1 + (s_suppkey %div% 2) % 2 AS INT) FROM {supplier}",
    "f_frequencies": "SELECT CAST(n_nationkey AS STRING) AS trip_id, concat(lpad(CAST(5 + n_nationkey % 3 AS STRING), 2, '0'), ':00:00') AS start_time, "
    "CASE WHEN n_nationkey = 9 THEN concat(lpad(CAST(5 + n_nationkey % 3 AS STRING), 2, '0'), ':00:00') WHEN n_nationkey = 8 THEN '25:30:00' ELSE concat(lpad(CAST(7 + n_nationkey AS STRING), 2, '0'), ':30:00') END AS end_time, "
    "CAST(300 + 60 * (n_nationkey % 5) AS INT) AS headway_secs FROM {nation} WHERE n_nationkey < 10",
    "f_freq_trips": f"SELECT CAST(n_nationkey AS STRING) AS trip_id, {route('n_nationkey')} AS route_id, CASE WHEN n_nationkey % 2 = 0 THEN '03:O' ELSE '2026-08-03:P' END AS service_id FROM {{nation}} WHERE n_nationkey < 10",
    "f_freq_stop_times": " UNION ALL ".join(f"SELECT CAST(n_nationkey AS STRING) AS trip_id, concat('S', CAST((n_nationkey + {k}) % 10 AS STRING)) AS stop_id FROM {{nation}} WHERE n_nationkey < 10" for k in range(3)),
    "f_nodes": "SELECT c_custkey AS node_id, CAST(20.90 AS DOUBLE) + (c_custkey % 40) * CAST(0.0015 AS DOUBLE) AS x, CAST(52.20 AS DOUBLE) + (c_custkey %div% 40) * CAST(0.0009 AS DOUBLE) AS y FROM {customer}",
    "f_nodes_m": "SELECT c_custkey AS id, CAST((c_custkey % 40) * 100 AS DOUBLE) AS mx, CAST((c_custkey %div% 40) * 100 AS DOUBLE) AS my FROM {customer}",
    "f_edges": "SELECT e.src, e.dst, CAST(100 + (least(e.src, e.dst) * 7) % 40 AS DOUBLE) AS length FROM ("
    "SELECT c_custkey AS src, c_custkey + 1 AS dst FROM {customer} WHERE c_custkey % 40 < 39 UNION ALL SELECT c_custkey, c_custkey - 1 FROM {customer} WHERE c_custkey % 40 > 0 AND (c_custkey - 1) % 11 <> 0 "
    "UNION ALL SELECT c_custkey, c_custkey + 40 FROM {customer} UNION ALL SELECT c_custkey, c_custkey - 40 FROM {customer}) e JOIN {customer} c ON e.dst = c.c_custkey",
    "f_stop_node": "SELECT concat('S', CAST(s_suppkey AS STRING)) AS stop_id, (s_suppkey % 10) * 2 + ((s_suppkey %div% 10) * 2) * 40 AS node_id FROM {supplier} JOIN {customer} ON c_custkey = (s_suppkey % 10) * 2 + ((s_suppkey %div% 10) * 2) * 40",
    "f_cluster_pts": "SELECT s_suppkey AS id, CAST((s_suppkey % 10) * 140 + CASE WHEN s_suppkey % 10 >= 5 THEN 400 ELSE 0 END AS DOUBLE) AS x, CAST((s_suppkey %div% 10) * 200 AS DOUBLE) AS y, "
    f"s_suppkey % 50 AS trip_count, CASE WHEN s_suppkey % 9 = 0 THEN '' ELSE concat({route('s_nationkey')}, ',R', CAST(s_suppkey % 4 AS STRING)) END AS route_ids FROM {{supplier}}",
    "f_osm": "SELECT p_partkey % 1800 AS osm_id, p_partkey AS seen, CASE WHEN p_type LIKE 'ECONOMY%' THEN 'motorway' WHEN p_type LIKE 'STANDARD%' THEN 'primary' WHEN p_type LIKE 'PROMO%' THEN 'residential' "
    "WHEN p_type LIKE 'SMALL%' THEN 'living_street' WHEN p_type LIKE 'MEDIUM%' THEN 'trunk_link' ELSE 'track' END AS highway, CASE p_size % 4 WHEN 0 THEN NULL WHEN 1 THEN 'many' ELSE CAST(p_size AS STRING) END AS levels, "
    "CASE p_size % 5 WHEN 0 THEN 'roof' WHEN 1 THEN 'service' WHEN 2 THEN NULL ELSE 'yes' END AS building FROM {part}",
    "f_route_names": "SELECT concat(p.prefix, CAST(n_nationkey AS STRING), s.suffix) AS route_id FROM {nation} CROSS JOIN (VALUES " + ", ".join(f"('{x}')" for x in _NAMES) + ") AS p(prefix) CROSS JOIN (VALUES (''), ('_BUS'), (' '), ('x')) AS s(suffix)",
    "f_trip_names": "SELECT concat('RA240327/', m.line, '/', CAST(o_orderkey AS STRING)) AS trip_id FROM {orders} JOIN (VALUES (0, '9'), (1, '17'), (2, '523'), (3, 'L-3'), (4, 'E2'), (5, 'S40'), (6, 'N83'), (7, 'Zx'), (8, 'WKD')) AS m(k, line) ON o_orderkey % 9 = m.k",
    "f_routecounts": "SELECT s_suppkey AS id, CASE s_suppkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN concat('a:b:', CAST(s_suppkey AS STRING), ',c:2') WHEN 3 THEN concat('x:1,x:', CAST(s_suppkey AS STRING)) WHEN 4 THEN 'bad,ok:5,n:z' ELSE concat('10:', CAST(s_suppkey AS STRING)) END AS route_trip_counts FROM {supplier}",
    "f_rail": "SELECT event_id AS id, event_type, user_id, value, props FROM {events}",
}


def spark_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = VIEWS[name].replace("%div%", "div")
    names = sorted(set(re.findall(r"\{(\w+)\}", text)))
    return spark.sql(text, **{n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names})


def duckdb_views(*names: str) -> str:
    """The WITH list of the views, for an oracle query."""
    return ",\n".join(f"{n} AS ({re.sub(r'[{](\w+)[}]', r'\1', VIEWS[n].replace('%div%', '//'))})" for n in names)
