"""Feeds: prefixes, extraction of one operator, appending, and the merges of the supported cities.

A feed is a dict of DataFrames by table name (trips, stop_times, stops, routes, agency, calendar, calendar_dates, shapes).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.operators import calendar

Feed = dict[str, DataFrame]
RAIL_TYPES = ("0", "1", "2")
PREFIXED = {"trips": ("trip_id", "service_id", "shape_id"), "stop_times": ("trip_id", "stop_id"), "stops": ("stop_id",), "calendar_dates": ("service_id",), "calendar": ("service_id",), "shapes": ("shape_id",)}


def prefix(rows: DataFrame, columns: tuple[str, ...], text: str) -> DataFrame:
    """text before the identifiers in columns that rows has; null stays null."""
    return rows.withColumns({c: F.concat(F.lit(text), F.col(c)) for c in columns if c in rows.columns})


def prefixed(feed: Feed, text: str, extra: dict[str, tuple[str, ...]] | None = None) -> Feed:
    return {name: prefix(rows, PREFIXED.get(name, ()) + (extra or {}).get(name, ()), text) for name, rows in feed.items()}


def append(base: DataFrame, more: DataFrame) -> DataFrame:
    """All rows of both with base's columns; columns that only base has are null in more's rows."""
    return base.unionByName(more.select([c for c in base.columns if c in more.columns]), allowMissingColumns=True)


def operator_routes(feed: Feed, name: str) -> DataFrame:
    """Routes of the first agency (by agency_id) whose name contains name, whatever its case."""
    agency = feed["agency"].filter(F.col("agency_name").ilike(f"%{name}%")).orderBy("agency_id").limit(1)
    return feed["routes"].join(agency.select("agency_id"), "agency_id", "left_semi")


def restrict(feed: Feed, routes: DataFrame) -> Feed:
    """The part of a feed that serves routes: each table keeps the keys that the one before it kept."""
    trips = feed["trips"].join(routes.select("route_id"), "route_id", "left_semi")
    out = {"routes": routes, "trips": trips}
    out["stop_times"] = feed["stop_times"].join(trips.select("trip_id"), "trip_id", "left_semi")
    if "stops" in feed:
        out["stops"] = feed["stops"].join(out["stop_times"].select("stop_id"), "stop_id", "left_semi")
    if "shapes" in feed and "shape_id" in trips.columns:
        out["shapes"] = feed["shapes"].join(trips.filter("shape_id IS NOT NULL").select("shape_id"), "shape_id", "left_semi")
    if "calendar" in feed or "calendar_dates" in feed:
        out["calendar_dates"] = calendar.load(feed.get("calendar"), feed.get("calendar_dates"), trips)
    return out


def extract_operator(feed: Feed, name: str, text: str) -> Feed:
    """One operator's part of a feed, its trip, service, shape and stop ids prefixed, its route ids not."""
    return prefixed(restrict(feed, operator_routes(feed, name)), text)


def rail_prefix(route: Column, is_rail: Column, rail: str = "wkd_", other: str = "wkd_bus_") -> Column:
    return F.concat(F.when(is_rail, rail).otherwise(other), route)


def prefix_by_rail(trips: DataFrame, routes: DataFrame) -> DataFrame:
    """trips with route_id prefixed by whether the route's type is a rail type."""
    rail = routes.filter(F.trim("route_type").isin(*RAIL_TYPES)).select("route_id").distinct().withColumn("_rail", F.lit(True))
    return trips.join(rail, "route_id", "left").withColumn("route_id", rail_prefix(F.col("route_id"), F.coalesce("_rail", F.lit(False)))).select(trips.columns)


def merge_single(feed: Feed) -> Feed:
    return feed | {"calendar_dates": calendar.effective(feed.get("calendar"), feed.get("calendar_dates"))}


def merge_two_modes(bus: Feed, tram: Feed, text: str = "tram_", prefix_routes: bool = False) -> Feed:
    """Two feeds of a city; the second one's ids but the route ids get a prefix, so that equal route ids meet and the
    later row counts in lookups, unless prefix_routes is set. Calendars merge only where both feeds have the table."""
    tram = prefixed(tram, text, {"trips": ("route_id",), "routes": ("route_id",)} if prefix_routes else None)
    out = {name: append(bus[name], tram[name]) for name in ("trips", "stop_times", "stops", "routes") if name in bus and name in tram}
    for name in ("calendar", "calendar_dates"):
        if name in bus and name in tram:
            out[name] = append(bus[name], tram[name])
        elif name in bus:
            out[name] = bus[name]
    return merge_single(out)


def merge_base_and_rail(base: Feed, national: Feed, local: Feed, operator: str = "mazowieckie") -> Feed:
    """A city's feed with one operator of a national rail feed and with a local railway; routes stay those of the city,
    so that the others are classified by name."""
    km = extract_operator(national, operator, "km_")
    wkd = prefixed(local, "wkd_") | {"routes": local["routes"]}
    wkd["trips"] = prefix_by_rail(wkd["trips"], local["routes"])
    out = dict(base)
    for more in (km, wkd):
        for name in ("trips", "stop_times", "stops", "calendar_dates"):
            if name in out and name in more:
                out[name] = append(out[name], more[name])
    return out


MERGES = {"single": merge_single, "krakow": merge_two_modes, "warsaw": merge_base_and_rail}
