"""Departures: trips of a service day, headway services, and counts by stop."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.functions import classes, gtfs_time, vehicles
from tramline.operators import calendar

STOP_COUNTS = ("bus", "tram", "train", "metro", "unique_routes", "route_ids", "route_trip_counts", "trip_count")


def substrings(text: Column) -> Column:
    """All substrings of a text, the empty one included, as an array."""
    n = F.length(text)
    from_ = lambda i: F.transform(F.sequence(F.lit(1), n - i + 1), lambda k: F.substring(text, i, k))
    return F.array_append(F.when(n > 0, F.flatten(F.transform(F.sequence(F.lit(1), n), from_))).otherwise(F.array().cast("array<string>")), F.lit(""))


def trips_of_services(trips: DataFrame, services: DataFrame, exact: bool = False) -> DataFrame:
    """Trips whose service_id contains one of the services' ids (or equals it, if exact).

    The distinct ids of the trips, of which there are few as services are calendar patterns, go by their substrings, so
    that both joins are equi-joins.
    """
    services = services.filter("service_id IS NOT NULL").select(F.col("service_id").alias("active")).distinct()
    if exact:
        return trips.join(services, F.col("service_id") == F.col("active"), "left_semi")
    own = trips.select("service_id").filter("service_id IS NOT NULL").distinct()
    matched = own.select("service_id", F.explode(substrings(F.col("service_id"))).alias("active")).join(services, "active", "left_semi")
    return trips.join(matched.select("service_id"), "service_id", "left_semi").select(trips.columns)


def with_routes(stop_times: DataFrame, trips: DataFrame) -> DataFrame:
    """stop_times of the trips, with route_id; a trip with several routes gives a row for each."""
    return stop_times.join(trips.select("trip_id", "route_id").distinct(), "trip_id")


def expand_frequencies(frequencies: DataFrame, trips: DataFrame, stop_times: DataFrame, services: DataFrame) -> DataFrame:
    """trip_id, stop_id, arrival_time, departure_time, route_id of the departures of headway services.

    A departure takes place at every stop of the trip at its start time. Trips count if their service is active by
    exact id, among active ids that don't start with "20"; if there are none such, all trips count.
    """
    coded = services.filter(~F.col("service_id").startswith("20")).select("service_id").distinct()
    own = trips.join(frequencies.select("trip_id").distinct(), "trip_id", "left_semi")
    none = coded.agg(F.count(F.lit(1)) == 0).scalar()
    own = own.join(coded.withColumn("_active", F.lit(True)), "service_id", "left").filter(none | F.col("_active"))
    template = calendar.first_by(own, ["trip_id"], ["route_id", "service_id"]).select("trip_id", "route_id")
    start, end = gtfs_time.elapsed_seconds(F.col("start_time")), gtfs_time.elapsed_seconds(F.col("end_time"))
    head = F.col("headway_secs").cast("int")
    times = F.when((end > start) & (head > 0), F.sequence(start, end - 1, head)).otherwise(F.array().cast("array<int>"))
    at = gtfs_time.clock_text(F.col("t"))
    departures = frequencies.select("trip_id", F.explode(times).alias("t")).join(template, "trip_id")
    rows = departures.join(stop_times.select("trip_id", "stop_id"), "trip_id")
    return rows.select(F.concat("trip_id", F.lit("__"), F.col("t").cast("string")).alias("trip_id"), "stop_id", at.alias("arrival_time"), at.alias("departure_time"), "route_id")


def headway_totals(frequencies: DataFrame, trips: DataFrame) -> DataFrame:
    """route_id, total_trips, trips of headway services in the daily window, without listing departures."""
    n = gtfs_time.headway_trips(gtfs_time.elapsed_seconds(F.col("start_time")), gtfs_time.elapsed_seconds(F.col("end_time")), F.col("headway_secs"))
    by_trip = frequencies.groupBy("trip_id").agg(F.sum(n).alias("total_trips"))
    return by_trip.join(trips, "trip_id").groupBy("route_id").agg(F.sum("total_trips").alias("total_trips"), F.count(F.lit(1)).alias("trips"))


def in_window(rows: DataFrame, start: int = gtfs_time.WINDOW_START, end: int = gtfs_time.WINDOW_END) -> DataFrame:
    """Rows whose arrival_time is a time in [start, end), with it in seconds."""
    # none or one element to explode, as a filter beside a column would parse the text once for each mention
    seconds = F.filter(F.array(gtfs_time.clock_seconds(F.col("arrival_time"))), lambda s: gtfs_time.in_window(s, start, end))
    return rows.withColumn("seconds", F.explode(seconds))


def route_kinds(routes: DataFrame) -> DataFrame:
    """route_id (trimmed), kind by route_type; of repeated mapped ids the last row counts."""
    kinds = routes.select(F.trim("route_id").alias("_route"), vehicles.by_route_type(F.col("route_type")).alias("_kind"), F.monotonically_increasing_id().alias("_row"))
    return kinds.filter("_kind IS NOT NULL").groupBy("_route").agg(F.max_by("_kind", "_row").alias("_kind"))


def with_vehicle(rows: DataFrame, routes: DataFrame, rule: Callable[[Column], Column]) -> DataFrame:
    """rows with vehicle: from the routes table, else by the city's rule."""
    joined = rows.withColumn("_route", F.trim("route_id")).join(route_kinds(routes), "_route", "left")
    return joined.withColumn("vehicle", vehicles.classify(F.col("route_id"), F.col("_kind"), rule)).drop("_route", "_kind")


def kinds_of(trips: DataFrame, routes: DataFrame, rule: Callable[[Column], Column]) -> DataFrame:
    """route_id, vehicle of the routes that trips have."""
    return with_vehicle(trips.select("route_id").filter("route_id IS NOT NULL").distinct(), routes, rule)


def route_counts(departures: DataFrame, kinds: DataFrame) -> DataFrame:
    """stop_id, route_id, vehicle, n: the one aggregation over departures from which all stop figures follow; only its
    rows meet the kinds of routes (route_id, vehicle)."""
    counts = departures.filter("route_id IS NOT NULL AND stop_id IS NOT NULL").groupBy("stop_id", "route_id").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(kinds, "route_id").select("stop_id", "route_id", "vehicle", "n")


def stop_counts(counts: DataFrame) -> DataFrame:
    """A row a stop of counts (stop_id, route_id, vehicle, n): STOP_COUNTS."""
    kinds = [F.coalesce(F.sum(F.when(F.col("vehicle") == v, F.col("n"))), F.lit(0)).alias(v) for v in ("bus", "tram", "train", "metro")]
    by_route = F.struct("route_id", "n")
    rows = counts.groupBy("stop_id").agg(*kinds, F.array_sort(F.collect_list(by_route)).alias("routes"), F.countDistinct("route_id").alias("unique_routes"))
    return rows.select(
        "stop_id", "bus", "tram", "train", "metro", "unique_routes", F.array_join(F.array_distinct(F.transform("routes", lambda x: x["route_id"])), ",").alias("route_ids"),
        classes.encoded_counts(F.col("routes")).alias("route_trip_counts"), (F.col("bus") + F.col("tram") + F.col("train") + F.col("metro")).alias("trip_count"),
    )


def stops_with_service(stops: DataFrame, counts: DataFrame) -> DataFrame:
    return stops.join(stop_counts(counts), "stop_id").filter("trip_count > 0").select(*stops.columns, *STOP_COUNTS)


def departures(feed: dict[str, DataFrame], date: int, headways: bool = True) -> DataFrame:
    """stop_id, route_id, seconds of every departure of a feed in the daily window of a date. Headway services are those
    of the tables frequencies, and freq_trips and freq_stop_times where the feed has them apart."""
    services = calendar.active(feed["calendar_dates"], date)
    rows = with_routes(feed["stop_times"], trips_of_services(feed["trips"], services)).select("stop_id", "route_id", "arrival_time")
    if headways and "frequencies" in feed:
        more = expand_frequencies(feed["frequencies"], feed.get("freq_trips", feed["trips"]), feed.get("freq_stop_times", feed["stop_times"]), services)
        rows = rows.unionByName(more.select("stop_id", "route_id", "arrival_time"))
    return in_window(rows).drop("arrival_time")


def departure_counts(feed: dict[str, DataFrame], date: int, rule: Callable[[Column], Column], headways: bool = True) -> DataFrame:
    """route_counts of a feed's departures."""
    trips = feed["trips"].select("route_id")
    if "freq_trips" in feed:
        trips = trips.unionByName(feed["freq_trips"].select("route_id"))
    return route_counts(departures(feed, date, headways), kinds_of(trips, feed["routes"], rule))


def totals(stops: DataFrame) -> DataFrame:
    """One row over stops with service: how many, departures by kind and in all."""
    return stops.agg(F.count(F.lit(1)).alias("stops"), *[F.sum(c).alias(c) for c in ("bus", "tram", "train", "metro", "trip_count")])


def fill_zero(rows: DataFrame) -> DataFrame:
    """rows without nulls: 0 in columns of numbers, "0" in those of texts."""
    return rows.na.fill(0).na.fill("0")
