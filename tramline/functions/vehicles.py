"""Vehicle kinds from route types, from the naming rules of five cities, and from trip identifiers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The feed's route_type codes.
ROUTE_TYPES = {"0": "tram", "1": "metro", "2": "train", "3": "bus", "5": "bus", "7": "bus", "11": "bus", "12": "train"}
VEHICLES = ("bus", "tram", "train", "metro")


def by_route_type(route_type: Column) -> Column:
    """Kind of a route_type, null where the code isn't mapped."""
    kinds = F.create_map(*[F.lit(x) for pair in ROUTE_TYPES.items() for x in pair])
    return F.try_element_at(kinds, F.trim(route_type))


def _number_below_100(route: Column) -> Column:
    return route.rlike("^[0-9]+$") & (F.length(F.regexp_replace(route, "^0+", "")) <= 2)


def _prefixed(route: Column, *prefixes: str) -> Column:
    return F.upper(route).rlike("^(" + "|".join(prefixes) + ")")


def warsaw(route: Column) -> Column:
    r = F.trim(route)
    train = r.rlike("^[SR]") | (r.startswith("KM_R") & ~r.contains("_BUS")) | (r.startswith("wkd_") & ~r.contains("bus"))
    return F.when(r.rlike("^M[0-9]+$"), "metro").when(r.rlike("^[0-9]{1,2}$"), "tram").when(r.rlike("^[0-9]{3}$"), "bus").when(train, "train").otherwise("bus")


def _numbered(*train_prefixes: str) -> Callable[[Column], Column]:
    def rule(route: Column) -> Column:
        r = F.trim(route)
        return F.when(_number_below_100(r), "tram").when(_prefixed(r, *train_prefixes), "train").otherwise("bus")

    return rule


poznan = _numbered("S", "R", "KW")
krakow = _numbered("S", "R", "SKA")
gdansk = _numbered("S", "R", "SKM", "PKM")


def berlin(route: Column) -> Column:
    r = F.trim(route)
    return F.when(r.rlike("^U[0-9]"), "metro").when(r.rlike("^S[0-9]"), "train").when(r.rlike("^M[0-9]") | _number_below_100(r), "tram").otherwise("bus")


def by_trip_id(trip: Column) -> Column:
    """Kind from the line part of a slash-separated trip identifier; the first rule that holds counts."""
    return (
        F.when(trip.rlike("/[0-9]{1,2}/"), "tram").when(trip.rlike("/[0-9]{3}/"), "bus").when(trip.rlike(r"/(L|E|Z)[-\w]{1,3}/"), "bus")
        .when(trip.rlike("/S[0-9]{1,2}/"), "train").when(trip.rlike("/N[0-9]{1,2}/"), "night_bus").otherwise("Unknown")
    )


def classify(route: Column, looked_up: Column, rule: Callable[[Column], Column]) -> Column:
    """The kind that the routes table gives, else the city's rule."""
    return F.coalesce(looked_up, rule(route))
