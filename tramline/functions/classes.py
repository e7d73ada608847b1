"""Lookups and small parsers: frequency classes, road ranks, building levels, railway kinds, encoded route counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The lower bounds of the frequency classes and their colours, index by index.
BREAKS = (1, 10, 25, 50, 80, 120, 170, 250, 350, 450, 600, 800, 1000, 1300, 1700, 2200, 2800, 3500)
LAST_BREAK = 100_000
COLORS = (
    (0, 12, 124), (0, 18, 149), (0, 21, 166), (66, 18, 166), (116, 10, 152), (149, 3, 143), (178, 0, 136), (205, 0, 129), (230, 8, 121),
    (249, 40, 112), (255, 71, 100), (255, 103, 87), (255, 132, 71), (255, 158, 51), (255, 181, 35), (255, 201, 28), (255, 221, 29), (255, 241, 35),
)
#: The rank of a road class; links share their road's.
ROADS = ("motorway", "trunk", "primary", "secondary", "tertiary", "unclassified", "residential", "living_street")
LINKED, OTHER_ROAD = ROADS[:5], 99
#: Classes drawn as major roads, and the columns that may hold the class, best first.
MAJOR_ROADS = ("ekspresowa", "glownaRuchuPrzyspieszonego", "glowna", "zbiorcza", "motorway", "trunk", "primary", "secondary")
ROAD_COLUMNS = ("highway", "KLASADROG", "fclass")
#: Minutes of reach by railway kind, in seconds.
TIME_LIMITS = {"tram": 480, "subway": 720, "light_rail": 720, "monorail": 720, "train": 900}
DEFAULT_LIMIT = 480


def frequency_class(value: Column) -> Column:
    """Index of the last break at or below the value, 0 for values below all."""
    return F.greatest(F.lit(0), F.size(F.filter(F.array(*map(F.lit, BREAKS)), lambda b: b <= value)) - 1)


def class_label(index: Column) -> Column:
    labels = [f"{lo} - {hi}" for lo, hi in zip(BREAKS, BREAKS[1:], strict=False)] + [f"{BREAKS[-1]}+"]
    return F.element_at(F.array(*map(F.lit, labels)), index + 1)


def road_rank(highway: Column) -> Column:
    ranks = {name: k for k, name in enumerate(ROADS, 1)} | {f"{name}_link": k for k, name in enumerate(LINKED, 1)}
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in ranks.items() for x in pair]), highway), F.lit(OTHER_ROAD))


def building_levels(text: Column) -> Column:
    return F.coalesce(text.try_cast("double"), F.lit(2.0))


def railway_kind(railway: Column, flags: dict[str, Column]) -> Column:
    """tram for tram_stop, else the first kind whose flag is yes, train last; null where none holds."""
    out = F.when(railway == "tram_stop", "tram")
    for kind in ("light_rail", "subway", "tram", "monorail", "train"):
        out = out.when(flags[kind] == "yes", kind)
    return out


def time_limit(kind: Column) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in TIME_LIMITS.items() for x in pair]), kind), F.lit(DEFAULT_LIMIT))


def route_counts(text: Column) -> Column:
    """array<struct<route_id, n>> of "route:count,..."; a part splits at its last colon, parts without a whole number
    are skipped, of repeated routes the last counts; null and empty give an empty array."""
    part = lambda p: F.struct(F.regexp_extract(p, r"^([\s\S]*):([^:]*)$", 1).alias("route_id"), F.trim(F.regexp_extract(p, r"^([\s\S]*):([^:]*)$", 2)).try_cast("bigint").alias("n"))
    parts = F.filter(F.transform(F.split(text, ","), part), lambda x: x["n"].isNotNull())
    last = F.filter(parts, lambda x, i: ~F.exists(F.slice(parts, i + 2, F.size(parts)), lambda y: y["route_id"] == x["route_id"]))
    return F.when(text.isNull() | (text == ""), F.array().cast("array<struct<route_id:string,n:bigint>>")).otherwise(last)


def encoded_counts(routes: Column) -> Column:
    """"route:count,..." by route, of array<struct<route_id, n>>."""
    return F.array_join(F.transform(F.array_sort(routes), lambda x: F.concat(x["route_id"], F.lit(":"), x["n"].cast("string"))), ",")
