"""The supported cities."""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column

from tramline.functions import vehicles


@dataclass(frozen=True)
class City:
    key: str
    name: str
    bbox: tuple[float, float, float, float]  # south, west, north, east
    crs: str
    merge: str
    classify: Callable[[Column], Column]
    frequencies: bool
    #: xmin, xmax, ymin, ymax in crs
    extent: tuple[float, float, float, float] | None = None
    #: feed name to address; none is set here, and none is fetched without one
    feeds: dict[str, str] = field(default_factory=dict)

    def folder(self, root: str, kind: str = "data") -> str:
        return f"{root.rstrip('/')}/{kind}/{self.key}"


#: Bounds, metric systems and merge rules.
CITIES = {
    c.key: c
    for c in (
        City("warsaw", "Warszawa", (52.0977, 20.8519, 52.3690, 21.2711), "EPSG:2180", "warsaw", vehicles.warsaw, True, (623233.8, 651733.8, 477610.7, 500410.7)),
        City("poznan", "Poznań", (52.30, 16.73, 52.50, 17.10), "EPSG:2180", "single", vehicles.poznan, False),
        City("krakow", "Kraków", (49.97, 19.79, 50.13, 20.13), "EPSG:2180", "krakow", vehicles.krakow, False),
        City("gdansk", "Trójmiasto", (54.28, 18.45, 54.52, 18.82), "EPSG:2180", "single", vehicles.gdansk, False),
        City("berlin", "Berlin", (52.34, 13.09, 52.68, 13.76), "EPSG:25833", "single", vehicles.berlin, True),
    )
}


class UnknownCity(KeyError):
    """No such city is supported."""


def get_city(name: str) -> City:
    """The city of a key, whatever its case and the space around it."""
    wanted = name.strip().casefold()
    for city in CITIES.values():
        if city.key == wanted:
            return city
    raise UnknownCity(f"{name!r} is none of " + " ".join(CITIES))


def list_cities() -> list[tuple[str, str]]:
    """Key and name of every city, in the table's order."""
    return [(city.key, city.name) for city in CITIES.values()]


def add_city_argument(parser: argparse.ArgumentParser) -> argparse.ArgumentParser:
    parser.add_argument("--city", choices=tuple(CITIES), type=lambda text: text.strip().casefold(), default=next(iter(CITIES)))
    return parser
