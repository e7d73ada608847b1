"""Maps as PNG pictures: shapes are rasterised in parallel into spans of pixel rows; only pixel rows come to the driver."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.functions import classes
from tramline.operators import styles

#: Colours of the dark map, opacity and, of lines, width in points.
BACKGROUND = (0x11, 0x11, 0x11)
GREEN, WATER, BUILDING = (0x0F, 0x1E, 0x0F), (0x0A, 0x15, 0x20), (0x22, 0x22, 0x22)
ROAD, MAJOR_ROAD, RAIL = (0x1A, 0x1A, 0x1A), (0x25, 0x25, 0x25), (0x20, 0x1D, 0x1A)
AREAS = {
    "allotments": (GREEN, 0.5), "grass": (GREEN, 0.5), "meadow": (GREEN, 0.5), "leisure_relations": (GREEN, 0.5), "cemeteries": (GREEN, 0.5),
    "parks": (GREEN, 0.7), "forests": (GREEN, 0.7), "water": (WATER, 1.0), "buildings": (BUILDING, 1.0),
}
LINES = {"roads": (ROAD, 0.8), "major_roads": (MAJOR_ROAD, 0.9), "railways": (RAIL, 0.7)}
ORDER = ("allotments", "grass", "meadow", "leisure_relations", "cemeteries", "parks", "forests", "water", "coverage", "buildings", "roads", "major_roads", "railways")


@dataclass(frozen=True)
class Frame:
    """The part of the map that a picture shows, in metres, and its width in pixels."""

    xmin: float
    xmax: float
    ymin: float
    ymax: float
    width: int

    @property
    def size(self) -> float:
        """Metres of a pixel."""
        return (self.xmax - self.xmin) / self.width

    @property
    def height(self) -> int:
        return max(1, round((self.ymax - self.ymin) / self.size))


def polygon_spans(polygon: list, frame: Frame) -> Iterator[tuple[int, int, int]]:
    """Pixel row, first and past-last pixel whose centres lie in a polygon (rings of points x, y)."""
    ends = [(a, b) for ring in polygon for a, b in zip(ring, ring[1:], strict=False) if a[1] != b[1]]
    if not ends:
        return
    rows = lambda y: (frame.ymax - y) / frame.size - 0.5
    top, low = max(0, int(np.ceil(rows(max(p[1] for e in ends for p in e))))), min(frame.height - 1, int(np.floor(rows(min(p[1] for e in ends for p in e)))))
    for row in range(top, low + 1):
        y = frame.ymax - (row + 0.5) * frame.size
        cuts = sorted(x1 + (y - y1) * (x2 - x1) / (y2 - y1) for (x1, y1), (x2, y2) in ends if (y1 > y) != (y2 > y))
        for a, b in zip(cuts[::2], cuts[1::2], strict=False):
            first, last = (max(0, min(frame.width, int(np.ceil((x - frame.xmin) / frame.size - 0.5)))) for x in (a, b))
            if last > first:
                yield row, first, last


def line_spans(line: list, frame: Frame) -> Iterator[tuple[int, int, int]]:
    """Pixels that a line of points x, y goes through, one a span."""
    for (x1, y1), (x2, y2) in zip(line, line[1:], strict=False):
        n = int(max(abs(x2 - x1), abs(y2 - y1)) / frame.size * 2) + 1
        for k in range(n + 1):
            px, py = (x1 + (x2 - x1) * k / n - frame.xmin) / frame.size, (frame.ymax - y1 - (y2 - y1) * k / n) / frame.size
            if 0 <= px < frame.width and 0 <= py < frame.height:
                yield int(py), int(px), int(px) + 1


def layer(shapes: DataFrame, frame: Frame, value: str | None = None, lines: bool = False) -> np.ndarray:
    """For each pixel the largest value (an int column, of at most 255; else 1) of the shapes there, 0 for none. shapes:
    polygons as in regions, or with lines an array of lines, in metres."""

    def spans(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for shape, n in zip(pdf["shape"], pdf["value"], strict=True):
                for part in shape if shape is not None else []:
                    found = line_spans([(p["x"], p["y"]) for p in part], frame) if lines else polygon_spans([[(p["x"], p["y"]) for p in ring] for ring in part], frame)
                    out += [(*span, n) for span in found]
            yield pd.DataFrame(out, columns=["row", "first", "last", "value"])

    def paint(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        row = np.zeros(frame.width, np.uint8)
        for a, b, n in pdf.sort_values("value")[["first", "last", "value"]].itertuples(index=False):
            row[a:b] = n
        return pd.DataFrame({"row": [key[0]], "pixels": [row.tobytes()]})

    rows = shapes.select(F.col("lines" if lines else "polygons").alias("shape"), (F.col(value) if value else F.lit(1)).cast("int").alias("value"))
    rows = rows.mapInPandas(spans, "row int, first int, last int, value int").distinct()
    out = np.zeros((frame.height, frame.width), np.uint8)
    for r in rows.groupBy("row").applyInPandas(paint, "row int, pixels binary").collect():  # a row of the picture each
        out[r["row"]] = np.frombuffer(r["pixels"], np.uint8)
    return out


def draw(frame: Frame, layers: dict[str, DataFrame], colors: tuple[tuple[int, int, int], ...] = classes.COLORS) -> np.ndarray:
    """The picture (height, width, 3) of layers by name, in ORDER; coverage has deduped_trips."""
    out = np.empty((frame.height, frame.width, 3))
    out[:] = BACKGROUND
    for name in ORDER:
        if name not in layers:
            continue
        if name == "coverage":
            found = layer(styles.coloured(layers[name], colors).withColumn("value", F.col("class") + 1), frame, "value")
            colour, opacity = np.array([BACKGROUND, *colors])[found], styles.COVERAGE_OPACITY
        else:
            colour, opacity = AREAS.get(name) or LINES[name]
            found = layer(layers[name], frame, lines=name in LINES)
        out = np.where((found > 0)[:, :, None], out * (1 - opacity) + np.asarray(colour) * opacity, out)
    return np.round(out).astype(np.uint8)


def png(picture: np.ndarray) -> bytes:
    """A PNG file of a picture (height, width, 3)."""
    height, width, _ = picture.shape
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    rows = np.concatenate([np.zeros((height, 1), np.uint8), picture.reshape(height, -1)], axis=1).tobytes()
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">2I5B", width, height, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows, 6)) + chunk(b"IEND", b"")
