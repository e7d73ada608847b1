"""Shapefiles: points, lines and polygons with their attribute table, read in parallel by file and written for results
of map size."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values of the format: shape type codes and the file code of the header.
KINDS = {0: "Null", 1: "Point", 3: "LineString", 5: "Polygon"}
FILE_CODE, VERSION = 9994, 1000
#: What an attribute and its name can hold, in bytes.
WIDEST, LONGEST = 254, 10
SCHEMA = "file string, record long, kind string, parts array<array<array<double>>>, properties map<string,string>"


def shapes(content: bytes) -> Iterator[tuple[str, list[list[list[float]]]]]:
    """Kind and parts (point lists) of every record of a main file."""
    at = 100
    while at + 8 <= len(content):
        size = struct.unpack(">i", content[at + 4 : at + 8])[0] * 2
        body = content[at + 8 : at + 8 + size]
        at += 8 + size
        code = struct.unpack("<i", body[:4])[0] % 10  # the last digit is the kind, the others say Z and M
        if code == 1:
            yield "Point", [[list(struct.unpack("<2d", body[4:20]))]]
        elif code in (3, 5):
            n, points = struct.unpack("<2i", body[36:44])
            starts = [*struct.unpack(f"<{n}i", body[44 : 44 + 4 * n]), points]
            flat = struct.unpack(f"<{2 * points}d", body[44 + 4 * n : 44 + 4 * n + 16 * points])
            xy = [list(p) for p in zip(flat[::2], flat[1::2], strict=True)]
            yield KINDS[code], [xy[a:b] for a, b in zip(starts, starts[1:], strict=False)]
        else:
            yield "Null", []


def attributes(content: bytes, encoding: str = "utf-8") -> Iterator[dict[str, str | None] | None]:
    """The rows of a dBASE table as text, None for a deleted one; empty fields are null."""
    rows, head, width = struct.unpack("<IHH", content[4:12])
    fields = []
    for at in range(32, head - 1, 32):
        if content[at] == 0x0D:
            break
        fields.append((content[at : at + 11].split(b"\0")[0].decode(encoding, "replace"), content[at + 16]))
    for k in range(rows):
        row = content[head + k * width : head + (k + 1) * width]
        if row[:1] == b"*":
            yield None
            continue
        out, at = {}, 1
        for name, size in fields:
            out[name] = row[at : at + size].decode(encoding, "replace").strip(" \0") or None
            at += size
        yield out


def read_shapefile(spark: SparkSession, uri: str, encoding: str = "utf-8") -> DataFrame:
    """SCHEMA of the records of the .shp files at uri, with the row at the same place of the .dbf beside each; records
    whose row is deleted are left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for name, shp, dbf in zip(pdf["file"], pdf["shp"], pdf["dbf"], strict=True):
                table = list(attributes(bytes(dbf), encoding)) if dbf is not None else []
                found = ((k, kind, parts, table[k] if k < len(table) else {}) for k, (kind, parts) in enumerate(shapes(bytes(shp))))
                rows += [(name, k, kind, parts, row) for k, kind, parts, row in found if row is not None]
            yield pd.DataFrame(rows, columns=["file", "record", "kind", "parts", "properties"])

    def load(kind: str) -> DataFrame:
        df = spark.read.format("binaryFile").load(uri.removesuffix(".shp") + "." + kind)
        return df.select(F.regexp_replace("path", r"\.\w+$", "").alias("file"), F.col("content").alias(kind))

    return load("shp").join(load("dbf"), "file", "left").select("file", "shp", "dbf").mapInPandas(run, SCHEMA)


def write_shapefile(kind: str, rows: list[tuple[list[list[tuple[float, float]]], dict[str, str | None]]]) -> dict[str, bytes]:
    """The .shp, .shx and .dbf of parts and attributes; polygons' rings as given.

    The format holds attributes of at most WIDEST bytes under names of at most LONGEST bytes; longer ones are an error.
    """
    code = {v: k for k, v in KINDS.items()}[kind]
    records, box = [], [float("inf"), float("inf"), float("-inf"), float("-inf")]
    for parts, _ in rows:
        flat = [p for part in parts for p in part]
        own = [min(p[0] for p in flat), min(p[1] for p in flat), max(p[0] for p in flat), max(p[1] for p in flat)]
        box = [*map(min, box[:2], own[:2]), *map(max, box[2:], own[2:])]
        if kind == "Point":
            records.append(struct.pack("<i2d", code, *flat[0]))
        else:
            starts = [sum(map(len, parts[:k])) for k in range(len(parts))]
            records.append(struct.pack("<i4d2i", code, *own, len(parts), len(flat)) + struct.pack(f"<{len(parts)}i", *starts) + b"".join(struct.pack("<2d", *p) for p in flat))
    body, index, at = b"", b"", 50
    for k, r in enumerate(records):
        head = struct.pack(">2i", k + 1, len(r) // 2)
        body, index, at = body + head + r, index + struct.pack(">2i", at, len(r) // 2), at + (8 + len(r)) // 2
    header = lambda n: struct.pack(">i5ii", FILE_CODE, 0, 0, 0, 0, 0, (100 + n) // 2) + struct.pack("<2i8d", VERSION, code, *(box if rows else [0] * 4), 0, 0, 0, 0)
    names = list(rows[0][1]) if rows else []
    cells = [[("" if p[n] is None else str(p[n])).encode() for n in names] for _, p in rows]
    for n in names:
        if len(n.encode()) > LONGEST:
            raise ValueError(f"attribute name {n!r} has more than {LONGEST} bytes, which a shapefile can't hold")
    for k, row in enumerate(cells):
        for n, c in zip(names, row, strict=True):
            if len(c) > WIDEST:
                raise ValueError(f"attribute {n!r} of record {k} has {len(c)} bytes, a shapefile holds at most {WIDEST}")
    wide = [max([1, *(len(c[k]) for c in cells)]) for k in range(len(names))]
    fields = b"".join(struct.pack("<11sc4xBB14x", n.encode(), b"C", w, 0) for n, w in zip(names, wide, strict=True))
    table = struct.pack("<B3BIHH20x", 3, 126, 1, 1, len(rows), 33 + len(fields), 1 + sum(wide)) + fields + b"\r"
    table += b"".join(b" " + b"".join(c.ljust(w) for c, w in zip(row, wide, strict=True)) for row in cells) + b"\x1a"
    return {"shp": header(len(body)) + body, "shx": header(len(index)) + index, "dbf": table}


def append_shapefile(files: dict[str, bytes], kind: str, rows: list[tuple[list[list[tuple[float, float]]], dict[str, str | None]]]) -> dict[str, bytes]:
    """The files of a shapefile with rows of the same kind added; a name that one side lacks is empty there."""
    table = list(attributes(files["dbf"]))
    old = [([[tuple(p) for p in part] for part in parts], table[k]) for k, (_, parts) in enumerate(shapes(files["shp"])) if parts and table[k] is not None]
    names = list(dict.fromkeys(n for _, row in (*old, *rows) for n in row))
    return write_shapefile(kind, [(parts, {n: row.get(n) for n in names}) for parts, row in (*old, *rows)])
