"""Feeds and map files as DataFrames, and sinks. Paths are URIs of any store that Spark reads."""

from __future__ import annotations

import posixpath
import shutil
import sqlite3
import struct
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns with a type of their own; every other column of a timetable file is a string.
TYPED = {"stop_lat": "double", "stop_lon": "double", "stop_sequence": "int", "date": "int", "exception_type": "int", "start_date": "int", "end_date": "int", "headway_secs": "int"} | dict.fromkeys(
    ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"), "int"
)
PIECE = 1 << 20
TABLES = ("agency", "calendar", "calendar_dates", "frequencies", "routes", "shapes", "stop_times", "stops", "trips")


def _path(spark: SparkSession, uri: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, uri: str) -> bool:
    path, store = _path(spark, uri)
    return store.exists(path)


def read_csv(spark: SparkSession, uri: str) -> DataFrame:
    """A timetable file: header, identifiers as strings whatever they look like, a byte order mark dropped."""
    df = spark.read.csv(uri, header=True)
    df = df.toDF(*[c.lstrip("﻿").strip() for c in df.columns])
    return df.withColumns({c: F.trim(c).try_cast(TYPED[c]) for c in df.columns if c in TYPED})


def read_feed(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The timetable tables that a folder holds."""
    found = {name: f"{folder.rstrip('/')}/{name}.txt" for name in TABLES}
    return {name: read_csv(spark, uri) for name, uri in found.items() if exists(spark, uri)}


def latest_snapshot(spark: SparkSession, root: str, marker: str = "stops.txt") -> str:
    """The last folder by name, of those under root that hold the marker file."""
    path, store = _path(spark, root)
    names = [s.getPath().toString() for s in store.listStatus(path) if s.isDirectory()] if store.exists(path) else []
    names = [n for n in names if exists(spark, f"{n}/{marker}")]
    if not names:
        raise FileNotFoundError(f"no folder with {marker} under {root}")
    return max(names, key=posixpath.basename)


def unzip(spark: SparkSession, archives: str, target: str) -> DataFrame:
    """Extracts zip archives to target/NAME/; path and bytes of what was written. Archives are read in parallel,
    and members piece by piece."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path in pdf["path"]:
                store, root = fs.FileSystem.from_uri(target)
                folder = posixpath.join(root, posixpath.basename(path).removesuffix(".zip"))
                store.create_dir(folder)
                source, at = fs.FileSystem.from_uri(_uri(path))
                with source.open_input_file(at) as archive, zipfile.ZipFile(archive) as z:
                    for item in z.infolist():
                        name = posixpath.basename(item.filename)
                        if name and not item.is_dir():
                            with store.open_output_stream(posixpath.join(folder, name)) as out, z.open(item) as member:
                                shutil.copyfileobj(member, out, PIECE)
                            rows.append((posixpath.join(folder, name), item.file_size))
            yield pd.DataFrame(rows, columns=["path", "bytes"])

    return spark.read.format("binaryFile").load(archives).select("path").mapInPandas(run, "path string, bytes long")


def _uri(path: str) -> str:
    """A path as Spark lists it, as pyarrow takes it."""
    return "file:///" + path.removeprefix("file:").lstrip("/") if path.startswith("file:") else path


def write_graph(nodes: DataFrame, edges: DataFrame, uri: str) -> None:
    """The Parquet form of a walking network, under uri."""
    nodes.select("node_id", "x", "y").write.mode("overwrite").parquet(f"{uri.rstrip('/')}/nodes")
    edges.select("src", "dst", "length").write.mode("overwrite").parquet(f"{uri.rstrip('/')}/edges")


def load_graph(spark: SparkSession, folder: str, name: str = "walk.graphml") -> tuple[DataFrame, DataFrame] | None:
    """nodes and edges of a folder: from the Parquet form, else from the GraphML file, else None."""
    folder = folder.rstrip("/")
    if exists(spark, f"{folder}/nodes/_SUCCESS") and exists(spark, f"{folder}/edges/_SUCCESS"):
        return spark.read.parquet(f"{folder}/nodes"), spark.read.parquet(f"{folder}/edges")
    return read_graph(spark, f"{folder}/{name}") if exists(spark, f"{folder}/{name}") else None


def graphml(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """text: the lines of a GraphML file, nodes before edges, for write_text."""
    value = lambda key, c: F.concat(F.lit(f'<data key="{key}">'), F.col(c).cast("string"), F.lit("</data>"))
    head = (
        '<?xml version="1.0" encoding="utf-8"?><graphml xmlns="http://graphml.graphdrawing.org/xmlns"><key id="x" for="node" attr.name="x" attr.type="double"/><key id="y" for="node" attr.name="y" attr.type="double"/>'
        '<key id="length" for="edge" attr.name="length" attr.type="double"/><graph edgedefault="directed">'
    )
    one = nodes.sparkSession.range(1)
    node = nodes.select(F.lit(1).alias("k"), F.concat(F.lit('<node id="'), F.col("node_id").cast("string"), F.lit('">'), value("x", "x"), value("y", "y"), F.lit("</node>")).alias("text"))
    edge = edges.select(F.lit(2).alias("k"), F.concat(F.lit('<edge source="'), F.col("src").cast("string"), F.lit('" target="'), F.col("dst").cast("string"), F.lit('">'), value("length", "length"), F.lit("</edge>")).alias("text"))
    rows = one.select(F.lit(0).alias("k"), F.lit(head).alias("text")).unionByName(node).unionByName(edge).unionByName(one.select(F.lit(3).alias("k"), F.lit("</graph></graphml>").alias("text")))
    return rows.orderBy("k", "text").select("text")


def read_graph(spark: SparkSession, uri: str) -> tuple[DataFrame, DataFrame]:
    """nodes (node_id, x, y) and edges (src, dst, length) of a GraphML file; keys are resolved by their names."""
    keys = {r["_id"]: r["_attr.name"] for r in spark.read.format("xml").option("rowTag", "key").load(uri).select("_id", "`_attr.name`").collect()}  # a handful, of the header
    data = "array<struct<_key:string,_VALUE:string>>"
    value = lambda name: F.get(F.filter("data", lambda d: d["_key"].isin(*[k for k, n in keys.items() if n == name])), F.lit(0))["_VALUE"].try_cast("double")
    read = lambda tag, schema: spark.read.format("xml").option("rowTag", tag).schema(schema).load(uri)
    nodes = read("node", f"_id bigint, data {data}").select(F.col("_id").alias("node_id"), value("x").alias("x"), value("y").alias("y"))
    edges = read("edge", f"_source bigint, _target bigint, data {data}").select(F.col("_source").alias("src"), F.col("_target").alias("dst"), value("length").alias("length"))
    return nodes, edges


# ---- GeoPackage: an SQLite file, read in memory by whichever task gets it


def read_geopackage(spark: SparkSession, uri: str, layer: str | None = None) -> DataFrame:
    """layer, fid, properties (map of strings), xmin, xmax, ymin, ymax, wkb of the features of a file's layers."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names_ = ["layer", "fid", "properties", "xmin", "xmax", "ymin", "ymax", "wkb"]
        for pdf in batches:
            for content in pdf["content"]:
                rows: list[tuple] = []
                con = sqlite3.connect(":memory:")
                con.deserialize(bytes(content))
                for table, column in con.execute("SELECT table_name, column_name FROM gpkg_geometry_columns").fetchall():
                    if layer and table != layer:
                        continue
                    cur = con.execute(f'SELECT * FROM "{table}"')
                    names = [d[0] for d in cur.description]
                    for row in cur:
                        values = dict(zip(names, row, strict=True))
                        blob, fid = values.pop(column), values.pop("fid", None)
                        box, wkb = _geometry(blob)
                        rows.append((table, fid, {k: None if v is None else str(v) for k, v in values.items()}, *box, wkb))
                        if len(rows) == 5000:
                            yield pd.DataFrame(rows, columns=names_)
                            rows = []
                con.close()
                yield pd.DataFrame(rows, columns=names_)

    schema = "layer string, fid long, properties map<string,string>, xmin double, xmax double, ymin double, ymax double, wkb binary"
    return spark.read.format("binaryFile").load(uri).select("content").mapInPandas(run, schema)


def _geometry(blob: bytes | None) -> tuple[tuple, bytes | None]:
    """Bounds and WKB of a GeoPackage geometry; bounds are null where the header has none."""
    if not blob:
        return (None,) * 4, None
    order = "<" if blob[3] & 1 else ">"
    kind = blob[3] >> 1 & 7
    size = (0, 32, 48, 48, 64)[kind]
    box = struct.unpack(order + "4d", blob[8:40]) if kind else (None,) * 4
    return box, blob[8 + size :]


def polygon_wkb(rings: list[list[tuple[float, float]]]) -> bytes:
    out = struct.pack("<BII", 1, 3, len(rings))
    for ring in rings:
        out += struct.pack("<I", len(ring)) + b"".join(struct.pack("<2d", *p) for p in ring)
    return out


def polygons_wkb(polygons: list[list[list[tuple[float, float]]]]) -> bytes:
    """A polygon, or a collection of polygons if there are several."""
    if len(polygons) == 1:
        return polygon_wkb(polygons[0])
    return struct.pack("<BII", 1, 6, len(polygons)) + b"".join(map(polygon_wkb, polygons))


def wkb_polygons(wkb: bytes) -> list[list[list[tuple[float, float]]]]:
    """The polygons of a polygon or collection of polygons, of either byte order; none of other kinds."""

    def read(at: int) -> tuple[list, int]:
        order = "<" if wkb[at] else ">"
        kind, n = struct.unpack(order + "II", wkb[at + 1 : at + 9])
        at += 9
        out = []
        for _ in range(n if kind in (3, 6) else 0):
            if kind == 6:
                own, at = read(at)
                out += own
            else:
                many = struct.unpack(order + "I", wkb[at : at + 4])[0]
                flat = struct.unpack(f"{order}{2 * many}d", wkb[at + 4 : at + 4 + 16 * many])
                out.append(list(zip(flat[::2], flat[1::2], strict=True)))
                at += 4 + 16 * many
        return ([out] if kind == 3 else out), at

    return read(0)[0]


class GeoPackage:
    """A GeoPackage file with one layer, being written; rows are plain values in the order of names, and a WKB or None."""

    def __init__(self, layer: str, names: list[str], srid: int = 4326, geometry: str = "geom"):
        self.con, self.srid, self.box = sqlite3.connect(":memory:"), srid, None
        self.con.executescript(
            "PRAGMA application_id = 1196444487;"
            "CREATE TABLE gpkg_spatial_ref_sys (srs_name TEXT, srs_id INTEGER PRIMARY KEY, organization TEXT, organization_coordsys_id INTEGER, definition TEXT, description TEXT);"
            "CREATE TABLE gpkg_contents (table_name TEXT PRIMARY KEY, data_type TEXT, identifier TEXT, description TEXT, last_change TEXT, min_x DOUBLE, min_y DOUBLE, max_x DOUBLE, max_y DOUBLE, srs_id INTEGER);"
            "CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT, geometry_type_name TEXT, srs_id INTEGER, z TINYINT, m TINYINT);"
            f'CREATE TABLE "{layer}" (fid INTEGER PRIMARY KEY AUTOINCREMENT, "{geometry}" BLOB' + "".join(f', "{n}"' for n in names) + ");"
        )
        self.con.execute("INSERT INTO gpkg_spatial_ref_sys VALUES (?, ?, 'EPSG', ?, 'undefined', NULL)", (f"EPSG:{srid}", srid, srid))
        self.con.execute("INSERT INTO gpkg_contents (table_name, data_type, identifier, srs_id) VALUES (?, 'features', ?, ?)", (layer, layer, srid))
        self.con.execute("INSERT INTO gpkg_geometry_columns VALUES (?, ?, 'GEOMETRY', ?, 0, 0)", (layer, geometry, srid))
        self.insert = f'INSERT INTO "{layer}" ("{geometry}"' + "".join(f', "{n}"' for n in names) + ") VALUES (?" + ", ?" * len(names) + ")"

    def add(self, values: list, wkb: bytes | None, box: tuple[float, float, float, float] | None = None) -> None:
        """box: xmin, xmax, ymin, ymax, for the geometry's header."""
        head = struct.pack("<BBi", 0, 3, self.srid) + struct.pack("<4d", *box) if box else struct.pack("<BBi", 0, 1, self.srid)
        self.con.execute(self.insert, (None if wkb is None else b"GP" + head + bytes(wkb), *values))
        if box:
            own = self.box or box
            self.box = (min(own[0], box[0]), max(own[1], box[1]), min(own[2], box[2]), max(own[3], box[3]))

    def bytes(self) -> bytes:
        if self.box:
            x1, x2, y1, y2 = self.box
            self.con.execute("UPDATE gpkg_contents SET min_x = ?, max_x = ?, min_y = ?, max_y = ?", (x1, x2, y1, y2))
        self.con.commit()
        return self.con.serialize()


def geopackage(layer: str, rows: list[dict], srid: int = 4326, geometry: str = "geom") -> bytes:
    """A GeoPackage file of rows that hold a WKB (or None) under geometry and plain values besides."""
    names = [k for k in rows[0] if k != geometry] if rows else []
    out = GeoPackage(layer, names, srid, geometry)
    for row in rows:
        out.add([row[n] for n in names], row.get(geometry))
    return out.bytes()


def write_geopackage(df: DataFrame, uri: str, layer: str, polygons: str = "polygons", srid: int = 4326) -> int:
    """Rows with polygons (or null) as a layer of a GeoPackage file at uri; how many. The rows go through one task, which
    holds the file until it is whole: for results of the size of a city's map. Larger ones belong in Parquet."""
    names = [c for c in df.columns if c != polygons]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, n = GeoPackage(layer, names, srid), 0
        for pdf in batches:
            for *values, shape in zip(*(pdf[c] for c in (*names, polygons)), strict=True):
                values = [v.item() if hasattr(v, "item") else v for v in values]
                found = [[[(p["x"], p["y"]) for p in ring] for ring in polygon] for polygon in shape] if shape is not None and len(shape) else None
                xs, ys = zip(*(p for polygon in found for p in polygon[0]), strict=True) if found else ((), ())
                out.add(values, polygons_wkb(found) if found else None, (min(xs), max(xs), min(ys), max(ys)) if found else None)
                n += 1
        write_bytes(uri, out.bytes())
        yield pd.DataFrame({"n": [n]})

    rows = df.select(*names, polygons)
    return rows.coalesce(1).mapInPandas(run, "n long").agg(F.sum("n")).first()[0] or 0


# ---- sinks


def write_csv(df: DataFrame, uri: str, one_file: bool = True) -> None:
    """CSV with a header; one file only for results of report size."""
    (df.coalesce(1) if one_file else df).write.mode("overwrite").csv(uri, header=True)


def write_once(df: DataFrame, uri: str) -> bool:
    """Parquet, unless the target exists already; whether it was written."""
    if exists(df.sparkSession, uri):
        return False
    df.write.parquet(uri)
    return True


def geojson_features(df: DataFrame, lon: str, lat: str, properties: list[str]) -> DataFrame:
    """feature: a GeoJSON point feature as text for each row."""
    point = F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates"))
    return df.select(F.to_json(F.struct(F.lit("Feature").alias("type"), point.alias("geometry"), F.struct(*properties).alias("properties"))).alias("feature"))


def geojson_areas(df: DataFrame, polygons: str, properties: list[str]) -> DataFrame:
    """feature: a GeoJSON feature as text for each row with polygons."""
    rings = F.transform(F.col(polygons), lambda polygon: F.transform(polygon, lambda ring: F.transform(ring, lambda p: F.array(p["x"], p["y"]))))
    shape = F.struct(F.lit("MultiPolygon").alias("type"), rings.alias("coordinates"))
    return df.select(F.to_json(F.struct(F.lit("Feature").alias("type"), shape.alias("geometry"), F.struct(*properties).alias("properties"))).alias("feature"))


def write_text(rows: DataFrame, uri: str, head: str = "", between: str = "\n", tail: str = "\n") -> int:
    """The texts of rows' only column, in their order, as one file at uri, row by row through one task; how many."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, path = fs.FileSystem.from_uri(uri)
        store.create_dir(posixpath.dirname(path))
        n = 0
        with store.open_output_stream(path) as out:
            out.write(head.encode())
            for pdf in batches:
                for text in pdf.iloc[:, 0]:
                    out.write(((between if n else "") + text).encode())
                    n += 1
            out.write(tail.encode())
        yield pd.DataFrame({"n": [n]})

    return rows.coalesce(1).mapInPandas(run, "n long").agg(F.sum("n")).first()[0] or 0


def write_feature_collection(features: DataFrame, uri: str) -> int:
    """A GeoJSON file of features (see geojson_features, geojson_areas); how many."""
    return write_text(features.select("feature"), uri, '{"type":"FeatureCollection","features":[', ",\n", "]}\n")


def write_bytes(uri: str, content: bytes) -> None:
    store, path = fs.FileSystem.from_uri(uri)
    store.create_dir(posixpath.dirname(path))
    with store.open_output_stream(path) as out:
        out.write(content)
