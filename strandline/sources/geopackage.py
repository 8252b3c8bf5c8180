"""GeoPackage files: SQLite tables with binary geometries, read on executors, one file a task."""

import sqlite3
import struct

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

#: A file is held by one task; larger ones should be split by layer or area first.
MAX_BYTES = 1 << 30
SCHEMA = "file string, properties map<string,string>, kind string, part int, points array<struct<x:double,y:double>>"
KINDS = {1: "Point", 2: "LineString", 3: "Polygon", 4: "MultiPoint", 5: "MultiLineString", 6: "MultiPolygon"}


def wkb_parts(data: bytes, at: int = 0) -> tuple[str, list[list[tuple[float, float]]], int]:
    """Kind, parts (outer rings of polygons) and end of a well-known binary geometry; further dimensions are left out."""
    order = "<" if data[at] == 1 else ">"
    (code,) = struct.unpack_from(f"{order}I", data, at + 1)
    at += 5
    if code & 0x20000000:  # an embedded reference system
        at += 4
    dims = 2 + bool(code & 0x80000000) + bool(code & 0x40000000) + {0: 0, 1: 1, 2: 1, 3: 2}[(code & 0xFFFFFFF) // 1000]
    kind = KINDS[(code & 0xFFFFFFF) % 1000]

    def number():
        nonlocal at
        (n,) = struct.unpack_from(f"{order}I", data, at)
        at += 4
        return n

    def run(n):
        nonlocal at
        flat = struct.unpack_from(f"{order}{n * dims}d", data, at)
        at += 8 * n * dims
        return [(flat[i], flat[i + 1]) for i in range(0, len(flat), dims)]

    if kind == "Point":
        return kind, [run(1)], at
    if kind == "LineString":
        return kind, [run(number())], at
    if kind == "Polygon":
        rings = [run(number()) for _ in range(number())]
        return kind, rings[:1], at
    parts = []
    for _ in range(number()):
        _, own, at = wkb_parts(data, at)
        parts += own
    return kind, parts, at


def geometry_parts(blob: bytes | None) -> tuple[str | None, list]:
    """Kind and parts of a GeoPackage geometry: a header with an optional box, then well-known binary."""
    if not blob or blob[:2] != b"GP":
        return None, []
    flags = blob[3]
    if flags >> 4 & 1:  # empty
        return None, []
    box = {0: 0, 1: 32, 2: 48, 3: 48, 4: 64}[flags >> 1 & 7]
    return wkb_parts(blob, 8 + box)[:2]


def rows_of(content: bytes, layer: str):
    """(properties, kind, parts) of the features of a layer."""
    con = sqlite3.connect(":memory:")
    try:
        con.deserialize(content)
        (column,) = con.execute("SELECT column_name FROM gpkg_geometry_columns WHERE table_name = ?", (layer,)).fetchone()
        name = layer.replace('"', '""')
        cursor = con.execute(f'SELECT * FROM "{name}"')
        names = [d[0] for d in cursor.description]
        for row in cursor:
            values = dict(zip(names, row, strict=True))
            kind, parts = geometry_parts(values.pop(column))
            yield {k: None if v is None else str(v) for k, v in values.items()}, kind, parts
    finally:
        con.close()


def geopackage(spark: SparkSession, path: str, layer: str) -> DataFrame:
    """The parts of the features of a layer of GeoPackage files, as ``layers.geojson`` gives them."""

    def run(batches):
        for pdf in batches:
            for row in pdf.itertuples():
                if len(row.content) > MAX_BYTES:
                    raise ValueError(f"{row.path}: {len(row.content)} bytes are too many for one task")
                out = [
                    (row.path, p, kind, i, [{"x": x, "y": y} for x, y in part]) for p, kind, parts in rows_of(row.content, layer) for i, part in enumerate(parts)
                ]
                for start in range(0, len(out), 10_000):
                    yield pd.DataFrame(out[start : start + 10_000], columns=["file", "properties", "kind", "part", "points"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, SCHEMA)
