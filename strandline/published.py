"""Published files of vector layers: zipped shapefiles and GeoPackages.

Encoders are plain functions of rows; a file is made by the task that has its rows, so a layer is dealt by a column that
bounds a file (a study area). A row's geometry is a list of parts, each a list of (x, y); a point is one part of one place.
"""

import io
import sqlite3
import struct
import zipfile
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.sinks import SINK_TYPES

#: Rows of one file.
MAX_ROWS = 5_000_000
# The projection of published shapefiles, as its text form is written.
ALBERS_WKT = (
    'PROJCS["GDA94_Australian_Albers",GEOGCS["GCS_GDA_1994",DATUM["D_GDA_1994",SPHEROID["GRS_1980",6378137.0,298.257222101]],'
    'PRIMEM["Greenwich",0.0],UNIT["Degree",0.0174532925199433]],PROJECTION["Albers"],PARAMETER["False_Easting",0.0],'
    'PARAMETER["False_Northing",0.0],PARAMETER["Central_Meridian",132.0],PARAMETER["Standard_Parallel_1",-18.0],'
    'PARAMETER["Standard_Parallel_2",-36.0],PARAMETER["Latitude_Of_Origin",0.0],UNIT["Meter",1.0]]'
)
EPSG = 3577
PARTS = "array<array<struct<x:double,y:double>>>"


def fields_of(df: DataFrame, skip: Sequence[str]) -> list[tuple[str, str, int, int]]:
    """Name, letter, width and decimals of the attributes of a ``sink_view``."""
    out = []
    for name, kind in df.dtypes:
        if name in skip:
            continue
        known = SINK_TYPES.get(name, "")
        if kind.startswith("decimal"):
            width, digits = map(int, kind[8:-1].split(","))
            out.append((name, "N", width + 2, digits))
        elif kind in ("int", "bigint", "smallint"):
            out.append((name, "N", 11 if kind == "int" else 20, 0))
        else:
            out.append((name, "C", int(known[7:-1]) if known.startswith("string(") else 80, 0))
    if len({n[:10] for n, *_ in out}) < len(out):
        raise ValueError("names of attributes must differ in their first ten characters")
    return out


def _box(parts) -> tuple[float, float, float, float]:
    xs, ys = [x for p in parts for x, _ in p], [y for p in parts for _, y in p]
    return (min(xs), min(ys), max(xs), max(ys)) if xs else (0.0, 0.0, 0.0, 0.0)


def shapefile(rows: list[tuple[list, list]], fields: list[tuple[str, str, int, int]], points: bool) -> dict[str, bytes]:
    """The four files of a layer by their endings: ``rows`` are (values, parts)."""
    kind = 1 if points else 3
    shapes, index, at = [], [], 50
    for number, (_, parts) in enumerate(rows, 1):
        if points:
            body = struct.pack("<i2d", kind, *parts[0][0])
        else:
            starts, n = [], 0
            for p in parts:
                starts.append(n)
                n += len(p)
            flat = [v for p in parts for place in p for v in place]
            body = struct.pack(f"<i4d2i{len(parts)}i{2 * n}d", kind, *_box(parts), len(parts), n, *starts, *flat)
        shapes.append(struct.pack(">2i", number, len(body) // 2) + body)
        index.append(struct.pack(">2i", at, len(body) // 2))
        at += len(shapes[-1]) // 2
    box = _box([p for _, parts in rows for p in parts])

    def head(words: int) -> bytes:
        return struct.pack(">7i", 9994, 0, 0, 0, 0, 0, words) + struct.pack("<2i8d", 1000, kind, *box, 0, 0, 0, 0)

    def shown(value, letter, width, digits) -> bytes:
        if value is None or value != value:
            return b" " * width
        if letter == "C":
            return str(value).encode()[:width].ljust(width)
        return (f"{value:.{digits}f}" if digits else str(int(value))).encode().rjust(width)[:width]

    table = struct.pack("<4BI2H20x", 3, 100, 1, 1, len(rows), 33 + 32 * len(fields), 1 + sum(f[2] for f in fields))
    for name, letter, width, digits in fields:
        table += struct.pack("<11sc4x2B14x", name[:10].encode(), letter.encode(), width, digits)
    body = b"".join(b" " + b"".join(shown(v, *f[1:]) for v, f in zip(values, fields, strict=True)) for values, _ in rows)
    return {
        "shp": head(at) + b"".join(shapes), "shx": head(50 + 4 * len(rows)) + b"".join(index),
        "dbf": table + b"\r" + body + b"\x1a", "prj": ALBERS_WKT.encode(),
    }


def zipped(name: str, files: dict[str, bytes]) -> bytes:
    """One archive, the same for the same files."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for ending, data in files.items():
            z.writestr(zipfile.ZipInfo(f"{name}.{ending}", (2000, 1, 1, 0, 0, 0)), data, zipfile.ZIP_DEFLATED)
    return out.getvalue()


def wkb(parts: list, points: bool) -> bytes:
    if points:
        return struct.pack("<BI2d", 1, 1, *parts[0][0])
    lines = (struct.pack(f"<B2I{2 * len(p)}d", 1, 2, len(p), *(v for place in p for v in place)) for p in parts)
    return struct.pack("<B2I", 1, 5, len(parts)) + b"".join(lines)


def geopackage(layer: str, rows: list[tuple[list, list]], fields: list[tuple[str, str, int, int]], points: bool, epsg: int = EPSG) -> bytes:
    """A GeoPackage with one layer."""
    con = sqlite3.connect(":memory:")
    try:
        con.executescript(
            """PRAGMA application_id = 1196444487; PRAGMA user_version = 10300;
            CREATE TABLE gpkg_spatial_ref_sys (srs_name TEXT NOT NULL, srs_id INTEGER PRIMARY KEY, organization TEXT NOT NULL,
              organization_coordsys_id INTEGER NOT NULL, definition TEXT NOT NULL, description TEXT);
            CREATE TABLE gpkg_contents (table_name TEXT PRIMARY KEY, data_type TEXT NOT NULL, identifier TEXT UNIQUE, description TEXT DEFAULT '',
              last_change DATETIME NOT NULL, min_x DOUBLE, min_y DOUBLE, max_x DOUBLE, max_y DOUBLE, srs_id INTEGER);
            CREATE TABLE gpkg_geometry_columns (table_name TEXT PRIMARY KEY, column_name TEXT NOT NULL, geometry_type_name TEXT NOT NULL,
              srs_id INTEGER NOT NULL, z TINYINT NOT NULL, m TINYINT NOT NULL);"""
        )
        systems = [("undefined cartesian", -1, "NONE", -1, "undefined"), ("undefined geographic", 0, "NONE", 0, "undefined"), ("WGS 84", 4326, "EPSG", 4326, "GEOGCS"), ("Albers", epsg, "EPSG", epsg, ALBERS_WKT)]
        con.executemany("INSERT OR REPLACE INTO gpkg_spatial_ref_sys VALUES (?, ?, ?, ?, ?, '')", systems)
        box = _box([p for _, parts in rows for p in parts])
        con.execute("INSERT INTO gpkg_contents VALUES (?, 'features', ?, '', '2000-01-01T00:00:00.000Z', ?, ?, ?, ?, ?)", (layer, layer, *box, epsg))
        con.execute("INSERT INTO gpkg_geometry_columns VALUES (?, 'geom', ?, ?, 0, 0)", (layer, "POINT" if points else "MULTILINESTRING", epsg))
        kinds = {"C": "TEXT", "N": "REAL"}
        quoted = ['"' + n.replace('"', '""') + '"' for n, *_ in fields]
        name = '"' + layer.replace('"', '""') + '"'
        columns = "".join(f", {q} {'INTEGER' if f[1] == 'N' and not f[3] else kinds[f[1]]}" for q, f in zip(quoted, fields, strict=True))
        con.execute(f"CREATE TABLE {name} (fid INTEGER PRIMARY KEY, geom BLOB{columns})")
        head = b"GP\x00\x01" + struct.pack("<i", epsg)
        marks = ", ".join("?" * (len(fields) + 1))
        plain = ((head + wkb(parts, points), *(None if v is None or v != v else v if isinstance(v, str) else float(v) for v in values)) for values, parts in rows)
        con.executemany(f"INSERT INTO {name} (geom{''.join(f', {q}' for q in quoted)}) VALUES ({marks})", plain)
        con.commit()
        return con.serialize()
    finally:
        con.close()


def files(df: DataFrame, by: str, layer: str, points: bool, path: Column, package: bool = False) -> DataFrame:
    """``path, content``: a zipped shapefile, or a GeoPackage, of each value of ``by``.

    ``df`` is a ``sink_view`` with the column ``parts`` (``PARTS``); ``path`` names a file by the column ``by``.
    """
    fields = fields_of(df, (by, "parts"))
    names = [f[0] for f in fields]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        if len(pdf) > MAX_ROWS:
            raise ValueError(f"{len(pdf)} rows are too many for one file")
        values = pdf[names].astype(object).where(pdf[names].notna(), None).to_numpy().tolist()
        parts = [[[(q["x"], q["y"]) for q in p] for p in own] for own in pdf["parts"]]
        rows = sorted(zip(values, parts, strict=True), key=lambda r: (str(r[0]), r[1]))
        data = geopackage(layer, rows, fields, points) if package else zipped(layer, shapefile(rows, fields, points))
        return pd.DataFrame({by: [pdf[by].iloc[0]], "content": [data]})

    made = df.groupBy(by).applyInPandas(run, f"{by} {dict(df.dtypes)[by]}, content binary")
    return made.select(path.alias("path"), "content")
