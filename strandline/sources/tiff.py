"""Single-band TIFF rasters: read from any store, written as plain uncompressed files.

Reads strips and tiles of uncompressed or deflated samples (with the horizontal predictor for integers); other compressions are an
error. A raster is one block of ``operators.rasters``.
"""

import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.operators.rasters import BLOCK, array_of

_TYPES = {1: "B", 2: "c", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q"}
_KINDS = {(1, 8): "u1", (1, 16): "u2", (1, 32): "u4", (2, 8): "i1", (2, 16): "i2", (2, 32): "i4", (3, 32): "f4", (3, 64): "f8"}


def decode(data: bytes) -> tuple[np.ndarray, float | None]:
    """The first band of a file and its nodata value."""
    order = {b"II": "<", b"MM": ">"}[data[:2]]
    magic, at = struct.unpack_from(f"{order}HI", data, 2)
    if magic != 42:
        raise ValueError("not a classic TIFF file")
    (n,) = struct.unpack_from(f"{order}H", data, at)
    tags = {}
    for i in range(n):
        tag, kind, count = struct.unpack_from(f"{order}HHI", data, at + 2 + 12 * i)
        form = f"{order}{count}{_TYPES.get(kind, 'B')}"
        size = struct.calcsize(form)
        place = at + 10 + 12 * i
        if size > 4:
            (place,) = struct.unpack_from(f"{order}I", data, place)
        tags[tag] = data[place : place + count] if kind == 2 else struct.unpack_from(form, data, place)
    w, h = tags[256][0], tags[257][0]
    compression, predictor = tags.get(259, (1,))[0], tags.get(317, (1,))[0]
    kind = np.dtype(_KINDS[tags.get(339, (1,))[0], tags.get(258, (8,))[0]]).newbyteorder(order)
    if tags.get(277, (1,))[0] != 1 or compression not in (1, 8, 32946) or predictor not in (1, 2):
        raise ValueError("only single bands, uncompressed or deflated, can be read")
    if 322 in tags:
        tw, th, places, sizes = tags[322][0], tags[323][0], tags[324], tags[325]
    else:
        tw, th, places, sizes = w, min(h, tags.get(278, (h,))[0]), tags[273], tags[279]
    out = np.zeros((h, w), kind.newbyteorder("="))
    across = -(-w // tw)
    for i, (place, size) in enumerate(zip(places, sizes, strict=True)):
        y, x = i // across * th, i % across * tw
        raw = data[place : place + size]
        part = np.frombuffer(raw if compression == 1 else zlib.decompress(raw), kind)
        part = part[: part.size // tw * tw].reshape(-1, tw)
        if predictor == 2:
            part = np.cumsum(part, axis=1, dtype=part.dtype.newbyteorder("="))
        rows = min(part.shape[0], h - y)
        out[y : y + rows, x : x + tw] = part[:rows, : w - x]
    missing = tags.get(42113)
    return out, float(missing.split(b"\0")[0]) if missing else None


def encode(values: np.ndarray, x0: float = 0.0, y0: float = 0.0, size: float = 30.0, nodata: float | None = None, epsg: int = 3577) -> bytes:
    """A little-endian file of one strip with the tags that place it: pixel size, upper left corner and projection."""
    values = np.ascontiguousarray(values)
    form = {"f": 3, "i": 2, "u": 1}[values.dtype.kind]
    body = values.astype(values.dtype.newbyteorder("<")).tobytes()
    text = b"" if nodata is None else f"{nodata:g}".encode() + b"\0"
    keys = struct.pack("<16H", 1, 1, 0, 3, 1024, 0, 1, 1, 1025, 0, 1, 1, 3072, 0, 1, epsg)
    entries = [
        (256, 4, 1, struct.pack("<I", values.shape[1])), (257, 4, 1, struct.pack("<I", values.shape[0])), (258, 3, 1, struct.pack("<H", values.itemsize * 8)),
        (259, 3, 1, struct.pack("<H", 1)), (262, 3, 1, struct.pack("<H", 1)), (273, 4, 1, struct.pack("<I", 8)), (277, 3, 1, struct.pack("<H", 1)),
        (278, 4, 1, struct.pack("<I", values.shape[0])), (279, 4, 1, struct.pack("<I", len(body))), (339, 3, 1, struct.pack("<H", form)),
        (33550, 12, 3, struct.pack("<3d", size, size, 0)), (33922, 12, 6, struct.pack("<6d", 0, 0, 0, x0, y0, 0)), (34735, 3, 16, keys),
        *([(42113, 2, len(text), text)] if text else []),
    ]
    head = 8 + len(body) + len(body) % 2
    extra, table, at = b"", struct.pack("<H", len(entries)), head + 2 + 12 * len(entries) + 4
    for tag, kind, count, raw in entries:
        table += struct.pack("<HHI", tag, kind, count)
        if len(raw) <= 4:
            table += raw.ljust(4, b"\0")
        else:
            table += struct.pack("<I", at + len(extra))
            extra += raw + b"\0" * (len(raw) % 2)
    return b"II*\0" + struct.pack("<I", head) + body + b"\0" * (len(body) % 2) + table + b"\0" * 4 + extra


def rasters(spark: SparkSession, path: str, start: int = 1988, end: int = 2021, year_of: str = r"^(\d{4})") -> DataFrame:
    """Blocks of the rasters whose file name begins with a year of the range; nodata becomes NaN. The folder names the tile."""
    files = spark.read.format("binaryFile").load(path).withColumn("_name", F.substring_index("path", "/", -1))
    files = files.withColumn("year", F.regexp_extract("_name", year_of, 1).try_cast("int")).where(F.col("year").between(start, end))
    files = files.withColumn("tile", F.split_part("path", F.lit("/"), F.lit(-2)))

    def run(batches):
        for pdf in batches:
            for row in pdf.itertuples():
                values, nodata = decode(row.content)
                data = values.astype(float)
                if nodata is not None:
                    data[data == nodata] = np.nan
                yield pd.DataFrame([(row.tile, row.year, 0, 0, *data.shape, data.tobytes())], columns=[c.split()[0] for c in BLOCK.split(", ")])

    return files.select("tile", "year", "content").mapInPandas(run, BLOCK)


def encoded(blocks: DataFrame, kind: str = "float32", nodata: float | None = None, size: float = 30.0, place: dict | None = None) -> DataFrame:
    """``tile, year, content``: each block as a TIFF file, for a writer that puts bytes in a store.

    ``place`` tells where the cells' centres lie; without it they are counted from 0, rows to the south.
    """
    at = place or {"x0": size / 2, "dx": size, "y0": -size / 2, "dy": -size}

    def run(batches):
        for pdf in batches:
            files = []
            for row in pdf.itertuples():
                data = array_of(row)
                data = data if nodata is None else np.where(np.isnan(data), nodata, data)
                files.append(encode(data.astype(kind), at["x0"] + (row.x0 - 0.5) * at["dx"], at["y0"] + (row.y0 - 0.5) * at["dy"], abs(at["dx"]), nodata))
            yield pd.DataFrame({"tile": pdf.tile, "year": pdf.year, "content": files})

    return blocks.mapInPandas(run, "tile string, year int, content binary")
