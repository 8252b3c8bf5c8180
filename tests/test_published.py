import io
import struct
import zipfile

from pyspark.sql import functions as F

from strandline import published, sinks
from strandline.sources import geopackage

FIELDS = [("uid", "C", 11, 0), ("year", "N", 11, 0), ("rate_time", "N", 10, 2)]
POINTS = [(["a", 2001, 1.255], [[(1.5, 2.5)]]), (["é" * 9, None, None], [[(-1.0, 9.0)]])]
LINES = [(["x", 1, 0.0], [[(0.0, 0.0), (1.0, 2.0)], [(5.0, 5.0), (6.0, 7.0), (8.0, 9.0)]])]


def test_point_shapefile():
    files = published.shapefile(POINTS, FIELDS, True)
    shp, shx, dbf = files["shp"], files["shx"], files["dbf"]
    assert struct.unpack(">i", shp[:4])[0] == 9994 and struct.unpack(">i", shp[24:28])[0] * 2 == len(shp) and struct.unpack(">i", shx[24:28])[0] * 2 == len(shx)
    assert struct.unpack("<i4d", shp[32:68]) == (1, -1.0, 2.5, 1.5, 9.0)
    for k, (_, parts) in enumerate(POINTS):
        at, words = struct.unpack(">2i", shx[100 + 8 * k : 108 + 8 * k])
        assert struct.unpack(">2i", shp[2 * at : 2 * at + 8]) == (k + 1, words)
        assert struct.unpack("<i2d", shp[2 * at + 8 : 2 * at + 8 + 2 * words]) == (1, *parts[0][0])
    n, head, size = struct.unpack("<I2H", dbf[4:12])
    assert (n, head, size) == (2, 33 + 96, 33) and dbf[32:43].rstrip(b"\0") == b"uid" and dbf[head - 1] == 13
    assert dbf[head : head + size] == b" a" + b" " * 10 + b"2001".rjust(11) + (b"1.25" if f"{1.255:.2f}" == "1.25" else b"1.26").rjust(10)
    assert dbf[head + size + 12 : -1] == b" " * 21 and len(dbf) == head + 2 * size + 1


def test_line_shapefile():
    shp = published.shapefile(LINES, FIELDS, False)["shp"]
    body = shp[108:]
    assert struct.unpack("<i4d2i", body[:44]) == (3, 0.0, 0.0, 8.0, 9.0, 2, 5)
    assert struct.unpack("<2i", body[44:52]) == (0, 2) and struct.unpack("<10d", body[52:])[:4] == (0.0, 0.0, 1.0, 2.0)


def test_geopackages_can_be_read():
    got = list(geopackage.rows_of(published.geopackage("spots", POINTS, FIELDS, True), "spots"))
    assert [(p["uid"], p["year"], kind, parts) for p, kind, parts in got] == [("a", "2001", "Point", [[(1.5, 2.5)]]), ("é" * 9, None, "Point", [[(-1.0, 9.0)]])]
    got = list(geopackage.rows_of(published.geopackage("lines", LINES, FIELDS, False), "lines"))
    assert got[0][1:] == ("MultiLineString", LINES[0][1])


def test_files_are_written_by_tasks(spark, tmp_path):
    rows = spark.createDataFrame([("t1", "a", 1.234, 1.0, 2.0), ("t1", "b", None, 3.0, 4.0), ("t2", "c", 0.5, 5.0, 6.0)], "tile string, uid string, rate_time double, x double, y double")
    place = F.array(F.array(F.struct("x", "y")))
    shown = sinks.sink_view(rows.withColumn("parts", place).drop("x", "y"), {"tile": "string(20)"}, keep=("parts",))
    name = F.concat(F.lit(f"{tmp_path}/out/"), F.col("tile"), F.lit(".zip"))
    sinks.write_files(published.files(shown, "tile", "rates", True, name))
    with zipfile.ZipFile(io.BytesIO((tmp_path / "out" / "t1.zip").read_bytes())) as z:
        assert sorted(z.namelist()) == ["rates.dbf", "rates.prj", "rates.shp", "rates.shx"] and struct.unpack("<I", z.read("rates.dbf")[4:8])[0] == 2
    name = F.concat(F.lit(f"{tmp_path}/out/"), F.col("tile"), F.lit(".gpkg"))
    sinks.write_files(published.files(shown, "tile", "rates", True, name, package=True))
    got = geopackage.geopackage(spark, str(tmp_path / "out" / "*.gpkg"), "rates").collect()
    assert sorted((r.properties["uid"], r.points[0].x) for r in got) == [("a", 1.0), ("b", 3.0), ("c", 5.0)]
