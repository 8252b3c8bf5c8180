import json
import sqlite3
import struct
import zipfile
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline import cli, recipe, sinks
from strandline.operators import reports
from strandline.sources import layers, surveys, tiff
from strandline.sources.geopackage import geopackage
from strandline.streaming.composites import append_metrics, running_composite

YAML = """
recipe:
  transform: expressions
  input:
    transform: apply_mask
    mask_measurement_name: ok
    input:
      transform: expressions
      input:
        collate:
          - {product: ls5, measurements: [nbart_green, nbart_swir_1, fmask], filters: {gqa: [0, 1]}}
          - {product: ls8, measurements: [nbart_green, nbart_swir_1, fmask], filters: {gqa: [0, 1]}}
      output:
        green: {formula: nbart_green * 0.0001, dtype: float32}
        swir1: {formula: nbart_swir_1 * 0.0001, dtype: float32}
        ok: {formula: ((fmask == 1) | (fmask == 4)) & (nbart_green > 0), dtype: bool}
  output:
    mndwi: {formula: (green - swir1) / (green + swir1)}
"""


def test_recipe(spark):
    schema = "tile string, nbart_green int, nbart_swir_1 int, fmask int, gqa double"
    a = spark.createDataFrame([("t", 3000, 1000, 1, 0.5), ("t", 3000, 1000, 2, 0.5)], schema)
    b = spark.createDataFrame([("t", 1000, 3000, 4, 0.5), ("t", 1, 1, 1, 2.0)], schema)
    got = recipe.build(recipe.load_config(YAML), {"ls5": a, "ls8": b}).collect()
    assert sorted(r.sensor for r in got) == ["ls5", "ls5", "ls8"]
    assert {None if r.mndwi is None else round(r.mndwi, 4) for r in got} == {0.5, None, -0.5}


def test_geojson_round_trip(spark, tmp_path):
    whole = {
        "type": "FeatureCollection",
        "features": [
            {"type": "Feature", "properties": {"id": 7}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [4, 0], [4, 4], [0, 0]]]}},
            {"type": "Feature", "properties": {"id": 8}, "geometry": {"type": "MultiLineString", "coordinates": [[[50, 50], [51, 51]], [[60, 60], [61, 61]]]}},
            {"type": "Feature", "properties": {"id": 9}, "geometry": {"type": "Point", "coordinates": [1, 2]}},
        ],
    }
    (tmp_path / "a.geojson").write_text(json.dumps(whole))
    rows = layers.geojson(spark, str(tmp_path / "a.geojson")).collect()
    assert sorted((r.properties["id"], r.part, len(r.points)) for r in rows) == [("7", 0, 4), ("8", 0, 2), ("8", 1, 2), ("9", 0, 1)]
    assert {r.properties["id"] for r in layers.geojson(spark, str(tmp_path / "a.geojson"), (0, 0, 5, 5)).collect()} == {"7", "9"}
    df = spark.createDataFrame([(1, 2.0, 3.0)], "uid int, x double, y double")
    shown = df.select("uid", sinks.geometry_json("Point", F.col("x"), F.col("y")).alias("geometry"))
    sinks.write_geojson(shown, str(tmp_path / "out"))
    back = layers.geojson(spark, str(tmp_path / "out"), by_line=True).collect()
    assert [(r.properties["uid"], [tuple(p) for p in r.points]) for r in back] == [("1", [(2.0, 3.0)])]


def test_geopackage(spark, tmp_path):
    path = tmp_path / "a.gpkg"
    con = sqlite3.connect(path)
    con.execute("CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT)")
    con.execute("INSERT INTO gpkg_geometry_columns VALUES ('shorelines_annual', 'geom')")
    con.execute("CREATE TABLE shorelines_annual (fid INTEGER, year INTEGER, certainty TEXT, geom BLOB)")
    head = b"GP\x00\x01" + struct.pack("<i", 3577)
    line = struct.pack("<BI", 1, 2) + struct.pack("<I", 2) + struct.pack("<4d", 0, 1, 2, 3)
    several = struct.pack("<BII", 1, 5, 2) + line + line
    boxed = b"GP\x00\x03" + struct.pack("<i", 3577) + struct.pack("<4d", 0, 2, 1, 3)
    area = struct.pack("<BII", 1, 1003, 1) + struct.pack("<I", 3) + struct.pack("<9d", 0, 0, 9, 4, 0, 9, 4, 4, 9)
    for i, blob in enumerate((head + line, boxed + several, head + area, b"GP\x00\x11" + struct.pack("<i", 3577), None)):
        con.execute("INSERT INTO shorelines_annual VALUES (?, 2001, NULL, ?)", (i, blob))
    con.commit()
    con.close()
    rows = geopackage(spark, str(path), "shorelines_annual").collect()
    assert sorted((r.properties["fid"], r.part, r.kind, len(r.points)) for r in rows) == [
        ("0", 0, "LineString", 2), ("1", 0, "MultiLineString", 2), ("1", 1, "MultiLineString", 2), ("2", 0, "Polygon", 3)
    ]
    assert all(r.properties["certainty"] is None for r in rows) and [tuple(p) for p in rows[0].points] == [(0.0, 1.0), (2.0, 3.0)]


def test_tiff(spark, tmp_path):
    values = np.arange(12, dtype=np.int16).reshape(3, 4)
    values[1, 1] = -999
    for y in (1999, 2000):
        (tmp_path / "t1").mkdir(exist_ok=True)
        (tmp_path / "t1" / f"{y}_count.tif").write_bytes(tiff.encode(values, nodata=-999))
    back, nodata = tiff.decode(tiff.encode(values.astype(np.float32)))
    assert (back == values).all() and nodata is None
    blocks = tiff.rasters(spark, str(tmp_path / "t1"), 2000, 2001).collect()
    assert [(b.tile, b.year, b.h, b.w) for b in blocks] == [("t1", 2000, 3, 4)]
    data = np.frombuffer(blocks[0].data).reshape(3, 4)
    assert np.isnan(data[1, 1]) and data[2, 3] == 11
    # tiles, deflated, with the predictor
    part = np.zeros((4, 16, 16), np.int16)
    whole = np.random.default_rng(0).integers(0, 99, (20, 30)).astype(np.int16)
    padded = np.pad(whole, ((0, 12), (0, 2)))
    raw = []
    for i in range(4):
        part[i] = padded[i // 2 * 16 : i // 2 * 16 + 16, i % 2 * 16 : i % 2 * 16 + 16]
        raw.append(zlib.compress(np.diff(part[i], axis=1, prepend=0).astype("<i2").tobytes()))
    at = [8 + sum(map(len, raw[:i])) for i in range(4)]
    body = b"".join(raw)
    start = 8 + len(body)
    tags = [(256, 3, 1, 30), (257, 3, 1, 20), (258, 3, 1, 16), (259, 3, 1, 8), (277, 3, 1, 1), (317, 3, 1, 2), (322, 3, 1, 16), (323, 3, 1, 16), (324, 4, 4, 0), (325, 4, 4, 0), (339, 3, 1, 2)]
    n = len(tags)
    tags = [(t, k, c, start + 2 + 12 * n + 4 + (0 if t == 324 else 16) if t in (324, 325) else v) for t, k, c, v in tags]
    table = struct.pack("<H", n) + b"".join(struct.pack("<HHII", *t) for t in tags) + b"\0" * 4
    data = b"II*\0" + struct.pack("<I", start) + body + table + struct.pack("<4I", *at) + struct.pack("<4I", *map(len, raw))
    assert (tiff.decode(data)[0] == whole).all()
    again = tiff.encoded(tiff.rasters(spark, str(tmp_path / "t1")), "int16", -999).collect()
    assert len(again) == 2 and (tiff.decode(bytes(again[0].content))[0] == values).all()


WORKFLOW = """
spec: {arguments: {parameters: [{name: cpu-limit, value: "2"}, {name: result-version, value: v1}]}}
status:
  nodes:
    a-1: {type: Pod, inputs: {parameters: [{name: id, value: "7"}]}, outputs: {exitCode: "137"}, finishedAt: "2023-01-02T03:04:05Z", resourcesDuration: {cpu: 240, memory: 9}}
    a-2: {type: Pod, inputs: {parameters: [{name: id, value: "7"}]}, outputs: {exitCode: "0"}, finishedAt: "2023-01-02T04:04:05Z", resourcesDuration: {cpu: 120, memory: 9}}
    a-3: {type: Pod, inputs: {parameters: [{name: id, value: "8"}]}, resourcesDuration: {cpu: 120, memory: 9}}
    a-4: {type: Pod, inputs: {parameters: [{name: v, value: v1}]}, outputs: {exitCode: "0"}, resourcesDuration: {cpu: 1, memory: 1}}
    a-5: {type: DAG}
"""


def test_workflow_runs(spark):
    runs = reports.workflow_runs(spark, WORKFLOW)
    assert [(r.run_id, r.tile, r.duration, r.error) for r in runs.orderBy("run_id").collect()] == [("a-1", 7, 2.0, "memory"), ("a-2", 7, 1.0, None), ("a-3", 8, None, "pod deleted")]
    assert {r.tile: r.status for r in reports.run_status(runs).collect()} == {7: "succeeded after retry", 8: "failed"}
    assert {r.tile: r.run_id for r in reports.longest_attempt(runs, "tile", "duration").collect()} == {7: "a-1", 8: "a-3"}


def test_survey_files(spark, tmp_path):
    (tmp_path / "beach_S1_20190304.txt").write_text("# LONGITUDE: 147.5\n# LATITUDE: -43.1\n# TRUE BEARING TRANSECT DEGREES: 95\n# other\ndist z flag\n0.0  2.5 2\n5.0 -9999 2\n\n10.0 -0.5 1\n")
    lines = surveys.lines(spark, str(tmp_path))
    meta = surveys.header_metadata(lines).collect()[0]
    assert (meta.longitude, meta.latitude, meta.bearing, meta.method) == ("147.5", "-43.1", "95", None)
    rows = surveys.table_of(lines, ["distance", "z", "flag"], skip=5)
    got = rows.select(surveys.known(F.col("z")).alias("z"), *surveys.from_file_name(F.col("file"), r"_(S\d+)_(\d+)\.", ["section", "day"])).collect()
    assert [r.z for r in got] == [2.5, None, -0.5] and {r.section for r in got} == {"S1"}
    when = spark.range(1).select(surveys.parsed_date(F.lit("04/03/2019"), "yyyy-MM-dd", "dd/MM/yyyy").alias("d"), surveys.numbers(F.lit("at -33.5, 151.25 m")).alias("n")).collect()[0]
    assert when.d.month == 3 and when.n == [-33.5, 151.25]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.125)], "year int, dist_2000 double")
    assert sinks.sink_view(df).dtypes == [("year", "int"), ("dist_2000", "decimal(8,2)")]
    path = str(tmp_path / "t")
    assert not sinks.completed(spark, path) and sinks.write_table(df, path) and sinks.completed(spark, path)
    assert not sinks.write_table(df, path, overwrite=False)
    for _ in range(2):
        sinks.append_log(df, str(tmp_path / "log"))
    assert spark.read.option("header", True).csv(str(tmp_path / "log")).count() == 2


def test_stream(spark, tmp_path):
    rows = spark.createDataFrame([("t", "2001-02-03", 1.0), ("t", "2001-05-03", 3.0)], "tile string, time string, v double").withColumn("time", F.col("time").cast("timestamp"))
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    q = running_composite(stream, ["tile"], "v").writeStream.format("memory").queryName("made").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(60)
    r = spark.table("made").collect()[0]
    assert (r["count"], r["mean"], r.stdev) == (2, 2.0, 1.0)
    append_metrics(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


@pytest.fixture(scope="module")
def scene(spark, tmp_path_factory):
    """A straight shore that moves 1.5 cells a year, seen six times a year."""
    root = str(tmp_path_factory.mktemp("scene"))
    px = spark.range(60 * 90).select((F.col("id") / 90).cast("int").alias("yi"), (F.col("id") % 90).cast("int").alias("xi"))
    when = spark.range(6 * 8).select((2000 + F.col("id") / 6).cast("int").alias("year"), (F.col("id") % 6).alias("k"))
    shore = 40 + 1.5 * (F.col("year") - 2000)
    index = F.greatest(F.lit(-0.9), F.least(F.lit(0.9), (F.col("xi") - shore - 0.3) / 4))
    obs = px.join(when).select(
        F.lit("1").alias("tile"), "yi", "xi", (F.col("yi") * 30.0).alias("y"), (F.col("xi") * 30.0).alias("x"), F.make_timestamp("year", F.col("k").cast("int") * 2 + 1, F.lit(5), F.lit(0), F.lit(0), F.lit(0)).alias("time"),
        (1 + index).alias("green"), (1 - index).alias("swir1"), F.lit("clear").alias("cloud_mask"), F.lit("final").alias("maturity"), F.lit(0.5).alias("gqa_iterative_mean_xy"), F.lit(0.1).alias("tide_m"),
    )
    obs.write.parquet(f"{root}/pixels")
    spark.createDataFrame([("1", 0, 0, -1.0), ("1", 0, 0, 1.0)], "tile string, cy long, cx long, tide_m double").write.parquet(f"{root}/tides")
    ring = [(-1e5, -1e5), (1e5, -1e5), (1e5, 1e5), (-1e5, 1e5)]
    spark.createDataFrame([("r1", ring)], "id_primary string, ring array<struct<x:double,y:double>>").write.parquet(f"{root}/regions")
    spark.createDataFrame([(9e6, 9e6, "Hard bedrock shore", "Unclassified")], "px double, py double, INTERTD1_V string, INTERTD2_V string").write.parquet(f"{root}/geomorphology")
    return root


def test_stages_end_to_end(spark, scene, tmp_path):
    def run(*args):
        return cli.main([args[0], "--root", scene, *args[1:]], spark)

    span = ["--start_year", "2001", "--end_year", "2006"]
    assert run("raster", "--raster_version", "v1", "--study_area", "1", *span) == 0
    assert run("raster", "--raster_version", "v1", "--study_area", "1", "--overwrite", "false", *span) == 0
    assert run("vector", "--raster_version", "v1", "--study_area", "1", "--baseline_year", "2006", *span) == 0
    points = spark.read.parquet(f"{scene}/vectors/v1/points/1").collect()
    assert len(points) > 30
    rates = sorted(p.rate for p in points)
    assert {p.certainty for p in points} == {"good"} and all(p.angle_std == 26 and p.angle_mean == 90 for p in points) and points[0].id_primary == "r1"
    parts = spark.read.parquet(f"{scene}/vectors/v1/shoreline_parts/1")
    assert parts.where("tide_datum = '0.0 m AMSL'").count() > 100 and parts.select("certainty").distinct().count() == 1
    # 1.5 cells of 30 m each year, seaward
    assert abs(abs(rates[len(rates) // 2]) - 45) < 1
    assert run("continental", "--vector_version", "v1", "--baseline_year", "2006", "--hotspots_radius", "600") == 0
    with zipfile.ZipFile(f"{scene}/vectors/v1/shapefiles/ratesofchange_1.zip") as z:
        assert struct.unpack("<I", z.read("ratesofchange.dbf")[4:8])[0] == len(points) and struct.unpack("<i", z.read("ratesofchange.shp")[32:36])[0] == 1
    with zipfile.ZipFile(f"{scene}/vectors/v1/shapefiles/annualshorelines_1.zip") as z:
        assert struct.unpack("<i", z.read("annualshorelines.shp")[32:36])[0] == 3
    assert all(len(p.uid) == 10 and 131 < p.lon < 133 for p in points) and len({p.uid for p in points}) == len(points)
    lines = layers.geojson(spark, f"{scene}/continental/v1/shorelines.geojson", by_line=True)
    assert {r.properties["year"] for r in lines.collect()} >= {str(y) for y in range(2001, 2007)} and lines.first().properties["tide_datum"] == "0.0 m AMSL"
    values, nodata = tiff.decode(open(f"{scene}/rasters/v1/tiff/1/2003_mndwi.tif", "rb").read())
    assert values.shape == (60, 90) and tiff.decode(open(f"{scene}/rasters/v1/tiff/1/2003_count_gapfill.tif", "rb").read())[0].max() == 18
    spots = geopackage(spark, f"{scene}/continental/v1/hotspots_zoom_1.gpkg", "hotspots_zoom")
    assert spots.count() == spark.read.parquet(f"{scene}/continental/v1/hotspots_zoom_1").count() and len(spots.first().properties["uid"]) == 11
    shown = layers.geojson(spark, f"{scene}/continental/v1/points.geojson", by_line=True)
    assert shown.count() == len(points) and "rate_time" in shown.first().properties
    assert spark.read.parquet(f"{scene}/continental/v1/hotspots_zoom_1").count() > 0
    ids = spark.range(3).select(F.concat(F.lit("p"), F.col("id").cast("string")).alias("id"), ((F.col("id") + 1) * 450.0).alias("y0"))
    steps = spark.range(0, 2600, 20).select(F.col("id").cast("double").alias("distance"))
    years = spark.createDataFrame([(y,) for y in range(2001, 2007)], "yr int")
    sea = (40 + 1.5 * (F.col("yr") - 2000) + 0.3) * 30
    prof = ids.join(steps).join(years).select("id", F.make_timestamp("yr", F.lit(6), F.lit(1), F.lit(0), F.lit(0), F.lit(0)).alias("date"), "distance", (F.col("distance") / 20).cast("int").alias("ord"), ((sea - F.col("distance")) / 10 + 0.001).alias("z"), F.col("distance").alias("x"), F.col("y0").alias("y"))
    prof.write.parquet(str(tmp_path / "surveys"))
    assert run("validation", "--vector_version", "v1", "--inputs_path", str(tmp_path / "surveys"), "--append_stats", "true") == 0
    (tmp_path / "config.yaml").write_text(f"root: {scene}\n")
    again = ["validation", "--config_path", str(tmp_path / "config.yaml"), "--vector_version", "v1", "--inputs_path", str(tmp_path / "surveys")]
    assert cli.main([*again, "--overwrite", "true", "--markdown_report", "true"], spark) == 0
    assert "| MAE | " in "\n".join(r.value for r in spark.read.text(f"{scene}/report/temp").collect())
    survey = layers.geojson(spark, f"{scene}/validation/temp_survey.geojson", by_line=True)
    assert survey.count() == spark.read.parquet(f"{scene}/validation/temp").count() and abs(survey.first().points[0].x - 132) < 0.1
    out = spark.read.parquet(f"{scene}/validation/temp")
    assert out.count() > 10 and out.agg(F.max(F.abs("error_m"))).first()[0] < 3
    assert spark.read.option("header", True).csv(f"{scene}/stats").count() == 1


def test_exit_codes(spark, tmp_path):
    spark.createDataFrame([], "tile string, time timestamp, maturity string, gqa_iterative_mean_xy double").write.parquet(str(tmp_path / "pixels"))
    assert cli.main(["raster", "--root", str(tmp_path), "--raster_version", "v", "--study_area", "1"], spark) == 2
    assert cli.main(["vector", "--root", str(tmp_path), "--raster_version", "v", "--study_area", "1"], spark) == 1
