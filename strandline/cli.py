"""Commands: raster, vector, continental, validation. Exit code 0 done or skipped, 1 failed, 2 no tide data.

Inputs and outputs are Parquet tables under ``--root``: ``pixels``, ``tides`` (tile, cy, cx, time, tide_m), optionally ``dem`` and ``sun``, and the
tables that the stages write for each other. Composites are also written as TIFF files, published layers as GeoJSON in degrees.
"""

import argparse
import sys
import traceback

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline import published, sinks
from strandline.functions import geodesy
from strandline.functions.numbers import let
from strandline.functions.statistics import circular
from strandline.operators import adapters
from strandline.operators import composites as C
from strandline.operators import rasters as X
from strandline.operators import rates as R
from strandline.operators import spatial as S
from strandline.operators import surveys, validation
from strandline.recipe import load_config
from strandline.session import local_session
from strandline.sources import layers, tiff

PIXEL_SIZE, CELL_SIZE = 30.0, 5000.0
BAD = ["nodata", "cloud", "shadow", "snow"]
#: Kinds of the rasters of a composite, and their value for nothing.
RASTERS = {"mndwi": ("float32", None), "stdev": ("float32", None), "count": ("int16", -999)}
#: Survey programmes whose raw table is one input.
ADAPTERS = {f.__name__: f for f in (adapters.nswbpd, adapters.narrabeen, adapters.cgc, adapters.vicdeakin, adapters.moruya, adapters.sunshinecoast)}
NAMES = {"rate": "rate_time", "sig": "sig_time", "se": "se_time"}


class NoTides(Exception):
    pass


def flag(text: str) -> bool:
    return text.lower() in ("1", "true", "yes")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="strandline")
    sub = top.add_subparsers(dest="command", required=True)

    def command(name, *, version: str):
        p = sub.add_parser(name)
        where = p.add_mutually_exclusive_group(required=True)
        where.add_argument("--root")
        where.add_argument("--config_path", help="YAML with the entry root")
        p.add_argument(f"--{version}", required=True)
        return p

    p = command("raster", version="raster_version")
    p.add_argument("--study_area", required=True)
    p.add_argument("--start_year", type=int, default=2000)
    p.add_argument("--end_year", type=int, default=2020)
    p.add_argument("--tide_centre", type=float, default=0.0)
    p.add_argument("--buffer", type=float, default=0.05, help="tables are read by tile; taken and not used")
    p.add_argument("--aws_unsigned", type=flag, default=True, help="access is the session's; taken and not used")
    p.add_argument("--overwrite", type=flag, default=True)
    p = command("vector", version="raster_version")
    p.add_argument("--study_area", required=True)
    p.add_argument("--vector_version")
    p.add_argument("--water_index", default="mndwi")
    p.add_argument("--index_threshold", type=float, default=0.0)
    p.add_argument("--start_year", type=int, default=1988)
    p.add_argument("--end_year", type=int, default=2021)
    p.add_argument("--baseline_year", type=int, default=2021)
    p.add_argument("--aws_unsigned", type=flag, default=True, help="access is the session's; taken and not used")
    p.add_argument("--overwrite", type=flag, default=True)
    p = command("continental", version="vector_version")
    p.add_argument("--continental_version")
    p.add_argument("--shorelines", type=flag, default=True)
    p.add_argument("--ratesofchange", type=flag, default=True)
    p.add_argument("--hotspots", type=flag, default=True)
    p.add_argument("--hotspots_radius", type=float, action="append")
    p.add_argument("--baseline_year", type=int, default=2021)
    p.add_argument("--shapefiles", type=flag, default=True, help="also write each layer as newline-delimited GeoJSON")
    p.add_argument("--include-styles", dest="include_styles", type=flag, default=True, help="copy root/styles.csv where there is one")
    p = command("validation", version="vector_version")
    p.add_argument("--inputs_path", required=True)
    p.add_argument("--prefix", default="temp")
    p.add_argument("--datum", type=float, default=0.0)
    p.add_argument("--adapter", choices=sorted(ADAPTERS), help="inputs_path holds this programme's raw table; without it, profiles")
    p.add_argument("--overwrite", type=flag, default=False)
    p.add_argument("--layer_name", default="shorelines")
    p.add_argument("--append_stats", type=flag, default=False)
    p.add_argument("--parallelised", type=flag, default=True, help="Spark deals out the work; taken and not used")
    p.add_argument("--markdown_report", type=flag, default=False)
    return top


def raster(spark: SparkSession, a) -> None:
    out = f"{a.root}/rasters/{a.raster_version}"
    if not a.overwrite and sinks.completed(spark, f"{out}/gapfill/{a.study_area}"):
        return
    if not sinks.exists(spark, f"{a.root}/tides"):
        raise NoTides(f"there is no {a.root}/tides")
    tides = spark.read.parquet(f"{a.root}/tides").where(F.col("tile") == a.study_area)
    obs = layers.pixels(spark, f"{a.root}/pixels", a.study_area, a.start_year, a.end_year)
    # a table for each tile, so that tiles can be written and skipped one by one
    sinks.write_table(layers.grid_of(obs), f"{out}/grid/{a.study_area}")
    place = layers.place_of(spark, f"{out}/grid/{a.study_area}")
    obs = C.water_index(obs).select("tile", "time", "yi", "xi", "y", "x", "tide_m", "cloud_mask", "mndwi")
    obs = X.erase_cleaned(obs, "cloud_mask", BAD, ["mndwi"])
    if sinks.exists(spark, f"{a.root}/dem") and sinks.exists(spark, f"{a.root}/sun"):
        dem = C.elevation(spark.read.parquet(f"{a.root}/dem")).withColumn("elevation", F.col("elevation") / PIXEL_SIZE)
        obs = X.erase_shadow(obs, dem, spark.read.parquet(f"{a.root}/sun"), ["mndwi"])
    obs = mid_tide(obs.where("mndwi is not null").withColumn("year", F.year("time")), tides, a.tide_centre)
    for name, composite in (("annual", C.annual_composite), ("gapfill", C.pooled_composite)):
        sinks.write_table(composite(obs, "mndwi", a.start_year, a.end_year), f"{out}/{name}/{a.study_area}")
        write_rasters(spark.read.parquet(f"{out}/{name}/{a.study_area}"), f"{out}/tiff/{a.study_area}", "" if name == "annual" else "_gapfill", place)


def mid_tide(obs: DataFrame, tides: DataFrame, centre: float) -> DataFrame:
    """Observations near the middle of the tides: within limits that are interpolated between the cells of a coarse tide table."""
    pixels = obs.select("yi", "xi", "y", "x").distinct()
    limits = C.bilinear_cutoffs(pixels, C.tide_cutoffs(tides, ["cy", "cx"], centre=centre), "y", "x", CELL_SIZE)
    return C.tidal_subset(obs, limits.select("yi", "xi", "tide_min", "tide_max"), ["yi", "xi"])


def write_rasters(composite: DataFrame, folder: str, suffix: str, place: dict) -> None:
    """A file for each year and variable of a tile's composite."""
    for name, (kind, nodata) in RASTERS.items():
        files = tiff.encoded(X.to_blocks(composite, name), kind, nodata, PIXEL_SIZE, place)
        sinks.write_files(files.select(F.concat(F.lit(f"{folder}/"), F.col("year").cast("string"), F.lit(f"_{name}{suffix}.tif")).alias("path"), "content"))


def on_plane(x: Column, y: Column, place: dict) -> tuple[Column, Column]:
    """Cell units as metres of the projection."""
    return place["x0"] + place["dx"] * x, place["y0"] + place["dy"] * y


def degrees(x: Column, y: Column, place: dict) -> Column:
    return geodesy.albers_inverse(*on_plane(x, y, place))


def shoreline_points(lines: DataFrame, combined: DataFrame, baseline: int, index: str, place: dict) -> DataFrame:
    """Signed distances of every year's shoreline from points along the baseline, in cell units times the cell's size.

    A point's name is the geohash of its place; the angle is the geodesic bearing of its shift.
    """
    keys = ["tile", "year", "line"]
    parts = S.segments(lines, keys)
    base = S.points_on_lines(lines.where(F.col("year") == baseline), keys, 1.0)
    name = let(degrees(F.col("px"), F.col("py"), place), lambda p: geodesy.geohash(p["lon"], p["lat"], 10))
    # lines that touch can put two points in one place
    points = base.withColumn("uid", name).groupBy("tile", "uid").agg(F.min(F.struct("px", "py")).alias("_p")).select("tile", "uid", "_p.*")
    near = S.nearest_on_lines(points.drop("tile"), parts.withColumn("seg", F.struct("line", "seg")), ["uid", "px", "py"], ["year"], 1200 / PIXEL_SIZE)
    here = points.select("tile", "uid").join(near, "uid")
    grid = combined.select("tile", "year", "yi", "xi", F.col(index).alias("v"))
    there = S.bilinear_sample(here.select("tile", "uid", F.col("year").alias("y"), F.col("qy").alias("gy"), F.col("qx").alias("gx")), grid.where(F.col("year") == baseline).drop("year"), "v", ["uid", "y"], ["tile"])
    other = S.bilinear_sample(here.select("tile", "year", "uid", F.col("py").alias("gy"), F.col("px").alias("gx")), grid, "v", ["uid"], ["tile", "year"])
    both = here.join(there.select("uid", F.col("y").alias("year"), F.col("v").alias("there")), ["uid", "year"]).join(other.select("uid", "year", F.col("v").alias("here")), ["uid", "year"])
    moved = R.movement(F.col("distance") * PIXEL_SIZE, F.col("there"), F.col("here"))
    ends = F.struct(degrees(F.col("px"), F.col("py"), place).alias("p"), degrees(F.col("qx"), F.col("qy"), place).alias("q"))
    angle = let(ends, lambda e: geodesy.bearing(e["p"]["lon"], e["p"]["lat"], e["q"]["lon"], e["q"]["lat"]))
    return both.select("tile", "uid", "px", "py", "year", F.when(F.col("year") == baseline, 0.0).otherwise(moved).alias("dist"), angle.alias("angle"))


def certain_parts(lines: DataFrame, combined: DataFrame) -> DataFrame:
    """The segments of shorelines with the certainty of the cell that they cross, and their datum."""
    classes = X.to_pixels(X.certainty_blocks(combined), "class", "int")
    parts = S.segment_classes(S.segments(lines, ["tile", "year", "line"]), classes, ["tile", "year"])
    return parts.withColumn("certainty", C.certainty_name(F.coalesce("class", F.lit(0)), F.col("year"), F.lit(None).cast("double"))).withColumn("tide_datum", F.lit("0.0 m AMSL")).drop("class")


def line_features(spark: SparkSession, parts: DataFrame, root: str, place: dict) -> DataFrame:
    """A feature for each year, certainty and region: the runs of segments that share them, on the plane and in degrees."""
    line = ["tile", "year", "line"]
    w = Window.partitionBy(*line).orderBy("seg")
    new = F.coalesce(F.lag("certainty").over(w) != F.col("certainty"), F.lit(True))
    runs = parts.withColumn("_new", new.cast("int")).withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    vertex = F.struct("seg", F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")).alias("p"))
    last = F.max(F.struct("seg", F.struct(F.col("x2").alias("x"), F.col("y2").alias("y")).alias("p")))
    runs = runs.groupBy(*line, "_run", "certainty", "tide_datum").agg(F.array_sort(F.collect_list(vertex)).alias("_v"), last.alias("_l"))
    cells = F.concat(F.transform("_v", lambda v: v["p"]), F.array(F.col("_l.p")))

    def moved(p: Column) -> Column:
        x, y = on_plane(p["x"], p["y"], place)
        return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))

    def turned(p: Column) -> Column:
        return let(geodesy.albers_inverse(p["x"], p["y"]), lambda d: F.struct(d["lon"].alias("x"), d["lat"].alias("y")))

    runs = runs.withColumn("plane", F.transform(cells, moved))
    runs = runs.withColumns({"turned": F.transform("plane", turned), "px": F.get("plane", F.lit(0))["x"], "py": F.get("plane", F.lit(0))["y"]})
    if sinks.exists(spark, f"{root}/regions"):
        named = S.in_polygons(runs.select(*line, "_run", "px", "py"), spark.read.parquet(f"{root}/regions"), ["id_primary"])
        runs = runs.join(named.groupBy(*line, "_run").agg(F.min("id_primary").alias("id_primary")), [*line, "_run"])
    else:
        runs = runs.withColumn("id_primary", F.lit(None).cast("string"))
    lists = (F.array_sort(F.collect_list(c)).alias(c) for c in ("plane", "turned"))
    return runs.groupBy("tile", "year", "certainty", "tide_datum", "id_primary").agg(*lists)


def named_points(points: DataFrame) -> DataFrame:
    return points.withColumnsRenamed(NAMES).withColumn("outl_time", F.array_join("outliers", " ")).drop("outliers", "incpt")


def published_points(points: DataFrame) -> DataFrame:
    place = sinks.geometry_json("Point", F.col("lon"), F.col("lat")).alias("geometry")
    return sinks.sink_view(named_points(points).select("*", place).drop("tile", "px", "py", "x", "y", "lon", "lat"))


def with_facts(spark: SparkSession, points: DataFrame, root: str) -> DataFrame:
    """Whether a point is on a rocky shore, and its region, where ``geomorphology`` and ``regions`` tables are there."""
    out = points
    if sinks.exists(spark, f"{root}/geomorphology"):
        shores = spark.read.parquet(f"{root}/geomorphology").withColumn("hard", R.is_rocky(F.col("INTERTD1_V"), F.col("INTERTD2_V")))
        here = points.select("uid", F.col("x").alias("cx"), F.col("y").alias("cy"))
        out = out.join(S.rocky_flag(here, shores, "uid", "hard"), "uid", "left")
    else:
        out = out.withColumn("rocky", F.lit(False))
    if sinks.exists(spark, f"{root}/regions"):
        here = points.select("uid", F.col("x").alias("px"), F.col("y").alias("py"))
        region = S.in_polygons(here, spark.read.parquet(f"{root}/regions"), ["id_primary"]).groupBy("uid").agg(F.min("id_primary").alias("id_primary"))
        return out.join(region, "uid", "left")
    return out.withColumn("id_primary", F.lit(None).cast("string"))


def vector(spark: SparkSession, a) -> None:
    out = f"{a.root}/vectors/{a.vector_version or a.raster_version}"
    if not a.overwrite and sinks.completed(spark, f"{out}/points/{a.study_area}"):
        return
    source = f"{a.root}/rasters/{a.raster_version}"
    if not sinks.exists(spark, f"{source}/grid/{a.study_area}"):
        raise FileNotFoundError(f"{source}: no rasters of {a.study_area}")
    place = layers.place_of(spark, f"{source}/grid/{a.study_area}")
    annual, gapfill = (layers.annual_rasters(spark, f"{source}/{k}/{a.study_area}", a.start_year, a.end_year) for k in ("annual", "gapfill"))
    combined = C.gapfill_select(annual, gapfill, a.water_index)
    ocean = spark.read.parquet(f"{a.root}/ocean").where(F.col("tile") == a.study_area) if sinks.exists(spark, f"{a.root}/ocean") else None
    edits = None
    if sinks.exists(spark, f"{a.root}/modifications"):
        shapes = spark.read.parquet(f"{a.root}/modifications").select("ring", F.when(F.col("type") == "add", 1).otherwise(2).alias("type"))
        x, y = on_plane(F.col("xi"), F.col("yi"), place)
        cells = combined.select("tile", "yi", "xi", x.alias("px"), y.alias("py")).distinct()
        edits = S.rasterize(cells, shapes, "type").where("type > 0").select("tile", "yi", "xi", "type")
    blocks = X.coastal_blocks(X.to_blocks(combined, a.water_index), a.index_threshold, ocean=ocean, edits=edits)
    sinks.write_table(X.shorelines(blocks, a.index_threshold), f"{out}/shorelines/{a.study_area}")
    lines = spark.read.parquet(f"{out}/shorelines/{a.study_area}")
    if lines.isEmpty():
        raise ValueError("no shorelines were found")
    sinks.write_table(shoreline_points(lines, annual, a.baseline_year, a.water_index, place), f"{out}/movements/{a.study_area}")
    moves = spark.read.parquet(f"{out}/movements/{a.study_area}")
    sinks.write_table(certain_parts(lines, combined), f"{out}/shoreline_parts/{a.study_area}")
    sinks.write_table(spark.read.parquet(f"{source}/grid/{a.study_area}"), f"{out}/grid/{a.study_area}")
    sinks.write_table(line_features(spark, spark.read.parquet(f"{out}/shoreline_parts/{a.study_area}"), a.root, place), f"{out}/shoreline_features/{a.study_area}")
    shown = spark.read.parquet(f"{out}/shoreline_features/{a.study_area}")
    sinks.write_geojson(sinks.sink_view(shown.drop("tile", "plane").withColumn("geometry", sinks.lines_json(F.col("turned"))).drop("turned")), f"{out}/annualshorelines/{a.study_area}.geojson")
    write_shapes(shown.drop("turned").withColumnRenamed("plane", "parts"), "annualshorelines", False, f"{out}/shapefiles")
    table = R.rate_table(moves, ["uid"], a.start_year)
    mean, std = circular(F.col("angle"))
    points = moves.groupBy("tile", "uid").agg(
        F.first("px").alias("px"), F.first("py").alias("py"), F.bround(mean).cast("int").alias("angle_mean"), F.bround(std).cast("int").alias("angle_std")
    )
    x, y = on_plane(F.col("px"), F.col("py"), place)
    points = points.withColumns({"x": x, "y": y}).withColumn("_d", geodesy.albers_inverse(F.col("x"), F.col("y")))
    points = points.withColumns({"lon": F.col("_d.lon"), "lat": F.col("_d.lat")}).drop("_d")
    both = with_facts(spark, points, a.root).join(table, "uid")
    sure = R.point_certainty(
        F.array_contains("outliers", a.baseline_year), F.coalesce("rocky", F.lit(False)), F.col("rate"), F.col("angle_std"), F.col("valid_obs"), a.end_year - a.start_year + 1
    )
    sinks.write_table(both.withColumn("certainty", sure).drop("rocky"), f"{out}/points/{a.study_area}")
    shown = spark.read.parquet(f"{out}/points/{a.study_area}")
    sinks.write_geojson(published_points(shown), f"{out}/ratesofchange/{a.study_area}.geojson")
    write_shapes(point_parts(named_points(shown), "x", "y").drop("lon", "lat", "px", "py"), "ratesofchange", True, f"{out}/shapefiles")


def point_parts(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.withColumn("parts", F.array(F.array(F.struct(F.col(x).alias("x"), F.col(y).alias("y"))))).drop(x, y)


def write_shapes(df: DataFrame, layer: str, points: bool, folder: str, by: str = "tile", package: bool = False) -> None:
    """A zipped shapefile, or a GeoPackage, for each study area."""
    shown = sinks.sink_view(df, {by: "string(40)"}, keep=("parts",))
    path = F.concat(F.lit(f"{folder}/{layer}_"), F.col(by), F.lit(".gpkg" if package else ".zip"))
    sinks.write_files(published.files(shown, by, layer, points, path, package))


def placed_cells(df: DataFrame, grids: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """Pairs of columns in cell units as metres, tile by tile; there is one row for each tile in ``grids``."""
    out = df.join(F.broadcast(grids), "tile")
    for x, y in pairs:
        out = out.withColumns({x: F.col("x0") + F.col("dx") * F.col(x), y: F.col("y0") + F.col("dy") * F.col(y)})
    return out.drop("x0", "dx", "y0", "dy")


def continental(spark: SparkSession, a) -> None:
    source, out = f"{a.root}/vectors/{a.vector_version}", f"{a.root}/continental/{a.continental_version or a.vector_version}"
    for wanted, name in ((a.shorelines, "shorelines"), (a.ratesofchange, "points")):
        if wanted:
            sinks.write_table(spark.read.option("recursiveFileLookup", True).parquet(f"{source}/{name}"), f"{out}/{name}")
    if a.shapefiles and a.ratesofchange:
        sinks.write_geojson(published_points(spark.read.parquet(f"{out}/points")), f"{out}/points.geojson")
    if a.shapefiles and a.shorelines:
        # the tiles' features as they are: lines of text
        spark.read.option("recursiveFileLookup", True).text(f"{source}/annualshorelines").write.mode("overwrite").text(f"{out}/shorelines.geojson")
    if a.include_styles and sinks.exists(spark, f"{a.root}/styles.csv"):
        spark.read.option("header", True).csv(f"{a.root}/styles.csv").write.mode("overwrite").option("header", True).csv(f"{out}/styles")
    if not a.hotspots:
        return
    read = spark.read.option("recursiveFileLookup", True)
    grids = read.parquet(f"{source}/grid")
    good = read.parquet(f"{source}/points").where("certainty = 'good'").select("uid")
    moves = read.parquet(f"{source}/movements").join(good, "uid", "left_semi")
    moves = placed_cells(moves, grids, ("px", "py"))
    lines = placed_cells(read.parquet(f"{source}/shorelines").where(F.col("year") == a.baseline_year), grids, ("x", "y"))
    places = moves.select("uid", "px", "py").distinct()
    for i, radius in enumerate(a.hotspots_radius or [10000.0, 5000.0, 1000.0]):
        centres = S.points_on_lines(lines, ["tile", "line"], float(int(radius / 2)))
        name = let(geodesy.albers_inverse(F.col("px"), F.col("py")), lambda d: geodesy.geohash(d["lon"], d["lat"], 11))
        centres = centres.select(name.alias("uid"), F.col("px").alias("cx"), F.col("py").alias("cy")).dropDuplicates(["uid"])
        fit = R.change_regress(S.hotspots(centres, moves, radius), ["uid"], "year", "dist")
        rows = S.hotspot_counts(centres, places, radius).join(fit, "uid", "left")
        named = rows.withColumnsRenamed(NAMES)
        sinks.write_table(R.wms_fields(named), f"{out}/hotspots_zoom_{i + 1}")
        if a.shapefiles:
            shown = spark.read.parquet(f"{out}/hotspots_zoom_{i + 1}")
            shown = shown.drop("incpt", *(c for c, kind in shown.dtypes if kind.startswith("array")))
            turned = shown.withColumn("_d", geodesy.albers_inverse(F.col("cx"), F.col("cy"))).drop("cx", "cy")
            turned = turned.withColumn("geometry", sinks.geometry_json("Point", F.col("_d.lon"), F.col("_d.lat"))).drop("_d")
            sinks.write_geojson(sinks.sink_view(turned), f"{out}/hotspots_zoom_{i + 1}.geojson")
            # the hotspots of a coast are few: one file
            write_shapes(point_parts(shown, "cx", "cy").withColumn("zoom", F.lit(str(i + 1))), "hotspots_zoom", True, out, "zoom", True)


def validate(spark: SparkSession, a) -> None:
    out = f"{a.root}/validation/{a.prefix}"
    if not a.overwrite and sinks.completed(spark, out):
        return
    raw, value = spark.read.parquet(a.inputs_path), f"{a.datum:g}_dist"
    if a.adapter:
        water = ADAPTERS[a.adapter](raw, datum=a.datum)
        ends = water.groupBy("id").agg(*(F.min_by(c, "date").alias(c) for c in adapters.ENDS))
    else:
        water, ends = surveys.waterline_intercept(raw, datum=a.datum), surveys.endpoints(raw)
        if "source" in raw.columns:
            water = water.join(surveys.first_and_mode(raw, surveys.PROFILE, (), ["source"]), list(surveys.PROFILE))
    modes = ["source"] if "source" in water.columns else []
    years = validation.by_year(water, value=value, modes=modes).join(ends, "id")
    parts = S.segments(spark.read.option("recursiveFileLookup", True).parquet(f"{a.root}/vectors/{a.vector_version}/{a.layer_name}"), ["tile", "year", "line"])
    grids = spark.read.option("recursiveFileLookup", True).parquet(f"{a.root}/vectors/{a.vector_version}/grid")
    scaled = placed_cells(parts, grids, ("x1", "y1"), ("x2", "y2"))
    rays = years.select("id", "year", F.col("start_x").alias("sx"), F.col("start_y").alias("sy"), F.col("end_x").alias("ex"), F.col("end_y").alias("ey"))
    result = validation.validated(years, S.line_crossings(rays, scaled, ["id"], ["year"]))
    sinks.write_table(result, out)
    result = spark.read.parquet(out)
    stats = validation.accuracy(result, "val_dist", "product_dist", weight="n")
    if modes:
        plain, corrected = (validation.accuracy(result, "val_dist", "product_dist", modes, "n", remove_bias=b) for b in (False, True))
        sinks.write_table(validation.accuracy_table(plain, corrected, "source"), f"{out}_by_source")
    for name, layer in validation.evaluation_layers(result).items():
        sinks.write_geojson(layer, f"{out}_{name}.geojson")
    if a.markdown_report:
        before = None
        if sinks.exists(spark, f"{a.root}/stats"):
            log = spark.read.option("header", True).csv(f"{a.root}/stats")
            before = log.orderBy(F.desc("time")).limit(1).collect()
        text = validation.markdown_report(stats.first().asDict(), before[0].asDict() if before else None)
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{a.root}/report/{a.prefix}")
    if a.append_stats:
        sinks.append_log(stats.withColumn("time", F.current_timestamp()).withColumn("name", F.lit(a.prefix)), f"{a.root}/stats")


COMMANDS = {"raster": raster, "vector": vector, "continental": continental, "validation": validate}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    try:
        spark = spark or SparkSession.getActiveSession() or local_session()
        if a.root is None:
            a.root = load_config("\n".join(r.value for r in spark.read.text(a.config_path).collect()))["root"]
        COMMANDS[a.command](spark, a)
    except NoTides as missing:
        print(missing, file=sys.stderr)
        return 2
    except Exception:
        traceback.print_exc()
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
