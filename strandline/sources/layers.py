"""Readers of tables and vector layers."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GEOJSON = "features array<struct<type:string,properties:map<string,string>,geometry:struct<type:string,coordinates:string>>>"


def annual_rasters(spark: SparkSession, path: str, start: int = 1988, end: int = 2021, tile: str | None = None) -> DataFrame:
    """Composites of a tile and range of years; partition folders ``tile=…/year=…`` outside them are not listed.

    An empty range is an error, as no shoreline can come of it.
    """
    df = spark.read.parquet(path).where(F.col("year").between(start, end))
    df = df if tile is None else df.where(F.col("tile") == tile)
    if df.isEmpty():
        raise FileNotFoundError(f"{path}: no rasters from {start} to {end}")
    return df


def pixels(spark: SparkSession, path: str, tile: str, start: int, end: int, maturity: str | None = "final", quality: tuple[float, float] = (0, 1)) -> DataFrame:
    """Observations of a tile, a year before and after included; all limits are pushed to the scan."""
    return good_scenes(spark.read.parquet(path).where(F.col("tile") == tile), start, end, maturity, quality)


def good_scenes(df: DataFrame, start: int, end: int, maturity: str | None = "final", quality: tuple[float, float] = (0, 1)) -> DataFrame:
    """Observations from the year before ``start`` to the year after ``end``, of scenes of a maturity and a geometric quality."""
    df = df.where(F.col("time").between(f"{start - 1}-01-01", f"{end + 1}-12-31 23:59:59"))
    if maturity is not None and "maturity" in df.columns:
        df = df.where(F.col("maturity") == maturity)
    return df.where(F.col("gqa_iterative_mean_xy").between(*quality)) if "gqa_iterative_mean_xy" in df.columns else df


def grid_of(obs: DataFrame) -> DataFrame:
    """Where the cells of each tile lie: a centre is at ``x0 + dx * xi, y0 + dy * yi``."""
    sums = [f(*c).alias(n) for c, names in (((F.col("x"), F.col("xi")), ("dx", "x0")), ((F.col("y"), F.col("yi")), ("dy", "y0"))) for f, n in zip((F.regr_slope, F.regr_intercept), names, strict=True)]
    return obs.groupBy("tile").agg(*sums)


def place_of(spark: SparkSession, path: str, size: float = 30.0) -> dict[str, float]:
    """The numbers of a table that ``grid_of`` made for one tile; cells of the given size from 0 where it can't tell."""
    row = spark.read.parquet(path).first()
    return {c: (0.0 if c.endswith("0") else size) if row is None or row[c] is None else row[c] for c in ("x0", "dx", "y0", "dy")}


def geojson(spark: SparkSession, path: str, bbox: Sequence[float] | None = None, by_line: bool = False) -> DataFrame:
    """``properties`` (map) and ``points`` (array of x, y: a point, a line or a polygon's outer ring) of each feature.

    Reads collections (a file is one task's), or with ``by_line`` newline-delimited features, which split. Of lines and polygons in several parts each part is a row.
    ``bbox`` (minx, miny, maxx, maxy) keeps the features that touch it.
    """
    raw = spark.read.schema("type string, properties map<string,string>, geometry struct<type:string,coordinates:string>, " + GEOJSON)
    rows = raw.option("multiLine", not by_line).json(path)
    each = rows.withColumn("f", F.explode_outer("features")).select(
        F.coalesce("f.properties", "properties").alias("properties"), F.coalesce("f.geometry", "geometry").alias("g")
    )
    pair, line, many, all_ = (f"{'array<' * d}double{'>' * d}" for d in (1, 2, 3, 4))
    kind, text = F.col("g.type"), F.col("g.coordinates")
    parts = (
        F.when(kind == "Point", F.array(F.array(F.from_json(text, pair))))
        .when(kind.isin("MultiPoint", "LineString"), F.array(F.from_json(text, line)))
        .when(kind == "MultiLineString", F.from_json(text, many))
        .when(kind == "Polygon", F.slice(F.from_json(text, many), 1, 1))
        .when(kind == "MultiPolygon", F.transform(F.from_json(text, all_), lambda p: F.get(p, F.lit(0))))
    )
    out = each.select("properties", kind.alias("kind"), F.posexplode(parts).alias("part", "xy"))
    out = out.select("properties", "kind", "part", F.transform("xy", lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y"))).alias("points"))
    if bbox is None:
        return out
    x, y = F.transform("points", lambda p: p["x"]), F.transform("points", lambda p: p["y"])
    touches = (F.array_max(x) >= bbox[0]) & (F.array_min(x) <= bbox[2]) & (F.array_max(y) >= bbox[1]) & (F.array_min(y) <= bbox[3])
    return out.where(touches)


def on_plane(layer: DataFrame, points: str = "points") -> DataFrame:
    """A layer in degrees with its ``points`` on the Albers plane."""
    from strandline.functions import geodesy

    def place(p):
        return geodesy.albers(p["x"], p["y"])

    return layer.withColumn(points, F.transform(points, place))


def merged_tiles(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The layers of all tiles as one; a tile may lack columns."""
    from functools import reduce

    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (spark.read.parquet(p) for p in paths))
