"""Sinks: typed views, GeoJSON text, CSV logs and completed-run marks."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions.numbers import half_even

# Types of the columns of published layers, and the widths of texts; every other column is decimal(8,2).
SINK_TYPES = {
    "id_primary": "string(10)", "uid": "string(11)", "certainty": "string(25)", "tide_datum": "string(20)", "outl_time": "string(80)",
    "rate_time": "decimal(8,2)", "sig_time": "decimal(8,3)", "se_time": "decimal(8,2)", "year": "int", "valid_obs": "int", "valid_span": "int",
    "max_year": "int", "min_year": "int", "angle_mean": "int", "angle_std": "int", "n": "int", "radius_m": "int",
    "sce": "decimal(8,2)", "nsm": "decimal(8,2)", "wms_conf": "decimal(8,1)", "wms_grew": "int", "wms_retr": "int", "wms_sig": "int",
}
DEFAULT_TYPE = "decimal(8,2)"


def sink_view(df: DataFrame, types: Mapping[str, str] | None = None, default: str = DEFAULT_TYPE, keep: tuple[str, ...] = ("geometry",)) -> DataFrame:
    """Columns cast to their published types; numbers are rounded half to even first, texts cut to their width."""
    names = {**SINK_TYPES, **(types or {})}

    def shown(c: str) -> Column:
        kind = names.get(c, default)
        if c in keep:
            return F.col(c)
        if kind.startswith("decimal"):
            digits = int(kind.rstrip(")").split(",")[1])
            return half_even(F.col(c).cast("double"), digits).cast(kind).alias(c)
        if kind.startswith("string("):
            return F.substring(F.col(c).cast("string"), 1, int(kind[7:-1])).alias(c)
        return F.col(c).cast(kind).alias(c)

    return df.select(*(shown(c) for c in df.columns))


def lines_json(lines: Column) -> Column:
    """A MultiLineString from an array of lines, each an array of points."""
    pairs = F.transform(lines, lambda line: F.transform(line, lambda p: F.array(p["x"], p["y"])))
    return F.struct(F.lit("MultiLineString").alias("type"), pairs.alias("coordinates"))


def geometry_json(kind: str, x: Column | None = None, y: Column | None = None, points: Column | None = None) -> Column:
    """A Point from two columns, or a LineString or Polygon from an array of points, as a GeoJSON struct."""
    if kind == "Point":
        return F.struct(F.lit("Point").alias("type"), F.array(x, y).alias("coordinates"))
    pairs = F.transform(points, lambda p: F.array(p["x"], p["y"]))
    return F.struct(F.lit(kind).alias("type"), (F.array(pairs) if kind == "Polygon" else pairs).alias("coordinates"))


def features(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """One GeoJSON feature as text in each row: newline-delimited GeoJSON, which can be written and read in parts."""
    properties = F.struct(*(c for c in df.columns if c != geometry))
    feature = F.struct(F.lit("Feature").alias("type"), properties.alias("properties"), F.col(geometry).alias("geometry"))
    return df.select(F.to_json(feature, {"ignoreNullFields": "false"}).alias("value"))


def write_geojson(df: DataFrame, path: str, geometry: str = "geometry") -> None:
    features(df, geometry).write.mode("overwrite").text(path)


def write_files(files: DataFrame) -> None:
    """Write rows ``path, content`` as files, each by the task that has it. A task that runs again writes the same bytes."""

    def put(rows) -> None:
        from pyarrow import fs

        for row in rows:
            store, path = fs.FileSystem.from_uri(row.path)
            store.create_dir(path.rpartition("/")[0], recursive=True)
            with store.open_output_stream(path) as out:
                out.write(bytes(row.content))

    files.select("path", "content").foreachPartition(put)


def append_log(df: DataFrame, path: str) -> None:
    """Run metrics: one more file in a folder of CSV files with headers."""
    df.write.mode("append").option("header", True).csv(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, in whatever store Spark reads it from."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def completed(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to its end, by the mark that the committer leaves."""
    return exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def write_table(df: DataFrame, path: str, overwrite: bool = True, by: tuple[str, ...] = ()) -> bool:
    """Write unless it is there already and ``overwrite`` is off; whether it was written."""
    if not overwrite and completed(df.sparkSession, path):
        return False
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if by else "static")
    (writer.partitionBy(*by) if by else writer).parquet(path)
    return True
