"""The driver's tables in the roles of the library's inputs, once as DataFrames and once as SQL.

``lineitem`` plays pixel observations, ``events`` survey profiles and runs, hashed keys give places on a plane.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

START, END = 1996, 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return table(spark, sf_dir, "lineitem").select(
        (c("l_suppkey") % 4).cast("string").alias("tile"), c("l_suppkey").cast("int").alias("yi"), (c("l_partkey") % 20).cast("int").alias("xi"),
        c("l_shipdate").alias("time"), F.year("l_shipdate").alias("year"), (c("l_extendedprice") / 1000).alias("green"), c("l_quantity").alias("swir1"),
        (c("l_tax") * 500).alias("nir"), (c("l_discount") * 20 - 1).alias("tide_m"), c("l_returnflag").alias("cloud_mask"),
        c("l_linestatus").alias("product"), (c("l_orderkey") * 10 + c("l_linenumber")).alias("scene"),
    )


OBS = """obs AS (SELECT (l_suppkey % 4)::VARCHAR AS tile, l_suppkey::INT AS yi, (l_partkey % 20)::INT AS xi, l_shipdate AS time,
  year(l_shipdate)::INT AS year, l_extendedprice / 1000 AS green, l_quantity AS swir1, l_tax * 500 AS nir, l_discount * 20 - 1 AS tide_m,
  l_returnflag AS cloud_mask, l_linestatus AS product, l_orderkey * 10 + l_linenumber AS scene FROM lineitem),
idx AS (SELECT *, (green - swir1) / nullif(green + swir1, 0) AS mndwi FROM obs)"""


def movements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``uid, year, value``: the median unit price of each supplier and year, a value that drifts."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("uid"), F.year("l_shipdate").alias("year"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("v"))
    return rows.groupBy("uid", "year").agg(F.median("v").alias("value"))


MOVES = """moves AS (SELECT l_suppkey AS uid, year(l_shipdate)::INT AS year, median(l_extendedprice / l_quantity) AS value FROM lineitem GROUP BY 1, 2),
disp AS (SELECT m.uid, m.year, m.value, m.value - b.value AS dist FROM moves m JOIN moves b ON b.uid = m.uid AND b.year = 1998)"""


def place(key: Column, factor: int) -> Column:
    """A coordinate on a plane of 10 km, from a key."""
    return ((key * factor) % 10007).cast("double")


def places(df: DataFrame, key: str, x: str, y: str) -> DataFrame:
    return df.withColumns({x: place(F.col(key), 7919), y: place(F.col(key), 104729)})


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survey rows: a user's events of a day in order; heights fall along the profile, by the event's value."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.concat(F.lit("p"), (F.col("user_id") % 50).cast("string")).alias("id"),
        F.to_date("ts").alias("date"),
        F.col("event_id").alias("ord"),
        (F.col("event_id") % 97).cast("double").alias("distance"),
        (F.col("value") * 0.09731 - (F.col("event_id") % 97) * 0.05173).alias("z"),
        ((F.col("event_id") % 97) * 3.0 + F.col("user_id") % 50).alias("x"),
        ((F.col("event_id") % 97) * 4.0 + F.col("event_id") % 3).alias("y"),
        F.col("event_type").alias("source"),
    )


PROFILES = """prof AS (SELECT 'p' || (user_id % 50)::VARCHAR AS id, ts::DATE AS date, event_id AS ord, (event_id % 97)::DOUBLE AS distance,
  value * 0.09731::DOUBLE - (event_id % 97) * 0.05173::DOUBLE AS z, (event_id % 97) * 3.0::DOUBLE + user_id % 50 AS x, (event_id % 97) * 4.0::DOUBLE + event_id % 3 AS y,
  event_type AS source FROM events)"""


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of a 40 x 40 raster with the mean discount of their line items, centred: a rough surface about 0."""
    li = table(spark, sf_dir, "lineitem")
    cells = li.groupBy((F.col("l_suppkey") * 7 % 40).cast("int").alias("yi"), (F.col("l_partkey") * 3 % 40).cast("int").alias("xi"))
    return cells.agg((F.round(F.avg("l_discount"), 6) - 0.05).alias("v"))


GRID = """grid AS (SELECT (l_suppkey * 7 % 40)::INT AS yi, (l_partkey * 3 % 40)::INT AS xi, round(avg(l_discount), 6) - 0.05 AS v
  FROM lineitem GROUP BY 1, 2)"""
