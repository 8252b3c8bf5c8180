"""Queries of raster neighbourhoods."""

import numpy as np
from pyspark.sql import functions as F

from strandline.functions import kernels
from strandline.operators import rasters as R
from strandline.plans.standins import GRID, grid, table

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


_DISC = "disc AS (SELECT a AS dy, b AS dx FROM range(-3, 4) s(a), range(-3, 4) t(b) WHERE a * a + b * b <= 9)"
_ALL = "alls AS (SELECT y::INT AS yi, x::INT AS xi FROM range(0, 40) s(y), range(0, 40) t(x))"
_HIGH = "high AS (SELECT yi, xi FROM grid WHERE v > 0.004)"


def _blocks(spark, sf):
    g = grid(spark, sf).withColumns({"tile": F.lit("t"), "year": F.lit(2000)})
    # every cell of the raster, so that the block's extent doesn't hang on the data
    full = spark.range(1600).select((F.col("id") / 40).cast("int").alias("yi"), (F.col("id") % 40).cast("int").alias("xi"), F.lit("t").alias("tile"), F.lit(2000).alias("year"))
    return R.to_blocks(full.join(g, ["tile", "year", "yi", "xi"], "left"), "v")


def _cells(blocks):
    return R.to_pixels(blocks, "v").where("v > 0").select("yi", "xi")


@query(f"WITH {GRID}, {_DISC}, {_HIGH} SELECT DISTINCT (yi + dy)::INT AS yi, (xi + dx)::INT AS xi FROM high, disc")
def dilate_cells(spark, sf):
    high = grid(spark, sf).where("v > 0.004")
    return R.dilate_cells(high, [], 3)


@query(f"WITH {GRID}, {_DISC}, {_HIGH}, {_ALL} SELECT yi, xi FROM alls WHERE (yi, xi) IN (SELECT (yi + dy, xi + dx) FROM high, disc)")
def binary_dilation(spark, sf):
    return _cells(R.apply_kernel(_blocks(spark, sf), lambda v: kernels.dilate(v > 0.004, 3)))


@query(f"""WITH {GRID}, {_DISC}, {_ALL}, low AS (SELECT yi, xi FROM alls WHERE (yi, xi) NOT IN (SELECT (yi, xi) FROM grid WHERE v > -0.004))
SELECT yi, xi FROM alls WHERE (yi, xi) NOT IN (SELECT (yi + dy, xi + dx) FROM low, disc WHERE dy * dy + dx * dx <= 1)""")
def binary_erosion(spark, sf):
    return _cells(R.apply_kernel(_blocks(spark, sf), lambda v: kernels.erode(v > -0.004, 1)))


@query(f"""WITH {GRID}, {_DISC}, {_ALL}, one AS (SELECT * FROM disc WHERE dy * dy + dx * dx <= 4), {_HIGH},
wide AS (SELECT yi, xi FROM alls WHERE (yi, xi) IN (SELECT (yi + dy, xi + dx) FROM high, one)),
gone AS (SELECT yi, xi FROM alls WHERE (yi, xi) NOT IN (SELECT (yi, xi) FROM wide)),
closed AS (SELECT yi, xi FROM alls WHERE (yi, xi) NOT IN (SELECT (yi + dy, xi + dx) FROM gone, one))
SELECT yi, xi FROM closed WHERE (yi, xi) NOT IN (SELECT (yi, xi) FROM high)""")
def black_tophat(spark, sf):
    return _cells(R.apply_kernel(_blocks(spark, sf), lambda v: kernels.black_tophat(v > 0.004, 2)))


@query(f"""WITH RECURSIVE {GRID}, water AS (SELECT yi, xi FROM grid WHERE v < 0.002),
sea(yi, xi) AS (SELECT yi, xi FROM water WHERE yi < 4 UNION SELECT w.yi, w.xi FROM sea s JOIN water w ON abs(w.yi - s.yi) + abs(w.xi - s.xi) = 1)
SELECT yi, xi FROM sea""")
def ocean_components(spark, sf):
    def sea(v):
        water = v < 0.002
        seed = np.zeros_like(water)
        seed[:4] = True
        return kernels.ocean_mask(water, seed)

    return _cells(R.apply_kernel(_blocks(spark, sf), sea))


@query(f"""WITH {GRID}, e AS (
  SELECT a.yi, a.xi, 'x' AS axis, a.v AS va, b.v AS vb FROM grid a JOIN grid b ON b.yi = a.yi AND b.xi = a.xi + 1
  UNION ALL SELECT a.yi, a.xi, 'y', a.v, b.v FROM grid a JOIN grid b ON b.xi = a.xi AND b.yi = a.yi + 1)
SELECT yi, xi, axis, round(yi + CASE WHEN axis = 'y' THEN -va / (vb - va) ELSE 0 END, 5) + 0.0 AS cy, round(xi + CASE WHEN axis = 'x' THEN -va / (vb - va) ELSE 0 END, 5) + 0.0 AS cx
FROM e WHERE (va > 0) <> (vb > 0)""")
def contour_crossings(spark, sf):
    out = R.contour_segments(grid(spark, sf), "v", [])
    return out.withColumns({c: F.round(c, 5) + F.lit(0.0) for c in ("cy", "cx")})


def _morph(name: str, source: str, step: str, radius: int) -> str:
    """A CTE: the dilation or erosion of the cells of another by a disc; what lies outside the raster counts as set for erosion."""
    if step == "dilate":
        return f"{name} AS (SELECT yi, xi FROM alls WHERE (yi, xi) IN (SELECT (yi + dy, xi + dx) FROM {source}, disc WHERE dy * dy + dx * dx <= {radius * radius}))"
    return f"""{name} AS (SELECT yi, xi FROM alls WHERE (yi, xi) NOT IN (SELECT (yi + dy, xi + dx) FROM (SELECT yi, xi FROM alls WHERE (yi, xi) NOT IN (SELECT (yi, xi) FROM {source})), disc
  WHERE dy * dy + dx * dx <= {radius * radius}))"""


@query(f"""WITH {GRID}, {_DISC}, {_ALL}, bad AS (SELECT yi, xi FROM alls LEFT JOIN grid USING (yi, xi) WHERE v IS NULL OR v > 0.006), {_morph('c1', 'bad', 'dilate', 1)}, {_morph('c2', 'c1', 'erode', 1)},
{_morph('o1', 'c2', 'erode', 2)}, {_morph('o2', 'o1', 'dilate', 2)}, {_morph('wide', 'o2', 'dilate', 1)}
SELECT yi, xi, CASE WHEN (yi, xi) NOT IN (SELECT (yi, xi) FROM wide) THEN round(v, 6) + 0.0 END AS v FROM grid""")
def cloud_mask_cleanup(spark, sf):
    g = grid(spark, sf).withColumns({"tile": F.lit("t"), "time": F.lit(0), "kind": F.when(F.col("v") > 0.006, "cloud").otherwise("clear")})
    # a corner each, so that the scene's extent doesn't hang on the data
    corners = spark.createDataFrame([(0, 0), (39, 39)], "yi int, xi int").select("yi", "xi", F.lit(None).cast("double").alias("v"), F.lit("t").alias("tile"), F.lit(0).alias("time"), F.lit("nodata").alias("kind"))
    rows = g.unionByName(corners.join(g, ["yi", "xi"], "left_anti"))
    out = R.erase_cleaned(rows, "kind", ["nodata", "cloud"], ["v"], kernel=lambda m: kernels.cloud_cleanup(m, 1, 2, 1)).where("kind <> 'nodata'")
    return out.select("yi", "xi", (F.round("v", 6) + F.lit(0.0)).alias("v"))


_SUN = (35.0, 290.0)


@query(f"""WITH {GRID}, {_DISC}, {_ALL}, dem AS (SELECT yi, xi, coalesce(v, 0) * 300.0::DOUBLE AS h FROM alls LEFT JOIN grid USING (yi, xi)),
g AS (SELECT c.yi, c.xi, (coalesce(s.h, c.h) - coalesce(n.h, c.h)) / CASE WHEN s.h IS NULL OR n.h IS NULL THEN 1 ELSE 2 END AS gy,
  (coalesce(e.h, c.h) - coalesce(w.h, c.h)) / CASE WHEN e.h IS NULL OR w.h IS NULL THEN 1 ELSE 2 END AS gx FROM dem c
  LEFT JOIN dem s ON s.yi = c.yi + 1 AND s.xi = c.xi LEFT JOIN dem n ON n.yi = c.yi - 1 AND n.xi = c.xi LEFT JOIN dem e ON e.yi = c.yi AND e.xi = c.xi + 1 LEFT JOIN dem w ON w.yi = c.yi AND w.xi = c.xi - 1),
dark AS (SELECT yi, xi FROM g WHERE ((sin(radians({_SUN[0]})) - cos(radians({_SUN[0]})) * (sin(radians({_SUN[1]})) * gx - cos(radians({_SUN[1]})) * gy)) / sqrt(1 + gx * gx + gy * gy) + 1) / 2 < 0.5),
{_morph('o1', 'dark', 'erode', 1)}, {_morph('o2', 'o1', 'dilate', 1)}, {_morph('wide', 'o2', 'dilate', 1)}
SELECT yi, xi, CASE WHEN (yi, xi) NOT IN (SELECT (yi, xi) FROM wide) THEN 1.0::DOUBLE END AS v FROM alls""")
def terrain_shadow_mask(spark, sf):
    full = spark.range(1600).select(F.lit("t").alias("tile"), (F.col("id") / 40).cast("int").alias("yi"), (F.col("id") % 40).cast("int").alias("xi"))
    dem = full.join(grid(spark, sf), ["yi", "xi"], "left").select("tile", "yi", "xi", (F.coalesce("v", F.lit(0.0)) * 300.0).alias("elevation"))
    sun = spark.createDataFrame([("t", 0, *_SUN)], "tile string, time int, sun_elevation double, sun_azimuth double")
    obs = full.withColumns({"time": F.lit(0), "v": F.lit(1.0)})
    return R.erase_shadow(obs, dem, sun, ["v"]).select("yi", "xi", "v")


def _years(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("year", F.year("l_shipdate"))
    cells = li.groupBy(F.lit("t").alias("tile"), "year", (F.col("l_suppkey") * 7 % 40).cast("int").alias("yi"), (F.col("l_partkey") * 3 % 40).cast("int").alias("xi"))
    return R.to_blocks(cells.agg((F.round(F.avg("l_discount"), 6) - 0.05).alias("v")), "v")


@query(f"""WITH RECURSIVE cell AS (SELECT year(l_shipdate)::INT AS year, (l_suppkey * 7 % 40)::INT AS yi, (l_partkey * 3 % 40)::INT AS xi, round(avg(l_discount), 6) - 0.05 AS v
  FROM lineitem GROUP BY 1, 2, 3), yr AS (SELECT year, row_number() OVER (ORDER BY year) AS k FROM (SELECT DISTINCT year FROM cell)),
land AS (SELECT k, yi, xi FROM cell JOIN yr USING (year) WHERE v > 0.02),
beside AS (SELECT a.k, a.yi, a.xi FROM land a WHERE EXISTS (SELECT 1 FROM land b WHERE b.yi = a.yi AND b.xi = a.xi AND abs(b.k - a.k) = 1)),
reach(k0, k, yi, xi) AS (SELECT k, k, yi, xi FROM beside UNION
  SELECT r.k0, l.k, l.yi, l.xi FROM reach r JOIN land l ON abs(l.k - r.k) <= 1 AND abs(l.yi - r.yi) <= 1 AND abs(l.xi - r.xi) <= 1),
every AS (SELECT k, year, y::INT AS yi, x::INT AS xi FROM yr, range((SELECT min(yi) FROM cell), (SELECT max(yi) FROM cell) + 1) s(y), range((SELECT min(xi) FROM cell), (SELECT max(xi) FROM cell) + 1) t(x))
SELECT year, yi, xi FROM every WHERE (k, yi, xi) NOT IN (SELECT (k, yi, xi) FROM land) OR (k, yi, xi) IN (SELECT (k, yi, xi) FROM reach WHERE k0 = k)""")
def temporal_components_3d(spark, sf):
    out = R.apply_over_years(_years(spark, sf), lambda cube: kernels.temporal_mask(cube > 0.02))
    return R.to_pixels(out, "v").where("v > 0").select("year", "yi", "xi")


@query(None)
def sieve(spark, sf):
    return R.to_pixels(R.apply_kernel(_blocks(spark, sf), lambda v: kernels.sieve((v > 0).astype(int), 6)), "v").select("yi", "xi", "v")


@query(None)
def subpixel_contours(spark, sf):
    return R.shorelines(_blocks(spark, sf), 0.0, 4)


@query(None)
def coastal_index(spark, sf):
    # a shore that runs north to south, rough by the discounts of each year's cells
    noise = R.to_pixels(_years(spark, sf), "v")
    shore = noise.withColumn("v", (F.col("xi") - 20 - F.sin(F.col("yi") / 5.0)) / 20 + 4 * F.col("v"))
    return R.to_pixels(R.coastal_blocks(R.to_blocks(shore, "v"), 0.0, 6, 4), "mndwi").select("year", "yi", "xi", "mndwi")
