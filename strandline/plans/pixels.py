"""Queries of pixel operators."""

from pyspark.sql import functions as F

from strandline.operators import composites as C
from strandline.plans.standins import END, OBS, START, observations, table
from strandline.sources.layers import good_scenes

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _index(spark, sf):
    return C.water_index(observations(spark, sf))


def _rounded(df, *names, digits=6):
    return df.withColumns({n: F.round(n, digits) + F.lit(0.0) for n in names})


@query(f"WITH {OBS} SELECT scene, round(mndwi, 6) + 0.0 AS mndwi, round((green - nir) / nullif(green + nir, 0), 6) + 0.0 AS ndwi FROM idx")
def water_index(spark, sf):
    both = C.water_index(_index(spark, sf), "ndwi")
    return _rounded(both.select("scene", "mndwi", "ndwi"), "mndwi", "ndwi")


@query(f"WITH {OBS} SELECT scene, round((green - nir) / nullif(green + nir, 0), 6) + 0.0 AS ndwi FROM obs")
def ndwi(spark, sf):
    return _rounded(C.water_index(observations(spark, sf), "ndwi").select("scene", "ndwi"), "ndwi")


@query("SELECT l_orderkey * 10 + l_linenumber AS scene, round(l_extendedprice * 0.0001::DOUBLE, 8) AS green, round(l_quantity * 0.0001::DOUBLE, 8) AS swir1 FROM lineitem")
def scaled_bands(spark, sf):
    scene = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("scene")
    stored = table(spark, sf, "lineitem").select(scene, F.col("l_extendedprice").alias("green"), F.col("l_quantity").alias("swir1"))
    return C.scaled(stored, ["green", "swir1"]).withColumns({c: F.round(c, 8) for c in ("green", "swir1")})


@query(f"""WITH {OBS} SELECT scene, year FROM obs WHERE year BETWEEN {START - 1} AND {END + 1} AND product = 'O' AND swir1 <= 30""")
def scene_metadata(spark, sf):
    rows = observations(spark, sf).withColumnsRenamed({"product": "maturity"}).withColumn("gqa_iterative_mean_xy", F.col("swir1") / 30)
    return good_scenes(rows, START, END, "O").select("scene", "year")


@query("""SELECT 'a' AS sensor, l_orderkey * 10 + l_linenumber AS scene, l_quantity AS swir1, NULL::DOUBLE AS green FROM lineitem
UNION ALL SELECT 'b', o_orderkey, NULL, o_totalprice FROM orders""")
def collate_sensors(spark, sf):
    scene = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    a = table(spark, sf, "lineitem").select(scene.alias("scene"), F.col("l_quantity").alias("swir1"))
    b = table(spark, sf, "orders").select(F.col("o_orderkey").alias("scene"), F.col("o_totalprice").alias("green"))
    return C.collate({"a": a, "b": b}).select("sensor", "scene", "swir1", "green")


@query(f"WITH {OBS} SELECT scene, CASE WHEN coalesce(cloud_mask IN ('R', 'A'), false) THEN NULL ELSE round(mndwi, 6) + 0.0 END AS mndwi FROM idx")
def mask_categories(spark, sf):
    return _rounded(C.mask_categories(_index(spark, sf), "cloud_mask", ["R", "A"], ["mndwi"]).select("scene", "mndwi"), "mndwi")


@query(f"""WITH {OBS}, d AS (SELECT tile, yi, xi, (time + INTERVAL 10 HOUR)::DATE AS day, scene, CASE WHEN cloud_mask <> 'R' THEN green END AS green FROM obs)
SELECT tile, yi, xi, day, arg_min(green, scene) FILTER (green IS NOT NULL) AS green FROM d GROUP BY ALL""")
def solar_day_mosaic(spark, sf):
    rows = C.mask_categories(observations(spark, sf), "cloud_mask", ["R"], ["green"])
    rows = rows.withColumn("day", C.solar_day(F.col("time"), F.lit(150.0)))
    return C.mosaic_by_day(rows, C.PIXEL, "day", "scene", ["green"])


_CUT = f"""{OBS}, cut AS (SELECT tile, yi, 0.0 - 0.25 * (max(tide_m) - min(tide_m)) AS tide_min, 0.0 + 0.25 * (max(tide_m) - min(tide_m)) AS tide_max
  FROM obs GROUP BY tile, yi)"""


@query(f"WITH {_CUT} SELECT tile, yi, round(tide_min, 6) + 0.0 AS tide_min, round(tide_max, 6) + 0.0 AS tide_max FROM cut")
def tide_cutoffs(spark, sf):
    return _rounded(C.tide_cutoffs(observations(spark, sf), ["tile", "yi"]), "tide_min", "tide_max")


@query(f"WITH {_CUT} SELECT scene, tile, yi, xi, round(tide_m, 6) + 0.0 AS tide_m FROM obs JOIN cut USING (tile, yi) WHERE tide_m BETWEEN tide_min AND tide_max")
def tidal_subset(spark, sf):
    obs = observations(spark, sf)
    got = C.tidal_subset(obs, C.tide_cutoffs(obs, ["tile", "yi"]), ["tile", "yi"])
    return _rounded(got.select("scene", "tile", "yi", "xi", "tide_m"), "tide_m")


@query(f"""WITH {OBS}, cells AS (SELECT (yi // 8)::BIGINT AS cy, (xi // 8)::BIGINT AS cx, 0.0 - 0.25 * (max(tide_m) - min(tide_m)) AS tide_min,
  0.25 * (max(tide_m) - min(tide_m)) AS tide_max FROM obs GROUP BY 1, 2),
px AS (SELECT DISTINCT yi, xi FROM obs),
near AS (SELECT yi, xi, floor((yi + 0.5) / 8 - 0.5)::BIGINT + a AS cy, floor((xi + 0.5) / 8 - 0.5)::BIGINT + b AS cx,
  (yi + 0.5) / 8 - 0.5 AS fy, (xi + 0.5) / 8 - 0.5 AS fx FROM px, (VALUES (0), (1)) s(a), (VALUES (0), (1)) t(b)),
w AS (SELECT *, (1 - abs(fy - cy)) * (1 - abs(fx - cx)) AS w FROM near)
SELECT yi, xi, round(sum(tide_min * w) / nullif(sum(w), 0), 6) + 0.0 AS tide_min, round(sum(tide_max * w) / nullif(sum(w), 0), 6) + 0.0 AS tide_max
FROM w JOIN cells USING (cy, cx) GROUP BY yi, xi""")
def bilinear_tide_cutoffs(spark, sf):
    obs = observations(spark, sf)
    cells = obs.withColumns({"cy": F.floor(F.col("yi") / 8), "cx": F.floor(F.col("xi") / 8)})
    cuts = C.tide_cutoffs(cells, ["cy", "cx"])
    px = obs.select("yi", "xi").distinct().withColumns({"py": F.col("yi") + 0.5, "px": F.col("xi") + 0.5})
    return _rounded(C.bilinear_cutoffs(px, cuts, "py", "px", 8).select("yi", "xi", "tide_min", "tide_max"), "tide_min", "tide_max")


_ANNUAL = f"""{OBS}, ann AS (SELECT tile, yi, xi, year, median(mndwi) AS mndwi, stddev_pop(mndwi) AS stdev, count(mndwi)::SMALLINT AS count
  FROM idx WHERE year BETWEEN {START - 1} AND {END} GROUP BY ALL),
gap AS (SELECT tile, yi, xi, label AS year, median(mndwi) AS mndwi, stddev_pop(mndwi) AS stdev, count(mndwi)::SMALLINT AS count
  FROM (SELECT *, unnest([year - 1, year, year + 1]) AS label FROM idx) WHERE label BETWEEN {START} AND {END} GROUP BY ALL),
sel AS (SELECT a.tile, a.yi, a.xi, a.year, CASE WHEN a.count > 5 THEN a.mndwi WHEN a.count > 1 THEN g.mndwi END AS mndwi,
  CASE WHEN a.count > 5 THEN a.stdev WHEN a.count > 1 THEN g.stdev END AS stdev, CASE WHEN a.count > 5 THEN a.count WHEN a.count > 1 THEN g.count END AS count
  FROM ann a LEFT JOIN gap g USING (tile, yi, xi, year) WHERE a.year >= {START})"""
_SHOW = "SELECT tile, yi, xi, year, round(mndwi, 6) + 0.0 AS mndwi, round(stdev, 6) + 0.0 AS stdev, count FROM"


@query(f"WITH {_ANNUAL} {_SHOW} ann")
def annual_composite(spark, sf):
    return _rounded(C.annual_composite(_index(spark, sf), "mndwi", START, END), "mndwi", "stdev")


@query(f"WITH {_ANNUAL} {_SHOW} gap")
def gapfill_composite(spark, sf):
    return _rounded(C.pooled_composite(_index(spark, sf), "mndwi", START, END), "mndwi", "stdev")


def _selected(spark, sf):
    return C.gapfilled_composite(_index(spark, sf), "mndwi", START, END)


@query(f"WITH {_ANNUAL} {_SHOW} sel")
def gapfill_of_tables(spark, sf):
    idx = _index(spark, sf)
    annual = C.annual_composite(idx, "mndwi", START, END).where(F.col("year") >= START)
    return _rounded(C.gapfill_select(annual, C.pooled_composite(idx, "mndwi", START, END), "mndwi"), "mndwi", "stdev")


@query(f"""WITH {_ANNUAL} SELECT tile, yi, xi, year, round(a.mndwi, 6) + 0.0 AS annual_mndwi, a.count AS annual_count, round(g.mndwi, 6) + 0.0 AS gapfill_mndwi, g.count AS gapfill_count
FROM ann a FULL JOIN gap g USING (tile, yi, xi, year)""")
def aligned_composites(spark, sf):
    idx = _index(spark, sf)
    both = {"annual": C.annual_composite(idx, "mndwi", START, END), "gapfill": C.pooled_composite(idx, "mndwi", START, END)}
    return _rounded(C.aligned(both).drop("annual_stdev", "gapfill_stdev"), "annual_mndwi", "gapfill_mndwi")


@query(f"WITH {_ANNUAL} {_SHOW} sel")
def gapfill_select(spark, sf):
    return _rounded(_selected(spark, sf), "mndwi", "stdev")


_LIMIT = 0.1
_LAND = f"{_ANNUAL}, land AS (SELECT *, mndwi < {_LIMIT} AS land FROM sel)"


@query(f"WITH {_LAND} SELECT tile, yi, xi, avg(land::INT) > 0.2 AS land_20, avg(land::INT) > 0.8 AS land_80 FROM land GROUP BY ALL")
def all_time_frequency(spark, sf):
    return C.all_time_frequency(C.land(_selected(spark, sf), "mndwi", _LIMIT))


@query(f"""WITH {_LAND} SELECT tile, yi, xi, year, land, coalesce(lag(land) OVER w, false) OR coalesce(lead(land) OVER w, false) AS beside
FROM land WINDOW w AS (PARTITION BY tile, yi, xi ORDER BY year)""")
def temporal_neighbours(spark, sf):
    land = C.land(_selected(spark, sf), "mndwi", _LIMIT)
    return C.temporal_neighbours(land).select("tile", "yi", "xi", "year", "land", "beside")


@query(f"""WITH {_ANNUAL}, c AS (SELECT tile, yi, xi, year, CASE WHEN count < 5 THEN 2 WHEN stdev > 0.3 THEN 1 ELSE 0 END AS class FROM sel)
SELECT tile, yi, xi, year, class, CASE WHEN yi % 30 - 25 > -23 AND year IN (1997, 1998, 1991, 1992) AND year IN (1991, 1992) THEN 'aerosol issues'
  WHEN class = 0 THEN 'good' WHEN class = 1 THEN 'unstable data' ELSE 'insufficient data' END AS certainty FROM c""")
def certainty_class(spark, sf):
    cls = C.certainty_class(F.col("count"), F.col("stdev"))
    out = _selected(spark, sf).select("tile", "yi", "xi", "year", cls.alias("class"))
    return out.withColumn("certainty", C.certainty_name(F.col("class"), F.col("year"), F.col("yi") % 30 - 25))
