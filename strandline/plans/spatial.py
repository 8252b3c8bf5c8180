"""Queries of spatial joins, lines and coordinates."""

import math

from pyspark.sql import functions as F

from strandline.functions import geodesy, geometry
from strandline.operators import spatial as S
from strandline.operators.rates import change_regress
from strandline.plans.standins import places, table
from strandline.sources import layers

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _r(df, *names, digits=6):
    return df.withColumns({n: F.round(n, digits) + F.lit(0.0) for n in names})


RADIUS = 600.0
_XY = """sup AS (SELECT s_suppkey AS uid, (s_suppkey * 7919 % 10007)::DOUBLE AS cx, (s_suppkey * 104729 % 10007)::DOUBLE AS cy, s_nationkey FROM supplier),
cust AS (SELECT c_custkey AS pid, (c_custkey * 7919 % 10007)::DOUBLE AS px, (c_custkey * 104729 % 10007)::DOUBLE AS py, c_acctbal, c_nationkey FROM customer)"""
_STEP = math.pi / 32
_TURN = f"(atan2(py - cy, px - cx) - {_STEP!r}::DOUBLE * floor(atan2(py - cy, px - cx) / {_STEP!r}::DOUBLE))"
_INSIDE = f"sqrt((px - cx) ^ 2 + (py - cy) ^ 2) * cos({_TURN} - {_STEP / 2!r}::DOUBLE) < {RADIUS * math.cos(_STEP / 2)!r}::DOUBLE"


def _centres(spark, sf):
    return places(table(spark, sf, "supplier").select(F.col("s_suppkey").alias("uid"), "s_nationkey"), "uid", "cx", "cy")


def _points(spark, sf):
    return places(table(spark, sf, "customer").select(F.col("c_custkey").alias("pid"), "c_acctbal", "c_nationkey"), "pid", "px", "py")


@query(f"WITH {_XY} SELECT uid, pid FROM sup, cust WHERE {_INSIDE}")
def within_join(spark, sf):
    return S.within_distance(_centres(spark, sf), _points(spark, sf), RADIUS).select("uid", "pid")


@query(f"WITH {_XY} SELECT uid, pid FROM sup, cust WHERE (px - cx) ^ 2 + (py - cy) ^ 2 < {RADIUS} ^ 2")
def within_join_disc(spark, sf):
    return S.within_distance(_centres(spark, sf), _points(spark, sf), RADIUS, "disc").select("uid", "pid")


@query(f"""WITH {_XY}, n AS (SELECT uid, count(*) AS n FROM sup, cust WHERE {_INSIDE} GROUP BY uid)
SELECT uid, {int(RADIUS)} AS radius_m, coalesce(n, 0)::INT AS n, CASE WHEN coalesce(n, 0) < {RADIUS} / 30 THEN 'insufficient points' ELSE 'good' END AS certainty
FROM sup LEFT JOIN n USING (uid)""")
def hotspot_counts(spark, sf):
    return S.hotspot_counts(_centres(spark, sf), _points(spark, sf), RADIUS).select("uid", "radius_m", "n", "certainty")


_HOT = f"""{_XY}, mv AS (SELECT pid, px, py, y AS year, ((pid * y) % 41 - 20 + (y - 1998) * (pid % 5))::DOUBLE AS dist FROM cust, range(1995, 2002) t(y)),
hot AS (SELECT uid, year, round_even(median(dist), 2) + 0.0 AS dist FROM sup, mv WHERE {_INSIDE} GROUP BY uid, year)"""


def _hot(spark, sf):
    moves = _points(spark, sf).withColumn("year", F.explode(F.sequence(F.lit(1995), F.lit(2001))))
    moves = moves.withColumn("dist", ((F.col("pid") * F.col("year")) % 41 - 20 + (F.col("year") - 1998) * (F.col("pid") % 5)).cast("double"))
    return S.hotspots(_centres(spark, sf), moves, RADIUS)


@query(f"WITH {_HOT} SELECT uid, year::INT AS year, dist FROM hot")
def within_join_hotspots(spark, sf):
    return _hot(spark, sf)


@query(f"""WITH {_HOT}, c AS (SELECT uid, median(year) AS mx, median(dist) AS my FROM hot GROUP BY uid),
far AS (SELECT uid, year, dist, sqrt((year - mx) ^ 2 + (dist - my) ^ 2) AS d FROM hot JOIN c USING (uid)), s AS (SELECT uid, median(d) AS mad FROM far GROUP BY uid),
f AS (SELECT uid, count(*) AS n, regr_slope(dist, year) AS slope FROM far JOIN s USING (uid) WHERE NOT CASE WHEN mad = 0 THEN d > 0 ELSE 0.6745 * d / mad > 3.5 END GROUP BY uid)
SELECT uid, round_even(slope, 3) + 0.0 AS rate FROM f WHERE n >= 2""")
def hotspot_regress(spark, sf):
    return change_regress(_hot(spark, sf), ["uid"], "year", "dist").where("rate is not null").select("uid", "rate")


@query(f"""WITH {_XY}, d AS (SELECT uid, pid, sqrt((px - cx) ^ 2 + (py - cy) ^ 2) AS distance FROM sup JOIN cust ON (px - cx) ^ 2 + (py - cy) ^ 2 <= 300.0 ^ 2),
r AS (SELECT *, rank() OVER (PARTITION BY uid ORDER BY distance) AS r FROM d)
SELECT s.uid, pid, round(distance, 6) + 0.0 AS distance FROM sup s LEFT JOIN (SELECT * FROM r WHERE r = 1) n USING (uid)""")
def nearest_join_capped(spark, sf):
    near = S.nearest_within(_centres(spark, sf), _points(spark, sf).select("pid", "px", "py"), "uid", 300.0)
    return _r(near.select("uid", "pid", "distance"), "distance")


@query(f"""WITH {_XY}, d AS (SELECT uid, pid, sqrt((px - cx) ^ 2 + (py - cy) ^ 2) AS distance, c_nationkey < 5 AND c_acctbal > 0 AS rocky FROM sup JOIN cust ON (px - cx) ^ 2 + (py - cy) ^ 2 <= 300.0 ^ 2),
r AS (SELECT *, rank() OVER (PARTITION BY uid ORDER BY distance) AS r FROM d)
SELECT s.uid, coalesce(bool_or(rocky), false) AS rocky FROM sup s LEFT JOIN (SELECT * FROM r WHERE r = 1) n USING (uid) GROUP BY s.uid""")
def rocky_shoreline_flag(spark, sf):
    shores = _points(spark, sf).select("px", "py", "c_nationkey", "c_acctbal")
    return S.rocky_flag(_centres(spark, sf), shores, "uid", "c_nationkey < 5 AND c_acctbal > 0")


@query("""WITH q AS (SELECT vec_id AS qid, embedding AS qe FROM embeddings WHERE vec_id % 50 = 0),
d AS (SELECT qid, vec_id, round(list_sum(list_transform(range(1, len(embedding) + 1), lambda i: (embedding[i]::DOUBLE - qe[i]::DOUBLE) * (embedding[i]::DOUBLE - qe[i]::DOUBLE))), 5) AS distance
  FROM embeddings, q WHERE vec_id <> qid)
SELECT qid, min({'d': distance, 'v': vec_id}).v AS vec_id FROM d GROUP BY qid""")
def nearest_embedding(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", "embedding")
    q = e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("qe"))
    return S.nearest_vectors(q, e, "qid", "qe", "vec_id", "embedding").select("qid", "vec_id")


_POLY = """poly AS (SELECT * FROM (VALUES ('north', [[1000.0, 1000.0], [5000.0, 1500.0], [4500.0, 6000.0], [900.0, 5200.0]]),
  ('south', [[6000.0, 2000.0], [9500.0, 2500.0], [8000.0, 4000.0], [9800.0, 9000.0], [5500.0, 7500.0]])) t(name, ring)),
edge AS (SELECT name, p[1] AS ax, p[2] AS ay, q[1] AS bx, q[2] AS by_ FROM (SELECT name, unnest(ring) AS p, unnest(list_concat(ring[2:], [ring[1]])) AS q FROM poly)),
hit AS (SELECT pid, name FROM cust, edge WHERE (ay > py) <> (by_ > py) AND px < (bx - ax) * (py - ay) / (by_ - ay) + ax GROUP BY pid, name HAVING count(*) % 2 = 1)"""


def _polygons(spark):
    return spark.sql("""SELECT name, transform(ring, p -> struct(p[0] AS x, p[1] AS y)) AS ring FROM VALUES
      ('north', array(array(1000D, 1000D), array(5000D, 1500D), array(4500D, 6000D), array(900D, 5200D))),
      ('south', array(array(6000D, 2000D), array(9500D, 2500D), array(8000D, 4000D), array(9800D, 9000D), array(5500D, 7500D))) AS t(name, ring)""")


@query(f"WITH {_XY}, {_POLY} SELECT pid, name FROM cust LEFT JOIN hit USING (pid)")
def point_in_polygon(spark, sf):
    return S.in_polygons(_points(spark, sf), _polygons(spark), ["name"]).select("pid", "name")


@query(f"WITH {_XY}, {_POLY} SELECT pid, name FROM cust LEFT JOIN hit USING (pid)")
def point_in_many_polygons(spark, sf):
    return S.in_polygons(_points(spark, sf), _polygons(spark), ["name"], "pid").select("pid", "name")


@query(f"WITH {_XY}, {_POLY} SELECT pid FROM cust WHERE pid IN (SELECT pid FROM hit)")
def clip_semi(spark, sf):
    return S.clip(_points(spark, sf), _polygons(spark), "pid").select("pid")


@query(f"""WITH {_XY}, {_POLY} SELECT pid FROM cust WHERE (px BETWEEN 5200.5 AND 5900.5 AND py BETWEEN 100.5 AND 9900.5)
  OR (pid IN (SELECT pid FROM hit) AND NOT (px BETWEEN 2000.5 AND 7000.5 AND py BETWEEN 2000.5 AND 4000.5))""")
def edited_water_mask(spark, sf):
    edits = spark.sql("""SELECT type, transform(ring, p -> struct(p[0] AS x, p[1] AS y)) AS ring FROM VALUES
      ('add', array(array(5200.5D, 100.5D), array(5900.5D, 100.5D), array(5900.5D, 9900.5D), array(5200.5D, 9900.5D))),
      ('remove', array(array(2000.5D, 2000.5D), array(7000.5D, 2000.5D), array(7000.5D, 4000.5D), array(2000.5D, 4000.5D))) AS t(type, ring)""")
    return S.in_edited(_points(spark, sf), _polygons(spark), edits, "pid")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def drop_anti(spark, sf):
    from strandline.operators.surveys import drop_rows

    bad = table(spark, sf, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return drop_rows(table(spark, sf, "customer").select("c_custkey"), bad, ["c_custkey"])


# polylines: each brand's parts in order, as steps to the east
_LINES = """vert AS (SELECT p_brand AS line, p_partkey AS ord, p_partkey * 3.0::DOUBLE AS x, (p_size * 10 + p_partkey % 7)::DOUBLE AS y FROM part),
step AS (SELECT line, ord, x AS x1, y AS y1, lead(x) OVER w AS x2, lead(y) OVER w AS y2, row_number() OVER w AS seg FROM vert WINDOW w AS (PARTITION BY line ORDER BY ord)),
seg AS (SELECT line, seg::INT AS seg, x1, y1, x2, y2, sum(sqrt((x2 - x1) ^ 2 + (y2 - y1) ^ 2)) OVER (PARTITION BY line ORDER BY seg ROWS UNBOUNDED PRECEDING) AS stop FROM step WHERE x2 IS NOT NULL),
segs AS (SELECT *, stop - sqrt((x2 - x1) ^ 2 + (y2 - y1) ^ 2) AS start FROM seg)"""


def _vertices(spark, sf):
    p = table(spark, sf, "part")
    return p.select(F.col("p_brand").alias("line"), F.col("p_partkey").alias("ord"), (F.col("p_partkey") * 3.0).alias("x"), (F.col("p_size") * 10 + F.col("p_partkey") % 7).cast("double").alias("y"))


def _segments(spark, sf):
    return S.segments(_vertices(spark, sf), ["line"])


@query(f"""WITH {_LINES}, e AS (SELECT *, floor(max(stop) OVER (PARTITION BY line)) AS total FROM segs),
k AS (SELECT *, unnest(range(ceil(start / 30)::BIGINT, ceil(stop / 30)::BIGINT)) AS k FROM e)
SELECT line, (k * 30)::DOUBLE AS at, round(x1 + coalesce((k * 30 - start) / nullif(stop - start, 0), 0) * (x2 - x1), 4) + 0.0 AS px,
  round(y1 + coalesce((k * 30 - start) / nullif(stop - start, 0), 0) * (y2 - y1), 4) + 0.0 AS py FROM k WHERE k * 30 < total""")
def points_on_line(spark, sf):
    return _r(S.points_on_lines(_vertices(spark, sf), ["line"], 30.0), "px", "py", digits=4)


@query(f"""WITH {_XY}, {_LINES}, u AS (SELECT uid, line, seg, cx, cy, x1, y1, x2, y2, greatest(0.0, least(1.0, coalesce(((cx / 4 - x1) * (x2 - x1) + (cy / 20 - y1) * (y2 - y1))
  / nullif((x2 - x1) ^ 2 + (y2 - y1) ^ 2, 0), 0.0))) AS u FROM sup, segs),
d AS (SELECT uid, line, round(sqrt((cx / 4 - x1 - u * (x2 - x1)) ^ 2 + (cy / 20 - y1 - u * (y2 - y1)) ^ 2), 6) AS distance FROM u)
SELECT uid, line, min(distance) + 0.0 AS distance FROM d GROUP BY uid, line HAVING min(distance) <= 200""")
def nearest_on_line(spark, sf):
    points = _centres(spark, sf).select("uid", (F.col("cx") / 4).alias("px"), (F.col("cy") / 20).alias("py"))
    near = S.nearest_on_lines(points, _segments(spark, sf), ["uid"], ["line"], 200.0)
    return _r(near.select("uid", "line", "distance"), "distance")


@query(f"""WITH {_XY}, {_LINES}, t AS (SELECT uid, cx / 4 AS sx, 0.0 AS sy, cx / 4 + 5 AS ex, 600.0 AS ey FROM sup),
m AS (SELECT *, (ex - sx) * (y2 - y1) - (ey - sy) * (x2 - x1) AS cr FROM t, segs),
h AS (SELECT *, ((x1 - sx) * (y2 - y1) - (y1 - sy) * (x2 - x1)) / nullif(cr, 0) AS a, ((x1 - sx) * (ey - sy) - (y1 - sy) * (ex - sx)) / nullif(cr, 0) AS b FROM m),
p AS (SELECT DISTINCT uid, line, round(sx + a * (ex - sx), 6) AS qx, round(sy + a * (ey - sy), 6) AS qy FROM h WHERE a BETWEEN 0 AND 1 AND b BETWEEN 0 AND 1)
SELECT uid, line, max(qx) AS qx, max(qy) AS qy FROM p GROUP BY uid, line HAVING count(*) = 1""")
def segment_intersection(spark, sf):
    x = F.col("cx") / 4
    t = _centres(spark, sf).select("uid", x.alias("sx"), F.lit(0.0).alias("sy"), (x + 5).alias("ex"), F.lit(600.0).alias("ey"))
    return S.line_crossings(t, _segments(spark, sf), ["uid"], ["line"], 300.0)


@query("""WITH g AS (SELECT l_suppkey::INT AS yi, (l_partkey % 20)::INT AS xi, avg(l_quantity) AS v FROM lineitem GROUP BY 1, 2),
p AS (SELECT s_suppkey AS uid, (s_suppkey * 37 % 90)::DOUBLE + 0.25 AS gy, (s_suppkey * 13 % 18)::DOUBLE + 0.75 AS gx FROM supplier),
n AS (SELECT uid, floor(gy)::INT + a AS yi, floor(gx)::INT + b AS xi, (1 - abs(gy - floor(gy) - a)) * (1 - abs(gx - floor(gx) - b)) AS w FROM p, (VALUES (0), (1)) s(a), (VALUES (0), (1)) t(b))
SELECT uid, CASE WHEN count(v) FILTER (w > 0) = count(*) FILTER (w > 0) THEN round(sum(coalesce(v, 0) * w), 6) + 0.0 END AS v FROM n LEFT JOIN g USING (yi, xi) GROUP BY uid""")
def bilinear_sample(spark, sf):
    li = table(spark, sf, "lineitem")
    g = li.groupBy(F.col("l_suppkey").cast("int").alias("yi"), (F.col("l_partkey") % 20).cast("int").alias("xi")).agg(F.avg("l_quantity").alias("v"))
    k = F.col("s_suppkey")
    p = table(spark, sf, "supplier").select(k.alias("uid"), ((k * 37 % 90).cast("double") + 0.25).alias("gy"), ((k * 13 % 18).cast("double") + 0.75).alias("gx"))
    return _r(S.bilinear_sample(p, g, "v", ["uid"]), "v")


_LL = "ll AS (SELECT s_suppkey AS uid, 113 + (s_suppkey * 7919 % 10007) / 250.0::DOUBLE AS lon, -44 + (s_suppkey * 104729 % 10007) / 300.0::DOUBLE AS lat FROM supplier)"


def _lonlat(spark, sf):
    c = _centres(spark, sf)
    return c.select("uid", (113 + F.col("cx") / 250.0).alias("lon"), (-44 + F.col("cy") / 300.0).alias("lat"))


@query(f"""WITH {_LL}, b AS (SELECT uid, least((1 << 25) - 1, floor((lon + 180) / 360 * (1 << 25)))::BIGINT AS x, least((1 << 25) - 1, floor((lat + 90) / 180 * (1 << 25)))::BIGINT AS y FROM ll),
c AS (SELECT uid, k, list_sum([CASE WHEN (5 * k + j) % 2 = 0 THEN (x >> (24 - (5 * k + j) // 2)) & 1 ELSE (y >> (24 - (5 * k + j) // 2)) & 1 END * (1 << (4 - j)) FOR j IN range(0, 5)]) AS v FROM b, range(0, 10) t(k))
SELECT uid, string_agg(substr('{geodesy.BASE32}', v::INT + 1, 1), '' ORDER BY k) AS geohash FROM c GROUP BY uid""")
def geohash_encode(spark, sf):
    return _lonlat(spark, sf).select("uid", geodesy.geohash(F.col("lon"), F.col("lat"), 10).alias("geohash"))


@query(f"""WITH {_LL}, p AS (SELECT uid, lon, lat, lon + (uid % 11 - 5) / 100.0::DOUBLE AS lon2, lat + (uid % 7 - 3.5) / 100.0::DOUBLE AS lat2 FROM ll),
u AS (SELECT uid, radians(lon2 - lon) AS d, atan({1 - geodesy.FLAT!r} * tan(radians(lat))) AS u1, atan({1 - geodesy.FLAT!r} * tan(radians(lat2))) AS u2 FROM p),
a AS (SELECT uid, degrees(atan2(sin(d) * cos(u2), cos(u1) * sin(u2) - sin(u1) * cos(u2) * cos(d))) AS a FROM u)
SELECT uid, round(a - 180 * floor(a / 180), 3) + 0.0 AS bearing FROM a""")
def bearing_mod180(spark, sf):
    p = _lonlat(spark, sf)
    lon2, lat2 = F.col("lon") + (F.col("uid") % 11 - 5) / 100.0, F.col("lat") + (F.col("uid") % 7 - 3.5) / 100.0
    return _r(p.select("uid", geodesy.bearing(F.col("lon"), F.col("lat"), lon2, lat2).alias("bearing")), "bearing", digits=3)


_N, _C, _RHO = geodesy.albers_constants()


@query(f"""WITH {_LL}, q AS (SELECT uid, lon, sin(radians(lat)) AS s FROM ll),
r AS (SELECT uid, {geodesy.A} * sqrt({_C!r} - {_N!r} * ({1 - geodesy.E2!r} * (s / (1 - {geodesy.E2!r} * s * s) - ln((1 - {geodesy.E1!r} * s) / (1 + {geodesy.E1!r} * s)) / {2 * geodesy.E1!r}))) / {_N!r} AS rho,
  {_N!r} * radians(lon - 132) AS th FROM q)
SELECT uid, round(rho * sin(th), 3) + 0.0 AS x, round({_RHO!r} - rho * cos(th), 3) + 0.0 AS y FROM r""")
def albers_project(spark, sf):
    return _r(_lonlat(spark, sf).select("uid", geodesy.albers(F.col("lon"), F.col("lat")).alias("p")).select("uid", "p.x", "p.y"), "x", "y", digits=3)


@query(f"""WITH {_LL}, q AS (SELECT uid, lon, sin(radians(lat)) AS s FROM ll),
r AS (SELECT uid, {geodesy.A} * sqrt({_C!r} - {_N!r} * ({1 - geodesy.E2!r} * (s / (1 - {geodesy.E2!r} * s * s) - ln((1 - {geodesy.E1!r} * s) / (1 + {geodesy.E1!r} * s)) / {2 * geodesy.E1!r}))) / {_N!r} AS rho,
  {_N!r} * radians(lon - 132) AS th FROM q)
SELECT uid, 3::BIGINT AS n, round(rho * sin(th), 3) + 0.0 AS x, round({_RHO!r} - rho * cos(th), 3) + 0.0 AS y FROM r""")
def reprojected_layer(spark, sf):
    place = F.struct(F.col("lon").alias("x"), F.col("lat").alias("y"))
    layer = _lonlat(spark, sf).select("uid", F.array(place, place, place).alias("points"))
    moved = layers.on_plane(layer)
    return _r(moved.select("uid", F.size("points").cast("bigint").alias("n"), F.element_at("points", -1).alias("p")).select("uid", "n", "p.x", "p.y"), "x", "y", digits=3)


@query(f"WITH {_LL} SELECT uid, round(lon, 6) + 0.0 AS lon, round(lat, 6) + 0.0 AS lat FROM ll")
def albers_round_trip(spark, sf):
    p = _lonlat(spark, sf).select("uid", geodesy.albers(F.col("lon"), F.col("lat")).alias("p"))
    return _r(p.select("uid", geodesy.albers_inverse(F.col("p.x"), F.col("p.y")).alias("b")).select("uid", "b.lon", "b.lat"), "lon", "lat")


@query("""SELECT v, round(CASE WHEN d > 0 THEN d + m / 60 + s / 3600 ELSE d - (m / 60 + s / 3600) END, 9) + 0.0 AS degrees FROM (VALUES
  ('151°18''15"', 151.0, 18.0, 15.0), ('-33°42''20"', -33.0, 42.0, 20.0), ('0°30''00"', 0.0, 30.0, 0.0)) t(v, d, m, s)""")
def dms_to_dd(spark, sf):
    rows = spark.sql("""SELECT * FROM VALUES ("151°18'15\\""), ("-33°42'20\\""), ("0°30'00\\"") AS t(v)""")
    return _r(rows.select("v", geodesy.dms_to_degrees(F.col("v")).alias("degrees")), "degrees", digits=9)


@query(f"""WITH {_XY}, r AS (SELECT uid, cx, cy, cx + 8000 * sin(radians(uid % 360)) AS ex, cy + 8000 * cos(radians(uid % 360)) AS ey FROM sup),
a AS (SELECT *, degrees(atan2(ex - cx, ey - cy)) AS a FROM r)
SELECT uid, round(ex, 4) + 0.0 AS ex, round(ey, 4) + 0.0 AS ey, round(CASE WHEN a <= 0 THEN a + 360 ELSE a END, 4) + 0.0 AS azimuth,
  round(cx + (ex - cx) * CASE WHEN uid % 2 = 0 THEN 0.25 ELSE 0.9375 END, 4) + 0.0 AS along_x FROM a""")
def bearing_rays(spark, sf):
    c = _centres(spark, sf)
    c = c.withColumn("e", geometry.ray_end(F.col("cx"), F.col("cy"), F.lit(8000.0), F.col("uid") % 360))
    x = [F.col(n) for n in ("cx", "cy", "e.x", "e.y")]
    far = F.when(F.col("uid") % 2 == 0, 2000.0).otherwise(-500.0)
    out = c.select("uid", F.col("e.x").alias("ex"), F.col("e.y").alias("ey"), geometry.azimuth(*x).alias("azimuth"), geometry.along(far, *x)["x"].alias("along_x"))
    return _r(out, "ex", "ey", "azimuth", "along_x", digits=4)


def rays_sql(segs: str) -> str:
    """CTEs: transects of the segments of a CTE, as ``ray``."""
    return f"""tot AS (SELECT line, max(stop) AS total FROM {segs} GROUP BY line HAVING max(stop) > 40),
stp AS (SELECT line, 20.0::DOUBLE + k * 200.0::DOUBLE AS pos FROM (SELECT line, unnest(range(0, floor((total - 20) / 200)::BIGINT + 1)) AS k FROM tot)),
fnd AS (SELECT t.line, pos, e, x1 + (pos + e * 20 - start) / nullif(stop - start, 0) * (x2 - x1) AS x, y1 + (pos + e * 20 - start) / nullif(stop - start, 0) * (y2 - y1) AS y
  FROM stp t, (VALUES (-1), (1)) v(e), {segs} s WHERE s.line = t.line AND pos + e * 20 >= start AND pos + e * 20 < stop),
par AS (SELECT line, pos, max(x) FILTER (e = -1) AS ax, max(y) FILTER (e = -1) AS ay, max(x) FILTER (e = 1) AS bx, max(y) FILTER (e = 1) AS by_ FROM fnd GROUP BY line, pos),
spn AS (SELECT *, sqrt((bx - ax) ^ 2 + (by_ - ay) ^ 2) AS sp FROM par),
ray AS (SELECT line, pos, (ax + bx) / 2 - (by_ - ay) / sp * 200 AS sx, (ay + by_) / 2 + (bx - ax) / sp * 200 AS sy, (ax + bx) / 2 + (by_ - ay) / sp * 200 AS ex, (ay + by_) / 2 - (bx - ax) / sp * 200 AS ey
  FROM spn WHERE sp > 0 AND sp <= 40 + 1e-6)"""


_ENDS = ("sx", "sy", "ex", "ey")
SHOWN_RAYS = ", ".join(f"round({c}, 4) + 0.0 AS {c}" for c in _ENDS)


@query(f"WITH {_LINES}, {rays_sql('segs')} SELECT line, pos AS at, {SHOWN_RAYS} FROM ray")
def transects(spark, sf):
    return _r(S.transects(_segments(spark, sf), ["line"], 400.0, 200.0, 20.0), *_ENDS, digits=4)


@query("""WITH g AS (SELECT p_brand AS line, p_size % 8 AS part, count(DISTINCT (p_size, p_partkey % 3)) AS n, count(*) AS points FROM part GROUP BY 1, 2)
SELECT line, part, n >= 2 AS valid, points FROM g""")
def valid_lines(spark, sf):
    place = geometry.point(F.col("p_size"), F.col("p_partkey") % 3)
    lines = table(spark, sf, "part").groupBy(F.col("p_brand").alias("line"), (F.col("p_size") % 8).alias("part")).agg(F.collect_list(place).alias("points"))
    return lines.select("line", "part", geometry.line_is_valid(F.col("points")).alias("valid"), F.size("points").cast("bigint").alias("points"))


@query("""SELECT p_brand AS line, count(DISTINCT p_size % 8) AS parts, count(*) AS points, sum(p_size)::BIGINT AS total FROM part GROUP BY 1""")
def dissolved_lines(spark, sf):
    place = geometry.point(F.col("p_size"), F.col("p_partkey") % 3)
    lines = table(spark, sf, "part").groupBy(F.col("p_brand").alias("line"), (F.col("p_size") % 8).alias("part")).agg(F.collect_list(place).alias("points"))
    every = F.flatten("parts")
    total = F.aggregate(every, F.lit(0.0), lambda acc, p: acc + p["x"]).cast("bigint")
    return S.dissolve(lines, ["line"]).select("line", F.size("parts").cast("bigint").alias("parts"), F.size(every).cast("bigint").alias("points"), total.alias("total"))


@query(f"""WITH {_LINES}, {_XY}, {_POLY}, sc AS (SELECT line, seg, x1 * 1.6 AS x1, y1 * 14 AS y1, x2 * 1.6 AS x2, y2 * 14 AS y2 FROM segs),
ct AS (SELECT line, seg, ((ax - x1) * (by_ - ay) - (ay - y1) * (bx - ax)) / nullif((x2 - x1) * (by_ - ay) - (y2 - y1) * (bx - ax), 0) AS t,
  ((ax - x1) * (y2 - y1) - (ay - y1) * (x2 - x1)) / nullif((x2 - x1) * (by_ - ay) - (y2 - y1) * (bx - ax), 0) AS u FROM sc, edge),
al AS (SELECT DISTINCT line, seg, t FROM ct WHERE t BETWEEN 0 AND 1 AND u BETWEEN 0 AND 1 UNION SELECT line, seg, unnest([0.0, 1.0]) FROM sc),
iv AS (SELECT line, seg, t AS ta, lead(t) OVER (PARTITION BY line, seg ORDER BY t) AS tb FROM al),
md AS (SELECT iv.*, x1 + (ta + tb) / 2 * (x2 - x1) AS px, y1 + (ta + tb) / 2 * (y2 - y1) AS py, sqrt((x2 - x1) ^ 2 + (y2 - y1) ^ 2) AS len FROM iv JOIN sc USING (line, seg) WHERE tb IS NOT NULL),
ins AS (SELECT m.line, m.seg, m.ta FROM md m JOIN edge e ON (ay > py) <> (by_ > py) AND px < (bx - ax) * (py - ay) / (by_ - ay) + ax GROUP BY m.line, m.seg, m.ta, e.name HAVING count(*) % 2 = 1)
SELECT line, round(sum((tb - ta) * len), 3) + 0.0 AS length FROM md WHERE (line, seg, ta) NOT IN (SELECT (line, seg, ta) FROM ins) GROUP BY line""")
def lines_outside(spark, sf):
    parts = _segments(spark, sf).select("line", "seg", *((F.col(c) * k).alias(c) for c, k in (("x1", 1.6), ("y1", 14.0), ("x2", 1.6), ("y2", 14.0))))
    out = S.split_lines(parts, _polygons(spark), ["name"], outside=True).where("name is null")
    length = F.sum(F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")))
    return _r(out.groupBy("line").agg(length.alias("length")), "length", digits=3)
