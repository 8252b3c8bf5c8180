"""Queries of vector layers, recipes, and small survey steps."""


from pyspark.sql import functions as F

from strandline import recipe, sinks
from strandline.functions import geodesy
from strandline.operators import composites as C
from strandline.operators import rates as R
from strandline.operators import spatial as S
from strandline.operators import surveys as V
from strandline.operators import validation as A
from strandline.plans.spatial import _LINES, _LL, _POLY, _XY, SHOWN_RAYS, _centres, _lonlat, _points, _polygons, _segments, _vertices, rays_sql
from strandline.plans.standins import OBS, PROFILES, observations, profiles, table

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


RECIPE = """
transform: apply_mask
mask_measurement_name: ok
input:
  transform: expressions
  input:
    collate:
      - {product: a, measurements: [scene, green, swir1, cloud_mask], filters: {tide_m: [-0.5, 1.0]}}
      - {product: b, measurements: [scene, green, swir1, cloud_mask], filters: {tide_m: [-0.5, 1.0]}}
  output:
    scene: scene
    mndwi: {formula: (green - swir1) / (green + swir1)}
    ok: {formula: (cloud_mask == 'N') | (cloud_mask == 'A')}
"""


@query(f"""WITH {OBS} SELECT CASE WHEN product = 'O' THEN 'a' ELSE 'b' END AS sensor, scene, CASE WHEN cloud_mask IN ('N', 'A') THEN round(mndwi, 6) + 0.0 END AS mndwi
FROM idx WHERE tide_m BETWEEN -0.5 AND 1.0""")
def virtual_product(spark, sf):
    obs = observations(spark, sf)
    products = {"a": obs.where("product = 'O'"), "b": obs.where("product <> 'O'")}
    return _r(recipe.build(recipe.load_config(RECIPE), products).select("sensor", "scene", "mndwi"), "mndwi")


@query("SELECT o_orderstatus AS value FROM orders GROUP BY 1 ORDER BY count(*) DESC, min(o_orderkey) LIMIT 1")
def modal_value(spark, sf):
    return C.modal(table(spark, sf, "orders"), "o_orderstatus", "o_orderkey").withColumnRenamed("o_orderstatus", "value")


@query("""SELECT event_id, round(1.2 * cos(radians(28.9841042 * epoch_us(ts) / 3.6e9::DOUBLE - 40)) + 0.4 * cos(radians(15.0410686 * epoch_us(ts) / 3.6e9::DOUBLE - 110)), 3) + 0.0 AS tide_m FROM events""")
def harmonic_tide(spark, sf):
    h = C.harmonic_tide(F.col("ts"), [(1.2, 28.9841042, 40.0), (0.4, 15.0410686, 110.0)])
    return _r(table(spark, sf, "events").select("event_id", h.alias("tide_m")), "tide_m", digits=3)


@query("SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS elevation FROM customer")
def dem_elevation(spark, sf):
    return C.elevation(table(spark, sf, "customer").select("c_custkey", F.col("c_acctbal").alias("elevation")))


_E2 = geodesy.E2
_TM = [1 - _E2 / 4 - 3 * _E2**2 / 64 - 5 * _E2**3 / 256, 3 * _E2 / 8 + 3 * _E2**2 / 32 + 45 * _E2**3 / 1024, 15 * _E2**2 / 256 + 45 * _E2**3 / 1024, 35 * _E2**3 / 3072]


@query(f"""WITH {_LL}, p AS (SELECT uid, radians(lat) AS f, radians(lon - (6 * floor((lon + 180) / 6) - 177)) AS dl FROM ll),
v AS (SELECT uid, f, {geodesy.A}::DOUBLE / sqrt(1 - {_E2!r}::DOUBLE * sin(f) * sin(f)) AS nu, tan(f) * tan(f) AS t, {_E2 / (1 - _E2)!r}::DOUBLE * cos(f) * cos(f) AS c, cos(f) * dl AS a,
  {geodesy.A}::DOUBLE * ({_TM[0]!r}::DOUBLE * f - {_TM[1]!r}::DOUBLE * sin(2 * f) + {_TM[2]!r}::DOUBLE * sin(4 * f) - {_TM[3]!r}::DOUBLE * sin(6 * f)) AS m FROM p)
SELECT uid, round(500000 + 0.9996::DOUBLE * nu * (a + (1 - t + c) * a ** 3 / 6 + (5 - 18 * t + t * t + 72 * c - 58 * {_E2 / (1 - _E2)!r}::DOUBLE) * a ** 5 / 120), 3) + 0.0 AS x,
  round(1e7::DOUBLE + 0.9996::DOUBLE * (m + nu * tan(f) * (a ** 2 / 2 + (5 - t + 9 * c + 4 * c * c) * a ** 4 / 24 + (61 - 58 * t + t * t + 600 * c - 330 * {_E2 / (1 - _E2)!r}::DOUBLE) * a ** 6 / 720)), 3) + 0.0 AS y FROM v""")
def utm_project(spark, sf):
    ll = _lonlat(spark, sf)
    p = geodesy.transverse_mercator(F.col("lon"), F.col("lat"), 6 * F.floor((F.col("lon") + 180) / 6) - 177)
    return _r(ll.select("uid", p.alias("p")).select("uid", "p.x", "p.y"), "x", "y", digits=3)


@query(f"WITH {_LL} SELECT uid, round(lon, 6) + 0.0 AS lon, round(lat, 6) + 0.0 AS lat FROM ll")
def utm_round_trip(spark, sf):
    ll = _lonlat(spark, sf)
    meridian = 6 * F.floor((F.col("lon") + 180) / 6) - 177
    p = ll.select("uid", meridian.alias("m"), geodesy.transverse_mercator(F.col("lon"), F.col("lat"), meridian).alias("p"))
    back = geodesy.transverse_mercator_inverse(F.col("p.x"), F.col("p.y"), F.col("m"))
    return _r(p.select("uid", back.alias("b")).select("uid", "b.lon", "b.lat"), "lon", "lat")


@query(f"""WITH {_LINES}, {_XY}, {_POLY}, sc AS (SELECT line, seg, x1 * 1.6 AS x1, y1 * 14 AS y1, x2 * 1.6 AS x2, y2 * 14 AS y2 FROM segs),
ct AS (SELECT line, seg, name, ((ax - x1) * (by_ - ay) - (ay - y1) * (bx - ax)) / nullif((x2 - x1) * (by_ - ay) - (y2 - y1) * (bx - ax), 0) AS t,
  ((ax - x1) * (y2 - y1) - (ay - y1) * (x2 - x1)) / nullif((x2 - x1) * (by_ - ay) - (y2 - y1) * (bx - ax), 0) AS u FROM sc, edge),
al AS (SELECT line, seg, name, t FROM ct WHERE t BETWEEN 0 AND 1 AND u BETWEEN 0 AND 1 UNION SELECT line, seg, name, unnest([0.0, 1.0]) FROM sc, poly),
iv AS (SELECT line, seg, name, t AS ta, lead(t) OVER (PARTITION BY line, seg, name ORDER BY t) AS tb FROM al),
md AS (SELECT iv.*, x1 + (ta + tb) / 2 * (x2 - x1) AS px, y1 + (ta + tb) / 2 * (y2 - y1) AS py, sqrt((x2 - x1) ^ 2 + (y2 - y1) ^ 2) AS len FROM iv JOIN sc USING (line, seg) WHERE tb IS NOT NULL),
ins AS (SELECT m.line, m.seg, m.name, m.ta, any_value((tb - ta) * len) AS part FROM md m JOIN edge e ON e.name = m.name AND (ay > py) <> (by_ > py) AND px < (bx - ax) * (py - ay) / (by_ - ay) + ax
  GROUP BY m.line, m.seg, m.name, m.ta HAVING count(*) % 2 = 1)
SELECT line, name, round(sum(part), 4) + 0.0 AS length FROM ins GROUP BY line, name""")
def clip_lines(spark, sf):
    parts = _segments(spark, sf)
    parts = parts.select("line", "seg", *((F.col(c) * k).alias(c) for c, k in (("x1", 1.6), ("y1", 14.0), ("x2", 1.6), ("y2", 14.0))))
    inside = S.split_lines(parts, _polygons(spark), ["name"])
    length = F.sum(F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")))
    return _r(inside.groupBy("line", "name").agg(length.alias("length")), "length", digits=4)


@query(f"WITH {_XY}, {_POLY} SELECT pid, CASE WHEN max(name) = 'north' THEN 1 WHEN max(name) = 'south' THEN 2 ELSE 0 END AS type FROM cust LEFT JOIN hit USING (pid) GROUP BY pid")
def rasterize(spark, sf):
    polygons = _polygons(spark).withColumn("type", F.when(F.col("name") == "north", 1).otherwise(2))
    return S.rasterize(_points(spark, sf).select("pid", "px", "py"), polygons, "type").select("pid", "type")


@query(f"""WITH {_LINES} SELECT line, round(sum(sqrt((x2 - x1) ^ 2 + (y2 - y1) ^ 2) * (x1 + x2) / 2) / sum(sqrt((x2 - x1) ^ 2 + (y2 - y1) ^ 2)), 5) + 0.0 AS x,
round(sum(sqrt((x2 - x1) ^ 2 + (y2 - y1) ^ 2) * (y1 + y2) / 2) / sum(sqrt((x2 - x1) ^ 2 + (y2 - y1) ^ 2)), 5) + 0.0 AS y FROM segs GROUP BY line""")
def line_centroids(spark, sf):
    return _r(S.centroids(_segments(spark, sf), ["line"]), "x", "y", digits=5)


@query(f"""WITH {_XY}, d AS (SELECT uid, sqrt((px - cx) ^ 2 + (py - cy) ^ 2) AS d, CASE c_nationkey % 3 WHEN 0 THEN 'rocky' WHEN 1 THEN 'sandy' END AS kind FROM sup
  JOIN cust ON (px - cx) ^ 2 + (py - cy) ^ 2 <= 250000.0 AND c_nationkey % 3 < 2),
r AS (SELECT *, rank() OVER (PARTITION BY uid ORDER BY d) AS r FROM d)
SELECT s.uid, min(kind) AS kind FROM sup s LEFT JOIN (SELECT * FROM r WHERE r = 1) n USING (uid) GROUP BY s.uid""")
def smartline_attribute(spark, sf):
    k = F.col("c_nationkey") % 3
    shores = _points(spark, sf).select("px", "py", F.when(k == 0, "rocky").when(k == 1, "sandy").otherwise("Unclassified").alias("kind"))
    return S.nearest_attribute(_centres(spark, sf), shores, "uid", "kind", 500.0)


@query(f"WITH {_XY} SELECT pid, px AS x, py AS y, (row_number() OVER (ORDER BY py DESC, px) - 1)::INT AS id FROM cust WHERE px BETWEEN 1000 AND 6000 AND py BETWEEN 2000 AND 7000")
def bbox_subset(spark, sf):
    p = _points(spark, sf).select("pid", F.col("px").alias("x"), F.col("py").alias("y"))
    return S.subset_box(p, (1000, 2000, 6000, 7000)).withColumn("id", F.col("id").cast("int"))


@query("""SELECT s_suppkey, b.block, b.d, b.z FROM (SELECT s_suppkey, unnest([{'block': '0', 'd': s_nationkey, 'z': s_acctbal}, {'block': '1', 'd': CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_nationkey + 1 END,
  'z': CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_acctbal * 2 END}]) AS b FROM supplier) WHERE b.d IS NOT NULL OR b.z IS NOT NULL""")
def blocks_to_long(spark, sf):
    s = table(spark, sf, "supplier")
    some = F.col("s_suppkey") % 3 != 0
    wide = s.select("s_suppkey", F.col("s_nationkey").alias("d0"), F.col("s_acctbal").alias("z0"), F.when(some, F.col("s_nationkey") + 1).alias("d1"), F.when(some, F.col("s_acctbal") * 2).alias("z1"))
    return V.blocks_to_long(wide, ["s_suppkey"], ["d", "z"], ["0", "1"])


@query(f"WITH {PROFILES} SELECT ord, id, max(distance) OVER (PARTITION BY id) - distance AS distance FROM prof WHERE date > DATE '1987-01-01' AND year(date) < 2050")
def reversed_chainage(spark, sf):
    rows = profiles(spark, sf).where(V.in_years(F.col("date"), 1987, 2050))
    return V.reversed_chainage(rows).select("ord", "id", "distance")


@query("""SELECT user_id, regexp_extract(props, '"[a-z_]+": *"?([A-Za-z0-9.]+)', 1) AS first_value, len(regexp_extract_all(props, '[0-9]+'))::INT AS n_numbers, event_id FROM events""")
def header_fields(spark, sf):
    e = table(spark, sf, "events")
    first = F.regexp_extract("props", '"[a-z_]+": *"?([A-Za-z0-9.]+)', 1)
    return e.select("user_id", first.alias("first_value"), F.size(F.regexp_extract_all("props", F.lit("([0-9]+)"), 1)).alias("n_numbers"), "event_id")


@query("""SELECT DISTINCT c_custkey AS uid, '{"type":"Feature","properties":{"uid":' || c_custkey || ',"certainty":"' || lower(c_mktsegment) || '"},"geometry":{"type":"Point","coordinates":['
  || (c_custkey * 7919 % 10007)::DOUBLE || ',' || (c_custkey * 104729 % 10007)::DOUBLE || ']}}' AS feature FROM customer""")
def geojson_features(spark, sf):
    p = _points(spark, sf).join(table(spark, sf, "customer").select(F.col("c_custkey").alias("pid"), F.lower("c_mktsegment").alias("certainty")), "pid")
    rows = p.select(F.col("pid").alias("uid"), "certainty", sinks.geometry_json("Point", F.col("px"), F.col("py")).alias("geometry"))
    return sinks.features(rows, "geometry").select(F.get_json_object("value", "$.properties.uid").cast("bigint").alias("uid"), F.col("value").alias("feature"))


@query("""WITH v AS (SELECT s_suppkey AS id, y::INT AS year, (s_suppkey * y % 97)::DOUBLE AS val_dist, 0.0::DOUBLE AS start_x, 0.0::DOUBLE AS start_y, CASE WHEN s_suppkey % 4 = 0 THEN 30.0 END AS foredune_dist FROM supplier, range(2000, 2004) t(y)),
m AS (SELECT s_suppkey AS id, y::INT AS year, (s_suppkey * y % 89)::DOUBLE AS qx, (s_suppkey % 7)::DOUBLE AS qy FROM supplier, range(2001, 2006) t(y))
SELECT id, year, round(sqrt(qx * qx + qy * qy), 6) + 0.0 AS product_dist, round(val_dist - sqrt(qx * qx + qy * qy), 6) + 0.0 AS error_m FROM v JOIN m USING (id, year)
WHERE foredune_dist IS NULL OR sqrt(qx * qx + qy * qy) >= foredune_dist""")
def validation_result(spark, sf):
    k = F.col("id")
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"))
    v = s.withColumn("year", F.explode(F.sequence(F.lit(2000), F.lit(2003))))
    v = v.withColumns({"val_dist": (k * F.col("year") % 97).cast("double"), "start_x": F.lit(0.0), "start_y": F.lit(0.0), "foredune_dist": F.when(k % 4 == 0, 30.0)})
    m = s.withColumn("year", F.explode(F.sequence(F.lit(2001), F.lit(2005))))
    m = m.withColumns({"qx": (k * F.col("year") % 89).cast("double"), "qy": (k % 7).cast("double")})
    return _r(A.validated(v, m).select("id", "year", "product_dist", "error_m"), "product_dist", "error_m")


@query(None)
def ransac_outliers(spark, sf):
    from strandline.plans.rates import _disp

    return R.ransac_outliers(_disp(spark, sf).select("uid", "year", "dist"), ["uid"], "year", "dist")


@query(f"""WITH RECURSIVE {_LINES}, v AS (SELECT line, ord, x, y, row_number() OVER (PARTITION BY line ORDER BY ord) AS k FROM vert),
iv(line, i, j) AS (SELECT line, min(k), max(k) FROM v GROUP BY line
  UNION ALL SELECT line, CASE WHEN h = 0 THEN i ELSE m END, CASE WHEN h = 0 THEN m ELSE j END FROM (
    SELECT line, i, j, arg_max(k, {{'o': off, 'n': -k}}) AS m FROM (
      SELECT s.line, s.i, s.j, v.k, CASE WHEN a.x = b.x AND a.y = b.y THEN sqrt((v.x - a.x) ^ 2 + (v.y - a.y) ^ 2)
        ELSE abs((v.x - a.x) * (b.y - a.y) - (v.y - a.y) * (b.x - a.x)) / sqrt((b.x - a.x) ^ 2 + (b.y - a.y) ^ 2) END AS off
      FROM iv s JOIN v a ON a.line = s.line AND a.k = s.i JOIN v b ON b.line = s.line AND b.k = s.j JOIN v ON v.line = s.line AND v.k > s.i AND v.k < s.j)
    GROUP BY line, i, j HAVING max(off) > 200), (VALUES (0), (1)) t(h))
SELECT line, ord, x, y FROM v WHERE (line, k) IN (SELECT (line, i) FROM iv UNION SELECT (line, j) FROM iv)""")
def simplified_lines(spark, sf):
    return S.simplified(_vertices(spark, sf), ["line"], 200.0)


_SCALED = f"""{_LINES}, {_XY}, {_POLY}, v AS (SELECT line, x * 1.6 AS x, y * 14 AS y, row_number() OVER (PARTITION BY line ORDER BY ord) AS k FROM vert),
iv(line, i, j) AS (SELECT line, min(k), max(k) FROM v GROUP BY line
  UNION ALL SELECT line, CASE WHEN h = 0 THEN i ELSE m END, CASE WHEN h = 0 THEN m ELSE j END FROM (
    SELECT line, i, j, arg_max(k, {{'o': off, 'n': -k}}) AS m FROM (
      SELECT s.line, s.i, s.j, v.k, CASE WHEN a.x = b.x AND a.y = b.y THEN sqrt((v.x - a.x) ^ 2 + (v.y - a.y) ^ 2)
        ELSE abs((v.x - a.x) * (b.y - a.y) - (v.y - a.y) * (b.x - a.x)) / sqrt((b.x - a.x) ^ 2 + (b.y - a.y) ^ 2) END AS off
      FROM iv s JOIN v a ON a.line = s.line AND a.k = s.i JOIN v b ON b.line = s.line AND b.k = s.j JOIN v ON v.line = s.line AND v.k > s.i AND v.k < s.j)
    GROUP BY line, i, j HAVING max(off) > 200), (VALUES (0), (1)) t(h)),
kv AS (SELECT line, k, x, y FROM v WHERE (line, k) IN (SELECT (line, i) FROM iv UNION SELECT (line, j) FROM iv)),
sc AS (SELECT line, row_number() OVER w AS seg, x AS x1, y AS y1, lead(x) OVER w AS x2, lead(y) OVER w AS y2 FROM kv WINDOW w AS (PARTITION BY line ORDER BY k)),
ch AS (SELECT *, sum(sqrt((x2 - x1) ^ 2 + (y2 - y1) ^ 2)) OVER (PARTITION BY line ORDER BY seg ROWS UNBOUNDED PRECEDING) AS stop FROM sc WHERE x2 IS NOT NULL),
chd AS (SELECT *, stop - sqrt((x2 - x1) ^ 2 + (y2 - y1) ^ 2) AS start FROM ch), {rays_sql('chd')},
en AS (SELECT line, pos, 0 AS e, sx AS px, sy AS py FROM ray UNION ALL SELECT line, pos, 1, ex, ey FROM ray),
ld AS (SELECT line, pos, en.e, name FROM en JOIN edge g ON (ay > py) <> (by_ > py) AND px < (bx - ax) * (py - ay) / (by_ - ay) + ax GROUP BY line, pos, en.e, name HAVING count(*) % 2 = 1),
sd AS (SELECT line, pos, coalesce(bool_or(e = 0), false) AS l0, coalesce(bool_or(e = 1), false) AS l1 FROM (SELECT DISTINCT line, pos, e FROM ld) GROUP BY line, pos),
tn AS (SELECT line, pos, CASE WHEN l0 THEN sx ELSE ex END AS sx, CASE WHEN l0 THEN sy ELSE ey END AS sy, CASE WHEN l0 THEN ex ELSE sx END AS ex, CASE WHEN l0 THEN ey ELSE sy END AS ey
  FROM ray JOIN sd USING (line, pos) WHERE l0 <> l1)"""


@query(f"WITH RECURSIVE {_SCALED} SELECT line, pos AS at, {SHOWN_RAYS} FROM tn")
def coastal_transects(spark, sf):
    lines = _vertices(spark, sf).withColumns({"x": F.col("x") * 1.6, "y": F.col("y") * 14.0})
    return _r(S.coastal_transects(lines, _polygons(spark), ["line"]), "sx", "sy", "ex", "ey", digits=4)
