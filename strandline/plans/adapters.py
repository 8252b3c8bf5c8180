"""Queries of the survey adapters: ``events`` plays each programme's raw tables, ``part`` its surveyed shorelines."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.functions import geodesy
from strandline.operators import adapters as A
from strandline.plans.standins import places, table

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _raw(spark, sf) -> DataFrame:
    """Heights that fall along 40 profiles, row by row in the order of the distance ``d``: one crossing of 0 each day."""
    e = F.col("event_id")
    z = F.lit(4.8) - F.lit(0.0973) * (e % 97) + F.lit(0.00917) * (e % 7)
    return table(spark, sf, "events").select(
        e.alias("e"), (F.col("user_id") % 40).alias("p"), F.to_date("ts").alias("day"), (e % 97).cast("double").alias("d"), ((e % 97) * 10000000 + e).alias("ord"), z.alias("z")
    )


RAW = """raw AS (SELECT event_id AS e, user_id % 40 AS p, ts::DATE AS day, (event_id % 97)::DOUBLE AS d, (event_id % 97) * 10000000 + event_id AS ord,
  4.8::DOUBLE - 0.0973::DOUBLE * (event_id % 97) + 0.00917::DOUBLE * (event_id % 7) AS z FROM events)"""


def _crossed(prof: str, source: str, slope: bool = True, extra: str = "") -> str:
    """Intercepts of the rows ``id, date, ord, distance, z`` that the CTE ``prof`` ends with."""
    joins = " LEFT JOIN sl USING (id, date)" if slope else ""
    return f"""WITH {RAW}, {prof},
st AS (SELECT *, lead(z) OVER w AS z2, lead(distance) OVER w AS d2 FROM prof WINDOW w AS (PARTITION BY id, date ORDER BY ord)),
ht AS (SELECT id, date, ord, distance + (0 - z) / (z2 - z) * (d2 - distance) AS d FROM st WHERE z2 IS NOT NULL AND sign(z) <> sign(z2)),
wl AS (SELECT id, date, arg_min(d, ord) AS d0 FROM ht GROUP BY id, date HAVING arg_min(d, ord) = arg_max(d, ord)),
sl AS (SELECT id, date, round_even(regr_slope(z, distance), 3) + 0.0 AS slope FROM prof JOIN wl USING (id, date) WHERE abs(distance - d0) <= 25 GROUP BY id, date)
SELECT id, date, '{source}' AS source{', slope' if slope else ''}, round(d0, 4) + 0.0 AS "0_dist"{extra and ', ' + extra} FROM wl{joins}{' JOIN (SELECT DISTINCT id, date, ' + extra + ' FROM prof) USING (id, date)' if extra else ''}"""


def _shown(df: DataFrame, *extra: str, slope: bool = True) -> DataFrame:
    rounded = ((F.round(c, 4) + F.lit(0.0)).alias(c) for c in ("0_dist", *extra))
    return df.select("id", F.to_date("date").alias("date"), "source", *(["slope"] if slope else []), *rounded)


_N, _C, _RHO = geodesy.albers_constants()
_E2, _E1 = geodesy.E2, geodesy.E1
_EP2, _E = _E2 / (1 - _E2), (1 - (1 - _E2) ** 0.5) / (1 + (1 - _E2) ** 0.5)
_M0 = geodesy.A * (1 - _E2 / 4 - 3 * _E2**2 / 64 - 5 * _E2**3 / 256)


def _plane(source: str, keep: str, x: str, y: str, meridian: str, scale: float = 0.9996, east: float = 500000.0, north: float = 1e7) -> str:
    """A subquery: ``source`` with the columns ``x, y`` of a transverse Mercator grid put on the Albers plane."""
    return f"""(SELECT {keep}, rho * sin(th) AS {x}, {_RHO!r}::DOUBLE - rho * cos(th) AS {y} FROM (
  SELECT *, {geodesy.A}::DOUBLE * sqrt({_C!r}::DOUBLE - {_N!r}::DOUBLE * {1 - _E2!r}::DOUBLE * (s / (1 - {_E2!r}::DOUBLE * s * s)
    - ln((1 - {_E1!r}::DOUBLE * s) / (1 + {_E1!r}::DOUBLE * s)) / {2 * _E1!r}::DOUBLE)) / {_N!r}::DOUBLE AS rho, {_N!r}::DOUBLE * radians(lon - 132) AS th FROM (
  SELECT *, {meridian} + degrees(g * (1 - (1 + 2 * t * t + c) * g * g / 6 + (5 - 2 * c + 28 * t * t - 3 * c * c + {8 * _EP2!r}::DOUBLE + 24 * t ** 4) * g ** 4 / 120) / cos(phi)) AS lon,
    sin(phi - w / {1 - _E2!r}::DOUBLE * t * g * g * (0.5::DOUBLE - (5 + 3 * t * t + 10 * c - 4 * c * c - {9 * _EP2!r}::DOUBLE) * g * g / 24
      + (61 + 90 * t * t + 298 * c + 45 * t ** 4 - {252 * _EP2!r}::DOUBLE - 3 * c * c) * g ** 4 / 720)) AS s FROM (
  SELECT *, ({x} - {east}::DOUBLE) * sqrt(w) / {geodesy.A * scale!r}::DOUBLE AS g FROM (
  SELECT *, 1 - {_E2!r}::DOUBLE * sin(phi) ** 2 AS w, tan(phi) AS t, {_EP2!r}::DOUBLE * cos(phi) ** 2 AS c FROM (
  SELECT *, mu + {3 * _E / 2 - 27 * _E**3 / 32!r}::DOUBLE * sin(2 * mu) + {21 * _E**2 / 16 - 55 * _E**4 / 32!r}::DOUBLE * sin(4 * mu)
    + {151 * _E**3 / 96!r}::DOUBLE * sin(6 * mu) + {1097 * _E**4 / 512!r}::DOUBLE * sin(8 * mu) AS phi FROM (
  SELECT *, ({y} - {north}::DOUBLE) / {scale}::DOUBLE / {_M0!r}::DOUBLE AS mu FROM {source})))))))"""


_LINES = """vert AS (SELECT substr(p_brand, 7)::INT AS line, p_partkey AS ord, p_partkey * 3.0::DOUBLE AS x, (p_size * 10 + p_partkey % 7)::DOUBLE AS y FROM part),
step AS (SELECT line, x AS x1, y AS y1, lead(x) OVER w AS x2, lead(y) OVER w AS y2 FROM vert WINDOW w AS (PARTITION BY line ORDER BY ord)),
tr AS (SELECT s_suppkey, (s_suppkey * 7919 % 10007)::DOUBLE / 4 AS sx, 0.0::DOUBLE AS sy, (s_suppkey * 7919 % 10007)::DOUBLE / 4 + 5 AS ex, 600.0::DOUBLE AS ey FROM supplier),
m AS (SELECT *, (ex - sx) * (y2 - y1) - (ey - sy) * (x2 - x1) AS cr FROM tr, step WHERE x2 IS NOT NULL AND line + 1980 > 1987),
h AS (SELECT *, ((x1 - sx) * (y2 - y1) - (y1 - sy) * (x2 - x1)) / nullif(cr, 0) AS a, ((x1 - sx) * (ey - sy) - (y1 - sy) * (ex - sx)) / nullif(cr, 0) AS b FROM m),
q AS (SELECT DISTINCT s_suppkey, line, sx, sy, round(sx + a * (ex - sx), 6) AS qx, round(sy + a * (ey - sy), 6) AS qy FROM h WHERE a BETWEEN 0 AND 1 AND b BETWEEN 0 AND 1),
one AS (SELECT s_suppkey, line, any_value(sx) AS sx, any_value(sy) AS sy, max(qx) AS qx, max(qy) AS qy FROM q GROUP BY s_suppkey, line HAVING count(*) = 1)
SELECT 'b_all_' || s_suppkey AS id, make_date(1980 + line, 1, 1) AS date, 'aerial photogrammetry' AS source, round(sqrt((qx - sx) ^ 2 + (qy - sy) ^ 2), 4) + 0.0 AS "0_dist" FROM one"""


def _contours(spark, sf):
    n = F.substring("p_brand", 7, 9).cast("int")
    kind = F.when(n % 2 == 0, "AHD 0m ").otherwise("HWM")
    lines = table(spark, sf, "part").select(
        (1980 + n).alias("year"), n.alias("line"), F.col("p_partkey").alias("ord"), (F.col("p_partkey") * 3.0).alias("x"), (F.col("p_size") * 10 + F.col("p_partkey") % 7).cast("double").alias("y"), kind.alias("TYPE")
    )
    s = places(table(spark, sf, "supplier").select("s_suppkey"), "s_suppkey", "cx", "cy")
    x = F.col("cx") / 4
    rays = s.select(F.lit("b").alias("beach"), F.col("s_suppkey").cast("string").alias("profile"), x.alias("sx"), F.lit(0.0).alias("sy"), (x + 5).alias("ex"), F.lit(600.0).alias("ey"))
    return lines, rays


@query(f"WITH {_LINES} WHERE line % 2 = 0")
def adapter_wadot(spark, sf):
    return _shown(A.wadot(*_contours(spark, sf)), slope=False)


@query(f"WITH {_LINES}")
def adapter_dasilva2021(spark, sf):
    return _shown(A.dasilva2021(*_contours(spark, sf)), slope=False)


@query(_crossed("""prof AS (SELECT 'mybeach_a_p' || p AS id, day AS date, ord, d AS distance, z, min(d) OVER (PARTITION BY p, day) AS foredune_dist FROM raw
  WHERE p IN (SELECT p FROM raw GROUP BY p HAVING max(d) > min(d)))""", "aerial photogrammetry", extra="foredune_dist"))  # fmt: skip
def adapter_nswbpd(spark, sf):
    d = F.col("d")
    rows = _raw(spark, sf).select(
        F.lit("My Beach").alias("beach"), F.lit("A").alias("block"), F.concat(F.lit("P"), F.col("p").cast("string")).alias("profile"), F.date_format("day", "d/MM/yyyy").alias("date"),
        d.alias("distance"), "z", (340000.0 + 4 * d).alias("x"), (6260000.0 + 3 * d).alias("y"), F.lit("Photos").alias("source"), "ord",
    )
    return _shown(A.nswbpd(rows), "foredune_dist")


@query(_crossed("prof AS (SELECT 'narrabeen_all_' || ['pf1', 'pf2', 'pf4', 'pf6', 'pf8'][(p % 5)::INT + 1] AS id, day AS date, ord, d AS distance, z FROM raw)", "emery/levelling"))
def adapter_narrabeen(spark, sf):
    name = F.get(F.array(*(F.lit(n[0]) for n in A.NARRABEEN)), (F.col("p") % 5).cast("int"))
    rows = _raw(spark, sf).select(name.alias("profile"), F.col("day").cast("timestamp").alias("date"), F.col("d").alias("distance"), "z", F.lit("Emery").alias("source"), "ord")
    return _shown(A.narrabeen(rows))


@query(_crossed("""r AS (SELECT * FROM raw WHERE e % 10 <> 0), ok AS (SELECT p, day FROM r GROUP BY p, day HAVING min(z) < 0 AND max(z) > 0),
prof AS (SELECT 'rochesbeach_all_p' || p AS id, day AS date, ord, d AS distance, z FROM r JOIN ok USING (p, day))""", "gps"))  # fmt: skip
def adapter_tasmarc(spark, sf):
    raw = _raw(spark, sf).withColumn("file", F.concat(F.lit("roches_beach_p"), F.col("p").cast("string"), F.lit("_"), F.col("day").cast("string"), F.lit(".txt")))
    flag = F.when(F.col("e") % 10 == 0, "1").otherwise("2")
    rows = raw.select("file", F.lit("roches_beach").alias("site"), "ord", F.col("d").cast("string").alias("distance"), F.col("z").cast("string").alias("z"), flag.alias("flag"))
    when = F.concat(F.col("day").cast("string"), F.lit(" 10:00"))
    meta = raw.groupBy("file").agg(F.min(when).alias("date"))
    meta = meta.select("file", F.lit("147.5").alias("longitude"), F.lit("-42.9").alias("latitude"), "date", F.lit("95").alias("bearing"), F.lit("RTK GPS").alias("method"))
    return _shown(A.tasmarc(rows, meta))


@query(_crossed("""prof AS (SELECT 'pedro_all_' || p AS id, day AS date, d AS ord, d AS distance, max(z * 100) * 0.01::DOUBLE AS z FROM raw
  WHERE d % 5 = 0 AND p <> 4 GROUP BY p, day, d)""", "emery/levelling"))  # fmt: skip
def adapter_moruya(spark, sf):
    wide = _raw(spark, sf).groupBy("p", "day").agg(*(F.max(F.when(F.col("d") == n, F.col("z") * 100)).alias(f"dist_{n}") for n in range(0, 97, 5)))
    head = {"beach": F.lit("pedro"), "section": F.lit("all"), "profile": F.col("p").cast("string"), "date": F.date_format("day", "dd/MM/yyyy")}
    ends = {"start_x": F.lit(240000.0), "start_y": F.lit(6020000.0), "mid_x": F.lit(240100.0), "mid_y": F.lit(6020100.0)}
    return _shown(A.moruya(wide.select(*(v.alias(k) for k, v in (head | ends).items()), *(c for c in wide.columns if c.startswith("dist_")))))


@query(_crossed("""v AS (SELECT CASE WHEN p % 2 = 0 THEN 'apo' ELSE 'cow' END || '_all_' || p AS id, (day - INTERVAL 10 YEAR)::DATE AS date, ord, 96 - d AS back, z FROM raw),
prof AS (SELECT id, date, ord, max(back) OVER (PARTITION BY id) - back AS distance, z FROM v)""", "drone photogrammetry"))  # fmt: skip
def adapter_vicdeakin(spark, sf):
    d = F.col("d").cast("int")
    place = F.concat(F.lit("POINT ("), (730000 + 4 * d).cast("string"), F.lit(".5 "), (5700000 + 3 * d).cast("string"), F.lit(".5)"))
    rows = _raw(spark, sf).select(
        F.when(F.col("p") % 2 == 0, "apo").otherwise("cow").alias("location"), F.col("p").alias("tr_id"), F.expr("CAST(day - INTERVAL '10' YEAR AS TIMESTAMP)").alias("survey_date"),
        place.alias("coordinates"), (96 - F.col("d")).alias("distance"), F.lit(0.0).alias("z"), F.col("z").alias("z_clean"), "ord",
    )
    return _shown(A.vicdeakin(rows))


_COAST = f"""ok AS (SELECT p, day FROM raw GROUP BY p, day HAVING min(z) < 0 AND max(z) > 0),
b AS (SELECT CASE WHEN p % 2 = 0 THEN 'KB' ELSE 'MB' END || p AS profile, day AS date, ord, z, 510000.0::DOUBLE AS sx, 7030000.0::DOUBLE AS sy,
  d / 8000 * (510000.0::DOUBLE + 8000 * sin(radians(CASE WHEN p % 2 = 0 THEN 125.7::DOUBLE ELSE 90.0::DOUBLE END)) - 510000.0::DOUBLE) + 510000.0::DOUBLE AS x,
  d / 8000 * (7030000.0::DOUBLE + 8000 * cos(radians(CASE WHEN p % 2 = 0 THEN 125.7::DOUBLE ELSE 90.0::DOUBLE END)) - 7030000.0::DOUBLE) + 7030000.0::DOUBLE AS y FROM raw JOIN ok USING (p, day)),
prof AS (SELECT 'kingsbeach_na_' || profile AS id, date, ord, z, sqrt((x - sx) ^ 2 + (y - sy) ^ 2) AS distance
  FROM {_plane(_plane('b', 'profile, date, ord, z, x, y', 'sx', 'sy', '153'), 'profile, date, ord, z, sx, sy', 'x', 'y', '153')})"""


@query(_crossed(_COAST, "hydrographic survey"))
def adapter_sunshinecoast(spark, sf):
    p = F.col("p")
    rows = _raw(spark, sf).select(
        F.lit("Kings Beach").alias("beach"), F.concat(F.when(p % 2 == 0, "KB").otherwise("MB"), p.cast("string")).alias("profile"), "ord", F.col("day").cast("timestamp").alias("date"),
        F.col("d").alias("distance"), "z", F.lit(510000.0).alias("start_x"), F.lit(7030000.0).alias("start_y"), F.lit(90.0).alias("bearing"),
    )
    return _shown(A.sunshinecoast(rows))


_CGC = f"""lo AS (SELECT p, day, ord, z, 550000.0::DOUBLE + 4 * d AS x, 6885000.0::DOUBLE + 3 * d AS y FROM raw WHERE z > -3.0::DOUBLE),
ok AS (SELECT p, day FROM lo GROUP BY p, day HAVING min(z) < 0 AND max(z) > 0), both_ AS (SELECT lo.* FROM lo JOIN ok USING (p, day)),
pl AS (SELECT * FROM {_plane('both_', 'p, day, ord, z', 'x', 'y', '153')}),
f AS (SELECT p, arg_min(x, {{'a': day, 'b': ord}}) AS sx, arg_min(y, {{'a': day, 'b': ord}}) AS sy FROM pl GROUP BY p HAVING abs(corr(x, y)) > 0.99),
g AS (SELECT p, day, ord, z, sqrt((x - sx) ^ 2 + (y - sy) ^ 2) AS distance FROM pl JOIN f USING (p)),
t AS (SELECT p, day, arg_max(distance, {{'z': z, 'o': -ord}}) AS foredune_dist FROM g GROUP BY p, day),
prof AS (SELECT 'northkirra_eta_' || p AS id, day AS date, ord, z, distance, round(foredune_dist, 4) + 0.0 AS foredune_dist FROM g JOIN t USING (p, day) WHERE distance >= t.foredune_dist)"""


# without slopes: some rows lie at almost one distance from the first one, on either side of it
@query(_crossed(_CGC, "hydrographic survey", False, "foredune_dist"))
def adapter_cgc(spark, sf):
    name = F.concat(F.lit("NO*TH KIRRA - ETA "), F.col("p").cast("string"), F.lit(" - (ETA "), F.col("day").cast("string"), F.lit(").txt"))
    rows = _raw(spark, sf).select(name.alias("file"), "ord", (550000.0 + 4 * F.col("d")).alias("x"), (6885000.0 + 3 * F.col("d")).alias("y"), "z")
    return _shown(A.cgc(rows), "foredune_dist", slope=False)


_SADEW = f"""w AS (SELECT p, ord, z, e, 280000.0::DOUBLE + 4 * d AS x, 6120000.0::DOUBLE + 3 * d AS y FROM raw),
pl AS (SELECT * FROM {_plane('w', 'p, ord, z, e', 'x', 'y', '(CASE WHEN p IN (1, 2, 3) THEN 141 ELSE 135 END)')}),
f AS (SELECT p, arg_min(x, ord) AS sx, arg_min(y, ord) AS sy FROM pl GROUP BY p),
l AS (SELECT p, ord, x, y, DATE '2001-02-03' AS date, z FROM pl UNION ALL SELECT p, ord, x, y, DATE '2001-02-04', z - 0.2::DOUBLE FROM pl WHERE e % 3 <> 0),
prof AS (SELECT 'sadew_all_' || p AS id, date, ord, z, sqrt((x - sx) ^ 2 + (y - sy) ^ 2) AS distance FROM l JOIN f USING (p))"""


@query(_crossed(_SADEW, "hydrographic survey"))
def adapter_sadew(spark, sf):
    later = F.when(F.col("e") % 3 == 0, F.lit(-9999.0)).otherwise(F.col("z") - 0.2)
    rows = _raw(spark, sf).select(F.col("p").alias("profile"), "ord", (280000.0 + 4 * F.col("d")).alias("x"), (6120000.0 + 3 * F.col("d")).alias("y"), F.col("z").alias("m03022001"), later.alias("m04022001"))
    return _shown(A.sadew(rows, [1, 2, 3]))


_LOCAL = {"scale": 0.9999990600000001, "east": 50000.0, "north": 3800000.0}
_STIRLING = f"""w AS (SELECT p, day AS date, ord, z, 270000.0::DOUBLE + 3 * d AS n, 45000.0::DOUBLE - 4 * d AS e, 270000.0::DOUBLE AS sn, 45000.0::DOUBLE AS se FROM raw
  UNION ALL SELECT p, day + 100, ord, z - 0.2::DOUBLE, 270000.0::DOUBLE + 3 * d, 45000.0::DOUBLE - 4 * d, 270000.0::DOUBLE, 45000.0::DOUBLE FROM raw),
prof AS (SELECT 'stirling_all_' || p AS id, date, ord, z, sqrt((e - se) ^ 2 + (n - sn) ^ 2) AS distance
  FROM {_plane(_plane('w', 'p, date, ord, z, e, n', 'se', 'sn', '115.8166666666667::DOUBLE', **_LOCAL), 'p, date, ord, z, se, sn', 'e', 'n', '115.8166666666667::DOUBLE', **_LOCAL)})"""


@query(_crossed(_STIRLING, "gps", slope=False))
def adapter_stirling(spark, sf):
    x, y = 270000.0 + 3 * F.col("d"), 45000.0 - 4 * F.col("d")
    blocks = _raw(spark, sf).select(
        F.col("p").cast("string").alias("profile"), "ord", F.date_format("day", "dd/MM/yyyy").alias("date0"), x.alias("x0"), y.alias("y0"), F.col("z").alias("z0"),
        F.date_format(F.date_add("day", 100), "dd/MM/yyyy").alias("date1"), x.alias("x1"), y.alias("y1"), (F.col("z") - 0.2).alias("z1"),
    )
    ends = blocks.select("profile", F.lit(270000.0).alias("start_x"), F.lit(45000.0).alias("start_y")).distinct()
    return _shown(A.stirling(blocks, ends, ["0", "1"]), slope=False)
