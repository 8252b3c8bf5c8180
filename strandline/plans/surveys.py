"""Queries of surveys, validation, snapshots and runs."""

from pyspark.sql import functions as F

from strandline.functions.names import SURVEY_METHODS, standard_method
from strandline.operators import reports as P
from strandline.operators import surveys as S
from strandline.operators import validation as V
from strandline.operators.composites import collate
from strandline.plans.standins import MOVES, PROFILES, movements, profiles, table

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


_CROSS = f"""{PROFILES}, st AS (SELECT *, lead(z) OVER w AS z2, lead(distance) OVER w AS d2, lead(x) OVER w AS x2, lead(y) OVER w AS y2,
  row_number() OVER w AS rn FROM prof WINDOW w AS (PARTITION BY id, date ORDER BY ord)),
ht AS (SELECT id, date, ord, distance + (0 - z) / (z2 - z) * (d2 - distance) AS d, x + (0 - z) / (z2 - z) * (x2 - x) AS x, y + (0 - z) / (z2 - z) * (y2 - y) AS y
  FROM st WHERE z2 IS NOT NULL AND sign(z) <> sign(z2)),
cr AS (SELECT p.id, p.date, count(ht.ord) AS n, arg_min(ht.d, ht.ord) AS fd, arg_min(ht.x, ht.ord) AS fx, arg_min(ht.y, ht.ord) AS fy, arg_max(ht.d, ht.ord) AS ld
  FROM (SELECT DISTINCT id, date FROM prof) p LEFT JOIN ht USING (id, date) GROUP BY ALL),
wl AS (SELECT id, date, CASE WHEN fd = ld THEN fd END AS d0, CASE WHEN fd = ld THEN fx END AS x0, CASE WHEN fd = ld THEN fy END AS y0 FROM cr)"""


@query(f"WITH {_CROSS} SELECT id, date, n AS n_crossings, round(fd, 6) + 0.0 AS first_distance, round(ld, 6) + 0.0 AS last_distance FROM cr")
def interp_intercept(spark, sf):
    return _r(S.intercepts(profiles(spark, sf)).select("id", "date", "n_crossings", "first_distance", "last_distance"), "first_distance", "last_distance")


@query(f'WITH {_CROSS} SELECT id, date, round(d0, 6) + 0.0 AS "0_dist", round(x0, 6) + 0.0 AS "0_x", round(y0, 6) + 0.0 AS "0_y" FROM wl')
def waterline_intercept(spark, sf):
    return _r(S.waterline_intercept(profiles(spark, sf)), "0_dist", "0_x", "0_y")


@query(f"""WITH {_CROSS} SELECT id, date, round_even(regr_slope(z, distance), 3) + 0.0 AS slope FROM prof JOIN wl USING (id, date)
WHERE abs(distance - d0) <= 25 GROUP BY id, date""")
def profile_slope(spark, sf):
    rows = profiles(spark, sf)
    return S.profile_slope(rows, S.waterline_intercept(rows))


@query(f"""WITH {PROFILES}, m AS (SELECT id, date, arg_max(distance, {{'z': z, 'o': -ord}}) AS f FROM prof GROUP BY ALL)
SELECT ord, id, date, f AS foredune_dist FROM prof JOIN m USING (id, date) WHERE distance >= f""")
def foredune_filter(spark, sf):
    return S.foredune_filter(profiles(spark, sf)).select("ord", "id", "date", "foredune_dist")


@query(f"""WITH {PROFILES} SELECT id, arg_min(x, {{'d': distance, 'o': ord}}) AS start_x, arg_min(y, {{'d': distance, 'o': ord}}) AS start_y,
  arg_max(x, {{'d': distance, 'o': -ord}}) AS end_x, arg_max(y, {{'d': distance, 'o': -ord}}) AS end_y FROM prof GROUP BY id""")
def profile_endpoints(spark, sf):
    return S.endpoints(profiles(spark, sf))


@query(f"WITH {PROFILES} SELECT ord, id FROM prof WHERE id IN (SELECT id FROM prof GROUP BY id HAVING abs(corr(x, y)) > 0.9999)")
def straightness_filter(spark, sf):
    return S.straight_only(profiles(spark, sf), "id", 0.9999).select("ord", "id")


@query(f"""WITH {PROFILES} SELECT ord, id, date FROM prof JOIN (SELECT id, date FROM prof GROUP BY ALL HAVING min(z) < 0 AND max(z) > 0) USING (id, date)""")
def straddle_filter(spark, sf):
    return S.straddling(profiles(spark, sf)).select("ord", "id", "date")


@query("""WITH c AS (SELECT o_custkey, o_orderpriority AS m, count(*) AS n FROM orders GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, m) AS r FROM c)
SELECT o.o_custkey, arg_min(o_orderstatus, o_orderkey) AS o_orderstatus, any_value(r.m) AS o_orderpriority
FROM orders o JOIN r ON r.o_custkey = o.o_custkey AND r.r = 1 GROUP BY o.o_custkey""")
def mode_attributes(spark, sf):
    return S.first_and_mode(table(spark, sf, "orders"), ["o_custkey"], ["o_orderstatus"], ["o_orderpriority"], "o_orderkey")


_RECODE = " ".join(f"WHEN lower(m) = '{k}' THEN {'NULL' if v is None else repr(v)}" for k, v in SURVEY_METHODS.items() if "\t" not in k)
_NAMES = ("Emery", "Levelling", "Dunefill", "RTK GPS", "Photos", "Total Station", "Drone", "GPS RTK GPS")


@query(f"""WITH m AS (SELECT o_orderkey, [{', '.join(f"'{n}'" for n in _NAMES)}][(o_orderkey % {len(_NAMES)})::INT + 1] AS m FROM orders)
SELECT o_orderkey, CASE {_RECODE} ELSE lower(m) END AS source FROM m""")
def standardise_source(spark, sf):
    name = F.get(F.array(*map(F.lit, _NAMES)), (F.col("o_orderkey") % len(_NAMES)).cast("int"))
    return table(spark, sf, "orders").select("o_orderkey", standard_method(name).alias("source"))


@query(f"""WITH {_CROSS}, sl AS (SELECT id, date, round_even(regr_slope(z, distance), 3) + 0.0 AS slope FROM prof JOIN wl USING (id, date) WHERE abs(distance - d0) <= 25 GROUP BY id, date),
mc AS (SELECT id, date, source, count(*) AS c FROM prof GROUP BY ALL),
md AS (SELECT *, row_number() OVER (PARTITION BY id, date ORDER BY c DESC, source) AS r FROM mc)
SELECT id, date, round(d0, 6) + 0.0 AS "0_dist", source, slope FROM wl LEFT JOIN sl USING (id, date) LEFT JOIN md USING (id, date) WHERE d0 IS NOT NULL AND r = 1""")
def survey_intercepts(spark, sf):
    return _r(S.intercept_table(profiles(spark, sf), modes=["source"]).select("id", "date", "0_dist", "source", "slope"), "0_dist")


_PAIR = """pr AS (SELECT l_suppkey % 20 AS beach, o_orderstatus AS source, l_quantity AS val, l_quantity * 0.97 + (l_orderkey % 9 - 4) * 0.313 AS sat, (l_linenumber % 3 + 1)::BIGINT AS n
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
_FIG = """{n}::BIGINT AS n, round_even(avg(abs(d)), 2) + 0.0 AS mae, round_even(sqrt(avg(d * d)), 2) + 0.0 AS rmse,
  CASE WHEN count(*) > 1 THEN round_even(stddev_samp(d), 2) + 0.0 END AS stdev, CASE WHEN count(*) > 1 THEN round_even(corr(val, sat), 3) + 0.0 END AS corr,
  round_even(avg(d), 2) + 0.0 AS bias"""


def _pairs(spark, sf):
    li, o = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    both = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    return both.select(
        (F.col("l_suppkey") % 20).alias("beach"), F.col("o_orderstatus").alias("source"), F.col("l_quantity").alias("val"),
        (F.col("l_quantity") * 0.97 + (F.col("l_orderkey") % 9 - 4) * 0.313).alias("sat"), (F.col("l_linenumber") % 3 + 1).cast("bigint").alias("n"),
    )


@query(f"WITH {_PAIR} SELECT {_FIG.format(n='count(*)')} FROM (SELECT *, val - sat AS d FROM pr)")
def accuracy_stats(spark, sf):
    return V.accuracy(_pairs(spark, sf), "val", "sat")


@query(f"WITH {_PAIR} SELECT beach, {_FIG.format(n='sum(n)')} FROM (SELECT *, val - sat AS d FROM pr) GROUP BY beach")
def accuracy_by_group(spark, sf):
    return V.accuracy(_pairs(spark, sf), "val", "sat", ["beach"], "n")


@query(f"""WITH {_PAIR}, a AS (SELECT source, {_FIG.format(n='count(*)')} FROM (SELECT *, val - sat AS d FROM pr) GROUP BY source),
b AS (SELECT source, {_FIG.format(n='count(*)')} FROM (SELECT *, val - sat - avg(val - sat) OVER (PARTITION BY source) AS d FROM pr) GROUP BY source)
SELECT source, a.n, a.bias, format('{{:.2f}} ({{:.2f}})', a.mae, b.mae) AS mae, format('{{:.2f}} ({{:.2f}})', a.rmse, b.rmse) AS rmse,
  format('{{:.2f}} ({{:.2f}})', a.stdev, b.stdev) AS stdev, a.corr, row_number() OVER (ORDER BY a.mae, source)::BIGINT AS rank FROM a JOIN b USING (source)""")
def accuracy_table(spark, sf):
    p = _pairs(spark, sf)
    return V.accuracy_table(V.accuracy(p, "val", "sat", ["source"]), V.accuracy(p, "val", "sat", ["source"], remove_bias=True), "source")


@query(f"""WITH {_PAIR} SELECT source, {_FIG.format(n='count(*)').replace('avg(d)', 'avg(raw)')}
FROM (SELECT *, val - sat AS raw, val - sat - avg(val - sat) OVER (PARTITION BY source) AS d FROM pr) GROUP BY source""")
def accuracy_bias_removed(spark, sf):
    return V.accuracy(_pairs(spark, sf), "val", "sat", ["source"], remove_bias=True)


@query(f"""WITH {_PAIR} SELECT {_FIG.format(n='sum(n)').replace('avg(d)', 'avg(raw)')} FROM (SELECT *, val - sat AS raw, val - sat - avg(val - sat) OVER () AS d FROM pr)""")
def accuracy_bias_removed_overall(spark, sf):
    return V.accuracy(_pairs(spark, sf), "val", "sat", weight="n", remove_bias=True)


@query("""WITH d AS (SELECT ts::DATE AS day, count(*)::DOUBLE AS n, avg(value) AS mae FROM events GROUP BY 1),
t AS (SELECT day, n, round(mae, 6) + 0.0 AS mae, n - lag(n) OVER (ORDER BY day) AS n_diff, round(mae - lag(mae) OVER (ORDER BY day), 6) + 0.0 AS mae_diff FROM d)
SELECT * FROM t ORDER BY day DESC LIMIT 1""")
def last_run(spark, sf):
    log = table(spark, sf, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count("*").cast("double").alias("n"), F.avg("value").alias("mae"))
    return _r(V.run_trend(log, "day", ["n", "mae"], last=True), "mae", "mae_diff")


@query("""WITH d AS (SELECT ts::DATE AS day, count(*)::DOUBLE AS n, avg(value) AS mae FROM events GROUP BY 1)
SELECT day, n, round(mae, 6) + 0.0 AS mae, n - lag(n) OVER (ORDER BY day) AS n_diff, round(mae - lag(mae) OVER (ORDER BY day), 6) + 0.0 AS mae_diff FROM d""")
def run_trend(spark, sf):
    log = table(spark, sf, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count("*").cast("double").alias("n"), F.avg("value").alias("mae"))
    return _r(V.run_trend(log, "day", ["n", "mae"]), "mae", "mae_diff")


_LIM = ", ".join(map(str, P.CHANGE_LIMITS))
_CLS = ("< -10 m", "-10 to -5 m", "-5 to 0 m", "0 to 5 m", "5 to 10 m", "> 10 m")
_YOY = f"""{MOVES}, ch AS (SELECT uid, year, (dist - CASE WHEN lag(year) OVER w = year - 1 THEN lag(dist) OVER w END) / 5 AS change FROM disp WINDOW w AS (PARTITION BY uid ORDER BY year)),
cl AS (SELECT *, CASE WHEN change <= -10 THEN '{_CLS[0]}' WHEN change <= -5 THEN '{_CLS[1]}' WHEN change <= 0 THEN '{_CLS[2]}' WHEN change <= 5 THEN '{_CLS[3]}'
  WHEN change <= 10 THEN '{_CLS[4]}' WHEN change > 10 THEN '{_CLS[5]}' END AS class FROM ch)"""


def _changes(spark, sf):
    from strandline.operators.rates import baseline_displacement

    d = baseline_displacement(movements(spark, sf), ["uid"], "value", 1998)
    ch = P.yearly_change(d.select("uid", "year", "dist"), ["uid"], 1990, 2010).withColumn("change", F.col("change") / 5)
    return ch.withColumn("class", P.cut(F.col("change"), P.CHANGE_LIMITS, _CLS))


@query(f"""WITH {_YOY}, k AS (SELECT year, class, count(*) AS n FROM cl WHERE class IS NOT NULL GROUP BY ALL),
s AS (SELECT *, 100.0::DOUBLE * n / sum(n) OVER (PARTITION BY year) AS share FROM k)
SELECT s.year, s.class, s.n, round(s.share, 6) + 0.0::DOUBLE AS share, round(s.share - b.share, 6) + 0.0::DOUBLE AS share_change FROM s LEFT JOIN s b ON b.class = s.class AND b.year = s.year - 1""")
def yoy_class_share(spark, sf):
    return _r(P.share_change(P.class_shares(_changes(spark, sf), ["year"], "class"), [], "class"), "share", "share_change")


@query(f"""WITH {_YOY} SELECT r_name, year, round(median(change), 6) + 0.0 AS change FROM cl JOIN supplier ON s_suppkey = uid JOIN nation ON n_nationkey = s_nationkey
JOIN region ON r_regionkey = n_regionkey WHERE change IS NOT NULL GROUP BY ALL""")
def region_year_median(spark, sf):
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("uid"), F.col("s_nationkey").alias("n_nationkey"))
    n, r = table(spark, sf, "nation").select("n_nationkey", F.col("n_regionkey").alias("r_regionkey")), table(spark, sf, "region").select("r_regionkey", "r_name")
    both = _changes(spark, sf).where("change is not null").join(s, "uid").join(n, "n_nationkey").join(r, "r_regionkey")
    return _r(both.groupBy("r_name", "year").agg(F.median("change").alias("change")), "change")


@query("""WITH r AS (SELECT event_id AS run_id, user_id AS tile, value AS duration, CASE event_type WHEN 'purchase' THEN 'memory' WHEN 'view' THEN NULL WHEN 'click' THEN NULL ELSE 'error code 1' END AS error FROM events),
l AS (SELECT *, row_number() OVER (PARTITION BY tile ORDER BY duration DESC NULLS LAST, run_id) AS rn FROM r),
s AS (SELECT tile, CASE WHEN count(*) = 1 THEN CASE WHEN count(error) = 0 THEN 'succeeded' ELSE 'failed' END
  ELSE CASE WHEN count(*) > count(error) THEN 'succeeded after retry' ELSE 'failed after retry' END END AS status FROM r GROUP BY tile)
SELECT tile, run_id, round(duration, 6) + 0.0 AS duration, error, status FROM l JOIN s USING (tile) WHERE rn = 1""")
def run_status(spark, sf):
    error = F.when(F.col("event_type") == "purchase", "memory").when(~F.col("event_type").isin("view", "click"), "error code 1")
    runs = table(spark, sf, "events").select(F.col("event_id").alias("run_id"), F.col("user_id").alias("tile"), F.col("value").alias("duration"), error.alias("error"))
    return _r(P.longest_attempt(runs, "tile", "duration").join(P.run_status(runs), "tile"), "duration")


@query("""SELECT event_id, CASE WHEN count(value) OVER w >= 3 THEN round(median(value) OVER w, 6) + 0.0 END AS rolling FROM events
WINDOW w AS (PARTITION BY user_id % 5 ORDER BY epoch_us(ts) RANGE BETWEEN 1799999999 PRECEDING AND CURRENT ROW)""")
def rolling_median_30min(spark, sf):
    e = table(spark, sf, "events").select("event_id", (F.col("user_id") % 5).alias("g"), "ts", "value")
    return _r(P.rolling_median(e, ["g"], "ts", "value", 30, 3).select("event_id", "rolling"), "rolling")


@query("SELECT event_type, round(quantile_cont(value, 0.1), 6) + 0.0 AS q100, round(quantile_cont(value, 0.5), 6) + 0.0 AS q500, round(quantile_cont(value, 0.9), 6) + 0.0 AS q900 FROM events GROUP BY event_type")
def duration_quantiles(spark, sf):
    return _r(P.duration_quantiles(table(spark, sf, "events"), ["event_type"], "value"), "q100", "q500", "q900")


@query("""SELECT 'a' AS sensor, event_id, value, NULL AS event_type FROM events WHERE event_id % 2 = 0
UNION ALL SELECT 'b', event_id, value, event_type FROM events WHERE event_id % 2 = 1""")
def merge_tiles(spark, sf):
    e = table(spark, sf, "events")
    return collate({"a": e.where("event_id % 2 = 0").select("event_id", "value"), "b": e.where("event_id % 2 = 1").select("event_id", "value", "event_type")}).select("sensor", "event_id", "value", "event_type")


@query(f"""WITH {_CROSS} SELECT id, year(date)::INT AS year, count(d0) AS n, round(median(d0), 6) + 0.0 AS val_dist FROM wl GROUP BY ALL""")
def survey_years(spark, sf):
    return _r(V.by_year(S.waterline_intercept(profiles(spark, sf)).withColumn("date", F.col("date").cast("timestamp"))), "val_dist")


@query("""WITH k AS (SELECT p_partkey, p_type AS kind, CASE WHEN p_size % 2 = 0 THEN 'Lake' ELSE 'Estuary' END AS featuretype, CASE WHEN p_size % 3 = 0 THEN 'Perennial' ELSE 'Dry' END AS perenniality FROM part)
SELECT p_partkey FROM k WHERE (featuretype = 'Lake' AND perenniality = 'Perennial') OR featuretype = 'Estuary'""")
def waterbody_filter(spark, sf):
    kind = F.when(F.col("p_size") % 2 == 0, "Lake").otherwise("Estuary")
    rows = table(spark, sf, "part").withColumns({"FEATURETYPE": kind, "PERENNIALITY": F.when(F.col("p_size") % 3 == 0, "Perennial").otherwise("Dry")})
    return S.waterbodies(rows).select("p_partkey")
