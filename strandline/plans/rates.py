"""Queries of rates of change."""

from pyspark.sql import functions as F

from strandline.functions.statistics import circular, ols, ols_error, ols_p
from strandline.operators import rates as R
from strandline.operators import surveys as S
from strandline.plans.standins import MOVES, movements, table

QUERIES, ORACLE_SQL = {}, {}
BASE, FIRST, LAST = 1998, 1995, 2001


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _disp(spark, sf):
    return R.baseline_displacement(movements(spark, sf), ["uid"], "value", BASE).select("uid", "year", "value", "dist")


@query(f"WITH {MOVES} SELECT uid, year, round(dist, 6) + 0.0 AS dist FROM disp")
def baseline_displacement(spark, sf):
    return _disp(spark, sf).select("uid", "year", (F.round("dist", 6) + F.lit(0.0)).alias("dist"))


@query(f"""WITH {MOVES}, s AS (SELECT uid, year, abs(dist) * 20 AS d, value AS here, value - dist + (uid + year) % 3 - 1 AS there FROM disp)
SELECT uid, year, round_even(CASE WHEN d < 1200 THEN d END * CASE WHEN there > here THEN 1.0 WHEN there <= here THEN -1.0 END, 2) + 0.0 AS dist FROM s""")
def annual_movements(spark, sf):
    d = _disp(spark, sf)
    there = F.col("value") - F.col("dist") + (F.col("uid") + F.col("year")) % 3 - 1
    return d.select("uid", "year", R.movement(F.abs("dist") * 20, there, F.col("value")).alias("dist"))


_MAD = f"""{MOVES}, c AS (SELECT uid, median(year) AS mx, median(dist) AS my FROM disp GROUP BY uid),
far AS (SELECT uid, year, dist, sqrt((year - mx) ^ 2 + (dist - my) ^ 2) AS d FROM disp JOIN c USING (uid)),
s AS (SELECT uid, median(d) AS mad FROM far GROUP BY uid),
mad AS (SELECT uid, year, dist, CASE WHEN mad = 0 THEN d > 0 ELSE 0.6745 * d / mad > 3.5 END AS outlier FROM far JOIN s USING (uid))"""


@query(f"WITH {_MAD} SELECT uid, year, outlier FROM mad")
def mad_outliers(spark, sf):
    return R.mad_outliers(_disp(spark, sf), ["uid"], "year", "dist").select("uid", "year", "outlier")


_FIT = f"""{_MAD}, f AS (SELECT uid, count(*) AS n, regr_slope(dist, year) AS slope, regr_intercept(dist, year) AS incpt, regr_sxx(dist, year) AS sxx,
  regr_syy(dist, year) AS syy, regr_sxy(dist, year) AS sxy FROM mad WHERE NOT outlier GROUP BY uid),
e AS (SELECT *, CASE WHEN n > 2 THEN sqrt(greatest(0.0, (1 - coalesce(least(1.0, sxy * sxy / nullif(sxx * syy, 0)), 1.0)) * syy / nullif(sxx, 0) / (n - 2)))
  WHEN n = 2 THEN 0.0 END AS se FROM f),
a AS (SELECT *, n - 2 AS v, atan(abs(slope / nullif(se, 0)) / sqrt(nullif(n - 2, 0))) AS th FROM e),
q AS (SELECT *, CASE WHEN v % 2 = 1 THEN (v - 1) // 2 ELSE v // 2 END AS m FROM a),
tm AS (SELECT uid, k, CASE WHEN v % 2 = 1 THEN cos(th) ELSE 1.0 END * pow(cos(th), 2 * (k - 1))
    * coalesce(list_product([CASE WHEN v % 2 = 1 THEN 2.0 * j / (2 * j + 1) ELSE (2.0 * j - 1) / (2 * j) END FOR j IN range(1, k)]), 1.0) AS term
  FROM q, unnest(range(1, m + 1)) AS u(k)),
ts AS (SELECT uid, sum(term) AS total FROM tm GROUP BY uid),
p AS (SELECT q.*, CASE WHEN n < 2 THEN NULL WHEN syy = 0 THEN 1.0 WHEN n = 2 OR se = 0 THEN 0.0
  WHEN v % 2 = 1 THEN greatest(0.0, 1 - 2 / pi() * (th + sin(th) * coalesce(total, 0))) ELSE greatest(0.0, 1 - sin(th) * coalesce(total, 0)) END AS sig
  FROM q LEFT JOIN ts USING (uid)),
o AS (SELECT uid, list_sort(list(year::INT) FILTER (outlier)) AS bad FROM mad GROUP BY uid),
fit AS (SELECT uid, round_even(slope, 3) + 0.0 AS rate_time, round_even(incpt, 3) + 0.0 AS incpt_time, round_even(sig, 3) + 0.0 AS sig_time,
  round_even(se, 3) + 0.0 AS se_time, coalesce(array_to_string(bad, ' '), '') AS outl_time FROM p JOIN o USING (uid) WHERE n >= 2)"""


def _fit(spark, sf):
    fit = R.change_regress(_disp(spark, sf), ["uid"], "year", "dist")
    return fit.select(
        "uid", F.col("rate").alias("rate_time"), F.col("incpt").alias("incpt_time"), F.col("sig").alias("sig_time"), F.col("se").alias("se_time"),
        F.array_join("outliers", " ").alias("outl_time"), "outliers",
    )


@query(f"WITH {_FIT} SELECT * FROM fit")
def change_regress(spark, sf):
    return _fit(spark, sf).drop("outliers")


@query(f"WITH {_FIT} SELECT uid, n, round(sig, 9) + 0.0 AS p FROM p WHERE n >= 2")
def regress_pvalue(spark, sf):
    used = R.mad_outliers(_disp(spark, sf), ["uid"], "year", "dist").where(~F.col("outlier"))
    fits = used.groupBy("uid").agg(*(v.alias(k) for k, v in ols(F.col("year"), F.col("dist")).items()))
    fits = fits.withColumn("se", ols_error(F.col("n"), F.col("sxx"), F.col("syy"), F.col("sxy")))
    p = ols_p(F.col("n"), F.col("slope"), F.col("se"), F.col("syy"))
    return fits.where("n >= 2").select("uid", "n", (F.round(p, 9) + F.lit(0.0)).alias("p"))


_STATS = f"""{_MAD}, st AS (SELECT uid, count(*)::BIGINT AS valid_obs, (max(year) - min(year) + 1)::BIGINT AS valid_span, round(max(dist) - min(dist), 6) + 0.0 AS sce,
  round(-max(dist) FILTER (year = {FIRST}), 6) + 0.0 AS nsm, -max({{'d': dist, 'y': -year}}).y AS max_year, min({{'d': dist, 'y': year}}).y AS min_year
  FROM mad WHERE NOT outlier GROUP BY uid)"""


def _stats(spark, sf):
    d = _disp(spark, sf)
    marked = d.join(_fit(spark, sf).select("uid", "outliers"), "uid")
    return R.all_time_stats(marked, ["uid"], FIRST, "dist", "outliers")


@query(f"WITH {_STATS} SELECT uid, valid_obs, valid_span, sce, nsm, max_year::INT AS max_year, min_year::INT AS min_year FROM st")
def all_time_stats(spark, sf):
    return _stats(spark, sf).withColumns({c: F.round(c, 6) + F.lit(0.0) for c in ("sce", "nsm")})


@query("""WITH t AS (SELECT user_id, avg(sin(value * pi() / 90)) AS s, avg(cos(value * pi() / 90)) AS c FROM events GROUP BY user_id)
SELECT user_id, round((degrees(atan2(s, c)) / 2 + 360) % 180, 4) + 0.0 AS angle_mean, round(sqrt(-2 * ln(least(1.0, sqrt(s * s + c * c)))) * 90 / pi(), 4) + 0.0 AS angle_std FROM t""")
def circular_stats(spark, sf):
    mean, std = circular(F.col("value"))
    return table(spark, sf, "events").groupBy("user_id").agg((F.round(mean, 4) + F.lit(0.0)).alias("angle_mean"), (F.round(std, 4) + F.lit(0.0)).alias("angle_std"))


_CERT = f"""{_FIT}, {_STATS.split(", st AS", 1)[1] and "st AS" + _STATS.split(", st AS", 1)[1]},
cert AS (SELECT fit.*, valid_obs, CASE WHEN valid_obs < {int(0.75 * (LAST - FIRST + 1))} THEN 'insufficient observations' WHEN uid % 41 > 30 THEN 'high angular variability'
  WHEN abs(rate_time) > 50 THEN 'extreme value (> 50 m)' WHEN uid % 7 = 0 THEN 'likely rocky coastline'
  WHEN list_contains(string_split(outl_time, ' '), '{BASE}') THEN 'baseline outlier' ELSE 'good' END AS certainty FROM fit JOIN st USING (uid))"""


def _certain(spark, sf):
    named = {"rate": "rate_time", "incpt": "incpt_time", "sig": "sig_time", "se": "se_time"}
    both = R.rate_table(_disp(spark, sf), ["uid"], FIRST).where("rate is not null").withColumnsRenamed(named)
    both = both.withColumn("outl_time", F.array_join("outliers", " "))
    rocky = F.when(F.col("uid") % 7 == 0, "Hard bedrock shore").otherwise("Sandy beach undiff")
    sure = R.point_certainty(
        F.array_contains("outliers", BASE), R.is_rocky(rocky, F.lit("Unclassified")), F.col("rate_time"), F.col("uid") % 41, F.col("valid_obs"), LAST - FIRST + 1
    )
    return both.withColumn("certainty", sure)


@query(f"WITH {_CERT} SELECT uid, valid_obs, certainty FROM cert")
def point_certainty(spark, sf):
    return _certain(spark, sf).select("uid", "valid_obs", "certainty")


@query(f"""WITH {_CERT} SELECT uid, abs(rate_time) AS wms_abs, round(se_time * 1.96, 6) AS wms_conf, rate_time < 0 AS wms_grew, rate_time > 0 AS wms_retr,
  sig_time <= 0.01 AS wms_sig, certainty = 'good' AS wms_good FROM cert""")
def wms_fields(spark, sf):
    out = R.wms_fields(_certain(spark, sf))
    return out.select("uid", "wms_abs", F.round("wms_conf", 6).alias("wms_conf"), "wms_grew", "wms_retr", "wms_sig", "wms_good")


@query(f"""WITH {_CERT} SELECT uid, rate_time, sig_time, se_time, outl_time, cert.valid_obs, valid_span, sce, nsm, max_year::INT AS max_year, min_year::INT AS min_year, certainty
FROM cert JOIN st USING (uid)""")
def rates_of_change(spark, sf):
    out = _certain(spark, sf).withColumns({c: F.round(c, 6) + F.lit(0.0) for c in ("sce", "nsm")})
    return out.select("uid", "rate_time", "sig_time", "se_time", "outl_time", "valid_obs", "valid_span", "sce", "nsm", "max_year", "min_year", "certainty")


@query(f"""WITH {_CERT} SELECT uid::VARCHAR AS uid, round_even(abs(rate_time), 2)::DECIMAL(8, 2) AS wms_abs, round_even(se_time * 1.96, 1)::DECIMAL(8, 1) AS wms_conf,
  (rate_time < 0)::INT AS wms_grew, (rate_time > 0)::INT AS wms_retr, (sig_time <= 0.01)::INT AS wms_sig, (certainty = 'good')::INT::DECIMAL(8, 2) AS wms_good, certainty FROM cert""")
def wms_sink(spark, sf):
    from strandline.sinks import sink_view

    out = R.wms_fields(_certain(spark, sf))
    return sink_view(out.select("uid", "wms_abs", "wms_conf", "wms_grew", "wms_retr", "wms_sig", "wms_good", "certainty"), {"uid": "string"})


_YEARS = range(FIRST, LAST + 1)


@query(f"WITH {MOVES} SELECT uid, {', '.join(f'round(max(dist) FILTER (year = {y}), 6) + 0.0 AS dist_{y}' for y in _YEARS)} FROM disp GROUP BY uid")
def pivot_years(spark, sf):
    wide = S.long_to_years(_disp(spark, sf), ["uid"], "dist", FIRST, LAST)
    return wide.withColumns({f"dist_{y}": F.round(f"dist_{y}", 6) + F.lit(0.0) for y in _YEARS})


@query(f"WITH {MOVES} SELECT uid, 'dist_' || year AS variable, round(dist, 6) + 0.0 AS value FROM disp WHERE dist IS NOT NULL")
def wide_to_long(spark, sf):
    wide = S.long_to_years(_disp(spark, sf), ["uid"], "dist", FIRST - 3, LAST + 1)
    long = S.wide_to_long(wide, ["uid"], [c for c in wide.columns if c != "uid"])
    return long.withColumn("value", F.round("value", 6) + F.lit(0.0))


@query(f"WITH {MOVES} SELECT uid, year, round(dist - (0.5 * year - 990.0), 6) + 0.0 AS dist FROM disp")
def detrend(spark, sf):
    return _disp(spark, sf).select("uid", "year", (F.round(R.detrended(F.col("dist"), F.col("year"), 0.5, -990.0), 6) + F.lit(0.0)).alias("dist"))


@query(f"WITH {MOVES} SELECT uid, year, round_even(dist, 2)::DECIMAL(8, 2) AS dist FROM disp")
def sink_schema(spark, sf):
    from strandline.sinks import sink_view

    return sink_view(_disp(spark, sf).select("uid", "year", "dist"), {"uid": "bigint", "year": "int"})
