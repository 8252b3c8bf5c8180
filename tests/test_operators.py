import math
import random
import re
import statistics

import pytest
from pyspark.sql import functions as F

from strandline.functions import geodesy, geometry
from strandline.functions.numbers import nan_to_null, tidy
from strandline.functions.statistics import circular, student_p
from strandline.operators import composites as C
from strandline.operators import rates as R
from strandline.operators import rasters as X
from strandline.operators import reports as P
from strandline.operators import spatial as S
from strandline.operators import surveys as V
from strandline.operators import validation as A


def one(df):
    return df.collect()[0]


def value(spark, column):
    return one(spark.range(1).select(column.alias("v"))).v


def test_tide_cutoffs_and_composite(spark):
    tides = spark.createDataFrame([(1, -1.0), (1, 3.0), (1, 0.5)], "cell int, tide_m double")
    r = one(C.tide_cutoffs(tides, ["cell"]))
    assert (r.tide_min, r.tide_max) == (-1.0, 1.0)
    assert sorted(x.tide_m for x in C.tidal_subset(tides, C.tide_cutoffs(tides, ["cell"]), ["cell"]).collect()) == [-1.0, 0.5]
    obs = spark.createDataFrame([(1, v) for v in (1.0, 1.0, 2.0, 2.0, None)], "k int, v double")
    r = one(C.composite(obs, ["k"], "v"))
    assert (r.v, r.stdev, r["count"]) == (1.5, 0.5, 4)


def test_years_of_composites_and_order(spark):
    rows = [("t", 0, 0, 1990 + i % 15, float(i)) for i in range(60)] + [("t", 0, 0, 2001, None)]
    random.Random(1).shuffle(rows)
    obs = spark.createDataFrame(rows, "tile string, yi int, xi int, year int, v double")
    assert {r.year for r in C.annual_composite(obs, "v", 2000, 2002).collect()} == {1999, 2000, 2001, 2002}
    pooled = {r.year: r for r in C.pooled_composite(obs, "v", 2000, 2002).collect()}
    assert set(pooled) == {2000, 2001, 2002}
    for y, r in pooled.items():
        near = sorted(v for *_, yy, v in rows if abs(yy - y) <= 1 and v is not None)
        assert r["count"] == len(near) and r.v == (near[len(near) // 2] + near[(len(near) - 1) // 2]) / 2


def test_gapfill_select(spark):
    annual = spark.createDataFrame([("t", i, 0, 2000, 1.0, 0.1, n) for i, n in enumerate((6, 5, 1))], "tile string, yi int, xi int, year int, v double, stdev double, count int")
    pooled = annual.withColumns({"v": F.lit(9.0), "count": F.lit(12)})
    got = {r.yi: (r.v, r["count"]) for r in C.gapfill_select(annual, pooled, "v").collect()}
    assert got == {0: (1.0, 6), 1: (9.0, 12), 2: (None, None)}


def test_certainty(spark):
    rows = spark.createDataFrame([(4, 0.5), (5, 0.31), (5, 0.3), (None, None)], "n int, s double")
    assert [r.c for r in rows.select(C.certainty_class(F.col("n"), F.col("s")).alias("c")).collect()] == [2, 1, 0, 0]
    assert value(spark, C.certainty_name(F.lit(0), F.lit(1991), F.lit(-20.0))) == "aerosol issues"
    assert value(spark, C.certainty_name(F.lit(1), F.lit(1991), F.lit(-30.0))) == "unstable data"


def test_all_time_stats(spark):
    rows = spark.createDataFrame([("a", 2000, 5.0), ("a", 2001, 9.0), ("a", 2002, 9.0), ("a", 2003, 0.0)], "uid string, year int, dist double")
    assert tuple(one(R.all_time_stats(rows, ["uid"], 2000)))[1:] == (4, 4, 9.0, -5.0, 2001, 2003)


def test_movement_sign_and_limit(spark):
    def moved(d, there, here):
        return value(spark, R.movement(F.lit(d), F.lit(there).cast("double"), F.lit(here).cast("double")))

    assert [moved(10.0, 2, 1), moved(10.0, 1, 2), moved(10.0, 1, 1), moved(10.0, None, 1)] == [10.0, -10.0, -10.0, None]
    assert (moved(1199.9, 2, 1), moved(1200.0, 2, 1)) == (1199.9, None)


def test_regression_without_outliers(spark):
    rows = [("a", y, 2.0 * (y - 2000)) for y in range(2000, 2010)] + [("a", 2010, 500.0), ("a", 2011, None), ("b", 2000, 1.0)]
    got = {r.uid: r for r in R.change_regress(spark.createDataFrame(rows, "uid string, year int, dist double"), ["uid"], "year", "dist").collect()}
    assert (got["a"].rate, got["a"].sig, list(got["a"].outliers)) == (2.0, 0.0, [2010, 2011])
    assert got["b"].rate is None
    flags = R.mad_outliers(spark.createDataFrame([r for r in rows if r[2] is not None], "uid string, year int, dist double"), ["uid"], "year", "dist")
    assert [r.year for r in flags.where("outlier").collect()] == [2010]


def test_rate_table_is_regression_and_summary(spark):
    rng = random.Random(5)
    rows = [(k, y, None if rng.random() < 0.2 else rng.gauss(0, 9) * (20 if rng.random() < 0.1 else 1)) for k in "abcdef" for y in range(1990, 2012)]
    rows += [("g", 2000, 1.0), ("h", 2000, None)]
    df = spark.createDataFrame(rows, "uid string, year int, dist double")
    fit = R.change_regress(df, ["uid"], "year", "dist")
    both = fit.join(R.all_time_stats(df.join(fit.select("uid", "outliers"), "uid"), ["uid"], 1990, "dist", "outliers"), "uid")
    got = R.rate_table(df, ["uid"], 1990).select(*both.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, both.collect())) and got.count() == 7
    assert all(r.valid_obs + len(r.outliers) == (1 if r.uid == "g" else 22) for r in got.collect())
    for r in fit.collect():  # an independent fit
        pts = [(y, v) for k, y, v in rows if k == r.uid and v is not None and y not in r.outliers]
        if len(pts) > 2:
            n, mx, my = len(pts), sum(x for x, _ in pts) / len(pts), sum(y for _, y in pts) / len(pts)
            sxx, sxy = sum((x - mx) ** 2 for x, _ in pts), sum((x - mx) * (y - my) for x, y in pts)
            sse = sum((y - my - sxy / sxx * (x - mx)) ** 2 for x, y in pts)
            assert abs(r.rate - sxy / sxx) < 1e-3 and abs(r.se - math.sqrt(sse / (n - 2) / sxx)) < 1e-3


def test_gapfilled_composite_equals_the_three_steps(spark):
    rng = random.Random(2)
    rows = [("t", i % 4, i % 3, 1999 + rng.randrange(6), None if rng.random() < 0.1 else rng.random()) for i in range(400)]
    obs = spark.createDataFrame(rows, "tile string, yi int, xi int, year int, v double")
    annual = C.annual_composite(obs, "v", 2000, 2003).where("year >= 2000")
    want = C.gapfill_select(annual, C.pooled_composite(obs, "v", 2000, 2003), "v")
    got = C.gapfilled_composite(obs, "v", 2000, 2003)

    def plain(df):
        return sorted(str(tuple(round(x, 9) if isinstance(x, float) else x for x in r)) for r in df.select("tile", "yi", "xi", "year", "v", "stdev", "count").collect())

    assert plain(got) == plain(want)


@pytest.mark.parametrize("t,df", [(0.5, 1), (2.0, 2), (1.3, 7), (3.1, 8), (2.2, 31)])
def test_student_p(spark, t, df):
    n, total = 200_000, 0.0
    c = math.gamma((df + 1) / 2) / math.sqrt(df * math.pi) / math.gamma(df / 2)
    for i in range(n):  # midpoints between 0 and t
        x = (i + 0.5) * t / n
        total += c * (1 + x * x / df) ** (-(df + 1) / 2) * t / n
    assert abs(value(spark, student_p(F.lit(t), F.lit(df))) - (1 - 2 * total)) < 1e-9


def test_certainty_cascade(spark):
    sure = R.point_certainty(F.lit(True), F.lit(True), F.lit(60.0), F.lit(31.0), F.lit(25), 34)
    assert value(spark, sure) == "high angular variability"
    assert value(spark, R.point_certainty(F.lit(False), F.lit(False), F.lit(0.0), F.lit(0.0), F.lit(24), 34)) == "insufficient observations"
    assert value(spark, R.is_rocky(F.lit("Hard bedrock shore"), F.lit("Unclassified"))) and not value(spark, R.is_rocky(F.lit("Unclassified"), F.lit("Hard bedrock shore")))


def test_display_fields_keep_their_signs(spark):
    df = spark.createDataFrame([(-1.0, 0.5, 0.01, "good")], "rate_time double, se_time double, sig_time double, certainty string")
    r = one(R.wms_fields(df))
    assert r.wms_grew and not r.wms_retr and r.wms_sig and r.wms_good and r.wms_conf == 0.98


def test_points_on_line(spark):
    line = spark.createDataFrame([("a", 0, 0.0, 0.0), ("a", 1, 50.0, 0.0), ("a", 2, 100.7, 0.0)], "line string, ord int, x double, y double")
    got = sorted((r.at, r.px) for r in S.points_on_lines(line, ["line"], 30.0).collect())
    assert got == [(0.0, 0.0), (30.0, 30.0), (60.0, 60.0), (90.0, 90.0)]


def test_bucket_joins_equal_all_pairs(spark):
    rng = random.Random(7)
    a = [(i, rng.uniform(-500, 500), rng.uniform(-500, 500)) for i in range(60)]
    b = [(i, rng.uniform(-500, 500), rng.uniform(-500, 500)) for i in range(200)]
    left, right = spark.createDataFrame(a, "uid int, cx double, cy double"), spark.createDataFrame(b, "pid int, px double, py double")
    near = {(i, j) for i, x, y in a for j, u, v in b if math.hypot(u - x, v - y) < 90}
    assert {(r.uid, r.pid) for r in S.within_distance(left, right, 90.0, "disc").collect()} == near
    assert {(r.uid, r.pid) for r in S.within_distance(left, right, 90.0).collect()} <= near
    want = {}
    for i, x, y in a:
        d = sorted((math.hypot(u - x, v - y), j) for j, u, v in b)
        want[i] = d[0][1] if d[0][0] <= 40 else None
    assert {r.uid: r.pid for r in S.nearest_within(left, right, "uid", 40.0).collect()} == want


def crowded(spark):
    """Few places with many rows each, and a key (7) that has two rows at one place and one at another."""
    rng = random.Random(3)
    places = [(0.0, 0.0), (30.0, 40.0), (-50.0, 0.0), (55.0, 40.0), (400.0, 0.0)]
    a = [(i, *rng.choice(places)) for i in range(40)] + [(7, *places[1]), (7, *places[1]), (7, *places[4]), (99, None, None)]
    b = [(i, *rng.choice(places[:4])) for i in range(90)] + [(1000, None, 0.0)]
    return a, b, spark.createDataFrame(a, "uid int, cx double, cy double"), spark.createDataFrame(b, "pid int, px double, py double")


def places_meet(df):
    """Whether both sides of the join on cells are grouped first, so that it can't pair the rows of places."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return re.split(r"Join Inner, .*_cx#", plan)[1].count("Aggregate [") >= 2


def nearest_of(a, b, radius):
    """Rows of a key with all of b that are nearest to any of the key's rows, as the join with the query's ranks gives them."""
    out = []
    for k, x, y in a:
        near = [(math.hypot(u - cx, v - cy), j) for kk, cx, cy in a if kk == k and cx is not None for j, u, v in b if u is not None and math.hypot(u - cx, v - cy) <= radius]
        out += [(k, j) for d, j in near if d == min(near)[0]] or [(k, None)]
    return sorted(out, key=str)


def test_nearest_attribute_of_crowded_places(spark):
    a, b, left, right = crowded(spark)
    got = S.nearest_attribute(left.where("uid <> 7"), right.withColumn("kind", F.when(F.col("pid") % 3 == 0, "Unclassified").when(F.col("pid") % 3 == 1, "rocky").otherwise("sandy")), "uid", "kind", 60.0)
    kinds = {k: None for k, _, _ in a if k != 7}
    for k, j in nearest_of([r for r in a if r[0] != 7], [r for r in b if r[0] % 3], 60.0):
        if j is not None:
            kinds[k] = min(kinds[k] or "z", "rocky" if j % 3 == 1 else "sandy")
    assert {r.uid: r.kind for r in got.collect()} == kinds and places_meet(got)


def test_nearest_rows_of_crowded_places(spark):
    a, b, left, right = crowded(spark)
    got = S.nearest_within(left, right, "uid", 60.0)
    assert got.columns == ["uid", "cx", "cy", "pid", "px", "py", "distance"]
    assert sorted(((r.uid, r.pid) for r in got.collect()), key=str) == nearest_of(a, b, 60.0) and places_meet(got)


def test_counts_of_crowded_places(spark):
    a, b, left, right = crowded(spark)
    got = S.hotspot_counts(left, right, 60.0)
    want = {k: sum(math.hypot(u - x, v - y) < 59 for kk, x, y in a if kk == k and x is not None for _, u, v in b if u is not None) for k, _, _ in a}
    assert sorted((r.uid, r.n) for r in got.collect()) == sorted((k, want[k]) for k, _, _ in a) and places_meet(got)


def test_rocky_flag_of_crowded_places(spark):
    a, b, left, right = crowded(spark)
    got = S.rocky_flag(left, right, "uid", "pid % 30 = 1", 60.0)
    want = {k: False for k, _, _ in a}
    for k, j in nearest_of(a, b, 60.0):
        want[k] = want[k] or (j is not None and j % 30 == 1)
    assert {r.uid: r.rocky for r in got.collect()} == want and places_meet(got)


@pytest.mark.parametrize("shape", ["disc", "polygon"])
def test_pairs_of_crowded_places(spark, shape):
    a, b, left, right = crowded(spark)
    got = S.within_distance(left, right, 60.0, shape)
    want = sorted((k, j) for k, x, y in a if x is not None for j, u, v in b if u is not None and math.hypot(u - x, v - y) < 59)
    assert got.columns == ["uid", "cx", "cy", "pid", "px", "py"]
    assert sorted((r.uid, r.pid) for r in got.collect()) == want and places_meet(got)


def test_hotspots_of_crowded_places(spark):
    a, b, left, right = crowded(spark)
    moves = [(u, v, y, None if j % 11 == 0 else float(j * y % 7)) for j, u, v in b for y in (2000, 2001)]
    got = S.hotspots(left, spark.createDataFrame(moves, "px double, py double, year int, dist double"), 60.0)
    want = {}
    for k, x, y in a:
        for u, v, t, d in moves:
            if x is not None and u is not None and math.hypot(u - x, v - y) < 59:
                want.setdefault((k, t), []).append(d)
    assert {(r.uid, r.year): r.dist for r in got.collect()} == {k: statistics.median([d for d in v if d is not None]) for k, v in want.items()} and places_meet(got)


def test_nearest_vectors_equal_all_pairs(spark):
    """Ties of rounded distances go to the smallest id, copies included; no sort of pairs is planned."""
    rng = random.Random(4)
    rows = [(i, [rng.choice((0.0, 1e-4, 0.5, 1.0, 3e3)) + rng.choice((0.0, 1e-3)) for _ in range(6)]) for i in range(300)]
    rows += [(1000 + i, rows[i][1]) for i in range(0, 300, 7)] + [(5000, [1.0]), (5050, None), (5100, [1.0, None])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    q = df.where("vec_id % 50 = 0").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("qe"))
    found = S.nearest_vectors(q, df, "qid", "qe", "vec_id", "embedding")
    got = {r.qid: r.vec_id for r in found.collect()}
    want = {}
    for k, v in rows:
        if k % 50 == 0 and v and len(v) == 6:
            want[k] = min((math.floor(sum((a - b) ** 2 for a, b in zip(v, u)) * 1e5 + 0.5) / 1e5, j) for j, u in rows if j != k and u and len(u) == 6)[1]
    assert got == want
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()


def test_hotspot_certainty(spark):
    centres = spark.createDataFrame([("a", 0.0, 0.0), ("b", 1e5, 0.0), ("c", 2e5, 0.0)], "uid string, cx double, cy double")
    places = spark.createDataFrame([(0.1 * i, 0.0) for i in range(34)] + [(1e5 + 0.1 * i, 0.0) for i in range(33)], "px double, py double")
    got = {r.uid: (r.n, r.certainty) for r in S.hotspot_counts(centres, places, 1000.0).collect()}
    assert got == {"a": (34, "good"), "b": (33, "insufficient points"), "c": (0, "insufficient points")}


def test_transects_are_perpendicular(spark):
    line = spark.createDataFrame([("a", 0, 0.0, 0.0), ("a", 1, 1000.0, 0.0)], "line string, ord int, x double, y double")
    rows = sorted(S.transects(S.segments(line, ["line"]), ["line"]).collect(), key=lambda r: r.at)
    assert [r.at for r in rows] == [20.0, 220.0, 420.0, 620.0, 820.0]
    assert all(abs(r.sx - r.at) < 1e-9 and abs(r.ex - r.at) < 1e-9 and abs(abs(r.sy - r.ey) - 400) < 1e-9 for r in rows)


def test_transects_grow_with_their_line(spark):
    """Places are found by the segment that holds them; joined with all segments of its line they would grow with the square."""
    line = spark.range(3001).select(F.lit("a").alias("line"), F.col("id").alias("ord"), (F.col("id") * 70.0).alias("x"), (F.col("id") % 2 * 9.0).alias("y"))
    parts = S.segments(line, ["line"])
    got = S.transects(parts, ["line"])
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
    total = one(parts.agg(F.max("stop").alias("t"))).t
    assert sorted(r.at for r in got.collect()) == [20.0 + 200 * k for k in range(int((total - 20) // 200) + 1) if 40.0 + 200 * k < total]
    assert S.transects(parts.withColumn("line", F.lit(None).cast("string")), ["line"]).count() == 0


def test_azimuth_and_degrees(spark):
    assert value(spark, geometry.azimuth(*map(F.lit, (0.0, 0.0, 0.0, 5.0)))) == 360.0
    assert value(spark, geometry.azimuth(*map(F.lit, (0.0, 0.0, 5.0, 0.0)))) == 90.0
    assert value(spark, geodesy.dms_to_degrees(F.lit("0°30'00"))) == -0.5
    assert value(spark, geodesy.dms_to_degrees(F.lit("151°30'00\""))) == 151.5


def test_geohash(spark):
    assert value(spark, geodesy.geohash(F.lit(10.40744), F.lit(57.64911), 11)) == "u4pruydqqvj"
    assert value(spark, geodesy.geohash(F.lit(-5.6), F.lit(42.6), 5)) == "ezs42"


def test_projections(spark):
    p = value(spark, geodesy.albers(F.lit(132.0), F.lit(0.0)))
    assert abs(p.x) < 1e-6 and abs(p.y) < 1e-6
    back = value(spark, geodesy.albers_inverse(F.lit(1_234_567.0), F.lit(-3_456_789.0)))
    again = value(spark, geodesy.albers(F.lit(back.lon), F.lit(back.lat)))
    assert abs(again.x - 1_234_567) < 1e-2 and abs(again.y + 3_456_789) < 1e-2
    tm = value(spark, geodesy.transverse_mercator(F.lit(153.0), F.lit(-30.0), 153.0))
    assert abs(tm.x - 500_000) < 1e-6 and 6_680_000 < tm.y < 6_682_000


def test_circular(spark):
    df = spark.createDataFrame([(179.0,), (1.0,)], "a double")
    mean, std = circular(F.col("a"))
    r = one(df.agg(mean.alias("m"), std.alias("s")))
    assert min(r.m, 180 - r.m) < 1e-9 and 0.9 < r.s < 1.1


PROFILE = "id string, date string, ord int, distance double, z double, x double, y double"


def profile(spark, heights):
    return spark.createDataFrame([("p", "d", i, 10.0 * i, z, 1.0 * i, 0.0) for i, z in enumerate(heights)], PROFILE)


@pytest.mark.parametrize("z,at", [((2.0, 1.0, -1.0), 15.0), ((1.0, -1.0, 1.0, -1.0), None), ((1.0, 0.0, -1.0), 10.0), ((1.0, None, -1.0), None), ((1.0, 2.0), None)])
def test_waterline(spark, z, at):
    assert one(V.waterline_intercept(profile(spark, z)))["0_dist"] == at


def test_survey_operators(spark):
    df = profile(spark, (1.0, 5.0, 5.0, 2.0, -1.0))
    kept = V.foredune_filter(df).collect()
    assert {r.foredune_dist for r in kept} == {10.0} and min(r.distance for r in kept) == 10.0
    assert tuple(one(V.endpoints(df)))[1:] == (0.0, 0.0, 4.0, 0.0)
    assert V.straddling(df).count() == 5 and V.straddling(profile(spark, (1.0, 2.0))).count() == 0
    assert one(V.reversed_chainage(df)).distance == 40.0
    tie = spark.createDataFrame([(1, "b", 0), (1, "a", 1)], "k int, m string, ord int")
    r = one(V.first_and_mode(tie, ["k"], ["ord"], ["m"]))
    assert r.m == "a" and r.ord == 0
    wide = spark.createDataFrame([("s", 1.0, None, 2.0, 3.0)], "id string, x1 double, x2 double, z1 double, z2 double")
    assert V.blocks_to_long(wide, ["id"], ["x", "z"], ["1", "2"]).count() == 2


def test_accuracy_weights_and_bias(spark):
    df = spark.createDataFrame([(1.0, 0.0, 2), (3.0, 1.0, 3)], "v double, s double, n int")
    r = one(A.accuracy(df, "v", "s", weight="n"))
    assert (r.n, r.mae, r.bias) == (5, 1.5, 1.5)
    r = one(A.accuracy(df, "v", "s", remove_bias=True))
    assert (r.bias, r.mae, r.rmse) == (1.5, 0.5, 0.5)
    figures = spark.createDataFrame([(10.0, 7.0, "a"), (12.0, 8.0, "a"), (9.0, 8.0, "a"), (1.0, 5.0, "b")], "v double, s double, k string")
    assert one(A.accuracy(figures.where("k = 'a'"), "v", "s", remove_bias=True)).bias == 2.67
    assert {r.k: (r.bias, r.mae) for r in A.accuracy(figures, "v", "s", ["k"], remove_bias=True).collect()} == {"a": (2.67, 1.11), "b": (-4.0, 0.0)}
    r = one(A.accuracy(df.limit(1), "v", "s"))
    assert r.stdev is None and r["corr"] is None


def test_bias_of_groups_without_a_window(spark):
    """No task holds the rows of a group, and a group without a name is one."""
    rows = [(float(i % 7), float(i % 5), (None, "a", "b")[i % 3]) for i in range(60)]
    got = A.accuracy(spark.createDataFrame(rows, "v double, s double, k string"), "v", "s", ["k"], remove_bias=True)
    for r in got.collect():
        d = [v - s for v, s, k in rows if k == r.k]
        bias = sum(d) / len(d)
        assert (r.n, r.bias) == (20, round(bias, 2)) and abs(r.mae - sum(abs(x - bias) for x in d) / 20) < 0.006
    assert got.count() == 3 and "Window" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_rolling_median_moves_through_slices(spark):
    """Against a plain search, over many slices of time, with equal times, unknown values and times; no window holds a whole key."""
    rng = random.Random(6)
    start = 1_700_000_000
    rows = [(i, rng.choice(("a", "b", None)), start + rng.randrange(200_000) // 7 * 7, rng.choice((None, 1.0, 2.5, rng.random()))) for i in range(1500)] + [(2000 + i, "a", None, 1.0 * i) for i in range(4)]
    df = spark.createDataFrame(rows, "id int, k string, s long, v double").withColumn("ts", F.timestamp_seconds("s"))
    got = P.rolling_median(df, ["k"], "ts", "v", 30, 3)
    assert got.columns == [*df.columns, "rolling"]
    want = {}
    for i, k, t, _ in rows:
        near = [v for _, kk, u, v in rows if kk == k and v is not None and ((t is None and u is None) or (t is not None and u is not None and t - 1800 < u <= t))]
        want[i] = statistics.median(near) if len(near) >= 3 else None
    assert {r.id: r.rolling for r in got.collect()} == want
    assert "Window" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_nan_and_negative_zero(spark):
    df = nan_to_null(spark.createDataFrame([(float("nan"),), (1.0,)], "v double"))
    assert [r.v for r in df.collect()] == [None, 1.0]
    assert str(value(spark, tidy(F.lit(-0.001), 2))) == "0.0" and value(spark, tidy(F.lit(0.125), 2)) == 0.12


def test_blocks_round_trip(spark):
    rows = [("t", 2000, 3, 4, 1.5), ("t", 2000, 5, 6, None), ("t", 2000, 4, 9, -2.0)]
    df = spark.createDataFrame(rows, "tile string, year int, yi int, xi int, v double")
    got = {tuple(r) for r in X.to_pixels(X.to_blocks(df, "v"), "v").collect()}
    assert got == {r for r in rows if r[4] is not None}


def test_polygons_of_all_sizes_by_cells(spark):
    rng = random.Random(9)
    boxes = [(i, rng.uniform(-900, 900), rng.uniform(-900, 900), 2.0 ** rng.uniform(-3, 10)) for i in range(60)]
    ring = [(i, [(x, y), (x + s, y), (x + s, y + s / 2), (x, y + s)]) for i, x, y, s in boxes]
    polygons = spark.createDataFrame(ring, "name int, ring array<struct<x:double,y:double>>")
    points = spark.createDataFrame([(i, rng.uniform(-1000, 1000), rng.uniform(-1000, 1000)) for i in range(400)], "pid int, px double, py double")
    a, b = (sorted((r.pid, r.name or -1) for r in S.in_polygons(points, polygons, ["name"], key).collect()) for key in (None, "pid"))
    assert a == b and len(a) >= 400
    assert sorted(r.pid for r in S.clip(points, polygons).collect()) == sorted(r.pid for r in S.clip(points, polygons, "pid").collect())


def test_global_numbers(spark):
    from strandline.operators.ordering import numbered

    values = [random.Random(i).randrange(1000) for i in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(7)
    got = sorted((r.id, r.v) for r in numbered(df, F.asc("v")).collect())
    assert [g[0] for g in got] == list(range(500)) and [g[1] for g in got] == sorted(values)
    assert numbered(df.where("v < 0"), F.asc("v")).count() == 0


def test_coastal_blocks_take_ocean_and_edits(spark):
    rows = [("t", y, i, j, (j - 20.2) / 10) for y in (2000, 2001, 2002) for i in range(30) for j in range(60)]
    blocks = X.to_blocks(spark.createDataFrame(rows, "tile string, year int, yi int, xi int, v double"), "v")
    ocean = spark.createDataFrame([("t", i, j) for i in range(30) for j in range(26, 60)], "tile string, yi int, xi int")
    edits = spark.createDataFrame([("t", i, j, 2) for i in range(10) for j in range(60)], "tile string, yi int, xi int, type int")

    def shore(**more):
        out = X.to_pixels(X.coastal_blocks(blocks, 0.0, 5, 4, **more), "v")
        return {r.yi for r in out.where("year = 2001 AND abs(xi - 20) < 2").collect()}

    assert shore() == set(range(30)) == shore(ocean=ocean)
    assert shore(ocean=ocean, edits=edits) == set(range(10, 30))
