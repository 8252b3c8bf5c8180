import datetime
import random

import pytest
from pyspark.sql import functions as F

from strandline.functions import geodesy
from strandline.operators import adapters as A
from strandline.operators import composites as C
from strandline.operators import rates as R
from strandline.operators import spatial as S

DAY = datetime.datetime(2001, 2, 3)
HEIGHTS = [3.0 - 0.25 * i for i in range(20)]  # meets 0 at row 12


def test_utm_there_and_back(spark):
    p = spark.range(1).select(geodesy.transverse_mercator(F.lit(151.3), F.lit(-33.7), 153.0).alias("p"))
    q = p.select(geodesy.transverse_mercator_inverse(F.col("p.x"), F.col("p.y"), 153.0).alias("q")).first().q
    assert abs(q.lon - 151.3) < 1e-8 and abs(q.lat + 33.7) < 1e-8


def check(df, dist, slope=True, n=1):
    rows = df.collect()
    assert len(rows) == n
    for r in rows:
        assert abs(r["0_dist"] - dist) < 0.6 and (not slope or r.slope is not None)
    return rows[0]


def test_wadot_and_dasilva(spark):
    lines = spark.createDataFrame([(1999, 0, i, 10.0 * i, 50.0, "AHD 0m ") for i in range(5)] + [(1980, 0, i, 10.0 * i, 60.0, "AHD 0m") for i in range(5)], "year int, line int, ord int, x double, y double, TYPE string")
    tr = spark.createDataFrame([("b", "1", 15.0, 0.0, 15.0, 100.0)], "beach string, profile string, sx double, sy double, ex double, ey double")
    r = check(A.wadot(lines, tr), 50.0, slope=False)
    assert r.id == "b_all_1" and r.slope is None
    assert A.dasilva2021(lines, tr).count() == 1 and A.wadot(lines.withColumn("TYPE", F.lit("x")), tr).count() == 0


def test_nswbpd(spark):
    rows = [("My Beach", "A", "P1", "3/02/2001", 5.0 * i, z, 340000.0 + 4 * i, 6260000.0 + 3 * i, "Photos") for i, z in enumerate([1.0, *HEIGHTS])]
    df = spark.createDataFrame(rows, "beach string, block string, profile string, date string, distance double, z double, x double, y double, source string").withColumn("ord", (F.col("distance") / 5).cast("int"))
    r = check(A.nswbpd(df), 65.0)
    assert r.id == "mybeach_a_p1" and r.source == "aerial photogrammetry" and r.foredune_dist == 5.0


def test_narrabeen(spark):
    df = spark.createDataFrame([("PF1", DAY, 5.0 * i, z, "Emery", i) for i, z in enumerate(HEIGHTS)], "profile string, date timestamp, distance double, z double, source string, ord int")
    r = check(A.narrabeen(df), 60.0)
    assert r.id == "narrabeen_all_pf1" and 180 < ((r.start_x - r.end_x) ** 2 + (r.start_y - r.end_y) ** 2) ** 0.5 < 240


def test_cgc(spark):
    name = "NO*TH KIRRA - ETA 63 - (ETA 2001-02-03).txt"
    df = spark.createDataFrame([(name, i, 550000.0 + 4 * i, 6885000.0 + 3 * i, z) for i, z in enumerate(HEIGHTS)], "file string, ord int, x double, y double, z double")
    assert check(A.cgc(df), 60.0).id == "northkirra_eta_63"


def test_sadew(spark):
    df = spark.createDataFrame([(7, i, 280000.0 + 4 * i, 6120000.0 + 3 * i, z, -9999.0) for i, z in enumerate(HEIGHTS)], "profile int, ord int, x double, y double, m03022001 double, m04022001 double")
    assert check(A.sadew(df, [1]), 60.0).id == "sadew_all_7"


def test_sunshinecoast(spark):
    df = spark.createDataFrame([("Kings Beach", "KB1", i, DAY, 5.0 * i, z, 510000.0, 7030000.0, 90.0) for i, z in enumerate(HEIGHTS)], "beach string, profile string, ord int, date timestamp, distance double, z double, start_x double, start_y double, bearing double")
    assert check(A.sunshinecoast(df), 60.0).id == "kingsbeach_na_KB1"


def test_tasmarc(spark):
    rows = spark.createDataFrame([("roches_beach_north_2001-02-03.txt", "roches_beach", i, str(5.0 * i), str(z), "2") for i, z in enumerate(HEIGHTS)] + [("roches_beach_north_2001-02-03.txt", "roches_beach", 99, "500", "9", "1")], "file string, site string, ord int, distance string, z string, flag string")
    meta = spark.createDataFrame([("roches_beach_north_2001-02-03.txt", "147.5", "-42.9", "2001-02-03 10:00", "95", "RTK GPS")], "file string, longitude string, latitude string, date string, bearing string, method string")
    r = check(A.tasmarc(rows, meta), 60.0)
    assert r.id == "rochesbeach_all_north" and r.source == "gps"


def test_moruya(spark):
    names = ", ".join(f"dist_{5 * i} double" for i in range(20))
    head = ("pedro", "all", "1", "03/02/2001", 240000.0, 6020000.0, 240100.0, 6020100.0)
    df = spark.createDataFrame([(*head, *(100 * z for z in HEIGHTS))], f"beach string, section string, profile string, date string, start_x double, start_y double, mid_x double, mid_y double, {names}")
    assert check(A.moruya(df), 60.0).id == "pedro_all_1"
    assert A.moruya(df.withColumn("profile", F.lit("4"))).count() == 0


def test_vicdeakin(spark):
    rows = [("apo", 3, DAY, f"POINT ({730000 + 4 * i}.5 {5700000 + 3 * i}.5)", 5.0 * i, 0.0, z) for i, z in enumerate(reversed(HEIGHTS))]
    df = spark.createDataFrame(rows, "location string, tr_id int, survey_date timestamp, coordinates string, distance double, z double, z_clean double").withColumn("ord", (F.col("distance") / 5).cast("int"))
    assert check(A.vicdeakin(df), 60.0).id == "apo_all_3"


def test_stirling(spark):
    rows = [("1", i, "03/02/2001", 270000.0 + 3 * i, 45000.0 - 4 * i, z) for i, z in enumerate(HEIGHTS)]
    df = spark.createDataFrame(rows, "profile string, ord int, date0 string, x0 double, y0 double, z0 double")
    ends = spark.createDataFrame([("1", 270000.0, 45000.0)], "profile string, start_x double, start_y double")
    check(A.stirling(df, ends, ["0"]), 60.0, slope=False)


SQUARE = [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)]


@pytest.fixture(scope="module")
def polygons(spark):
    return spark.createDataFrame([("in", 1, SQUARE)], "name string, cls int, ring array<struct<x:double,y:double>>")


def test_split_lines(spark, polygons):
    parts = spark.createDataFrame([("a", 1, -5.0, 5.0, 15.0, 5.0), ("a", 2, 15.0, 5.0, 15.0, 9.0)], "line string, seg int, x1 double, y1 double, x2 double, y2 double")
    inside = [(r.x1, r.x2) for r in S.split_lines(parts, polygons, ["name"]).collect()]
    assert inside == [(0.0, 10.0)]
    both = S.split_lines(parts, polygons, ["name"], outside=True).collect()
    assert sorted((r.seg, r.x1, r.x2, r.name or "") for r in both) == [(1, -5.0, 0.0, ""), (1, 0.0, 10.0, "in"), (1, 10.0, 15.0, ""), (2, 15.0, 15.0, "")]


def test_rasterize_and_classes(spark, polygons):
    cells = spark.createDataFrame([(0, 0, 5.5, 5.5), (0, 20, 20.5, 5.5)], "yi int, xi int, px double, py double")
    assert {r.xi: r.cls for r in S.rasterize(cells, polygons, "cls").collect()} == {0: 1, 20: 0}
    parts = spark.createDataFrame([(1, 0.0, 0.2, 0.2, 0.1)], "seg int, y1 double, x1 double, y2 double, x2 double")
    classes = spark.createDataFrame([(0, 0, 2)], "yi int, xi int, class int")
    assert S.segment_classes(parts, classes, []).first()["class"] == 2


def test_transects_lead_to_sea(spark, polygons):
    found = spark.createDataFrame([(1, 5.0, 5.0, 5.0, 20.0), (2, 5.0, 20.0, 5.0, 5.0), (3, 1.0, 1.0, 2.0, 2.0)], "at int, sx double, sy double, ex double, ey double")
    assert {(r.at, r.sy, r.ey) for r in S.oriented_transects(found, polygons, ["at"]).collect()} == {(1, 5.0, 20.0), (2, 5.0, 20.0)}


def test_coastal_transects_follow_the_simplified_line(spark):
    """Bends within the tolerance go before transects are drawn; those of the line as it is would be askew."""
    line = spark.createDataFrame([("a", i, 70.0 * i, 100.0 * (i % 2)) for i in range(31)], "line string, ord int, x double, y double")
    land = spark.createDataFrame([([(-500.0, 0.0), (3000.0, 0.0), (3000.0, -900.0), (-500.0, -900.0)],)], "ring array<struct<x:double,y:double>>")
    got = sorted(S.coastal_transects(line, land, ["line"]).collect(), key=lambda r: r.at)
    assert [(r.at, *(round(v, 6) for v in (r.sx, r.sy, r.ex, r.ey))) for r in got] == [(x, x, -200.0, x, 200.0) for x in (20.0 + 200 * k for k in range(11))]
    assert {r.at for r in S.coastal_transects(line, land, ["line"], tolerance=10.0).collect()} != {r.at for r in got}


def test_numbers_of_a_box_are_those_of_its_rows(spark):
    """Points at one place are numbered alike, however the rows are dealt."""
    df = spark.createDataFrame([(i * 37 % 200, float(i % 3), float(i % 2)) for i in range(200)], "pid int, x double, y double")
    want = {p: i for i, (_, _, p) in enumerate(sorted((-float(i % 2), float(i % 3), i * 37 % 200) for i in range(200)))}
    for rows in (df.repartition(5), df.orderBy(F.desc("pid"))):
        assert {r.pid: r.id for r in S.subset_box(rows, (0, 0, 5, 5)).collect()} == want


def test_small_operators(spark):
    line = spark.createDataFrame([("a", i, float(i), 0.001 * (i % 2)) for i in range(9)], "line string, ord int, x double, y double")
    assert S.simplified(line, ["line"], 0.1).count() == 2
    parts = S.segments(line.where("ord in (0, 8)"), ["line"])
    assert S.centroids(parts, ["line"]).first().x == 4.0
    assert len(S.dissolve(spark.createDataFrame([("a", [1]), ("a", [2])], "k string, points array<int>"), ["k"]).first().parts) == 2
    df = spark.createDataFrame([("x", 3), ("y", 1), ("y", 4), ("x", 2)], "crs string, ord int")
    assert C.modal(df, "crs", "ord").first().crs == "y"
    tide = spark.range(1).select(C.harmonic_tide(F.lit("1970-01-01 00:00:00").cast("timestamp"), [(1.5, 28.98, 0.0), (0.5, 30.0, 180.0)]).alias("h")).first().h
    assert abs(tide - 1.0) < 1e-9
    rng = random.Random(1)
    rows = [("a", float(i), 2.0 * i + rng.uniform(-0.1, 0.1)) for i in range(20)] + [("a", 20.0, 900.0)]
    out = R.ransac_outliers(spark.createDataFrame(rows, "k string, x double, y double"), ["k"], "x", "y").where("outlier").collect()
    assert [r.x for r in out] == [20.0]
    near = S.nearest_attribute(spark.createDataFrame([("p", 0.0, 0.0)], "id string, cx double, cy double"), spark.createDataFrame([(1.0, 0.0, "Unclassified"), (2.0, 0.0, "sandy")], "px double, py double, kind string"), "id", "kind", 10.0)
    assert near.first().kind == "sandy"
    assert [r.id for r in S.subset_box(spark.createDataFrame([(0.0, 1.0), (0.0, 2.0), (9.0, 9.0)], "x double, y double"), (0, 0, 5, 5)).orderBy("id").collect()] == [0, 1]
