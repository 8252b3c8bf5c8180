"""Every query of the catalogue with SQL gives the rows that DuckDB gives."""

import datetime
import math
import os
import statistics
from collections import Counter

import duckdb
import numpy as np
import pytest

from strandline.functions import kernels
from strandline.operators import rasters
from strandline.plans import catalogue

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")


def plain(v):
    if isinstance(v, float):
        return None if v != v else v
    return v.replace(tzinfo=None) if isinstance(v, datetime.datetime) else v


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_query(spark, con, name):
    got = catalogue.QUERIES[name](spark, SF)
    want = con.sql(catalogue.ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    order = [want.columns.index(c) for c in got.columns]
    a = Counter(tuple(map(plain, r)) for r in got.collect())
    b = Counter(tuple(plain(r[i]) for i in order) for r in want.fetchall())
    assert a == b, (list((a - b).items())[:3], list((b - a).items())[:3])


@pytest.mark.parametrize("first", [1, 700000000001])
def test_wms_sink_of_rates_that_end_in_five(spark, tmp_path, first):
    """33.535 * 100 is less than 3353.5 and 37.505 * 100 more than 3750.5: neither is a tie to SQL. Ids have any length."""
    rates = [33.535, 32.995, 37.505, -37.145, -16.725, 10.085, 78.305, 10.525, -5.215]
    # 0.0001 beyond each rate, so that its third decimal is safe
    rows = ", ".join(f"({first + i}, {y}, {1000 + (r + math.copysign(0.0001, r)) * (y - 1998)})" for i, r in enumerate(rates) for y in range(1995, 2002))
    con = duckdb.connect()
    con.sql(f"""CREATE VIEW lineitem AS SELECT uid::BIGINT AS l_suppkey, make_timestamp(y, 6, 1, 0, 0, 0.0) AS l_shipdate, v::DOUBLE AS l_extendedprice,
      1.0::DOUBLE AS l_quantity FROM (VALUES {rows}) t(uid, y, v)""")
    con.sql(f"COPY lineitem TO '{tmp_path}/lineitem.parquet' (FORMAT parquet)")
    got = {tuple(r) for r in catalogue.QUERIES["wms_sink"](spark, str(tmp_path)).collect()}
    want = set(con.sql(catalogue.ORACLE_SQL["wms_sink"]).fetchall())
    assert got == want and len(got) == len(rates), (got - want, want - got)
    shown = {r[0]: float(r[1]) for r in got}
    assert [shown[str(first + i)] for i in range(len(rates))] == [33.53, 32.99, 37.51, 37.15, 16.73, 10.09, 78.31, 10.52, 5.22]


def test_all_others_are_below():
    assert set(catalogue.QUERIES) - set(catalogue.ORACLE_SQL) == {"ransac_outliers", "sieve", "subpixel_contours", "coastal_index"}


def test_ransac_outliers(spark, con):
    """Against a plain search: of the lines through the pairs drawn, the one that most points are near."""
    rows = con.sql("""WITH m AS (SELECT l_suppkey AS uid, year(l_shipdate)::INT AS year, median(l_extendedprice / l_quantity) AS v FROM lineitem GROUP BY 1, 2)
      SELECT m.uid, m.year, m.v - b.v FROM m JOIN m b ON b.uid = m.uid AND b.year = 1998 ORDER BY 1, 2""").fetchall()
    got = {(r.uid, r.year): r.outlier for r in catalogue.QUERIES["ransac_outliers"](spark, SF).collect()}
    assert len(got) == len(rows)
    for uid in {r[0] for r in rows}:
        x, y = zip(*[(float(r[1]), r[2]) for r in rows if r[0] == uid])
        limit = statistics.median(abs(v - statistics.median(y)) for v in y)
        rng, best = np.random.default_rng(0), set()
        for _ in range(100 if len(x) > 2 else 0):
            i, j = rng.choice(len(x), 2, replace=False)
            near = {k for k in range(len(x)) if abs(y[k] - y[i] - (y[j] - y[i]) / (x[j] - x[i]) * (x[k] - x[i])) <= limit}
            best = near if len(near) > len(best) else best
        assert [got[uid, int(v)] for v in x] == [bool(best) and k not in best for k in range(len(x))]


#: Tables with a supplier for each row of the rasters.
WIDE = "/root/testdata/sf0.01"


def raster(years=False):
    by = "year(l_shipdate)::INT" if years else "0"
    rows = duckdb.sql(f"""SELECT {by} AS t, (l_suppkey * 7 % 40)::INT AS yi, (l_partkey * 3 % 40)::INT AS xi, round(avg(l_discount), 6) - 0.05::DOUBLE AS v FROM '{WIDE}/lineitem.parquet' GROUP BY 1, 2, 3""").fetchall()
    out = {t: np.full((40, 40), np.nan) for t in sorted({r[0] for r in rows})}
    for t, y, x, v in rows:
        out[t][y, x] = v
    return out


def test_sieve(spark):
    """No small region is left that touches a larger one, and large regions keep their value."""
    grid = raster()[0]
    before = (grid > 0).astype(int)
    after = np.full((40, 40), -1)
    for r in catalogue.QUERIES["sieve"](spark, WIDE).collect():
        after[r.yi, r.xi] = r.v
    assert (after == kernels.sieve(before, 6)).all()
    label = kernels.components(before)
    sizes = dict(zip(*np.unique(label, return_counts=True)))
    for y, x in np.ndindex(40, 40):
        if sizes[label[y, x]] >= 6:
            assert after[y, x] == before[y, x]
    changed = kernels.components(after)
    assert len(np.unique(changed)) < len(sizes) and min(np.unique(changed, return_counts=True)[1]) >= 6


def test_subpixel_contours(spark):
    """Vertices are the places where neighbours cross the level; steps stay in a square."""
    grid, places = raster()[0], set()
    for y, x in np.ndindex(40, 40):
        for dy, dx in ((0, 1), (1, 0)):
            if y + dy < 40 and x + dx < 40 and not np.isnan(p := grid[y, x]) and not np.isnan(q := grid[y + dy, x + dx]) and (p > 0) != (q > 0):
                t = -p / (q - p)
                places.add((round(y + t * dy, 6), round(x + t * dx, 6)))
    lines = {}
    for r in catalogue.QUERIES["subpixel_contours"](spark, WIDE).orderBy("line", "ord").collect():
        lines.setdefault(r.line, []).append((r.y, r.x))
    assert lines and all(len(v) >= 4 for v in lines.values())
    for v in lines.values():
        assert {(round(y, 6), round(x, 6)) for y, x in v} <= places
        for (ya, xa), (yb, xb) in zip(v, v[1:]):
            assert max(ya, yb) <= math.floor(min(ya, yb)) + 1 and max(xa, xb) <= math.floor(min(xa, xb)) + 1


def test_coastal_index(spark):
    """The query deals rasters out and puts them together as the function of one tile's array does."""
    cells = raster(years=True)
    y, x = np.mgrid[:40, :40]
    cube = np.stack([(x - 20 - np.sin(y / 5.0)) / 20 + 4 * v for v in cells.values()])
    want = rasters.coastal_index(cube, None, 0.0, 6, None, 4)["masked"]
    got = {(r.year, r.yi, r.xi): r.mndwi for r in catalogue.QUERIES["coastal_index"](spark, WIDE).collect()}
    expected = {(t, int(a), int(b)): want[k, a, b] for k, t in enumerate(cells) for a, b in zip(*np.nonzero(~np.isnan(want[k])))}
    assert got.keys() == expected.keys() and all(math.isclose(v, expected[k], abs_tol=1e-9) for k, v in got.items()) and got


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
