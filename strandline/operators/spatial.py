"""Spatial joins and lines. Joins by place are equi joins on grid cells with an exact test after.

A side is broadcast only where a count says that it is small (``MOST_VERTICES``, ``MOST_QUERIES``).
"""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions.geometry import crossing, in_disc, on_segment, ring_contains
from strandline.operators.ordering import numbered

#: Vertices of polygons, and queries, that are broadcast at once.
MOST_VERTICES, MOST_QUERIES = 100_000, 10_000
#: Rows of one place that travel as one array.
MOST_LISTED = 1_000_000
NEAR = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1)]


def _cells(df: DataFrame, x: str, y: str, size: float) -> DataFrame:
    return df.withColumns({"_cx": F.floor(F.col(x) / size), "_cy": F.floor(F.col(y) / size)})


def _around(df: DataFrame, x: str, y: str, size: float) -> DataFrame:
    """A row for each of the nine cells about a point."""
    near = F.explode(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in NEAR)))
    out = df.withColumn("_n", near)
    return out.withColumns({"_cx": F.floor(F.col(x) / size) + F.col("_n.a"), "_cy": F.floor(F.col(y) / size) + F.col("_n.b")}).drop("_n")


def _spread(df: DataFrame, *columns: str) -> DataFrame:
    """Dealt to a fixed number of tasks: pairs are many more than the rows that they come from, by whose size tasks would be merged."""
    spark = df.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    return df.repartition(n, *columns)


def _place_pairs(here: DataFrame, there: DataFrame, radius: float) -> DataFrame:
    """Rows of ``here`` (``cx, cy``), put in nine cells each, with those of ``there`` (``px, py``) in the same cell."""
    cells = ["_cx", "_cy"]
    return _spread(_around(here, "cx", "cy", radius), *cells).join(_spread(_cells(there, "px", "py", radius), *cells), cells).drop(*cells)


def _inside(radius: float, shape: str) -> Column:
    return in_disc(F.col("px") - F.col("cx"), F.col("py") - F.col("cy"), radius, shape)


def _listed(df: DataFrame, place: Sequence[str], name: str) -> DataFrame:
    """A row for each place with its rows as an array, of at most ``MOST_LISTED`` rows each."""
    part = F.floor(F.monotonically_increasing_id() / MOST_LISTED)
    rest = [c for c in df.columns if c not in place]
    return df.withColumn("_part", part).groupBy(*place, "_part").agg(F.collect_list(F.struct(F.lit(0).alias("_0"), *rest)).alias(name)).drop("_part")


def within_distance(centres: DataFrame, points: DataFrame, radius: float, shape: str = "polygon") -> DataFrame:
    """Pairs of a centre (``cx, cy``) and a point (``px, py``) strictly within its buffer.

    Places meet, not their rows: centres' places, the fewer, are put in nine cells each, so a pair of places meets once, and its
    rows are paired as they are given out. Nothing else grows with the number of pairs.
    """
    pairs = _place_pairs(_listed(centres, ["cx", "cy"], "_c"), _listed(points, ["px", "py"], "_p"), radius).where(_inside(radius, shape))
    rows = pairs.select("cx", "cy", "px", "py", "_p", F.inline("_c")).drop("_0")
    return rows.select(*(c for c in rows.columns if c != "_p"), F.inline("_p")).drop("_0").select(*centres.columns, *points.columns)


def nearest_within(left: DataFrame, right: DataFrame, key: str, radius: float) -> DataFrame:
    """Every row of ``left`` (``cx, cy``) with its nearest rows of ``right`` (``px, py``) within the radius.

    Equally near rows are all kept; rows without a neighbour stay, with NULLs. Distances are of places, each once, however many
    rows lie there.
    """
    dx, dy = F.col("px") - F.col("cx"), F.col("py") - F.col("cy")
    pairs = _place_pairs(left.select("cx", "cy").distinct(), right.select("px", "py").distinct(), radius)
    pairs = pairs.withColumn("distance", F.sqrt(dx * dx + dy * dy)).where(F.col("distance") <= radius)
    first = pairs.withColumn("_r", F.rank().over(Window.partitionBy("cx", "cy").orderBy("distance"))).where("_r = 1")
    first = first.groupBy("cx", "cy").agg(F.min("distance").alias("distance"), F.collect_list(F.struct(F.col("px").alias("_px"), F.col("py").alias("_py"))).alias("_near"))
    # a key can have several places
    near = left.select(key, "cx", "cy").join(first, ["cx", "cy"])
    near = near.withColumn("_least", F.min("distance").over(Window.partitionBy(key))).where("distance = _least")
    near = near.groupBy(key).agg(F.min("distance").alias("distance"), F.flatten(F.collect_list("_near")).alias("_near"))
    found = left.join(near, key, "left").select(*left.columns, "distance", F.inline_outer("_near"))
    both = found.join(right, (F.col("_px") == F.col("px")) & (F.col("_py") == F.col("py")), "left")
    return both.select(key, *(c for c in left.columns if c != key), *right.columns, "distance")


def rocky_flag(points: DataFrame, shores: DataFrame, key: str, query: str = "Preds = 'Bedrock' AND Probs > 0.75", radius: float = 300.0) -> DataFrame:
    """``key, rocky``: whether any of the nearest shores within the radius meets the condition; False without one."""
    flagged = shores.groupBy("px", "py").agg(F.bool_or(F.coalesce(F.expr(query), F.lit(False))).alias("rocky"))
    near = nearest_within(points.select(key, "cx", "cy").distinct(), flagged, key, radius)
    return near.groupBy(key).agg(F.bool_or(F.coalesce("rocky", F.lit(False))).alias("rocky"))


def nearest_vectors(queries: DataFrame, rows: DataFrame, key: str, vector: str, other: str, other_vector: str, digits: int = 5) -> DataFrame:
    """``key, distance, other``: for each query the other row of the least squared distance, rounded; ties go to the smallest id.

    Ids are whole numbers, a query's own id does not count. Queries go to the rows in blocks of a bounded size; each task keeps
    one candidate for each query of a block, so pairs are never rows.
    """
    blocks = max(1, -(-queries.count() // MOST_QUERIES))
    own = queries.select(F.col(key).cast("long").alias("_q"), F.col(vector).cast("array<double>").alias("_v")).where("_q is not null and _v is not null")
    named = rows.select(F.col(other).cast("long").alias("_i"), F.col(other_vector).cast("array<double>").alias("_v")).where("_i is not null and _v is not null")

    def block(k: int) -> DataFrame:
        asked = own if blocks == 1 else own.where(F.pmod(F.xxhash64("_q"), F.lit(blocks)) == k)
        held = rows.sparkSession.sparkContext.broadcast([(r._q, r._v) for r in asked.collect()])
        return named.mapInArrow(_nearest_of(held, digits), "_q long, distance double, _i long")

    found = reduce(DataFrame.unionByName, map(block, range(blocks)))
    # two aggregates of plain numbers: one of structs would have to sort
    least = found.withColumn("_d", F.min("distance").over(Window.partitionBy("_q"))).where("distance = _d")
    return least.groupBy(F.col("_q").alias(key)).agg(F.min("distance").alias("distance"), F.min("_i").alias(other))


def _nearest_of(held, digits: int):
    """A function of Arrow batches that gives each held query's nearest row of them all."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        ids = np.array([q for q, _ in held.value], np.int64)
        lengths = np.array([len(v) for _, v in held.value], np.int64)
        best, at = np.full(len(ids), np.inf), np.full(len(ids), np.iinfo(np.int64).max)
        groups = {}
        for n in np.unique(lengths):
            which = np.flatnonzero(lengths == n)
            # a missing number is NaN, whose distances are never least
            groups[int(n)] = which, np.array([[np.nan if x is None else x for x in held.value[i][1]] for i in which], np.float64).reshape(len(which), n)
        power = 10.0**digits

        def shown(d):
            y = d * power
            low = np.floor(y)
            return (low + (y - low >= 0.5)) / power

        def exact(q, r):
            d = np.zeros(len(q))
            for i in range(q.shape[1]):
                d += (r[:, i] - q[:, i]) ** 2
            return shown(d)

        for batch in batches:
            named, lists = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
            sizes, flat, start = np.diff(lists.offsets.to_numpy()), lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()[:-1]
            for n in np.unique(sizes):
                if int(n) not in groups:
                    continue
                which, asked = groups[int(n)]
                here = np.flatnonzero(sizes == n)
                for some in (here[k : k + 512] for k in range(0, len(here), 512)):
                    r = flat[start[some][:, None] + np.arange(n)]
                    rid = named[some]
                    for part in (slice(k, k + 1024) for k in range(0, len(which), 1024)):
                        w, q = which[part], asked[part]
                        qq, rr = np.einsum("ij,ij->i", q, q), np.einsum("ij,ij->i", r, r)
                        with np.errstate(invalid="ignore"):
                            near = qq[:, None] + rr[None, :] - 2.0 * (q @ r.T)
                        near[ids[w][:, None] == rid[None, :]] = np.nan
                        # products only choose who is measured: their error is far below this, beside that of rounding
                        slack = 2.0 / power + 1e-12 * (n + 1) * (qq[:, None] + rr[None, :])
                        limit = np.minimum(best[w], np.nanmin(np.where(np.isnan(near), np.inf, near + slack), axis=1) if near.size else np.inf)
                        i, j = np.nonzero(near - slack <= limit[:, None])
                        d, g, m = exact(q[i], r[j]), w[i], rid[j]
                        good = ~np.isnan(d)
                        d, g, m = d[good], g[good], m[good]
                        first = np.lexsort((m, d, g))
                        d, g, m = d[first], g[first], m[first]
                        lead = np.r_[True, g[1:] != g[:-1]] if len(g) else np.zeros(0, bool)
                        d, g, m = d[lead], g[lead], m[lead]
                        better = (d < best[g]) | ((d == best[g]) & (m < at[g]))
                        best[g[better]], at[g[better]] = d[better], m[better]
        known = np.flatnonzero(np.isfinite(best))
        yield pa.RecordBatch.from_arrays([pa.array(ids[known]), pa.array(best[known]), pa.array(at[known])], names=["_q", "distance", "_i"])

    return run


def _boxed(polygons: DataFrame, attributes: Sequence[str]) -> DataFrame:
    x, y = F.transform("ring", lambda p: p["x"]), F.transform("ring", lambda p: p["y"])
    ends = {"_lox": F.array_min(x), "_hix": F.array_max(x), "_loy": F.array_min(y), "_hiy": F.array_max(y)}
    return polygons.select(*attributes, "ring", *(v.alias(k) for k, v in ends.items()))


def polygon_hits(points: DataFrame, polygons: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """Inner join of points (``px, py``) with the polygons that hold them, by an equi join on cells; any number of polygons.

    A polygon's cells are as wide as its box, rounded up to a power of two, so it has at most four. Points get the cell of
    each width in use; there are as many widths as powers of two between the smallest and the largest box.
    """
    boxed = _boxed(polygons, attributes)
    wide = F.greatest(F.col("_hix") - F.col("_lox"), F.col("_hiy") - F.col("_loy"), F.lit(2.0**-40))
    boxed = boxed.withColumn("_level", F.ceil(F.log2(wide)).cast("int"))
    size = F.pow(F.lit(2.0), F.col("_level"))

    def span(a, b):
        return F.explode(F.sequence(F.floor(F.col(a) / size), F.floor(F.col(b) / size)))

    celled = boxed.withColumn("_cx", span("_lox", "_hix")).withColumn("_cy", span("_loy", "_hiy"))
    levels = boxed.select("_level").distinct()  # at most some hundred powers of two
    dealt = points.join(F.broadcast(levels)).withColumns({"_cx": F.floor(F.col("px") / size), "_cy": F.floor(F.col("py") / size)})
    both = dealt.join(celled, ["_level", "_cx", "_cy"]).where(ring_contains(F.col("ring"), F.col("px"), F.col("py")))
    return both.select(*points.columns, *attributes)


def few(polygons: DataFrame) -> bool:
    """Whether the polygons have so few vertices that they may be broadcast."""
    return (polygons.agg(F.sum(F.size("ring").cast("long")).alias("n")).first().n or 0) <= MOST_VERTICES


def _same(columns: Sequence[str], other: str) -> Column:
    return reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"{other}.{c}")) for c in columns))


def in_polygons(points: DataFrame, polygons: DataFrame, attributes: Sequence[str], key: str | None = None) -> DataFrame:
    """Left join of points (``px, py``) with the polygons (``ring``) that hold them.

    Without ``key`` polygons of few vertices (regions, grid cells) are broadcast. With a ``key`` that tells points apart, and
    where there are more, they are met cell by cell, and points without one are joined back, by all columns if there is no key.
    """
    if key is not None:
        return points.join(polygon_hits(points.select(key, "px", "py"), polygons, attributes).select(key, *attributes), key, "left")
    if not few(polygons):
        hits = polygon_hits(points.distinct(), polygons, attributes)
        found = hits.select(F.struct(*points.columns).alias("_here"), *attributes)
        return points.join(found, _same(points.columns, "_here"), "left").select(*points.columns, *attributes)
    box = F.col("px").between(F.col("_lox"), F.col("_hix")) & F.col("py").between(F.col("_loy"), F.col("_hiy"))
    holds = box & ring_contains(F.col("ring"), F.col("px"), F.col("py"))
    return points.join(F.broadcast(_boxed(polygons, attributes)), holds, "left").select(*points.columns, *attributes)


def clip(points: DataFrame, polygons: DataFrame, key: str | None = None) -> DataFrame:
    """The points that lie in any of the polygons; ``key`` as for ``in_polygons``."""
    if key is not None:
        return points.join(polygon_hits(points.select(key, "px", "py"), polygons, []).select(key), key, "left_semi")
    if not few(polygons):
        found = polygon_hits(points.distinct(), polygons, []).select(F.struct(*points.columns).alias("_here"))
        return points.join(found, _same(points.columns, "_here"), "left_semi")
    return points.join(F.broadcast(polygons.select("ring")), ring_contains(F.col("ring"), F.col("px"), F.col("py")), "left_semi")


def in_edited(points: DataFrame, areas: DataFrame, edits: DataFrame, key: str) -> DataFrame:
    """The points (``key, px, py``) of a mask of areas with edits: those in an edit of type ``add``, and those in an area but
    in no edit of type ``remove``. Polygons can be any number; each point meets its own cells.
    """
    kind = F.when(F.col("type") == "add", "add").otherwise("remove")
    shapes = areas.select("ring", F.lit("area").alias("_kind")).unionByName(edits.where(F.col("type").isin("add", "remove")).select("ring", kind.alias("_kind")))
    hits = polygon_hits(points.select(key, "px", "py"), shapes, ["_kind"])
    held = {k: F.bool_or(F.col("_kind") == k) for k in ("area", "add", "remove")}
    return hits.groupBy(key).agg((held["add"] | (held["area"] & ~held["remove"])).alias("_on")).where("_on").select(key)


def segments(lines: DataFrame, line: Sequence[str], order: str = "ord", x: str = "x", y: str = "y") -> DataFrame:
    """Vertices to segments ``seg, x1, y1, x2, y2`` with the chainage ``start, stop`` of their ends.

    A line is one window, so its length bounds a task: lines are those of one tile or transect.
    """
    w = Window.partitionBy(*line).orderBy(order)
    out = lines.withColumns({"x2": F.lead(x).over(w), "y2": F.lead(y).over(w), "seg": F.row_number().over(w)})
    out = out.where("x2 is not null").withColumn("_len", F.hypot(F.col("x2") - F.col(x), F.col("y2") - F.col(y)))
    run = Window.partitionBy(*line).orderBy("seg").rowsBetween(Window.unboundedPreceding, 0)
    out = out.withColumn("stop", F.sum("_len").over(run))
    return out.select(*line, "seg", F.col(x).alias("x1"), F.col(y).alias("y1"), "x2", "y2", (F.col("stop") - F.col("_len")).alias("start"), "stop")


def points_on_lines(lines: DataFrame, line: Sequence[str], spacing: float = 30.0, order: str = "ord", x: str = "x", y: str = "y") -> DataFrame:
    """Points at 0, spacing, 2 spacing, … along each line, its whole length excluded: ``at, px, py``."""
    parts = segments(lines, line, order, x, y)
    total = Window.partitionBy(*line)
    parts = parts.withColumn("_end", F.floor(F.max("stop").over(total)))
    first, last = F.ceil(F.col("start") / spacing), F.ceil(F.col("stop") / spacing) - 1
    steps = F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))
    out = parts.withColumn("at", F.explode(steps)).withColumn("at", F.col("at") * spacing).where(F.col("at") < F.col("_end"))
    u = F.coalesce(F.try_divide(F.col("at") - F.col("start"), F.col("stop") - F.col("start")), F.lit(0.0))
    return out.select(
        *line, "at", (F.col("x1") + u * (F.col("x2") - F.col("x1"))).alias("px"), (F.col("y1") + u * (F.col("y2") - F.col("y1"))).alias("py")
    )


def nearest_on_lines(points: DataFrame, parts: DataFrame, key: Sequence[str], by: Sequence[str], reach: float) -> DataFrame:
    """For each point and each value of ``by`` (a year) the nearest place on the segments within ``reach``.

    Segments are short; each is put in the cells that its box grown by ``reach`` touches, points keep one cell. Of
    equally near segments the first counts. Nothing within reach: no row.
    """
    low, high = ((lambda a, b, f=f, s=s: F.floor((f(a, b) + s * reach) / reach)) for f, s in ((F.least, -1), (F.greatest, 1)))
    celled = parts.withColumn("_cx", F.explode(F.sequence(low(F.col("x1"), F.col("x2")), high(F.col("x1"), F.col("x2")))))
    celled = celled.withColumn("_cy", F.explode(F.sequence(low(F.col("y1"), F.col("y2")), high(F.col("y1"), F.col("y2")))))
    pairs = _cells(points, "px", "py", reach).join(celled, ["_cx", "_cy"])
    q = on_segment(*(F.col(c) for c in ("px", "py", "x1", "y1", "x2", "y2")))
    pairs = pairs.withColumn("_q", q).withColumn("distance", F.hypot(F.col("px") - F.col("_q.x"), F.col("py") - F.col("_q.y")))
    best = F.min(F.struct("distance", "seg", F.col("_q.x").alias("qx"), F.col("_q.y").alias("qy")))
    return pairs.where(F.col("distance") <= reach).groupBy(*key, *by).agg(best.alias("_b")).select(*key, *by, "_b.distance", "_b.qx", "_b.qy")


def line_crossings(transects: DataFrame, parts: DataFrame, key: Sequence[str], on: Sequence[str], cell: float = 1000.0) -> DataFrame:
    """Where each transect (``sx, sy, ex, ey``) meets the segments of each ``on``: only a single meeting point counts.

    Of ``on`` the columns that transects have too must be equal.
    """
    shared = [c for c in on if c in transects.columns]

    def celled(df, ends):
        (a, b, c, d) = (F.floor(F.col(e) / cell) for e in ends)
        out = df.withColumn("_cx", F.explode(F.sequence(F.least(a, c), F.greatest(a, c))))
        return out.withColumn("_cy", F.explode(F.sequence(F.least(b, d), F.greatest(b, d))))

    pairs = celled(transects, ("sx", "sy", "ex", "ey")).join(celled(parts, ("x1", "y1", "x2", "y2")), [*shared, "_cx", "_cy"])
    ends = [(F.col(a), F.col(b)) for a, b in (("sx", "sy"), ("ex", "ey"), ("x1", "y1"), ("x2", "y2"))]
    met = pairs.withColumn("_p", crossing(*ends)).where("_p is not null")
    # segments that share a vertex meet a transect in one point, and cells can show a pair more than once
    place = F.struct(F.round("_p.x", 6).alias("x"), F.round("_p.y", 6).alias("y"))
    got = met.groupBy(*key, *on).agg(F.collect_set(place).alias("_s"))
    return got.where(F.size("_s") == 1).select(*key, *on, F.get("_s", F.lit(0))["x"].alias("qx"), F.get("_s", F.lit(0))["y"].alias("qy"))


def bilinear_sample(points: DataFrame, grid: DataFrame, value: str, key: Sequence[str], on: Sequence[str] = ()) -> DataFrame:
    """The grid's value at fractional indices (``gy, gx``) of each point, from the four cells about it (``yi, xi``).

    NULL if one of the four is missing or unknown and has a weight.
    """
    corner = F.explode(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (0, 1) for b in (0, 1))))
    near = points.withColumn("_c", corner)
    y0, x0 = F.floor("gy"), F.floor("gx")
    near = near.withColumns({"yi": (y0 + F.col("_c.a")).cast("int"), "xi": (x0 + F.col("_c.b")).cast("int")})
    near = near.withColumn("_w", (1 - F.abs(F.col("gy") - F.col("yi"))) * (1 - F.abs(F.col("gx") - F.col("xi"))))
    joined = near.join(grid.select(*on, "yi", "xi", value), [*on, "yi", "xi"], "left")
    lost = F.bool_or(F.col(value).isNull() & (F.col("_w") > 0))
    return joined.groupBy(*key, *on).agg(F.when(~lost, F.sum(F.coalesce(value, F.lit(0.0)) * F.col("_w"))).alias(value))


def hotspots(centres: DataFrame, points: DataFrame, radius: float, key: str = "uid", year: str = "year", dist: str = "dist") -> DataFrame:
    """Median movement of each year over the good points within a centre's buffer (long form), rounded to 2 places.

    Equal movements of a place and year are one with a count, a place travels as one row, and centres at one place are one site
    (a key with several places is a site of its own), so what meets are places.
    """
    lists = points.groupBy("px", "py", year, dist).agg(F.count("*").alias("_n")).groupBy("px", "py").agg(F.collect_list(F.struct(year, dist, "_n")).alias("_moves"))
    places = centres.where("cx is not null and cy is not null").groupBy(key, "cx", "cy").agg(F.count("*").alias("_m"))
    sites = places.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("cx", "cy", "_m"))).alias("_site"))
    met = _place_pairs(sites.select("_site").distinct().select("_site", F.inline("_site")), lists, radius).where(_inside(radius, "polygon"))
    moves = met.select("_site", "_m", F.inline("_moves")).groupBy("_site", year, dist).agg(F.sum(F.col("_n") * F.col("_m")).alias("_n"))
    found = moves.groupBy("_site", year).agg((F.bround(F.percentile(dist, 0.5, F.col("_n")), 2) + F.lit(0.0)).alias(dist))
    return sites.join(found, "_site").select(key, year, dist)


def hotspot_counts(centres: DataFrame, places: DataFrame, radius: float, key: str = "uid") -> DataFrame:
    """Every centre with the number of points within its buffer and the certainty that it gives. Places meet, with counts."""
    there = places.groupBy("px", "py").agg(F.count("*").alias("n"))
    here = _place_pairs(centres.select("cx", "cy").distinct(), there, radius).where(_inside(radius, "polygon")).groupBy("cx", "cy").agg(F.sum("n").alias("n"))
    near = centres.select(key, "cx", "cy").join(here, ["cx", "cy"]).groupBy(key).agg(F.sum("n").alias("n"))
    n = F.coalesce("n", F.lit(0))
    sure = F.when(n < radius / 30, "insufficient points").otherwise("good")
    return centres.join(near, key, "left").withColumns({"radius_m": F.lit(int(radius)), "n": n.cast("int")}).withColumn("certainty", sure)


def transects(parts: DataFrame, line: Sequence[str], length: float = 400.0, interval: float = 200.0, buffer: float = 20.0) -> DataFrame:
    """Perpendiculars to each line every ``interval`` from ``buffer`` on; where it bends within the buffer there is none.

    A tangent joins the places ``buffer`` before and after; its length tells a bend. ``at, sx, sy, ex, ey``.
    Each segment names the places that lie on it, so lines are not joined with their segments.
    """
    named = parts.where(reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in line)))
    sides = named.select(*line, "x1", "y1", "x2", "y2", "start", "stop", F.explode(F.array(F.lit(-1), F.lit(1))).alias("_e"))
    # one more at either end, for rounding; the comparison decides
    low, high = (F.greatest(F.lit(0), F.floor((F.col(c) - buffer - F.col("_e") * buffer) / interval) + m) for c, m in (("start", -1), ("stop", 1)))
    found = sides.withColumn("_k", F.explode(F.sequence(low, high))).withColumn("at", F.lit(float(buffer)) + F.col("_k") * interval).withColumn("_d", F.col("at") + F.col("_e") * buffer)
    found = found.where((F.col("_d") >= F.col("start")) & (F.col("_d") < F.col("stop")))
    u = F.try_divide(F.col("_d") - F.col("start"), F.col("stop") - F.col("start"))
    found = found.select(*line, "at", "_e", (F.col("x1") + u * (F.col("x2") - F.col("x1"))).alias("_x"), (F.col("y1") + u * (F.col("y2") - F.col("y1"))).alias("_y"))
    # places may be many more than segments: by line alone, all of a line's would be in one task
    found = found.repartition(*line, "at")

    def at(side, c):
        return F.max(F.when(F.col("_e") == side, F.col(c)))

    pair = found.groupBy(*line, "at").agg(at(-1, "_x").alias("ax"), at(-1, "_y").alias("ay"), at(1, "_x").alias("bx"), at(1, "_y").alias("by"))
    span = F.hypot(F.col("bx") - F.col("ax"), F.col("by") - F.col("ay"))
    pair = pair.withColumn("_s", span).where(F.col("_s").isNotNull() & (F.col("_s") > 0) & (F.col("_s") <= 2 * buffer + 1e-6))
    mx, my = (F.col("ax") + F.col("bx")) / 2, (F.col("ay") + F.col("by")) / 2
    ux, uy = (F.col("bx") - F.col("ax")) / F.col("_s") * (length / 2), (F.col("by") - F.col("ay")) / F.col("_s") * (length / 2)
    return pair.select(*line, "at", (mx - uy).alias("sx"), (my + ux).alias("sy"), (mx + uy).alias("ex"), (my - ux).alias("ey"))


def oriented_transects(found: DataFrame, polygons: DataFrame, key: Sequence[str]) -> DataFrame:
    """Transects with one end on land (any of the polygons), turned to lead from land to water; the others go."""
    named = found.where(reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in key)))
    ends = named.select("*", F.inline(F.array(*(F.struct(F.lit(i).alias("_e"), F.col(x).alias("px"), F.col(y).alias("py")) for i, x, y in ((0, "sx", "sy"), (1, "ex", "ey"))))))
    land = in_polygons(ends, polygons.select(F.lit(True).alias("_land"), "ring"), ["_land"])
    # transects travel with their ends: joined back they would be made twice
    sides = land.groupBy(*found.columns).agg(*(F.coalesce(F.bool_or(F.when(F.col("_e") == i, F.col("_land"))), F.lit(False)).alias(f"_l{i}") for i in (0, 1)))
    good = sides.where(F.col("_l0") != F.col("_l1"))
    turned = {a: F.when(F.col("_l0"), F.col(a)).otherwise(F.col(b)) for a, b in (("sx", "ex"), ("sy", "ey"), ("ex", "sx"), ("ey", "sy"))}
    return good.select(*(c for c in found.columns if c not in turned), *(v.alias(k) for k, v in turned.items()))


def coastal_transects(
    lines: DataFrame, polygons: DataFrame, line: Sequence[str], tolerance: float = 200.0, length: float = 400.0, interval: float = 200.0, buffer: float = 20.0
) -> DataFrame:
    """Transects of coastlines (vertices ``ord, x, y``) that lead from land to water: lines are simplified before they are measured."""
    parts = segments(simplified(lines, line, tolerance), line)
    return oriented_transects(transects(parts, line, length, interval, buffer), polygons, [*line, "at"])


def _levelled(df: DataFrame, box: tuple[Column, Column, Column, Column]) -> DataFrame:
    """``_level``: the power of two that a row's box (low x, high x, low y, high y) fits in."""
    lox, hix, loy, hiy = box
    wide = F.greatest(hix - lox, hiy - loy, F.lit(2.0**-40))
    return df.withColumns({"_level": F.ceil(F.log2(wide)).cast("int"), "_lox": lox, "_hix": hix, "_loy": loy, "_hiy": hiy})


def _dealt(df: DataFrame, levels: DataFrame) -> DataFrame:
    """A row for each cell (at most four) that its box touches, at its own level and each wider one in use: ``_at, _cx, _cy``."""
    size = F.pow(F.lit(2.0), F.col("_at"))
    out = df.join(F.broadcast(levels), F.col("_at") >= F.col("_level"))

    def span(a, b):
        return F.explode(F.sequence(F.floor(F.col(a) / size), F.floor(F.col(b) / size)))

    return out.withColumn("_cx", span("_lox", "_hix")).withColumn("_cy", span("_loy", "_hiy"))


def box_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """Inner join of rows whose boxes meet (both as ``_levelled``; the columns of ``right`` as struct ``_r``).

    Both sides are dealt to grids of powers of two; a pair meets at the wider one's level, and counts in the cell that holds the
    lower corner of what the boxes share.
    """
    # levels are powers of two: some hundred at most
    levels = left.select(F.col("_level").alias("_at")).unionByName(right.select(F.col("_level").alias("_at"))).distinct()
    other = _dealt(right, levels)
    other = other.select("_at", "_cx", "_cy", F.struct(*right.columns).alias("_r"))
    both = _dealt(left, levels).join(other, ["_at", "_cx", "_cy"]).where(F.col("_at") == F.greatest(F.col("_level"), F.col("_r._level")))
    x, y = F.greatest(F.col("_lox"), F.col("_r._lox")), F.greatest(F.col("_loy"), F.col("_r._loy"))
    meet = (x <= F.least(F.col("_hix"), F.col("_r._hix"))) & (y <= F.least(F.col("_hiy"), F.col("_r._hiy")))
    size = F.pow(F.lit(2.0), F.col("_at"))
    first = (F.floor(x / size) == F.col("_cx")) & (F.floor(y / size) == F.col("_cy"))
    return both.where(meet & first).select(*(c for c in left.columns if c not in ("_level", "_lox", "_hix", "_loy", "_hiy")), "_r")


def split_lines(parts: DataFrame, polygons: DataFrame, attributes: Sequence[str], outside: bool = False) -> DataFrame:
    """Segments cut at the edges of polygons: the pieces inside with the polygon's attributes, and those outside with NULLs.

    Both kinds together are a union overlay of lines, the pieces inside an intersection overlay, or a clip. Segments meet
    the polygons whose boxes touch theirs, cell by cell. Equal segments are one in what is outside.
    """
    a, b = (F.col("x1"), F.col("y1")), (F.col("x2"), F.col("y2"))
    n = F.size("ring")
    edges = F.zip_with("ring", F.concat(F.slice("ring", 2, n - 1), F.slice("ring", 1, 1)), lambda p, q: F.struct(p.alias("p"), q.alias("q")))
    dx, dy = b[0] - a[0], b[1] - a[1]

    def place(e):
        met = crossing(a, b, (e["p"]["x"], e["p"]["y"]), (e["q"]["x"], e["q"]["y"]))
        return F.try_divide((met["x"] - a[0]) * dx + (met["y"] - a[1]) * dy, dx * dx + dy * dy)

    cuts = F.array_distinct(F.array_sort(F.concat(F.array(F.lit(0.0), F.lit(1.0)), F.filter(F.transform(edges, place), lambda t: t.isNotNull()))))
    x, y = F.transform("ring", lambda p: p["x"]), F.transform("ring", lambda p: p["y"])
    shapes = _levelled(polygons.select(*attributes, "ring"), (F.array_min(x), F.array_max(x), F.array_min(y), F.array_max(y)))
    lines = _levelled(parts, (F.least(a[0], b[0]), F.greatest(a[0], b[0]), F.least(a[1], b[1]), F.greatest(a[1], b[1])))
    met = box_pairs(lines, shapes)
    pairs = met.select(*parts.columns, *(F.col(f"_r.{c}").alias(c) for c in (*attributes, "ring")))
    t = pairs.withColumn("_t", cuts)
    piece = F.zip_with(F.slice("_t", 1, F.size("_t") - 1), F.slice("_t", 2, F.size("_t") - 1), lambda u, v: F.struct(u.alias("u"), v.alias("v")))
    each = t.withColumn("_p", F.explode(piece)).withColumn("_m", (F.col("_p.u") + F.col("_p.v")) / 2)
    each = each.withColumn("_in", F.coalesce(ring_contains(F.col("ring"), a[0] + F.col("_m") * dx, a[1] + F.col("_m") * dy), F.lit(False)))
    ends = {f"{c}{k}": F.col(f"{c}1") + F.col(f"_p.{u}") * d for k, u in ((1, "u"), (2, "v")) for c, d in (("x", dx), ("y", dy))}
    keep = [c for c in parts.columns if c not in ends]
    inside = each.where("_in").select(*keep, *(v.alias(k) for k, v in ends.items()), *attributes)
    if not outside:
        return inside
    # what no polygon holds: the segment's places less the inside intervals, cut at all their ends
    spans = each.groupBy(*parts.columns).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("_t")))).alias("_t"), F.collect_list(F.when(F.col("_in"), F.col("_p"))).alias("_i"))
    alone = parts.distinct().join(spans.select(F.struct(*parts.columns).alias("_here")), _same(parts.columns, "_here"), "left_anti")
    whole, none = F.array(F.lit(0.0), F.lit(1.0)), F.array().cast("array<struct<u:double,v:double>>")
    spans = spans.unionByName(alone.withColumns({"_t": whole, "_i": none}))
    free = spans.withColumn("_p", F.explode(piece)).withColumn("_m", (F.col("_p.u") + F.col("_p.v")) / 2)
    free = free.where(~F.exists("_i", lambda i: (i["u"] <= F.col("_m")) & (F.col("_m") <= i["v"])))
    return inside.unionByName(free.select(*keep, *(v.alias(k) for k, v in ends.items()), *(F.lit(None).cast(polygons.schema[c].dataType).alias(c) for c in attributes)))


def rasterize(cells: DataFrame, polygons: DataFrame, attribute: str) -> DataFrame:
    """Cells (``px, py`` of their centres) with the greatest attribute of the polygons that hold them, 0 outside."""
    found = in_polygons(cells, polygons, [attribute])
    return found.groupBy(*cells.columns).agg(F.coalesce(F.max(attribute), F.lit(0)).alias(attribute))


def segment_classes(parts: DataFrame, classes: DataFrame, on: Sequence[str], value: str = "class") -> DataFrame:
    """Segments in cell units with the class of the cell (``yi, xi``) that holds their middle."""
    mid = parts.withColumns({"yi": F.round((F.col("y1") + F.col("y2")) / 2).cast("int"), "xi": F.round((F.col("x1") + F.col("x2")) / 2).cast("int")})
    return mid.join(classes.select(*on, "yi", "xi", value), [*on, "yi", "xi"], "left").drop("yi", "xi")


def dissolve(lines: DataFrame, by: Sequence[str], points: str = "points") -> DataFrame:
    """The lines of each key as the parts of one."""
    return lines.groupBy(*by).agg(F.collect_list(points).alias("parts"))


def centroids(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Centres of lines, their segments weighted by length."""
    w = F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    return parts.groupBy(*by).agg(*(F.try_divide(F.sum(w * (F.col(f"{c}1") + F.col(f"{c}2")) / 2), F.sum(w)).alias(c) for c in "xy"))


def simplified(lines: DataFrame, line: Sequence[str], tolerance: float) -> DataFrame:
    """Vertices (``ord, x, y``) of each line without those near its chords."""
    from strandline.functions.kernels import kept_vertices

    def run(pdf):
        pdf = pdf.sort_values("ord")
        return pdf[kept_vertices(pdf[["x", "y"]].to_numpy(float), tolerance)]

    return lines.groupBy(*line).applyInPandas(run, lines.schema)


def nearest_attribute(points: DataFrame, shores: DataFrame, key: str, attribute: str, radius: float, skip: Sequence[str] = ("Unclassified",)) -> DataFrame:
    """``key`` and the attribute of the nearest shore within the radius (ties: the smallest), without the skipped ones."""
    useful = shores.where(~F.coalesce(F.col(attribute).isin(*skip), F.lit(True))).groupBy("px", "py").agg(F.min(attribute).alias(attribute))
    near = nearest_within(points.select(key, "cx", "cy").dropDuplicates([key]), useful, key, radius)
    return near.groupBy(key).agg(F.min(attribute).alias(attribute))


def subset_box(df: DataFrame, box: Sequence[float], order: str = "y") -> DataFrame:
    """Points (``x, y``) of a box with new numbers from north to south; those at one place in the order of their other columns."""
    inside = df.where(F.col("x").between(box[0], box[2]) & F.col("y").between(box[1], box[3]))
    rest = (F.asc(c) for c in df.columns if c not in (order, "x"))
    return numbered(inside, F.desc(order), F.asc("x"), *rest)
