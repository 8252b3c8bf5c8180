"""Rates of change: displacement from a baseline, outliers, regressions, summaries and certainty."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions.numbers import let
from strandline.functions.statistics import ols_error, ols_p

MAD_SCALE, MAD_LIMIT = 0.6745, 3.5
# Intertidal classes that count as rocky.
ROCKY = (
    "Bedrock breakdown debris (cobbles/boulders)", "Boulder (rock) beach", "Cliff (>5m) (undiff)", "Colluvium (talus) undiff",
    "Flat boulder deposit (rock) undiff", "Hard bedrock shore", "Hard bedrock shore inferred", "Hard rock cliff (>5m)",
    "Hard rocky shore platform", "Rocky shore (undiff)", "Rocky shore platform (undiff)", "Sloping hard rock shore",
    "Sloping rocky shore (undiff)", "Soft `bedrock¿ cliff (>5m)", "Steep boulder talus",
)


def baseline_displacement(df: DataFrame, keys: Sequence[str], value: str, baseline: int) -> DataFrame:
    """``dist``: the value less that of the baseline year; keys without a baseline are left out.

    A key's years are few, so a window brings the baseline to them; what is grouped by the same keys next needs no new shuffle.
    """
    base = F.max(F.when(F.col("year") == baseline, F.col(value))).over(Window.partitionBy(*keys))
    return df.withColumn("_base", base).where("_base is not null").withColumn("dist", F.col(value) - F.col("_base")).drop("_base")


def movement(distance: Column, base_there: Column, other_here: Column, most: float = 1200.0) -> Column:
    """The signed distance: positive if the baseline year's index at the other point exceeds the other year's here.

    NULL from ``most`` on, or where an index is not known.
    """
    sign = F.when(base_there > other_here, 1.0).when(base_there <= other_here, -1.0)
    return F.bround(F.when(distance < most, distance) * sign, 2) + F.lit(0.0)


def mad_outliers(df: DataFrame, keys: Sequence[str], x: str, y: str, limit: float = MAD_LIMIT) -> DataFrame:
    """``outlier``: whether a point lies far from its group's medians, by the median of the distances to them.

    Distances take both axes. A group whose median distance is 0 rejects every other point.
    """
    centre = df.groupBy(*keys).agg(F.median(x).alias("_mx"), F.median(y).alias("_my"))
    far = df.join(centre, list(keys)).withColumn("_d", F.hypot(F.col(x) - F.col("_mx"), F.col(y) - F.col("_my")))
    spread = far.groupBy(*keys).agg(F.median("_d").alias("_mad"))
    score = F.when(F.col("_mad") == 0, F.col("_d") > 0).otherwise(MAD_SCALE * F.col("_d") / F.col("_mad") > limit)
    return far.join(spread, list(keys)).withColumn("outlier", score).drop("_mx", "_my", "_d", "_mad")


def marked_lists(df: DataFrame, keys: Sequence[str], x: str, y: str, limit: float = MAD_LIMIT) -> DataFrame:
    """``points`` of each key: an array of (x, y, outlier) ordered by x, for short series.

    The series of a key is a few dozen years, so it is gathered once, and medians are taken within the array: one shuffle
    where joins would take five. Use ``mad_outliers`` for groups of any size.
    """
    known = F.col(x).isNotNull() & F.col(y).isNotNull()
    got = df.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.when(known, F.struct(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))))).alias("_p"),
        F.collect_set(F.when(F.col(x).isNotNull() & F.col(y).isNull(), F.col(x))).alias("_missing"),
    )
    # each step is bound once: a column used inside a lambda would be computed again for every element

    def xs(p):
        return middle(F.transform(p, lambda q: q["x"]))

    def ys(p):
        return middle(F.transform(p, lambda q: q["y"]))

    def distances(c):
        return F.struct(c["p"].alias("p"), F.transform(c["p"], lambda q: F.hypot(q["x"] - c["mx"], q["y"] - c["my"])).alias("d"))

    def spread(c):
        return F.struct(c["p"].alias("p"), c["d"].alias("d"), middle(c["d"]).alias("mad"))

    def marks(c):
        def mark(q, d):
            bad = F.when(c["mad"] == 0, d > 0).otherwise(MAD_SCALE * d / c["mad"] > limit)
            return F.struct(q["x"].alias("x"), q["y"].alias("y"), bad.alias("outlier"))

        return F.zip_with(c["p"], c["d"], mark)

    centre = F.struct(F.col("_p").alias("p"), xs(F.col("_p")).alias("mx"), ys(F.col("_p")).alias("my"))
    points = let(let(let(centre, distances), spread), marks)
    return got.select(*keys, points.alias("points"), "_missing")


def middle(values: Column) -> Column:
    """The median of an array of numbers."""

    def mean(v: Column) -> Column:
        n = F.size(v)
        return (F.get(v, F.floor((n - 1) / 2).cast("int")) + F.get(v, F.floor(n / 2).cast("int"))) / 2

    return let(F.array_sort(values), mean)


def detrended(y: Column, x: Column, slope: float, intercept: float) -> Column:
    """The part of ``y`` that a known trend leaves."""
    return y - (x * slope + intercept)


def line_of(points: Column) -> Column:
    """Least squares over an array of (x, y): ``struct<n, slope, intercept, sxx, syy, sxy>``."""

    def centred(p: Column) -> Column:
        n = F.nullif(F.size(p), F.lit(0))
        return F.struct(
            p.alias("p"),
            (F.aggregate(p, F.lit(0.0), lambda a, q: a + q["x"]) / n).alias("mx"),
            (F.aggregate(p, F.lit(0.0), lambda a, q: a + q["y"]) / n).alias("my"),
        )

    def squares(c: Column) -> Column:
        def total(f):
            return F.aggregate(c["p"], F.lit(0.0), lambda a, q: a + f(q["x"] - c["mx"], q["y"] - c["my"]))

        return F.struct(
            F.size(c["p"]).alias("n"), c["mx"].alias("mx"), c["my"].alias("my"),
            total(lambda x, y: x * x).alias("sxx"), total(lambda x, y: y * y).alias("syy"), total(lambda x, y: x * y).alias("sxy"),
        )

    def line(s: Column) -> Column:
        slope = F.try_divide(s["sxy"], s["sxx"])
        return F.struct(s["n"].alias("n"), slope.alias("slope"), (s["my"] - slope * s["mx"]).alias("intercept"), s["sxx"].alias("sxx"), s["syy"].alias("syy"), s["sxy"].alias("sxy"))

    return let(let(let(points, centred), squares), line)


def change_regress(df: DataFrame, keys: Sequence[str], x: str, y: str, limit: float = MAD_LIMIT, digits: int = 3) -> DataFrame:
    """A line through each key's points without outliers: ``rate, incpt, sig, se, outliers``.

    ``outliers`` are the sorted years that were not used, those without a value included. NULL below two points.
    """
    return regressed(marked_lists(df, keys, x, y, limit), keys, digits).drop("points")


def regressed(lists: DataFrame, keys: Sequence[str], digits: int = 3) -> DataFrame:
    """``change_regress`` of lists that are made already, which stay in ``points``."""
    bad = F.transform(F.filter("points", lambda p: p["outlier"]), lambda p: p["x"].cast("int"))
    left = F.array_sort(F.concat(bad, F.transform("_missing", lambda m: m.cast("int"))))
    fits = lists.withColumn("_f", line_of(F.filter("points", lambda p: ~p["outlier"]))).select(*keys, "points", left.alias("outliers"), "_f.*")
    fits = fits.withColumn("_se", ols_error(F.col("n"), F.col("sxx"), F.col("syy"), F.col("sxy")))
    p = ols_p(F.col("n"), F.col("slope"), F.col("_se"), F.col("syy"))
    enough = F.col("n") >= 2

    def shown(c):
        return F.when(enough, F.bround(c, digits) + F.lit(0.0))

    return fits.select(
        *keys, shown(F.col("slope")).alias("rate"), shown(F.col("intercept")).alias("incpt"), shown(p).alias("sig"),
        shown(F.col("_se")).alias("se"), "outliers", "points",
    )


def rate_table(df: DataFrame, keys: Sequence[str], initial: int, x: str = "year", y: str = "dist", limit: float = MAD_LIMIT) -> DataFrame:
    """``change_regress`` and ``all_time_stats`` together, from lists that are gathered once: one shuffle for all figures."""
    fits = regressed(marked_lists(df, keys, x, y, limit), keys)
    ok = fits.withColumn("_u", F.filter("points", lambda p: ~p["outlier"]))
    years, values = F.transform("_u", lambda p: p["x"]), F.transform("_u", lambda p: p["y"])
    top = F.array_max(F.transform("_u", lambda p: F.struct(p["y"].alias("y"), (-p["x"]).alias("x"))))
    low = F.array_min(F.transform("_u", lambda p: F.struct(p["y"].alias("y"), p["x"].alias("x"))))
    first = F.array_max(F.transform(F.filter("_u", lambda p: p["x"] == initial), lambda p: p["y"]))
    return ok.where(F.size("_u") > 0).select(
        *(c for c in fits.columns if c != "points"),
        F.size("_u").cast("long").alias("valid_obs"),
        (F.array_max(years) - F.array_min(years) + 1).cast("long").alias("valid_span"),
        (F.array_max(values) - F.array_min(values)).alias("sce"),
        (-first).alias("nsm"),
        (-top["x"]).cast("int").alias("max_year"),
        low["x"].cast("int").alias("min_year"),
    )


def all_time_stats(df: DataFrame, keys: Sequence[str], initial: int, dist: str = "dist", outliers: str | None = None) -> DataFrame:
    """Over the valid years of each key: obs, span, envelope, net movement since ``initial``, years of the extremes.

    Of equal extremes the first year counts. ``outliers`` names an array column of years to leave out.
    """
    ok = F.col(dist).isNotNull()
    if outliers:
        ok = ok & ~F.coalesce(F.array_contains(outliers, F.col("year").cast("int")), F.lit(False))
    rows = df.where(ok)
    top, low = F.max(F.struct(F.col(dist), -F.col("year"))), F.min(F.struct(F.col(dist), F.col("year")))
    return rows.groupBy(*keys).agg(
        F.count("*").alias("valid_obs"),
        (F.max("year") - F.min("year") + 1).cast("long").alias("valid_span"),
        (F.max(dist) - F.min(dist)).alias("sce"),
        (-F.max(F.when(F.col("year") == initial, F.col(dist)))).alias("nsm"),
        (-top["col2"]).cast("int").alias("max_year"),
        low["year"].cast("int").alias("min_year"),
    )


def point_certainty(baseline_out: Column, rocky: Column, rate: Column, angle_std: Column, valid_obs: Column, n_years: int) -> Column:
    """The certainty of a rate; of several reasons the last in this order: outlier, rocky, extreme, angular, too few."""
    return (
        F.when(valid_obs < int(0.75 * n_years), "insufficient observations")
        .when(angle_std > 30, "high angular variability")
        .when(F.abs(rate) > 50, "extreme value (> 50 m)")
        .when(rocky, "likely rocky coastline")
        .when(baseline_out, "baseline outlier")
        .otherwise("good")
    )


def is_rocky(first: Column, second: Column) -> Column:
    """Whether both intertidal classes are rocky; the second may be unclassified."""
    return F.coalesce(first.isin(*ROCKY) & second.isin(*ROCKY, "Unclassified"), F.lit(False))


def wms_fields(df: DataFrame, rate: str = "rate_time", se: str = "se_time", sig: str = "sig_time") -> DataFrame:
    """Display fields. A negative rate counts as ``wms_grew`` and a positive one as ``wms_retr``, as consumers expect it."""
    return df.withColumns(
        {
            "wms_abs": F.abs(rate),
            "wms_conf": F.col(se) * 1.96,
            "wms_grew": F.col(rate) < 0,
            "wms_retr": F.col(rate) > 0,
            "wms_sig": F.col(sig) <= 0.01,
            "wms_good": F.col("certainty") == "good",
        }
    )


def ransac_outliers(df: DataFrame, keys: Sequence[str], x: str, y: str, trials: int = 100, seed: int = 0) -> DataFrame:
    """``outlier`` by consensus: the line through two random points that most points are near, near being the median deviation of y."""
    import numpy as np
    import pandas as pd

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(x).reset_index(drop=True)
        px, py = pdf[x].to_numpy(float), pdf[y].to_numpy(float)
        rng, limit, best = np.random.default_rng(seed), np.median(np.abs(py - np.median(py))), np.zeros(len(px), bool)
        for _ in range(trials if len(px) > 2 else 0):
            i, j = rng.choice(len(px), 2, replace=False)
            if px[i] == px[j]:
                continue
            slope = (py[j] - py[i]) / (px[j] - px[i])
            near = np.abs(py - py[i] - slope * (px - px[i])) <= limit
            if near.sum() > best.sum():
                best = near
        return pdf.assign(outlier=~best if best.any() else np.zeros(len(px), bool))

    from pyspark.sql.types import BooleanType, StructType

    schema = StructType([*df.schema.fields]).add("outlier", BooleanType())
    return df.groupBy(*keys).applyInPandas(run, schema)
