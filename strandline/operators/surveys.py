"""Field-survey profiles: crossings, slopes, filters and attributes.

A profile is the rows of a key (``id, date``) in the order of the source, which the column ``ord`` keeps: crossings
and ends follow that order and not the distance.
"""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PROFILE = ("id", "date")


def intercepts(df: DataFrame, keys: Sequence[str] = PROFILE, datum: float = 0.0, order: str = "ord") -> DataFrame:
    """The first and the last place where each profile crosses the datum: ``n_crossings, first_, last_`` of distance, x, y.

    A crossing lies between two rows whose heights less the datum differ in sign; places are interpolated. A height
    that isn't known makes the profile's places NULL.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    names = [c for c in ("distance", "x", "y") if c in df.columns]
    nxt = df.withColumns({f"_{c}": F.lead(c).over(w) for c in ("z", *names)}).withColumn("_more", F.lead(F.lit(1)).over(w))
    steps = nxt.withColumn("_hit", F.col("_more").isNotNull() & (F.signum(F.col("z") - datum) != F.signum(F.col("_z") - datum)))
    u = F.try_divide(datum - F.col("z"), F.col("_z") - F.col("z"))
    place = {c: F.col(c) + u * (F.col(f"_{c}") - F.col(c)) for c in names}
    at = F.when(F.col("_hit"), F.struct(F.col(order), *(v.alias(c) for c, v in place.items())))
    got = steps.groupBy(*keys).agg(
        F.count(F.when(F.col("_hit"), 1)).alias("n_crossings"),
        F.bool_or(F.col("z").isNull()).alias("_lost"),
        F.min(at).alias("_first"),
        F.max(at).alias("_last"),
    )
    return got.select(
        *keys, "n_crossings", *(F.when(~F.col("_lost"), F.col(f"_{e}.{c}")).alias(f"{e}_{c}") for e in ("first", "last") for c in names)
    )


def waterline_intercept(df: DataFrame, keys: Sequence[str] = PROFILE, datum: float = 0.0, order: str = "ord") -> DataFrame:
    """The waterline of each profile: the crossing of the datum if it is the only one, else NULL.

    Two crossings at one place (a row that lies on the datum) count as one.
    """
    found = intercepts(df, keys, datum, order)
    names = [c[6:] for c in found.columns if c.startswith("first_")]
    one = F.col("first_distance") == F.col("last_distance")
    return found.select(*keys, *(F.when(one, F.col(f"first_{c}")).alias(f"{datum:g}_{'dist' if c == 'distance' else c}") for c in names))


def profile_slope(df: DataFrame, waterline: DataFrame, keys: Sequence[str] = PROFILE, datum: float = 0.0, buffer: float = 25.0, method: str = "distance") -> DataFrame:
    """Slope of height over distance near the waterline: within ``buffer`` of its distance, or of the datum's height."""
    at = f"{datum:g}_dist"
    rows = df.join(waterline.select(*keys, at), list(keys))
    near = F.abs(F.col("distance") - F.col(at)) <= buffer if method == "distance" else F.abs(F.col("z") - datum) <= buffer
    return rows.where(near).groupBy(*keys).agg((F.bround(F.regr_slope("z", "distance"), 3) + F.lit(0.0)).alias("slope"))


def foredune_filter(df: DataFrame, keys: Sequence[str] = PROFILE, order: str = "ord") -> DataFrame:
    """Rows from the highest one on, seaward; of equal heights the first counts. Adds ``foredune_dist``."""
    top = df.groupBy(*keys).agg(F.max_by("distance", F.when(F.col("z").isNotNull(), F.struct("z", -F.col(order)))).alias("foredune_dist"))
    return df.join(top, list(keys)).where(F.col("distance") >= F.col("foredune_dist"))


def endpoints(df: DataFrame, key: str = "id", order: str = "ord") -> DataFrame:
    """``start_x, start_y, end_x, end_y`` of each profile: its rows of least and greatest distance (ties: the first row)."""
    low = F.min(F.struct("distance", order, "x", "y"))
    high = F.max(F.struct(F.col("distance"), -F.col(order), F.col("x"), F.col("y")))
    got = df.where("distance is not null").groupBy(key).agg(low.alias("a"), high.alias("b"))
    return got.select(key, F.col("a.x").alias("start_x"), F.col("a.y").alias("start_y"), F.col("b.x").alias("end_x"), F.col("b.y").alias("end_y"))


def straight_only(df: DataFrame, key: str = "id", least: float = 0.99) -> DataFrame:
    """Profiles whose places lie on a line: \\|corr(x, y)\\| above ``least``."""
    good = df.groupBy(key).agg(F.corr("x", "y").alias("_r")).where(F.abs("_r") > least)
    return df.join(good.select(key), key, "left_semi")


def straddling(df: DataFrame, keys: Sequence[str] = PROFILE, datum: float = 0.0) -> DataFrame:
    """Profiles with rows above and below the datum."""
    good = df.groupBy(*keys).agg(F.min("z").alias("_lo"), F.max("z").alias("_hi")).where((F.col("_lo") < datum) & (F.col("_hi") > datum))
    return df.join(good.select(*keys), list(keys), "left_semi")


def first_and_mode(df: DataFrame, keys: Sequence[str], first: Sequence[str], modes: Sequence[str], order: str = "ord") -> DataFrame:
    """Attributes of each key: of some the first value, of others the most frequent (ties: the smallest)."""
    return df.groupBy(*keys).agg(
        *(F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in first), *(F.mode(c, True).alias(c) for c in modes)
    )


def wide_to_long(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str = "variable", value: str = "value") -> DataFrame:
    """A row for each of the columns; rows without a value go."""
    return df.unpivot(list(ids), list(columns), name, value).where(F.col(value).isNotNull())


def blocks_to_long(df: DataFrame, ids: Sequence[str], stubs: Sequence[str], suffixes: Sequence[str], name: str = "block") -> DataFrame:
    """Blocks of columns ``stub + suffix`` as rows with a column for each stub; blocks without any value go."""
    rows = F.array(*(F.struct(F.lit(s).alias(name), *(F.col(f"{t}{s}").alias(t) for t in stubs)) for s in suffixes))
    out = df.select(*ids, F.inline(rows))
    return out.where(reduce(lambda a, b: a | b, (F.col(t).isNotNull() for t in stubs)))


def long_to_years(df: DataFrame, keys: Sequence[str], value: str, start: int, end: int, prefix: str = "dist_") -> DataFrame:
    """A column for each year from ``start`` to ``end``, also for years without rows."""
    years = list(range(start, end + 1))
    wide = df.groupBy(*keys).pivot("year", years).agg(F.first(value))
    return wide.select(*keys, *(F.col(f"`{y}`").alias(f"{prefix}{y}") for y in years))


def drop_rows(df: DataFrame, bad: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(bad.select(*keys).distinct(), list(keys), "left_anti")


def reversed_chainage(df: DataFrame, key: str = "id") -> DataFrame:
    """Distances from the other end."""
    return df.withColumn("distance", F.max("distance").over(Window.partitionBy(key)) - F.col("distance"))


def in_years(column: Column, first: int = 1987, last: int | None = None) -> Column:
    """After ``first`` began and, if given, before ``last``."""
    ok = column > F.lit(f"{first}-01-01").cast("timestamp")
    return ok if last is None else ok & (F.year(column) < last)


def intercept_table(df: DataFrame, keys: Sequence[str] = PROFILE, first: Sequence[str] = (), modes: Sequence[str] = (), datum: float = 0.0) -> DataFrame:
    """The end of every survey pipeline: crossing, attributes and slope of each profile that has a waterline."""
    water = waterline_intercept(df, keys, datum)
    water = water.where(F.col(f"{datum:g}_dist").isNotNull())
    attributes = first_and_mode(df, keys, first, modes)
    return water.join(attributes, list(keys), "left").join(profile_slope(df, water, keys, datum), list(keys), "left")


# Perennial lakes and other water that no shoreline crosses.
WATER_TYPES = ("Aquaculture Area", "Estuary", "Watercourse Area", "Salt Evaporator", "Settling Pond")


def waterbodies(df: DataFrame, kind: str = "FEATURETYPE", perennial: str = "PERENNIALITY") -> DataFrame:
    """Water areas of an inland map: perennial lakes and the types in ``WATER_TYPES``."""
    lake = (F.col(kind) == "Lake") & (F.col(perennial) == "Perennial")
    return df.where(lake | F.col(kind).isin(*WATER_TYPES))
