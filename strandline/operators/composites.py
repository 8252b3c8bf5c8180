"""From pixel observations to annual and pooled composites.

An observation is a row of a pixel (``keys``) at a time. Every reduction is one grouped aggregate, so Spark combines before
it shuffles; masks and tide limits are row filters or conditions, which reach the scan.
"""

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions.numbers import let, normalised_difference

PIXEL = ("tile", "yi", "xi")


def collate(sensors: Mapping[str, DataFrame]) -> DataFrame:
    """One table of the sensors' tables, which may lack columns of each other, with the name in ``sensor``."""
    named = [df.withColumn("sensor", F.lit(name)) for name, df in sensors.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def scaled(df: DataFrame, bands: Iterable[str], factor: float = 0.0001) -> DataFrame:
    """Stored integers as reflectances."""
    return df.withColumns({b: F.col(b) * factor for b in bands})


def water_index(df: DataFrame, name: str = "mndwi") -> DataFrame:
    """``df`` with a water index: mndwi from green and swir1, ndwi from green and nir."""
    other = {"mndwi": "swir1", "ndwi": "nir"}[name]
    return df.withColumn(name, normalised_difference(F.col("green"), F.col(other)))


def erase(df: DataFrame, bad: Column, values: Iterable[str]) -> DataFrame:
    """NULL in ``values`` where ``bad`` holds; a condition that is not known erases nothing."""
    return df.withColumns({v: F.when(~F.coalesce(bad, F.lit(False)), F.col(v)) for v in values})


def mask_categories(df: DataFrame, column: str, bad: Sequence[str], values: Iterable[str]) -> DataFrame:
    return erase(df, F.col(column).isin(*bad), values)


def solar_day(time: Column, longitude: Column) -> Column:
    """The local solar date: the sun moves 15 degrees an hour."""
    return F.to_date(F.timestamp_seconds(F.unix_timestamp(time) + F.floor(longitude / 15 * 3600)))


def mosaic_by_day(df: DataFrame, keys: Sequence[str], day: str, order: str, values: Iterable[str]) -> DataFrame:
    """One row for each pixel and day: of each value the first that is known, in the given order."""
    return df.groupBy(*keys, day).agg(*(F.min_by(F.col(v), F.when(F.col(v).isNotNull(), F.col(order))).alias(v) for v in values))


def tide_cutoffs(tides: DataFrame, cell: Sequence[str], tide: str = "tide_m", centre: float = 0.0, share: float = 0.25) -> DataFrame:
    """For each cell the limits ``centre ± share * range of its tides``."""
    half = share * (F.max(tide) - F.min(tide))
    return tides.groupBy(*cell).agg((centre - half).alias("tide_min"), (centre + half).alias("tide_max"))


def tidal_subset(df: DataFrame, cutoffs: DataFrame, cell: Sequence[str], tide: str = "tide_m") -> DataFrame:
    """Observations within the limits of their cell, both ends included."""
    return df.join(cutoffs, list(cell)).where(F.col(tide).between(F.col("tide_min"), F.col("tide_max"))).drop("tide_min", "tide_max")


def bilinear_cutoffs(pixels: DataFrame, cutoffs: DataFrame, y: str, x: str, size: float) -> DataFrame:
    """Limits at each pixel, interpolated between the four cells (``cy, cx``) around it; at the rim from those there are."""
    fy, fx = F.col(y) / size - 0.5, F.col(x) / size - 0.5
    corners = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (0, 1) for b in (0, 1)))
    near = pixels.withColumn("_c", F.explode(corners))
    near = near.withColumns({"cy": F.floor(fy) + F.col("_c.a"), "cx": F.floor(fx) + F.col("_c.b")})
    weight = (1 - F.abs(fy - F.col("cy"))) * (1 - F.abs(fx - F.col("cx")))
    joined = near.withColumn("_w", weight).join(cutoffs, ["cy", "cx"])
    total = F.sum("_w")
    return joined.groupBy(*pixels.columns).agg(*(F.try_divide(F.sum(F.col(c) * F.col("_w")), total).alias(c) for c in ("tide_min", "tide_max")))


def composite(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Median, population deviation and number of the known values in each group; NULL, NULL, 0 where none is."""
    return df.groupBy(*keys).agg(
        F.median(value).alias(value), F.stddev_pop(value).alias("stdev"), F.count(value).cast("smallint").alias("count")
    )


def annual_composite(df: DataFrame, value: str, start: int, end: int, keys: Sequence[str] = PIXEL) -> DataFrame:
    """A composite for each pixel and year from ``start - 1`` to ``end``."""
    return composite(df.where(F.col("year").between(start - 1, end)), [*keys, "year"], value)


def pooled_composite(df: DataFrame, value: str, start: int, end: int, keys: Sequence[str] = PIXEL) -> DataFrame:
    """Composites over the observations of three years, the year before and the year after included.

    A median can't be had from medians, so the values themselves are pooled: gathered once by pixel and year, and those
    short lists, not the observations, go to the three years that they serve. Rows are dealt out by pixel first, so that
    both groupings are met by one shuffle.
    """
    pooled = _pooled_lists(df, value, start, end, keys)
    return pooled.select(*keys, "year", *(v.alias(k) for k, v in summary(F.col("_v"), value).items()))


def _pooled_lists(df: DataFrame, value: str, start: int, end: int, keys: Sequence[str]) -> DataFrame:
    """``_v``: the sorted values of three years for each pixel and year; ``_own``: those of the year itself, and ``_seen`` if it has rows."""
    rows = df.where(F.col("year").between(start - 1, end + 1)).select(*keys, "year", value)
    lists = rows.repartition(*keys).groupBy(*keys, "year").agg(F.array_sort(F.collect_list(value)).alias("_v"))
    label = F.explode(F.filter(F.sequence(F.col("year") - 1, F.col("year") + 1), lambda y: y.between(start, end))).alias("_label")
    own = F.col("_label") == F.col("year")
    return (
        lists.select(*keys, "year", "_v", label)
        .groupBy(*keys, "_label")
        .agg(F.array_sort(F.flatten(F.collect_list("_v"))).alias("_v"), F.max(F.when(own, F.col("_v"))).alias("_own"), F.bool_or(own).alias("_seen"))
        .withColumnRenamed("_label", "year")
    )


def summary(values: Column, name: str) -> dict[str, Column]:
    """Median, population deviation and number of a sorted array of known values."""
    n = F.size(values)
    low, high = F.get(values, F.floor((n - 1) / 2).cast("int")), F.get(values, F.floor(n / 2).cast("int"))

    def spread(v: Column) -> Column:
        mean = F.aggregate(v, F.lit(0.0), lambda a, x: a + x) / F.size(v)
        squares = let(F.struct(v.alias("v"), mean.alias("m")), lambda s: F.aggregate(s["v"], F.lit(0.0), lambda a, x: a + (x - s["m"]) * (x - s["m"])))
        return F.sqrt(squares / F.size(v))

    return {name: (low + high) / 2, "stdev": F.when(n > 0, let(values, spread)), "count": n.cast("smallint")}


def gapfilled_composite(df: DataFrame, value: str, start: int, end: int, keys: Sequence[str] = PIXEL) -> DataFrame:
    """``gapfill_select`` of the annual and the pooled composites, from the observations: one scan, one shuffle, no join."""
    lists = _pooled_lists(df, value, start, end, keys).where("_seen")
    n = F.size("_own")
    chosen = lists.withColumn("_v", F.when(n > 5, F.col("_own")).when(n > 1, F.col("_v")))
    return chosen.select(*keys, "year", *(F.when(F.col("_v").isNotNull(), v).alias(k) for k, v in summary(F.col("_v"), value).items()))


def gapfill_select(annual: DataFrame, pooled: DataFrame, value: str, keys: Sequence[str] = PIXEL) -> DataFrame:
    """All variables of the annual composite where it has more than 5 observations, else of the pooled one.

    Where the annual composite has at most one observation the result is NULL.
    """
    names = (value, "stdev", "count")
    other = pooled.select(*keys, "year", *(F.col(c).alias(f"_{c}") for c in names))
    joined = annual.join(other, [*keys, "year"], "left")
    own, known = F.col("count") > 5, F.col("count") > 1
    return joined.select(*keys, "year", *(F.when(known, F.when(own, F.col(c)).otherwise(F.col(f"_{c}"))).alias(c) for c in names))


def aligned(tables: Mapping[str, DataFrame], keys: Sequence[str] = (*PIXEL, "year")) -> DataFrame:
    """Tables side by side on their keys, with every cell that any has; a table's other columns get its name as a prefix."""
    named = [df.select(*keys, *(F.col(c).alias(f"{name}_{c}") for c in df.columns if c not in keys)) for name, df in tables.items()]
    return reduce(lambda a, b: a.join(b, list(keys), "full"), named)


def land(df: DataFrame, index: str, threshold: float = 0.0) -> DataFrame:
    """``land``: whether the index is below the threshold; unknown stays unknown."""
    return df.withColumn("land", F.col(index) < threshold)


def all_time_frequency(df: DataFrame, keys: Sequence[str] = PIXEL, low: float = 0.2, high: float = 0.8) -> DataFrame:
    """Whether a pixel was land in more than the given shares of the years that are known."""
    share = F.avg(F.col("land").cast("double"))
    return df.groupBy(*keys).agg((share > low).alias("land_20"), (share > high).alias("land_80"))


def temporal_neighbours(df: DataFrame, keys: Sequence[str] = PIXEL, flag: str = "land") -> DataFrame:
    """``beside``: the flag in the year before or after (in order of the years there are), False at the ends."""
    w = Window.partitionBy(*keys).orderBy("year")
    near = F.coalesce(F.lag(flag, 1, False).over(w), F.lit(False)) | F.coalesce(F.lead(flag, 1, False).over(w), F.lit(False))
    return df.withColumn("beside", near)


def certainty_class(count: Column, stdev: Column, least: int = 5, most: float = 0.3) -> Column:
    """2 with too few observations, else 1 if they spread too much, else 0."""
    return F.when(count < least, 2).when(stdev > most, 1).otherwise(0)


# Names of the classes of a shoreline's certainty.
CERTAINTY = {0: "good", 1: "unstable data", 2: "insufficient data"}
AEROSOL_YEARS, AEROSOL_LATITUDE = (1991, 1992), -23.0


def certainty_name(cls: Column, year: Column, latitude: Column) -> Column:
    """The name of a class; in the years after an eruption northern lines are "aerosol issues"."""
    named = F.create_map(*(F.lit(x) for kv in CERTAINTY.items() for x in kv))
    return F.when((latitude > AEROSOL_LATITUDE) & year.isin(*AEROSOL_YEARS), "aerosol issues").otherwise(named[cls])


def modal(df: DataFrame, column: str, order: str) -> DataFrame:
    """The most frequent value of a column, such as the projection of most scenes; of equal ones the first by ``order``."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"), F.min(order).alias("first"))
    return counts.orderBy(F.desc("n"), "first").limit(1).select(column)


def elevation(dem: DataFrame, value: str = "elevation") -> DataFrame:
    """Heights below 0 are no land."""
    return dem.withColumn(value, F.when(F.col(value) >= 0, F.col(value)))


def harmonic_tide(time: Column, constituents: Iterable[tuple[float, float, float]]) -> Column:
    """Height of the tide from constituents (amplitude in metres, degrees an hour, phase in degrees), hours since 1970."""
    hours = F.unix_micros(time.cast("timestamp")) / 3.6e9
    return reduce(lambda a, b: a + b, (h * F.cos(F.radians(speed * hours - phase)) for h, speed, phase in constituents))
