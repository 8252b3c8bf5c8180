"""Survey adapters: the raw tables of each programme to profiles, and these to intercepts.

An adapter names columns, builds ids ``beach_section_profile``, drops what its programme marks as bad, puts places on the Albers
plane, and hands over to ``finished``. Workbooks are expected as tables already.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions import geodesy, geometry
from strandline.functions.names import standard_method
from strandline.functions.numbers import let
from strandline.operators import spatial, surveys
from strandline.sources.surveys import known, numbers, parsed_date

ENDS = ("start_x", "start_y", "end_x", "end_y")
FACTS = ("beach", "section", "profile", "name", "source")


def identified(df: DataFrame, beach: Column, section: Column, profile: Column, name: str, source: Column) -> DataFrame:
    out = df.withColumns({"beach": beach, "section": section, "profile": profile.cast("string"), "name": F.lit(name), "source": source})
    return out.withColumn("id", F.concat_ws("_", "beach", "section", "profile"))


def moved(df: DataFrame, zone: int | Column | None, *pairs: tuple[str, str]) -> DataFrame:
    """Pairs of columns from a UTM zone, or degrees where it is None, to the Albers plane. A zone can be a column."""

    def place(x, y):
        return geodesy.albers(F.col(x), F.col(y)) if zone is None else geodesy.utm_to_albers(F.col(x), F.col(y), zone)

    for x, y in pairs:
        df = df.withColumn("_p", place(x, y)).withColumns({x: F.col("_p.x"), y: F.col("_p.y")}).drop("_p")
    return df


def along_transect(df: DataFrame) -> DataFrame:
    """Places of rows that have only a distance."""
    p = geometry.along(F.col("distance"), *(F.col(c) for c in ENDS))
    return df.withColumn("_p", p).withColumns({"x": F.col("_p.x"), "y": F.col("_p.y")}).drop("_p")


def from_start(df: DataFrame) -> DataFrame:
    return df.withColumn("distance", F.hypot(F.col("x") - F.col("start_x"), F.col("y") - F.col("start_y")))


def with_ends(df: DataFrame) -> DataFrame:
    return df.drop(*ENDS).join(surveys.endpoints(df), "id")


def finished(df: DataFrame, modes: bool = True, slope: bool = True, datum: float = 0.0, extra: Sequence[str] = ()) -> DataFrame:
    """Intercepts of profiles: waterline, slope, and attributes by mode or by the first row."""
    names = [*FACTS, *ENDS, *extra]
    out = surveys.intercept_table(df, first=() if modes else names, modes=names if modes else (), datum=datum)
    last = [f"{datum:g}_{c}" for c in ("dist", "x", "y")]
    return out.select("id", "date", *FACTS, *extra, *(["slope"] if slope else []), *ENDS, *last)


def contours(lines: DataFrame, transects: DataFrame, name: str, source: str, kind: Column | None = None) -> DataFrame:
    """Surveyed shorelines (``year, line, ord, x, y``) met by transects (``beach, profile, sx, sy, ex, ey``); no slope.

    Serves aerial programmes: of their lines those of the right kind and after 1987; only single meeting points count.
    """
    rows = lines.where(F.col("year") > 1987)
    rows = rows if kind is None else rows.where(kind)
    met = spatial.line_crossings(transects.select("beach", "profile", "sx", "sy", "ex", "ey"), spatial.segments(rows, ["year", "line"]), ["beach", "profile", "sx", "sy", "ex", "ey"], ["year"])
    out = identified(met, F.col("beach"), F.lit("all"), F.col("profile"), name, F.lit(source))
    ends = dict(zip(ENDS, ("sx", "sy", "ex", "ey"), strict=True))
    out = out.withColumns({**{k: F.col(v) for k, v in ends.items()}, "date": F.make_date("year", F.lit(1), F.lit(1)), "slope": F.lit(None).cast("double")})
    dist = F.hypot(F.col("qx") - F.col("sx"), F.col("qy") - F.col("sy"))
    return out.select("id", "date", *FACTS, "slope", *ENDS, dist.alias("0_dist"), F.col("qx").alias("0_x"), F.col("qy").alias("0_y"))


def wadot(lines: DataFrame, transects: DataFrame) -> DataFrame:
    return contours(lines, transects, "wadot", "aerial photogrammetry", F.trim("TYPE") == "AHD 0m")


def dasilva2021(lines: DataFrame, transects: DataFrame) -> DataFrame:
    return contours(lines, transects, "dasilva2021", "aerial photogrammetry")


def stirling(blocks: DataFrame, ends: DataFrame, suffixes: Sequence[str], datum: float = 0.0) -> DataFrame:
    """Wide blocks of date, x, y, z for each profile, on a local grid whose axes are swapped; no slope."""
    long = surveys.blocks_to_long(blocks, ["profile", "ord"], ["date", "x", "y", "z"], suffixes)
    rows = long.join(ends, "profile").withColumn("date", parsed_date(F.col("date").cast("string"), "dd/MM/yyyy", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd"))

    def place(x, y):
        p = geodesy.transverse_mercator_inverse(F.col(y), F.col(x), 115.8166666666667, 0.9999990600000001, 50000.0, 3800000.0)
        return let(p, lambda q: geodesy.albers(q["lon"], q["lat"]))

    for x, y in (("x", "y"), ("start_x", "start_y")):
        rows = rows.withColumn("_p", place(x, y)).withColumns({x: F.col("_p.x"), y: F.col("_p.y")}).drop("_p")
    rows = identified(rows.dropna(), F.lit("stirling"), F.lit("all"), F.col("profile"), "stirling", F.lit("gps"))
    far = from_start(rows)
    end = far.groupBy("id").agg(F.max(F.struct(F.col("distance"), -F.col("ord"), F.col("x"), F.col("y"))).alias("_e"))
    far = far.join(end.select("id", F.col("_e.x").alias("end_x"), F.col("_e.y").alias("end_y")), "id")
    return finished(far, modes=False, slope=False, datum=datum)


# UTM zones of the beaches of a survey.
VIC_ZONES = {"apo": 54, "cow": 55, "inv": 55, "leo": 55, "mar": 54, "pfa": 54, "por": 55, "prd": 55, "sea": 55, "wbl": 54}


def vicdeakin(raw: DataFrame, datum: float = 0.0) -> DataFrame:
    """Drone surveys: coordinates in a text, zones by beach, chainage from the sea."""
    rows = raw.dropna().where((F.year("survey_date") < 2020) & ~((F.col("location") == "leo") & (F.col("tr_id") == 94)))
    xy = numbers(F.col("coordinates"))
    rows = rows.withColumns({"x": F.get(xy, F.lit(0)).cast("float").cast("double"), "y": F.get(xy, F.lit(1)).cast("float").cast("double"), "z": F.col("z_clean"), "date": F.col("survey_date")})
    zone = F.create_map(*(F.lit(v) for kv in VIC_ZONES.items() for v in kv))[F.col("location")]
    rows = moved(rows, zone, ("x", "y"))
    rows = identified(rows, F.col("location"), F.lit("all"), F.col("tr_id"), "vicdeakin", F.lit("drone photogrammetry"))
    return finished(with_ends(surveys.reversed_chainage(rows)), modes=False, datum=datum)


def nswbpd(raw: DataFrame, datum: float = 0.0) -> DataFrame:
    """Columns beach, block, profile, date, distance, z, x, y, source; straight profiles from the foredune on."""
    when = parsed_date(F.col("date"), "dd/MM/yyyy", "d/M/yyyy", "yyyy")
    rows = raw.withColumn("date", when).where(surveys.in_years(F.col("date")))
    rows = identified(rows, F.replace(F.lower("beach"), F.lit(" "), F.lit("")), F.lower("block"), F.lower("profile"), "nswbpd", standard_method(F.col("source")))
    rows = with_ends(moved(rows, 56, ("x", "y")))
    rows = surveys.foredune_filter(surveys.straight_only(rows))
    return finished(rows, datum=datum, extra=["foredune_dist"])


# Starts and bearings of five transects.
NARRABEEN = (
    ("PF1", "-33°42'20.65", "151°18'16.30", 118.42),
    ("PF2", "-33°42'33.45", "151°18'10.33", 113.36),
    ("PF4", "-33°43'01.55", "151°17'58.84", 100.26),
    ("PF6", "-33°43'29.81", "151°17'58.65", 83.65),
    ("PF8", "-33°43'55.94", "151°18'06.47", 60.48),
)
RAY_DEGREES = 0.002


def narrabeen(raw: DataFrame, datum: float = 0.0) -> DataFrame:
    """Columns profile, date, distance, z, source; starts are given in degrees, minutes, seconds."""
    rays = raw.sparkSession.createDataFrame(NARRABEEN, "profile string, lat string, lon string, bearing double")
    x, y = geodesy.dms_to_degrees(F.col("lon")), geodesy.dms_to_degrees(F.col("lat"))
    rays = rays.select(F.lower("profile").alias("profile"), x.alias("start_x"), y.alias("start_y"), "bearing")
    rows = raw.where(F.year("date") > 1987).withColumn("profile", F.lower("profile")).join(F.broadcast(degree_rays(rays)), "profile")
    rows = along_transect(rows)
    return finished(identified(rows, F.lit("narrabeen"), F.lit("all"), F.col("profile"), "wrl", standard_method(F.col("source"))), datum=datum)


def degree_rays(df: DataFrame) -> DataFrame:
    """Short rays from ``start_x, start_y`` in degrees along ``bearing``, put on the plane."""
    e = geometry.ray_end(F.col("start_x"), F.col("start_y"), F.lit(RAY_DEGREES), F.col("bearing"))
    out = df.withColumn("_e", e).withColumns({"end_x": F.col("_e.x"), "end_y": F.col("_e.y")}).drop("_e", "bearing")
    return moved(out, None, ("start_x", "start_y"), ("end_x", "end_y"))


def first_and_last(df: DataFrame) -> DataFrame:
    """Ends of profiles from their first and last rows."""
    a, b = (f(F.struct("date", "ord", "x", "y")) for f in (F.min, F.max))
    ends = df.groupBy("id").agg(a.alias("a"), b.alias("b"))
    return df.join(ends.select("id", *(F.col(f"{e}.{c}").alias(f"{n}_{c}") for e, n in (("a", "start"), ("b", "end")) for c in "xy")), "id")


def cgc(raw: DataFrame, datum: float = 0.0) -> DataFrame:
    """Columns file, ord, x, y, z; all else is in the name: ``SITE - section profile - (… yyyy-mm-dd).txt``."""
    head, tail = F.split_part("file", F.lit(" - ("), F.lit(1)), F.split_part("file", F.lit(" - ("), F.lit(2))
    words = F.split(F.split_part(head, F.lit(" - "), F.lit(2)), " ")
    first, rest = F.lower(F.get(words, F.lit(0))), F.lower(F.array_join(F.slice(words, 2, 99), ""))
    none, alone = (first == "") & (rest == ""), rest == ""
    beach = F.lower(F.replace(F.replace(F.split_part(head, F.lit(" - "), F.lit(1)), F.lit("NO*TH"), F.lit("NORTH")), F.lit(" "), F.lit("")))
    section = F.when(alone, "na").otherwise(first)
    profile = F.when(none, "na").when(alone, first).otherwise(rest)
    rows = identified(raw, beach, section, profile, "cgc", F.lit("hydrographic survey"))
    rows = rows.withColumn("date", parsed_date(F.regexp_extract(tail, r"(\d{4}-?\d{2}-?\d{2})", 1), "yyyy-MM-dd", "yyyyMMdd"))
    rows = surveys.straddling(rows.where(surveys.in_years(F.col("date")) & (F.col("z") > -3.0)), datum=datum)
    rows = surveys.straight_only(from_start(first_and_last(moved(rows, 56, ("x", "y")))))
    return finished(surveys.foredune_filter(rows), modes=False, datum=datum, extra=["foredune_dist"])


def sadew(raw: DataFrame, zone_54: Sequence[int], datum: float = 0.0) -> DataFrame:
    """Columns profile, ord, x, y and one for each survey day (``mDDMMYYYY``); -9999 is no height."""
    days = [c for c in raw.columns if c not in ("profile", "ord", "x", "y", "sample_no")]
    zone = F.when(F.col("profile").isin(*zone_54), 54).otherwise(53)
    wide = moved(raw, zone, ("x", "y")).withColumn("date", F.lit(None).cast("timestamp"))
    wide = identified(wide, F.lit("sadew"), F.lit("all"), F.col("profile"), "sadew", F.lit("hydrographic survey"))
    wide = first_and_last(wide).drop("date").withColumns({d: known(F.col(d).cast("string")) for d in days})
    long = surveys.wide_to_long(wide, ["id", *FACTS, *ENDS, "ord", "x", "y"], days, "day", "z")
    long = long.withColumn("date", parsed_date(F.trim(F.substring("day", 2, 99)), "ddMMyyyy"))
    long = long.where((F.year("date") > 1987) & (F.year("date") < 2020))
    return finished(from_start(long), modes=False, datum=datum)


def sunshinecoast(raw: DataFrame, datum: float = 0.0) -> DataFrame:
    """Columns beach, profile, ord, date, distance, z, start_x, start_y, bearing; long rays, some bearings overridden."""
    bearing = F.when(F.col("profile").contains("KB"), 125.7).otherwise(F.col("bearing"))
    e = geometry.ray_end(F.col("start_x"), F.col("start_y"), F.lit(8000.0), bearing)
    rows = raw.withColumn("_e", e).withColumns({"end_x": F.col("_e.x"), "end_y": F.col("_e.y")}).drop("_e", "bearing")
    rows = identified(rows.where(F.year("date") > 1987), F.lower(F.replace("beach", F.lit(" "), F.lit(""))), F.lit("na"), F.col("profile"), "sunshinecoast", F.lit("hydrographic survey"))
    rows = along_transect(surveys.straddling(rows, datum=datum))
    rows = from_start(moved(rows, 56, ("start_x", "start_y"), ("end_x", "end_y"), ("x", "y")))
    return finished(rows, datum=datum)


# Files with a wrong start.
TASMARC_INVALID = ("shelly_beach_north",)


def tasmarc(rows: DataFrame, meta: DataFrame, datum: float = 0.0) -> DataFrame:
    """``rows``: file, site, ord, distance, z, flag as text; ``meta``: the files' headers."""
    good = rows.where((F.col("flag").try_cast("int") == 2) & ~F.col("file").rlike("|".join(TASMARC_INVALID)))
    facts = meta.select("file", F.col("longitude").cast("double").alias("start_x"), F.col("latitude").cast("double").alias("start_y"), F.col("bearing").cast("double").alias("bearing"), F.col("method"), parsed_date(F.substring("date", 1, 10), "yyyy-MM-dd").alias("date"))
    joined = good.join(degree_rays(facts), "file").where(surveys.in_years(F.col("date")))
    joined = joined.withColumns({c: F.col(c).try_cast("double") for c in ("distance", "z")})
    part = F.replace(F.regexp_extract(F.replace("file", F.col("site"), F.lit("")), r"^_?(.*?)_?\d[\d-]*\.\w+$", 1), F.lit("_"), F.lit(""))
    profile = F.when(part == "", "middle").otherwise(part)
    joined = identified(joined, F.replace("site", F.lit("_"), F.lit("")), F.lit("all"), profile, "tasmarc", standard_method(F.col("method")))
    return finished(along_transect(surveys.straddling(joined, datum=datum)), datum=datum)


# A transect whose results are left out.
MORUYA_INVALID = "pedro_all_4"


def moruya(raw: DataFrame, datum: float = 0.0) -> DataFrame:
    """Columns beach, section, profile, date, start_x, start_y, mid_x, mid_y, then one for each distance (``dist_N``) in cm."""
    ids = ["beach", "section", "profile", "date", "start_x", "start_y", "mid_x", "mid_y"]
    long = surveys.wide_to_long(raw, ids, [c for c in raw.columns if c not in ids], "d", "cm")
    rows = long.withColumns({"z": F.col("cm") * 0.01, "distance": F.substring("d", 6, 99).cast("double"), "date": parsed_date(F.col("date"), "dd/MM/yyyy")})
    turn = geometry.azimuth(*(F.col(c) for c in ("start_x", "start_y", "mid_x", "mid_y")))
    e = geometry.ray_end(F.col("start_x"), F.col("start_y"), F.lit(1000.0), turn)
    rows = rows.withColumn("_e", e).withColumns({"end_x": F.col("_e.x"), "end_y": F.col("_e.y"), "ord": F.col("distance").cast("int")}).drop("_e")
    rows = identified(moved(rows, 56, ("start_x", "start_y"), ("end_x", "end_y")), F.col("beach"), F.col("section"), F.col("profile"), "moruya", F.lit("emery/levelling"))
    return finished(along_transect(rows).where(F.col("id") != MORUYA_INVALID), datum=datum)
