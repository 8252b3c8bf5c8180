"""Accuracy of shorelines against surveys, and trends of runs."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.storage import durable


def accuracy(df: DataFrame, survey: str, product: str, by: Sequence[str] = (), weight: str | None = None, remove_bias: bool = False) -> DataFrame:
    """``n, mae, rmse, stdev, corr, bias`` of the differences survey less product, in one pass, or two with ``remove_bias``.

    Rounded to 2 places, the correlation to 3. ``n`` is the sum of ``weight`` if given. Deviation and correlation
    are NULL below two rows. ``remove_bias`` takes each group's bias from the differences first; ``bias`` is always
    that of the differences as they were.
    """
    rows = df.where(F.col(survey).isNotNull() & F.col(product).isNotNull())
    rows = rows.withColumns({c: F.col(survey) - F.col(product) for c in ("_raw", "_d")})
    if remove_bias:
        if by:
            # a written table of few rows is broadcast, by its size; a window would hold all rows of a group in one task
            mean = durable(rows.groupBy(*(F.col(c).alias(f"_by_{c}") for c in by)).agg(F.avg("_raw").alias("_m")), "bias")
            same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by))
            rows = rows.join(mean, same).withColumn("_d", F.col("_raw") - F.col("_m"))
        else:  # one row of statistics, rather than all rows in one window
            mean = rows.agg(F.avg("_d").alias("_m"))
            rows = rows.join(F.broadcast(mean)).withColumn("_d", F.col("_d") - F.col("_m"))

    def shown(c: Column, digits: int = 2) -> Column:
        return F.bround(c, digits) + F.lit(0.0)

    two = F.count("*") > 1
    return rows.groupBy(*by).agg(
        (F.count("*") if weight is None else F.sum(weight)).cast("long").alias("n"),
        shown(F.avg(F.abs("_d"))).alias("mae"),
        shown(F.sqrt(F.avg(F.col("_d") * F.col("_d")))).alias("rmse"),
        F.when(two, shown(F.stddev_samp("_d"))).alias("stdev"),
        F.when(two, shown(F.corr(survey, product), 3)).alias("corr"),
        shown(F.avg("_raw")).alias("bias"),
    )


def accuracy_table(plain: DataFrame, corrected: DataFrame, by: str) -> DataFrame:
    """Figures with those after bias correction in brackets, best first (``rank``)."""
    other = corrected.select(by, *(F.col(c).alias(f"{c}_bc") for c in ("mae", "rmse", "stdev")))

    def pair(c):
        return F.concat(F.format_string("%.2f", c), F.lit(" ("), F.format_string("%.2f", f"{c}_bc"), F.lit(")"))

    joined = plain.join(other, by)
    # groups are few
    order = F.row_number().over(Window.orderBy("mae", by))
    return joined.select(
        by, "n", "bias", *(pair(c).alias(c) for c in ("mae", "rmse", "stdev")), "corr", order.cast("long").alias("rank")
    )


def run_trend(log: DataFrame, order: str, values: Sequence[str], last: bool = False) -> DataFrame:
    """Each run's figures less those of the run before; ``last`` keeps the latest run alone."""
    w = Window.orderBy(order)
    out = log.withColumns({f"{v}_diff": F.col(v) - F.lag(v).over(w) for v in values})
    return out.orderBy(F.desc(order)).limit(1) if last else out


def validated(surveys: DataFrame, met: DataFrame, id_col: str = "id") -> DataFrame:
    """Survey years with the shoreline that their transect meets: distances along the transect and their difference.

    ``surveys`` has one row for each id and year (``start_x … end_y, val_dist, n``); ``met`` the single meeting points.
    """
    both = surveys.join(met, [id_col, "year"])
    d = F.hypot(F.col("qx") - F.col("start_x"), F.col("qy") - F.col("start_y"))
    out = both.withColumn("product_dist", d).withColumn("error_m", F.col("val_dist") - F.col("product_dist"))
    return out.where(F.col("foredune_dist").isNull() | (F.col("product_dist") >= F.col("foredune_dist"))) if "foredune_dist" in out.columns else out


def by_year(intercepts: DataFrame, id_col: str = "id", value: str = "0_dist", modes: Sequence[str] = ()) -> DataFrame:
    """Yearly medians of intercepts, with their number and the most frequent attributes."""
    return intercepts.groupBy(id_col, F.year("date").alias("year")).agg(
        F.count(value).alias("n"), F.median(value).alias("val_dist"), *(F.mode(m, True).alias(m) for m in modes)
    )


def evaluation_layers(result: DataFrame) -> dict[str, DataFrame]:
    """Three layers to look at, in degrees: surveyed points, the product's points, and the transects as lines.

    ``result`` has the columns of ``validated``; a surveyed point lies at its distance along the transect.
    """
    from strandline.functions import geodesy, geometry
    from strandline.sinks import geometry_json

    def place(x: Column, y: Column) -> Column:
        return geodesy.albers_inverse(x, y)

    ends = ("start_x", "start_y", "end_x", "end_y")
    facts = [c for c in result.columns if c not in (*ends, "qx", "qy", "_d")]
    at = geometry.along(F.col("val_dist"), *(F.col(c) for c in ends))
    surveyed = result.withColumn("_a", at).withColumn("_d", place(F.col("_a.x"), F.col("_a.y")))
    product = result.withColumn("_d", place(F.col("qx"), F.col("qy")))
    out = {k: df.select(*facts, geometry_json("Point", F.col("_d.lon"), F.col("_d.lat")).alias("geometry")) for k, df in (("survey", surveyed), ("product", product))}
    lines = result.groupBy("id").agg(*(F.min(c).alias(c) for c in ends))
    pair = [place(F.col(f"{e}_x"), F.col(f"{e}_y")) for e in ("start", "end")]
    lines = lines.withColumn("_l", F.array(*(F.struct(d["lon"].alias("x"), d["lat"].alias("y")) for d in pair)))
    return out | {"transects": lines.select("id", geometry_json("LineString", points=F.col("_l")).alias("geometry"))}


def markdown_report(stats: dict, before: dict | None = None) -> str:
    """The figures of a run, and how they differ from those of the run before, as a table."""
    names = {"rmse": "RMSE", "mae": "MAE", "bias": "Bias", "corr": "Correlation", "stdev": "Standard deviation", "n": "Observations"}
    lines = ["| Figure | Value | Change |", "| --- | --- | --- |"]
    for k, name in names.items():
        change = "" if not before or before.get(k) is None or stats.get(k) is None else f"{float(stats[k]) - float(before[k]):+.3f}"
        lines.append(f"| {name} | {stats.get(k)} | {change} |")
    return "\n".join(lines) + "\n"
