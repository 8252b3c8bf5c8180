"""Summaries for annual snapshots, and the state of batch runs."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

# Limits of the classes of yearly change in metres, each closed on the right.
CHANGE_LIMITS = (-10.0, -5.0, 0.0, 5.0, 10.0)


def cut(value: Column, limits: Sequence[float], names: Sequence[str]) -> Column:
    """The name of the right-closed class of a value."""
    out = F.when(value <= limits[0], names[0])
    for limit, name in zip(limits[1:], names[1:-1], strict=True):
        out = out.when(value <= limit, name)
    return out.when(value > limits[-1], names[-1])


def without_outliers(df: DataFrame, dist: str = "dist", outliers: str = "outliers") -> DataFrame:
    """Values of outlier years become NULL."""
    bad = F.coalesce(F.array_contains(outliers, F.col("year").cast("int")), F.lit(False))
    return df.withColumn(dist, F.when(~bad, F.col(dist)))


def yearly_change(df: DataFrame, keys: Sequence[str], start: int, end: int, dist: str = "dist") -> DataFrame:
    """``change``: a year's value less that of the calendar year before; NULL where either is missing."""
    w = Window.partitionBy(*keys).orderBy("year")
    before = F.when(F.lag("year").over(w) == F.col("year") - 1, F.lag(dist).over(w))
    return df.where(F.col("year").between(start, end)).withColumn("change", F.col(dist) - before)


def class_shares(df: DataFrame, by: Sequence[str], cls: str) -> DataFrame:
    """Percentage of each class within its group."""
    counts = df.where(F.col(cls).isNotNull()).groupBy(*by, cls).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy(*by))
    return counts.withColumn("share", 100.0 * F.col("n") / total)


def share_change(shares: DataFrame, by: Sequence[str], cls: str, year: str = "year") -> DataFrame:
    """A class's share less its share in the calendar year before; NULL where there is none."""
    w = Window.partitionBy(*by, cls).orderBy(year)
    before = F.when(F.lag(year).over(w) == F.col(year) - 1, F.lag("share").over(w))
    return shares.withColumn("share_change", F.col("share") - before)


# What the codes of a failed run mean; a run without a code was deleted, 0 is no error.
ERROR_CODES = {"1": "error code 1", "137": "memory"}


def workflow_runs(spark: SparkSession, text: str) -> DataFrame:
    """``run_id, tile, duration, memory, finished, error`` of the nodes of a batch workflow's YAML, which is one small file.

    Nodes without inputs and those whose first input is no tile (a parameter of the workflow) are left out; durations are
    hours of the machine that the workflow asks for.
    """
    import yaml

    data = yaml.safe_load(text)
    asked = {p["name"]: p.get("value") for p in data["spec"]["arguments"]["parameters"]}
    rows = []
    for run, node in data["status"]["nodes"].items():
        first = next(iter(node.get("inputs", {}).get("parameters", ())), {}).get("value")
        if first is None or not str(first).isdigit():
            continue
        done, used = node.get("outputs"), node.get("resourcesDuration", {})
        code = None if done is None else str(done["exitCode"])
        error = "pod deleted" if code is None else None if code == "0" else ERROR_CODES.get(code, code)
        hours = float(used["cpu"]) / 60 / int(asked["cpu-limit"]) if "cpu" in used and done is not None else None
        rows.append((run, int(first), hours, used.get("memory"), str(node["finishedAt"]) if done is not None and "finishedAt" in node else None, error))
    out = spark.createDataFrame(rows, "run_id string, tile int, duration double, memory long, finished string, error string")
    return out.withColumn("finished", F.col("finished").try_cast("timestamp"))


def run_status(runs: DataFrame, key: str = "tile") -> DataFrame:
    """How each key ended: at once or after a retry, with success if any of its runs has no error."""
    good, once = F.count("*") > F.count("error"), F.count("*") == 1
    ended = F.when(good, "succeeded").otherwise("failed")
    return runs.groupBy(key).agg(F.when(once, ended).otherwise(F.concat(ended, F.lit(" after retry"))).alias("status"))


def longest_attempt(runs: DataFrame, key: str, duration: str) -> DataFrame:
    """Of each key the run that took longest (ties: the first by its id)."""
    w = Window.partitionBy(key).orderBy(F.desc_nulls_last(duration), "run_id")
    return runs.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


#: Frames that a slice of time holds besides the one before it.
FRAMES = 16


def rolling_median(df: DataFrame, keys: Sequence[str], time: str, value: str, minutes: int = 30, least: int = 10) -> DataFrame:
    """``rolling``: the median of the values in the window ``(time - minutes, time]``; NULL below ``least`` values.

    A key's rows are cut into slices of time, each with the frame before it, and a slice keeps its frame in order as it moves:
    the work of a row is that of finding its place, and a task holds one slice. Rows without a time are one frame.
    """
    frame = minutes * 60_000_000
    width, run = FRAMES * frame, _rolling(frame, least)
    at = F.coalesce(F.unix_micros(F.col(time).cast("timestamp")), F.lit(-(1 << 62)))
    rows = df.withColumns({"_t": at, "_v": F.col(value).cast("double")})
    first, last = (F.expr(f"({t} - pmod({t}, {width}L)) div {width}L") for t in ("_t", f"(_t + {frame - 1}L)"))
    dealt = rows.withColumn("_b", F.explode(F.sequence(first, last))).withColumn("_own", F.col("_b") == first)
    return dealt.groupBy(*keys, "_b").applyInArrow(run, StructType([*df.schema.fields, StructField("rolling", DoubleType())]))


def _rolling(frame: int, least: int):
    def run(table):
        from bisect import bisect_left, insort

        import numpy as np
        import pyarrow as pa

        t, known = table["_t"].to_numpy(), table["_v"].is_valid().to_numpy()
        v = table["_v"].to_numpy()
        order = np.argsort(t, kind="stable")
        # ranks stand for values: they differ, and NaN is the greatest
        which = np.flatnonzero(known)
        which = which[np.argsort(v[which], kind="stable")]
        values, rank = v[which].tolist(), np.full(len(v), -1)
        rank[which] = np.arange(len(which))
        times, ranks = t[order].tolist(), rank[order].tolist()
        got, now, low, i = np.full(len(v), np.nan), [], 0, 0
        enough = np.zeros(len(v), bool)
        while i < len(times):
            j = i
            while j < len(times) and times[j] == times[i]:
                if ranks[j] >= 0:
                    insort(now, ranks[j])
                j += 1
            while times[low] <= times[i] - frame:
                if ranks[low] >= 0:
                    del now[bisect_left(now, ranks[low])]
                low += 1
            n = len(now)
            if n and n >= least:
                got[order[i:j]], enough[order[i:j]] = (values[now[(n - 1) // 2]] + values[now[n // 2]]) / 2, True
            i = j
        out = table.select([c for c in table.column_names if c not in ("_t", "_v", "_b", "_own")])
        return out.append_column("rolling", pa.array(got, mask=~enough)).filter(table["_own"])

    return run


def duration_quantiles(df: DataFrame, by: Sequence[str], value: str, at: Sequence[float] = (0.1, 0.5, 0.9)) -> DataFrame:
    return df.groupBy(*by).agg(*(F.percentile(value, q).alias(f"q{round(1000 * q):03d}") for q in at))
