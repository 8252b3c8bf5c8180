"""Running composites over a stream of observations.

Exact medians need all values of a pixel and year, so the stream keeps counts, sums and squares, from which mean and
deviation follow, and an approximate median. A year is final once the watermark has passed its end.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def running_composite(stream: DataFrame, keys: Sequence[str], value: str, time: str = "time", delay: str = "30 days") -> DataFrame:
    """``count``, ``mean``, ``stdev`` and ``median_about`` of each key and window of 365 days."""
    timed = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)
    window = F.window(time, "365 days")
    return timed.groupBy(*keys, window).agg(
        F.count(value).alias("count"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("stdev"), F.percentile_approx(value, 0.5, 1000).alias("median_about")
    )


def append_metrics(stream: DataFrame, path: str, checkpoint: str):
    """Append a stream of run metrics to a folder of Parquet files; each row is written once."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
