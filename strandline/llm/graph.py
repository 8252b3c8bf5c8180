"""Connected components of a link table by alternating stars.

Each round is two grouped minima and two joins; the number of rounds is logarithmic in practice. Rows of a busy node
are only ever pre-aggregated or split by the adaptive skew join, never gathered. State is cut by durable tables, whose
predecessors go as soon as they are written.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.storage import discard, durable


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one link to a smaller one, which has none itself."""
    centres = edges.select(F.col("v").alias("u")).distinct().withColumn("centre", F.lit(True))
    many = edges.groupBy("u").agg(F.count("*").alias("n")).join(centres, "u", "left").where("n > 1 or centre")
    return not many.limit(1).count()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node, root`` for every node with a link to another; the root is the smallest node of its component.

    ``edges`` has long columns ``u`` and ``v``; loops, repeats and either direction are allowed.
    """
    spark = edges.sparkSession
    now = durable(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    for _ in range(rounds):
        if _stars(now):
            break
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = durable(large, "large-star")
        discard(spark, now.durable_path)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = durable(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        discard(spark, large.durable_path)
    else:
        if not _stars(now):
            raise RuntimeError(f"components did not settle within {rounds} rounds")
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
