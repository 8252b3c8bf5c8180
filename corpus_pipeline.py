"""The corpus pipeline: quality rules, near-duplicates, decontamination, secrets, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet and reads it again as the
next stage's documents. All but the last return the columns of documents.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm import bpe, decontaminate, quality, secrets, similar
from strandline.storage import discard, durable, mark, sweep


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule, or whose lines are mostly boilerplate, go."""
    field = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.kept_rows(docs, field)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (operator 2 on five-word shingles, similarity 0.8 or more) the document with the smallest id stays."""
    return similar.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a whole benchmark item, or passages of several, go; a lesser passage is cut out."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced; every document stays."""
    return secrets.redacted(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` of each document."""
    return bpe.encoded(docs).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("bpe_tokens", tokens),
]
#: Hashes of shingles and merges of ranks have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES:
        start = mark()
        docs = durable(stage(spark, docs, sf_dir), name)
        sweep(spark, start, docs)
        if before is not None:
            discard(spark, before)
        before = docs.durable_path
    return docs
