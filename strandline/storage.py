"""Durable intermediate tables: they cut lineage and survive the loss of executors."""

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIR: list[str] = []
_WRITTEN: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's ``spark.checkpoint.dir``.

    Without that setting a local master gets a temporary folder, which goes when the program ends; any other master
    is an error, as no folder is known to be shared.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set spark.checkpoint.dir to a folder that the driver and the executors of {master} share")
    if not _LOCAL_DIR:
        _LOCAL_DIR.append(tempfile.mkdtemp(prefix="strandline-"))
        atexit.register(shutil.rmtree, _LOCAL_DIR[0], ignore_errors=True)
    return _LOCAL_DIR[0]


def durable(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/strandline-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _WRITTEN.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.durable_path = path
    return out


def mark() -> int:
    """A point in the sequence of durable tables, for ``sweep``."""
    return len(_WRITTEN)


def sweep(spark: SparkSession, since: int, *keep: DataFrame) -> None:
    """Delete the durable tables written after ``since``, but those of ``keep``.

    Call it when everything that reads them has been written itself: nothing is then computed from them again, even if
    executors are lost.
    """
    kept = {k.durable_path for k in keep}
    discard(spark, *(p for p in _WRITTEN[since:] if p not in kept))


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete durable tables."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
        if path in _WRITTEN:
            _WRITTEN.remove(path)
