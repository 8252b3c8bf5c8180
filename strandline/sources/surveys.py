"""Readers of survey files: delimited text with odd headers, and metadata in headers and file names."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, ord, line``: the lines of text files with their number in the file (from 0). A file is read whole."""
    text = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.col("value"))
    return text.select("file", F.posexplode(F.split(F.regexp_replace("value", r"\r?\n$", ""), r"\r?\n")).alias("ord", "line"))


def table_of(rows: DataFrame, names: list[str], skip: int = 0, separator: str = r"\s+", comment: str = "#") -> DataFrame:
    """Lines split to named string columns; the first ``skip`` lines, comments and blank lines go."""
    text = F.trim("line")
    part = F.split(text, separator)
    good = rows.where((F.col("ord") >= skip) & (text != "") & ~text.startswith(comment))
    return good.select("file", "ord", *(F.trim(F.get(part, F.lit(i))).alias(n) for i, n in enumerate(names)))


# Header fields of survey files.
HEADER_FIELDS = {
    "longitude": "LONGITUDE", "latitude": "LATITUDE", "date": "START DATE/TIME", "bearing": "TRUE BEARING TRANSECT DEGREES", "method": "SURVEY METHOD",
}


def header_metadata(rows: DataFrame, fields: dict[str, str] | None = None, first: int = 19) -> DataFrame:
    """``file`` and a column for each field, from ``name: value`` or ``name,value`` in the first lines marked as comments."""
    head = rows.where((F.col("ord") < first) & F.col("line").rlike(r"^[#& ]")).withColumn("_h", F.regexp_replace("line", r"^[#& ]+", ""))

    def value(label: str) -> Column:
        found = F.regexp_extract("_h", rf"(?i)^{label}[^:=,]*[:=,]\s*(.*?)\s*$", 1)
        return F.min_by(F.when(found != "", found), F.when(found != "", F.col("ord")))

    return head.groupBy("file").agg(*(value(v).alias(k) for k, v in (fields or HEADER_FIELDS).items()))


def from_file_name(column: Column, pattern: str, groups: list[str]) -> list[Column]:
    """Parts of a file name as columns; NULL where the pattern doesn't match."""
    return [F.nullif(F.regexp_extract(column, pattern, i + 1), F.lit("")).alias(g) for i, g in enumerate(groups)]


def parsed_date(column: Column, *formats: str) -> Column:
    """The first format that fits gives the date; NULL if none does."""
    return F.coalesce(*(F.try_to_timestamp(column, F.lit(f)) for f in formats))


def numbers(column: Column) -> Column:
    """All decimals in a text."""
    return F.transform(F.regexp_extract_all(column, F.lit(r"(-?\d+\.\d+)"), 1), lambda v: v.cast("double"))


def known(value: Column, nodata: float = -9999.0) -> Column:
    """A number, NULL where it is the nodata value or no number."""
    v = value.try_cast("double")
    return F.when(v != nodata, v)


def with_order(df: DataFrame, keys: list[str], by: str) -> DataFrame:
    """The source's order within each key as ``ord``, where a table has only something to sort by."""
    return df.withColumn("ord", F.row_number().over(Window.partitionBy(*keys).orderBy(by)))
