from pyspark.sql import functions as F

from strandline.llm import text


def test_results_stay_with_their_rows(spark):
    """A batch of several slices: results come slice by slice, and each belongs to its row."""
    rows = spark.range(600, numPartitions=1).select("id", F.when(F.col("id") % 7 != 0, F.repeat(F.concat("id", F.lit(" é ")), 3000)).alias("text"))
    found = rows.withColumn("n", text.text_column(F.col("text"), lambda: lambda t: None if t is None else len(t), "long"))
    wrong = found.where(~F.col("n").eqNullSafe(F.length("text").cast("long"))).count()
    assert found.count() == 600 and wrong == 0
    kept = found.where("n > 15000")
    assert kept.count() == rows.where(F.length("text") > 15000).count()
    assert found.limit(0).count() == 0
    mapped = text.map_batches(rows.select("id", "text"), lambda: lambda b: [b.column(0), [None if t is None else len(t) for t in b.column(1).to_pylist()]], "id long, n long")
    assert {r.id: r.n for r in mapped.collect()} == {r.id: r.n for r in found.select("id", "n").collect()}


def test_workers_keep_the_latest_of_each_kind():
    made = []

    def make(x):
        return lambda: made.append(x) or x

    assert [text.held("t", "a", make(1)), text.held("t", "a", make(2)), text.held("t", "b", make(3)), text.held("t", "a", make(4))] == [1, 1, 3, 4] and made == [1, 3, 4]
