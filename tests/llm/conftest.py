import os

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("the driver's tables are not here")
    return SF


@pytest.fixture(scope="session")
def texts(spark, sf):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and blank texts, repeated rows, null ids, long texts and columns with clashing names."""
    long = " ".join(f"word{i % 977} né" for i in range(30_000))
    rows = [
        (1, None, "x", 1, 5.0), (2, "", "x", 1, None), (3, " \n\t ", None, 0, 1.0), (4, "a", "x", 1, 1.0), (4, "a", "x", 1, 1.0),
        (None, "one two three four", "x", 1, 1.0), (5, "one two three four", "x", 1, 1.0), (6, long, "x", 1, 1.0), (6, long, "x", 1, 1.0),
        (7, "日本語のテキスト。" * 9000, "x", 1, 1.0), (8, "x" * 40_000, "x", 1, 1.0), (9, "12345 ....  \r\n\x0b\x0c é\u00a0\u2003 <|endoftext|> <s>", "x", 1, 1.0),
    ]
    return spark.createDataFrame([(*r, "clash", 3) for r in rows], "doc_id long, text string, lang string, n_words int, score double, _clean string, _Cleaned int")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
