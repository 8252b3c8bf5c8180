"""Operators keep the type of ids, and strings are as good as numbers."""

import pytest

from strandline.llm import bpe, chat, decontaminate, language, quality, secrets, similar, simhash, token_counts, urls


@pytest.fixture(scope="module")
def docs(spark):
    rows = [("b", "one two three four five six"), ("a", "one two three four five six"), (None, None), ("c", "secret = 0123456789abcdef0123")]
    return spark.createDataFrame(rows, "doc_id string, text string")


def test_string_ids(spark, docs):
    bench = spark.createDataFrame([("q1", "three four five"), ("q2", "five six")], "item_id string, text string")
    found = {r.doc_id: list(r["items"]) for r in decontaminate.contamination(docs, bench).collect()}
    assert found == {"a": ["q1", "q2"], "b": ["q1", "q2"], "c": [], None: []}
    model = language.fit(spark.createDataFrame([("a", "der die das", "de")], "doc_id string, text string, lang string"))
    field = quality.Field(quality.np.zeros(quality.N_FEATURES), quality.np.zeros((2, 2)))
    for rows in (language.identified(docs, model), quality.judged(docs, field), secrets.scanned(docs), bpe.encoded(docs), token_counts.counted(docs)):
        assert rows.schema["doc_id"].dataType.simpleString() == "string" and {r.doc_id for r in rows.collect()} == {"a", "b", "c", None}
    for near in (simhash.near_duplicates(docs), similar.near_duplicates(docs)):
        assert {r.doc_id: r.component_id for r in near.collect()} == {"a": "a", "b": "a", "c": "c", None: None}
    assert sorted(r.doc_id or "" for r in similar.deduplicated(docs).collect()) == ["", "a", "c"]


def test_string_conversations(spark):
    rows = [("x", "1", "user", "hi"), ("x", "2", "assistant", "yo"), (None, "1", None, None)]
    got = chat.read_back(chat.formatted(spark.createDataFrame(rows, "conv_id string, turn string, role string, text string"))).collect()
    assert {r.conv_id: (r.n_turns, r.loss_chars) for r in got} == {"x": (2, 2), None: (1, 0)}


def test_strength_is_of_the_spread_within_parents(spark):
    # suffixes differ, domains within a suffix don't: nothing speaks for spread below the suffix
    rows = [("a", 100, 10), ("a", 100, 10), ("b", 100, 90), ("b", 100, 90)]
    groups = spark.createDataFrame(rows, "suffix string, n long, bad long")
    assert urls._strength(groups, "suffix") == urls.MOST_STRENGTH and urls._strength(groups) < 5
    rows = [("a", 40, 4), ("a", 60, 30), ("a", 10, 0), ("b", 50, 45), ("b", 20, 6), ("c", 5, 1)]
    between = room = 0.0
    for name in "abc":
        own = [(n, x) for p, n, x in rows if p == name]
        n = sum(k for k, _ in own)
        m = sum(x for _, x in own) / n
        between += sum(k * (x / k - m) ** 2 for k, x in own) - (len(own) - 1) * m * (1 - m)
        room += m * (1 - m) * (n - sum(k * k for k, _ in own) / n)
    want = min(urls.MOST_STRENGTH, max(urls.LEAST_STRENGTH, room / between - 1))
    assert urls._strength(spark.createDataFrame(rows, "suffix string, n long, bad long"), "suffix") == pytest.approx(want)


def test_addresses_are_their_own_domain(spark):
    hosts = ["10.0.0.1", "10.0.0.1:8080", "a.b.co.uk", "www.example.com:80", "localhost", "[::1]:80", ""]
    got = spark.createDataFrame([(h,) for h in hosts], "host string").select(urls.domain_of(urls.F.col("host")).alias("d"), urls.suffix_of(urls.F.col("host")).alias("s")).collect()
    assert [tuple(r) for r in got] == [
        ("10.0.0.1", "10.0.0.1"), ("10.0.0.1", "10.0.0.1"), ("b.co.uk", "co.uk"), ("example.com", "com"), ("localhost", "localhost"), ("[::1]", "[::1]"), ("", ""),
    ]


def test_decontamination_by_parts_equals_one_automaton(spark, sf):
    docs, bench = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    assert len(decontaminate.parts_of(bench, 20_000)) > 2
    one, many = (sorted(map(str, decontaminate.contamination(docs, bench, n).collect())) for n in (decontaminate.MAX_NODES, 20_000))
    assert one == many
    one, many = (sorted(map(str, decontaminate.decontaminated(docs, bench, max_nodes=n).select("doc_id", "text", "n_chars").collect())) for n in (decontaminate.MAX_NODES, 20_000))
    # items are dealt whole, so each part tells whether one of its items is there whole
    assert one == many
