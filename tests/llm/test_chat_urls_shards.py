import hashlib
import os
import random
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from strandline.llm import chat, registry, sharding, urls


def compare(spark, sf, name):
    con = duckdb.connect()
    for f in os.listdir(sf):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf}/{f}'")
    want = con.sql(registry.ORACLE_SQL[name])
    got = registry.QUERIES[name](spark, sf)
    assert sorted(got.columns) == sorted(want.columns)
    order = [want.columns.index(c) for c in got.columns]
    assert Counter(tuple(r) for r in got.collect()) == Counter(tuple(r[i] for i in order) for r in want.fetchall())


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_sql(spark, sf, name):
    compare(spark, sf, name)


def test_escapes_can_be_undone():
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice(["<", "\\", "|", "\n", "n", "<|im_end|>", "a"]) for _ in range(rng.randrange(12)))
        assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
        assert chat.unescape_role(chat.escape_role(text)) == text and "\n" not in chat.escape_role(text)


def test_odd_conversations(spark):
    rows = [
        (1, 1, "assistant", "<|im_end|>x"), (1, 0, "user", None), (1, 0, "user", None), (None, None, None, "t"), (2, None, "a\n\\b<|", "<\\|"),
        (3, 5, "assistant", ""), (3, 2, "assistant", "é\U0001f600"),
    ]
    talks = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, ids string")
    got = {r.conv_id: r for r in chat.read_back(chat.formatted(talks)).collect()}

    def sha(*parts):
        return hashlib.sha256("".join(parts).encode()).hexdigest()

    assert {k: r.n_turns for k, r in got.items()} == {1: 3, None: 1, 2: 1, 3: 2}
    assert got[1].turns_sha256 == sha("user\n\n", "user\n\n", "assistant\n<|im_end|>x\n") and got[1].loss_sha256 == sha("<|im_end|>x")
    assert got[None].turns_sha256 == sha("\nt\n") and got[None].loss_chars == 0
    assert got[2].turns_sha256 == sha("a\n\\b<|\n<\\|\n")
    assert (got[3].loss_chars, got[3].loss_sha256) == (2, sha("é\U0001f600"))
    assert chat.read_back(chat.formatted(talks.limit(0))).count() == 0


def test_loss_mask_covers_the_assistant_text_alone(spark):
    talks = spark.createDataFrame([(1, 0, "assistant", "hello there"), (1, 1, "user", "hello")], "conv_id long, turn long, role string, text string")
    rows = sorted(chat.formatted(talks).collect(), key=lambda r: r.turn)
    assert sum(rows[1].loss_mask) == 0
    mask = rows[0].loss_mask
    assert 0 < sum(mask) == len(mask) - mask.index(1) - 2 and mask[-2:] == [0, 0]


def test_url_parts_and_rules(spark):
    cases = [
        ("http://WWW.Example.com/en/7x?q", "www.example.com", "/en/7x", "example.com/en/7", "allow"),
        ("https://com/en/", "com", "/en/", "com/en/", "block"),
        ("https://a.example.net#/de/8", "a.example.net", "", None, "allow"),
        ("x://y.net/de/1#f", "y.net", "/de/1", "net/de/", "allow"),
        ("x://example.net/de/81", "example.net", "/de/81", "example.net/de/8", "block"),
        ("x://notexample.com/en/7", "notexample.com", "/en/7", "com/en/", "block"),
        ("x://É.ORG/es/?://b.com/en/", "É.org", "/es/", "org/es/", "block"),
        ("no scheme", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("x://", "", "", None, "allow"),
    ]
    pages = spark.createDataFrame([(i, c[0], "clash") for i, c in enumerate(cases)], "page_id long, url string, host string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judged(pages, none).collect()}
    assert got == {i: c[1:] for i, c in enumerate(cases)}
    assert urls.judged(pages.limit(0), none).count() == 0


def test_bad_hosts_are_blocked_and_small_ones_shrunk(spark):
    pages = spark.range(300).select(
        F.col("id").alias("page_id"),
        F.when(F.col("id") < 60, "http://bad.example.org/x").when(F.col("id") < 61, "http://once.example.org/x").otherwise(F.concat(F.lit("http://h"), (F.col("id") % 7).cast("string"), F.lit(".co.uk/x"))).alias("url"),
    )
    labels = spark.range(300).select(F.col("id").alias("doc_id"), F.when((F.col("id") < 57) | (F.col("id") == 60), 0).otherwise(1).alias("quality"), F.lit(0).alias("toxic"))
    rep = {r.host: r for r in urls.reputations(pages, labels).collect()}
    assert rep["bad.example.org"].bad_host and rep["once.example.org"].mean < 1 and not rep["h1.co.uk"].bad_host
    assert rep["once.example.org"].bound < rep["bad.example.org"].bound
    twice = labels.unionByName(labels)
    assert {r.host: (r.n, r.bad) for r in urls.reputations(pages, twice).collect()} == {k: (r.n, r.bad) for k, r in rep.items()}


def test_shares_and_moves():
    names = list(sharding.SHARDS[:16])
    full = sharding.lookup_table(names, 4099)
    assert max(Counter(full).values()) - min(Counter(full).values()) <= 1
    fewer = sharding.lookup_table(names[:-1], 4099)
    kept = [a == b for a, b in zip(full, fewer, strict=True) if a != 15]
    assert sum(kept) > 0.9 * len(kept)
    for bad in (lambda: sharding.lookup_table(names, 4098), lambda: sharding.lookup_table(["a", "a"], 7)):
        with pytest.raises(ValueError):
            bad()


def test_placement_of_odd_keys(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("", 3), ("a", 4)], "k string, v int")
    got = {r.v: r.shard for r in sharding.placed(df, "k").collect()}
    assert got[1] == got[4] and got[2] == got[3] and len(got) == 4
    assert sharding.placed(df.limit(0), "k").count() == 0
    clash = sharding.placed(df.withColumns({"Shard": F.lit(1), "slot": F.col("k")}), "slot")
    assert clash.columns == ["k", "v", "slot", "shard"] and {r.v: r.shard for r in clash.collect()} == got
    plan = sharding.placed(df, "k")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Python" not in plan


def test_sharded_files(spark, tmp_path):
    df = spark.range(200).withColumnRenamed("id", "k")
    sharding.write_sharded(df, "k", str(tmp_path / "out"), sharding.SHARDS[:4])
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 200 and back.select("shard").distinct().count() == 4
