import random
import re

import xxhash
from pyspark.sql import functions as F

from strandline.llm import graph, simhash


def brute_fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    parts = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(p.encode(), seed=42).intdigest() for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    """fps: key -> fingerprint; the smallest reachable key of each."""
    root = {k: k for k in fps}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    keys = sorted(fps)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if (fps[a] ^ fps[b]).bit_count() <= 2:
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {k: find(k) for k in keys}


def test_fingerprints_and_components(spark, sf, texts):
    want = {k: brute_fingerprint(t) for k, t in texts.items()}
    comp = brute_components(want)
    got = simhash.query(spark, sf).collect()
    assert {r.doc_id: r.fingerprint for r in got} == {k: f"{v:016x}" for k, v in want.items()}
    assert {r.doc_id: r.component_id for r in got} == comp
    assert len(got) == len(texts)


def test_masks_cover_every_pair_within_the_radius():
    rng = random.Random(5)
    for mask in (0, *simhash.submasks(0)):
        free = [i for i in range(64) if not mask >> i & 1]
        masks = simhash.submasks(mask)
        assert len(masks) == 7 and all(m & mask == mask for m in masks)
        pairs = [(a, b) for a in free for b in free if a < b]
        for a, b in pairs if mask == 0 else rng.sample(pairs, 60):
            assert any(not m >> a & 1 and not m >> b & 1 for m in masks)


def test_three_levels_bound_a_bucket():
    left = {m for a in simhash.submasks(0) for b in simhash.submasks(a) for m in simhash.submasks(b)}
    assert max(64 - m.bit_count() for m in left) <= 6 and 1 << 6 <= simhash.BUCKET


def test_hot_buckets_keep_every_link(spark):
    rng = random.Random(1)
    centre, fps = rng.getrandbits(64), set()
    while len(fps) < 150:  # one crowd around a centre, and others apart
        fps.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.choice((1, 2, 3, 4)))))
    while len(fps) < 200:
        fps.add(rng.getrandbits(64))
    signed = [simhash._signed(f) for f in fps]
    table = spark.createDataFrame([(f,) for f in signed], "fp long")
    want = brute_components({f: f & (1 << 64) - 1 for f in signed})
    for bucket in (1, 8, 64):
        got = {r.node: r.root for r in graph.components(simhash.links(table, bucket)).collect()}
        assert {f: got.get(f, f) for f in signed} == want


def test_odd_documents(spark, odd_docs, no_docs):
    got = simhash.near_duplicates(odd_docs).collect()
    assert len(got) == odd_docs.count()
    zero = [r for r in got if r.doc_id in (1, 2, 3)]
    assert all(r.fp == 0 and r.component_id == 1 for r in zero)
    assert {r.component_id for r in got if r.doc_id is None} == {5}
    assert simhash.near_duplicates(no_docs).count() == 0


def test_one_of_each_group_stays(spark, no_docs, odd_docs):
    body = " ".join(f"w{i}" for i in range(300))
    rows = [(10, body), (3, body), (7, body + " end"), (7, body + " end"), (20, "quite another text than that"), (None, "no id here at all"), (None, "no id here at all")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("extra", F.lit(1))
    got = simhash.deduplicated(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got.collect()) == [(False, 3), (False, 20), (True, 0)]
    assert simhash.deduplicated(no_docs).count() == 0


def test_repeated_ids_with_different_texts(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(200)) for x in "abc")
    docs = spark.createDataFrame([(3, a, 1), (5, a, 2), (5, b, 3), (5, c, 4), (None, b, 5), (None, "alone", 7), (None, "alone", 6)], "doc_id long, text string, _fp int")
    assert sorted(r["_fp"] for r in simhash.deduplicated(docs).collect()) == [1, 3, 6]


def test_components_of_chains(spark):
    chain = [(i, i + 1) for i in range(100)] + [(200, 201), (201, 200), (300, 300)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(101)} | {200: 200, 201: 200}


def test_classes_of_many_copies(spark, monkeypatch):
    docs = spark.createDataFrame([(i, ["a b c d", "e f g h i", f"own {i} words here"][min(2, i % 4)]) for i in range(60)], "doc_id long, text string")
    want = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    monkeypatch.setattr(simhash, "HOT_COPIES", 5)
    assert {(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()} == want and len(want) == 60
