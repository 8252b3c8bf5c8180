import random

import numpy as np

import corpus_pipeline
from strandline.llm import similar, simhash


def brute_shingles(text):
    words = simhash.encoded(text).translate(simhash.ASCII_LOWER).split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_components(texts):
    sets = {k: brute_shingles(t) for k, t in texts.items()}
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            x, y = sets[a], sets[b]
            if x == y or 5 * len(x & y) >= 4 * len(x | y):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {k: find(k) for k in keys}


def test_pipeline_drops_near_copies_beyond_the_radius_of_op2(spark, sf):
    rng = random.Random(3)
    words = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    copy = list(words)
    for i in (20, 90, 150, 220, 280):
        copy[i] = "changed"
    far = [w if i % 12 else "other" for i, w in enumerate(words)]
    texts = {1: " ".join(words), 2: " ".join(copy), 3: " ".join(far)}
    a, b = brute_shingles(texts[1]), brute_shingles(texts[2])
    assert len(a & b) / len(a | b) >= 0.8 and (simhash.fingerprint(texts[1]) ^ simhash.fingerprint(texts[2])).bit_count() > 2
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, sf).collect()) == [1, 3]


def test_components_equal_brute_force(spark, sf, texts):
    got = similar.near_duplicates(spark.read.parquet(f"{sf}/documents.parquet")).collect()
    assert {r.doc_id: r.component_id for r in got} == brute_components(texts)


def test_large_buckets(spark):
    rng = random.Random(8)
    body = [f"w{i}" for i in range(200)]
    texts = {}
    for k in range(150):
        mine = list(body)
        for _ in range(rng.choice((1, 2, 3, 4))):
            mine[rng.randrange(200)] = f"x{k}"
        texts[k] = " ".join(mine)
    got = similar.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == brute_components(texts)


def test_odd_documents(spark, odd_docs, no_docs):
    got = similar.near_duplicates(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert {r.component_id for r in got if r.doc_id in (1, 2, 3)} == {1} and {r.component_id for r in got if r.doc_id is None} == {5}
    assert sorted(r.doc_id for r in similar.deduplicated(odd_docs.unionByName(odd_docs)).collect()) == [1, 4, 5, 6, 7, 8, 9]
    assert similar.deduplicated(no_docs).count() == 0


def test_sets_and_tables():
    rng = random.Random(5)
    sets = similar.Sets()
    for _ in range(50):
        text = " ".join(rng.choice(["A", "b", "cé", "D"]) for _ in range(rng.randrange(40)))
        assert len(sets.shingles(text)) == len(brute_shingles(text))
    assert sets.key(None) == sets.key(" \n") == 0
    keys, sketch = similar.tables(sets.shingles("one two three four five six"))
    assert len(set(keys.tolist())) == 7 + similar.BANDS and len(sketch) == similar.SLICES


def test_sketches_tell_minima_apart(spark):
    sets = similar.Sets()
    texts = ["a b c d e f g h", "a b c d e f g x", "q r s t u v w", ""]
    sketches = [similar.tables(sets.shingles(t))[1].tolist() for t in texts]
    rows = [(a, b) for a in sketches for b in sketches]
    got = spark.createDataFrame(rows, "a array<long>, b array<long>").select(similar._unlike(similar.F.col("a"), similar.F.col("b")).alias("n")).collect()

    def lanes(s):
        return [tuple((x & (1 << 64) - 1) >> lane & 1 for x in s) for lane in range(64)]

    assert [r.n for r in got] == [sum(p != q for p, q in zip(lanes(a), lanes(b))) for a, b in rows]


def test_rounds_of_large_buckets(spark, monkeypatch):
    """Large buckets of texts that are not all alike, with few queries at a time."""
    monkeypatch.setattr(similar, "MOST_SHINGLES", 500)
    monkeypatch.setattr(similar, "MOST_BLOCKS", 2)
    monkeypatch.setattr(similar, "REPS", 1)
    rng = random.Random(9)
    body, texts = [f"w{i}" for i in range(60)], {}
    for k in range(60):
        mine = body + [f"y{k // 3}_{i}" for i in range(20)]
        mine[rng.randrange(80)] = f"x{k}"
        texts[k] = " ".join(mine)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = similar.marked(docs, "doc_id", "text").selectExpr("fp", "doc_id AS rep", "n", "keys", "sketch")
    own = {r.rep: r.fp for r in rows.collect()}
    root = {r.node: r.root for r in similar.linked(docs, rows, bucket=4).collect()}
    want = brute_components(texts)
    for a in texts:
        for b in texts:
            assert (want[a] == want[b]) == (root.get(own[a], own[a]) == root.get(own[b], own[b]))


def test_index_finds_similar_sets():
    rng = random.Random(2)
    sets = [np.array(sorted(rng.sample(range(30), rng.randrange(8, 25))), np.int64) for _ in range(40)]
    index = similar.Index(np.arange(40), np.arange(40) % 7, np.array([len(s) for s in sets]), np.concatenate(sets))
    for k, own in enumerate(sets):
        want = [j for j, s in enumerate(sets) if j % 7 != k % 7 and 5 * len(set(s) & set(own)) >= 4 * len(set(s) | set(own))]
        assert index.links(k % 7, own).tolist() == want
    empty = similar.Index(*(np.zeros(0, np.int64) for _ in range(4)))
    assert empty.links(1, sets[0]).tolist() == []
