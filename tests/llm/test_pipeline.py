import pytest

import corpus_pipeline
from strandline.llm import bpe, decontaminate, quality, secrets, simhash, similar

from .test_filters import brute_hits, brute_secrets
from .test_similar import brute_components
from .test_tokens import library


def test_pipeline_equals_brute_force(spark, sf, texts):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    field = quality.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    kept = {k: t for k, t in texts.items() if quality.verdict(t, field)}
    comp = brute_components(kept)
    kept = {k: t for k, t in kept.items() if comp[k] == k}
    windows, scanner = decontaminate.Windows(items), secrets.Scanner(secrets.ranked_words())
    want = {}
    _, enc = library()
    for k, t in kept.items():
        if len(t) < 8000:
            assert brute_hits(t, items)[2] == set(windows.scan(t)[2])
        _, spans, own = windows.scan(t)
        words = f" {b' '.join(decontaminate.words_of(t)).decode()} "
        whole = any(f" {b' '.join(decontaminate.words_of(x)).decode()} " in words for i, x in items if i in own)
        if len(own) < decontaminate.MIN_ITEMS and not whole:
            clean = scanner.redact(decontaminate.cut(t, decontaminate.offsets(t, spans)))
            assert not brute_secrets(clean)
            want[k] = enc.encode_ordinary(clean)
    got = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, sf).collect()}
    assert got == want


def test_stages_keep_the_columns(spark, sf, no_docs):
    docs = no_docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == no_docs.columns and docs.dtypes == no_docs.dtypes
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() == 0
    assert bpe.encoded(no_docs).count() == 0


def test_stages_take_odd_documents(spark, sf, odd_docs):
    docs = odd_docs.selectExpr("doc_id", "text", "lang", "CAST(NULL AS STRING) source", "CAST(n_words AS BIGINT) n_chars", "_clean", "score")
    docs = docs.unionByName(docs)
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, sf)
        if name != "bpe_tokens":
            assert docs.columns == before.columns
    got = docs.collect()
    assert len({r.doc_id for r in got}) == len(got)


@pytest.mark.parametrize("operator", [simhash, similar])
def test_near_dedup_of_odd_documents(spark, odd_docs, operator):
    got = operator.deduplicated(odd_docs.unionByName(odd_docs)).collect()
    # 1, 2, 3 have no words; 5 is also the row without an id
    assert sorted(r.doc_id for r in got) == [1, 4, 5, 6, 7, 8, 9]
