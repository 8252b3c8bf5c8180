import base64
import hashlib
import random

import public_tokenizers
import sentencepiece
import tiktoken

from strandline.llm import bpe, token_counts


def library():
    data = open(public_tokenizers.path(bpe.VOCABULARY), "rb").read()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
    return data, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library(spark, sf, texts):
    _, enc = library()
    got = {r.doc_id: r for r in bpe.query(spark, sf).collect()}
    assert got.keys() == texts.keys()
    for k, text in texts.items():
        ids = enc.encode_ordinary(text)
        assert got[k].n_tokens == len(ids)
        assert got[k].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[k].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_bpe_of_odd_documents(spark, odd_docs, no_docs):
    _, enc = library()
    got = sorted((r.doc_id or 0, tuple(r.ids)) for r in bpe.encoded(odd_docs).collect())
    assert got == sorted((r.doc_id or 0, tuple(enc.encode_ordinary(r.text or ""))) for r in odd_docs.collect())
    assert bpe.encoded(no_docs).count() == 0


def test_every_text_takes_the_path_by_chunk(texts):
    data, _ = library()
    coder = bpe.Bpe(data, public_tokenizers.PATTERN)
    many = [t for t in texts.values() if len(t) > bpe.CHUNK + bpe.OVERLAP]
    assert len(many) > 0.2 * len(texts)
    for text in texts.values():
        coder.chunks = coder.stitches = 0
        coder.encode(text)
        chunks = max(1, -(-(len(text) - bpe.OVERLAP) // bpe.CHUNK))
        assert (coder.chunks, coder.stitches) == (chunks, chunks - 1)


def test_texts_of_all_sizes():
    data, enc = library()
    rng = random.Random(1)
    coder = bpe.Bpe(data, public_tokenizers.PATTERN)
    words = [f"{rng.choice(['the', 'Wort', 'ébahi', '12,5', '\n', '日本', '  '])}{i % 50}" for i in range(900_000)]
    whole = " ".join(words)
    for size in (0, 1, bpe.CHUNK, bpe.CHUNK + bpe.OVERLAP, bpe.CHUNK + bpe.OVERLAP + 1, bpe.BLOCK, 300_000, 5_000_000):
        text = whole[:size]
        assert len(text) == size and coder.encode_to_numpy(text).tolist() == enc.encode_ordinary(text)
    for text in ("x" * 40_000, " " * 300_000, "a" * 5000 + " b" + "c" * 9000):
        assert "".join(coder.pieces(text)) == text and coder.pieces(text) == coder.pattern.findall(text)


def test_long_documents_by_block(spark, odd_docs, monkeypatch):
    _, enc = library()
    monkeypatch.setattr(bpe, "BLOCK", 1 << 13)
    docs = odd_docs.unionByName(odd_docs)
    got = sorted((r.doc_id or 0, tuple(r.ids)) for r in bpe.encoded(docs).collect())
    assert got == sorted((r.doc_id or 0, tuple(enc.encode_ordinary(r.text or ""))) for r in docs.collect())


def test_chunks_and_blocks_are_stitched(monkeypatch):
    data, enc = library()
    rng = random.Random(3)
    coder = bpe.Bpe(data, public_tokenizers.PATTERN)
    monkeypatch.setattr(bpe, "CHUNK", 30)
    monkeypatch.setattr(bpe, "BLOCK", 100)
    monkeypatch.setattr(bpe, "OVERLAP", 40)
    monkeypatch.setattr(bpe, "MARGIN", 8)
    for _ in range(300):
        alphabet = rng.choice(["ab ", "a1.' \n", "it's 'll  \t\nxy", "日本 é", "a", " ", "<|>#"])
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(1500)))
        want = enc.encode_ordinary(text)
        assert coder.encode(text) == want, text
        # as the tasks that have one block each make them
        blocks = [(text[i : i + 140], *coder.block(text[i : i + 140])) for i in range(0, max(1, len(text) - 40), 100)]
        assert bpe.join_blocks(coder, blocks).tolist() == want, text
    assert coder.stitches > 1000


def test_ids_keep_their_type(spark):
    docs = spark.createDataFrame([("a", "one two"), (None, "x"), ("b", None)], "doc_id string, text string")
    assert sorted((r.doc_id or "", len(r.ids)) for r in bpe.encoded(docs).collect()) == [("", 1), ("a", 2), ("b", 0)]
    assert bpe.decoded(bpe.encoded(docs)).schema["doc_id"].dataType.simpleString() == "string"
    assert sorted((r.doc_id or "", r.n_tokens) for r in token_counts.counted(docs).collect()) == [("", 1), ("a", 2), ("b", 0)]


def test_token_counts_equal_the_library(spark, sf, texts, odd_docs, no_docs):
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(token_counts.MODEL))
    got = {r.doc_id: r for r in token_counts.query(spark, sf).collect()}
    assert {k: r.n_tokens for k, r in got.items()} == {k: len(model.encode(t)) for k, t in texts.items()}
    assert all(got[k].n_bytes == len(t.encode()) and got[k].over_limit == (got[k].n_tokens > 4096) for k, t in texts.items())
    want = sorted((r.doc_id or 0, len((r.text or "").encode()), len(model.encode(r.text or ""))) for r in odd_docs.collect())
    for common in (250_000, 3):  # with few common pre-tokens the others go by the join
        rows = token_counts.counted(odd_docs, common=common).collect()
        assert sorted((r.doc_id or 0, r.n_bytes, r.n_tokens) for r in rows) == want
    assert token_counts.counted(no_docs).count() == 0


def test_pre_tokens_partition_random_texts():
    data = open(public_tokenizers.path(token_counts.MODEL), "rb").read()
    counts, rng = token_counts.Counts(data), random.Random(8)
    for _ in range(300):
        alphabet = rng.choice(["ab ", "  \n▁x", "the of.,", "é½ﬁ　 ", "日本語 a", "<s></s> "])
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(60)))
        assert sum(counts.tokens(counts.pre_tokens(text))) == len(counts.model.encode(text)), repr(text)
