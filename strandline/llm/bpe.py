"""Byte-level BPE encoding and decoding with a rank file.

A text is cut into overlapping chunks of ``CHUNK`` characters that are pre-tokenised independently. A chunk's first cuts may
be wrong, as it can begin inside a pre-token; from the first cut that both neighbours of an overlap share on, they agree,
because matching only looks ahead. Chunks are stitched there, and the pieces are encoded by merging ranks. Where an overlap
has no shared cut (a pre-token longer than it), the text is pre-tokenised on from the last sure cut, over a stretch that
doubles, so that the work stays in proportion to the text.

Every text takes this path. Where a text is longer than a ``BLOCK`` of chunks, its blocks are dealt out to tasks, so that
one long document is the work of many; the blocks' ids are joined at cuts that both sides of an overlap share, as chunks are.

Defined results: null text counts as empty and has no ids; repeated rows each get a row; an empty table gives an empty
result; further columns are ignored; special tokens are never produced; ids of documents keep their type. Decoding
concatenates raw bytes, and an id outside the vocabulary is an error.
"""

import base64
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.text import map_batches, type_of

VOCABULARY = "byte_bpe_50k.tiktoken"
CHUNK, OVERLAP = 1 << 11, 1 << 7
#: Characters of a text that one task takes.
BLOCK = CHUNK << 5
#: Cuts this near to the end of a chunk are not trusted: the match there may have gone on.
MARGIN = 64
#: Of a block: the cuts in the overlaps at its start and at its end with the number of ids before each, and its ids.
BLOCK_ARRAYS = ("head", "head_at", "tail", "tail_at", "ids")
#: Pieces that a worker remembers, and their length; beyond so many, it starts afresh.
CACHE, CACHE_CHARS = 150_000, 64


def ranks_of(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}


class _Known(dict):
    """Ids of the pieces seen; a new piece is merged when it is first asked for."""

    def __init__(self, merge):
        self.merge = merge

    def __missing__(self, piece: str) -> list[int]:
        ids = self.merge(piece.encode("utf-8", "surrogatepass"))
        if len(piece) <= CACHE_CHARS:
            self[piece] = ids
        return ids


class Bpe:
    """A worker's coder: ranks, the pre-token pattern and the ids of pieces seen.

    ``chunks`` and ``stitches`` count the chunks that were pre-tokenised and the joins that were made.
    """

    def __init__(self, data: bytes, pattern: str):
        self.pattern = regex.compile(pattern)
        # the library merges single pieces here; cutting texts into pieces is done by chunk
        self.coder = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks_of(data), special_tokens={})
        self.known = _Known(self.coder._core_bpe.encode_single_piece)
        self.chunks = self.stitches = 0

    def pieces(self, text: str) -> list[str]:
        """Pre-tokens of a text, chunk by chunk."""
        find, n = self.pattern.findall, len(text)
        end = min(n, CHUNK + OVERLAP)
        held = find(text, 0, end)
        self.chunks += 1
        while end < n:
            start = end - OVERLAP
            stop = min(n, end + CHUNK)
            own = find(text, start, stop)
            self.chunks += 1
            at = meeting(held, own, start, end)
            if at:
                self.stitches += 1
                del held[at[0] :]
                held += own[at[1] :]
            else:
                at = end
                while held and at >= end - MARGIN:
                    at -= len(held.pop())
                stop = min(n, max(stop, 2 * end - at))
                held += find(text, at, stop)
            end = stop
        return held

    def merged(self, pieces: list[str]) -> np.ndarray:
        """The ids of pieces, one after the other."""
        if len(self.known) > CACHE:
            self.known.clear()
        return np.fromiter(chain.from_iterable(map(self.known.__getitem__, pieces)), np.int32)

    def encode_to_numpy(self, text: str | None) -> np.ndarray:
        return self.merged(self.pieces(text)) if text else np.zeros(0, np.int32)

    def encode(self, text: str | None) -> list[int]:
        return self.encode_to_numpy(text).tolist()

    def block(self, part: str) -> tuple[np.ndarray, ...]:
        """What a block gives for its joins: its ``BLOCK_ARRAYS``."""
        pieces = self.pieces(part)
        ids = self.merged(pieces)
        head, head_at, at, n = [], [], 0, 0
        for p in pieces:
            if at >= OVERLAP:
                break
            head.append(at)
            head_at.append(n)
            at, n = at + len(p), n + len(self.known[p])
        tail, tail_at, at, n = [], [], len(part), len(ids)
        for p in reversed(pieces):
            at, n = at - len(p), n - len(self.known[p])
            if at < BLOCK:
                break
            tail.append(at)
            tail_at.append(n)
        return *(np.array(x, np.int32) for x in (head, head_at, tail[::-1], tail_at[::-1])), ids


def meeting(left: list[str], right: list[str], start: int, end: int) -> tuple[int, int] | None:
    """Numbers of the first pieces from which on both lists agree; they share the text from ``start`` to ``end``.

    The left list ends at ``end``, the right one begins at ``start``. A cut is trusted up to ``MARGIN`` before the end.
    """
    cuts, at, i = {}, end, len(left)
    while i and at > start:
        i -= 1
        at -= len(left[i])
        cuts[at] = i
    at = start
    for j, piece in enumerate(right):
        if at >= end - MARGIN:
            return None
        if at in cuts:
            return cuts[at], j
        at += len(piece)
    return None


def vocabulary(spark: SparkSession, path: str):
    """The rank file, sent to the executors: a file of fixed size, read where the driver runs."""
    with open(path, "rb") as f:
        data = f.read()
    if len(data) > 64 << 20:
        raise ValueError(f"{path}: a vocabulary of {len(data)} bytes is too large to broadcast")
    return spark.sparkContext.broadcast(data)


def encoded(docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``doc_id, ids``: the token ids of each text."""
    sent = vocabulary(docs.sparkSession, path or public_tokenizers.path(VOCABULARY))
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    own = type_of(rows, "doc_id")

    def make():
        bpe = Bpe(sent.value, pattern)

        def work(batch):
            return [batch.column(0), _lists([bpe.encode_to_numpy(t) for t in batch.column(1).to_pylist()])]

        return work

    one = F.length("text") <= BLOCK + OVERLAP
    return map_batches(rows.where(one), make, f"doc_id {own}, ids array<int>").unionByName(_encoded_by_block(rows.where(~one), own, sent, pattern))


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)], dtype=np.int32)
    flat = np.concatenate(arrays).astype(np.int32) if arrays else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def _encoded_by_block(rows: DataFrame, own: str, sent, pattern: str) -> DataFrame:
    def make_parts():
        def work(batch):
            doc, key, n, k, part = [], [], [], [], []
            for i, h, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for start in range(0, max(1, len(text) - OVERLAP), BLOCK):
                    doc.append(i)
                    key.append(h)
                    n.append(len(text))
                    k.append(start // BLOCK)
                    part.append(text[start : start + BLOCK + OVERLAP])
            return [doc, key, n, k, part]

        return work

    of_doc = f"doc_id {own}, h long, n int"
    parts = map_batches(rows.select("doc_id", F.xxhash64("text").alias("h"), "text"), make_parts, f"{of_doc}, k int, part string")
    # one task for each block, not for each document; equal rows of a table are one here
    parts = parts.groupBy("doc_id", "h", "n", "k").agg(F.first("part").alias("part"), F.count("*").alias("times"))

    def make():
        bpe = Bpe(sent.value, pattern)

        def work(batch):
            found = [bpe.block(part) for part in batch.column(4).to_pylist()]
            return [*batch.columns, *(_lists([f[i] for f in found]) for i in range(len(BLOCK_ARRAYS)))]

        return work

    arrays = ", ".join(f"{c} array<int>" for c in BLOCK_ARRAYS)
    done = map_batches(parts, make, f"{of_doc}, k int, part string, times long, {arrays}")
    # what meets here is one document: its ids are one row of the result as well
    blocks = F.sort_array(F.collect_list(F.struct("k", "part", *BLOCK_ARRAYS))).alias("blocks")
    whole = done.groupBy("doc_id", "h", "n").agg(F.max("times").alias("times"), blocks)

    def make_join():
        bpe = Bpe(sent.value, pattern)

        def work(batch):
            doc, ids = [], []
            for i, times, blocks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                _, part, *lists = blocks.values.flatten()
                found = join_blocks(bpe, [(part[j].as_py(), *(a[j].values.to_numpy() for a in lists)) for j in range(len(part))])
                doc += [i] * times
                ids += [found] * times
            return [pa.array(doc, batch.column(0).type), _lists(ids)]

        return work

    return map_batches(whole.select("doc_id", "times", "blocks"), make_join, f"doc_id {own}, ids array<int>")


def join_blocks(bpe: Bpe, blocks: list[tuple]) -> np.ndarray:
    """Ids of a document from its blocks (text and ``BLOCK_ARRAYS``), in order.

    Each block gives the ids of its pieces from one join to the next. If any overlap has no join, the whole text is
    encoded here; a pre-token longer than the overlap is all that does this.
    """
    out, low = [], 0
    for k, (part, head, head_at, tail, tail_at, ids) in enumerate(blocks):
        if k + 1 == len(blocks):  # it reaches the end of the text
            out.append(ids[low:])
            break
        # the tail is counted from this block's start, the next head from its own
        shared, here, there = np.intersect1d(tail - BLOCK, blocks[k + 1][1], return_indices=True)
        if not len(shared) or shared[0] + BLOCK >= len(part) - MARGIN:
            text = "".join(c[0][:BLOCK] for c in blocks) + blocks[-1][0][BLOCK:]
            return bpe.encode_to_numpy(text)
        out.append(ids[low : tail_at[here[0]]])
        low = blocks[k + 1][2][there[0]]
    return np.concatenate(out) if out else np.zeros(0, np.int32)


def decoded(tokens: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, ids, data``: the bytes of ids, concatenated raw (they need not be valid UTF-8)."""
    sent = vocabulary(tokens.sparkSession, path or public_tokenizers.path(VOCABULARY))

    def make():
        table = sorted((i, raw) for raw, i in ranks_of(sent.value).items())
        if [i for i, _ in table] != list(range(len(table))):
            raise ValueError("ranks must be the numbers from 0 on")
        pool = np.frombuffer(b"".join(raw for _, raw in table), np.uint8)
        size = np.array([len(raw) for _, raw in table], np.int64)
        start = np.cumsum(size) - size

        def work(batch):
            lists = batch.column(1)
            ids = lists.flatten().to_numpy()
            if len(ids) and not 0 <= int(ids.min()) <= int(ids.max()) < len(size):
                raise ValueError("an id lies outside the vocabulary")
            n = size[ids]
            ends = np.concatenate([[0], np.cumsum(n)])
            data = pool[np.repeat(start[ids] - ends[:-1], n) + np.arange(ends[-1])]
            counts = np.array([0 if c is None else c for c in pc.list_value_length(lists).to_pylist()], np.int64)
            offsets = ends[np.concatenate([[0], np.cumsum(counts)])].astype(np.int32)
            return [batch.column(0), lists, pa.BinaryArray.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(offsets), pa.py_buffer(data)])]

        return work

    return map_batches(tokens.select("doc_id", "ids"), make, f"doc_id {type_of(tokens, 'doc_id')}, ids array<int>, data binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decoded(encoded(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("data", 256).alias("decoded_sha256"),
    )
