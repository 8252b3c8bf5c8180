"""Near-duplicate detection: SimHash fingerprints and covering locality-sensitive hashing.

Every pair of fingerprints within ``RADIUS`` bits is found. Bit *i* of a fingerprint has a label m(i), a non-zero vector
of GF(2)^(r+1); the mask of a table v keeps the bits whose label has odd parity with v. For a pair that differs in at
most r bits, r linear equations in r+1 unknowns leave a non-zero v that is orthogonal to the labels of all differing
bits; its mask keeps none of them, so the pair collides in that table. Seven masks do for a radius of 2.

Exact copies are one fingerprint class, so a group of copies is one row from the start. A bucket of up to
``BUCKET`` different fingerprints is linked in one short list. The rows of a larger bucket are dealt again by seven
masks over the bits which the bucket's mask leaves free (the same covering argument holds for them); after three
levels at most six bits are free, so that a bucket holds at most 64 different fingerprints, whatever the data.
No level drops a link, and none compares all pairs of an unbounded group.

Defined results: null text and text without words have fingerprint zero and link like any other; repeated rows each
get a row; a null ``doc_id`` keeps its fingerprint, and its component is the smallest non-null id reachable (null if
there is none); an empty table gives an empty result; further columns are ignored.
"""

from collections.abc import Callable

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.graph import components
from strandline.llm.text import ASCII_LOWER, encoded, free_name, map_batches, text_column, type_of
from strandline.storage import durable

WIDTH, SEED, RADIUS, BITS, BUCKET, LEVELS = 3, 42, 2, 64, 64, 3
#: Ids, and labels of classes, that are broadcast; copies from which on a class's label is.
BROADCAST_IDS, BROADCAST_ROWS, HOT_COPIES = 1_000_000, 200_000, 10_000
BLOCK = 1 << 15


def fingerprint(text: str | None, width: int = WIDTH) -> int:
    """Unsigned 64-bit SimHash of a text's word shingles."""
    words = encoded(text).translate(ASCII_LOWER).split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < width:
        return digest(b" ".join(words), SEED)
    counts, n = np.zeros(BITS, np.int64), len(words) - width + 1
    join = b" ".join
    for start in range(0, n, BLOCK):
        part = words[start : min(start + BLOCK, n) + width - 1]
        hashes = np.fromiter((digest(join(s), SEED) for s in zip(*(part[i:] for i in range(width)), strict=False)), np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        # sums of up to 255 rows fit a byte, which keeps the additions in vector registers
        whole = len(bits) // 255 * 255
        counts += bits[:whole].reshape(-1, 255, BITS).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        counts += bits[whole:].sum(axis=0, dtype=np.uint8)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """``doc_id, fp``: one row per document; ``fp`` is the fingerprint as a signed long."""

    def make():
        def work(batch):
            values = np.array([fingerprint(t, width) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
            return [batch.column(0), values]

        return work

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(rows, make, f"doc_id {type_of(rows, 'doc_id')}, fp long")


def submasks(mask: int = 0, radius: int = RADIUS) -> list[int]:
    """The covering masks over the bits that ``mask`` leaves free, each with ``mask`` itself, as unsigned numbers."""
    free = [i for i in range(BITS) if not mask >> i & 1]
    size = 1 << (radius + 1)
    label = {bit: 1 + k % (size - 1) for k, bit in enumerate(free)}
    return [mask | sum(1 << b for b in free if (label[b] & v).bit_count() % 2) for v in range(1, size)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def bucket_links(fps: list[int], radius: int = RADIUS) -> list[tuple[int, int]]:
    """Links that join the fingerprints of one bounded bucket just as all pairs within the radius would."""
    a = np.array(fps, np.int64).view(np.uint64)
    near = np.bitwise_count(a[:, None] ^ a[None, :]) <= radius
    root, out = list(range(len(fps))), []

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, j in zip(*np.nonzero(np.triu(near, 1)), strict=True):
        p, q = find(int(i)), find(int(j))
        if p != q:
            root[max(p, q)] = min(p, q)
            out.append((fps[int(i)], fps[int(j)]))
    return out


def links(fps: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """``u, v``: links between different fingerprints of the column ``fp`` (distinct), within the radius."""
    spark = fps.sparkSession

    def make():
        def work(batch):
            pairs = [p for fs in batch.column(0).to_pylist() for p in bucket_links(fs)]
            return [[p[0] for p in pairs], [p[1] for p in pairs]]

        return work

    masks, found = [0], []
    rows = fps.select(F.lit(0).cast("long").alias("mask"), "fp")
    for level in range(LEVELS):
        below = {_signed(m): [_signed(x) for x in submasks(m)] for m in masks}
        table = F.create_map(*(F.lit(x) for m, sub in below.items() for x in (m, F.array(*map(F.lit, sub)))))
        rows = rows.select("fp", F.explode(F.element_at(table, F.col("mask"))).alias("mask"))
        rows = rows.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")
        last = level == LEVELS - 1
        hot = None
        if not last:
            hot = durable(rows.groupBy("mask", "key").agg(F.count("*").alias("n")).where(F.col("n") > bucket).select("mask", "key"), "hot-buckets")
            # large buckets are few; beyond a size that a broadcast may have, the join is left to the planner
            n_hot = hot.count()
            known = F.broadcast(hot) if n_hot <= 200_000 else hot
            small = rows.join(known, ["mask", "key"], "left_anti") if n_hot else rows
        else:
            small = rows
        lists = small.groupBy("mask", "key").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1).select(F.array_sort("fps"))
        found.append(map_batches(lists, make, "u long, v long"))
        if last or not n_hot:
            break
        masks = [x & (1 << 64) - 1 for m in below for x in below[m]]
        rows = durable(rows.join(known, ["mask", "key"], "left_semi").select("mask", "fp"), "hot-rows")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp, component_id``: one row per document, exact for the radius."""
    marked = durable(fingerprints(docs, id_col, text_col), "fingerprints")
    classes = durable(marked.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "fingerprint-classes")
    return labelled(marked, classes, components(links(classes.select("fp"))))


def labelled(marked: DataFrame, classes: DataFrame, stars: DataFrame) -> DataFrame:
    """``doc_id, fp, component_id`` of the rows ``doc_id, fp``, with their classes ``fp, rep, copies`` and the components ``node, root`` of these.

    Classes of very many copies get their label by a broadcast, so that no task has to take all copies of one text.
    """
    # a component's members and root get the smallest id among all of its classes
    member = classes.join(stars.withColumnRenamed("node", "fp"), "fp")
    least = member.groupBy("root").agg(F.min("rep").alias("component_id"))
    joined = member.join(least, "root").select("fp", "component_id")
    labels = durable(
        classes.join(joined, "fp", "left").select("fp", F.coalesce("component_id", "rep").alias("component_id")), "fingerprint-labels"
    )
    many = classes.where(F.col("copies") > HOT_COPIES).select("fp")
    names = ("doc_id", "fp", "component_id")
    n_many = many.count()
    if not n_many:
        return marked.join(labels, "fp").select(*names)
    hot = labels.join(many, "fp", "left_semi")
    hot = F.broadcast(hot) if n_many <= BROADCAST_ROWS else hot
    rest = marked.join(hot.select("fp"), "fp", "left_anti").join(labels, "fp").select(*names)
    return rest.unionByName(marked.join(hot, "fp").select(*names))


def _signed_fingerprint(text: str | None) -> int:
    return _signed(fingerprint(text))


def marked_rows(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with the fingerprint of their text in the column ``name``."""
    return docs.withColumn(name, text_column(F.col("text"), lambda: _signed_fingerprint, "long"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` without near duplicates: of each component the document with the smallest id stays, once.

    Of several rows with one id, one stays: of those whose text makes the id the smallest of its component, the first in
    order of all columns as JSON. Rows without an id stay only where no document with an id is near, and then one for each
    fingerprint, chosen likewise.
    """
    return one_of_each(docs, near_duplicates(docs), marked_rows)


def one_of_each(docs: DataFrame, found: DataFrame, marked_rows: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """The rows of ``docs`` that stay, by the near-duplicates ``found``; ``marked_rows`` gives rows their class ``fp``.

    Ids that go, or whose rows must be looked at, are the smaller side. Up to ``BROADCAST_IDS`` of them are broadcast, so that
    no text moves; beyond, the join is left to the planner.
    """
    found = durable(found, "near-duplicates")
    first = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    ids = found.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n"), F.max(first).alias("first"))
    ids = durable(ids.where("not first or n > 1"), "ids-to-drop")
    drop = ids.select("doc_id")
    drop = F.broadcast(drop) if ids.count() <= BROADCAST_IDS else drop
    once = docs.where("doc_id is not null").join(drop, "doc_id", "left_anti").select(*docs.columns)
    fp = free_name(docs, "_fp")

    def one_each(rows: DataFrame, by: str) -> DataFrame:
        # pre-aggregated, so that many rows of one key meet as one row from each task
        whole = F.struct(*docs.columns)
        chosen = rows.groupBy(by).agg(F.min_by(whole, F.to_json(whole)).alias("row"))
        return chosen.select("row.*")

    again = ids.where("first and n > 1").select("doc_id")
    if again.limit(1).count():
        good = found.where(first).select("doc_id", F.col("fp").alias(fp)).distinct()
        rows = marked_rows(docs.join(again, "doc_id", "left_semi").select(*docs.columns), fp)
        once = once.unionByName(one_each(rows.join(good, ["doc_id", fp], "left_semi"), "doc_id"))
    alone = found.where("doc_id is null and component_id is null").select(F.col("fp").alias(fp)).distinct()
    if alone.limit(1).count():
        rows = marked_rows(docs.where("doc_id is null"), fp)
        once = once.unionByName(one_each(rows.join(alone, fp, "left_semi"), fp))
    return once


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = near_duplicates(docs)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
