"""Near-duplicate detection (operator 2) for a similarity: SimHash and minima propose pairs, exact similarity decides.

A text is its set of hashed shingles of ``WIDTH`` words (lower-cased A-Z; a shorter text is one shingle). Texts with one
set are one class from the start. Pairs are proposed by two kinds of tables: the covering masks of ``simhash`` over the
SimHash of the set, which find every pair within their radius, and ``BANDS`` bands of ``ROWS`` minima each. The second kind is
needed because at a similarity of 0.8 most pairs differ in 3 to 14 of the 64 bits; such a pair misses all bands with
probability (1 - 0.8^4)^16 = 0.0002, more similar ones less. A pair is linked if its exact Jaccard similarity is at least
``SIMILAR`` (a fraction of whole numbers).

All pairs of a bucket of up to ``BUCKET`` classes are compared, but those whose sizes rule a link out. In a larger one a few
representatives, those in most large buckets first, are compared with all its classes. Then the classes that are outside the
largest component of a large bucket are a query set: block by block (``MOST_SHINGLES``), with an index of the block's
shingles that is broadcast, all classes of large buckets are held against it, and each gives at most one link for a query
and a component. So a large group makes pairs in proportion to its size, and yet no link between classes of a common bucket is
lost. Pairs are first compared by ``SLICES`` bits of each minimum: at least ``AGREE`` of the 64 must be equal (at a
similarity of 0.8 fewer are with a probability of 0.00001).

Defined results: null text and text without words are one class; otherwise as in ``simhash``.
"""

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm import simhash
from strandline.llm.graph import components
from strandline.llm.text import ASCII_LOWER, encoded, map_batches, text_column, type_of
from strandline.storage import durable

WIDTH, SEED, BANDS, ROWS, BUCKET, REPS, AGREE = 5, 42, 16, 4, 32, 4, 37
SLICES = 6
#: 0.8 as a fraction.
SIMILAR = (4, 5)
#: Shingles at a time, words that a worker remembers, rows that are broadcast.
BLOCK, CACHE, BROADCAST_ROWS = 1 << 10, 200_000, 200_000
#: Shingles of the queries in a block (16 bytes each), and blocks that are answered in one pass.
MOST_SHINGLES, MOST_BLOCKS = 2_000_000, 8
_RNG = np.random.default_rng(SEED)
_FACTORS = _RNG.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_ODD = _RNG.integers(0, 1 << 63, WIDTH, np.uint64) * np.uint64(2) + np.uint64(1)
_MASKS = np.array(simhash.submasks(), np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


class _Hashes(dict):
    """Hashes of words; a new word is hashed when it is first asked for."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word, SEED)
        return found


class Sets:
    """A worker's shingler."""

    def __init__(self):
        self.known = _Hashes()

    def shingles(self, text: str | None) -> np.ndarray:
        """The sorted different hashes of a text's shingles."""
        words = encoded(text).translate(ASCII_LOWER).split()
        if not words:
            return np.zeros(0, np.uint64)
        h = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
        n = max(1, len(h) - WIDTH + 1)
        out = np.full(n, min(len(h), WIDTH), np.uint64)
        for i in range(min(WIDTH, len(h))):
            out = _mixed(out * _ODD[i] + h[i : i + n])
        return np.unique(out)

    def key(self, text: str | None) -> int:
        return set_hash(self.shingles(text))


def set_hash(found: np.ndarray) -> int:
    """Signed 64-bit hash of a set of shingles."""
    return simhash._signed(xxhash.xxh64_intdigest(found.tobytes(), SEED)) if len(found) else 0


def tables(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signed hash of a set's bucket in each table (the covering masks, then the bands); ``SLICES`` bits of the minima, in a long each."""
    if not len(found):
        return np.zeros(0, np.int64), np.zeros(SLICES, np.int64)
    least = np.full(len(_FACTORS), np.iinfo(np.uint64).max)
    ones = np.zeros(simhash.BITS, np.int64)
    for start in range(0, len(found), BLOCK):
        part = found[start : start + BLOCK]
        np.minimum(least, (_FACTORS[:, None] * part).min(axis=1), out=least)
        ones += np.unpackbits(_mixed(part).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(found), bitorder="little").view(np.uint64)
    rows = least.reshape(BANDS, ROWS)
    bands = np.zeros(BANDS, np.uint64)
    for k in range(ROWS):
        bands = _mixed(bands * _ODD[0] + rows[:, k])
    values = np.concatenate([bits & _MASKS, bands])
    keys = _mixed(values * _ODD[1] + np.arange(1, len(values) + 1, dtype=np.uint64))
    slices = (_mixed(least) >> np.arange(SLICES, dtype=np.uint64)[:, None]).astype(np.uint8) & 1
    return keys.view(np.int64), np.packbits(slices, axis=1, bitorder="little").view(np.int64).ravel()


def marked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, fp, n, keys, sketch``: the hash of each document's set, its size, its buckets, and bits of its minima."""

    def make():
        sets = Sets()

        def work(batch):
            found = [sets.shingles(t) for t in batch.column(1).to_pylist()]
            keys, sketches = zip(*map(tables, found), strict=True) if found else ((), ())
            return [batch.column(0), [set_hash(s) for s in found], [len(s) for s in found], list(keys), list(sketches)]

        return work

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(rows, make, f"doc_id {type_of(rows, 'doc_id')}, fp long, n int, keys array<long>, sketch array<long>")


def _near_in_size(a: Column, b: Column) -> Column:
    """Whether sets of such sizes can be similar."""
    return F.least(a, b) * SIMILAR[1] >= F.greatest(a, b) * SIMILAR[0]


def _unlike(a: Column, b: Column) -> Column:
    """The number of minima that two sketches tell apart."""
    differs = a[0].bitwiseXOR(b[0])
    for k in range(1, SLICES):
        differs = differs.bitwiseOR(a[k].bitwiseXOR(b[k]))
    return F.bit_count(differs)


def _paired(rows: DataFrame) -> DataFrame:
    """All pairs of each bounded bucket of ``key, fp, n`` that can be similar."""
    lists = rows.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("fp", "n"))).alias("fps")).where(F.size("fps") > 1)
    first = lists.select("fps", F.posexplode("fps").alias("at", "a"))
    both = first.select("a", F.explode(F.expr("slice(fps, at + 2, size(fps))")).alias("b"))
    return both.where(_near_in_size(F.col("a.n"), F.col("b.n"))).select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v"))


def _broadcast(rows: DataFrame) -> DataFrame:
    """A written table, to be broadcast if it has few rows; beyond, the join is left to the planner."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def buckets(classes: DataFrame, bucket: int = BUCKET) -> tuple[DataFrame, DataFrame | None]:
    """``u, v`` (u < v): the pairs of small buckets; and the rows ``key, fp, n`` of larger buckets, if there are any."""
    rows = durable(classes.select(F.explode("keys").alias("key"), "fp", "n"), "buckets")
    hot = durable(rows.groupBy("key").agg(F.count("*").alias("size")).where(F.col("size") > bucket).select("key"), "hot-buckets")
    if not hot.limit(1).count():
        return _paired(rows), None
    known = _broadcast(hot)
    return _paired(rows.join(known, "key", "left_anti")), durable(rows.join(known, "key", "left_semi"), "hot-rows")


def _star_pairs(hot: DataFrame) -> DataFrame:
    """Pairs of up to ``REPS`` rows of each large bucket with all its rows that can be similar."""
    busy = hot.groupBy("fp").agg(F.count("*").alias("busy"))
    part = F.pmod(F.xxhash64("fp"), F.lit(REPS))
    first = F.min(F.struct(-F.col("busy"), F.col("fp").alias("rep"), F.col("n").alias("rep_n"))).alias("row")
    reps = durable(hot.join(busy, "fp").groupBy("key", part.alias("part")).agg(first).select("key", "row.rep", "row.rep_n"), "representatives")
    both = hot.join(_broadcast(reps), "key").where((F.col("fp") != F.col("rep")) & _near_in_size(F.col("n"), F.col("rep_n")))
    return both.select(F.least("fp", "rep").alias("u"), F.greatest("fp", "rep").alias("v"))


class Index:
    """The shingles of some sets, for their similarity with others."""

    def __init__(self, fps: np.ndarray, roots: np.ndarray, sizes: np.ndarray, shingles: np.ndarray):
        order = np.argsort(shingles, kind="stable")
        self.fps, self.roots, self.sizes = fps, roots, sizes
        self.shingles, self.owner = shingles[order], np.repeat(np.arange(len(sizes)), sizes)[order]

    def links(self, root: int, shingles: np.ndarray) -> np.ndarray:
        """Numbers of the sets of other components that are similar to a set."""
        low, high = np.searchsorted(self.shingles, shingles, "left"), np.searchsorted(self.shingles, shingles, "right")
        n = high - low
        at = np.arange(n.sum()) + np.repeat(low - (np.cumsum(n) - n), n)
        common = np.bincount(self.owner[at], minlength=len(self.sizes))
        either = self.sizes + len(shingles) - common
        return np.flatnonzero((common * SIMILAR[1] >= either * SIMILAR[0]) & (self.roots != root))


def _answered(rows: DataFrame, block: DataFrame) -> DataFrame:
    """``u, v``: links of the queries ``fp, root, shingles`` of a block, of a bounded size, with rows of other components."""
    got = block.toArrow()
    sets = got["shingles"].combine_chunks() if got.num_rows else None
    parts = (
        got["fp"].to_numpy(), got["root"].to_numpy(), np.diff(sets.offsets.to_numpy()) if got.num_rows else np.zeros(0, np.int64),
        sets.flatten().to_numpy() if got.num_rows else np.zeros(0, np.int64),
    )
    sent = rows.sparkSession.sparkContext.broadcast(parts)

    def make():
        index, told = Index(*sent.value), set()

        def work(batch):
            u, v = [], []
            for fp, root, shingles in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                for k in index.links(root, shingles.values.to_numpy()):
                    if (k, root) not in told:
                        told.add((k, root))
                        u.append(int(index.fps[k]))
                        v.append(fp)
            return [u, v]

        return work

    return map_batches(rows, make, "u long, v long")


def sets_of(docs: DataFrame, id_col: str, text_col: str, wanted: DataFrame) -> DataFrame:
    """``fp, shingles`` of the classes ``fp, rep`` in ``wanted``, from the documents ``rep``."""

    def make():
        sets = Sets()

        def work(batch):
            found = [sets.shingles(t) for t in batch.column(0).to_pylist()]
            return [[set_hash(s) for s in found], [s.view(np.int64) for s in found]]

        return work

    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    texts = texts.join(_broadcast(wanted), F.col("_id").eqNullSafe(F.col("rep")), "left_semi").select("_text")
    rows = map_batches(texts, make, "fp long, shingles array<long>").join(wanted.select("fp"), "fp", "left_semi")
    return rows.groupBy("fp").agg(F.any_value("shingles").alias("shingles"))


def _similar(pairs: DataFrame, sketches: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that are similar; their sketches are compared before the sets travel."""
    for side in "uv":
        pairs = pairs.join(sketches.select(F.col("fp").alias(side), F.col("sketch").alias(f"_{side}")), side)
    pairs = pairs.where(_unlike(F.col("_u"), F.col("_v")) <= len(_FACTORS) - AGREE).select("u", "v")
    both = pairs.join(sets.select(F.col("fp").alias("u"), F.col("shingles").alias("a")), "u")
    both = both.join(sets.select(F.col("fp").alias("v"), F.col("shingles").alias("b")), "v")
    common = F.size(F.array_intersect("a", "b"))
    return both.where(common * SIMILAR[1] >= (F.size("a") + F.size("b") - common) * SIMILAR[0]).select("u", "v")


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``node, root`` after more links: the components of the components that these join."""
    a = roots.select(F.col("node").alias("u"), F.col("root").alias("ru"))
    b = roots.select(F.col("node").alias("v"), F.col("root").alias("rv"))
    met = links.join(a, "u", "left").join(b, "v", "left").select(F.coalesce("ru", "u").alias("u"), F.coalesce("rv", "v").alias("v"))
    over = durable(components(met), "joined").select(F.col("node").alias("root"), F.col("root").alias("top"))
    below = roots.join(over, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    return durable(below.unionByName(over.select(F.col("root").alias("node"), F.col("top").alias("root"))).distinct(), "roots")


def linked(docs: DataFrame, classes: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket: int = BUCKET) -> DataFrame:
    """``node, root``: the components of the classes ``fp, n, rep, keys, sketch`` that have links, over all pairs of a common bucket."""
    pairs, hot = buckets(classes, bucket)
    if hot is not None:
        pairs = pairs.unionByName(_star_pairs(hot))
    pairs = durable(pairs.distinct(), "candidates")
    nodes = pairs.select(F.col("u").alias("fp")).unionByName(pairs.select(F.col("v").alias("fp")))
    nodes = (nodes if hot is None else nodes.unionByName(hot.select("fp"))).distinct()
    wanted = durable(classes.select("fp", "rep", "sketch").join(nodes, "fp", "left_semi"), "wanted")
    sets = durable(sets_of(docs, id_col, text_col, wanted.select("fp", "rep")), "shingle-sets")
    roots = durable(components(_similar(pairs, wanted, sets)), "roots")
    return roots if hot is None else _settled(roots, hot, sets)


def _settled(roots: DataFrame, hot: DataFrame, sets: DataFrame) -> DataFrame:
    """The components after the classes outside of the largest component of a large bucket were held against all classes of such."""
    every = durable(sets.join(hot.select("fp").distinct(), "fp", "left_semi"), "hot-sets")
    done = None
    while True:
        own = roots.withColumnRenamed("node", "fp")
        placed = hot.join(own, "fp", "left").select("key", "fp", F.coalesce("root", "fp").alias("root"))
        main = placed.groupBy("key", "root").agg(F.count("*").alias("k")).groupBy("key").agg(F.max_by("root", F.struct("k", "root")).alias("main"))
        left = placed.join(main, "key").where("root <> main").select("fp").distinct()
        left = durable(left if done is None else left.join(done, "fp", "left_anti"), "left")
        rows = every.join(own, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "shingles")
        asked = durable(rows.join(left, "fp", "left_semi"), "queries")
        size = asked.agg(F.sum(F.size("shingles").cast("long")).alias("n")).first().n
        if not size:
            return roots
        blocks = -(-size // MOST_SHINGLES)
        part = F.pmod(F.xxhash64("fp"), F.lit(blocks))
        # what these find may settle some of the others
        now = min(blocks, MOST_BLOCKS)
        # classes lie in few files, so they are dealt out
        rows = rows.repartition(2 * rows.sparkSession.sparkContext.defaultParallelism)
        found = _answered(rows, asked.where(part == 0))
        for k in range(1, now):
            found = found.unionByName(_answered(rows, asked.where(part == k)))
        found = durable(found, "found")
        if found.limit(1).count():
            roots = _joined(roots, found)
        if now == blocks:
            return roots
        answered = asked.where(part < now).select("fp")
        done = answered if done is None else done.unionByName(answered)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp, component_id``: one row per document."""
    rows = durable(marked(docs, id_col, text_col), "marked")
    first = (F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.any_value("n").alias("n"), F.any_value("keys").alias("keys"), F.any_value("sketch").alias("sketch"))
    classes = durable(rows.groupBy("fp").agg(*first), "set-classes")
    return simhash.labelled(rows.select("doc_id", "fp"), classes.select("fp", "rep", "copies"), linked(docs, classes, id_col, text_col))


def marked_rows(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with the hash of their text's set in the column ``name``."""
    return docs.withColumn(name, text_column(F.col("text"), lambda: Sets().key, "long"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` without near duplicates, chosen as by ``simhash.deduplicated``."""
    return simhash.one_of_each(docs, near_duplicates(docs), marked_rows)
