"""Benchmark decontamination: one Aho-Corasick automaton over the windows of normalised questions and answers.

Text is normalised to lower-case words and scanned once; every occurrence of a window marks the words inside it and names
the items that own the window. The automaton spells each word of the benchmark with two letters (its number, in a base that
keeps the edges of a node few), any other word with a pair that no window has, so a window has at most ``2 * WINDOW`` nodes.
Offsets in the text as it was are derived for documents that are hit.

The automaton is built once in each worker, so its size is checked: a benchmark of more than ``MAX_NODES`` nodes is dealt by
a hash of the item to several automata of about that size, and each task scans with one of them. The marks of a document,
which are few, meet by its id and a hash of its text. Items are counted and sent part by part.

Defined results: null text has no words and is never hit; items without words (null, empty) own no window and items without an id are left out; equal windows
belong to every item that has them; repeated documents each get a row; an item id that repeats counts once; further
columns are ignored; an empty benchmark hits nothing; ids keep their type.
"""

import re
import uuid
from collections import Counter
from math import isqrt

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.text import LOWER, UPPER, encoded, free_name, held, map_batches, text_column, type_of
from strandline.storage import durable

WINDOW, MIN_ITEMS = 8, 2
#: Nodes of one automaton (some 60 bytes each).
MAX_NODES = 6_000_000
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _table() -> bytes:
    table = bytearray(b" " * 128 + bytes(range(128, 256)))
    for c in b"0123456789" + LOWER:
        table[c] = c
    for a, b in zip(UPPER, LOWER, strict=True):
        table[a] = b
    return bytes(table)


_NORMAL = _table()


def words_of(text: str | None) -> list[bytes]:
    return encoded(text).translate(_NORMAL).split()


class Windows:
    """The automaton over the windows of ``items`` (id, text), and what they belong to."""

    def __init__(self, items: list[tuple], width: int = WINDOW):
        own_words = [(item, words_of(text)) for item, text in items]
        vocabulary = list(dict.fromkeys(w for _, words in own_words for w in words))
        base = isqrt(len(vocabulary)) + 1
        # first and second letters differ, so a match begins where a word does
        self.spelt = {w: chr(1 + k // base) + chr(2 + base + k % base) for k, w in enumerate(vocabulary)}
        owners: dict[tuple, set] = {}
        for item, words in own_words:
            for i in range(max(1, len(words) - width + 1) if words else 0):
                owners.setdefault(tuple(words[i : i + width]), set()).add(item)
        self.owners = [own for _, own in sorted(owners.items())]
        #: Windows of each item, and whether they have the full width.
        self.sizes = Counter(item for own in self.owners for item in own)
        self.full = {item for w, own in owners.items() if len(w) == width for item in own}
        self.automaton = ahocorasick.Automaton() if owners else None
        if owners:
            for k, w in enumerate(sorted(owners)):
                self.automaton.add_word("".join(map(self.spelt.__getitem__, w)), (k, len(w)))
            self.automaton.make_automaton()

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, int]], dict]:
        """Number of words, merged (first, past last) word spans that are hit, and the items found.

        The items have the number of their different windows that occur.
        """
        words = words_of(text)
        if self.automaton is None or not words:
            return len(words), [], {}
        get = self.spelt.get
        spans, seen = [], set()
        for end, (k, n) in self.automaton.iter("".join([get(w, "\0\0") for w in words])):
            past = (end + 1) // 2
            spans.append((past - n, past))
            seen.add(k)
        return len(words), merged(spans), Counter(item for k in seen for item in self.owners[k])

    def whole(self, items: dict) -> bool:
        """Whether all windows of one of the items were found, and these have the full width; shorter items are too common to tell."""
        return any(n == self.sizes[item] and item in self.full for item, n in items.items())


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def offsets(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word spans as code point offsets of the text as it was."""
    if not spans:
        return []
    # upper-case letters are word characters once they are lower-cased, so look at the text after that
    places = [m.span() for m in WORD.finditer(text.translate(_UP))]
    return [(places[a][0], places[b - 1][1]) for a, b in spans]


_UP = dict(zip(UPPER, LOWER, strict=True))


def parts_of(benchmark: DataFrame, max_nodes: int = MAX_NODES) -> list[Broadcast]:
    """A name and the items (id, text) of each part, of about ``max_nodes`` nodes at most. One part is the rule."""
    items = benchmark.select("item_id", F.col("text").cast("string").alias("text")).where("text is not null and item_id is not null").distinct()
    # a letter or digit of a word is followed by another or begins a new one, so this bounds the number of words
    words = F.ceil(F.length("text") / 2) + 1
    total = items.agg(F.sum(words.cast("long")).alias("n")).first().n or 0
    n = -(-total * 2 * WINDOW // max_nodes) if total else 1
    part = F.pmod(F.xxhash64("item_id"), F.lit(n))
    send = benchmark.sparkSession.sparkContext.broadcast
    return [send((uuid.uuid4().hex, [tuple(r) for r in items.where(part == k).collect()])) for k in range(n)]


def _windows(part: Broadcast) -> Windows:
    name, items = part.value
    return held("windows", name, lambda: Windows(items))


def _marks(item: str) -> str:
    return f"n_words long, spans array<struct<first:int,past:int,start:int,end:int>>, items array<{item}>, whole boolean"


def _scanned(rows: DataFrame, part: Broadcast, item: str, hits_only: bool) -> DataFrame:
    """``doc_id, h`` and the marks of the documents ``doc_id, h, text``: of all, or of those that are hit."""

    def make():
        windows = _windows(part)

        def work(batch):
            keep, n, spans, found, whole = [], [], [], [], []
            for i, text in enumerate(batch.column(2).to_pylist()):
                k, hit, own = windows.scan(text)
                if hits_only and not hit:
                    continue
                keep.append(i)
                n.append(k)
                places = zip(hit, offsets(text, hit) if hit else [], strict=True)
                spans.append([{"first": a, "past": b, "start": s, "end": e} for (a, b), (s, e) in places])
                found.append(sorted(own))
                whole.append(windows.whole(own))
            keep = pa.array(keep, pa.int64())
            return [batch.column(0).take(keep), batch.column(1).take(keep), n, spans, found, whole]

        return work

    return map_batches(rows, make, f"doc_id {type_of(rows, 'doc_id')}, h long, {_marks(item)}")


def _united(spans: str) -> Column:
    """The union of the spans in an array column, as ``merged`` makes it."""

    def step(done, s):
        last = F.element_at(done, -1)
        joins = (F.size(done) > 0) & (s["first"] <= last["past"])
        past, end = (F.greatest(last[c], s[c]).alias(c) for c in ("past", "end"))
        longer = F.struct(last["first"].alias("first"), past, last["start"].alias("start"), end)
        return F.when(joins, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))).otherwise(F.concat(done, F.array(s)))

    none = F.array().cast("array<struct<first:int,past:int,start:int,end:int>>")
    return F.aggregate(F.array_sort(F.flatten(F.collect_list(spans))), none, step).alias(spans)


def _scanned_in_parts(rows: DataFrame, parts: list[Broadcast], item: str) -> DataFrame:
    """``doc_id, h`` and the marks of the documents that are hit, from one scan for each part; each document once."""
    found = _scanned(rows, parts[0], item, True)
    for part in parts[1:]:
        found = found.unionByName(_scanned(rows, part, item, True))
    return found.groupBy("doc_id", "h").agg(
        F.max("n_words").alias("n_words"),
        _united("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.max("whole").alias("whole"),
    )


def _rows(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select("doc_id", F.xxhash64(text, F.length(text)).alias("h"), text.alias("text"))


def contamination(docs: DataFrame, benchmark: DataFrame, max_nodes: int = MAX_NODES) -> DataFrame:
    """``doc_id, n_words, spans, items, chars`` per document: hit words, items with occurring windows, text offsets."""
    rows, item = _rows(docs), type_of(benchmark, "item_id")
    parts = parts_of(benchmark, max_nodes)
    if len(parts) == 1:
        return _shown(_scanned(rows, parts[0], item, False))
    hits = durable(_scanned_in_parts(rows, parts, item), "hits")

    def make():
        def work(batch):
            return [batch.column(0), batch.column(1), [len(words_of(t)) for t in batch.column(2).to_pylist()]]

        return work

    own = map_batches(rows, make, f"doc_id {type_of(rows, 'doc_id')}, h long, n_words long")
    hits = hits.drop("n_words", "whole").withColumnsRenamed({"doc_id": "_id", "h": "_h"})
    out = own.join(hits, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h")), "left")
    marks = [(c, kind) for c, kind in hits.dtypes if c in ("spans", "items")]
    return _shown(out.select("doc_id", "n_words", *(F.coalesce(c, F.array().cast(kind)).alias(c) for c, kind in marks)))


def _shown(marks: DataFrame) -> DataFrame:
    spans = F.transform("spans", lambda s: F.struct(s["first"].alias("first"), s["past"].alias("past")))
    chars = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    return marks.select("doc_id", "n_words", spans.alias("spans"), "items", chars.alias("chars"))


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the given code point spans."""
    out, at = [], 0
    for a, b in spans:
        out.append(text[at:a])
        at = b
    return "".join([*out, text[at:]])


def decontaminated(docs: DataFrame, benchmark: DataFrame, min_items: int = MIN_ITEMS, max_nodes: int = MAX_NODES) -> DataFrame:
    """``docs`` without those that hold passages of ``min_items`` items, or every window of one of ``WINDOW`` words or more.

    Lesser passages are cut out of their document; ``n_chars`` follows a cut. With a single automaton, texts are judged
    where they lie, without a shuffle; with several, the few marks are joined to the documents.
    """
    parts = parts_of(benchmark, max_nodes)
    name = free_name(docs, "_cleaned")
    if len(parts) == 1:
        sent = parts[0]

        def make():
            windows = _windows(sent)

            def clean(text):
                _, spans, own = windows.scan(text)
                if len(own) >= min_items or windows.whole(own):
                    return None
                return cut(text, offsets(text, spans)) if spans else text or ""

            return clean

        out = docs.withColumn(name, text_column(F.col("text"), make, "string")).where(F.col(name).isNotNull())
    else:
        hits = durable(_scanned_in_parts(_rows(docs), parts, type_of(benchmark, "item_id")), "hits")
        own = free_name(docs, "_marks")
        marks = hits.select(F.struct("doc_id", "h", "spans", (F.col("whole") | (F.size("items") >= min_items)).alias("goes")).alias(own))
        text = F.col("text").cast("string")
        same = F.col("doc_id").eqNullSafe(F.col(f"{own}.doc_id")) & (F.xxhash64(text, F.length(text)) == F.col(f"{own}.h"))
        at = F.col(f"{own}.spans")
        ends = F.concat(F.transform(at, lambda s: s["start"]), F.array(F.length("text")))
        begins = F.concat(F.array(F.lit(0)), F.transform(at, lambda s: s["end"]))
        left = F.array_join(F.transform(F.arrays_zip(begins.alias("a"), ends.alias("b")), lambda s: F.substring("text", s["a"] + 1, s["b"] - s["a"])), "")
        out = docs.join(marks, same, "left").where(~F.coalesce(F.col(f"{own}.goes"), F.lit(False)))
        out = out.withColumn(name, F.when(F.size(at) > 0, left).otherwise(F.coalesce(text, F.lit(""))))
    if "n_chars" in docs.columns:
        length = F.length(name).cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col(name) != F.col("text"), length).otherwise(F.col("n_chars")))
    return out.withColumn("text", F.when(F.col("text").isNotNull(), F.col(name))).select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["past"] - s["first"])
    named = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    n = F.size("items").cast("long")
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), n.alias("n_items"), F.sha2(named, 256).alias("items_sha256"), (n >= MIN_ITEMS).alias("contaminated")
    )


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
bi AS (SELECT item_id, w, unnest(range(1, greatest(len(w) - 7, 1) + 1)) AS i FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, least(8, len(w)) AS n, array_to_string(w[i:i + 7], ' ') AS win FROM bi),
dn AS (SELECT r, w, n FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n),
di AS (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dn),
dw AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS win FROM di),
hit AS (SELECT r, item_id, n, i FROM dw JOIN bw USING (n, win)),
pos AS (SELECT r, count(DISTINCT p)::BIGINT AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
own AS (SELECT r, count(*)::BIGINT AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM (SELECT DISTINCT r, item_id FROM hit) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_items, 0) >= 2 AS contaminated FROM d LEFT JOIN pos USING (r) LEFT JOIN own USING (r)
"""
