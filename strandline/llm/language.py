"""Language identification by a mixture of language models.

A text is taken as draws of character n-grams (three UTF-8 bytes of lower-cased words) from a mixture of the languages'
n-gram distributions. Expectation-maximisation estimates the document's language proportions; the set of languages is
chosen by penalised likelihood, ``log L - PENALTY * (k - 1) * log n``, over the sets that take the languages in order of
their proportions. The predicted language is the one with the largest share in the chosen set, the score its share.

The model is fitted on a bounded sample of labelled rows, about ``TRAIN_ROWS`` for each language, dealt by a hash of the
id. Every language of the labels is learned; the model holds the counts that are not zero, at most ``BUCKETS`` for each
language. What is broadcast is checked: more than ``MAX_COUNTS`` counts or ``MAX_LANGUAGES`` languages are an error, never a
smaller model.

Defined results: null text and text without a letter get ``und`` and score 0; with no labelled row every text does; ties
go to the language that sorts first; repeated rows each get a row; a null id counts as held in; an empty table gives an
empty result; further columns are ignored; ids keep their type.
"""

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.text import encoded, map_batches, type_of
from strandline.storage import durable

BUCKETS = 1 << 15
TRAIN_ROWS = 3000
MAX_LANGUAGES, MAX_COUNTS = 10_000, 16_000_000
EM_STEPS, PENALTY, MIN_SHARE, SMOOTHING = 12, 3.0, 0.03, 0.2
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
_OTHER = regex.compile(r"[^\p{L}\p{M}]+")


def grams(text: str) -> np.ndarray:
    """Bucket of each run of three bytes in the letters of a text."""
    raw = np.frombuffer(encoded(" " + _OTHER.sub(" ", text.lower()) + " "), np.uint8).astype(np.uint32)
    if len(raw) < 3:
        return np.zeros(0, np.uint32)
    code = raw[:-2] << 16 | raw[1:-1] << 8 | raw[2:]
    return (code * np.uint32(2654435761)) >> np.uint32(17)


class Mixture:
    """``names`` (sorted), and the counts ``n`` of the n-grams ``bucket`` in the languages ``lang`` (its number)."""

    def __init__(self, names: list[str], lang: np.ndarray, bucket: np.ndarray, n: np.ndarray):
        self.names, self.parts = names, (names, lang, bucket, n)
        order = np.argsort(bucket, kind="stable")
        self.lang, self.start = lang[order], np.searchsorted(bucket[order], np.arange(BUCKETS + 1))
        total = np.bincount(lang, n, minlength=len(names)) + SMOOTHING * BUCKETS
        self.unseen = SMOOTHING / total
        self.p = (n[order] + SMOOTHING) / total[self.lang]

    def table(self, buckets: np.ndarray) -> np.ndarray:
        """The probability of each of the n-grams (rows) in each language (columns)."""
        out = np.repeat(self.unseen[None, :], len(buckets), axis=0)
        first = self.start[buckets]
        sizes = self.start[buckets + 1] - first
        row = np.repeat(np.arange(len(buckets)), sizes)
        at = np.arange(len(row)) + np.repeat(first - (np.cumsum(sizes) - sizes), sizes)
        out[row, self.lang[at]] = self.p[at]
        return out

    def em(self, p: np.ndarray, n: np.ndarray, steps: int) -> tuple[np.ndarray, float]:
        """Proportions of the columns of ``p`` for counts ``n``, and the log likelihood."""
        total = n.sum()
        share = np.full(p.shape[1], 1 / p.shape[1])
        for _ in range(steps):
            share = share * ((n / (p @ share)) @ p) / total
        return share, float(n @ np.log(p @ share))

    def infer(self, text: str | None) -> tuple[str, float, list[str], list[float]]:
        if text is None or not self.names or not _LETTER.search(text):
            return UNKNOWN, 0.0, [], []
        counts = np.bincount(grams(text), minlength=BUCKETS)
        seen = np.flatnonzero(counts)
        n = counts[seen].astype(np.float64)
        p = self.table(seen)
        single = n @ np.log(p)
        first = int(single.argmax())
        best, chosen = float(single[first]), ([first], np.ones(1))
        share, _ = self.em(p, n, EM_STEPS)
        order = [int(i) for i in np.argsort(-share, kind="stable") if share[i] >= MIN_SHARE]
        cost = PENALTY * np.log(n.sum())
        for k in range(2, len(order) + 1):
            own, like = self.em(p[:, order[:k]], n, EM_STEPS)
            if like - cost * (k - 1) > best:
                best, chosen = like - cost * (k - 1), (order[:k], own)
        ranked = sorted(zip((-chosen[1]).tolist(), chosen[0], strict=True))
        names = [self.names[i] for _, i in ranked]
        shares = [min(1.0, -s) for s, _ in ranked]
        return names[0], shares[0], names, shares


def fit(labelled: DataFrame) -> Mixture:
    """Fit on ``doc_id, text, lang`` rows; rows without text or language are left out."""
    rows = labelled.where("text is not null and lang is not null").select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} values of lang")
    sizes = sorted((r.lang, r.n) for r in sizes)
    if not sizes:
        return _mixture([], pa.table({"language": pa.array([], pa.int32()), "bucket": pa.array([], pa.int32()), "n": pa.array([], pa.int64())}))
    limits = [(k, i, min(1_000_000, int(1_000_000 * TRAIN_ROWS / n))) for i, (k, n) in enumerate(sizes)]
    known = F.broadcast(labelled.sparkSession.createDataFrame(limits, "lang string, language int, most long"))
    dealt = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1_000_000))
    sample = rows.join(known, "lang").where(dealt < F.col("most")).select("text", "language")

    def make():
        def work(batch):
            found: dict[int, np.ndarray] = {}
            for text, language in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found[language] = found.get(language, 0) + np.bincount(grams(text), minlength=BUCKETS)
            keys = [(k, np.flatnonzero(n)) for k, n in found.items()]
            none = [np.zeros(0, np.int64)]
            return [
                np.concatenate(none + [np.full(len(b), k) for k, b in keys]),
                np.concatenate(none + [b for _, b in keys]),
                np.concatenate(none + [found[k][b] for k, b in keys]),
            ]

        return work

    counts = map_batches(sample, make, "language int, bucket int, n long").groupBy("language", "bucket").agg(F.sum("n").alias("n"))
    counts = durable(counts, "gram-counts")
    if counts.count() > MAX_COUNTS:
        raise ValueError(f"more than {MAX_COUNTS} counts of n-grams")
    return _mixture([k for k, _ in sizes], counts.toArrow())


def _mixture(names: list[str], counts: pa.Table) -> Mixture:
    return Mixture(names, *(counts[c].to_numpy() for c in ("language", "bucket", "n")))


def identified(docs: DataFrame, model: Mixture) -> DataFrame:
    """``doc_id, lang_pred, score, languages, shares``; only the text is an input of the prediction."""
    sent = docs.sparkSession.sparkContext.broadcast(model.parts)

    def make():
        own = Mixture(*sent.value)

        def work(batch):
            out = [own.infer(t) for t in batch.column(1).to_pylist()]
            return [batch.column(0), *([x[i] for x in out] for i in range(4))]

        return work

    rows = docs.select("doc_id", F.col("text").cast("string"))
    found = "lang_pred string, score double, languages array<string>, shares array<double>"
    return map_batches(rows, make, f"doc_id {type_of(rows, 'doc_id')}, {found}")


def held_out(doc_id="doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs.where(~held_out()).select("doc_id", "text", "lang"))
    found = identified(docs, model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "languages", "shares")
