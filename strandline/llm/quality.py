"""Quality rules: base counts, and a linear-chain conditional random field that labels lines.

The field has two labels, boilerplate and content, and real-valued features of a line. It is fitted by maximum
likelihood (forward-backward, limited-memory BFGS) on a bounded sample of labelled documents (``TRAIN_DOCS``); a line's
training label is the quality label of its document. Of a document of more than ``TRAIN_LINES`` lines, a window of so many
consecutive lines is in the sample, at a place that a checksum of the text gives. Viterbi decoding labels the lines of
every document; a document stays if the lines marked content hold at least ``CONTENT_SHARE`` of the characters of its lines.

Defined results: null text has no words and fails the base rule, and so does text with fewer than ``MIN_WORDS`` words;
repeated rows each get a row; an empty table gives an empty result; further columns are ignored. Without any usable
label the field is neutral and the verdict is the base rule's. Ids keep their type.
"""

from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.text import UPPER, encoded, map_batches, text_column, type_of

MIN_WORDS, MAX_REPEAT = 50, 50
CONTENT_SHARE = 0.5
#: The training sample: documents (in expectation, dealt by hash) and lines of each.
TRAIN_DOCS, TRAIN_LINES = 2000, 128
#: The fit: most steps, least gradient, gradients remembered, weight of the penalty.
STEPS, STILL, MEMORY, L2 = 100, 1e-6, 8, 1e-3
SYMBOLS = b"#*$%&|<>"
DIGITS = b"0123456789"
N_FEATURES = 12
#: Bytes that go on with a character.
_GO_ON = bytes(range(0x80, 0xC0))


def repeat_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more."""
    n = len(words)
    if n < 4:
        return 0
    index: dict[bytes, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, n)
    k = len(index)
    pair = ids[:-1] * k + ids[1:]
    if k > 2_000_000:  # a third factor would not fit 64 bits
        pair = np.unique(pair, return_inverse=True)[1]
    window = pair[:-1] * k + ids[2:]
    order = np.argsort(window, kind="stable")
    ranked = window[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(window), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    covered[:-2] |= twice
    covered[1:-1] |= twice
    covered[2:] |= twice
    return int(covered.sum())


def counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    if not text:
        return 0, 0, 0, 0, 0
    raw = encoded(text)
    words = raw.split()
    blank = len(raw) - len(raw.translate(None, b"\t\n\v\f\r "))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.split()]
    return len(words), len(text) - blank, symbols, len(lines) - len(set(lines)), repeat_words(words)


def line_features(raw: bytes) -> tuple[list[int], list[tuple]]:
    """Lengths in characters and features of the lines that hold a word; shares are of characters."""
    sizes, rows, seen = [], [], set()
    plain = raw.isascii()
    for line in raw.split(b"\n"):
        words = line.split()
        if not words:
            continue
        size, w = len(line), len(words)
        upper = size - len(line.translate(None, UPPER))
        symbols = size - len(line.translate(None, SYMBOLS))
        digits = size - len(line.translate(None, DIGITS))
        n = size if plain else len(line.translate(None, _GO_ON))
        wide = len(set(words))
        rows.append(
            (
                1.0,
                min(w, 40) / 40,
                w < 4,
                upper / n,
                upper * 3 > n,
                symbols / n,
                symbols * 20 > n,
                digits / n,
                line.count(b"|") > 1,
                line[-1:] in b".?!",
                line in seen,
                1 - wide / w,
            )
        )
        sizes.append(n)
        seen.add(line)
    return sizes, rows


class Field:
    """Two-label linear-chain CRF: ``w`` scores content against boilerplate, ``trans`` scores label pairs."""

    def __init__(self, w: np.ndarray, trans: np.ndarray):
        self.w, self.trans = w, trans

    @classmethod
    def fit(cls, docs: list[tuple[np.ndarray, int]]) -> "Field":
        """``docs``: feature rows and the label of all their lines."""
        docs = [(x, y) for x, y in docs if len(x)]
        if len({y for _, y in docs}) < 2:
            return cls(np.zeros(N_FEATURES), np.zeros((2, 2)))
        y = np.array([label for _, label in docs])
        # both classes weigh the same, whatever their shares in the sample; so do the documents of a class
        weight = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum()) / [len(x) for x, _ in docs]
        # documents of like length are stacked, so that little is padded
        order = sorted(range(len(docs)), key=lambda i: len(docs[i][0]))
        stacks, at = [], 0
        while at < len(order):
            length = 2 * len(docs[order[at]][0])
            group = [i for i in order[at:] if len(docs[i][0]) <= length]
            at += len(group)
            stacks.append(cls._stack([docs[i][0] for i in group], y[group], weight[group]))
        theta = _least(lambda t: cls._loss(t, stacks), np.zeros(N_FEATURES + 4))
        return cls(theta[:N_FEATURES].copy(), theta[N_FEATURES:].reshape(2, 2).copy())

    @staticmethod
    def _stack(rows: list[np.ndarray], y: np.ndarray, weight: np.ndarray) -> tuple:
        length = max(map(len, rows))
        x, on = np.zeros((len(rows), length, N_FEATURES)), np.zeros((len(rows), length), bool)
        for i, own in enumerate(rows):
            x[i, : len(own)], on[i, : len(own)] = own, True
        return x, on, y, weight

    @classmethod
    def _loss(cls, theta: np.ndarray, stacks: list[tuple]) -> tuple[float, np.ndarray]:
        """Penalised negative log likelihood, weighted, and its gradient."""
        w, trans = theta[:N_FEATURES], theta[N_FEATURES:].reshape(2, 2)
        loss, slope = 0.5 * L2 * float(theta @ theta), L2 * theta
        for x, on, y, weight in stacks:
            score = x @ w
            node, pairs, logz = cls._marginals(score, trans, on)
            lines = on.sum(axis=1)
            own = np.where(y == 1, (score * on).sum(axis=1), 0.0) + (lines - 1) * trans[y, y]
            loss += float(weight @ (logz - own))
            wrong = (node - y[:, None]) * on * weight[:, None]
            slope[:N_FEATURES] += wrong.ravel() @ x.reshape(-1, N_FEATURES)
            for a in (0, 1):
                for b in (0, 1):
                    seen = (lines - 1) * ((y == a) & (y == b))
                    slope[N_FEATURES + 2 * a + b] += float(weight @ (pairs[:, a, b] - seen))
        return loss, slope

    @staticmethod
    def _marginals(score: np.ndarray, trans: np.ndarray, on: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """P(content) of each line, the expected number of each pair of neighbours, and log Z, by scaled forward-backward."""
        b, t = score.shape
        top = np.maximum(score, 0.0)
        node = np.exp(np.stack([-top, score - top], axis=2))
        step = np.exp(trans - trans.max())
        ahead, back, scale = np.empty((b, t, 2)), np.ones((b, t, 2)), np.ones((b, t))
        now = node[:, 0]
        scale[:, 0] = now.sum(axis=1)
        ahead[:, 0] = now / scale[:, :1]
        for i in range(1, t):
            now = (ahead[:, i - 1] @ step) * node[:, i]
            scale[:, i] = now.sum(axis=1)
            ahead[:, i] = now / scale[:, i, None]
        for i in range(t - 2, -1, -1):
            nxt = ((node[:, i + 1] * back[:, i + 1]) @ step.T) / scale[:, i + 1, None]
            back[:, i] = np.where(on[:, i + 1, None], nxt, 1.0)
        both = ahead * back
        both /= both.sum(axis=2, keepdims=True)
        ends = (node * back)[:, 1:] * (on[:, 1:] / scale[:, 1:])[:, :, None]
        pairs = np.einsum("bia,ac,bic->bac", ahead[:, :-1], step, ends, optimize=True) if t > 1 else np.zeros((b, 2, 2))
        logz = ((np.log(scale) + top) * on).sum(axis=1) + (on.sum(axis=1) - 1) * trans.max()
        return both[:, :, 1], pairs, logz

    def decode(self, x: np.ndarray) -> list[int]:
        """Viterbi labels of the lines of one document; ties go to content."""
        (t00, t01), (t10, t11) = self.trans.tolist()
        low, high, back = 0.0, 0.0, []
        for i, s in enumerate((x @ self.w).tolist()):
            if i:
                from_low, from_high = low + t01 > high + t11, low + t00 > high + t10
                low, high = (low + t00 if from_high else high + t10), (low + t01 if from_low else high + t11) + s
                back.append((0 if from_high else 1, 0 if from_low else 1))
            else:
                high = s
        label = 1 if high >= low else 0
        out = [label]
        for pair in reversed(back):
            label = pair[label]
            out.append(label)
        return out[::-1]


def _least(loss, x: np.ndarray) -> np.ndarray:
    """Where a smooth convex function, given with its gradient, is least: limited-memory BFGS with backtracking."""
    value, slope = loss(x)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(STEPS):
        if np.abs(slope).max() < STILL:
            break
        way, kept = -slope, []
        for s, d in reversed(past):
            a = float(s @ way) / float(s @ d)
            kept.append(a)
            way = way - a * d
        if past:
            s, d = past[-1]
            way = way * (float(s @ d) / float(d @ d))
        for (s, d), a in zip(past, reversed(kept), strict=True):
            way = way + s * (a - float(d @ way) / float(s @ d))
        fall, size = float(slope @ way), 1.0
        while size > 1e-10:
            new, new_slope = loss(x + size * way)
            if new <= value + 1e-4 * size * fall:
                break
            size /= 2
        else:
            break
        moved, change = size * way, new_slope - slope
        if float(moved @ change) > 1e-12:
            past = [*past, (moved, change)][-MEMORY:]
        x, value, slope = x + moved, new, new_slope
    return x


def sampled(raw: bytes) -> np.ndarray:
    """Features of a text's lines for the fit: ``TRAIN_LINES`` consecutive ones at most."""
    lines = line_features(raw)[1]
    start = crc32(raw) % (len(lines) - TRAIN_LINES + 1) if len(lines) > TRAIN_LINES else 0
    return np.array(lines[start : start + TRAIN_LINES], np.float32)


def fit(docs: DataFrame, labels: DataFrame) -> Field:
    """Fit the field on about ``TRAIN_DOCS`` labelled documents, chosen by a hash of their id."""
    usable = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    n = usable.count()
    if not n:
        return Field(np.zeros(N_FEATURES), np.zeros((2, 2)))
    share = min(1.0, TRAIN_DOCS / n)
    chosen = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    # the sample is bounded, so this side may be broadcast
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", F.col("quality").cast("long"))

    def make():
        def work(batch):
            found = [sampled(encoded(text)).tobytes() for text in batch.column(0).to_pylist()]
            return [pa.array(found, pa.binary()), batch.column(1)]

        return work

    sample = map_batches(rows, make, "x binary, y long").collect()
    # sorted, so that the sums of the fit don't depend on the order of tasks
    pairs = sorted((bytes(r.x), r.y) for r in sample)
    return Field.fit([(np.frombuffer(x, np.float32).reshape(-1, N_FEATURES).astype(float), y) for x, y in pairs])


def judged(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the base counts, ``base_failed``, ``content_share`` and ``kept``."""

    def make():
        def work(batch):
            rows, shares = [], []
            for text in batch.column(1).to_pylist():
                rows.append(counts(text))
                sizes, x = line_features(encoded(text))
                marks = field.decode(np.array(x, float)) if x else []
                total = sum(sizes)
                shares.append(sum(s for s, m in zip(sizes, marks, strict=True) if m) / total if total else 0.0)
            return [batch.column(0), *(list(c) for c in (zip(*rows, strict=True) if rows else ((),) * 5)), shares]

        return work

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    longs = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
    out = map_batches(rows, make, f"doc_id {type_of(rows, 'doc_id')}, {longs}, content_share double")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("content_share") >= CONTENT_SHARE))


def kept_rows(docs: DataFrame, field: Field) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns; each text is judged where it lies, without a shuffle."""
    return docs.where(text_column(F.col("text"), lambda: lambda text: verdict(text, field), "boolean"))


def verdict(text: str | None, field: Field) -> bool:
    n_words, _, _, _, repeated = counts(text)
    if n_words < MIN_WORDS or 100 * repeated > MAX_REPEAT * n_words:
        return False
    sizes, x = line_features(encoded(text))
    marks = field.decode(np.array(x, float))
    return sum(s for s, m in zip(sizes, marks, strict=True) if m) >= CONTENT_SHARE * sum(sizes)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    field = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judged(docs, field)
