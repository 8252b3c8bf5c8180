"""Secret scans: fixed patterns, and a guess-cost measure for values that stand in a credential context.

The cost of a value is the least sum over all its segmentations, found by dynamic programming, of the log10 number of
guesses of each segment: a word (by its rank in a vocabulary, with capitals and letter swaps), a date or year, a repeated
character, the block before once more, a walk over neighbouring keys, a sequence, or brute force. A run may be cut anywhere:
all its ends count, not only the longest one. A value whose cost reaches ``MIN_GUESSES`` digits is a secret; placeholders
such as ``changeme123`` cost little.

Words are ranked by ``WORDS`` and then by the whole words of a public tokenizer's vocabulary, which is in order of frequency.

Defined results: null text counts as empty and has no spans; repeated rows each get a row; an empty table gives an
empty result; further columns are ignored; ids keep their type. Spans are code point offsets, end exclusive. A guessed span
may overlap base spans but always reaches beyond them.
"""

import math
import re

import public_tokenizers
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.bpe import VOCABULARY, ranks_of
from strandline.llm.text import free_name, map_batches, text_column, type_of

KINDS = ("assign", "access", "hex", "guess")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 12, 18, 16
#: log10 of the guesses from which a value counts as a secret.
MIN_GUESSES = 8.0
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
#: Contexts that announce a credential; wider than ASSIGN, and with any printable value. The keyword may stand inside an
#: identifier; only ``pass`` needs a separator behind it, as many words of prose start with it.
CONTEXT = re.compile(
    r"""(?:pass(?:(?:word|wd|phrase|code)[\w.-]{0,64}+|[\d_.-][\w.-]{0,64}+)?"""
    r"""|(?:pwd|secret|token|api[_-]?key|credential|auth[_-]?key|access[_-]?key|private[_-]?key)[\w.-]{0,64}+)"""
    r"""["']?[\x20\t]*(?:[:=]|=>|:=|\bis\b)[\x20\t]*["'`]?([^\s"'`,;<>()\[\]{}]{6,})""",
    re.IGNORECASE | re.ASCII,
)
_HINTS = ("pass", "pwd", "secret", "token", "api", "credential", "key")

# Common words of guessed passwords and placeholders.
WORDS = """password passwd pass secret token admin root user login welcome letmein master dragon monkey shadow sunshine
princess football baseball superman batman trustno hello freedom whatever qazwsx michael jordan jennifer hunter
changeme change example sample dummy test testing default placeholder your here enter insert none null true false
string value key api demo guest public private access temp temporary summer winter spring autumn love money computer
internet server database redacted hidden required optional""".split()
# Rows of a keyboard, for walks.
KEY_ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")

_SWAPS = str.maketrans("@4301$57!", "aaeoissti")
_DATE = re.compile(r"(?:19|20)\d\d(?:[-/._]?(?:0[1-9]|1[0-2])(?:[-/._]?(?:0[1-9]|[12]\d|3[01]))?)?|(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)\d\d")
#: Lengths of dates, of blocks that may be repeated, the shortest word, and the shortest run of each kind.
DATE_SIZES, LEAST_BLOCK, MOST_BLOCK, LEAST_WORD, LEAST_RUNS = (4, 6, 7, 8, 9, 10), 2, 8, 3, (3, 3, 4)


def ranked_words(path: str | None = None) -> dict[str, int]:
    """Ranks of ``WORDS`` and then of the whole words of the tokenizer's vocabulary."""
    with open(path or public_tokenizers.path(VOCABULARY), "rb") as f:
        ranks = ranks_of(f.read())
    out = {w: i + 1 for i, w in enumerate(WORDS)}
    for token in sorted(ranks, key=ranks.get):
        if re.fullmatch(rb" [A-Za-z]{3,}", token):
            out.setdefault(token[1:].decode().lower(), len(out) + 1)
    return out


def _beside() -> dict[str, str]:
    near: dict[str, set] = {}
    for y, row in enumerate(KEY_ROWS):
        for x, c in enumerate(row):
            for dy, dx in ((0, 1), (0, -1), (1, 0), (1, -1), (-1, 0), (-1, 1)):
                if 0 <= y + dy < len(KEY_ROWS) and 0 <= x + dx < len(KEY_ROWS[y + dy]):
                    near.setdefault(c, set()).add(KEY_ROWS[y + dy][x + dx])
    return {c: "".join(sorted(v)) for c, v in near.items()}


_NEAR = _beside()


def _alphabet(value: str) -> int:
    size = 0
    for found, n in ((any(c.islower() for c in value), 26), (any(c.isupper() for c in value), 26), (any(c.isdigit() for c in value), 10)):
        size += n * found
    return size + 33 * any(not c.isalnum() for c in value) or 10


def run_cost(kind: int, size: int, brute: float) -> float:
    """Cost of a run of a character (0), of a sequence (1) or of a walk (2). Each is concave in the size."""
    if kind == 0:
        return brute + math.log10(size)
    if kind == 1:
        return 1.5 + math.log10(size)
    return 2.0 + 0.3 * math.sqrt(size) + math.log10(size)


def word_cost(rank: int, part: str, plain: str) -> float:
    low = part.lower()
    return math.log10(1 + rank) + 0.5 * ((part != low) + (low != plain))


class Scanner:
    """Spans of texts, by the fixed patterns and by the cost of guessing with the words ``ranks``."""

    def __init__(self, ranks: dict[str, int]):
        self.ranks, self.longest = ranks, max(map(len, ranks), default=0)

    def cost(self, value: str, enough: float = math.inf) -> float:
        """log10 of the guesses that the cheapest segmentation of ``value`` takes.

        If no segmentation can stay below ``enough`` any more, a number from there on. Of a run's starts only those are
        held that may still be the best one: as the cost of a run is concave in its size, an early start that has
        caught up with a later one stays ahead of it, and one that has cost more by itself never will.
        """
        n = len(value)
        if not n:
            return 0.0
        low = value.lower()
        if len(low) != n:  # a letter whose small form is longer
            low = "".join(c.lower() if len(c.lower()) == 1 else c for c in value)
        plain = low.translate(_SWAPS)
        brute = math.log10(_alphabet(value))
        back = max(self.longest, MOST_BLOCK, *DATE_SIZES)
        best = [0.0] + [math.inf] * n
        sizes, starts = [1, 1, 1], ([], [], [])
        for end in range(1, n + 1):
            i = end - 1
            cost = best[i] + brute
            if i:
                d = ord(value[i]) - ord(value[i - 1])
                same_step = sizes[1] == 1 or d == ord(value[i - 1]) - ord(value[i - 2])
                sizes[0] = sizes[0] + 1 if d == 0 else 1
                sizes[1] = 1 if d not in (1, -1) else sizes[1] + 1 if same_step else 2
                sizes[2] = sizes[2] + 1 if low[i] in _NEAR.get(low[i - 1], "") else 1
            for kind, size in enumerate(sizes):
                if size < LEAST_RUNS[kind]:
                    starts[kind].clear()
                    continue
                held: list[tuple[float, int]] = []
                for j in (*starts[kind], end - LEAST_RUNS[kind]):
                    now = best[j] + run_cost(kind, end - j, brute)
                    if held and held[-1][0] <= now:
                        continue
                    while held and best[held[-1][1]] >= best[j]:
                        held.pop()
                    held.append((now, j))
                starts[kind][:] = [j for _, j in held]
                cost = min(cost, held[-1][0])
            for size in range(LEAST_WORD, min(self.longest, end) + 1):
                rank = self.ranks.get(plain[end - size : end])
                if rank:
                    cost = min(cost, best[end - size] + word_cost(rank, value[end - size : end], plain[end - size : end]))
            for size in DATE_SIZES:
                if size <= end and _DATE.fullmatch(value, end - size, end):
                    cost = min(cost, best[end - size] + (2.0 if size == 4 else 4.3))
            for size in range(LEAST_BLOCK, min(MOST_BLOCK, end // 2) + 1):  # the block before, once more
                if value[end - size : end] == value[end - 2 * size : end - size]:
                    cost = min(cost, best[end - size] + 0.6)
            best[end] = cost
            if end % back == 0 and cost >= enough:
                # every later segment starts at one of these places
                least = min(min(best[end - back : end + 1]), min((best[j] for s in starts for j in s), default=math.inf))
                if least >= enough:
                    return least
        return best[n]

    def guessed(self, text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """Values in a credential context that cost at least ``MIN_GUESSES`` and that base spans don't cover whole."""
        low = text.lower()
        if not any(h in low for h in _HINTS):
            return []
        out, whole, at = [], united(base), 0
        for m in CONTEXT.finditer(text):
            a, b = m.span(1)
            value = m[1].rstrip(".!?:")
            b = a + len(value)
            while at < len(whole) and whole[at][1] < b:  # both lists go forward
                at += 1
            inside = at < len(whole) and whole[at][0] <= a
            if len(value) >= 6 and not inside and self.cost(value, MIN_GUESSES) >= MIN_GUESSES:
                out.append((a, 3, b))
        return out

    def spans(self, text: str | None) -> list[tuple[int, int, int]]:
        """(start, kind index, end) of all spans, sorted."""
        if not text:
            return []
        base = base_spans(text)
        return sorted(base + self.guessed(text, base))

    def redact(self, text: str | None, mark: str = "[SECRET]") -> str | None:
        """The text with every span, or union of spans that overlap or touch, replaced by ``mark``."""
        spans = united(self.spans(text))
        if not spans:
            return text
        out, at = [], 0
        for s, e in spans:
            out += [text[at:s], mark]
            at = e
        return "".join([*out, text[at:]])


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of the base patterns, sorted."""
    low = text.lower()
    out = []
    if "passw" in low or "secret" in low or "token" in low or "api" in low:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def united(spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Unions (start, end) of sorted spans that overlap or touch."""
    out: list[tuple[int, int]] = []
    for s, _, e in spans:
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out


def named(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _sent(spark: SparkSession) -> Broadcast:
    """The ranked words: a table of the size of a vocabulary file."""
    return spark.sparkContext.broadcast(ranked_words())


def scanned(docs: DataFrame) -> DataFrame:
    """``doc_id, spans``: the spans of each document as structs of start, kind and end."""
    sent = _sent(docs.sparkSession)

    def make():
        scanner = Scanner(sent.value)

        def work(batch):
            found = [scanner.spans(t) for t in batch.column(1).to_pylist()]
            return [batch.column(0), [[{"start": s, "kind": KINDS[k], "end": e} for s, k, e in x] for x in found]]

        return work

    rows = docs.select("doc_id", F.col("text").cast("string"))
    return map_batches(rows, make, f"doc_id {type_of(rows, 'doc_id')}, spans array<struct<start:int,kind:string,end:int>>")


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with secrets replaced; every row stays, ``n_chars`` follows the text. No shuffle."""
    sent = _sent(docs.sparkSession)
    name = free_name(docs, "_clean")
    out = docs.withColumn(name, text_column(F.col("text"), lambda: Scanner(sent.value).redact, "string"))
    if "n_chars" in docs.columns:
        length = F.length(name).cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col(name) != F.col("text"), length).otherwise(F.col("n_chars")))
    return out.withColumn("text", F.col(name)).select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scanned(spark.read.parquet(f"{sf_dir}/documents.parquet"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"] != "guess")
    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{k}") for k in KINDS[:3]),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
