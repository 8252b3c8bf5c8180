"""Token counts from pre-token counts, without materialising ids.

The piece model maps a space to U+2581 and puts one before the text; it normalises nothing else. No piece has that mark
after another character, and some characters stand in no piece of several characters at all. So merges never cross the
cuts of ``pre_tokens``: before a mark that follows another character, and around each character that never merges.
The count of a text is the sum of the counts of its pre-tokens; the model's own vocabulary gives the characters.

1. Frequencies of pre-tokens over the corpus: pre-aggregated in each batch, then by key.
2. Each distinct pre-token is counted once by the model.
3. The counts of at most ``COMMON`` of the most frequent pre-tokens are broadcast; a document's other pre-tokens are joined to the table
   of counts by key and summed. So no frequent key is ever shuffled per document, and no rare one is lost.

Defined results: null text counts as empty and has no tokens; repeated rows each get a row; null ids too; an empty table
gives an empty result; further columns are ignored; ids keep their type.
"""

import re
from collections import Counter

import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.bpe import vocabulary
from strandline.llm.text import map_batches, type_of
from strandline.storage import durable

MODEL, LIMIT = "piece_bpe_32k.model", 4096
MARK = "▁"
#: Bounds of the broadcast table of counts: so many pre-tokens of up to so many characters, and so many longer ones.
COMMON, COMMON_CHARS = 250_000, 32
LONG_COMMON, LONG_CHARS = 500, 10_000


def pre_token_pattern(model: sentencepiece.SentencePieceProcessor) -> re.Pattern:
    """The pattern whose matches partition a text (spaces as marks); it is derived from the vocabulary."""
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
    joined = [p for p in pieces if len(p) > 1]
    if any(MARK in p.lstrip(MARK) for p in joined):
        raise ValueError("a piece goes on over a space: texts can't be cut there")
    chars = "".join(map(re.escape, sorted(set("".join(joined)) - {MARK})))
    return re.compile(f"{MARK}*[{chars}]+|{MARK}+|[^{MARK}{chars}]", re.DOTALL)


class Counts:
    """A worker's model: pre-tokens of a text, tokens of a pre-token."""

    def __init__(self, data: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.find = pre_token_pattern(self.model).findall
        self.lead = len(self.model.encode("\n"))

    def pre_tokens(self, text: str | None) -> list[str]:
        return self.find(MARK + text.replace(" ", MARK)) if text else []

    def tokens(self, pre_tokens: list[str]) -> list[int]:
        # a line feed merges with nothing, so it shields the pre-token from the mark that the model puts first
        return [len(x) - self.lead for x in self.model.encode(["\n" + p for p in pre_tokens], num_threads=1)]


def counted(docs: DataFrame, path: str | None = None, common: int = COMMON) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` per document."""
    spark = docs.sparkSession
    sent = vocabulary(spark, path or public_tokenizers.path(MODEL))
    texts = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def make_seen():
        counts = Counts(sent.value)

        def work(batch):
            seen = Counter()
            for text in batch.column(0).to_pylist():
                seen.update(counts.pre_tokens(text))
            return [list(seen), list(seen.values())]

        return work

    def make_counted():
        counts = Counts(sent.value)

        def work(batch):
            own = batch.column(0).to_pylist()
            return [batch.column(0), batch.column(1), counts.tokens(own)]

        return work

    seen = map_batches(texts, make_seen, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    table = durable(map_batches(seen, make_counted, "piece string, n long, tokens int"), "piece-counts")
    size = F.length("piece")
    known = spark.sparkContext.broadcast(
        [
            _frequent(table.where(size <= COMMON_CHARS), common),
            _frequent(table.where((size > COMMON_CHARS) & (size <= LONG_CHARS)), min(common, LONG_COMMON)),
        ]
    )

    def make_summed():
        counts = Counts(sent.value)
        pairs = pa.concat_tables(map(_table, known.value))
        get = dict(zip(pairs["piece"].to_pylist(), pairs["tokens"].to_pylist(), strict=True)).get

        def work(batch):
            totals, rest = [], []
            for text in batch.column(1).to_pylist():
                total, rare = 0, Counter()
                for p in counts.pre_tokens(text):
                    n = get(p)
                    if n is None:
                        rare[p] += 1
                    else:
                        total += n
                totals.append(total)
                rest.append([{"piece": p, "times": n} for p, n in rare.items()])
            return [batch.column(0), batch.column(2), totals, rest]

        return work

    rows = docs.select(
        "doc_id",
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)).cast("long").alias("n_bytes"),
    )
    part = map_batches(rows, make_summed, f"doc_id {type_of(rows, 'doc_id')}, n_bytes long, known long, rest array<struct<piece:string,times:int>>")
    # a number for each row; the table is written, so that the numbers hold from here on
    part = durable(part.withColumn("row", F.monotonically_increasing_id()), "known-counts")
    rare = part.select("row", F.explode("rest").alias("r")).select("row", "r.piece", "r.times")
    more = rare.join(table.select("piece", "tokens"), "piece").groupBy("row").agg(F.sum(F.col("times") * F.col("tokens")).alias("more"))
    total = F.col("known") + F.coalesce("more", F.lit(0))
    return part.drop("rest").join(more, "row", "left").select("doc_id", "n_bytes", total.cast("long").alias("n_tokens"))


def _frequent(table: DataFrame, most: int) -> bytes:
    """At most ``most`` of the most frequent pieces and their counts, as an Arrow stream.

    A histogram of the frequencies (steps of a quarter of a power of two, a few hundred at most) gives the lowest
    frequency from which on there are so few pieces; no sort, and no more rows than that come to the driver.
    """
    step = F.floor(4 * F.log2("n")).cast("int")
    above, lowest = 0, None
    for r in table.groupBy(step.alias("step")).agg(F.count("*").alias("k")).orderBy(F.desc("step")).collect():
        above += r.k
        if above > most:
            break
        lowest = r.step
    got = table.where(step >= lowest) if lowest is not None else table.limit(0)
    found = got.select("piece", "tokens").toArrow()
    with pa.BufferOutputStream() as out:
        with pa.ipc.new_stream(out, found.schema) as writer:
            writer.write_table(found)
        return out.getvalue().to_pybytes()


def _table(stream: bytes) -> pa.Table:
    return pa.ipc.open_stream(stream).read_all()


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = counted(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.withColumn("over_limit", F.col("n_tokens") > LIMIT)
