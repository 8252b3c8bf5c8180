"""Sharding by a permutation-filled lookup table.

Each shard has its own order of preference over the slots of a table of prime size (offset and stride from a hash of its
name, so the order is a permutation). Shards take turns; each claims the free slot that it prefers most, until the table
is full. Shares differ by at most one slot, and when a shard goes or comes few slots change hands. A key's shard is
the entry of the slot that the key's hash gives: one lookup in a table whose size is fixed, which is broadcast.

Defined results: null keys count as the empty string and are placed like it; equal keys share a shard; repeated rows each
get a row; an empty table gives an empty result; other columns are kept by ``placed``, but a column that has one of the
added names (in any case) is replaced by the added one, also where it is the key itself.
"""

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHARDS = tuple(f"shard-{i:03d}" for i in range(64))
#: A prime, about a thousand slots for each shard; also the bound of what is broadcast.
SLOTS, MAX_SLOTS = 65537, 1_000_003


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def lookup_table(shards=SHARDS, slots: int = SLOTS) -> list[int]:
    """The index of the shard in each slot."""
    if len(set(shards)) < len(shards) or not shards:
        raise ValueError("shards must be named, each once")
    if not len(shards) <= slots <= MAX_SLOTS or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError(f"the number of slots must be a prime from the number of shards to {MAX_SLOTS}")
    place = [_number(f"offset:{s}") % slots for s in shards]
    stride = [1 + _number(f"stride:{s}") % (slots - 1) for s in shards]
    table, left = [-1] * slots, slots
    while True:
        for i in range(len(shards)):
            while table[place[i]] >= 0:
                place[i] = (place[i] + stride[i]) % slots
            table[place[i]] = i
            left -= 1
            if not left:
                return table


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """60 bits of the key's MD5, modulo the size of the table: stable over engines and versions."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long"), F.lit(slots)).cast("long")


def table_frame(spark: SparkSession, shards=SHARDS, slots: int = SLOTS) -> DataFrame:
    """``slot, shard``: the lookup table as rows, made from one literal on the JVM."""
    entries = F.split(F.lit(",".join(map(str, lookup_table(shards, slots)))), ",")
    rows = spark.range(1, numPartitions=1).select(F.posexplode(entries).alias("slot", "i"))
    name = F.element_at(F.array(*map(F.lit, shards)), F.col("i").cast("int") + 1)
    return rows.select(F.col("slot").cast("long"), name.alias("shard"))


def placed(df: DataFrame, key: str, shards=SHARDS, slots: int = SLOTS) -> DataFrame:
    """``df`` with ``slot`` and ``shard``; no shuffle."""
    table = table_frame(df.sparkSession, shards, slots)  # at most MAX_SLOTS rows
    kept = [c for c in df.columns if c.lower() not in ("slot", "shard")]
    rows = df.select(slot_of(F.col(key), slots).alias("slot"), *kept)
    return rows.join(F.broadcast(table), "slot").select(*kept, "slot", "shard")


def write_sharded(df: DataFrame, key: str, path: str, shards=SHARDS, files: int = 1) -> None:
    """One folder for each shard, of ``files`` files each at most; rows of a shard are dealt by their slot."""
    part = F.pmod(F.xxhash64("slot"), F.lit(files))
    placed(df, key, shards).repartition(len(shards) * files, F.col("shard"), part).write.partitionBy("shard").parquet(path)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return placed(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id"), "doc_id")


ORACLE = f"""
WITH t AS (SELECT unnest(range({SLOTS}))::BIGINT AS slot, unnest([{",".join(map(str, lookup_table()))}]) AS i)
SELECT doc_id, slot, printf('shard-%03d', i) AS shard
FROM (SELECT doc_id, (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % {SLOTS})::BIGINT AS slot FROM documents)
JOIN t USING (slot)
"""
