"""Sharding by a permutation-filled lookup table.

Every shard has its own preference order over the slots of a prime-sized table
(offset and step from hashes of its name; a prime size makes every step a full
permutation). The shards take turns: each claims its next free preferred slot until
the table is full, so slot counts differ by one at most and removing a shard moves
little besides its own slots. The table depends on the shard names and its size
alone, never on the data; it is broadcast (``table_size`` rows, at most
``MAX_TABLE``) and a document's shard is one lookup by key hash.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from baobab.llm._text import fresh, whole

TABLE_SIZE = 8191
MAX_TABLE = 1_000_003


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def preference(shard: str, size: int) -> tuple[int, int]:
    """(first slot, step) of a shard's preference order."""
    digest = hashlib.md5(shard.encode()).hexdigest()
    return int(digest[:15], 16) % size, int(digest[15:30], 16) % (size - 1) + 1


def fill_table(shards: list[str], size: int = TABLE_SIZE) -> list[int]:
    """Shard number of every slot."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct names, at least one")
    if not _is_prime(size) or size < len(shards) or size > MAX_TABLE:
        raise ValueError(f"table size must be a prime from {len(shards)} to {MAX_TABLE}")
    # A table of one or two slots has one step only; every order is then its offset.
    walks = [preference(s, size) for s in shards]
    reached = [0] * len(shards)
    table, free = [-1] * size, size
    while free:
        for i, (first, step) in enumerate(walks):
            if not free:
                break
            while True:
                slot = (first + reached[i] * step) % size
                reached[i] += 1
                if table[slot] < 0:
                    table[slot] = i
                    free -= 1
                    break
    return table


def lookup_table(spark: SparkSession, table: list[int]) -> DataFrame:
    """(slot, shard) rows, made from one literal in the JVM."""
    numbers = F.split(F.lit(",".join(map(str, table))), ",").cast("array<int>")
    return spark.range(1).select(F.posexplode(numbers).alias("slot", "shard"))


def slot_column(doc_id: str, text: str, size: int):
    """Slot of a row: from its id, or from its text where the id is null, so that
    rows without an id do not share one shard."""
    name = F.coalesce(F.col(doc_id).cast("string"), F.concat(F.lit("t"), whole(F.col(text))))
    return F.pmod(F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("bigint"), F.lit(size)).cast("int")


def place(docs: DataFrame, shards: list[str], size: int = TABLE_SIZE, doc_id: str = "doc_id",
          text: str = "text", out: str = "shard") -> DataFrame:
    """``docs`` with the shard number of each row in column ``out``.

    A null id is placed by its text, null text counts as empty, repeated rows share a
    shard, an empty table stays empty. An existing column named ``out`` is replaced.
    """
    slot, s_slot, s_shard = fresh(docs, "slot", "table_slot", "table_shard")
    lookup = lookup_table(docs.sparkSession, fill_table(shards, size)).toDF(s_slot, s_shard)
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() != out.lower()]
    return (docs.withColumn(slot, slot_column(doc_id, text, size))
            .join(F.broadcast(lookup), F.col(slot) == F.col(s_slot), "left")
            .select(*kept, F.col(s_shard).alias(out)))


def write_shards(placed: DataFrame, path: str, shard: str = "shard") -> None:
    """One folder per shard; each task writes its own files, no shard meets in one task."""
    placed.write.mode("overwrite").partitionBy(shard).parquet(path)
