"""Shard placement by a permutation-filled lookup table.

Each shard orders the slots of a prime-sized table by a permutation of its own (an offset and a step, hashed from
its name); shards take turns claiming their next free slot until the table is full. A key's slot is its hash modulo
the table's size. The table has SLOTS rows whatever the input, so it is broadcast, and placing a key is one lookup.

A null key is placed like any other value (all null keys together); equal keys share a shard. An empty table gives
an empty result, and columns named slot or shard are replaced.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from splatframe.llm.common import table

SHARDS, SLOTS = 64, 65_537


def _number(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.blake2b(f"{salt}:{name}".encode(), digest_size=8).digest(), "big")


def lookup_table(names: list[str], slots: int = SLOTS, weights: dict[str, int] | None = None) -> list[int]:
    """For each slot the index of its shard in names; a shard of weight w claims w slots a turn."""
    if not names or len(set(names)) != len(names):
        raise ValueError("shard names must be given and differ")
    if slots < len(names) or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("the number of slots must be a prime not below the number of shards")
    where = [_number(n, "offset") % slots for n in names]
    step = [_number(n, "skip") % (slots - 1) + 1 if slots > 1 else 0 for n in names]
    turn = [k for k, n in enumerate(names) for _ in range((weights or {}).get(n, 1))]
    filled, left = [-1] * slots, slots
    while left:
        for k in turn:
            at = where[k]
            while filled[at] >= 0:
                at = (at + step[k]) % slots
            filled[at], where[k], left = k, (at + step[k]) % slots, left - 1
            if not left:
                break
    return filled


def place(df: DataFrame, key: str, names: list[str], slots: int = SLOTS, weights: dict[str, int] | None = None) -> DataFrame:
    """Adds slot and shard (its name) to every row."""
    spark = df.sparkSession
    filled = lookup_table(names, slots, weights)
    lookup = spark.createDataFrame([(s, names[k]) for s, k in enumerate(filled)], "slot int, shard string")
    keyed = df.drop("slot", "shard").withColumn("slot", F.pmod(F.xxhash64(F.col(key)), F.lit(slots)).cast("int"))
    return keyed.join(F.broadcast(lookup), "slot").select(*[c for c in keyed.columns if c != "slot"], "slot", "shard")


def write_shards(placed: DataFrame, path: str, files_per_shard: int = 8) -> None:
    """A folder per shard; its rows are dealt to several tasks, so a large shard is not one task's."""
    salted = placed.repartition("shard", F.pmod(F.xxhash64(*[c for c in placed.columns if c != "shard"]), F.lit(files_per_shard)))
    salted.write.partitionBy("shard").parquet(path)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    return place(docs, "doc_id", [f"shard-{k:03d}" for k in range(SHARDS)])
