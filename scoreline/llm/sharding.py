"""Shard placement by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime
size: an offset and a skip, both from its name. The shards take turns; a shard
claims the first slot of its order that is still free, and heavier shards take
more turns. A key's slot is its hash modulo the size, so that placement is one
lookup, and a shard that comes or goes moves few other slots.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import unused

#: Slots of the table: a prime well above 100 slots per shard. Its rows bound what is broadcast.
SLOTS = 65_537
#: The shards of the registered query; one in eight has twice the capacity.
SHARDS = {f"shard-{i:03d}": 2 if i % 8 == 0 else 1 for i in range(128)}


def _number(name: str, use: str) -> int:
    return int.from_bytes(hashlib.sha256(f"{use}:{name}".encode()).digest()[:8], "big")


def lookup_table(shards: Mapping[str, int], slots: int = SLOTS) -> np.ndarray:
    """The position (in name order) of the shard that owns each slot.

    ``slots`` must be prime and at least the number of shards; weights are turns
    per round, at least one. The table depends on names and weights alone, not on
    the order in which they are given.
    """
    if slots < 2 or any(slots % p == 0 for p in range(2, int(slots**0.5) + 1)):
        raise ValueError("the number of slots must be prime")
    if not shards or len(shards) > slots or min(shards.values()) < 1:
        raise ValueError("need between one shard and as many as slots, with weights of at least one")
    names = sorted(shards)
    place = [_number(n, "offset") % slots for n in names]
    skip = [_number(n, "skip") % (slots - 1) + 1 for n in names]
    owner = np.full(slots, -1, dtype=np.int32)
    free = slots
    while free:
        for shard, name in enumerate(names):
            for _ in range(min(shards[name], free)):
                while owner[place[shard]] >= 0:
                    place[shard] = (place[shard] + skip[shard]) % slots
                owner[place[shard]] = shard
                free -= 1
    return owner


def assign_shards(docs: DataFrame, shards: Mapping[str, int], key: str = "doc_id", slots: int = SLOTS) -> DataFrame:
    """One row per row of ``docs``: key, slot, shard.

    The broadcast table has ``slots`` rows whatever the input. Rows with one key
    share a shard, a NULL key is placed like the empty text, and other columns are
    not read. An empty input gives no rows.
    """
    spark, names = docs.sparkSession, sorted(shards)
    table = spark.createDataFrame([(i, names[o]) for i, o in enumerate(lookup_table(shards, slots).tolist())], "slot INT, shard STRING")
    slot = F.pmod(F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit(""))), F.lit(slots)).cast("int")
    return docs.select(F.col(key), slot.alias("slot")).join(F.broadcast(table), "slot").select(key, "slot", "shard")


def write_shards(docs: DataFrame, shards: Mapping[str, int], path: str, key: str = "doc_id", files: int = 8) -> None:
    """Write the rows of ``docs`` in one folder per shard; each shard is dealt to ``files`` tasks by key."""
    placed, other, shard = assign_shards(docs.select(key).distinct(), shards, key), unused(docs, "_key"), unused(docs, "shard")
    placed = placed.select(F.col(key).alias(other), F.col("shard").alias(shard))
    deal = F.pmod(F.xxhash64(F.lit(1), F.col(key)), F.lit(files))
    joined = docs.join(placed, F.col(key).eqNullSafe(F.col(other))).drop(other)
    joined.repartition(shard, deal).write.partitionBy(shard).parquet(path)


def op6_shard_lookup(docs: DataFrame) -> DataFrame:
    return assign_shards(docs, SHARDS)
