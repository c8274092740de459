"""Operator 7, sharding by a permutation-filled lookup table.

Every shard has its own preference order of the slots of a prime-sized table
(an offset and a step, so that the order is a permutation). The shards take
turns; at its turn a shard claims the first slot of its order that is still
free. A row goes to the shard that holds slot ``hash(key) mod size``: one lookup
in a broadcast table, without a shuffle. All shards hold nearly the same
number of slots, and when a shard is added or removed few other slots move.

The rows are placed by SQL functions only. The table is a setting: it depends
on the shard names and the size, never on the data, and ``MAX_TABLE`` bounds it.

Nulls: a row with a NULL key is placed by the hash of NULL. Repeated rows go to
the same shard. An empty input gives an empty result. All input columns are
kept; a column that has the name of the result column is replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custlens.llm.common import fresh

TABLE_SIZE = 65_537
MAX_TABLE = 1_100_000
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def _preference(shard: str, size: int) -> tuple[int, int]:
    digest = hashlib.md5(shard.encode()).digest()
    offset = int.from_bytes(digest[:8], "big") % size
    step = int.from_bytes(digest[8:], "big") % (size - 1) + 1
    return offset, step


def slot_owners(shards: Sequence[str], size: int = TABLE_SIZE) -> list[int]:
    """For each slot the index of the shard that claims it."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shard names must be distinct, and one at least")
    if not _is_prime(size) or not len(shards) <= size <= MAX_TABLE:
        raise ValueError(f"size must be a prime from the number of shards to {MAX_TABLE}")
    orders = [_preference(s, size) for s in shards]
    position = [offset for offset, _ in orders]
    owner = [-1] * size
    free = size
    while free:
        for i, (_, step) in enumerate(orders):
            while owner[position[i]] >= 0:
                position[i] = (position[i] + step) % size
            owner[position[i]] = i
            free -= 1
            if not free:
                break
    return owner


def lookup_table(spark: SparkSession, shards: Sequence[str], size: int = TABLE_SIZE) -> DataFrame:
    """(slot, owner), ``size`` rows, as a literal that SQL takes apart."""
    text = ",".join(map(str, slot_owners(shards, size)))
    return spark.range(1, numPartitions=1).select(
        F.posexplode(F.split(F.lit(text), ",")).alias("slot", "owner")
    ).select("slot", F.col("owner").cast("int").alias("owner"))


def place(
    df: DataFrame,
    key: str = "doc_id",
    shards: Sequence[str] = SHARDS,
    size: int = TABLE_SIZE,
    out: str = "shard",
) -> DataFrame:
    """``df`` with the index of each row's shard in ``out``."""
    kept = [c for c in df.columns if c.lower() != out.lower()]
    slot, owner = fresh(df, "slot"), fresh(df, "owner")
    found = lookup_table(df.sparkSession, shards, size).toDF(slot, owner)
    slots = df.select(
        *[F.col(f"`{c}`") for c in kept],
        F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(size)).cast("int").alias(slot),
    )
    return slots.join(F.broadcast(found), slot).select(
        *[F.col(f"`{c}`") for c in kept], F.col(owner).alias(out)
    )
