"""Sharding by a permutation-filled lookup table (operator 10), in DataFrame functions only.

Every shard has a preference order over the slots of a prime-sized table:
``(offset + j * skip) mod size`` for j = 0, 1, ..., both from its name's MD5.
Shards take turns; in its turn a shard claims the first slot of its order that is
still free, until all slots are taken.  The table depends on the shards' names and
its size alone, not on any data, so it is filled once where the query is built.  A row
belongs to the shard of slot ``hash(key) mod size``, one look-up in a broadcast
table of ``size`` rows (a parameter, so its size is bounded).  Shards differ by at
most one slot, and removing a shard moves few slots besides its own.

Null keys hash as the empty text.  Equal keys always meet in one shard;
repeated rows each get a row.  An empty table gives no rows; a column named
like an output column is replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS = 6553  # a prime, about 100 slots a shard
SHARDS = 64


def hashed(text: Column) -> Column:
    """60 bits of a text's MD5 as a long."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def shard_names(shards: int) -> list[str]:
    return [f"shard-{i}" for i in range(shards)]


def filled_slots(names: Sequence[str], slots: int = SLOTS) -> list[int]:
    """The position in ``names`` of the shard that each slot of the table belongs to."""
    orders = []
    for name in names:
        digest = hashlib.md5(name.encode()).hexdigest()
        offset, skip = int(digest[:15], 16) % slots, int(digest[16:31], 16) % (slots - 1) + 1
        orders.append((slot % slots for slot in range(offset, offset + slots * skip, skip)))
    owner = [-1] * slots
    for turn in range(slots):
        shard = turn % len(names)
        claimed = next(slot for slot in orders[shard] if owner[slot] < 0)
        owner[claimed] = shard
    return owner


def lookup_table(spark: SparkSession, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """(slot, shard) of a table of ``slots`` (a prime) filled in turns by ``shards`` shards."""
    owners = F.split(F.lit(",".join(map(str, filled_slots(shard_names(shards), slots)))), ",").cast("array<int>")
    return spark.range(1).select(F.posexplode(owners).alias("slot", "shard"))


def place(df: DataFrame, key: str, table: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``df`` with the ``slot`` and ``shard`` of each row's key."""
    slot = (hashed(F.coalesce(F.col(key).cast("string"), F.lit(""))) % slots).cast("int")
    return df.drop("slot", "shard").withColumn("slot", slot).join(F.broadcast(table), "slot")
