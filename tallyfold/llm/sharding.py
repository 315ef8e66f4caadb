"""Shard placement by a permutation-filled lookup table, DataFrame functions only.

Shards take turns claiming slots of a prime-sized table, each in the order of
its own permutation (offset + k * skip modulo the size). The finished table is
an array of `slots` small integers, one literal that Spark broadcasts with the
tasks; placing a row is one hash and one array access, with no shuffle, whatever
key is hot. When a
shard leaves, nearly all other keys keep their places.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Prime, and over a hundred times the number of shards.
SLOTS = 7919
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))


def lookup_table(shards: tuple[str, ...] | list[str], slots: int = SLOTS) -> list[int]:
    """Index into `shards` for each slot; shares differ by one slot at most."""
    if not shards or len(set(shards)) != len(shards) or len(shards) > slots:
        raise ValueError("shards must be distinct, at least one, and no more than slots")
    if slots < 2 or any(slots % k == 0 for k in range(2, int(slots**0.5) + 1)):
        raise ValueError("slots must be prime")
    digest = lambda s, salt: int.from_bytes(hashlib.sha256(f"{salt}:{s}".encode()).digest()[:8], "big")
    at = [digest(s, "offset") % slots for s in shards]
    skip = [digest(s, "skip") % (slots - 1) + 1 for s in shards]
    table = [-1] * slots
    free = slots
    while free:
        for i in range(len(shards)):
            while table[at[i]] >= 0:
                at[i] = (at[i] + skip[i]) % slots
            table[at[i]] = i
            free -= 1
            if not free:
                break
    return table


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key: the first 60 bits of its MD5 modulo the table's size; null counts as empty."""
    digest = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15)
    return (F.conv(digest, 16, 10).cast("long") % F.lit(slots)).cast("int")


def place(docs: DataFrame, key_col: str = "doc_id", shards: tuple[str, ...] | list[str] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """`docs` with slot int and shard string.

    Equal keys share a shard; a null key has the place of the empty string.
    Rows are never moved or dropped; text of any length is left alone. slot and
    shard replace input columns of these names. An empty table stays empty.
    """
    table = F.split(F.lit(",".join(map(str, lookup_table(shards, slots)))), ",").cast("array<int>")  # folded to one literal
    names = F.array(*map(F.lit, shards))
    docs = docs.drop("slot", "shard")
    slot = slot_of(F.col(key_col), slots)
    return docs.select("*", slot.alias("slot")).withColumn("shard", F.element_at(names, F.element_at(table, F.col("slot") + 1) + 1))


def place_sql(shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> str:
    return f"""
SELECT doc_id, slot, ({list(shards)!r})[({lookup_table(shards, slots)!r})[slot + 1] + 1] AS shard FROM (
  SELECT doc_id, CAST(CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT) % {slots} AS INTEGER) AS slot FROM documents)"""
