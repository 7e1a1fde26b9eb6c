"""Sharding by weighted rendezvous hashing.

A row's key draws a number for every shard from a hash of (key, shard); the
shard with the best weighted number gets the row.  Key and shards alone
decide, so one more shard takes rows only into itself (about its share) and a
removed one hands its rows to all others.  All of it is column expressions.

With u uniform in (0, 1), the shard with the least -ln(u) / weight wins with
a chance of its weight's share.  Ties (equal numbers) go to the lower shard.

Defined cases: a null key is a key of its own; a null text counts as no bytes
and has the checksum of an empty one; rows that repeat a key share its shard
and get slots of their own; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from potluck.llm.common import numbered, written


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """The shard (int) of a key among ``len(weights)`` shards."""
    if not weights or min(weights) <= 0:
        raise ValueError("every shard needs a weight above zero")
    text = F.coalesce(key.cast("string"), F.lit("null"))
    draws = []
    for shard, weight in enumerate(weights):
        # 53 bits of the hash, moved off zero: 0 < u < 1
        u = (F.shiftrightunsigned(F.xxhash64(F.lit(shard), text, key.isNull()), 11).cast("double") + F.lit(0.5)) * F.lit(2.0 ** -53)
        draws.append(F.struct((-F.log(u) / F.lit(float(weight))).alias("d"), F.lit(shard).alias("s")))
    return (F.least(*draws) if len(draws) > 1 else draws[0])["s"].cast("int")


def shard_rows(df: DataFrame, key: str, text: str, weights: Sequence[float], new_weight: float | None = None,
               overhead: int = 8) -> DataFrame:
    """key, size, text_crc32, shard, slot and grown_shard of every row.

    ``new_weight``: the weight of the shard that ``grown_shard`` adds (by
    default as much as the mean).  The slots of a shard are gapless from 0.
    """
    new = new_weight or sum(weights) / len(weights)
    body = F.coalesce(F.col(text), F.lit(""))
    narrow = df.select(
        F.col(key).alias("key"), (F.octet_length(body).cast("long") + F.lit(overhead)).alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"), shard_of(F.col(key), weights).alias("shard"),
        shard_of(F.col(key), [*weights, new]).alias("grown_shard"), F.monotonically_increasing_id().alias("rid"))
    return numbered(written(narrow, "shards"), "shard", "rid", "slot").drop("rid")
