"""W7 routing: shard number from routing key, else parent id, else ``_id``.

The hash is our own choice (tier P, not bit-compatible with any server): the
first 32 bits of the MD5 of the key, modulo the shard count. It is a pure
column expression (inside whole-stage codegen) and can be reproduced by other
SQL engines, which makes co-location checkable.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def routing_key(routing: str = "_routing", parent: str = "_parent", id_col: str = "_id") -> Column:
    return F.coalesce(F.col(routing), F.col(parent), F.col(id_col))


def shard_of(key: Column, n_shards: int) -> Column:
    h = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("long")
    return F.pmod(h, F.lit(n_shards)).cast("int")


def shard_of_value(key: str, n_shards: int) -> int:
    """Same hash for one literal key, so a point read can prune to one shard."""
    return int(hashlib.md5(key.encode("utf-8")).hexdigest()[:8], 16) % n_shards


def route(df: DataFrame, n_shards: int, repartition: bool = False) -> DataFrame:
    """Add ``shard``; optionally bring the rows of a shard together (AQE splits a hot shard over several tasks)."""
    cols = set(df.columns)
    key = F.coalesce(*[F.col(c) for c in ("_routing", "_parent", "_id") if c in cols])
    out = df.withColumn("shard", shard_of(key, n_shards))
    if repartition:
        out = out.hint("rebalance", "shard")
    return out
