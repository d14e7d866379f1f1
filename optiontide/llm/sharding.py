"""Rendezvous hashing: records to weighted shards by a stable key.

Every shard draws a number for a record from a hash of (key, shard); the
smallest ``-ln(u) / weight`` wins. A shard's draws do not depend on the other
shards, so a new shard takes records only into itself and a removed one gives
away only its own. Null keys hash like one more key; records of one key always
share a shard.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from optiontide.llm.common import numbered_within, without


def draw(key: Column, shard: int, weight: float) -> Column:
    """The shard's bid for a record; the smallest bid wins."""
    unit = (F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11).cast("double") + 0.5) / F.lit(float(2**53))
    return -F.log(unit) / F.lit(float(weight))


def rendezvous(key: Column, weights: Mapping[int, float]) -> Column:
    """The shard number of a record under ``{shard: weight}``; weights are above 0."""
    if not weights or min(weights.values()) <= 0:
        raise ValueError("shards need weights above 0")
    bids = [F.struct(draw(key, s, w).alias("bid"), F.lit(s).alias("shard")) for s, w in sorted(weights.items())]
    return F.array_min(F.array(*bids))["shard"]


def shard_records(df: DataFrame, key: str, weights: Mapping[int, float], order: list[str] = (), buckets: int = 512) -> DataFrame:
    """``df`` with ``shard`` (int) and ``slot`` (long, gapless from 0 in each shard).

    Slots go by ``buckets`` hash ranges of each shard, so that no shard is
    ordered in one task; within a range by key, then by ``order``. An empty
    table stays empty; columns called ``shard`` or ``slot`` are replaced.
    """
    out = without(df, "shard", "slot").withColumn("shard", rendezvous(F.col(key), weights))
    columns = [F.col(key), *[F.col(c) for c in order]]
    return numbered_within(out, ["shard"], columns, columns, "slot", buckets)
