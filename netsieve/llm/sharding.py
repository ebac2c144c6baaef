"""Rendezvous hashing of record keys over weighted shards, with gapless slots in each shard.

Every record draws one number for each shard from its key and the shard's number, and goes to the shard with the
smallest ``-ln(u) / weight``. The draw of one shard does not depend on the others, so a new shard takes records only into
itself, in proportion to its weight, and no other record moves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netsieve.llm.words import byte_count

SLOT_BUCKETS = 1024


def rendezvous_shard(key: Column, weights: Sequence[float]) -> Column:
    """Shard of a key. A null key is a key like any other. A shard of weight 0 takes nothing; ties go to the lower shard."""
    if not any(w > 0 for w in weights) or any(w < 0 for w in weights):
        raise ValueError("weights must be 0 or more, and one above 0")
    table = F.array(*[F.lit(float(w)) for w in weights])

    def draw(shard: Column) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(key.cast("string"), shard), 11)
        u = (bits + F.lit(0.5)) / F.lit(float(2**53))
        return F.struct((-F.log(u) / F.element_at(table, shard + 1)).alias("cost"), shard.alias("shard"))

    shards = F.array(*[F.lit(j) for j, w in enumerate(weights) if w > 0])
    return F.array_min(F.transform(shards, draw))["shard"]


def assign_shards(
    records: DataFrame, key: str, weights: Sequence[float], new_shard_weight: float | None = None, name: str = "shard"
) -> DataFrame:
    """All records and columns, with the shard of the key as ``name`` and, if a weight for one more shard is given, the
    shard among one more as ``grown_<name>``. A projection: nothing is shuffled. Columns of these names are replaced."""
    out = records.withColumn(name, rendezvous_shard(F.col(f"`{key}`"), weights))
    if new_shard_weight is not None:
        out = out.withColumn(f"grown_{name}", rendezvous_shard(F.col(f"`{key}`"), [*weights, new_shard_weight]))
    return out


def placement(
    documents: DataFrame,
    shards: int = 24,
    weights: Sequence[float] | None = None,
    key: str = "doc_id",
    text: str = "text",
    buckets: int = SLOT_BUCKETS,
) -> DataFrame:
    """Shard, slot and size of every document under the law ``key``: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Equal rows are counted before anything is shuffled. A shard is numbered in ``buckets`` parts: counts of the parts
    are summed up (at most shards x buckets rows), rows are numbered inside a part, so no task sees a whole shard.
    Cases: null text: size 8 and CRC 0; null key: one key; repeated rows get slots of their own; empty table: no rows.
    """
    weights = [1.0] * shards if weights is None else list(weights)
    body = F.col(f"`{text}`")
    rows = documents.select(
        F.col(f"`{key}`").alias("doc_id"),
        (byte_count(body) + 8).alias("size"),
        F.coalesce(F.crc32(body.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
    )
    groups = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("copies"))
    groups = assign_shards(groups, "doc_id", weights, weights[-1]).withColumn(
        "part", F.pmod(F.xxhash64("doc_id", "size", "text_crc32", F.lit("slot")), F.lit(buckets))
    )
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = groups.groupBy("shard", "part").agg(F.sum("copies").alias("total"))
    parts = parts.select("shard", "part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("start"))
    inside = (
        Window.partitionBy("shard", "part")
        .orderBy("doc_id", "size", "text_crc32")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = groups.withColumn("inside", F.coalesce(F.sum("copies").over(inside), F.lit(0))).join(parts, ["shard", "part"])
    first = F.col("start") + F.col("inside")
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        F.explode(F.sequence(first, first + F.col("copies") - 1)).alias("slot"),
        "grown_shard",
    )
