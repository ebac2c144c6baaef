"""Decisions about rows that leave texts where they are: a row is known by two hashes, and only hashes travel."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALT = 2_862_933_555_777_941_757
LISTED_ROWS = 1_000_000  # ids (16 bytes each) up to which they are broadcast as they are
SLOT_BITS = 32_768
BITS_PER_ID = 16
MAX_BITS = 1 << 28  # of the bit table that goes first beyond that: 32 MB


def fresh(columns: Iterable[str], stem: str) -> str:
    """A prefix that no column name begins with."""
    names = [c.lower() for c in columns]
    while any(name.startswith(stem) for name in names):
        stem = "_" + stem
    return stem


def row_id(*columns: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes of a row's values. Nulls are told apart from empty texts by their place in a list of flags."""
    flags = F.concat(*[F.when(c.isNull(), "0").otherwise("1") for c in columns])
    return F.xxhash64(flags, *columns), F.xxhash64(F.lit(SALT), flags, *columns)


def split_by_ids(frame: DataFrame, first: str, second: str, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose id is in ``ids``, all others); ``ids`` is a stored table (first, second) of distinct ids.

    Up to ``LISTED_ROWS`` ids are broadcast. Beyond, a bit table of bounded size is; what it does not name stays where it is, and only
    the rows it names are shuffled to meet the ids.
    """
    rows = ids.count()
    told = ids.select(F.col(first).alias("_told1"), F.col(second).alias("_told2"))
    same = (F.col(first) == F.col("_told1")) & (F.col(second) == F.col("_told2"))
    if rows <= LISTED_ROWS:
        told = F.broadcast(told)
        return frame.join(told, same, "left_semi"), frame.join(told, same, "left_anti")
    bits = SLOT_BITS
    while bits < min(MAX_BITS, rows * BITS_PER_ID):
        bits *= 2
    place = F.pmod(F.col(first), F.lit(bits))
    slot, bit = F.shiftright(place, 15), place.bitwiseAND(F.lit(SLOT_BITS - 1))
    table = ids.select(slot.alias("_slot"), bit.alias("bit")).groupBy("_slot").agg(F.bitmap_construct_agg("bit").alias("_bits"))
    byte = F.conv(F.hex(F.substring("_bits", (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    named = F.coalesce(F.getbit(byte, bit.bitwiseAND(F.lit(7)).cast("int")) == 1, F.lit(False))
    marked = frame.join(F.broadcast(table), slot == F.col("_slot"), "left").withColumn("_named", named).drop("_slot", "_bits")
    maybe, no = marked.filter("_named").drop("_named"), marked.filter("NOT _named").drop("_named")
    return maybe.join(told, same, "left_semi"), maybe.join(told, same, "left_anti").unionByName(no)
