"""Exact stratified splits without sorting the data.

Each row gets a hash of its key and the seed; inside a label, rows are taken in hash order. The
cut points are found from a histogram of hash prefixes and one look into the single bucket each cut
falls in, so no task ever ranks a label. Rows are then compared with the cut points: the split
itself is a projection.

With unique keys the parts have exactly the intended sizes. Rows with equal keys cannot be told
apart: they stay together, on the side of the cut where most of the group lies, and are counted
before they are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from .sizing import small_table

BUCKET_DIGITS = 4  # 65,536 buckets per label
TRAIN, VALIDATION, TEST = "train", "validation", "test"


def row_hash(key_columns: Sequence[str], seed: int) -> Column:
    """md5 of the key columns and the seed; without key columns, of the whole unified record."""
    if key_columns:
        key = F.concat_ws("|", *[F.coalesce(F.col(name).cast("string"), F.lit("")) for name in key_columns])
    else:
        key = F.xxhash64(*[F.col(name) for name in fixed.UNIFIED_COLUMNS]).cast("string")
    return F.md5(F.concat(key, F.lit(f":{seed}")))


def largest_remainder(counts: DataFrame, wanted: Column, count: str, name: str) -> DataFrame:
    """Share ``wanted`` rows between labels in proportion to ``count``; one row per label."""
    everything = W.partitionBy()
    exact = wanted * F.col(count) / F.sum(count).over(everything)
    base = F.floor(exact)
    missing = wanted - F.sum(base).over(everything)
    order = F.row_number().over(W.orderBy((exact - base).desc(), F.col("label")))
    return counts.withColumn(name, (base + (order <= missing).cast("long")).cast("long"))


def split_quotas(label_counts: DataFrame, test_size: float, validation_size: float) -> DataFrame:
    """(label, n) -> (label, n, test, validation) row quotas."""
    everything = W.partitionBy()
    wanted_test = F.ceil(F.sum("n").over(everything) * F.lit(test_size))
    quotas = largest_remainder(label_counts.select("label", "n"), wanted_test, "n", "test")
    quotas = quotas.withColumn("rest", F.col("n") - F.col("test"))
    wanted_validation = F.ceil(F.sum("rest").over(everything) * F.lit(validation_size / (1.0 - test_size)))
    return largest_remainder(quotas, wanted_validation, "rest", "validation").drop("rest")


def selection_quotas(label_counts: DataFrame, limit: int) -> DataFrame:
    """(label, n) -> (label, n, kept): ``limit`` rows in label proportion, or all of them."""
    wanted = F.least(F.lit(limit).cast("long"), F.sum("n").over(W.partitionBy()))
    return largest_remainder(label_counts.select("label", "n"), wanted, "n", "kept")


def _bounded(frame: DataFrame) -> DataFrame:
    """Tables with a few rows per label."""
    return small_table(frame) or frame


def label_counts(frame: DataFrame) -> DataFrame:
    return _bounded(frame.groupBy("label").agg(F.count(F.lit(1)).alias("n")))


def cut_points(frame: DataFrame, hashed: Column, cuts: DataFrame) -> DataFrame:
    """(label, cut, rank) -> (label, cut, hash): the largest hash among the first ``rank`` rows.

    A label without a row for a cut has rank 0.
    """
    rows = frame.select("label", hashed.alias("hash"))
    bucket = F.substring("hash", 1, BUCKET_DIGITS)
    histogram = rows.groupBy("label", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("label").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    histogram = histogram.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    inside = (F.col("rank") > F.col("before")) & (F.col("rank") <= F.col("before") + F.col("n"))
    cut_buckets = _bounded(
        histogram.join(cuts, "label")
        .filter(inside)
        .select("label", "bucket", "cut", (F.col("rank") - F.col("before")).alias("rank"))
    )
    located = (
        rows.withColumn("bucket", bucket)
        .join(cut_buckets.select("label", "bucket").distinct(), ["label", "bucket"], "left_semi")
        .groupBy("label", "bucket", "hash")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    earlier = W.partitionBy("label", "bucket").orderBy("hash").rowsBetween(W.unboundedPreceding, -1)
    located = located.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    taken = 2 * F.col("before") + F.col("n") <= 2 * F.col("rank")
    # If the first group of the bucket is not taken, the cut lies just below the bucket.
    return _bounded(
        located.join(cut_buckets, ["label", "bucket"])
        .groupBy("label", "cut", "bucket")
        .agg(F.max(F.when(taken, F.col("hash"))).alias("hash"))
        .select("label", "cut", F.coalesce("hash", "bucket").alias("hash"))
    )


def stratified_split(
    frame: DataFrame,
    key_columns: Sequence[str] = (),
    test_size: float = fixed.TEST_SIZE,
    validation_size: float = fixed.VALIDATION_SIZE,
    seed: int = fixed.SEED,
) -> DataFrame:
    """Add ``split``: test rows first in hash order, then validation, the rest is train."""
    quotas = _bounded(split_quotas(label_counts(frame), test_size, validation_size))
    cuts = quotas.select(
        "label",
        F.inline(
            F.array(
                F.struct(F.lit(TEST).alias("cut"), F.col("test").alias("rank")),
                F.struct(F.lit(VALIDATION).alias("cut"), (F.col("test") + F.col("validation")).alias("rank")),
            )
        ),
    )
    hashed = row_hash(key_columns, seed)
    points = cut_points(frame, hashed, cuts)
    limits = points.groupBy(F.col("label").alias("_label")).agg(
        F.max(F.when(F.col("cut") == TEST, F.col("hash"))).alias("_test"),
        F.max(F.when(F.col("cut") == VALIDATION, F.col("hash"))).alias("_validation"),
    )
    part = (
        F.when(F.col("_hash") <= F.col("_test"), TEST)
        .when(F.col("_hash") <= F.col("_validation"), VALIDATION)
        .otherwise(TRAIN)
    )
    return (
        frame.withColumn("_hash", hashed)
        .join(_bounded(limits), F.col("label") == F.col("_label"), "left")
        .withColumn("split", part)
        .drop("_hash", "_label", "_test", "_validation")
    )


def selection_subset(
    frame: DataFrame,
    key_columns: Sequence[str] = (),
    limit: int = fixed.SELECTION_ROWS,
    seed: int = fixed.SEED,
) -> DataFrame:
    """At most ``limit`` rows in label proportion: the sampling operator of model selection."""
    counts = label_counts(frame)
    if (counts.agg(F.sum("n")).first()[0] or 0) <= limit:
        return frame
    quotas = _bounded(selection_quotas(counts, limit))
    cuts = quotas.select("label", F.lit("kept").alias("cut"), F.col("kept").alias("rank"))
    hashed = row_hash(key_columns, seed)
    points = cut_points(frame, hashed, cuts).select(F.col("label").alias("_label"), F.col("hash").alias("_limit"))
    match = (F.col("label") == F.col("_label")) & (F.col("_hash") <= F.col("_limit"))
    return frame.withColumn("_hash", hashed).join(points, match, "left_semi").drop("_hash")
