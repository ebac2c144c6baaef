"""Sample weights: class balance times source balance, scaled to mean 1."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .sizing import small_table


def weight_cells(frame: DataFrame) -> DataFrame:
    """(label, source_name, weight): the whole computation, on one row per label and source.

    Counts, class sizes, source sizes and the mean weight all follow from the cell counts, so the
    table itself is read once and reduced before any shuffle.
    """
    cells = frame.groupBy("label", "source_name").agg(F.count(F.lit(1)).alias("n"))
    cells = small_table(cells) or cells
    everything, by_class, by_source = W.partitionBy(), W.partitionBy("label"), W.partitionBy("source_name")
    rows = F.sum("n").over(everything)
    classes = F.size(F.collect_set("label").over(everything))
    sources = F.size(F.collect_set("source_name").over(everything))
    weighed = cells.select(
        "label",
        "source_name",
        "n",
        (rows / (classes * F.sum("n").over(by_class))).alias("class_weight"),
        (rows / (sources * F.sum("n").over(by_source))).alias("source_weight"),
    ).withColumn("raw", F.col("class_weight") * F.col("source_weight"))
    mean = F.sum(F.col("raw") * F.col("n")).over(everything) / F.sum("n").over(everything)
    return weighed.select(
        "label",
        "source_name",
        "n",
        "class_weight",
        "source_weight",
        (F.col("raw") / F.greatest(mean, F.lit(1e-9))).cast("float").alias("weight"),
    )


def with_sample_weights(frame: DataFrame, cells: DataFrame | None = None, name: str = "weight") -> DataFrame:
    """Add the weight of each row. The cell table is broadcast if it is small, so no row moves."""
    cells = weight_cells(frame) if cells is None else cells
    table = small_table(cells) or cells
    table = table.select(
        F.col("label").alias("_label"), F.col("source_name").alias("_source"), F.col("weight").alias(name)
    )
    match = (F.col("label") == F.col("_label")) & (F.col("source_name") == F.col("_source"))
    return frame.join(table, match, "left").drop("_label", "_source")


def positive_scale(frame: DataFrame) -> DataFrame:
    """One row: negatives, positives and their ratio."""
    counts = frame.agg(
        F.count_if(F.col("label") == 0).alias("negative"), F.count_if(F.col("label") == 1).alias("positive")
    )
    return counts.withColumn("positive_scale", F.col("negative") / F.greatest(F.col("positive"), F.lit(1)))


def scaled_weight(scale: float, weight: str = "weight") -> Column:
    """The weight of boosted trees: positive rows count ``scale`` times."""
    return F.col(weight).cast("double") * F.when(F.col("label") == 1, F.lit(float(scale))).otherwise(F.lit(1.0))


def balanced_weight(negative: int, positive: int, weight: str = "weight") -> Column:
    """The weight of the forest: both classes get the same total before sample weights."""
    rows = negative + positive
    per_class = F.when(F.col("label") == 1, F.lit(rows / (2.0 * max(positive, 1)))).otherwise(
        F.lit(rows / (2.0 * max(negative, 1)))
    )
    return F.col(weight).cast("double") * per_class
