"""Row counts of a training table. Every one is a partial aggregate before its shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _rows():
    return F.count(F.lit(1)).alias("rows")


def label_totals(frame: DataFrame) -> DataFrame:
    """One row: rows, malicious, benign."""
    return frame.agg(
        _rows(),
        F.coalesce(F.sum(F.col("label").cast("long")), F.lit(0)).alias("malicious"),
        F.count_if(F.col("label") == 0).alias("benign"),
    )


def rows_by_source(frame: DataFrame) -> DataFrame:
    return frame.groupBy("source_name").agg(_rows())


def labels_by_source(frame: DataFrame) -> DataFrame:
    """Source x label pivot, zero-filled."""
    return frame.groupBy("source_name").agg(
        F.count_if(F.col("label") == 0).alias("label_0"), F.count_if(F.col("label") == 1).alias("label_1")
    )


def class_distribution(frame: DataFrame) -> DataFrame:
    return frame.groupBy(F.col("label").cast("int").alias("label")).agg(_rows())


def split_rows(frame: DataFrame) -> DataFrame:
    return frame.groupBy("split").agg(_rows())
