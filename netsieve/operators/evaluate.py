"""Binary classification metrics from one aggregate over (label, prediction, probability)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fixed


def _share(part: Column, whole: Column) -> Column:
    """0 where the denominator is 0."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def outcome_counts(scored: DataFrame, *more: Column) -> DataFrame:
    """One row: tn, fp, fn, tp and any further aggregates."""
    label, prediction = F.col("label"), F.col("prediction")
    return scored.agg(
        *more,
        F.count_if((label == 0) & (prediction == 0)).alias("tn"),
        F.count_if((label == 0) & (prediction == 1)).alias("fp"),
        F.count_if((label == 1) & (prediction == 0)).alias("fn"),
        F.count_if((label == 1) & (prediction == 1)).alias("tp"),
    )


def _metrics() -> list[Column]:
    tn, fp, fn, tp = (F.col(name) for name in ("tn", "fp", "fn", "tp"))
    return [
        _share(tp + tn, tn + fp + fn + tp).alias("accuracy"),
        _share(tp, tp + fp).alias("precision"),
        _share(tp, tp + fn).alias("recall"),
        _share(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
    ]


def binary_metrics(scored: DataFrame) -> DataFrame:
    """One row: accuracy, precision, recall, f1_score of the positive class."""
    return outcome_counts(scored).select(*_metrics())


def evaluation_row(scored: DataFrame) -> DataFrame:
    """Metrics, matrix cells and probability range in one row and one pass."""
    return outcome_counts(scored, *_probability_range()).select("*", *_metrics())


def confusion_matrix(scored: DataFrame) -> DataFrame:
    """Two rows, always both classes: actual, pred_0, pred_1."""
    rows = F.array(
        F.struct(F.lit("actual_0").alias("actual"), F.col("tn").alias("pred_0"), F.col("fp").alias("pred_1")),
        F.struct(F.lit("actual_1").alias("actual"), F.col("fn").alias("pred_0"), F.col("tp").alias("pred_1")),
    )
    return outcome_counts(scored).select(F.inline(rows))


def classification_report(scored: DataFrame) -> DataFrame:
    """name, precision, recall, f1_score, support for each class that occurs and the averages."""
    tn, fp, fn, tp = (F.col(name) for name in ("tn", "fp", "fn", "tp"))

    def entry(name: str, precision: Column, recall: Column, f1: Column, support: Column, occurs: Column) -> Column:
        return F.struct(
            F.lit(name).alias("name"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1_score"),
            support.cast("long").alias("support"),
            occurs.alias("occurs"),
        )

    def of_class(name: str, hit: Column, wrongly: Column, missed: Column) -> Column:
        return entry(
            name,
            _share(hit, hit + wrongly),
            _share(hit, hit + missed),
            _share(2 * hit, 2 * hit + wrongly + missed),
            hit + missed,
            hit + wrongly + missed > 0,
        )

    table = outcome_counts(scored).select(
        "*", of_class("0", tn, fn, fp).alias("negative"), of_class("1", tp, fp, fn).alias("positive")
    )
    rows = tn + fp + fn + tp
    both = F.array("negative", "positive")
    present = F.filter(both, lambda c: c["occurs"])

    def total(array: Column, value) -> Column:
        return F.aggregate(array, F.lit(0.0), lambda acc, c: acc + value(c))

    def average(name: str, weigh) -> Column:
        def mean(field: str) -> Column:
            return _share(total(present, lambda c: c[field] * weigh(c)), total(present, weigh))

        return entry(name, mean("precision"), mean("recall"), mean("f1_score"), rows, F.lit(True))

    accuracy = _share(tp + tn, rows)
    averages = F.array(
        entry("accuracy", accuracy, accuracy, accuracy, rows, F.lit(True)),
        average("macro avg", lambda c: F.lit(1.0)),
        average("weighted avg", lambda c: c["support"].cast("double")),
    )
    return table.select(F.inline(F.concat(present, averages))).drop("occurs")


def _probability_range() -> list[Column]:
    p = F.col("probability")
    return [F.min(p).alias("min"), F.max(p).alias("max"), F.avg(p).alias("mean")]


def probability_summary(scored: DataFrame) -> DataFrame:
    return scored.agg(*_probability_range())


def feature_importance(importances: DataFrame, top: int | None = None) -> DataFrame:
    """(feature, importance) in falling order; equal values by name."""
    ranked = importances.orderBy(F.desc("importance"), F.asc("feature"))
    return ranked if top is None else ranked.limit(top)


def best_candidate(scores: DataFrame) -> DataFrame:
    """The row with the highest (f1, accuracy); of equals, the one listed first by ``position``."""
    return scores.orderBy(F.desc("f1"), F.desc("accuracy"), F.asc("position")).limit(1)


def model_importances(model, spark) -> DataFrame:
    """(feature, importance) of a fitted tree model; one row per feature."""
    values = [float(v) for v in model.featureImportances.toArray()]
    return spark.createDataFrame(list(zip(fixed.FEATURE_NAMES, values)), "feature string, importance double")
