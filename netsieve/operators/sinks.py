"""Writers of results and of fitted artifacts."""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from .sizing import SMALL_ROWS, claim_file, file_exists, file_names
from .state import FeatureState, load_state

MODEL_CLASSES = {"boosted_trees": GBTClassificationModel, "random_forest": RandomForestClassificationModel}


def write_test_split(test_rows: DataFrame, artifacts: str) -> None:
    test_rows.write.mode("overwrite").parquet(f"{artifacts}/test_dataset")


def read_test_split(spark: SparkSession, artifacts: str) -> DataFrame:
    return spark.read.parquet(f"{artifacts}/test_dataset")


def write_model(model, name: str, artifacts: str) -> None:
    model.write().overwrite().save(f"{artifacts}/model/{name}")


def write_small_json(frame: DataFrame, path: str) -> None:
    """For results of a few rows, as one file."""
    frame.coalesce(1).write.mode("overwrite").json(path)


def write_metadata(artifacts: str, schema: DataFrame, features: DataFrame, summary: DataFrame) -> None:
    write_small_json(schema, f"{artifacts}/schema_metadata")
    write_small_json(features, f"{artifacts}/feature_list")
    write_small_json(summary, f"{artifacts}/training_summary")


def write_evaluation(artifacts: str, matrix: DataFrame, importance: DataFrame, report: DataFrame, metrics: DataFrame) -> None:
    matrix.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{artifacts}/confusion_matrix")
    importance.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{artifacts}/feature_importance")
    report_lines(report).coalesce(1).write.mode("overwrite").text(f"{artifacts}/classification_report")
    write_small_json(metrics, f"{artifacts}/evaluation")


def report_lines(report: DataFrame) -> DataFrame:
    line = F.format_string("%14s %9.2f %9.2f %9.2f %9d", "name", "precision", "recall", "f1_score", "support")
    return report.select(line.alias("value"))


def write_predictions(predictions: DataFrame, path: str) -> None:
    predictions.write.mode("overwrite").json(path)


def required_artifacts(artifacts: str) -> list[str]:
    return [f"{artifacts}/{name}" for name in ("model", "state", "feature_list")]


def missing_paths(spark: SparkSession, paths: list[str]) -> list[str]:
    """Paths that hold nothing readable."""
    missing = []
    for path in paths:
        try:
            spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).inputFiles()
        except Exception as error:  # the reader reports a missing path as an analysis error
            if "PATH_NOT_FOUND" not in str(error):
                raise
            missing.append(path)
    return missing


def load_artifacts(spark: SparkSession, artifacts: str, with_test_split: bool = False) -> dict:
    """Model, its name, fitted state and feature list; a clear error names what is missing."""
    paths = required_artifacts(artifacts) + ([f"{artifacts}/test_dataset"] if with_test_split else [])
    missing = missing_paths(spark, paths)
    if missing:
        raise FileNotFoundError("missing training artifacts, run training first: " + ", ".join(missing))
    name = spark.read.json(f"{artifacts}/training_summary").filter("section = 'selected_model'").first().name
    rows = spark.read.json(f"{artifacts}/feature_list").orderBy("position").collect()  # 47 rows
    state: FeatureState = load_state(spark, f"{artifacts}/state")
    model = MODEL_CLASSES[name].load(f"{artifacts}/model/{name}")
    return {"model": model, "model_name": name, "state": state, "features": [row.name for row in rows]}


def feature_list(spark: SparkSession) -> DataFrame:
    rows = list(enumerate(fixed.FEATURE_NAMES, start=1))
    return spark.createDataFrame(rows, "position int, name string")


def stream_name(checkpoint: str) -> str:
    """A stream is known by its checkpoint, so streams of several sources, or one begun anew, add to the same table."""
    return hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:16]


def append_batch(folder: str, checkpoint: str):
    """A ``foreachBatch`` writer that repeats safely.

    Each attempt at a batch has a folder of its own below ``data``; once all of it is written, a record below ``commits`` names it.
    Readers (:func:`read_table`) see committed attempts only, so a batch that was killed half-way is invisible, and a batch that has a
    record is not written again: a restart adds nothing twice.
    """
    stream = stream_name(checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        record = f"{folder}/commits/{stream}-{batch_id}.json"
        if file_exists(spark, record):
            return
        attempt = uuid.uuid4().hex
        batch.write.parquet(f"{folder}/data/stream={stream}/batch_id={batch_id}/attempt={attempt}")
        claim_file(spark, record, json.dumps({"stream": stream, "batch_id": batch_id, "attempt": attempt}))

    return write


def commits(spark: SparkSession, folder: str) -> DataFrame:
    """(stream, batch_id, attempt) of every committed batch."""
    return spark.read.schema("stream string, batch_id long, attempt string").json(f"{folder}/commits")


def read_table(spark: SparkSession, folder: str) -> DataFrame:
    """The committed rows of a table of batches, with ``stream`` and ``batch_id``; no batch committed yet: no rows, and no columns either.

    Attempts are partitions: the join with their records prunes the folders of all others before any file is opened.
    """
    if not file_names(spark, f"{folder}/commits"):
        return spark.createDataFrame([], "stream string, batch_id long")
    rows = spark.read.option("basePath", f"{folder}/data").parquet(f"{folder}/data")
    kept = commits(spark, folder).select("stream", "batch_id", "attempt")
    rows = rows.withColumns({"stream": F.col("stream").cast("string"), "batch_id": F.col("batch_id").cast("long"), "attempt": F.col("attempt").cast("string")})
    return rows.join(F.broadcast(kept) if kept.count() <= SMALL_ROWS else kept, ["stream", "batch_id", "attempt"], "left_semi").drop("attempt")
