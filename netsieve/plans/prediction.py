"""The prediction job: any supported table or JSON file to prediction records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.scoring import Scorer, model_scorer, prediction_records
from ..operators.sinks import load_artifacts, write_predictions
from ..operators.state import FeatureState
from ..operators.unify import unify_for_inference
from ..sources.files import INFERENCE_INDEX, inference_json

WEB_URI_INPUT = "_web_uri_input"


def predict_table(raw: DataFrame, state: FeatureState, scorer: Scorer, index: str = INFERENCE_INDEX) -> DataFrame:
    """Prediction records of a raw table. The web view needs a column named exactly ``uri`` and at
    least one other column."""
    columns = [name for name in raw.columns if name != index]
    has_uri = "uri" in columns and len(columns) > 1
    keep = [index]
    if has_uri:
        raw = raw.withColumn(WEB_URI_INPUT, F.col("uri"))
        keep.append(WEB_URI_INPUT)
    unified = unify_for_inference(raw, keep=keep)
    return prediction_records(unified, state, scorer, index, WEB_URI_INPUT if has_uri else None, branch=True)


def predict_file(spark: SparkSession, artifacts: str, path: str, output: str | None = None) -> DataFrame:
    """Score a JSON file with stored artifacts; written only if an output path is given."""
    found = load_artifacts(spark, artifacts)
    records = predict_table(inference_json(spark, path), found["state"], model_scorer(found["model"]))
    if output is not None:
        write_predictions(records, output)
        return spark.read.schema(records.schema).json(output)
    return records
