"""The training job: split, fit state, compare two candidates, refit the better one, evaluate, store."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..operators import evaluate, models, profile, sinks
from ..operators.features import select_features, transform
from ..operators.sizing import checkpoint_table, scratch_path
from ..operators.split import TEST, TRAIN, VALIDATION, selection_subset, stratified_split
from ..operators.state import FeatureState, fit_to, state_summary
from ..operators.weights import balanced_weight, positive_scale, scaled_weight, with_sample_weights


@dataclass(frozen=True)
class Candidate:
    name: str
    estimator: Callable[[], object]
    weight: Callable[[int, int], Column]


def default_candidates(boosted: dict | None = None, forest: dict | None = None) -> list[Candidate]:
    """Listed in order of preference on equal scores."""
    return [
        Candidate(
            models.BOOSTED,
            lambda: models.boosted_trees(**(boosted or {})),
            lambda negative, positive: scaled_weight(negative / max(positive, 1)),
        ),
        Candidate(models.FOREST, lambda: models.random_forest(**(forest or {})), balanced_weight),
    ]


@dataclass(frozen=True)
class TrainingResult:
    model_name: str
    model: object
    state: FeatureState
    candidate_scores: DataFrame
    evaluation: dict[str, DataFrame]
    scored_test: DataFrame


def feature_table(rows: DataFrame, state: FeatureState, keep: Sequence[str]) -> DataFrame:
    """Features, label and weight, written once because learners read their input several times."""
    kept = list(dict.fromkeys([*keep, "label", "source_name"]))
    return checkpoint_table(transform(rows, state, kept), "features", file_rows=models.FIT_ROWS)


def _class_totals(rows: DataFrame) -> tuple[int, int]:
    totals = positive_scale(rows).first()
    return totals.negative, totals.positive


def evaluation_tables(scored: DataFrame, model) -> dict[str, DataFrame]:
    """All evaluation results of a table with label, probability and prediction."""
    importance = evaluate.model_importances(model, scored.sparkSession)
    return {
        "scored": scored,
        "metrics": evaluate.binary_metrics(scored),
        "confusion_matrix": evaluate.confusion_matrix(scored),
        "classification_report": evaluate.classification_report(scored),
        "probability_summary": evaluate.probability_summary(scored),
        "feature_importance": evaluate.feature_importance(importance),
        "top_features": evaluate.feature_importance(importance, 25),
    }


def write_evaluation(artifacts: str, tables: dict[str, DataFrame]) -> None:
    sinks.write_evaluation(
        artifacts,
        tables["confusion_matrix"],
        tables["feature_importance"],
        tables["classification_report"],
        evaluate.evaluation_row(tables["scored"]),
    )
    sinks.write_small_json(tables["top_features"], f"{artifacts}/top_features")


def train(
    dataset: DataFrame,
    artifacts: str,
    key_columns: Sequence[str] = (),
    candidates: list[Candidate] | None = None,
    test_size: float = fixed.TEST_SIZE,
    validation_size: float = fixed.VALIDATION_SIZE,
    selection_rows: int = fixed.SELECTION_ROWS,
    seed: int = fixed.SEED,
) -> TrainingResult:
    """``dataset`` holds unified records of all sources."""
    spark = dataset.sparkSession
    candidates = candidates or default_candidates()
    split = stratified_split(dataset, key_columns, test_size, validation_size, seed)
    staged = checkpoint_table(split, "dataset", partition_by=("split",), file_rows=models.FIT_ROWS)
    part = {name: staged.filter(F.col("split") == name).drop("split") for name in (TRAIN, VALIDATION, TEST)}

    selection_state = fit_to(part[TRAIN], scratch_path(spark, "state"))
    subset = selection_subset(with_sample_weights(part[TRAIN]), key_columns, selection_rows, seed)
    subset_features = feature_table(subset, selection_state, ["weight"])
    validation_features = feature_table(part[VALIDATION], selection_state, [])
    # Trees scale the positive class by the whole training part, the forest balances what it sees.
    subset_totals, train_totals = _class_totals(subset_features), _class_totals(part[TRAIN])

    rows = []
    for position, candidate in enumerate(candidates):
        totals = train_totals if candidate.name == models.BOOSTED else subset_totals
        model = models.fit_model(candidate.estimator(), subset_features, candidate.weight(*totals))
        scored = models.with_prediction(models.with_probability(validation_features, model))
        score = evaluate.binary_metrics(scored).first()
        rows.append((position, candidate.name, score.f1_score, score.accuracy))
    scores = spark.createDataFrame(rows, "position int, name string, f1 double, accuracy double")
    best = candidates[evaluate.best_candidate(scores).first().position]

    fitted_rows = staged.filter(F.col("split").isin(TRAIN, VALIDATION)).drop("split")
    state = fit_to(fitted_rows, f"{artifacts}/state")
    final_features = feature_table(with_sample_weights(fitted_rows), state, ["weight"])
    model = models.fit_model(best.estimator(), final_features, best.weight(*_class_totals(fitted_rows)))

    test_features = feature_table(part[TEST], state, [])
    # Stored, since three tables read it and the model is dear.
    scored_test = checkpoint_table(models.with_prediction(models.with_probability(test_features, model)), "scored-test")
    evaluation = evaluation_tables(scored_test, model)

    sinks.write_model(model, best.name, artifacts)
    sinks.write_test_split(part[TEST], artifacts)
    state_summary(state).write.mode("overwrite").json(f"{artifacts}/encoders")
    sinks.write_metadata(
        artifacts, schema_metadata(staged), sinks.feature_list(spark), training_summary(staged, scores, best.name)
    )
    write_evaluation(artifacts, evaluation)
    return TrainingResult(best.name, model, state, scores, evaluation, scored_test)


def schema_metadata(dataset: DataFrame) -> DataFrame:
    """(section, name, value): rows and labels by source, total rows."""

    def section(name: str, frame: DataFrame, key: Column, value: str) -> DataFrame:
        return frame.select(
            F.lit(name).alias("section"), key.cast("string").alias("name"), F.col(value).cast("double").alias("value")
        )

    by_source = profile.labels_by_source(dataset)
    parts = [
        section("source_rows", profile.rows_by_source(dataset), F.col("source_name"), "rows"),
        section("source_label_0", by_source, F.col("source_name"), "label_0"),
        section("source_label_1", by_source, F.col("source_name"), "label_1"),
        section("total_rows", profile.label_totals(dataset), F.lit("all"), "rows"),
    ]
    columns = list(enumerate(fixed.RECORD_COLUMNS, start=1))
    names = dataset.sparkSession.createDataFrame(columns, "position int, name string")
    parts.append(section("unified_schema", names, F.col("name"), "position"))
    return _union(parts)


def training_summary(dataset: DataFrame, scores: DataFrame, selected: str) -> DataFrame:
    """(section, name, value): selected model, candidate scores, split and class sizes."""

    def section(name: str, frame: DataFrame, key: Column, value: Column) -> DataFrame:
        return frame.select(
            F.lit(name).alias("section"), key.cast("string").alias("name"), value.cast("double").alias("value")
        )

    chosen = scores.filter(F.col("name") == selected)
    return _union(
        [
            section("selected_model", chosen, F.col("name"), F.col("f1")),
            section("candidate_f1", scores, F.col("name"), F.col("f1")),
            section("candidate_accuracy", scores, F.col("name"), F.col("accuracy")),
            section("split_rows", profile.split_rows(dataset), F.col("split"), F.col("rows")),
            section("class_distribution", profile.class_distribution(dataset), F.col("label"), F.col("rows")),
            section("feature_count", chosen, F.lit("all"), F.lit(len(fixed.FEATURE_NAMES))),
        ]
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged


def evaluate_saved(spark, artifacts: str) -> dict[str, DataFrame]:
    """Score the stored test split with the stored model and write the evaluation again."""
    found = sinks.load_artifacts(spark, artifacts, with_test_split=True)
    test = sinks.read_test_split(spark, artifacts)
    features = select_features(transform(test, found["state"], ["label"]), found["features"], ["label"])
    scored = checkpoint_table(
        models.with_prediction(models.with_probability(features, found["model"])).select(
            "label", "prediction", "probability"
        ),
        "scored",
    )
    tables = evaluation_tables(scored, found["model"])
    write_evaluation(artifacts, tables)
    return tables
