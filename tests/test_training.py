import json

import pytest
from pyspark.sql import functions as F

from netsieve.operators import features, lookups, models, sinks, state, weights
from netsieve.operators.sizing import checkpoint_table, scratch_path
from netsieve.plans import catalog, prediction, telemetry, training

BOOSTED = {"rounds": 3, "depth": 3, "rate": 0.3}
FOREST = {"trees": 4, "depth": 5}


@pytest.fixture(scope="module")
def trained(spark, small, tmp_path_factory):
    artifacts = str(tmp_path_factory.mktemp("artifacts"))
    # Labels that the features can tell: error events use their own protocol.
    dataset = telemetry.unified_view(spark, small)
    candidates = training.default_candidates(BOOSTED, FOREST)
    return artifacts, training.train(dataset, artifacts, ["event_id"], candidates, selection_rows=500)


def test_selected_model_beats_the_trivial_one(trained):
    _, result = trained
    scores = {r.name: (r.f1, r.accuracy) for r in result.candidate_scores.collect()}
    assert set(scores) == {"boosted_trees", "random_forest"}
    assert result.model_name == max(scores, key=lambda n: scores[n])
    metrics = result.evaluation["metrics"].first()
    assert metrics.f1_score > 0.9
    probabilities = result.evaluation["probability_summary"].first()
    assert 0 <= probabilities["min"] <= probabilities["mean"] <= probabilities["max"] <= 1


def test_saved_model_gives_the_same_evaluation(spark, trained):
    artifacts, result = trained
    again = training.evaluate_saved(spark, artifacts)
    assert again["metrics"].first() == result.evaluation["metrics"].first()
    assert again["confusion_matrix"].collect() == result.evaluation["confusion_matrix"].collect()
    importance = again["feature_importance"].collect()
    assert len(importance) == 47 and again["top_features"].count() == 25
    assert [r.importance for r in importance] == sorted((r.importance for r in importance), reverse=True)


def test_artifacts_on_disk(spark, trained):
    artifacts, result = trained
    summary = {(r.section, r.name): r.value for r in spark.read.json(f"{artifacts}/training_summary").collect()}
    assert summary[("split_rows", "test")] == 150 and summary[("feature_count", "all")] == 47
    assert spark.read.parquet(f"{artifacts}/test_dataset").count() == 150
    assert spark.read.json(f"{artifacts}/schema_metadata").filter("section = 'total_rows'").first().value == 1000
    assert spark.read.option("header", True).csv(f"{artifacts}/confusion_matrix").count() == 2
    assert spark.read.text(f"{artifacts}/classification_report").count() >= 4


def test_predict_file(spark, trained, folder):
    artifacts, _ = trained
    path = f"{folder}/in.json"
    with open(path, "w") as handle:
        json.dump(["/cart?sort=price", "v=declare+order+by+dbms_lock--", "/img/a-1.png"], handle)
    stored = prediction.predict_file(spark, artifacts, path, f"{folder}/out")
    rows = stored.orderBy("index").collect()
    assert [r["index"] for r in rows] == [0, 1, 2]
    assert all(0 <= r.malicious_probability <= 1 and r.selected_view == "primary" for r in rows)
    assert rows[1].normalized_record.uri.startswith("v=declare")
    fresh = prediction.predict_file(spark, artifacts, path).orderBy("index").collect()
    assert [r.malicious_probability for r in fresh] == [r.malicious_probability for r in rows]


def test_missing_artifacts_are_named(spark, folder):
    with pytest.raises(FileNotFoundError, match="model"):
        sinks.load_artifacts(spark, f"{folder}/nothing")


def test_parts_of_a_fit_do_not_grow_with_the_table(spark, monkeypatch):
    table = spark.range(0, 1000, 1, 2)
    assert models.in_parts(table).rdd.getNumPartitions() == 2
    monkeypatch.setattr(models, "FIT_ROWS", 100)
    sizes = models.in_parts(table).rdd.glom().map(len).collect()
    assert len(sizes) == 10 and sum(sizes) == 1000 and max(sizes) <= 120


def longest_method(frame):
    """Bytes of the longest method that Spark generates for a plan."""
    stages = frame._jdf.queryExecution().debug().codegenToSeq()
    return max(stages.apply(n)._3().maxMethodCodeSize() for n in range(stages.size()))


def test_generated_methods_are_short_enough_to_be_compiled(spark, small, monkeypatch):
    rows = weights.with_sample_weights(telemetry.unified_view(spark, small))
    stored = checkpoint_table(rows, "rows")
    fitted = state.fit_to(stored, scratch_path(spark, "state"))
    spark.conf.set("spark.sql.adaptive.enabled", False)  # an adaptive plan has no code before it runs
    try:
        table = features.transform(stored, fitted, ["event_id", "label", "weight"])
        assert longest_method(table) < 8000  # HotSpot interprets longer ones
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    with monkeypatch.context() as patch:
        for module in (features, lookups):
            patch.setattr(module, "code_cut", lambda frame, text="": frame)
        plain = features.transform(stored, fitted, ["event_id", "label", "weight"])
    assert table.exceptAll(plain).count() == 0 and table.count() == plain.count() == 1000


def test_files_of_a_feature_table_do_not_grow_with_the_table(spark, small, monkeypatch):
    monkeypatch.setattr(models, "FIT_ROWS", 100)
    stored = checkpoint_table(telemetry.unified_view(spark, small).coalesce(1), "rows")
    table = training.feature_table(stored, state.fit_to(stored, scratch_path(spark, "state")), ["event_id"])
    sizes = [row["count"] for row in table.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 10 and max(sizes) == 100 and sum(sizes) == 1000


def test_a_table_in_small_files_is_fitted_without_a_shuffle(spark, folder, monkeypatch):
    monkeypatch.setattr(models, "FIT_ROWS", 100)
    seen = []

    class Estimator:
        def fit(self, table):
            seen.append((table.rdd.getNumPartitions(), "RoundRobin" in table._jdf.queryExecution().executedPlan().toString()))

    features_of = [F.col("id").cast("float").alias(name) for name in models.fixed.FEATURE_NAMES]
    rows = spark.range(0, 3000, 1, 1).select(F.lit(1).alias("label"), *features_of)
    opening = spark.conf.get("spark.sql.files.openCostInBytes")
    for name, limit in (("small", 100), ("large", 0)):
        rows.write.option("maxRecordsPerFile", limit).parquet(f"{folder}/{name}")
        models.fit_model(Estimator(), spark.read.parquet(f"{folder}/{name}"), F.lit(1.0))
    assert seen == [(30, False), (30, True)]
    assert spark.conf.get("spark.sql.files.openCostInBytes") == opening


def test_the_boosted_query_grows_the_trees_of_the_operator(spark, monkeypatch):
    features_of = [F.col("id").cast("float").alias(name) for name in models.fixed.FEATURE_NAMES]
    label, keys = (F.col("id") >= 20).cast("int").alias("label"), [F.col("id").alias("event_id"), F.lit(1.0).alias("weight")]
    table = spark.range(0, 40, 1, 1).select(*keys, label, *features_of)
    monkeypatch.setattr(catalog, "_training_features", lambda spark, folder: table)
    asked, fit = [], models.fit_model

    def fit_one_tree(estimator, *rest):
        asked.append([estimator.getMaxIter(), estimator.getMaxDepth(), estimator.getStepSize(), estimator.getSubsamplingRate()])
        return fit(estimator.copy({estimator.maxIter: 1, estimator.maxDepth: 1}), *rest)

    monkeypatch.setattr(models, "fit_model", fit_one_tree)
    rows = catalog.ENTRIES["k1_boosted_trees"].query(spark, "").collect()
    assert asked == [[400, 10, 0.03, 0.8]]
    assert sorted((r.event_id, r.label) for r in rows) == [(n, int(n >= 20)) for n in range(40)]
