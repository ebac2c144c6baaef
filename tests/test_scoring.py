import pytest
from pyspark.sql import functions as F

from netsieve.operators import alerts, evaluate, events, scoring, state
from netsieve.operators.sizing import scratch_path
from netsieve.operators.unify import unify_for_inference
from netsieve.plans import prediction, telemetry


@pytest.fixture(scope="module")
def unified(spark, small):
    return telemetry.unified_view(spark, small).persist()


@pytest.fixture(scope="module")
def fitted(spark, unified):
    return state.fit_to(unified, scratch_path(spark, "state"))


def keyed_scorer(features, prefix):
    """Uses looked-up features, so that the lookups of both views matter."""
    score = sum(
        F.col(f"{prefix}{name}").cast("double")
        for name in (
            "sql_attack_score", "xss_attack_score", "endpoint_frequency", "repeated_access_count", "src_ip_frequency",
            "dst_ip_frequency", "src_dst_pair_frequency", "unique_dst_ports_per_source", "protocol_encoded",
            "http_method_frequency", "bytes", "packets", "http_like_request",
        )
    )
    return features.withColumn(f"{prefix}probability", score / (score + 50.0))


def test_web_view_equals_scoring_the_payload_alone(spark, unified, fitted):
    both = scoring.score_both_views(unified, fitted, keyed_scorer, ["event_id", "uri"]).filter("web_probability IS NOT NULL")
    payloads = unify_for_inference(both.select("event_id", F.col("uri").alias("payload")), keep=["event_id"])
    alone = scoring.score_both_views(payloads, fitted, keyed_scorer, ["event_id"], web_uri=None)
    assert both.count() > 100
    joined = both.join(alone.select("event_id", F.col("probability").alias("expected")), "event_id")
    assert joined.count() == both.count()
    assert joined.filter(F.abs(F.col("web_probability") - F.col("expected")) > 1e-12).count() == 0


def test_branch_form_gives_the_same_rows(unified, fitted):
    forms = [
        sorted(map(tuple, scoring.predict(unified, fitted, keyed_scorer, ["event_id"], branch=branch).collect()))
        for branch in (False, True)
    ]
    assert forms[0] == forms[1] and len(forms[0]) == unified.count()


def test_ties_keep_the_primary_view(spark):
    rows = spark.createDataFrame([(0.5, 0.5), (0.5, 0.6), (0.5, None)], "probability double, web_probability double")
    assert [r.selected_view for r in scoring.choose_view(rows).collect()] == ["primary", "web_payload", "primary"]


def test_risk_and_decision_bounds(spark):
    rows = spark.createDataFrame([(p,) for p in (0.85, 0.8499, 0.5, 0.4999, 0.2, 0.1999)], "p double")
    found = rows.select(scoring.risk_level(F.col("p")), scoring.decide(F.col("p"))).collect()
    assert [tuple(r) for r in found] == [("high", 1), ("medium", 1), ("medium", 1), ("low", 0), ("low", 0), ("benign", 0)]


def test_web_view_needs_a_second_column_named_uri(spark, fitted):
    attack = "/a?x=<script>"
    two = spark.createDataFrame([(0, "GET", attack)], "index long, method string, uri string")
    named = spark.createDataFrame([(0, "GET", attack)], "index long, method string, url string")
    views = [prediction.predict_table(t, fitted, keyed_scorer).first().selected_view for t in (named,)]
    assert views == ["primary"]
    row = prediction.predict_table(two, fitted, lambda f, p: f.withColumn(f"{p}probability", F.lit(0.9 if p else 0.1))).first()
    assert (row.selected_view, row.prediction) == ("web_payload", 1)


def test_uri_of_another_layout_still_gets_a_web_view(spark, fitted):
    columns = ["index", "Src IP", "Dst IP", "Log subtype", "uri"]
    firewall = spark.createDataFrame([(0, "1.1.1.1", "2.2.2.2", "Denied", "/x?q=<script>")], columns)
    row = prediction.predict_table(firewall, fitted, lambda f, p: f.withColumn(f"{p}probability", F.lit(0.9 if p else 0.1))).first()
    assert row.normalized_record.uri == "" and row.selected_view == "web_payload"


# --- metrics --------------------------------------------------------------------------------


def scored(spark, rows):
    return spark.createDataFrame([(a, b, b / 2) for a, b in rows], "label int, prediction int, probability double")


def test_one_class_input(spark):
    table = scored(spark, [(0, 0)] * 3)
    assert tuple(evaluate.binary_metrics(table).first()) == (1.0, 0.0, 0.0, 0.0)
    assert [tuple(r) for r in evaluate.confusion_matrix(table).collect()] == [("actual_0", 3, 0), ("actual_1", 0, 0)]
    report = {r.name: (r.f1_score, r.support) for r in evaluate.classification_report(table).collect()}
    assert report == {"0": (1.0, 3), "accuracy": (1.0, 3), "macro avg": (1.0, 3), "weighted avg": (1.0, 3)}


def test_metrics(spark):
    table = scored(spark, [(1, 1)] * 3 + [(1, 0)] * 1 + [(0, 1)] * 2 + [(0, 0)] * 4)
    row = evaluate.binary_metrics(table).first()
    assert (row.accuracy, row.precision, row.recall) == (0.7, 0.6, 0.75)
    assert row.f1_score == pytest.approx(2 * 0.6 * 0.75 / 1.35)
    report = {r.name: r for r in evaluate.classification_report(table).collect()}
    assert report["0"].precision == 0.8 and report["0"].support == 6
    assert report["macro avg"].precision == pytest.approx(0.7)
    assert report["weighted avg"].recall == pytest.approx(0.7)


def test_best_candidate_order(spark):
    table = spark.createDataFrame([(0, "a", 0.5, 0.9), (1, "b", 0.5, 0.9), (2, "c", 0.4, 1.0)], "position int, name string, f1 double, accuracy double")
    assert evaluate.best_candidate(table).first().name == "a"


# --- alerts ---------------------------------------------------------------------------------


def test_alert_decisions(spark):
    rows = spark.createDataFrame([(0,), (1,)], "prediction int")
    found = {
        mode: [tuple(r.d) for r in rows.select(alerts.decide_alert(F.col("prediction"), mode).alias("d")).collect()]
        for mode in ("ml_only", "suricata_only", "other")
    }
    assert found["ml_only"] == [(False, "ml_prediction"), (True, "ml_prediction")]
    assert found["suricata_only"] == [(True, "suricata_alert")] * 2
    assert found["other"] == [(True, "suricata_alert"), (True, "suricata_alert_and_ml")]


def test_event_keeps_its_own_values_while_the_model_sees_normalised_ones(spark, fitted):
    source = '{"source":{"ip":" 1.2.3.4 ","port":70000},"network":{"protocol":"-"},"url":{"original":"/a"}}'
    hits = spark.createDataFrame([("i", "1", source)], "_index string, _id string, _source string")
    port = lambda f, p: f.withColumn(f"{p}probability", F.col(f"{p}src_port").cast("double"))
    record = alerts.alert_records(alerts.score_events(events.map_firewall_events(hits), fitted, port)).first()
    assert record.network_event.src_port == 70000 and record.network_event.protocol == "-"
    assert record.ml.malicious_probability == 65535.0
    assert record["@timestamp"] == "" and record.source_ref.id == "1"
