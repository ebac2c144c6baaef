import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from netsieve.operators import alerts, events, scoring, state
from netsieve.operators.sinks import append_batch, read_table
from netsieve.operators.sizing import scratch_path
from netsieve.plans import telemetry
from netsieve.sources import events as sources
from netsieve.streaming import jobs

SCHEMA = "_index string, _id string, _source string"


def stamp(seconds):
    return f"2024-01-01T00:00:{seconds:06.3f}Z"


def drop(folder, name, hits):
    """One file of events, moved into place as a whole."""
    os.makedirs(folder, exist_ok=True)
    lines = [json.dumps({"_index": "i", "_id": key, "_source": json.dumps({"@timestamp": stamp(at)})}) for key, at in hits]
    temporary = f"{folder}-{name}.tmp"
    with open(temporary, "w") as handle:
        handle.write("\n".join(lines))
    shutil.copy(temporary, f"{folder}/{name}.json")


def run(spark, folder, out, checkpoint, lateness):
    stream = sources.with_timestamp(sources.event_stream(spark, folder))
    query = jobs.to_json_files(jobs.deduplicate(stream, lateness), out, checkpoint, available_now=True)
    query.awaitTermination(120)
    return sorted((r._id, r.timestamp) for r in spark.read.schema(SCHEMA + ", timestamp string").json(out).collect())


BATCHES = [
    [("1", 0), ("1", 0), ("2", 5)],
    [("2", 5), ("3", 5), ("1", 9)],
    [("9", 1), ("8", 8.998), ("4", 10)],
]


def test_strict_deduplication_across_restarts(spark, folder):
    source, out, checkpoint = f"{folder}/in", f"{folder}/out", f"{folder}/ckpt"
    for number, hits in enumerate(BATCHES):
        drop(source, f"b{number}", hits)
        found = run(spark, source, out, checkpoint, jobs.STRICT_LATENESS)
    assert found == sorted((k, stamp(s)) for k, s in [("1", 0), ("2", 5), ("3", 5), ("1", 9), ("4", 10)])


def test_late_events_are_kept_by_default(spark, folder):
    source, out, checkpoint = f"{folder}/in", f"{folder}/out", f"{folder}/ckpt"
    for number, hits in enumerate(BATCHES):
        drop(source, f"b{number}", hits)
        found = run(spark, source, out, checkpoint, jobs.DEFAULT_LATENESS)
    assert found == sorted({(k, stamp(s)) for hits in BATCHES for k, s in hits})


def test_start_from_latest(spark):
    rows = [("i", "a", stamp(1)), ("i", "b", stamp(2)), ("i", "c", stamp(2)), ("i", "d", stamp(3))]
    hits = [(i, k, json.dumps({"@timestamp": t})) for i, k, t in rows]
    stored = spark.createDataFrame(hits[:2], SCHEMA)
    found = jobs.from_latest(spark.createDataFrame(hits, SCHEMA), stored)
    assert sorted(r._id for r in found.collect()) == ["c", "d"]
    empty = spark.createDataFrame([], SCHEMA)
    assert jobs.from_latest(spark.createDataFrame(hits, SCHEMA), empty).count() == 4


def test_pages(spark):
    hits = [("i", str(n), json.dumps({"@timestamp": stamp(n % 5)})) for n in range(20)]
    timed = sources.with_timestamp(spark.createDataFrame(hits, SCHEMA))
    page = sources.page(timed, 3, stamp(3)).collect()
    assert [(r._id, r.timestamp) for r in page] == [("13", stamp(3)), ("18", stamp(3)), ("3", stamp(3))]
    assert tuple(sources.newest(timed).first()) == (stamp(4), "i", "9")


@pytest.fixture(scope="module")
def fitted(spark, small):
    return state.fit_to(telemetry.unified_view(spark, small), scratch_path(spark, "state"))


def test_alert_table_and_outbox_equal_the_batch_result(spark, small, folder, fitted):
    docs = telemetry.document_view(spark, small).select("_index", "_id", "_source").limit(200)
    docs.write.json(f"{folder}/in")
    docs = sources.event_batch(spark, f"{folder}/in")
    batch = alerts.alert_records(alerts.score_events(events.map_firewall_events(docs), fitted, scoring.rule_scorer))
    expected = sorted((r.source_ref.id, round(r.ml.malicious_probability, 9)) for r in alerts.only_alerts(batch).collect())

    def stream():
        source = sources.event_stream(spark, f"{folder}/in")
        return jobs.scored_stream(source, events.map_firewall_events, fitted, scoring.rule_scorer)

    jobs.to_alert_table(stream(), f"{folder}/alerts", f"{folder}/c1", alerts_only=True, available_now=True).awaitTermination(180)
    found = read_table(spark, f"{folder}/alerts").collect()
    assert sorted((r.source_ref.id, round(r.ml.malicious_probability, 9)) for r in found) == expected and expected

    query = jobs.to_outbox(
        stream(), alerts.notice_text(), lambda r: alerts.notifiable(r, 0.5), f"{folder}/outbox", f"{folder}/c2", available_now=True
    )
    query.awaitTermination(180)
    sent = read_table(spark, f"{folder}/outbox").collect()
    assert sorted(r.source_id for r in sent) == [key for key, _ in expected]
    assert all(r.message.startswith("<b>Cyber Alert</b>\nTime: <code>2024") for r in sent)


def test_repeated_batch_adds_nothing(spark, folder):
    write = append_batch(f"{folder}/table", "checkpoint-a")
    assert read_table(spark, f"{folder}/table").count() == 0
    write(spark.range(3), 0)
    write(spark.range(3), 0)
    write(spark.range(2), 1)
    append_batch(f"{folder}/table", "checkpoint-b")(spark.range(4), 0)
    rows = read_table(spark, f"{folder}/table")
    assert rows.count() == 9 and rows.select("stream", "batch_id").distinct().count() == 3


def test_a_batch_killed_half_way_is_invisible(spark, folder, monkeypatch):
    from netsieve.operators import sinks

    write = append_batch(f"{folder}/table", "checkpoint-a")
    write(spark.range(2), 0)

    def killed(*_):
        raise RuntimeError("killed before the record")

    with monkeypatch.context() as broken:
        broken.setattr(sinks, "claim_file", killed)
        with pytest.raises(RuntimeError):
            write(spark.range(5), 1)
    assert sorted(r.id for r in read_table(spark, f"{folder}/table").collect()) == [0, 1]
    write(spark.range(5), 1)
    write(spark.range(5), 1)
    assert sorted(r.id for r in read_table(spark, f"{folder}/table").collect()) == [0, 0, 1, 1, 2, 3, 4]


def test_a_new_fit_counts_from_the_next_batch(spark, small, folder):
    """One running stream, two files; between them another state is published."""
    view = telemetry.unified_view(spark, small)
    root = f"{folder}/state"
    state.publish_state(view.limit(1), root)
    source = state.PublishedState(root)
    docs = telemetry.document_view(spark, small).select("_index", "_id", "_source").limit(60).collect()
    frames = [spark.createDataFrame(docs[:30], SCHEMA), spark.createDataFrame(docs[30:], SCHEMA)]

    def by_frequency(features, prefix=""):
        return features.withColumn(f"{prefix}probability", F.col(f"{prefix}src_ip_frequency").cast("double"))

    frames[0].coalesce(1).write.mode("append").json(f"{folder}/in")
    stream = sources.event_stream(spark, f"{folder}/in")
    query = jobs.scored_batches(stream, events.map_firewall_events, source, by_frequency, append_batch(f"{folder}/table", "c"), f"{folder}/c", interval="1 second")
    try:
        query.processAllAvailable()
        state.publish_state(view, root)
        frames[1].coalesce(1).write.mode("append").json(f"{folder}/in")
        query.processAllAvailable()
    finally:
        query.stop()
    best = {}
    for r in read_table(spark, f"{folder}/table").collect():
        best[r.source_ref.id] = r.ml.malicious_probability
    assert max(best[d._id] for d in docs[:30]) == 0 < max(best[d._id] for d in docs[30:])


def test_both_sources_with_a_fitted_model_into_one_table(spark, small, folder, monkeypatch):
    """The streams end to end, on state above the broadcast limit; a restart adds nothing."""
    from netsieve.operators import features, models

    view = telemetry.unified_view(spark, small)
    monkeypatch.setattr(state, "BROADCAST_ROWS", 1)
    root = f"{folder}/state"
    stored = state.load_state(spark, state.publish_state(view, root))
    table = features.transform(view.limit(500), stored, ["label"]).withColumn("label", (F.rand(3) < 0.4).cast("int"))
    scorer = scoring.model_scorer(models.fit_model(models.random_forest(trees=2, depth=3), table, F.lit(1.0)))
    docs = telemetry.document_view(spark, small).select("_index", "_id", "_source").limit(120)
    docs.write.json(f"{folder}/in")
    batch_docs = sources.event_batch(spark, f"{folder}/in")

    def run():
        for name, mapper, mode, pick in (("fw", events.map_firewall_events, None, lambda e: e), ("ids", events.map_single_ids_events, "suricata_or_ml", sources.ids_alerts)):
            stream = pick(sources.event_stream(spark, f"{folder}/in"))
            write = append_batch(f"{folder}/table/{name}", f"{folder}/c-{name}")
            jobs.scored_batches(stream, mapper, state.PublishedState(root), scorer, write, f"{folder}/c-{name}", ids_mode=mode, available_now=True).awaitTermination(300)

    run()
    run()
    for name, mapper, pick in (("fw", events.map_firewall_events, lambda e: e), ("ids", events.map_single_ids_events, sources.ids_alerts)):
        want = alerts.score_events(mapper(pick(batch_docs)), stored, scorer).select("source_id", F.round("malicious_probability", 9)).collect()
        got = read_table(spark, f"{folder}/table/{name}").select("source_ref.id", F.round("ml.malicious_probability", 9)).collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and got


def test_plain_records_are_scored_once(spark, small, folder, fitted):
    from pyspark.sql.functions import udf

    calls = {"": spark.sparkContext.accumulator(0), "web_": spark.sparkContext.accumulator(0)}

    def counting(features, prefix=""):
        seen = calls[prefix]

        @udf("double")
        def count(score):
            seen.add(1)
            return score

        scored = scoring.rule_scorer(features, prefix)
        return scored.withColumn(f"{prefix}probability", count(F.col(f"{prefix}probability")))

    docs = telemetry.document_view(spark, small).select("_index", "_id", "_source").limit(150)
    docs.coalesce(1).write.json(f"{folder}/in")
    stream = sources.event_stream(spark, f"{folder}/in")
    written = []
    jobs.scored_batches(
        stream, events.map_ids_events, fitted, counting, lambda rows, _: written.extend(rows.collect()), f"{folder}/c", available_now=True
    ).awaitTermination(200)
    mapped = events.map_ids_events(sources.event_batch(spark, f"{folder}/in"))
    suspicious = mapped.filter(scoring.is_suspicious(F.col("uri"))).count()
    assert len(written) == 150 and 0 < suspicious < 150
    assert (calls[""].value, calls["web_"].value) == (150, suspicious)


def test_console(spark, folder):
    spark.range(3).selectExpr("id").write.json(f"{folder}/in")
    stream = spark.readStream.schema("id long").json(f"{folder}/in")
    query = jobs.to_console(stream, f"{folder}/c", available_now=True)
    assert query.awaitTermination(120) and query.exception() is None and query.lastProgress["numInputRows"] == 3


def test_events_without_a_time_do_not_stop_the_stream(spark, folder):
    rows = [("i", "1", '{"@timestamp":"2024-01-01T00:00:00Z"}'), ("i", "1", '{"@timestamp":"2024-01-01T00:00:00Z"}'), ("i", "2", "{}"), ("i", "3", '{"@timestamp":"soon"}')]
    spark.createDataFrame(rows, "_index string, _id string, _source string").coalesce(1).write.json(f"{folder}/in")
    from netsieve.sources.events import event_stream, with_timestamp

    fresh = jobs.deduplicate(with_timestamp(event_stream(spark, f"{folder}/in")))
    jobs.to_json_files(fresh, f"{folder}/out", f"{folder}/c", available_now=True).awaitTermination(180)
    assert sorted(r._id for r in spark.read.json(f"{folder}/out").collect()) == ["1", "2", "3"]


def test_alerts_of_any_list_element(spark):
    from netsieve.sources.events import ids_alerts

    documents = [
        '{"event":{"module":"suricata","kind":"alert"}}', '{"event":{"module":["zeek","suricata"],"kind":"alert"}}',
        '{"event":{"module":"\\u0073uricata","kind":["alert"]}}', '{"event.module":"suricata","event.kind":"alert"}',
        '{"event":{"module":"zeek","kind":"alert"},"note":"suricata"}', "{}",
    ]
    frame = spark.createDataFrame([("i", str(k), d) for k, d in enumerate(documents)], "_index string, _id string, _source string")
    assert sorted(r._id for r in ids_alerts(frame).collect()) == ["0", "1", "2", "3"]
