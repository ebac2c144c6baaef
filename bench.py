"""Headline timings. Prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Inputs are staged once as Parquet with one part per core, since the driver tables are single small
files. Each query then runs twice to a sink that discards rows; the better time counts.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from netsieve.operators import alerts, evaluate, events, features, scoring, split, state, unify, weights
from netsieve.operators.sizing import scratch_path
from netsieve.plans import ranking, telemetry
from netsieve.sources import events as event_sources
from netsieve.streaming import jobs

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("netsieve-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def staged(spark: SparkSession, frame, name: str):
    path = scratch_path(spark, name)
    frame.repartition(int(CPUS)).write.parquet(path)
    return spark.read.parquet(path)


def discard(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = session()
    raw = staged(spark, telemetry.flow_view(spark, FOLDER), "raw")
    unified = staged(spark, unify.unify_records(raw, F.col("source_name"), original_label="label", keep=["event_id"]), "unified")
    docs = staged(spark, telemetry.documents(raw).drop("ts"), "docs")
    fitted = state.fit_to(unified, scratch_path(spark, "state"))
    scored = staged(
        spark,
        scoring.predict(unified, fitted, scoring.rule_scorer, ["event_id", "label"]).withColumnRenamed("malicious_probability", "probability"),
        "scored",
    )
    event_folder = scratch_path(spark, "events")
    docs.select("_index", "_id", "_source").write.json(event_folder)

    def normalise():
        keep = ["event_id"]
        discard(
            unify.union_sources(
                unify.unify_flow_table(telemetry.flow_table_view(raw), keep=keep),
                unify.unify_flow_csv(telemetry.flow_csv_view(raw), keep=keep),
                unify.unify_payloads(telemetry.payload_view(raw), keep=keep),
                unify.unify_firewall_log(telemetry.firewall_view(raw), keep=keep),
            )
        )

    def evaluation():
        discard(evaluate.evaluation_row(scored))
        discard(evaluate.classification_report(scored))

    def stream():
        source = event_sources.event_stream(spark, event_folder)
        records = jobs.scored_stream(source, events.map_ids_events, fitted, scoring.rule_scorer)
        query = jobs.to_json_files(records, scratch_path(spark, "out"), scratch_path(spark, "ckpt"), available_now=True)
        query.awaitTermination()

    def shuffled_lookups():
        """The join form for state too large to broadcast, hot keys split off."""
        large = {name: (1 << 40, 1 << 50) for name in (*state.COUNT_KINDS, "sources")}
        sized = state.FeatureState(fitted.protocol, fitted.http_method, fitted.sources, fitted.counts, fitted.total, fitted.sizes | large)
        discard(features.transform(unified, sized, ["event_id"]))

    queries = {
        "normalise_all_sources": normalise,
        "fit_state": lambda: state.fit_to(unified, scratch_path(spark, "state")),
        "transform_features": lambda: discard(features.transform(unified, fitted, ["event_id", "label"])),
        "transform_features_shuffled": shuffled_lookups,
        "sample_weights": lambda: discard(weights.with_sample_weights(unified)),
        "stratified_split": lambda: discard(split.stratified_split(unified, ["event_id"])),
        "score_both_views": lambda: discard(scoring.predict(unified, fitted, scoring.rule_scorer, ["event_id"])),
        "evaluate": evaluation,
        "map_events": lambda: discard(events.map_ids_events(docs, ["event_id"])),
        "alert_records": lambda: discard(
            alerts.alert_records(alerts.score_events(events.map_ids_events(docs), fitted, scoring.rule_scorer))
        ),
        "attack_ranking": lambda: discard(ranking.attack_ranking(unified)),
        "stream_map_dedup_score": stream,
    }
    seconds = {}
    for name, query in queries.items():
        times = []
        for _ in range(2):
            start = time.time()
            query()
            times.append(time.time() - start)
        seconds[name] = round(min(times), 3)
    rows = unified.count()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows": rows,
                "sf": os.path.basename(FOLDER.rstrip("/")),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
