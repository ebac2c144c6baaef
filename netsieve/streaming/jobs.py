"""Streaming form of event scoring. The mappers and scorers are those of the batch jobs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..operators.alerts import alert_records, ids_alert_records, only_alerts, outbox, score_events
from ..operators.lookups import narrowed
from ..operators.scoring import Scorer
from ..operators.sinks import append_batch
from ..operators.state import FeatureState, PublishedState
from ..operators.unify import unify_generic
from ..sources.events import after_newest, newest, since, with_timestamp

DEFAULT_LATENESS = "10 minutes"
# Accepts a new event at the newest time seen and drops everything older.
STRICT_LATENESS = "1 milliseconds"


def deduplicate(events: DataFrame, lateness: str = DEFAULT_LATENESS) -> DataFrame:
    """Drop repeats of an event, and events later than ``lateness``.

    Needs ``timestamp`` (text), ``_index`` and ``_id``. The same id at another time is another event,
    so the time is part of the key; only that window of keys is kept as state. Events without a valid
    time go round the watermark and are not deduplicated: no state could ever be dropped for them.
    """
    event_time = F.date_trunc("millisecond", F.try_to_timestamp("timestamp"))
    timed = events.filter(event_time.isNotNull()).withColumn("event_time", event_time)
    fresh = timed.withWatermark("event_time", lateness).dropDuplicates(["_index", "_id", "timestamp", "event_time"])
    return fresh.drop("event_time").unionByName(events.filter(event_time.isNull()))


def deduplicate_batch(events: DataFrame) -> DataFrame:
    """Batch form: one row per (index, id, time)."""
    return events.dropDuplicates(["_index", "_id", "timestamp"])


def from_latest(stream: DataFrame, existing: DataFrame) -> DataFrame:
    """Skip what an existing table already holds: start from its newest event."""
    row = newest(with_timestamp(existing)).first()
    stream = with_timestamp(stream)
    return stream if row is None else after_newest(stream, (row.timestamp, row["_index"], row["_id"]))


def scored_stream(
    events: DataFrame,
    mapper: Callable[[DataFrame], DataFrame],
    state: FeatureState,
    scorer: Scorer,
    lateness: str = DEFAULT_LATENESS,
    cursor: str | None = None,
    ids_mode: str | None = None,
) -> DataFrame:
    """Events to alert records: time filter, deduplication, mapping, scoring."""
    timed = events if "timestamp" in events.columns else with_timestamp(events)
    fresh = deduplicate(since(timed, cursor), lateness)
    scored = score_events(mapper(fresh), state, scorer)
    return alert_records(scored) if ids_mode is None else ids_alert_records(scored, ids_mode)


def scored_batches(
    events: DataFrame,
    mapper: Callable[[DataFrame], DataFrame],
    state: PublishedState | FeatureState,
    scorer: Scorer,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    lateness: str = DEFAULT_LATENESS,
    cursor: str | None = None,
    ids_mode: str | None = None,
    alerts_only: bool = False,
    available_now: bool = False,
    interval: str | None = None,
) -> StreamingQuery:
    """Start a stream that scores each micro-batch with the state that is published when the batch begins.

    A newly published fit counts from the next batch on, without a restart. Of state too large to broadcast a batch reads the buckets of its own keys.
    Only suspicious records get the second view, and the model is called once for the others.
    ``write`` takes (records, batch id) and must repeat safely, as ``append_batch`` does. Several sources, each with its checkpoint, may write to one table.
    """
    timed = events if "timestamp" in events.columns else with_timestamp(events)
    fresh = deduplicate(since(timed, cursor), lateness)

    def score(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        now = state.current(spark) if isinstance(state, PublishedState) else state
        mapped = mapper(batch)
        mapped = mapper(batch).persist()  # read for its keys and for both branches
        try:
            scored = score_events(mapped, narrowed(now, unify_generic(mapped), "uri"), scorer, branch=True)
            records = alert_records(scored) if ids_mode is None else ids_alert_records(scored, ids_mode)
            write(only_alerts(records, alerts_only), batch_id)
        finally:
            mapped.unpersist()

    writer = fresh.writeStream.foreachBatch(score).option("checkpointLocation", checkpoint)
    return _once(writer, available_now, interval).start()


def union_streams(*records: DataFrame) -> DataFrame:
    """Records of several sources in one stream."""
    merged = records[0]
    for other in records[1:]:
        merged = merged.unionByName(other)
    return merged


def _once(writer: DataStreamWriter, available_now: bool, interval: str | None) -> DataStreamWriter:
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval) if interval else writer


def to_json_files(
    records: DataFrame, folder: str, checkpoint: str, available_now: bool = False, interval: str | None = None
) -> StreamingQuery:
    """One JSON object per line, exactly once by the file sink's log."""
    writer = records.writeStream.format("json").outputMode("append").option("checkpointLocation", checkpoint)
    return _once(writer, available_now, interval).start(folder)


def to_alert_table(
    records: DataFrame,
    folder: str,
    checkpoint: str,
    alerts_only: bool = False,
    available_now: bool = False,
    interval: str | None = None,
) -> StreamingQuery:
    """Table of scored records for ``sinks.read_table``; a repeated batch adds nothing."""
    writer = only_alerts(records, alerts_only).writeStream.foreachBatch(append_batch(folder, checkpoint))
    writer = writer.option("checkpointLocation", checkpoint)
    return _once(writer, available_now, interval).start()


def to_outbox(
    records: DataFrame,
    text,
    chosen: Callable[[DataFrame], DataFrame],
    folder: str,
    checkpoint: str,
    available_now: bool = False,
    interval: str | None = None,
) -> StreamingQuery:
    """Notification texts of the chosen records."""
    writer = outbox(chosen(records), text).writeStream.foreachBatch(append_batch(folder, checkpoint))
    return _once(writer.option("checkpointLocation", checkpoint), available_now, interval).start()


def to_console(records: DataFrame, checkpoint: str, available_now: bool = False, interval: str | None = None) -> StreamingQuery:
    writer = records.writeStream.format("console").option("truncate", False).option("checkpointLocation", checkpoint)
    return _once(writer, available_now, interval).start()
