"""Event sources: documents ``(_index, _id, _source)``, filtered, ordered and limited as asked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.documents import any_value, leaf, repeated_keys_allowed
from ..functions.text import once

EVENT_SCHEMA = "_index string, _id string, _source string"


def event_stream(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """JSON-lines files of events as a stream; the source of each micro-batch is bounded by files."""
    reader = spark.readStream.schema(EVENT_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(folder)


def event_batch(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(EVENT_SCHEMA).json(folder)


def document_value(path: str) -> Column:
    return leaf(F.col("_source"), path)


def event_timestamp() -> Column:
    """The ``@timestamp`` text; empty if missing."""
    return F.coalesce(document_value("@timestamp"), F.lit(""))


def ids_alerts(events: DataFrame) -> DataFrame:
    """Alerts of the intrusion detection module. Of a list of values any one counts."""
    document = F.col("_source")
    return repeated_keys_allowed(events).filter(any_value(document, "event.module", "suricata") & any_value(document, "event.kind", "alert"))


def with_timestamp(events: DataFrame) -> DataFrame:
    return repeated_keys_allowed(events).withColumn("timestamp", once(event_timestamp()))


def since(events: DataFrame, cursor: str | None) -> DataFrame:
    """Events at or after the cursor. Timestamps are ISO text and compare as text."""
    return events if not cursor else events.filter(F.col("timestamp") >= cursor)


def page(events: DataFrame, size: int, cursor: str | None = None) -> DataFrame:
    """The oldest ``size`` events from a cursor on; ties in id order."""
    return since(events, cursor).orderBy("timestamp", "_index", "_id").limit(size)


def newest(events: DataFrame) -> DataFrame:
    """The newest event as (timestamp, _index, _id): one partial maximum, no sort."""
    top = F.max(F.struct("timestamp", "_index", "_id")).alias("top")
    return events.agg(top).select("top.*").filter(F.col("timestamp").isNotNull())


def after_newest(events: DataFrame, cursor: tuple[str, str, str]) -> DataFrame:
    """Start from the latest: later events, and other events at the cursor time."""
    timestamp, index, key = cursor
    same_event = (F.col("_index") == index) & (F.col("_id") == key)
    return events.filter(
        (F.col("timestamp") > timestamp) | ((F.col("timestamp") == timestamp) & ~same_event)
    )
