"""Mapping of nested event documents to the unified record.

Three mappers share one reader and differ only in the tables of paths below and in a few rules.
Documents are flattened once; the rules read the texts of the paths in use.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions.documents import first_present, flatten_document, plain_texts, repeated_keys_allowed, to_float, to_int
from ..functions.reuse import built_once
from ..functions.text import once, strip

# The paths each mapper reads, in order of preference.
SHARED_PATHS = {
    "src_bytes": ["source.bytes", "suricata.eve.flow.bytes_toserver"],
    "dst_bytes": ["destination.bytes", "suricata.eve.flow.bytes_toclient"],
    "src_packets": ["source.packets", "suricata.eve.flow.pkts_toserver"],
    "dst_packets": ["destination.packets", "suricata.eve.flow.pkts_toclient"],
    "total_bytes": ["network.bytes"],
    "total_packets": ["network.packets"],
    "query": ["url.query", "http.request.query"],
    "app_protocol": ["network.application", "suricata.eve.app_proto"],
    "severity": ["event.severity", "suricata.eve.alert.severity"],
}
TWO_SOURCE_PATHS = SHARED_PATHS | {
    "duration": ["event.duration", "suricata.eve.flow.age", "suricata.eve.flow.start"],
    "any_total_bytes": ["network.bytes", "flow.bytes_toserver", "flow.bytes_toclient"],
    "original_uri": ["url.original", "http.request.referrer", "http.request.body.content"],
    "path": ["url.path", "http.request.path", "suricata.eve.http.url", "suricata.eve.http.hostname"],
    "request_line": ["http.request.line", "suricata.eve.http.http_user_agent"],
    "method": ["http.request.method", "http.method", "suricata.eve.http.http_method", "request.method"],
    "protocol": ["network.protocol", "network.transport", "protocol"],
}
FIREWALL_PATHS = TWO_SOURCE_PATHS | {
    "src_ip": ["source.ip", "src_ip"],
    "dst_ip": ["destination.ip", "dst_ip"],
    "src_port": ["source.port", "src_port"],
    "dst_port": ["destination.port", "dst_port"],
    "action": ["event.action"],
    "reason": ["event.reason", "message"],
    "rule": ["rule.name", "firewall.rule.name"],
}
IDS_ADDRESS_PATHS = {
    "src_ip": ["source.ip", "source.address"],
    "dst_ip": ["destination.ip", "destination.address"],
    "src_port": ["source.port"],
    "dst_port": ["destination.port"],
}
IDS_PATHS = TWO_SOURCE_PATHS | IDS_ADDRESS_PATHS | {
    "fallback_protocol": ["suricata.eve.proto"],
    "fallback_uri": ["rule.name", "suricata.eve.alert.signature", "message"],
    "action": ["event.kind", "event.action"],
    "reason": ["message"],
    "rule": ["rule.name", "suricata.eve.alert.signature"],
}
SINGLE_IDS_PATHS = SHARED_PATHS | IDS_ADDRESS_PATHS | {
    "duration": ["event.duration", "suricata.eve.flow.age"],
    "original_uri": ["url.original"],
    "path": ["url.path", "http.request.path", "suricata.eve.http.url"],
    "method": ["http.request.method", "http.method", "suricata.eve.http.http_method"],
    "protocol": ["network.protocol", "network.transport", "suricata.eve.proto"],
    "signature": ["rule.name", "suricata.eve.alert.signature"],
    "category": ["rule.category", "suricata.eve.alert.category"],
    "message": ["message"],
    "action": ["event.action", "event.kind"],
}
EVENT_COLUMNS = ["_index", "_id", "_source"]


@built_once
def _flattening(paths: tuple[str, ...]) -> tuple[Column, Column, Column, Column]:
    plain = F.col("_plain")
    pairs = F.when(plain.isNull(), flatten_document(F.col("_source"), paths))
    names = F.array(*[F.lit(path) for path in paths])
    values = F.transform(names, lambda n: F.get("_texts", F.array_position("_paths", n) - 1))
    numerals = F.transform(F.arrays_zip(names.alias("name"), F.col("_values").alias("value")), lambda v: F.when(F.array_contains("_trues", v["name"]), "1").otherwise(v["value"]))
    return pairs, values, F.when(F.coalesce(F.size("_trues"), F.lit(0)) <= 0, F.col("_values")).otherwise(numerals), plain_texts(F.col("_source"), paths)


def flatten(events: DataFrame, paths: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Flatten ``_source`` once: ``_values`` holds the text of each path in order, ``_paths`` the
    paths that occur, ``_numerals`` the texts as numbers read them: JSON true is 1.

    Plain documents are read in one pass each, the others as variants.
    """
    pairs, values, numerals, plain = _flattening(tuple(paths))
    trues = F.filter("_pairs", lambda p: p["is_true"])["path"]
    read = F.col("_plain").isNotNull()
    occur = F.when(F.col("_plain")[len(paths)] != "", F.split(F.col("_plain")[len(paths)], "\n")).otherwise(F.array().cast("array<string>"))
    return (
        repeated_keys_allowed(events)
        .select(*dict.fromkeys([*keep, "_source"]), plain.alias("_plain"))
        .select(*keep, "_plain", pairs.alias("_pairs"))
        .select(*keep, "_plain", once(F.col("_pairs.path")).alias("_paths"), once(F.col("_pairs.text")).alias("_texts"), once(trues).alias("_trues"))
        .select(
            *keep,
            once(F.when(read, occur).otherwise(F.col("_paths"))).alias("_paths"),
            "_trues",
            once(F.when(read, F.slice("_plain", 1, len(paths))).otherwise(values)).alias("_values"),
        )
        .select(*keep, "_paths", "_values", numerals.alias("_numerals"))
    )


class EventFields:
    """Values of one mapper by field name, over flattened events."""

    def __init__(self, paths: dict[str, list[str]]):
        self._paths = paths
        self.all_paths = list(dict.fromkeys([p for group in paths.values() for p in group] + ["@timestamp"]))

    def text(self, path: str) -> Column:
        return F.col("_values")[self.all_paths.index(path)]

    def get(self, name: str, default: str | None = "") -> Column:
        return first_present(*[self.text(path) for path in self._paths[name]], default=default)

    def stripped(self, name: str) -> Column:
        return strip(self.get(name))

    def numeral(self, path: str) -> Column:
        """The text at a path as numbers read it."""
        return F.col("_numerals")[self.all_paths.index(path)]

    def _numeral_of(self, name: str) -> Column:
        return first_present(*[self.numeral(path) for path in self._paths[name]])

    def number(self, name: str) -> Column:
        return to_float(self._numeral_of(name))

    def whole(self, name: str) -> Column:
        return to_int(self._numeral_of(name))


def duration_seconds(event: EventFields) -> Column:
    """Above a million the value is in nanoseconds."""
    value = event.number("duration")
    return F.when(value > 1_000_000, value / 1_000_000_000.0).otherwise(value)


def _two_way(event: EventFields, unit: str) -> Column:
    return event.number(f"src_{unit}") + event.number(f"dst_{unit}")


def packet_count(event: EventFields) -> Column:
    """The total if positive, else both directions if positive, else one packet."""
    total, both = event.number("total_packets"), _two_way(event, "packets")
    return F.when(total > 0, total).when(both > 0, both).otherwise(F.lit(1.0))


def byte_count(event: EventFields) -> Column:
    """A given total counts even if 0, provided some total field holds a value."""
    has_total = F.array_contains("_paths", "network.bytes")
    given = event.get("any_total_bytes", default=None).isNotNull() & has_total
    both = _two_way(event, "bytes")
    total = to_float(event.numeral("network.bytes"))
    return F.when(given, total).when(both > 0, both).otherwise(event.number("total_bytes"))


def single_byte_count(event: EventFields) -> Column:
    total, both = event.number("total_bytes"), _two_way(event, "bytes")
    return F.when(total > 0, total).when(both > 0, both).otherwise(F.lit(0.0))


def _path_and_query(event: EventFields) -> Column:
    """Null without a path."""
    path, query = event.stripped("path"), event.stripped("query")
    full = F.when(query != "", F.concat(path, F.lit("?"), query)).otherwise(path)
    return F.when(path != "", full)


def _is_http(event: EventFields) -> Column:
    return F.lower(event.stripped("app_protocol")).startswith("http")


def request_uri(event: EventFields) -> Column:
    """Original URI, else path and query, else the request line."""
    original = F.nullif(event.stripped("original_uri"), F.lit(""))
    return F.coalesce(original, _path_and_query(event), event.stripped("request_line"))


def ids_uri(event: EventFields) -> Column:
    """As :func:`request_uri`; an HTTP alert without any falls back to its rule, signature or message."""
    uri = request_uri(event)
    fallback = F.when(_is_http(event), event.stripped("fallback_uri")).otherwise(F.lit(""))
    return F.when(uri != "", uri).otherwise(fallback)


def single_ids_uri(event: EventFields) -> Column:
    original = F.nullif(event.stripped("original_uri"), F.lit(""))
    signature = F.when(_is_http(event), event.stripped("signature")).otherwise(F.lit(""))
    return F.coalesce(original, _path_and_query(event), signature)


def _record(event: EventFields, protocol: Column, size: Column, uri: Column) -> dict[str, Column]:
    return {
        "src_ip": event.get("src_ip"),
        "dst_ip": event.get("dst_ip"),
        "src_port": event.whole("src_port"),
        "dst_port": event.whole("dst_port"),
        "protocol": protocol,
        "bytes": size,
        "packets": packet_count(event),
        "duration": duration_seconds(event),
        "http_method": F.upper(event.get("method")),
        "uri": uri,
        "label": F.lit(0),
    }


def _map(
    events: DataFrame,
    event: EventFields,
    source_type: str,
    record: dict[str, Column],
    context: dict[str, Column],
    keep: Sequence[str],
) -> DataFrame:
    """Record columns, ``event_timestamp``, ``source_type``, ids, context columns and ``_source``."""
    carried = list(dict.fromkeys([*keep, *EVENT_COLUMNS]))
    values = {
        **record,
        "event_timestamp": F.coalesce(event.text("@timestamp"), F.lit("")),
        "source_type": F.lit(source_type),
        "source_index": F.coalesce(F.col("_index"), F.lit("")),
        "source_id": F.coalesce(F.col("_id"), F.lit("")),
        **context,
    }
    # The generator is a fence: neither a later filter nor the planner's search for the origin of a join
    # key unfolds the mapping expressions, which takes seconds on every plan.
    row = F.struct(*[column.alias(name) for name, column in values.items()])
    return flatten(events, event.all_paths, carried).select(
        *[F.col(name) for name in keep], F.inline(F.array(row)), F.col("_source").alias("original_event")
    )


@built_once
def _firewall_columns() -> tuple[EventFields, dict[str, Column], dict[str, Column]]:
    event = EventFields(FIREWALL_PATHS)
    record = _record(event, F.upper(event.get("protocol")), byte_count(event), request_uri(event))
    context = {
        "action": event.get("action"),
        "reason": event.get("reason"),
        "rule_name": event.get("rule"),
        "severity": F.lit(0).cast("long"),
    }
    return event, record, context


@built_once
def _ids_columns() -> tuple[EventFields, dict[str, Column], dict[str, Column]]:
    event = EventFields(IDS_PATHS)
    own = F.nullif(F.upper(event.get("protocol")), F.lit(""))
    protocol = F.coalesce(own, F.upper(event.get("fallback_protocol")))
    record = _record(event, protocol, byte_count(event), ids_uri(event))
    context = {
        "action": event.get("action"),
        "reason": event.get("reason"),
        "rule_name": event.get("rule"),
        "severity": event.whole("severity"),
    }
    return event, record, context


@built_once
def _single_ids_columns() -> tuple[EventFields, dict[str, Column], dict[str, Column]]:
    event = EventFields(SINGLE_IDS_PATHS)
    record = _record(event, F.upper(event.get("protocol")), single_byte_count(event), single_ids_uri(event))
    context = {
        "signature": event.get("signature"),
        "severity": event.whole("severity"),
        "category": event.get("category"),
        "action": event.get("action", default="alert"),
        "message": event.get("message"),
    }
    return event, record, context


def map_firewall_events(events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    event, record, context = _firewall_columns()
    return _map(events, event, fixed.FIREWALL_EVENTS, record, context, keep)


def map_ids_events(events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    event, record, context = _ids_columns()
    return _map(events, event, fixed.IDS_EVENTS, record, context, keep)


def map_single_ids_events(events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    event, record, context = _single_ids_columns()
    return _map(events, event, fixed.IDS_EVENTS, record, context, keep)
