"""Normalisation of each telemetry layout to the unified record.

Every normaliser is one ``select``: it reads only the columns it needs, so column pruning reaches
the scan, and it never shuffles. ``keep`` names columns (row keys, timestamps) carried through.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions import text
from ..functions.labels import label_from_number, label_from_words
from ..sources.columns import ColumnFinder, detect_format


def unified_select(
    frame: DataFrame,
    columns: dict[str, Column],
    label: Column,
    original_label: Column,
    source_name: str | Column,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Final coercion and column order. Columns left out become empty text or zero."""
    source = F.lit(source_name) if isinstance(source_name, str) else source_name

    def get(name: str, default: object) -> Column:
        return columns.get(name, F.lit(default))

    return frame.select(
        *[F.col(name) for name in keep],
        text.as_text(get("src_ip", "")).alias("src_ip"),
        text.as_text(get("dst_ip", "")).alias("dst_ip"),
        get("src_port", 0).cast("int").alias("src_port"),
        get("dst_port", 0).cast("int").alias("dst_port"),
        text.clean_protocol(get("protocol", "")).alias("protocol"),
        get("bytes", 0).cast("float").alias("bytes"),
        get("packets", 0).cast("float").alias("packets"),
        get("duration", 0).cast("float").alias("duration"),
        text.clean_method(get("http_method", "")).alias("http_method"),
        text.as_text(get("uri", "")).alias("uri"),
        label.alias("label"),
        source.alias("source_name"),
        text.as_text(original_label).alias("original_label_text"),
    )


def binary_label(column: Column, numeric: bool, label_mode: str) -> Column:
    """``keywords`` reads words in the label text; ``numeric`` keeps only what parses as a number."""
    if label_mode == "keywords":
        return label_from_words(column, numeric)
    if label_mode == "numeric":
        return label_from_number(column, numeric)
    raise ValueError(f"label_mode must be 'keywords' or 'numeric', not {label_mode!r}")


def unify_records(
    frame: DataFrame,
    source_name: str | Column,
    label_mode: str = "keywords",
    original_label: str | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """A table that already has unified column names: coerce, label, add provenance."""
    found = ColumnFinder(frame, keep)
    columns = {name: found.raw(name) for name in fixed.TEXT_COLUMNS}
    columns |= {name: found.port(name) for name in ("src_port", "dst_port")}
    columns |= {name: found.number(name) for name in ("bytes", "packets", "duration")}
    label = binary_label(found.raw("label", default=0), found.is_numeric("label", default=0), label_mode)
    shown = label if original_label is None else found.raw(original_label)
    return unified_select(frame, columns, label, shown, source_name, keep)


def unify_flow_table(
    frame: DataFrame,
    source_name: str = fixed.FLOW_PARQUET_SOURCE,
    label_mode: str = "keywords",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Flow records with two-way byte and packet counts and no addresses."""
    found = ColumnFinder(frame, keep)
    http = found.number("ct_flw_http_mthd") > 0
    columns = {
        "protocol": found.raw("proto", "protocol"),
        "bytes": found.number("sbytes") + found.number("dbytes"),
        "packets": found.number("spkts") + found.number("dpkts"),
        "duration": found.number("dur", "duration"),
        "http_method": F.when(http, F.lit("UNKNOWN_HTTP")).otherwise(F.lit("")),
    }
    names = ("label", "attack_cat")
    label = binary_label(found.raw(*names, default=0), found.is_numeric(*names, default=0), label_mode)
    return unified_select(frame, columns, label, found.raw("attack_cat", "label"), source_name, keep)


def unify_flow_csv(
    frame: DataFrame,
    source_name: str = fixed.FLOW_CSV_SOURCE,
    label_mode: str = "keywords",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Flow statistics with addresses; durations are in microseconds."""
    found = ColumnFinder(frame, keep)
    columns = {
        "src_ip": found.raw("Source IP", "Src IP", "src_ip"),
        "dst_ip": found.raw("Destination IP", "Dst IP", "dst_ip"),
        "src_port": found.port("Source Port", "Src Port", "src_port"),
        "dst_port": found.port("Destination Port", "Dst Port", "dst_port"),
        "protocol": found.raw("Protocol", "Proto"),
        "bytes": found.number("Total Length of Fwd Packets", "Subflow Fwd Bytes")
        + found.number("Total Length of Bwd Packets", "Subflow Bwd Bytes"),
        "packets": found.number("Total Fwd Packets", "Subflow Fwd Packets")
        + found.number("Total Backward Packets", "Subflow Bwd Packets"),
        "duration": found.number("Flow Duration") / F.lit(1_000_000.0),
    }
    label = binary_label(found.raw("Label"), found.is_numeric("Label"), label_mode)
    return unified_select(frame, columns, label, found.raw("Label"), source_name, keep)


def unify_firewall_log(
    frame: DataFrame,
    source_name: str = fixed.FIREWALL_SOURCE,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Firewall log lines, labelled by rule. A missing or non-numeric rule type counts as 0."""
    found = ColumnFinder(frame, keep)
    subtype = found.string("Log subtype")
    rule = found.string("Firewall rule name")
    message = found.string("Message")
    blocked = (
        (F.lower(subtype) != "allowed")
        | rule.rlike("(?i)" + fixed.BLOCKING_RULE_PATTERN)
        | (message != "")
        | (found.number("Rule type") == 0)
    )
    columns = {
        "src_ip": found.raw("Src IP", "src_ip"),
        "dst_ip": found.raw("Dst IP", "dst_ip"),
        "src_port": found.port("Src port", "src_port"),
        "dst_port": found.port("Dst port", "dst_port"),
        "protocol": found.raw("protocol", "proto"),
        "packets": found.number("Log occurrence", default=1),
    }
    shown = F.coalesce(F.nullif(subtype, F.lit("")), F.nullif(rule, F.lit("")), message)
    return unified_select(frame, columns, blocked.cast("byte"), shown, source_name, keep)


def payload_record(payload: Column) -> dict[str, Column]:
    """The unified fields of one raw web payload."""
    decoded = text.payload_text(payload)
    return {
        "protocol": F.lit("HTTP"),
        "bytes": F.length(decoded).cast("float"),
        "packets": F.lit(1),
        "http_method": F.lit("GET"),
        "uri": decoded,
    }


def unify_payloads(
    frame: DataFrame,
    source_name: str = fixed.PAYLOAD_SOURCE,
    payload: str = "payload",
    label: str | None = "label",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Raw web payloads, one text per row. Without a label column every row is benign."""
    given = F.lit(0) if label is None else F.col(label)
    value = label_from_number(given, numeric=True)
    return unified_select(
        frame, payload_record(F.col(f"`{payload}`")), value, given.cast("string"), source_name, keep
    )


def unify_generic(
    frame: DataFrame,
    source_name: str = fixed.INFERENCE_SOURCES["generic"],
    keep: Sequence[str] = (),
) -> DataFrame:
    """Any table, by alias groups. The label stays the given whole number."""
    found = ColumnFinder(frame, keep)
    aliases = fixed.GENERIC_ALIASES
    columns = {name: found.raw(*aliases[name]) for name in fixed.TEXT_COLUMNS}
    columns |= {name: found.port(*aliases[name]) for name in ("src_port", "dst_port")}
    columns |= {name: found.number(*aliases[name]) for name in ("bytes", "packets", "duration")}
    label = F.coalesce(found.number(*aliases["label"]).try_cast("int"), F.lit(0))
    return unified_select(frame, columns, label, found.raw("label"), source_name, keep)


def unify_for_inference(frame: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Detect the layout from the column names and normalise accordingly."""
    names = [name for name in frame.columns if name not in set(keep)]
    layout = detect_format(names)
    source = fixed.INFERENCE_SOURCES[layout]
    if layout == "unsw":
        return unify_flow_table(frame, source, keep=keep)
    if layout == "cic":
        return unify_flow_csv(frame, source, keep=keep)
    if layout == "firewall":
        return unify_firewall_log(frame, source, keep=keep)
    if layout == "modsec":
        return unify_payloads(frame, source, payload=names[0], label=None, keep=keep)
    return unify_generic(frame, source, keep=keep)


def union_sources(*sources: DataFrame) -> DataFrame:
    """UNION ALL of normalised sources."""
    merged = sources[0]
    for source in sources[1:]:
        merged = merged.unionByName(source)
    return merged
