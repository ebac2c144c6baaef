"""Alert records, alert decisions and notification texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions.text import html_escape, truncate
from .scoring import Scorer, predict, risk_level
from .state import FeatureState
from .unify import unify_generic


def _network_event() -> Column:
    return F.struct(*[F.col(name) for name in fixed.NETWORK_FIELDS]).alias("network_event")


def _head() -> list[Column]:
    return [
        F.col("event_timestamp").alias("@timestamp"),
        F.col("source_type"),
        F.struct(F.col("source_index").alias("index"), F.col("source_id").alias("id")).alias("source_ref"),
        _network_event(),
    ]


def _ml(with_alert: bool) -> Column:
    fields = [
        F.col("prediction"),
        F.col("malicious_probability"),
        risk_level(F.col("malicious_probability")).alias("risk_level"),
    ]
    if with_alert:
        fields.append((F.col("prediction") == 1).alias("alert"))
    return F.struct(
        *fields, F.col("selected_view"), F.lit(fixed.MODEL_FAMILY).alias("model_family")
    ).alias("ml")


def decide_alert(prediction: Column, mode: str) -> Column:
    """(triggered, reason): the model alone, the rule engine alone, or either."""
    hit = prediction == 1
    if mode == "ml_only":
        return F.struct(hit.alias("triggered"), F.lit("ml_prediction").alias("reason"))
    reason = F.lit("suricata_alert")
    if mode != "suricata_only":
        reason = F.when(hit, F.lit("suricata_alert_and_ml")).otherwise(reason)
    return F.struct(F.lit(True).alias("triggered"), reason.alias("reason"))


def score_events(mapped: DataFrame, state: FeatureState, scorer: Scorer, keep: Sequence[str] = (), branch: bool = False) -> DataFrame:
    """Predictions beside every column of the mapped event. ``branch``: the second view is built and scored for suspicious records only; ``mapped`` is read twice.

    The model sees the normalised record; the event keeps its values as mapped.
    """
    shown = {f"_shown_{name}": F.col(name) for name in fixed.NETWORK_FIELDS}
    others = [name for name in dict.fromkeys([*keep, *mapped.columns]) if name not in fixed.RECORD_COLUMNS]
    unified = unify_generic(mapped.withColumns(shown), keep=[*others, *shown])
    scored = predict(unified, state, scorer, [*others, *shown], branch=branch)
    return scored.withColumnsRenamed({column: name for column, name in zip(shown, fixed.NETWORK_FIELDS)})


def alert_records(scored: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Scored records of the two-source job."""
    return scored.select(
        *keep,
        *_head(),
        F.struct("action", "reason", "rule_name", "severity").alias("event_context"),
        _ml(with_alert=True),
        F.col("original_event"),
    )


def ids_alert_records(scored: DataFrame, mode: str = "suricata_or_ml", keep: Sequence[str] = ()) -> DataFrame:
    """Scored records of the one-by-one job."""
    mode = mode.strip().lower()
    decision = decide_alert(F.col("prediction"), mode)
    return scored.select(
        *keep,
        *_head(),
        F.struct("signature", "severity", "category", "action", "message").alias("suricata"),
        _ml(with_alert=False),
        F.struct(
            decision["triggered"].alias("triggered"), decision["reason"].alias("reason"), F.lit(mode).alias("mode")
        ).alias("alert"),
        F.col("original_event"),
    )


def only_alerts(records: DataFrame, enabled: bool = True) -> DataFrame:
    """The filter of the alert-table sink."""
    return records.filter(F.col("ml.alert")) if enabled else records


def notifiable(records: DataFrame, minimum: float = fixed.FLOW_NOTICE_MINIMUM, alerts_only: bool = True) -> DataFrame:
    return only_alerts(records, alerts_only).filter(F.col("ml.malicious_probability") >= minimum)


def ids_notifiable(records: DataFrame, minimum: float = fixed.IDS_NOTICE_MINIMUM) -> DataFrame:
    too_weak = (F.col("ml.malicious_probability") < minimum) & (F.col("alert.mode") == "ml_only")
    return records.filter(F.col("alert.triggered") & ~too_weak)


def _coded(label: str, text: Column) -> Column:
    return F.concat(F.lit(f"{label}: <code>"), html_escape(text), F.lit("</code>"))


def _optional(label: str, text: Column, shorten: bool = True) -> Column:
    shown = truncate(text, fixed.NOTICE_TEXT_LENGTH) if shorten else text
    return F.when(shown != "", _coded(label, shown))


def _address(side: str) -> Column:
    event = F.col("network_event")
    return html_escape(F.concat(event[f"{side}_ip"], F.lit(":"), event[f"{side}_port"].cast("string")))


def _title(text: str) -> Column:
    return F.concat(F.lit("<b>"), html_escape(F.lit(text)), F.lit("</b>"))


def _core_lines() -> list[Column]:
    ml = F.col("ml")
    return [
        F.concat(F.lit("Risk: <b>"), F.upper(html_escape(ml["risk_level"])), F.lit("</b>")),
        F.concat(F.lit("Score: <code>"), F.format_string("%.4f", ml["malicious_probability"]), F.lit("</code>")),
        F.concat(F.lit("Path: <code>"), _address("src"), F.lit("</code> -> <code>"), _address("dst"), F.lit("</code>")),
        _coded("Protocol", F.col("network_event.protocol")),
    ]


def _reference() -> Column:
    ref = F.col("source_ref")
    return F.concat(
        F.lit("Ref: <code>"), html_escape(ref["index"]), F.lit("</code> / <code>"), html_escape(ref["id"]), F.lit("</code>")
    )


def notice_text(title: str = fixed.FLOW_NOTICE_TITLE) -> Column:
    """Notification of the two-source job. ``concat_ws`` skips the optional lines that are null."""
    event, context = F.col("network_event"), F.col("event_context")
    return F.concat_ws(
        "\n",
        _title(title),
        _coded("Time", F.col("`@timestamp`")),
        _coded("Source", F.col("source_type")),
        *_core_lines(),
        _optional("Method", event["http_method"], shorten=False),
        _optional("URI", event["uri"]),
        _optional("Rule", context["rule_name"]),
        _optional("Reason", context["reason"]),
        _reference(),
    )


def ids_notice_text(title: str = fixed.IDS_NOTICE_TITLE) -> Column:
    suricata = F.col("suricata")
    return F.concat_ws(
        "\n",
        _title(title),
        _coded("Time", F.col("`@timestamp`")),
        _coded("Reason", F.col("alert.reason")),
        *_core_lines(),
        _optional("Signature", suricata["signature"]),
        _optional("Category", suricata["category"]),
        _optional("URI", F.col("network_event.uri")),
        _reference(),
    )


def outbox(records: DataFrame, text: Column) -> DataFrame:
    """Rows of the notification outbox; delivery is left to another system."""
    return records.select(
        F.col("source_ref.index").alias("source_index"), F.col("source_ref.id").alias("source_id"), text.alias("message")
    )
