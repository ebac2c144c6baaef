"""The 47 model features, as built-in expressions over one record view and its lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions import patterns
from ..functions.patterns import count_text
from ..functions.reuse import built_once
from .lookups import with_lookups
from .records import TEXT_OF, VIEWS, code_cut, with_text
from .sizing import scratch_path
from .state import MIN_COUNT, FeatureState, fit_to


def _single(value: float) -> Column:
    return F.lit(value).cast("float")


def ratio(above: Column, below: Column) -> Column:
    """Division in double precision with a floor under the denominator."""
    return above.cast("double") / F.greatest(below.cast("double"), F.lit(1e-9))


def record_features(record: dict[str, Column]) -> dict[str, Column]:
    """Features that need no fitted state."""
    size, packets, duration = record["bytes"], record["packets"], record["duration"]
    source_port, target_port = record["src_port"], record["dst_port"]
    is_http = record["protocol"] == "HTTP"
    to_web_port = target_port.isin(fixed.WEB_PORTS)
    has_text = F.length(record["text"]) > 0
    return {
        "src_port": source_port,
        "dst_port": target_port,
        "bytes": size,
        "packets": packets,
        "duration": duration,
        "packets_per_flow": packets,
        "bytes_per_flow": size,
        "packet_byte_ratio": ratio(packets, size + _single(1.0)),
        "bytes_per_second": ratio(size, duration + _single(1e-6)),
        "packets_per_second": ratio(packets, duration + _single(1e-6)),
        "duration_per_packet": ratio(duration, packets + _single(1.0)),
        "http_like_request": is_http | (record["http_method"] != "") | has_text | to_web_port,
        "protocol_is_http": is_http,
        "src_ip_is_private": record["src_ip"].rlike(fixed.PRIVATE_IP_PATTERN),
        "dst_ip_is_private": record["dst_ip"].rlike(fixed.PRIVATE_IP_PATTERN),
        "src_port_is_system": source_port < 1024,
        "dst_port_is_system": target_port < 1024,
        "dst_port_is_web": to_web_port,
        "payload_present": has_text,
    }


def text_features(text: Column) -> dict[str, Column]:
    """Features of the decoded URI."""
    has_equals = F.contains(text, F.lit("="))
    quotes = count_text(text, "'") + count_text(text, '"') + count_text(text, "`")
    brackets = count_text(text, "<") + count_text(text, ">")
    return {
        "uri_length": F.length(text),
        "uri_path_depth": count_text(text, "/"),
        "uri_query_param_count": F.when(has_equals, count_text(text, "&") + 1).otherwise(0),
        "uri_equals_count": count_text(text, "="),
        "uri_quote_count": quotes,
        "uri_angle_bracket_count": brackets,
        "uri_has_query_string": F.contains(text, F.lit("?")),
        "uri_has_percent_encoding": F.contains(text, F.lit("%")) & text.rlike(fixed.PERCENT_ENCODING_PATTERN),
        "uri_sql_keyword_hits": patterns.sql_keywords(text),
        "uri_sql_tautology_hits": patterns.sql_tautologies(text),
        "uri_sql_comment_hits": patterns.sql_comments(text),
        "uri_sql_encoded_meta_hits": patterns.sql_encoded_meta(text),
        "uri_xss_keyword_hits": patterns.xss_keywords(text),
        "uri_xss_event_handler_hits": patterns.xss_event_handlers(text),
        "uri_xss_script_tag_hits": patterns.xss_script_tags(text),
        "uri_special_char_ratio": ratio(patterns.special_characters(text), F.length(text) + 1),
    }


def score_features(hit: dict[str, Column]) -> dict[str, Column]:
    """Weighted sums of the pattern counts."""
    sql = (
        2.0 * hit["uri_sql_keyword_hits"]
        + 3.0 * hit["uri_sql_tautology_hits"]
        + 1.0 * hit["uri_sql_comment_hits"]
        + 0.5 * hit["uri_sql_encoded_meta_hits"]
        + 0.25 * hit["uri_quote_count"]
    )
    xss = (
        2.0 * (hit["uri_xss_keyword_hits"] + hit["uri_xss_event_handler_hits"] + hit["uri_xss_script_tag_hits"])
        + 0.25 * hit["uri_angle_bracket_count"]
    )
    return {"sql_attack_score": sql, "xss_attack_score": xss}


def state_features(prefix: str = "_") -> dict[str, Column]:
    """Features read from the lookup columns; unknown values and single occurrences are 0."""

    def known(name: str) -> Column:
        return F.coalesce(F.col(f"{prefix}{name}").cast("double"), F.lit(0.0))

    def log_count(name: str) -> Column:
        count = known(name)
        return F.log1p(F.when(count >= MIN_COUNT, count).otherwise(F.lit(0.0)))

    return {
        "protocol_encoded": known("protocol_code"),
        "protocol_frequency": known("protocol_frequency"),
        "http_method_encoded": known("http_method_code"),
        "http_method_frequency": known("http_method_frequency"),
        "unique_dst_ports_per_source": F.log1p(known("ports")),
        "repeated_access_count": log_count("request"),
        "src_ip_frequency": log_count("src"),
        "dst_ip_frequency": log_count("dst"),
        "src_dst_pair_frequency": log_count("src_dst"),
        "endpoint_frequency": log_count("endpoint"),
    }


@built_once
def _feature_columns(view: str, lookup_prefix: str, prefix: str) -> tuple[dict[str, Column], list[Column]]:
    """Staged pattern counts and, over them, the features in model order."""
    record = VIEWS[view]()
    counted = text_features(record["text"])
    staged = {f"_f_{name}": column.cast("float") for name, column in counted.items()}
    counts = {name: F.col(f"_f_{name}") for name in counted}
    features = record_features(record) | counts | score_features(counts) | state_features(lookup_prefix)
    return staged, [features[name].cast("float").alias(prefix + name) for name in fixed.FEATURE_NAMES]


def with_features(
    frame: DataFrame, view: str, keep: Sequence[str], lookup_prefix: str = "_", prefix: str = ""
) -> DataFrame:
    """Select ``keep`` and the 47 features of a view, named ``<prefix><feature>``, in model order.

    Counts are projected first, so each pattern runs once although the scores read it again.
    """
    staged, chosen = _feature_columns(view, lookup_prefix, prefix)
    return code_cut(frame.withColumns(staged), TEXT_OF[view]).select(*[F.col(name) for name in keep], *chosen)


def transform(frame: DataFrame, state: FeatureState, keep: Sequence[str] = ()) -> DataFrame:
    """Feature table of unified records; ``keep`` carries key and label columns through.

    Only the record and ``keep`` travel through the lookups; the features are computed after them.
    """
    wanted = list(dict.fromkeys([*keep, *fixed.NETWORK_FIELDS]))
    kept = {f"_keep_{name}": F.col(name) for name in keep}
    frame = with_text(frame.select(*wanted)).withColumns(kept) if kept else with_text(frame.select(*wanted))
    frame = with_lookups(frame, state)
    table = with_features(frame, "primary", list(kept))
    # A kept column that is also a feature keeps only the feature.
    clash = [name for name in keep if name in fixed.FEATURE_NAMES]
    table = table.drop(*[f"_keep_{name}" for name in clash])
    return table.withColumnsRenamed({f"_keep_{name}": name for name in keep if name not in clash})


def fit_transform(frame: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Fit on a table and transform the same table: a row counts its own occurrence. The state is written to the shared folder."""
    return transform(frame, fit_to(frame, scratch_path(frame.sparkSession, "state")), keep)


def select_features(frame: DataFrame, names: Sequence[str] = tuple(fixed.FEATURE_NAMES), keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the pinned features in the pinned order."""
    missing = [name for name in names if name not in frame.columns]
    if missing:
        raise ValueError(f"missing features: {', '.join(missing)}")
    return frame.select(*keep, *names)
