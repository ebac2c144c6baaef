"""Registered queries: one per operator, with the DuckDB statement that must give the same rows.

Names start with the operator's id in the survey. Queries without a statement are fitted models,
streams and file sinks, which SQL cannot express.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions import documents, labels, text
from ..functions.keys import traffic_keys
from ..functions.patterns import is_suspicious
from ..operators import alerts, evaluate, events, features, models, profile, scoring, sinks, split, state, unify, weights
from ..operators.lookups import lookup_category, lookup_key
from ..operators.records import primary_view, with_text
from ..operators.sizing import scratch_path
from ..sources import columns as source_columns
from ..sources import events as event_sources
from ..sources import files
from ..streaming import jobs
from . import oracles as sql
from . import prediction, ranking, telemetry, training

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    query: Query
    oracle: str | None


ENTRIES: dict[str, Entry] = {}


def add(name: str, query: Query, oracle: str | None = None) -> None:
    ENTRIES[name] = Entry(query, oracle)


def register(name: str, oracle: str | None = None):
    def keep(query: Query) -> Query:
        add(name, query, oracle)
        return query

    return keep


# --- helpers ----------------------------------------------------------------------------------

unified = telemetry.unified_view


def plain_record(frame: DataFrame, key: str = "event_id") -> DataFrame:
    """Unified records with types both engines share."""
    doubles = {"bytes", "packets", "duration"}
    chosen = []
    for name in fixed.UNIFIED_COLUMNS:
        kind = "double" if name in doubles else "int" if name in ("label", "src_port", "dst_port") else None
        chosen.append(F.col(name).cast(kind).alias(name) if kind else F.col(name))
    return frame.select(F.col(key).alias("event_id"), *chosen)


def as_double(frame: DataFrame, names: list[str]) -> DataFrame:
    return frame.select(*[F.col(c).cast("double").alias(c) if c in names else F.col(c) for c in frame.columns])


def view_with_text(spark: SparkSession, folder: str) -> DataFrame:
    return with_text(unified(spark, folder))


# --- A. sources -------------------------------------------------------------------------------


def _written(spark: SparkSession, frame: DataFrame, name: str, write) -> str:
    path = scratch_path(spark, name)
    write(frame, path)
    return path


@register(
    "a1_flow_parquet_source",
    f"SELECT * FROM ({sql.flow_table_sql('label <> ' + sql.q('BENIGN'))}) t UNION ALL SELECT * FROM t2".replace(
        "UNION ALL SELECT * FROM t2", f"UNION ALL SELECT * FROM ({sql.flow_table_sql('label <> ' + sql.q('BENIGN'))}) u"
    ),
)
def _a1(spark, folder):
    raw = telemetry.flow_table_view(telemetry.flow_view(spark, folder))
    path = _written(spark, raw, "flows", lambda f, p: f.write.parquet(p))
    parts = [unify.unify_flow_table(spark.read.parquet(path), keep=["event_id"]) for _ in range(2)]
    return plain_record(unify.union_sources(*parts))


def _read_back(spark, folder, view, name):
    """The view from CSV files with two headers, one with the columns in reverse order and under other spellings."""
    raw = view(telemetry.flow_view(spark, folder))

    def write(frame, path):
        even = F.col("event_id") % 2 == 0
        odd = frame.filter(~even)
        odd = odd.select(*[F.col(f"`{c}`").alias(c if c == "event_id" else c.upper()) for c in reversed(odd.columns)])
        for part in (frame.filter(even), odd):
            part.write.mode("append").option("header", True).option("escape", '"').csv(path)

    parts = files.read_csv_directory(spark, _written(spark, raw, name, write))
    return [part.withColumn("event_id", F.col("event_id").cast("long")) for part in parts]


@register("a2_flow_csv_source", sql.flow_csv_sql(sql.words_sql("label")))
def _a2(spark, folder):
    parts = _read_back(spark, folder, telemetry.flow_csv_view, "flowcsv")
    return plain_record(unify.union_sources(*[unify.unify_flow_csv(part, keep=["event_id"]) for part in parts]))


@register("a3_firewall_csv_source", sql.firewall_sql())
def _a3(spark, folder):
    parts = _read_back(spark, folder, telemetry.firewall_view, "firewallcsv")
    return plain_record(unify.union_sources(*[unify.unify_firewall_log(part, keep=["event_id"]) for part in parts]))


def _payload_folder(spark, folder) -> str:
    """Payloads of the events, as JSON lines below one folder per label."""
    root = scratch_path(spark, "payloads")
    raw = telemetry.payload_view(telemetry.flow_view(spark, folder))
    for name, label in (("legitimate", 0), ("malicious", 1)):
        part = raw.filter(F.col("label") == label)
        quoted = F.regexp_replace(F.to_json(F.array("payload")), r"^\[|\]$", "")
        part.select(quoted.alias("value")).write.option("compression", "none").text(f"{root}/{name}")
    return root


PAYLOAD_LINES_SQL = (
    f"{sql.FLOW_CTE} SELECT uri AS payload, CAST(label <> 'BENIGN' AS INT) AS label, count(*) AS n FROM flows GROUP BY ALL"
)


@register("a6_inference_json_source", sql.generic_sql())
def _a6(spark, folder):
    """JSON records read as text columns, detected and normalised."""
    raw = telemetry.generic_view(telemetry.flow_view(spark, folder))
    path = _written(spark, raw, "records", lambda f, p: f.write.json(p))
    frame = files.inference_json_lines(spark, path, raw.columns).withColumn("event_id", F.col("event_id").cast("long"))
    return plain_record(unify.unify_for_inference(frame, keep=["event_id"]))


IDS_FILTER = f"{sql.at('event.module')} = 'suricata' AND {sql.at('event.kind')} = 'alert'"
IDS_CTE = f"{sql.DOCS_CTE}, ids AS (SELECT * FROM docs WHERE {IDS_FILTER})"


@register("a7_event_source", f"{IDS_CTE} SELECT event_id, _index, _id FROM ids")
def _a7(spark, folder):
    return event_sources.ids_alerts(telemetry.document_view(spark, folder)).select("event_id", "_index", "_id")


def timed_documents(spark, folder) -> DataFrame:
    return event_sources.with_timestamp(telemetry.document_view(spark, folder))


NEWEST = "(SELECT (stamp, _index, _id) AS k, stamp, _index, _id FROM docs ORDER BY stamp DESC, _index DESC, _id DESC LIMIT 1)"


@register(
    "a8_start_from_latest",
    f"{sql.DOCS_CTE}, top AS (SELECT stamp, _index, _id FROM docs WHERE event_id < 20 ORDER BY stamp DESC, _index DESC, _id DESC LIMIT 1) "
    "SELECT event_id, docs.stamp AS event_timestamp FROM docs, top WHERE docs.stamp > top.stamp "
    "OR (docs.stamp = top.stamp AND NOT (docs._index = top._index AND docs._id = top._id))",
)
def _a8(spark, folder):
    """What comes after the newest event of a table that holds the first events already, others of the same time included."""
    events_ = telemetry.document_view(spark, folder)
    later = jobs.from_latest(events_, events_.filter("event_id < 20"))
    return later.select("event_id", F.col("timestamp").alias("event_timestamp"))


# --- B. sinks ---------------------------------------------------------------------------------


@register(
    "b1_test_split_sink",
    f"""{sql.UNIFIED_CTE}, counts AS (SELECT label, count(*) AS n FROM unified GROUP BY 1),
parts AS (SELECT *, ceil(sum(n) OVER () * 0.15::DOUBLE) * n / sum(n) OVER () AS exact FROM counts),
quotas AS (SELECT label, floor(exact) + CAST(row_number() OVER (ORDER BY exact - floor(exact) DESC, label)
  <= ceil(sum(n) OVER () * 0.15::DOUBLE) - sum(floor(exact)) OVER () AS INT) AS quota FROM parts),
ranked AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(event_id || ':42')) AS r FROM unified)
SELECT {sql.UNIFIED_OUT} FROM ranked JOIN quotas USING (label) WHERE r <= quota""",
)
def _b1(spark, folder):
    """The test part, written and read back."""
    parts = split.stratified_split(unified(spark, folder), ["event_id"])
    artifacts = scratch_path(spark, "artifacts")
    sinks.write_test_split(parts.filter(F.col("split") == split.TEST).drop("split"), artifacts)
    return plain_record(sinks.read_test_split(spark, artifacts))


@register(
    "b2_state_sink",
    f"""{sql.STATE_CTE} SELECT 'dst' AS kind, key, n AS "count" FROM dst_state UNION ALL SELECT 'src_dst', key, n FROM src_dst_state
UNION ALL SELECT 'endpoint', key, n FROM endpoint_state UNION ALL SELECT 'request', key, n FROM request_state
UNION ALL SELECT 'src', key, n FROM ports_state""",
)
def _b2(spark, folder):
    """State fitted, stored, loaded."""
    fitted = state.fit_to(unified(spark, folder), scratch_path(spark, "state"))
    parts = [table.select(F.lit(kind).alias("kind"), "key", "count") for kind, table in fitted.counts.items()]
    return unify.union_sources(*parts, fitted.sources.select(F.lit("src").alias("kind"), "key", "count"))


# --- C. normalisation -------------------------------------------------------------------------


@register(
    "c1_c2_alias_resolution",
    f"{sql.FLOW_CTE} SELECT event_id, src_ip AS first_alias, dst_port AS second_alias, '' AS missing_text, 0 AS missing_number FROM flows",
)
def _c2(spark, folder):
    frame = telemetry.generic_view(telemetry.flow_view(spark, folder))
    found = source_columns.ColumnFinder(frame, ["event_id"])
    return frame.select(
        "event_id",
        found.raw("src ip", "SOURCE-IP").alias("first_alias"),
        found.port("destination_port", "DsPort").alias("second_alias"),
        found.string("nothing").alias("missing_text"),
        found.raw("nothing", default=0).alias("missing_number"),
    )


SPACED = "chr(9) || ' ' || text || chr(160) || ' ' || chr(8195) || chr(10)"


@register(
    "c3_string_coercion",
    "SELECT doc_id, md5(trim(text, ' ' || chr(9) || chr(10) || chr(13) || chr(160) || chr(8195))) AS digest, "
    "length(trim(text, ' ' || chr(9) || chr(10) || chr(13) || chr(160) || chr(8195))) AS n FROM documents",
)
def _c3(spark, folder):
    padded = F.concat(F.lit("\t "), F.col("text"), F.lit("\xa0  \n"))
    frame = telemetry.table(spark, folder, "documents").select("doc_id", padded.alias("padded"))
    clean = text.as_text(F.col("padded"))
    return frame.select("doc_id", F.md5(clean).alias("digest"), F.length(clean).cast("long").alias("n"))


NUMBER_FORMS = ["1d", " 2 ", "1e3", "+5", ".5", "inf", "nan", "", "0x10", "1,000", "True", "1f", "-3.25"]


def number_forms() -> Column:
    event = F.col("event_id")
    return telemetry._choose(event % 17, dict(enumerate(NUMBER_FORMS)), (event % 9973).cast("string"))


NUMBER_FORMS_SQL = sql.choose("event_id % 17", sql.texts(dict(enumerate(NUMBER_FORMS))), "CAST(event_id % 9973 AS VARCHAR)")
NUMBER_CTE = f"WITH raw AS (SELECT event_id, {NUMBER_FORMS_SQL} AS form FROM events)"


@register("c4_numeric_coercion", f"{NUMBER_CTE} SELECT event_id, {sql.number_sql('form')} AS number FROM raw")
def _c4(spark, folder):
    events_table = telemetry.table(spark, folder, "events")
    return events_table.select("event_id", text.as_number(number_forms()).alias("number"))


@register("c5_protocol_cleaning", f"{sql.FLOW_CTE} SELECT event_id, {sql.protocol_sql('protocol')} AS protocol FROM flows")
def _c5(spark, folder):
    return telemetry.flow_view(spark, folder).select("event_id", text.clean_protocol(F.col("protocol")).alias("protocol"))


PORT_VALUE = "value * 500 - 100"


@register(
    "c6_port_coercion",
    f"SELECT event_id, {sql.port_sql(PORT_VALUE)} AS port, {sql.port_sql('event_id / 2.0::DOUBLE')} AS half FROM events",
)
def _c6(spark, folder):
    return telemetry.table(spark, folder, "events").select(
        "event_id",
        text.as_port(F.col("value") * 500 - 100, numeric=True).alias("port"),
        text.as_port(F.col("event_id") / 2.0, numeric=True).alias("half"),
    )


LABEL_FORMS = [*fixed.BENIGN_WORDS, *fixed.MALICIOUS_WORDS, "Web Attack - XSS", "unknown", "1", "0", " 3 ", "-1", "Successful DENY"]
LABEL_FORM_SQL = sql.choose(
    f"event_id % {len(LABEL_FORMS)}", sql.texts(dict(enumerate(LABEL_FORMS[:-1]))), sql.q(LABEL_FORMS[-1])
)


@register(
    "c7_label_words",
    f"WITH raw AS (SELECT event_id, {LABEL_FORM_SQL} AS form FROM events) SELECT event_id, form, {sql.words_sql('form')} AS label FROM raw",
)
def _c7(spark, folder):
    form = telemetry._choose(F.col("event_id") % len(LABEL_FORMS), dict(enumerate(LABEL_FORMS[:-1])), LABEL_FORMS[-1])
    raw = telemetry.table(spark, folder, "events").select("event_id", form.alias("form"))
    return raw.select("event_id", "form", labels.label_from_words(F.col("form")).cast("int").alias("label"))


add(
    "c8_unified_record_keywords",
    lambda spark, folder: plain_record(unified(spark, folder)),
    f"{sql.UNIFIED_CTE} SELECT {sql.UNIFIED_OUT} FROM unified",
)
add(
    "c8_unified_record_numeric",
    lambda spark, folder: plain_record(unified(spark, folder, "numeric")),
    f"{sql.UNIFIED_CTE} SELECT {sql.UNIFIED_OUT.replace('CAST(label AS INT)', '0')} FROM unified",
)


def _normalised(view, normalise, **options) -> Query:
    return lambda spark, folder: plain_record(
        normalise(view(telemetry.flow_view(spark, folder)), keep=["event_id"], **options)
    )


add("c9_flow_table", _normalised(telemetry.flow_table_view, unify.unify_flow_table), sql.flow_table_sql("label <> 'BENIGN'"))
add("c10_flow_csv", _normalised(telemetry.flow_csv_view, unify.unify_flow_csv), sql.flow_csv_sql(sql.words_sql("label")))
add(
    "c10_flow_csv_numeric_labels",
    _normalised(telemetry.flow_csv_view, unify.unify_flow_csv, label_mode="numeric"),
    sql.flow_csv_sql("0"),
)
add("c11_firewall_log", _normalised(telemetry.firewall_view, unify.unify_firewall_log), sql.firewall_sql())
add(
    "c12_payloads",
    _normalised(telemetry.payload_view, unify.unify_payloads),
    sql.payload_sql("uri", "CAST(label <> 'BENIGN' AS INT)", sql.FLOW_CTE, "flows"),
)
add("c13_generic", _normalised(telemetry.generic_view, unify.unify_generic), sql.generic_sql())


@register("c12_page_urls", sql.payload_sql("url", "0", "WITH p AS (SELECT page_id, url FROM pages)", "p", key="page_id"))
def _c12(spark, folder):
    pages = telemetry.table(spark, folder, "pages").select("page_id", "url")
    return plain_record(unify.unify_payloads(pages, payload="url", label=None, keep=["page_id"]), "page_id")


LAYOUTS = {
    "unsw": (telemetry.flow_table_view, sql.flow_table_sql("label <> 'BENIGN'", fixed.INFERENCE_SOURCES["unsw"])),
    "cic": (telemetry.flow_csv_view, sql.flow_csv_sql(sql.words_sql("label"), fixed.INFERENCE_SOURCES["cic"])),
    "firewall": (telemetry.firewall_view, sql.firewall_sql(fixed.INFERENCE_SOURCES["firewall"])),
    "modsec": (
        lambda raw: telemetry.payload_view(raw).drop("label"),
        sql.payload_sql("uri", "0", sql.FLOW_CTE, "flows", fixed.INFERENCE_SOURCES["modsec"]),
    ),
    "generic": (telemetry.generic_view, sql.generic_sql()),
}
for _layout, (_view, _oracle) in LAYOUTS.items():
    add(f"c14_c15_dispatch_{_layout}", _normalised(_view, unify.unify_for_inference), _oracle)


# --- D. features ------------------------------------------------------------------------------

_STATELESS = [name for name in fixed.FEATURE_NAMES if name not in sql.STATE_SQL]


def _feature(name: str, slots: dict[int, str]) -> Query:
    def query(spark, folder):
        frame = unified(spark, folder, slots=slots)
        if name in _STATELESS:
            rows, record = with_text(frame), primary_view()
            counted = features.text_features(record["text"])
            every = features.record_features(record) | counted | features.score_features(counted)
            value = every[name].cast("float").cast("double")
            return rows.select("event_id", value.alias(name))
        table = features.fit_transform(frame, ["event_id"])
        return table.select("event_id", F.col(name).cast("double").alias(name))

    return query


for _number, _name in enumerate(fixed.FEATURE_NAMES, start=1):
    if _name in _STATELESS:
        _slots = telemetry.SCRIPT_TAG_SLOTS if _name == "uri_xss_script_tag_hits" else telemetry.URI_SLOTS
        add(f"d{_number:02d}_{_name}", _feature(_name, _slots), sql.feature_query(_name, _slots))


def _state_columns(names: list[str]) -> Query:
    def query(spark, folder):
        table = features.fit_transform(unified(spark, folder), ["event_id"])
        return table.select("event_id", *[F.col(name).cast("double").alias(name) for name in names])

    return query


def _add_state_features(name: str, columns: list[str]) -> None:
    chosen = ", ".join(sql.feature_column(column) for column in columns)
    add(name, _state_columns(columns), f"{sql.STATE_CTE} SELECT event_id, {chosen} FROM keyed")


_add_state_features("d12_d13_protocol_lookup", ["protocol_encoded", "protocol_frequency"])
_add_state_features("d14_d15_http_method_lookup", ["http_method_encoded", "http_method_frequency"])
for _number, _name in enumerate(fixed.FEATURE_NAMES, start=1):
    if _name in sql.STATE_SQL and 36 <= _number <= 41:
        _add_state_features(f"d{_number:02d}_{_name}", [_name])


@register("d00_url_decode", f"{sql.KEYED_CTE} SELECT event_id, text AS decoded FROM keyed")
def _d00(spark, folder):
    return view_with_text(spark, folder).select("event_id", F.col("_text").alias("decoded"))


def _text_columns(source: str, names: list[str]) -> str:
    counted = sql.text_sql(source)
    counted |= sql.score_sql(counted)
    return ", ".join(f"CAST(CAST({counted[n]} AS FLOAT) AS DOUBLE) AS {n}" for n in names)


_TEXT_NAMES = [*sql.text_sql("url"), "sql_attack_score", "xss_attack_score"]


@register("d16_d33_page_urls", f"SELECT page_id, {_text_columns(sql.decode('url'), _TEXT_NAMES)} FROM pages")
def _page_urls(spark, folder):
    pages = telemetry.table(spark, folder, "pages").select("page_id", text.request_text(F.col("url")).alias("t"))
    counted = features.text_features(F.col("t"))
    every = counted | features.score_features(counted)
    return pages.select("page_id", *[every[n].cast("float").cast("double").alias(n) for n in _TEXT_NAMES])


# Patterns without word boundaries, whose meaning on letters beyond ASCII is the same in both engines.
_MARKUP_NAMES = [
    "uri_length", "uri_path_depth", "uri_equals_count", "uri_quote_count", "uri_angle_bracket_count",
    "uri_has_query_string", "uri_sql_comment_hits", "uri_sql_encoded_meta_hits", "uri_xss_keyword_hits",
    "uri_xss_script_tag_hits", "uri_special_char_ratio",
]


@register("d16_d31_page_html", f"SELECT page_id, {_text_columns('html', _MARKUP_NAMES)} FROM pages")
def _page_html(spark, folder):
    pages = telemetry.table(spark, folder, "pages").select("page_id", "html")
    counted = features.text_features(F.col("html"))
    return pages.select("page_id", *[counted[n].cast("float").cast("double").alias(n) for n in _MARKUP_NAMES])


for _id, _kinds in (("d48", ["src"]), ("d49", ["dst"]), ("d50", ["endpoint"]), ("d51", ["request", "src_dst"])):

    def _keys(spark, folder, kinds=tuple(_kinds)):
        keys = traffic_keys(primary_view())
        return view_with_text(spark, folder).select("event_id", *[keys[k].alias(k) for k in kinds])

    add(f"{_id}_{'_and_'.join(_kinds)}_key", _keys, f"{sql.KEYED_CTE} SELECT event_id, {', '.join(_kinds)} FROM keyed")

add(
    "c16_d_all_features",
    lambda spark, folder: as_double(
        features.select_features(features.fit_transform(unified(spark, folder), ["event_id"]), keep=["event_id"]),
        fixed.FEATURE_NAMES,
    ),
    sql.all_features_query(),
)


# --- E. state ---------------------------------------------------------------------------------


def _categories(spark, folder, column: str) -> DataFrame:
    keys = state.keyed(unified(spark, folder))
    return state.category_table(state.value_counts(keys, column))


for _column in ("protocol", "http_method"):
    add(
        f"e1_{_column}_codes",
        lambda spark, folder, c=_column: _categories(spark, folder, c).filter("code IS NOT NULL").select("value", "code"),
        f"{sql.STATE_CTE} SELECT value, CAST(code AS INT) AS code FROM {_column}_state WHERE code IS NOT NULL",
    )
    add(
        f"e2_{_column}_frequency",
        lambda spark, folder, c=_column: _categories(spark, folder, c).select("value", "frequency"),
        f"{sql.STATE_CTE} SELECT value, frequency FROM {_column}_state",
    )

add(
    "e3_ports_per_source",
    lambda spark, folder: state.source_table(unified(spark, folder)).select("key", "ports"),
    f"{sql.STATE_CTE} SELECT key, ports FROM ports_state",
)
for _kind in ("dst", "src_dst", "endpoint", "request"):
    add(
        f"e4_{_kind}_counts",
        lambda spark, folder, k=_kind: state.count_table(state.keyed(unified(spark, folder)), k),
        f'{sql.STATE_CTE} SELECT key, n AS "count" FROM {_kind}_state',
    )
add(
    "e4_src_counts",
    lambda spark, folder: state.source_table(unified(spark, folder))
    .filter(F.col("count") >= state.MIN_COUNT)
    .select("key", "count"),
    f'{sql.STATE_CTE} SELECT key, n AS "count" FROM src_state',
)


@register(
    "e5_fit_transform_same_rows",
    f"{sql.STATE_CTE} SELECT event_id, {sql.feature_column('src_ip_frequency')}, {sql.feature_column('endpoint_frequency')}, "
    f"{sql.feature_column('repeated_access_count')} FROM keyed",
)
def _e5(spark, folder):
    """Through stored state: fit, save, load, look up with recorded sizes."""
    frame = unified(spark, folder)
    fitted = state.fit_to(frame, scratch_path(spark, "state"))
    names = ["src_ip_frequency", "endpoint_frequency", "repeated_access_count"]
    table = features.transform(frame, fitted, ["event_id"])
    return table.select("event_id", *[F.col(n).cast("double").alias(n) for n in names])


def _summary_sql() -> str:
    parts = []
    for name in ("protocol", "http_method"):
        parts.append(f"SELECT '{name}_encoder' AS section, value AS name, code::DOUBLE AS value FROM {name}_state WHERE code IS NOT NULL")
        parts.append(f"SELECT '{name}_frequency', value, frequency FROM {name}_state")
    parts += [
        f"SELECT 'count_map_sizes', '{kind}', count(*)::DOUBLE FROM {kind}_state"
        for kind in ("src", "dst", "src_dst", "endpoint", "request")
    ]
    rows = ", ".join(f"('feature_list', '{name}', {n}::DOUBLE)" for n, name in enumerate(fixed.FEATURE_NAMES, start=1))
    return f"{sql.STATE_CTE} {' UNION ALL '.join(parts)} UNION ALL SELECT * FROM (VALUES {rows}) v"


add("e6_state_summary", lambda spark, folder: state.state_summary(state.fit(unified(spark, folder))), _summary_sql())


# --- F. lookups -------------------------------------------------------------------------------


@register(
    "f1_category_lookup",
    f"{sql.STATE_CTE} SELECT event_id, CAST(coalesce(code, 0) AS INT) AS code, frequency FROM keyed JOIN protocol_state ON value = protocol",
)
def _f1(spark, folder):
    rows = unified(spark, folder)
    table = _categories(spark, folder, "protocol")
    found = lookup_category(rows, F.col("protocol"), table, {"code": "code", "frequency": "frequency"}, None)
    return found.select("event_id", F.coalesce("code", F.lit(0)).alias("code"), "frequency")


@register(
    "f2_key_lookup_hot_keys",
    f"{sql.STATE_CTE} SELECT event_id, coalesce(n, 0) AS seen FROM keyed LEFT JOIN src_dst_state ON key = src_dst",
)
def _f2(spark, folder):
    """The shuffled form with its hot keys split off, forced by declaring the table as too large."""
    rows = view_with_text(spark, folder)
    key = traffic_keys(primary_view())["src_dst"]
    table = state.count_table(state.keyed(unified(spark, folder)), "src_dst")
    found = lookup_key(rows, key, table, {"seen": "count"}, size=(1 << 40, 1 << 50), total=100_000)
    return found.select("event_id", F.coalesce("seen", F.lit(0)).alias("seen"))


_WEIGHTS_CTE = f"""{sql.UNIFIED_CTE}, sized AS (SELECT event_id, label, source_name,
  count(*) OVER () / ((SELECT count(DISTINCT label) FROM unified) * count(*) OVER (PARTITION BY label)::DOUBLE) AS class_weight,
  count(*) OVER () / ((SELECT count(DISTINCT source_name) FROM unified) * count(*) OVER (PARTITION BY source_name)::DOUBLE) AS source_weight
  FROM unified), weighed AS (SELECT *, class_weight * source_weight / avg(class_weight * source_weight) OVER () AS weight FROM sized)"""


@register(
    "f3_class_and_source_weight_lookup",
    f"{_WEIGHTS_CTE} SELECT event_id, round(class_weight, 6) AS class_weight, round(source_weight, 6) AS source_weight FROM weighed",
)
def _f3(spark, folder):
    rows = unified(spark, folder)
    cells = weights.weight_cells(rows)
    for name in ("class_weight", "source_weight"):
        rows = weights.with_sample_weights(rows, cells.withColumn("weight", F.col(name)), name)
    return rows.select("event_id", *[F.round(n, 6).alias(n) for n in ("class_weight", "source_weight")])


@register(
    "f4_scores_beside_records",
    f"{sql.SCORED_CTE} SELECT event_id, src_ip, uri, round(malicious_probability, 6) AS malicious_probability "
    "FROM predicted JOIN unified USING (event_id)",
)
def _f4(spark, folder):
    scored = predicted(spark, folder, ["event_id", "src_ip", "uri"])
    return scored.select("event_id", "src_ip", "uri", F.round("malicious_probability", 6).alias("malicious_probability"))


# --- G. training and evaluation aggregates ----------------------------------------------------


@register("g1_sample_weights", f"{_WEIGHTS_CTE} SELECT event_id, round(weight, 5) AS weight FROM weighed")
def _g1(spark, folder):
    rows = weights.with_sample_weights(unified(spark, folder))
    return rows.select("event_id", F.round(F.col("weight").cast("double"), 5).alias("weight"))


add(
    "g2_positive_scale",
    lambda spark, folder: weights.positive_scale(unified(spark, folder)),
    f"{sql.UNIFIED_CTE} SELECT count(*) FILTER (label = 0) AS negative, count(*) FILTER (label = 1) AS positive, "
    "count(*) FILTER (label = 0) / greatest(count(*) FILTER (label = 1), 1)::DOUBLE AS positive_scale FROM unified",
)
add(
    "g3_label_totals",
    lambda spark, folder: profile.label_totals(unified(spark, folder)),
    f"{sql.UNIFIED_CTE} SELECT count(*) AS rows, sum(label)::BIGINT AS malicious, count(*) FILTER (label = 0) AS benign FROM unified",
)
add(
    "g4_rows_by_source",
    lambda spark, folder: profile.rows_by_source(unified(spark, folder)),
    f"{sql.UNIFIED_CTE} SELECT source_name, count(*) AS rows FROM unified GROUP BY 1",
)
add(
    "g5_labels_by_source",
    lambda spark, folder: profile.labels_by_source(unified(spark, folder)),
    f"{sql.UNIFIED_CTE} SELECT source_name, count(*) FILTER (label = 0) AS label_0, count(*) FILTER (label = 1) AS label_1 FROM unified GROUP BY 1",
)
add(
    "g6_class_distribution",
    lambda spark, folder: profile.class_distribution(unified(spark, folder)),
    f"{sql.UNIFIED_CTE} SELECT CAST(label AS INT) AS label, count(*) AS rows FROM unified GROUP BY 1",
)


def _split_sql() -> str:
    val = f"({fixed.VALIDATION_SIZE}::DOUBLE / (1.0::DOUBLE - {fixed.TEST_SIZE}::DOUBLE))"
    return f"""{sql.UNIFIED_CTE}, counts AS (SELECT label, count(*) AS n FROM unified GROUP BY 1),
t0 AS (SELECT *, ceil(sum(n) OVER () * {fixed.TEST_SIZE}::DOUBLE) AS want FROM counts),
t1 AS (SELECT *, want * n / sum(n) OVER () AS exact FROM t0),
t2 AS (SELECT *, floor(exact) + CAST(row_number() OVER (ORDER BY exact - floor(exact) DESC, label) <= want - sum(floor(exact)) OVER () AS INT) AS test FROM t1),
v0 AS (SELECT label, n, test, n - test AS rest, ceil(sum(n - test) OVER () * {val}) AS want FROM t2),
v1 AS (SELECT *, want * rest / sum(rest) OVER () AS exact FROM v0),
quotas AS (SELECT *, floor(exact) + CAST(row_number() OVER (ORDER BY exact - floor(exact) DESC, label) <= want - sum(floor(exact)) OVER () AS INT) AS validation FROM v1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(event_id || ':{fixed.SEED}')) AS r FROM unified),
parts AS (SELECT ranked.*, CASE WHEN r <= test THEN 'test' WHEN r <= test + validation THEN 'validation' ELSE 'train' END AS split
  FROM ranked JOIN quotas USING (label))"""


def _split(spark, folder) -> DataFrame:
    return split.stratified_split(unified(spark, folder), ["event_id"])


add(
    "g7_split_rows",
    lambda spark, folder: profile.split_rows(_split(spark, folder)).withColumn("features", F.lit(len(fixed.FEATURE_NAMES))),
    f"{_split_sql()} SELECT split, count(*) AS rows, {len(fixed.FEATURE_NAMES)} AS features FROM parts GROUP BY 1",
)


def scored_labels(spark, folder) -> DataFrame:
    """Document labels as a scored table: quality is the label, not toxic the prediction."""
    table = telemetry.table(spark, folder, "labels")
    return table.select(
        F.col("quality").alias("label"), (1 - F.col("toxic")).alias("prediction"), (F.col("doc_id") % 97 / 97.0).alias("probability")
    )


_SCORED_LABELS = """WITH s AS (SELECT quality AS label, 1 - toxic AS prediction, (doc_id % 97) / 97.0::DOUBLE AS probability FROM labels),
c AS (SELECT count(*) FILTER (label = 0 AND prediction = 0) AS tn, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
  count(*) FILTER (label = 1 AND prediction = 0) AS fn, count(*) FILTER (label = 1 AND prediction = 1) AS tp FROM s)"""
add(
    "g8_binary_metrics",
    lambda spark, folder: evaluate.binary_metrics(scored_labels(spark, folder)),
    f"{_SCORED_LABELS} SELECT (tp + tn) / (tp + tn + fp + fn)::DOUBLE AS accuracy, tp / (tp + fp)::DOUBLE AS precision, "
    "tp / (tp + fn)::DOUBLE AS recall, 2 * tp / (2 * tp + fp + fn)::DOUBLE AS f1_score FROM c",
)
add(
    "g9_confusion_matrix",
    lambda spark, folder: evaluate.confusion_matrix(scored_labels(spark, folder)),
    f"{_SCORED_LABELS} SELECT 'actual_0' AS actual, tn AS pred_0, fp AS pred_1 FROM c UNION ALL SELECT 'actual_1', fn, tp FROM c",
)
_REPORT = f"""{_SCORED_LABELS}, classes AS (
  SELECT '0' AS name, coalesce(tn / nullif(tn + fn, 0)::DOUBLE, 0) AS p, coalesce(tn / nullif(tn + fp, 0)::DOUBLE, 0) AS r,
    coalesce(2 * tn / nullif(2 * tn + fn + fp, 0)::DOUBLE, 0) AS f, tn + fp AS support FROM c
  UNION ALL SELECT '1', coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0), coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0),
    coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0), tp + fn FROM c),
report AS (SELECT name, p, r, f, support FROM classes
  UNION ALL SELECT 'accuracy', a, a, a, n FROM (SELECT (tp + tn) / (tp + tn + fp + fn)::DOUBLE AS a, tp + tn + fp + fn AS n FROM c)
  UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), sum(support) FROM classes
  UNION ALL SELECT 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support), sum(f * support) / sum(support), sum(support) FROM classes)"""


@register(
    "g10_classification_report",
    f'{_REPORT} SELECT name, round(p, 9) AS "precision", round(r, 9) AS recall, round(f, 9) AS f1_score, support::BIGINT AS support FROM report',
)
def _g10(spark, folder):
    report = evaluate.classification_report(scored_labels(spark, folder))
    return report.select("name", *[F.round(n, 9).alias(n) for n in ("precision", "recall", "f1_score")], "support")


add(
    "g11_probability_summary",
    lambda spark, folder: evaluate.probability_summary(scored_labels(spark, folder)).select(
        "min", "max", F.round("mean", 9).alias("mean")
    ),
    f'{_SCORED_LABELS} SELECT min(probability) AS "min", max(probability) AS "max", round(avg(probability), 9) AS mean FROM s',
)


# --- H. order and limits ----------------------------------------------------------------------


@register(
    "h3_best_candidate",
    """WITH s AS (SELECT source_name AS name, CAST(dense_rank() OVER (ORDER BY source_name) AS INT) AS position,
  2 * tp / (2 * tp + fp + fn)::DOUBLE AS f1, (tp + tn) / (tp + tn + fp + fn)::DOUBLE AS accuracy FROM (
  SELECT event_type AS source_name, count(*) FILTER (event_id % 2 = 1 AND value > 50) AS tp, count(*) FILTER (event_id % 2 = 0 AND value <= 50) AS tn,
    count(*) FILTER (event_id % 2 = 0 AND value > 50) AS fp, count(*) FILTER (event_id % 2 = 1 AND value <= 50) AS fn FROM events GROUP BY 1))
SELECT name, f1, accuracy FROM s ORDER BY f1 DESC, accuracy DESC, position LIMIT 1""",
)
def _h3(spark, folder):
    """Scores of one candidate per event type, computed from the events."""
    rows = telemetry.table(spark, folder, "events").select(
        "event_type", (F.col("event_id") % 2).alias("label"), (F.col("value") > 50).cast("int").alias("prediction")
    )
    hit, both = F.col("label") == 1, F.col("label") == F.col("prediction")
    scores = rows.groupBy("event_type").agg(
        (2 * F.count_if(hit & both) / (F.count_if(hit) + F.count_if(F.col("prediction") == 1))).alias("f1"),
        (F.count_if(both) / F.count(F.lit(1))).alias("accuracy"),
    )
    named = scores.select(F.col("event_type").alias("name"), "f1", "accuracy", F.col("event_type").alias("position"))
    return evaluate.best_candidate(named).select("name", "f1", "accuracy")


CURSOR = "2024-01-02T00:00:00Z"


@register(
    "h4_oldest_page",
    f"{sql.DOCS_CTE} SELECT event_id, stamp AS event_timestamp FROM docs WHERE stamp >= '{CURSOR}' ORDER BY stamp, _index, _id LIMIT {fixed.FIREWALL_PAGE_SIZE}",
)
def _h4(spark, folder):
    oldest = event_sources.page(timed_documents(spark, folder), fixed.FIREWALL_PAGE_SIZE, CURSOR)
    return oldest.select("event_id", F.col("timestamp").alias("event_timestamp"))


add(
    "h5_newest_event",
    lambda spark, folder: event_sources.newest(timed_documents(spark, folder)).withColumnRenamed("timestamp", "event_timestamp"),
    f"{sql.DOCS_CTE} SELECT stamp AS event_timestamp, _index, _id FROM docs ORDER BY stamp DESC, _index DESC, _id DESC LIMIT 1",
)


# --- I. unions --------------------------------------------------------------------------------


@register(
    "i1_union_of_sources",
    " UNION ALL ".join(
        f"SELECT * FROM ({part}) p{n}"
        for n, part in enumerate(
            [
                sql.flow_table_sql("label <> 'BENIGN'"),
                sql.flow_csv_sql(sql.words_sql("label")),
                sql.payload_sql("uri", "CAST(label <> 'BENIGN' AS INT)", sql.FLOW_CTE, "flows"),
                sql.firewall_sql(),
            ]
        )
    ),
)
def _i1(spark, folder):
    raw, keep = telemetry.flow_view(spark, folder), ["event_id"]
    return plain_record(
        unify.union_sources(
            unify.unify_flow_table(telemetry.flow_table_view(raw), keep=keep),
            unify.unify_flow_csv(telemetry.flow_csv_view(raw), keep=keep),
            unify.unify_payloads(telemetry.payload_view(raw), keep=keep),
            unify.unify_firewall_log(telemetry.firewall_view(raw), keep=keep),
        )
    )


@register("i2_train_and_validation", f"{_split_sql()} SELECT event_id FROM parts WHERE split IN ('train', 'validation')")
def _i2(spark, folder):
    return _split(spark, folder).filter(F.col("split").isin(split.TRAIN, split.VALIDATION)).select("event_id")


# --- J. splits --------------------------------------------------------------------------------

add(
    "j1_stratified_split",
    lambda spark, folder: _split(spark, folder).select("event_id", F.col("label").cast("int").alias("label"), "split"),
    f"{_split_sql()} SELECT event_id, CAST(label AS INT) AS label, split FROM parts",
)
SUBSET_ROWS = 750


@register(
    "j2_selection_subset",
    f"""{sql.UNIFIED_CTE}, counts AS (SELECT label, count(*) AS n FROM unified GROUP BY 1),
q0 AS (SELECT *, least({SUBSET_ROWS}, sum(n) OVER ()) AS want FROM counts), q1 AS (SELECT *, want * n / sum(n) OVER ()::DOUBLE AS exact FROM q0),
quotas AS (SELECT *, floor(exact) + CAST(row_number() OVER (ORDER BY exact - floor(exact) DESC, label) <= want - sum(floor(exact)) OVER () AS INT) AS kept FROM q1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(event_id || ':{fixed.SEED}')) AS r FROM unified)
SELECT event_id, CAST(label AS INT) AS label FROM ranked JOIN quotas USING (label) WHERE r <= kept""",
)
def _j2(spark, folder):
    """The sampling operator of model selection, at a limit below the table size."""
    subset = split.selection_subset(unified(spark, folder), ["event_id"], SUBSET_ROWS)
    return subset.select("event_id", F.col("label").cast("int").alias("label"))


# --- K. models (no SQL form) ------------------------------------------------------------------

SMALL_BOOSTED = {"rounds": 4, "depth": 4, "rate": 0.3}
SMALL_FOREST = {"trees": 6, "depth": 6}


def _training_features(spark, folder) -> DataFrame:
    rows = weights.with_sample_weights(unified(spark, folder))
    fitted = state.fit_to(rows, scratch_path(spark, "state"))
    return training.feature_table(rows, fitted, ["event_id", "weight"])


def _fitted(spark, folder, candidate: int, boosted: dict | None = SMALL_BOOSTED):
    """The training table and a model of it; boosted trees have the operator's own sizes where ``boosted`` is None."""
    table = _training_features(spark, folder)
    chosen = training.default_candidates(boosted, SMALL_FOREST)[candidate]
    totals = weights.positive_scale(table).first()
    return table, models.fit_model(chosen.estimator(), table, chosen.weight(totals.negative, totals.positive))


def _scored_by(candidate: int, boosted: dict | None = SMALL_BOOSTED) -> Query:
    def query(spark, folder):
        table, model = _fitted(spark, folder, candidate, boosted)
        scored = models.with_prediction(models.with_probability(table, model))
        return scored.select("event_id", F.col("label").cast("int").alias("label"), "probability", "prediction")

    return query


add("k1_boosted_trees", _scored_by(0, None))  # 400 rounds of depth 10
add("k2_random_forest", _scored_by(1))


@register("k3_train_and_select")
def _k3(spark, folder):
    result = _trained(spark, folder)[1]
    return result.candidate_scores


def _trained(spark, folder):
    artifacts = scratch_path(spark, "artifacts")
    candidates = training.default_candidates(SMALL_BOOSTED, SMALL_FOREST)
    return artifacts, training.train(unified(spark, folder), artifacts, ["event_id"], candidates)


@register("k5_h1_feature_importance")
def _k5(spark, folder):
    _, model = _fitted(spark, folder, 1)
    return evaluate.feature_importance(evaluate.model_importances(model, spark))


@register("h2_top_features")
def _h2(spark, folder):
    _, model = _fitted(spark, folder, 1)
    return evaluate.feature_importance(evaluate.model_importances(model, spark), 25)


@register("k6_b3_b5_evaluate_saved_model")
def _k6(spark, folder):
    artifacts, _ = _trained(spark, folder)
    return training.evaluate_saved(spark, artifacts)["metrics"]


# Facts about fitted models and stored artifacts that SQL can state, whatever trees were grown.


def _checked_by(candidate: int) -> Query:
    """Every row is scored once, within 0 and 1, and decided at the threshold."""

    def query(spark, folder):
        p, decided = F.col("probability"), F.col("prediction")
        return _scored_by(candidate)(spark, folder).select(
            "event_id", "label", p.between(0.0, 1.0).alias("in_range"), (decided == (p >= 0.5).cast("int")).alias("decided")
        )

    return query


_CHECKED_SQL = f"{sql.UNIFIED_CTE} SELECT event_id, CAST(label AS INT) AS label, true AS in_range, true AS decided FROM unified"
add("k1_k4_boosted_trees_checked", _checked_by(0), _CHECKED_SQL)
add("k2_k4_random_forest_checked", _checked_by(1), _CHECKED_SQL)


def _facts(spark, facts: dict[str, float]) -> DataFrame:
    return spark.createDataFrame([(name, float(value)) for name, value in facts.items()], "fact string, value double")


def _facts_sql(facts: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS fact, CAST({value} AS DOUBLE) AS value" for name, value in facts.items())


@register(
    "k5_h1_h2_importance_checked",
    _facts_sql({"features": "47", "top": "25", "sum": "1", "falling": "1", "negative": "0", "top_is_head": "1"}),
)
def _k5_checked(spark, folder):
    """Importances of all features sum to 1 and fall; the short list is the head of the long one."""
    _, model = _fitted(spark, folder, 1)
    importances = evaluate.model_importances(model, spark)
    ranked = [tuple(row) for row in evaluate.feature_importance(importances).collect()]  # one row per feature
    top = [tuple(row) for row in evaluate.feature_importance(importances, 25).collect()]
    values = [value for _, value in ranked]
    return _facts(spark, {
        "features": len({name for name, _ in ranked} & set(fixed.FEATURE_NAMES)), "top": len(top), "sum": round(sum(values), 9),
        "falling": values == sorted(values, reverse=True), "negative": sum(v < 0 for v in values), "top_is_head": top == ranked[:25],
    })


@register(
    "k3_k6_a9_a10_b3_b4_b5_artifacts_checked",
    f"""{_split_sql()}, held AS (SELECT count(*) AS n, count(*) FILTER (WHERE label = 1) AS p FROM parts WHERE split = 'test') """
    + _facts_sql({
        "candidates": "2", "selected_is_best": "1", "feature_list": "47", "schema_rows": "(SELECT count(*) FROM unified)",
        "summary_test_rows": "(SELECT n FROM held)", "test_rows": "(SELECT n FROM held)", "test_positive": "(SELECT p FROM held)",
        "matrix_rows": "(SELECT n FROM held)", "matrix_positive": "(SELECT p FROM held)", "importance_rows": "47", "top_rows": "25",
        "report_rows": "(SELECT count(DISTINCT label) + 3 FROM parts WHERE split = 'test')", "same_metrics": "1", "same_scores": "1",
    }),
)
def _artifacts_checked(spark, folder):
    """Train and select, store everything, load it, evaluate again: sizes by SQL, and the saved model scores as the fitted one did."""
    artifacts, result = _trained(spark, folder)
    scores = result.candidate_scores.collect()  # one row per candidate
    best = max(scores, key=lambda row: (row.f1, row.accuracy, -row.position)).name
    summary = {(row.section, row.name): row.value for row in spark.read.json(f"{artifacts}/training_summary").collect()}
    schema = spark.read.json(f"{artifacts}/schema_metadata").filter("section = 'total_rows'").first()
    loaded = sinks.load_artifacts(spark, artifacts, with_test_split=True)
    again = training.evaluate_saved(spark, artifacts)
    held = sinks.read_test_split(spark, artifacts).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == 1).alias("p")).first()
    matrix = spark.read.schema("actual string, pred_0 long, pred_1 long").option("header", True).csv(f"{artifacts}/confusion_matrix")
    cells = {row.actual: row.pred_0 + row.pred_1 for row in matrix.collect()}
    spread_of = [F.round(f(F.col("probability")), 9) for f in (F.min, F.max, F.avg)]
    return _facts(spark, {
        "candidates": len(scores), "selected_is_best": best == result.model_name == loaded["model_name"],
        "feature_list": len(loaded["features"]), "schema_rows": schema.value, "summary_test_rows": summary[("split_rows", "test")],
        "test_rows": held.n, "test_positive": held.p, "matrix_rows": sum(cells.values()), "matrix_positive": cells["actual_1"],
        "importance_rows": spark.read.option("header", True).csv(f"{artifacts}/feature_importance").count(),
        "top_rows": spark.read.json(f"{artifacts}/top_features").count(),
        "report_rows": spark.read.text(f"{artifacts}/classification_report").count(),
        "same_metrics": again["metrics"].first() == result.evaluation["metrics"].first(),
        "same_scores": again["scored"].agg(*spread_of).first() == result.scored_test.agg(*spread_of).first(),
    })


# --- L. inference -----------------------------------------------------------------------------


def predicted(spark, folder, keep: list[str]) -> DataFrame:
    """Rule-scored predictions of the unified view."""
    frame = unified(spark, folder)
    return scoring.predict(frame, _stored_state(spark, folder), scoring.rule_scorer, keep)


@register(
    "l1_suspicious_payload",
    f"{sql.UNIFIED_CTE} SELECT event_id, {sql.suspicious_sql('uri')} AS suspicious FROM unified",
)
def _l1(spark, folder):
    return unified(spark, folder).select("event_id", is_suspicious(F.col("uri")).alias("suspicious"))


@register(
    "l2_both_views",
    f"{sql.SCORED_CTE} SELECT event_id, round(probability, 6) AS probability, round(web_probability, 6) AS web_probability FROM scored",
)
def _l2(spark, folder):
    frame = unified(spark, folder)
    scored = scoring.score_both_views(frame, _stored_state(spark, folder), scoring.rule_scorer, ["event_id"])
    return scored.select("event_id", *[F.round(n, 6).alias(n) for n in ("probability", "web_probability")])


@register(
    "l3_l4_choice_and_decision",
    f"{sql.SCORED_CTE} SELECT event_id, round(malicious_probability, 6) AS malicious_probability, selected_view, prediction FROM predicted",
)
def _l3(spark, folder):
    scored = predicted(spark, folder, ["event_id"])
    return scored.select(
        "event_id", F.round("malicious_probability", 6).alias("malicious_probability"), "selected_view", "prediction"
    )


@register(
    "l5_b6_prediction_records",
    f"""{sql.SCORED_CTE} SELECT event_id AS "index", prediction, round(malicious_probability, 6) AS malicious_probability, selected_view,
src_ip, dst_ip, src_port, dst_port, protocol, bytes::DOUBLE AS bytes, packets::DOUBLE AS packets, duration::DOUBLE AS duration, http_method, uri
FROM predicted JOIN unified USING (event_id)""",
)
def _l5(spark, folder):
    """Prediction records written as JSON and read back."""
    frame = unified(spark, folder)
    records = scoring.prediction_records(frame, _stored_state(spark, folder), scoring.rule_scorer, "event_id")
    path = scratch_path(spark, "predictions")
    sinks.write_predictions(records, path)
    stored = spark.read.schema(records.schema).json(path)
    nested = ["src_ip", "dst_ip", "src_port", "dst_port", "protocol", "http_method", "uri"]
    return stored.select(
        "index",
        "prediction",
        F.round("malicious_probability", 6).alias("malicious_probability"),
        "selected_view",
        *[F.col(f"normalized_record.{n}").cast("double").alias(n) for n in ("bytes", "packets", "duration")],
        *[F.col(f"normalized_record.{n}").alias(n) for n in nested],
    )


@register(
    "l6_risk_level",
    f"WITH p AS (SELECT event_id, value / (value + 20) AS p FROM events) SELECT event_id, {sql.risk_sql('p')} AS risk_level FROM p",
)
def _l6(spark, folder):
    table = telemetry.table(spark, folder, "events")
    return table.select("event_id", scoring.risk_level(F.col("value") / (F.col("value") + 20)).alias("risk_level"))


# --- M. event documents -----------------------------------------------------------------------


def _flat(spark, folder, paths: list[str]) -> DataFrame:
    docs = telemetry.document_view(spark, folder)
    flat = events.flatten(docs, paths, ["event_id"])
    return flat.select("event_id", "_paths", *[F.col("_values")[n].alias(f"v{n}") for n in range(len(paths))])


M1_PATHS = ["source.ip", "event.module", "suricata.eve.alert.signature", "suricata.eve.proto", "url.original", "network.bytes"]


@register(
    "m1_flatten",
    f"{sql.DOCS_CTE} SELECT event_id, {', '.join(f'{sql.at(p)} AS v{n}' for n, p in enumerate(M1_PATHS))} FROM docs",
)
def _m1(spark, folder):
    return _flat(spark, folder, M1_PATHS).drop("_paths")


M2_PATHS = ["event.action", "source.port", "event.module", "http.request.method"]


@register(
    "m2_first_of_list",
    f"{sql.DOCS_CTE} SELECT event_id, {', '.join(f'{sql.at(p)} AS v{n}' for n, p in enumerate(M2_PATHS))} FROM docs",
)
def _m2(spark, folder):
    return _flat(spark, folder, M2_PATHS).drop("_paths")


M3_PATHS = ["network.bytes", "event.severity", "source.ip", "source.address"]


@register(
    "m3_first_present_path",
    f"{sql.DOCS_CTE} SELECT event_id, coalesce({', '.join(f'nullif({sql.at(p)}, {sql.q(str()) })' for p in M3_PATHS)}, '') AS value FROM docs",
)
def _m3(spark, folder):
    flat = _flat(spark, folder, M3_PATHS)
    return flat.select("event_id", documents.first_present(*[F.col(f"v{n}") for n in range(len(M3_PATHS))]).alias("value"))


@register(
    "m4_numbers_from_text",
    f"{NUMBER_CTE} SELECT event_id, n AS as_float, CASE WHEN isinf(n) OR abs(n) >= 9e18 THEN 0 ELSE trunc(n)::BIGINT END AS as_int FROM "
    f"(SELECT event_id, {sql.number_sql('form')} AS n FROM raw)",
)
def _m4(spark, folder):
    form = number_forms()
    table = telemetry.table(spark, folder, "events")
    return table.select("event_id", documents.to_float(form).alias("as_float"), documents.to_int(form).alias("as_int"))


_MAPPERS = {"F": events.map_firewall_events, "R": events.map_ids_events, "S": events.map_single_ids_events}


def _mapped(spark, folder, rules: str) -> DataFrame:
    return _MAPPERS[rules](telemetry.document_view(spark, folder), ["event_id"])


def _add_mapped(name: str, rules: str, columns: list[str] | None = None) -> None:
    def query(spark, folder):
        names = columns or list(sql.mapped_sql(sql.MAPPER_PATHS[rules], rules))
        return _mapped(spark, folder, rules).select("event_id", *names)

    add(name, query, sql.mapper_query(rules, columns))


_add_mapped("m5_duration_two_source", "R", ["duration"])
_add_mapped("m5_duration_single_ids", "S", ["duration"])
_add_mapped("m6_bytes_two_source", "F", ["bytes"])
_add_mapped("m6_bytes_single_ids", "S", ["bytes"])
_add_mapped("m7_packets", "F", ["packets"])
_add_mapped("m8_uri_firewall", "F", ["uri"])
_add_mapped("m8_uri_single_ids", "S", ["uri"])
_add_mapped("m9_uri_ids_fallback", "R", ["uri"])
_add_mapped("m10_method", "S", ["http_method"])
_add_mapped("m11_protocol", "R", ["protocol"])
_add_mapped("m12_firewall_mapper", "F")
_add_mapped("m13_ids_mapper", "R")
_add_mapped("m14_single_ids_mapper", "S")


# --- N. streaming and alerting ----------------------------------------------------------------

add(
    "n1_time_filter",
    lambda spark, folder: event_sources.since(timed_documents(spark, folder), CURSOR).select("event_id"),
    f"{sql.DOCS_CTE} SELECT event_id FROM docs WHERE stamp >= '{CURSOR}'",
)


@register("n2_deduplicate", f"{sql.DOCS_CTE} SELECT _index, _id, stamp AS event_timestamp FROM docs")
def _n2(spark, folder):
    """Every event twice; one of each must remain."""
    timed = timed_documents(spark, folder)
    unique = jobs.deduplicate_batch(timed.unionByName(timed))
    return unique.select("_index", "_id", F.col("timestamp").alias("event_timestamp"))


def _event_files(spark, folder, times: int = 1) -> str:
    docs = telemetry.document_view(spark, folder).select("_index", "_id", "_source")
    path = scratch_path(spark, "events")
    for _ in range(times):
        docs.write.mode("append").json(path)
    return path


@register("n2_stream_deduplicate", f"{sql.DOCS_CTE} SELECT _index, _id, stamp AS event_timestamp FROM docs")
def _n2_stream(spark, folder):
    """The same as a checkpointed stream over files that hold every event twice."""
    stream = event_sources.with_timestamp(event_sources.event_stream(spark, _event_files(spark, folder, 2)))
    unique = jobs.deduplicate(stream).select("_index", "_id", F.col("timestamp").alias("event_timestamp"))
    out = scratch_path(spark, "unique")
    jobs.to_json_files(unique, out, scratch_path(spark, "ckpt"), available_now=True).awaitTermination()
    return spark.read.schema("_index string, _id string, event_timestamp string").json(out)


def _stored_state(spark, folder) -> state.FeatureState:
    return state.fit_to(unified(spark, folder), scratch_path(spark, "state"))


def _stream_sql() -> str:
    one = (
        "({cte} SELECT source_id, source_type, round(malicious_probability, 6) AS malicious_probability, prediction = 1 AS alert "
        "FROM predicted WHERE prediction = 1 AND source_index = '{index}')"
    )
    return " UNION ALL ".join(one.format(cte=sql.scored_events_cte(rules), index=index) for rules, index in (("F", "idx-0"), ("R", "idx-1")))


@register("n3_b7_b8_scored_streams", _stream_sql())
def _n3(spark, folder):
    """Two sources, each a stream with its mapper, scored batch by batch with published state; their alerts in one table, read as committed."""
    files_ = _event_files(spark, folder)
    root, out = scratch_path(spark, "published"), scratch_path(spark, "alerts")
    state.publish_state(unified(spark, folder), root)
    for mapper, index in ((events.map_firewall_events, "idx-0"), (events.map_ids_events, "idx-1")):
        stream = event_sources.event_stream(spark, files_).filter(F.col("_index") == index)
        checkpoint = scratch_path(spark, "ckpt")
        write = sinks.append_batch(out, checkpoint)
        jobs.scored_batches(stream, mapper, state.PublishedState(root), scoring.rule_scorer, write, checkpoint, alerts_only=True, available_now=True).awaitTermination()
    stored = sinks.read_table(spark, out)
    return stored.select(
        F.col("source_ref.id").alias("source_id"),
        "source_type",
        F.round("ml.malicious_probability", 6).alias("malicious_probability"),
        F.col("ml.alert").alias("alert"),
    )


@register(
    "n3_b7_scored_stream",
    f"{sql.scored_events_cte('R')} SELECT source_id, round(malicious_probability, 6) AS malicious_probability, prediction = 1 AS alert FROM predicted",
)
def _n3_files(spark, folder):
    """Events to scored alert records in one stream with a file sink, read back."""
    stream = event_sources.event_stream(spark, _event_files(spark, folder))
    scored = jobs.scored_stream(stream, events.map_ids_events, _stored_state(spark, folder), scoring.rule_scorer)
    out = scratch_path(spark, "records")
    jobs.to_json_files(scored, out, scratch_path(spark, "ckpt"), available_now=True).awaitTermination()
    stored = spark.read.schema(scored.schema).json(out)
    return stored.select(
        F.col("source_ref.id").alias("source_id"),
        F.round("ml.malicious_probability", 6).alias("malicious_probability"),
        F.col("ml.alert").alias("alert"),
    )


def _scored_events(spark, folder, rules: str) -> DataFrame:
    mapped = _MAPPERS[rules](telemetry.document_view(spark, folder), ["event_id"])
    return alerts.score_events(mapped, _stored_state(spark, folder), scoring.rule_scorer)


def _records(spark, folder) -> DataFrame:
    return alerts.alert_records(_scored_events(spark, folder, "R"), ["event_id"])


def _ids_records(spark, folder, mode: str = "suricata_or_ml") -> DataFrame:
    return alerts.ids_alert_records(_scored_events(spark, folder, "S"), mode, ["event_id"])


_RECORD_SQL = (
    "event_id, event_timestamp, source_type, source_index, source_id, src_ip, dst_ip, src_port, dst_port, protocol, bytes, packets, "
    "duration, http_method, uri, severity, prediction, round(malicious_probability, 6) AS malicious_probability, risk_level, selected_view, "
    f"'{fixed.MODEL_FAMILY}' AS model_family"
)


def _opened(records: DataFrame, context: str) -> list[Column]:
    return [
        F.col("event_id"),
        F.col("`@timestamp`").alias("event_timestamp"),
        F.col("source_type"),
        F.col("source_ref.index").alias("source_index"),
        F.col("source_ref.id").alias("source_id"),
        *[F.col(f"network_event.{n}").alias(n) for n in fixed.NETWORK_FIELDS],
        F.col(f"{context}.severity").alias("severity"),
        F.col("ml.prediction").alias("prediction"),
        F.round("ml.malicious_probability", 6).alias("malicious_probability"),
        F.col("ml.risk_level").alias("risk_level"),
        F.col("ml.selected_view").alias("selected_view"),
        F.col("ml.model_family").alias("model_family"),
    ]


@register(
    "n4_alert_records",
    f"{sql.scored_events_cte('R')} SELECT {_RECORD_SQL}, action, reason, rule_name, prediction = 1 AS alert FROM predicted",
)
def _n4(spark, folder):
    records = _records(spark, folder)
    extra = [F.col(f"event_context.{n}").alias(n) for n in ("action", "reason", "rule_name")]
    return records.select(*_opened(records, "event_context"), *extra, F.col("ml.alert").alias("alert"))


@register(
    "n5_ids_alert_records",
    f"{sql.scored_events_cte('S')} SELECT {_RECORD_SQL}, signature, category, action, message, true AS triggered, "
    "CASE WHEN prediction = 1 THEN 'suricata_alert_and_ml' ELSE 'suricata_alert' END AS reason, 'suricata_or_ml' AS mode FROM predicted",
)
def _n5(spark, folder):
    records = _ids_records(spark, folder)
    extra = [F.col(f"suricata.{n}").alias(n) for n in ("signature", "category", "action", "message")]
    decision = [F.col(f"alert.{n}").alias(n) for n in ("triggered", "reason", "mode")]
    return records.select(*_opened(records, "suricata"), *extra, *decision)


@register("b8_alert_table_filter", f"{sql.scored_events_cte('R')} SELECT event_id FROM predicted WHERE prediction = 1")
def _b8(spark, folder):
    return alerts.only_alerts(_records(spark, folder)).select("event_id")


@register(
    "n6_notification_filter",
    f"{sql.scored_events_cte('R')} SELECT event_id FROM predicted WHERE prediction = 1 AND malicious_probability >= 0.80",
)
def _n6(spark, folder):
    return alerts.notifiable(_records(spark, folder)).select("event_id")


@register(
    "n7_ids_notification_filter",
    f"{sql.scored_events_cte('S')} SELECT event_id FROM predicted WHERE prediction = 1 AND malicious_probability >= 0.70",
)
def _n7(spark, folder):
    return alerts.ids_notifiable(_ids_records(spark, folder, "ml_only"), 0.70).select("event_id")


def _n8(spark, folder):
    table = telemetry.table(spark, folder, "events").withColumn("prediction", (F.col("value") > 50).cast("int"))
    decisions = [alerts.decide_alert(F.col("prediction"), mode) for mode in fixed.ALERT_MODES]
    chosen = [
        column
        for mode, d in zip(fixed.ALERT_MODES, decisions)
        for column in (d["triggered"].alias(f"{mode}_triggered"), d["reason"].alias(f"{mode}_reason"))
    ]
    return table.select("event_id", *chosen)


add(
    "n8_alert_decision",
    _n8,
    """SELECT event_id, true AS suricata_or_ml_triggered, CASE WHEN value > 50 THEN 'suricata_alert_and_ml' ELSE 'suricata_alert' END AS suricata_or_ml_reason,
true AS suricata_only_triggered, 'suricata_alert' AS suricata_only_reason, value > 50 AS ml_only_triggered, 'ml_prediction' AS ml_only_reason FROM events""",
)
add(
    "n9_notification_text",
    lambda spark, folder: _records(spark, folder).select("event_id", alerts.notice_text().alias("message")),
    f"{sql.scored_events_cte('R')} SELECT event_id, {sql.notice_sql()} AS message FROM predicted",
)
add(
    "n10_ids_notification_text",
    lambda spark, folder: _ids_records(spark, folder).select("event_id", alerts.ids_notice_text().alias("message")),
    f"{sql.scored_events_cte('S')} SELECT event_id, "
    + sql.ids_notice_sql("CASE WHEN prediction = 1 THEN 'suricata_alert_and_ml' ELSE 'suricata_alert' END")
    + " AS message FROM predicted",
)
add(
    "b10_notification_outbox",
    lambda spark, folder: alerts.outbox(alerts.only_alerts(_records(spark, folder)), alerts.notice_text()),
    f"{sql.scored_events_cte('R')} SELECT source_index, source_id, {sql.notice_sql()} AS message FROM predicted WHERE prediction = 1",
)


@register("n11_truncate_text", f"SELECT doc_id, {sql.cut_sql('text')} AS shown FROM documents")
def _n11(spark, folder):
    table = telemetry.table(spark, folder, "documents")
    return table.select("doc_id", text.truncate(F.col("text"), fixed.NOTICE_TEXT_LENGTH).alias("shown"))


@register("n12_html_escape", f"SELECT page_id, md5({sql.escape_sql('html')}) AS digest, length({sql.escape_sql('html')}) AS n FROM pages")
def _n12(spark, folder):
    escaped = text.html_escape(F.col("html"))
    table = telemetry.table(spark, folder, "pages")
    return table.select("page_id", F.md5(escaped).alias("digest"), F.length(escaped).cast("long").alias("n"))


# --- whole jobs -------------------------------------------------------------------------------


_RANK_COUNTS = sql.text_sql("text")
_RANK_SCORES = sql.score_sql(_RANK_COUNTS)


@register(
    "attack_ranking",
    f"""{sql.STATE_CTE} SELECT src AS src_key, count(*) AS requests, sum({_RANK_SCORES['sql_attack_score']}) AS sql_attack_score,
sum({_RANK_SCORES['xss_attack_score']}) AS xss_attack_score, max(coalesce(n, 0)) AS most_repeated
FROM keyed LEFT JOIN request_state ON key = request GROUP BY 1""",
)
def _ranking(spark, folder):
    return ranking.attack_ranking(unified(spark, folder))


@register("a4_a5_payload_source", PAYLOAD_LINES_SQL)
def _a4(spark, folder):
    rows = files.payload_rows(spark, _payload_folder(spark, folder), json_lines=True, pattern="*.txt")
    return rows.groupBy("payload", "label").agg(F.count(F.lit(1)).alias("n"))


@register("k4_predict_with_model")
def _k4(spark, folder):
    """Raw rows to prediction records with a fitted model and both views."""
    table, model = _fitted(spark, folder, 0)
    raw = telemetry.flow_view(spark, folder).drop("ts", "source_name").withColumnRenamed("event_id", "index")
    records = prediction.predict_table(raw, _stored_state(spark, folder), scoring.model_scorer(model))
    return records.select("index", "prediction", "malicious_probability", "selected_view")
