"""DuckDB SQL for the registered queries, over the same driver tables.

The common table expressions restate the telemetry views; each query adds its own final SELECT.
"""

from __future__ import annotations

from itertools import product

from .. import fixed_values as fixed
from ..operators import events as mappers
from . import telemetry as view


class literal:
    """Values of the rules, written out here so that a wrong constant of the library shows as a difference."""

    BENIGN_WORDS = ["benign", "normal", "legitimate", "allow", "allowed", "clean", "successful"]
    MALICIOUS_WORDS = [
        "attack", "malicious", "sqli", "sql injection", "xss", "brute", "dos", "ddos", "portscan",
        "scan", "bot", "infiltration", "exploit", "fuzzer", "reconnaissance", "backdoor", "shellcode",
        "worm", "generic", "deny", "denied", "blocked", "anomaly", "abnormal",
    ]
    SQL_KEYWORD_PATTERN = (
        r"\b(select|union(?:\s+all)?|insert|update|delete|drop|sleep|benchmark|waitfor|exec(?:ute)?|declare|cast|convert|"
        r"having|order\s+by|group\s+by|information_schema|load_file|outfile|xp_cmdshell|dbms_[a-z_]+|pg_sleep|"
        r"ascii\(|substring\(|concat\(|char\(|chr\(|hex\(|unhex\(|database\(|schema\(|table_name|column_name)"
    )
    SQL_TAUTOLOGY_PATTERN = r"(?:\b(?:or|and|xor)\b\s+['\"`\(]*[a-z0-9_]+['\"`]*\s*=\s*['\"`]*[a-z0-9_]+['\"`]*)"
    SQL_COMMENT_PATTERN = r"(--|#|/\*|\*/|;)"
    SQL_ENCODED_META_PATTERN = r"(%27|%22|%23|%2d%2d|%3b|%2f\*|\*/|%3d|%28|%29)"
    XSS_KEYWORD_PATTERN = (
        r"(<script|</script|javascript:|vbscript:|data:text/html|alert\(|document\.cookie|window\.location|<img|<svg|<iframe|<body)"
    )
    XSS_EVENT_HANDLER_PATTERN = r"(on[a-z]+\s*=)"
    XSS_SCRIPT_TAG_PATTERN = r"(<script|</script|%3cscript|%3c/script)"
    WEB_PORTS = [80, 443, 8080, 8443]
    PRIVATE_IP_PATTERN = r"^(10\.|127\.|192\.168\.|172\.(1[6-9]|2[0-9]|3[0-1])\.)"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def choose(selector: str, options: dict, default: str) -> str:
    cases = " ".join(f"WHEN {selector} = {q(k) if isinstance(k, str) else k} THEN {v}" for k, v in options.items())
    return f"CASE {cases} ELSE {default} END"


def texts(options: dict) -> dict:
    return {k: q(v) for k, v in options.items()}


WS = r"E' \t\n\r'"
FLOWS = f"""
flows AS (
  SELECT event_id, ts,
    CASE WHEN user_id % 11 = 0 THEN '' WHEN user_id % 3 = 0 THEN '203.0.113.' || (user_id % 256)
         ELSE '10.0.0.' || (user_id % 256) END AS src_ip,
    CASE WHEN k % 13 = 0 THEN '' ELSE '192.168.' || (k % 4) || '.' || (k % 32) END AS dst_ip,
    CAST(1024 + (event_id * 7919) % 64000 AS INT) AS src_port,
    {choose('event_id % 7', dict(enumerate(view.PORTS[:-1])), str(view.PORTS[-1]))} AS dst_port,
    {choose('event_type', texts(view.PROTOCOLS), "''")} AS protocol,
    value * 100 AS bytes, floor(value) AS packets, value / 100 AS duration,
    {choose('event_type', texts(view.METHODS), "''")} AS http_method,
    CASE WHEN event_id % 12 = {view.ITEM_SLOT} THEN '/items/' || (event_id % 499) || '?page=' || k || '&sort=asc'
         ELSE {choose('event_id % 12', texts(view.URI_SLOTS), "''")} END AS uri,
    CASE WHEN event_type <> 'error' THEN 'BENIGN' WHEN event_id % 2 = 0 THEN 'DDoS' ELSE 'PortScan' END AS label,
    {choose('event_id % 4', texts(dict(enumerate(view.SOURCES[:-1]))), q(view.SOURCES[-1]))} AS source_name
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events))"""


def protocol_sql(column: str) -> str:
    return f"CASE WHEN upper(trim({column}, {WS})) IN ('-', '0') THEN '' ELSE upper(trim({column}, {WS})) END"


def words_sql(column: str) -> str:
    text = f"lower(trim({column}, {WS}))"
    bad = " OR ".join(f"contains({text}, {q(w)})" for w in literal.MALICIOUS_WORDS)
    good = " OR ".join(f"contains({text}, {q(w)})" for w in literal.BENIGN_WORDS)
    return f"CASE WHEN {bad} THEN 1 WHEN {good} THEN 0 WHEN {number_sql(column)} > 0 THEN 1 ELSE 0 END"


def number_sql(column: str) -> str:
    shape = r"^[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)$"
    text = f"trim(CAST({column} AS VARCHAR), {WS})"
    return f"CASE WHEN regexp_full_match({text}, {q(shape)}) THEN try_cast({text} AS DOUBLE) ELSE 0 END"


def port_sql(number: str) -> str:
    return f"CAST(round_even(least(greatest({number}, 0), 65535), 0) AS INT)"


UNIFIED = f"""
unified AS (
  SELECT event_id, src_ip, dst_ip, src_port, dst_port, {protocol_sql('protocol')} AS protocol,
    CAST(bytes AS FLOAT) AS bytes, CAST(packets AS FLOAT) AS packets, CAST(duration AS FLOAT) AS duration,
    upper(http_method) AS http_method, trim(uri, {WS}) AS uri, {words_sql('label')} AS label,
    source_name, label AS original_label_text
  FROM flows)"""


def decode(text: str) -> str:
    return f"url_decode(replace({text}, '+', ' '))"


KEYS = f"""
base AS (SELECT *, {decode('uri')} AS text FROM unified),
pairs AS (
  SELECT *, CASE WHEN src_ip <> '' THEN src_ip ELSE 'NO_SRC::' || CASE WHEN protocol <> '' THEN protocol ELSE 'UNKNOWN' END END AS src,
    CASE WHEN dst_ip <> '' THEN dst_ip
         ELSE 'NO_DST::' || CASE WHEN protocol <> '' THEN protocol ELSE 'UNKNOWN' END || '::' || dst_port END AS dst,
    CASE WHEN text <> '' THEN text ELSE CASE WHEN dst_ip <> '' THEN dst_ip ELSE 'NO_ENDPOINT' END || '::' || dst_port END AS endpoint
  FROM base),
keyed AS (SELECT *, src || '->' || dst AS src_dst, src || '|' || endpoint AS request FROM pairs)"""


def _counts(kind: str) -> str:
    return f"{kind}_state AS (SELECT {kind} AS key, count(*) AS n FROM keyed GROUP BY 1 HAVING count(*) >= 2)"


def _codes(name: str) -> str:
    return f"""{name}_state AS (
  SELECT {name} AS value, count(*) / (SELECT greatest(count(*), 1)::DOUBLE FROM keyed) AS frequency,
    CASE WHEN {name} <> '' THEN row_number() OVER (ORDER BY {name}) END AS code
  FROM keyed GROUP BY 1)"""


STATE = ",\n".join(
    [
        _codes("protocol"),
        _codes("http_method"),
        "ports_state AS (SELECT src AS key, count(DISTINCT dst_port) AS ports, count(*) AS n FROM keyed GROUP BY 1)",
        *[_counts(kind) for kind in ("src", "dst", "src_dst", "endpoint", "request")],
    ]
)

FLOW_CTE = f"WITH {FLOWS}"
UNIFIED_CTE = f"{FLOW_CTE},{UNIFIED}"
KEYED_CTE = f"{UNIFIED_CTE},{KEYS}"
STATE_CTE = f"{KEYED_CTE},\n{STATE}"


def hits(text: str, pattern: str) -> str:
    return f"len(regexp_extract_all({text}, {q('(?i)' + pattern)}))"


def chars(text: str, one_of: str) -> str:
    return f"len(regexp_extract_all({text}, {q(one_of)}))"


def text_sql(text: str) -> dict[str, str]:
    lower = f"lower({text})"
    return {
        "uri_length": f"length({text})",
        "uri_path_depth": chars(text, "/"),
        "uri_query_param_count": f"CASE WHEN contains({text}, '=') THEN {chars(text, '&')} + 1 ELSE 0 END",
        "uri_equals_count": chars(text, "="),
        "uri_quote_count": chars(text, "['\"`]"),
        "uri_angle_bracket_count": chars(text, "[<>]"),
        "uri_has_query_string": f"CAST(contains({text}, '?') AS INT)",
        "uri_has_percent_encoding": f"CAST(regexp_matches({text}, '%[0-9a-fA-F]{{2}}') AS INT)",
        "uri_sql_keyword_hits": hits(text, literal.SQL_KEYWORD_PATTERN),
        "uri_sql_tautology_hits": hits(text, literal.SQL_TAUTOLOGY_PATTERN),
        "uri_sql_comment_hits": hits(text, literal.SQL_COMMENT_PATTERN),
        "uri_sql_encoded_meta_hits": hits(lower, literal.SQL_ENCODED_META_PATTERN),
        "uri_xss_keyword_hits": hits(text, literal.XSS_KEYWORD_PATTERN),
        "uri_xss_event_handler_hits": hits(text, literal.XSS_EVENT_HANDLER_PATTERN),
        "uri_xss_script_tag_hits": hits(lower, literal.XSS_SCRIPT_TAG_PATTERN),
        "uri_special_char_ratio": f"{chars(text, '[^A-Za-z0-9/_.-]')}::DOUBLE / (length({text}) + 1)",
    }


def score_sql(count: dict[str, str]) -> dict[str, str]:
    return {
        "sql_attack_score": f"2.0::DOUBLE * {count['uri_sql_keyword_hits']} + 3 * {count['uri_sql_tautology_hits']}"
        f" + {count['uri_sql_comment_hits']} + 0.5 * {count['uri_sql_encoded_meta_hits']} + 0.25 * {count['uri_quote_count']}",
        "xss_attack_score": f"2.0::DOUBLE * {count['uri_xss_keyword_hits']} + 2 * {count['uri_xss_event_handler_hits']}"
        f" + 2 * {count['uri_xss_script_tag_hits']} + 0.25 * {count['uri_angle_bracket_count']}",
    }


def share(above: str, below: str) -> str:
    return f"{above}::DOUBLE / greatest(({below})::DOUBLE, 1e-9)"


WEB = "(" + ", ".join(map(str, literal.WEB_PORTS)) + ")"
PRIVATE = q(literal.PRIVATE_IP_PATTERN)
RECORD_SQL = {
    "src_port": "src_port",
    "dst_port": "dst_port",
    "bytes": "bytes",
    "packets": "packets",
    "duration": "duration",
    "packets_per_flow": "packets",
    "bytes_per_flow": "bytes",
    "packet_byte_ratio": share("packets", "bytes + 1::FLOAT"),
    "bytes_per_second": share("bytes", "duration + 1e-6::FLOAT"),
    "packets_per_second": share("packets", "duration + 1e-6::FLOAT"),
    "duration_per_packet": share("duration", "packets + 1::FLOAT"),
    "http_like_request": f"CAST(protocol = 'HTTP' OR http_method <> '' OR length(text) > 0 OR dst_port IN {WEB} AS INT)",
    "protocol_is_http": "CAST(protocol = 'HTTP' AS INT)",
    "src_ip_is_private": f"CAST(regexp_matches(src_ip, {PRIVATE}) AS INT)",
    "dst_ip_is_private": f"CAST(regexp_matches(dst_ip, {PRIVATE}) AS INT)",
    "src_port_is_system": "CAST(src_port < 1024 AS INT)",
    "dst_port_is_system": "CAST(dst_port < 1024 AS INT)",
    "dst_port_is_web": f"CAST(dst_port IN {WEB} AS INT)",
    "payload_present": "CAST(length(text) > 0 AS INT)",
}


def _looked_up(table: str, match: str, value: str) -> str:
    return f"coalesce((SELECT {value} FROM {table} s WHERE s.{match}), 0)"


STATE_SQL = {
    "protocol_encoded": _looked_up("protocol_state", "value = keyed.protocol", "code"),
    "protocol_frequency": _looked_up("protocol_state", "value = keyed.protocol", "frequency"),
    "http_method_encoded": _looked_up("http_method_state", "value = keyed.http_method", "code"),
    "http_method_frequency": _looked_up("http_method_state", "value = keyed.http_method", "frequency"),
    "unique_dst_ports_per_source": f"ln(1 + {_looked_up('ports_state', 'key = keyed.src', 'ports')})",
    "repeated_access_count": f"ln(1 + {_looked_up('request_state', 'key = keyed.request', 'n')})",
    "src_ip_frequency": f"ln(1 + {_looked_up('src_state', 'key = keyed.src', 'n')})",
    "dst_ip_frequency": f"ln(1 + {_looked_up('dst_state', 'key = keyed.dst', 'n')})",
    "src_dst_pair_frequency": f"ln(1 + {_looked_up('src_dst_state', 'key = keyed.src_dst', 'n')})",
    "endpoint_frequency": f"ln(1 + {_looked_up('endpoint_state', 'key = keyed.endpoint', 'n')})",
}
FEATURE_SQL = RECORD_SQL | text_sql("text") | score_sql(text_sql("text")) | STATE_SQL


def feature_column(name: str) -> str:
    return f"CAST(CAST({FEATURE_SQL[name]} AS FLOAT) AS DOUBLE) AS {name}"


def feature_query(name: str, slots: dict[int, str] = view.URI_SLOTS) -> str:
    cte = STATE_CTE if name in STATE_SQL else KEYED_CTE
    usual, wanted = (choose("event_id % 12", texts(each), "''") for each in (view.URI_SLOTS, slots))
    cte = cte.replace(usual, wanted)
    return f"{cte} SELECT event_id, {feature_column(name)} FROM keyed"


def all_features_query() -> str:
    columns = ", ".join(feature_column(name) for name in fixed.FEATURE_NAMES)
    return f"{STATE_CTE} SELECT event_id, {columns} FROM keyed"


# --- normalisers ------------------------------------------------------------------------------

UNIFIED_OUT = (
    "event_id, src_ip, dst_ip, src_port, dst_port, protocol, CAST(bytes AS DOUBLE) AS bytes, CAST(packets AS DOUBLE) AS packets, "
    "CAST(duration AS DOUBLE) AS duration, http_method, uri, CAST(label AS INT) AS label, source_name, original_label_text"
)


def unified_out(**columns: str) -> str:
    """SELECT list of a normaliser oracle; fields left out are empty or zero."""
    defaults = {
        "src_ip": "''", "dst_ip": "''", "src_port": "0", "dst_port": "0", "protocol": "''", "bytes": "0", "packets": "0",
        "duration": "0", "http_method": "''", "uri": "''", "label": "0", "source_name": "''", "original_label_text": "''",
    }
    values = defaults | columns
    floats = {"bytes", "packets", "duration"}
    parts = ["event_id"]
    for name, value in values.items():
        if name in floats:
            value = f"CAST(CAST({value} AS FLOAT) AS DOUBLE)"
        elif name in ("label", "src_port", "dst_port"):
            value = f"CAST({value} AS INT)"
        parts.append(f"{value} AS {name}")
    return ", ".join(parts)


def flow_table_sql(label: str, source: str = fixed.FLOW_PARQUET_SOURCE) -> str:
    return f"{FLOW_CTE} SELECT " + unified_out(
        protocol=protocol_sql("protocol"),
        bytes="floor(bytes) + event_id % 1000",
        packets="packets + event_id % 5",
        duration="duration",
        http_method="CASE WHEN http_method <> '' THEN 'UNKNOWN_HTTP' ELSE '' END",
        label=label,
        source_name=q(source),
        original_label_text="CASE WHEN event_id % 3 = 0 THEN 'Normal' ELSE label END",
    ) + " FROM flows"


def flow_csv_sql(label: str, source: str = fixed.FLOW_CSV_SOURCE) -> str:
    return f"{FLOW_CTE} SELECT " + unified_out(
        src_ip="src_ip",
        dst_ip="dst_ip",
        src_port="src_port",
        dst_port="dst_port",
        protocol=protocol_sql("protocol"),
        bytes="floor(bytes) + CASE WHEN event_id % 6 = 0 THEN 'inf'::DOUBLE WHEN event_id % 6 = 1 THEN 0 ELSE event_id % 100 END",
        packets="packets + event_id % 7",
        duration="(event_id * 250)::DOUBLE / 1000000",
        label=label,
        source_name=q(source),
        original_label_text="label",
    ) + " FROM flows"


def firewall_sql(source: str = fixed.FIREWALL_SOURCE) -> str:
    subtype = choose("event_id % 5", {0: "'Allowed'", 1: "'Denied'", 2: "''"}, "'allowed'")
    rule = choose("event_id % 11", {0: "'WAN-to-FW-Block'", 1: "''", 2: "'deny-all'"}, "'LAN-to-WAN'")
    message = "CASE WHEN event_id % 17 = 0 THEN 'invalid flags' ELSE '' END"
    zero_rule = "event_id % 13 IN (0, 1)"
    return f"{FLOW_CTE} SELECT " + unified_out(
        src_ip="src_ip",
        dst_ip="dst_ip",
        src_port="src_port",
        dst_port="CASE WHEN event_id % 19 = 0 THEN 65535 WHEN event_id % 19 = 1 THEN 2 ELSE dst_port END",
        protocol=protocol_sql("protocol"),
        packets="CASE WHEN event_id % 23 = 0 THEN 0 ELSE event_id % 9 END",
        label=f"lower({subtype}) <> 'allowed' OR regexp_matches(lower({rule}), 'block|deny|drop') OR {message} <> '' OR {zero_rule}",
        source_name=q(source),
        original_label_text=f"coalesce(nullif({subtype}, ''), nullif({rule}, ''), {message})",
    ) + " FROM flows"


def payload_sql(payload: str, label: str, cte: str, table: str, source: str = fixed.PAYLOAD_SOURCE, key: str = "event_id") -> str:
    text = f"trim({decode(payload)}, {WS})"
    return f"{cte} SELECT " + unified_out(
        protocol="'HTTP'",
        bytes=f"length({text})",
        packets="1",
        http_method="'GET'",
        uri=text,
        label=label,
        source_name=q(source),
        original_label_text=f"CAST({label} AS VARCHAR)",
    ).replace("event_id,", f"{key} AS event_id,", 1) + f" FROM {table}"


def generic_sql() -> str:
    return f"{FLOW_CTE} SELECT " + unified_out(
        src_ip="src_ip",
        dst_ip="dst_ip",
        src_port="src_port",
        dst_port="dst_port",
        protocol=protocol_sql("protocol"),
        bytes="bytes",
        packets="packets",
        duration="duration",
        http_method="upper(http_method)",
        uri=f"trim(uri, {WS})",
        label="CASE WHEN label = 'BENIGN' THEN 0 ELSE event_id % 400 END",
        source_name=q(fixed.INFERENCE_SOURCES["generic"]),
    ) + " FROM flows"


# --- event documents --------------------------------------------------------------------------


def _documents() -> str:
    fields = {
        "ts": "strftime(ts, '%Y-%m-%dT%H:%M:00Z')",
        "src": "src_ip",
        "dst": "dst_ip",
        "sport": "src_port::VARCHAR",
        "dport": "dst_port::VARCHAR",
        "proto": "trim(protocol)",
        "size": "floor(bytes)::BIGINT::VARCHAR",
        "n": "packets::BIGINT::VARCHAR",
        "nanos": "(event_id * 1000)::VARCHAR",
        "uri": choose("event_id % 12", texts(view.DOCUMENT_URIS), "''"),
        "long": q(view.LONG_TEXT),
    }
    source = choose(
        "event_id % 10", texts(dict(enumerate(view.DOCUMENT_LAYOUTS[:-1]))), q(view.DOCUMENT_LAYOUTS[-1])
    )
    for name, value in fields.items():
        source = f"replace({source}, '{{{name}}}', {value})"
    return f"""
docs AS (
  SELECT event_id, ts, 'idx-' || (event_id % 3) AS _index, event_id::VARCHAR AS _id, {source} AS _source,
    strftime(ts, '%Y-%m-%dT%H:%M:00Z') AS stamp FROM flows)"""


DOCS_CTE = f"{FLOW_CTE},{_documents()}"


def duck_paths(path: str) -> list[str]:
    parts = path.split(".")
    found = []
    for joins in product((False, True), repeat=len(parts) - 1):
        keys = [parts[0]]
        for part, joined in zip(parts[1:], joins):
            keys = [*keys[:-1], keys[-1] + "." + part] if joined else [*keys, part]
        found.append("$" + "".join(f'."{key}"' for key in keys))
    return found


def at(path: str) -> str:
    """Text at a dotted path in any spelling."""
    forms = []
    for form in duck_paths(path):
        kind = f"json_type(_source, {q(form)})"
        forms.append(
            f"CASE {kind} WHEN 'OBJECT' THEN NULL WHEN 'ARRAY' THEN json_extract_string(_source, {q(form + '[0]')}) "
            f"ELSE json_extract_string(_source, {q(form)}) END"
        )
    return f"coalesce({', '.join(forms)}, NULL)"


def column_of(path: str) -> str:
    return "p_" + path.replace(".", "_").replace("@", "")


def flat_cte(paths: dict[str, list[str]]) -> str:
    names = list(dict.fromkeys([p for group in paths.values() for p in group] + ["@timestamp"]))
    columns = ", ".join(f"{at(path)} AS {column_of(path)}" for path in names)
    # A path exists with any value but an object, JSON null included.
    kinds = " OR ".join(
        f"coalesce(json_type(_source, {q(form)}), 'OBJECT') <> 'OBJECT'" for form in duck_paths("network.bytes")
    )
    return f"{DOCS_CTE}, flat AS (SELECT *, {columns}, ({kinds}) AS has_total FROM docs)"


def first_of(paths: list[str], default: str | None = "''") -> str:
    values = ", ".join(f"nullif({column_of(path)}, '')" for path in paths)
    return f"coalesce({values}, {default})" if default else f"coalesce({values}, NULL)"


def as_double(text: str) -> str:
    return f"coalesce(try_cast(trim({text}) AS DOUBLE), 0)"


def as_whole(text: str) -> str:
    return f"coalesce(try_cast(trunc(try_cast(trim({text}) AS DOUBLE)) AS BIGINT), 0)"


def mapped_sql(paths: dict[str, list[str]], rules: str) -> dict[str, str]:
    """Mapper columns as SQL; ``rules`` is F, R or S."""

    def get(name: str) -> str:
        return first_of(paths[name])

    def two_way(unit: str) -> str:
        return f"({as_double(get('src_' + unit))} + {as_double(get('dst_' + unit))})"

    total_bytes, total_packets = as_double(get("total_bytes")), as_double(get("total_packets"))
    if rules == "S":
        size = f"CASE WHEN {total_bytes} > 0 THEN {total_bytes} WHEN {two_way('bytes')} > 0 THEN {two_way('bytes')} ELSE 0 END"
    else:
        given = f"({first_of(paths['any_total_bytes'], None)} IS NOT NULL AND has_total)"
        plain = as_double(column_of("network.bytes"))
        size = f"CASE WHEN {given} THEN {plain} WHEN {two_way('bytes')} > 0 THEN {two_way('bytes')} ELSE {total_bytes} END"
    packets = (
        f"CASE WHEN {total_packets} > 0 THEN {total_packets} WHEN {two_way('packets')} > 0 THEN {two_way('packets')} ELSE 1 END"
    )
    duration = as_double(get("duration"))
    duration = f"CASE WHEN {duration} > 1000000 THEN {duration} / 1e9 ELSE {duration} END"
    path, query = f"trim({get('path')})", f"trim({get('query')})"
    full = f"CASE WHEN {path} <> '' AND {query} <> '' THEN {path} || '?' || {query} WHEN {path} <> '' THEN {path} END"
    original = f"nullif(trim({get('original_uri')}), '')"
    is_http = f"starts_with(lower(trim({get('app_protocol')})), 'http')"
    if rules == "S":
        uri = f"coalesce({original}, {full}, CASE WHEN {is_http} THEN trim({get('signature')}) ELSE '' END)"
    else:
        uri = f"coalesce({original}, {full}, trim({get('request_line')}))"
        if rules == "R":
            uri = f"coalesce(nullif({uri}, ''), CASE WHEN {is_http} THEN trim({get('fallback_uri')}) ELSE '' END)"
    protocol = f"upper({get('protocol')})"
    if rules == "R":
        protocol = f"coalesce(nullif({protocol}, ''), upper({get('fallback_protocol')}))"
    columns = {
        "src_ip": get("src_ip"),
        "dst_ip": get("dst_ip"),
        "src_port": as_whole(get("src_port")),
        "dst_port": as_whole(get("dst_port")),
        "protocol": protocol,
        "bytes": size,
        "packets": packets,
        "duration": duration,
        "http_method": f"upper({get('method')})",
        "uri": uri,
        "event_timestamp": f"coalesce({column_of('@timestamp')}, '')",
        "source_type": q(fixed.FIREWALL_EVENTS if rules == "F" else fixed.IDS_EVENTS),
        "source_index": "_index",
        "source_id": "_id",
    }
    if rules == "S":
        columns |= {
            "signature": get("signature"),
            "severity": as_whole(get("severity")),
            "category": get("category"),
            "action": first_of(paths["action"], "'alert'"),
            "message": get("message"),
        }
    else:
        columns |= {
            "action": get("action"),
            "reason": get("reason"),
            "rule_name": get("rule"),
            "severity": as_whole(get("severity")) if rules == "R" else "0::BIGINT",
        }
    return columns


MAPPER_PATHS = {"F": mappers.FIREWALL_PATHS, "R": mappers.IDS_PATHS, "S": mappers.SINGLE_IDS_PATHS}
MAPPED_DOUBLES = ("bytes", "packets", "duration")


def mapped_cte(rules: str) -> str:
    paths = MAPPER_PATHS[rules]
    columns = ", ".join(
        f"CAST({sql} AS DOUBLE) AS {name}" if name in MAPPED_DOUBLES else f"{sql} AS {name}"
        for name, sql in mapped_sql(paths, rules).items()
    )
    return f"{flat_cte(paths)}, mapped AS (SELECT event_id, {columns} FROM flat)"


def mapper_query(rules: str, names: list[str] | None = None) -> str:
    names = names or list(mapped_sql(MAPPER_PATHS[rules], rules))
    return f"{mapped_cte(rules)} SELECT event_id, {', '.join(names)} FROM mapped"


# --- scoring ----------------------------------------------------------------------------------


def suspicious_sql(uri: str) -> str:
    names = ["SQL_KEYWORD", "SQL_TAUTOLOGY", "SQL_COMMENT", "SQL_ENCODED_META", "XSS_KEYWORD", "XSS_EVENT_HANDLER"]
    tests = " OR ".join(f"regexp_matches({uri}, {q('(?i)' + getattr(literal, n + '_PATTERN'))})" for n in names)
    return f"({tests})"


def rule_probability(text: str, dst_port: str) -> str:
    count = text_sql(text)
    score = score_sql(count)
    special = f"CAST(CAST({count['uri_special_char_ratio']} AS FLOAT) AS DOUBLE)"
    total = (
        f"({score['sql_attack_score']}) + ({score['xss_attack_score']}) "
        f"+ 0.5::DOUBLE * CAST({dst_port} < 1024 AS INT) + 0.25::DOUBLE * {special}"
    )
    return f"(SELECT s / (s + 4) FROM (SELECT {total} AS s))"


def scored_cte(cte: str, table: str, keep: str) -> str:
    """``scored``: keep, probability, web_probability of a table with uri and dst_port."""
    return f"""{cte},
views AS (SELECT *, trim(uri, {WS}) AS raw_uri FROM {table}),
texts AS (SELECT *, {decode('raw_uri')} AS text, trim({decode('raw_uri')}, {WS}) AS web_uri, {suspicious_sql('raw_uri')} AS has_web FROM views),
webs AS (SELECT *, {decode('web_uri')} AS web_text FROM texts),
scored AS (SELECT {keep}, {rule_probability('text', 'dst_port')} AS probability,
  CASE WHEN has_web THEN {rule_probability('web_text', '0')} END AS web_probability FROM webs),
chosen AS (SELECT *, CASE WHEN web_probability > probability THEN web_probability ELSE probability END AS malicious_probability,
  CASE WHEN web_probability > probability THEN 'web_payload' ELSE 'primary' END AS selected_view FROM scored),
decided AS (SELECT *, CAST(malicious_probability >= 0.5 AS INT) AS prediction FROM chosen),
predicted AS (SELECT *, {risk_sql('malicious_probability')} AS risk_level FROM decided)"""


def risk_sql(p: str) -> str:
    return f"CASE WHEN {p} >= 0.85 THEN 'high' WHEN {p} >= 0.5 THEN 'medium' WHEN {p} >= 0.2 THEN 'low' ELSE 'benign' END"


SCORED_CTE = scored_cte(UNIFIED_CTE, "unified", "event_id, label")


def scored_events_cte(rules: str) -> str:
    names = ", ".join(["event_id", *mapped_sql(MAPPER_PATHS[rules], rules)])
    return scored_cte(mapped_cte(rules), "mapped", names)


def escape_sql(text: str) -> str:
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        text = f"replace({text}, {q(plain)}, {q(entity)})"
    return text


def cut_sql(text: str, limit: int = fixed.NOTICE_TEXT_LENGTH) -> str:
    clean = f"trim({text}, {WS})"
    return f"CASE WHEN length({clean}) > {limit} THEN substr({clean}, 1, {limit - 3}) || '...' ELSE {clean} END"


def line(label: str, text: str) -> str:
    return f"'{label}: <code>' || {escape_sql(text)} || '</code>'"


def optional_line(label: str, text: str, shorten: bool = True) -> str:
    shown = f"({cut_sql(text)})" if shorten else text
    return f"CASE WHEN {shown} <> '' THEN {line(label, shown)} END"


def core_lines() -> list[str]:
    return [
        f"'Risk: <b>' || upper(risk_level) || '</b>'",
        "'Score: <code>' || printf('%.4f', malicious_probability) || '</code>'",
        f"'Path: <code>' || {escape_sql('(src_ip || chr(58) || src_port)')} || '</code> -> <code>' || {escape_sql('(dst_ip || chr(58) || dst_port)')} || '</code>'",
        line("Protocol", "protocol"),
    ]


REF_LINE = f"'Ref: <code>' || {escape_sql('source_index')} || '</code> / <code>' || {escape_sql('source_id')} || '</code>'"


def notice_sql() -> str:
    lines = [
        f"'<b>{fixed.FLOW_NOTICE_TITLE}</b>'",
        line("Time", "event_timestamp"),
        line("Source", "source_type"),
        *core_lines(),
        optional_line("Method", "http_method", shorten=False),
        optional_line("URI", "uri"),
        optional_line("Rule", "rule_name"),
        optional_line("Reason", "reason"),
        REF_LINE,
    ]
    return f"concat_ws(chr(10), {', '.join(lines)})"


def ids_notice_sql(reason: str) -> str:
    lines = [
        f"'<b>{fixed.IDS_NOTICE_TITLE}</b>'",
        line("Time", "event_timestamp"),
        line("Reason", reason),
        *core_lines(),
        optional_line("Signature", "signature"),
        optional_line("Category", "category"),
        optional_line("URI", "uri"),
        REF_LINE,
    ]
    return f"concat_ws(chr(10), {', '.join(lines)})"
