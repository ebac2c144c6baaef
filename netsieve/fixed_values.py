"""Fixed values.

Names, word lists, patterns and defaults that results depend on. They are part of the data
contract, so they are stated here once, as plain text.
"""

# --- unified record -------------------------------------------------------------------------

RECORD_COLUMNS = [
    "src_ip", "dst_ip", "src_port", "dst_port", "protocol", "bytes", "packets", "duration",
    "http_method", "uri", "label",
]
PROVENANCE_COLUMNS = ["source_name", "original_label_text"]
UNIFIED_COLUMNS = RECORD_COLUMNS + PROVENANCE_COLUMNS
NETWORK_FIELDS = RECORD_COLUMNS[:-1]
TEXT_COLUMNS = ["src_ip", "dst_ip", "protocol", "http_method", "uri"]

# Accepted names of each unified column in a table of unknown origin, first match wins.
GENERIC_ALIASES = {
    "src_ip": ["srcip", "sourceip", "source_ip", "src_ip"],
    "dst_ip": ["dstip", "destinationip", "destination_ip", "dst_ip"],
    "src_port": ["srcport", "sourceport", "source_port", "sport", "src_port"],
    "dst_port": ["dstport", "destinationport", "destination_port", "dsport", "dst_port"],
    "protocol": ["protocol", "proto", "protocoltype"],
    "bytes": ["bytes", "bytecount", "totalbytes", "flowbytes"],
    "packets": ["packets", "packetcount", "totalpackets", "flowpackets"],
    "duration": ["duration", "dur", "flowduration"],
    "http_method": ["httpmethod", "method", "http_method"],
    "uri": ["uri", "path", "request", "payload", "query", "url", "requesturi"],
    "label": ["label", "attackcat", "attack_cat", "class"],
}

# Values of source_name.
FLOW_PARQUET_SOURCE = "UNSW_NB15"
FLOW_CSV_SOURCE = "CIC_IDS_2017"
FIREWALL_SOURCE = "FIREWALL"
PAYLOAD_SOURCE = "MODSEC_LEARN"
INFERENCE_SOURCES = {
    "unsw": "INFERENCE_UNSW",
    "cic": "INFERENCE_CIC",
    "firewall": "INFERENCE_FIREWALL",
    "modsec": "INFERENCE_MODSEC",
    "generic": "INFERENCE_GENERIC",
}

# Payload files preferred over any other file below the payload root.
PREFERRED_PAYLOAD_FILES = ["legitimate/legitimate_dataset.json", "malicious/sqli_dataset.json"]

# Words of a text label. A malicious word wins over a benign one.
BENIGN_WORDS = ["benign", "normal", "legitimate", "allow", "allowed", "clean", "successful"]
MALICIOUS_WORDS = [
    "attack", "malicious", "sqli", "sql injection", "xss", "brute", "dos", "ddos", "portscan",
    "scan", "bot", "infiltration", "exploit", "fuzzer", "reconnaissance", "backdoor", "shellcode",
    "worm", "generic", "deny", "denied", "blocked", "anomaly", "abnormal",
]
BLOCKING_RULE_PATTERN = r"block|deny|drop"

# Text cells a CSV file uses for "no value".
CSV_NULL_WORDS = [
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# --- attack patterns on URIs (case is ignored) ----------------------------------------------

SQL_KEYWORD_PATTERN = (
    r"\b(select|union(?:\s+all)?|insert|update|delete|drop|sleep|benchmark|waitfor|exec(?:ute)?|"
    r"declare|cast|convert|having|order\s+by|group\s+by|information_schema|load_file|outfile|"
    r"xp_cmdshell|dbms_[a-z_]+|pg_sleep|ascii\(|substring\(|concat\(|char\(|chr\(|hex\(|unhex\(|"
    r"database\(|schema\(|table_name|column_name)"
)
SQL_TAUTOLOGY_PATTERN = (
    r"(?:\b(?:or|and|xor)\b\s+['\"`\(]*[a-z0-9_]+['\"`]*\s*=\s*['\"`]*[a-z0-9_]+['\"`]*)"
)
SQL_COMMENT_PATTERN = r"(--|#|/\*|\*/|;)"
SQL_ENCODED_META_PATTERN = r"(%27|%22|%23|%2d%2d|%3b|%2f\*|\*/|%3d|%28|%29)"
XSS_KEYWORD_PATTERN = (
    r"(<script|</script|javascript:|vbscript:|data:text/html|alert\(|document\.cookie|"
    r"window\.location|<img|<svg|<iframe|<body)"
)
XSS_EVENT_HANDLER_PATTERN = r"(on[a-z]+\s*=)"
XSS_SCRIPT_TAG_PATTERN = r"(<script|</script|%3cscript|%3c/script)"
PERCENT_ENCODING_PATTERN = r"%[0-9a-fA-F]{2}"
PLAIN_URI_CHARACTERS = r"[A-Za-z0-9/_\-.]+"
PRIVATE_IP_PATTERN = r"^(10\.|127\.|192\.168\.|172\.(1[6-9]|2[0-9]|3[0-1])\.)"

WEB_PORTS = [80, 443, 8080, 8443]

# --- features, in model order ---------------------------------------------------------------

FEATURE_NAMES = [
    "src_port", "dst_port", "bytes", "packets", "duration", "packets_per_flow", "bytes_per_flow",
    "packet_byte_ratio", "bytes_per_second", "packets_per_second", "duration_per_packet",
    "protocol_encoded", "protocol_frequency", "http_method_encoded", "http_method_frequency",
    "uri_length", "uri_path_depth", "uri_query_param_count", "uri_equals_count",
    "uri_quote_count", "uri_angle_bracket_count", "uri_has_query_string",
    "uri_has_percent_encoding", "uri_sql_keyword_hits", "uri_sql_tautology_hits",
    "uri_sql_comment_hits", "uri_sql_encoded_meta_hits", "uri_xss_keyword_hits",
    "uri_xss_event_handler_hits", "uri_xss_script_tag_hits", "uri_special_char_ratio",
    "sql_attack_score", "xss_attack_score", "http_like_request", "protocol_is_http",
    "unique_dst_ports_per_source", "repeated_access_count", "src_ip_frequency",
    "dst_ip_frequency", "src_dst_pair_frequency", "endpoint_frequency", "src_ip_is_private",
    "dst_ip_is_private", "src_port_is_system", "dst_port_is_system", "dst_port_is_web",
    "payload_present",
]

# --- training defaults ----------------------------------------------------------------------

SEED = 42
TEST_SIZE = 0.15
VALIDATION_SIZE = 0.15
SELECTION_ROWS = 250_000
BOOSTED_TREES = {"rounds": 400, "depth": 10, "rate": 0.03, "row_share": 0.8, "column_share": 0.8}
RANDOM_FOREST = {"trees": 300, "depth": 18, "min_leaf": 2}

# --- scoring and alerting -------------------------------------------------------------------

DECISION_THRESHOLD = 0.5
RISK_LEVELS = [(0.85, "high"), (0.5, "medium"), (0.2, "low")]
LOWEST_RISK = "benign"
PRIMARY_VIEW = "primary"
WEB_VIEW = "web_payload"
MODEL_FAMILY = "xgboost_or_random_forest_runtime"

FIREWALL_EVENTS = "pfelkfw"
IDS_EVENTS = "ids_to_elk"
FIREWALL_PAGE_SIZE = 200
IDS_PAGE_SIZE = 100

ALERT_MODES = ("suricata_or_ml", "suricata_only", "ml_only")
FLOW_NOTICE_TITLE = "Cyber Alert"
FLOW_NOTICE_MINIMUM = 0.80
IDS_NOTICE_TITLE = "IDS Alert"
IDS_NOTICE_MINIMUM = 0.50
NOTICE_TEXT_LENGTH = 180
