"""Telemetry-shaped views of the driver tables, each as Spark expressions.

``events`` rows become flow records, source-shaped raw rows, or nested event documents. All views are
narrow projections of one scan.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.reuse import built_once
from ..operators.unify import unify_records

# Request texts by event_id % 12; the other slots are blank.
ITEM_SLOT = 5
URI_SLOTS = {
    0: "q=9;WAITFOR DELAY char(3)",
    1: "/cart?sort=price&dir=up",
    2: "/img/a-1.png",
    3: "go=javascript:f()&u=data:text/html,x",
    4: "/p?z=1 AND pg_sleep(2)=2 xor `k`=`k` GROUP BY 1",
    6: "/x?q=%2527%2520or%25201%253D1;drop table t/*c*/",
    7: " /a+b?c=<img src=x onerror=alert(1)>&d=`e` ",
}
# The texts above hold no script tag. Those of the query that counts the tags do.
SCRIPT_TAG_SLOTS = URI_SLOTS | {
    0: "/selected/updates/dropbox",
    1: "/reports/2031/summary.html",
    2: "/door?key=x' OR 'b'='b' -- ",
    3: "/note?t=%3Cscript%3Ewindow.location=%22/%22%3C/script%3E",
    4: "row=4%20UNION%20ALL%20SELECT%20char('a'),database()#",
}
PROTOCOLS = {"click": "tcp", "view": "HTTP", "purchase": "udp", "signup": " - ", "error": "icmp"}
METHODS = {"view": "get", "purchase": "post"}
PORTS = [80, 443, 22, 53, 8080, 3389, 445]
SOURCES = ["UNSW_NB15", "CIC_IDS_2017", "MODSEC_LEARN", "FIREWALL"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _choose(selector: Column, options: dict, default: object) -> Column:
    chosen = None
    for key, value in options.items():
        chosen = F.when(selector == key, F.lit(value)) if chosen is None else chosen.when(selector == key, F.lit(value))
    return chosen.otherwise(default if isinstance(default, Column) else F.lit(default))


@built_once
def _flow_columns(slots: tuple[tuple[int, str], ...]) -> list[Column]:
    event, user = F.col("event_id"), F.col("user_id")
    k = F.get_json_object("props", "$.k").cast("int")
    octet = (user % 256).cast("string")
    item = F.concat(F.lit("/items/"), (event % 499).cast("string"), F.lit("?page="), k.cast("string"), F.lit("&sort=asc"))
    slot = event % 12
    return [
        F.col("event_id"),
        F.col("ts"),
        F.when(user % 11 == 0, F.lit(""))
        .when(user % 3 == 0, F.concat(F.lit("203.0.113."), octet))
        .otherwise(F.concat(F.lit("10.0.0."), octet))
        .alias("src_ip"),
        F.when(k % 13 == 0, F.lit(""))
        .otherwise(F.concat(F.lit("192.168."), (k % 4).cast("string"), F.lit("."), (k % 32).cast("string")))
        .alias("dst_ip"),
        (1024 + (event * 7919) % 64000).cast("int").alias("src_port"),
        _choose(event % 7, dict(enumerate(PORTS[:-1])), PORTS[-1]).alias("dst_port"),
        _choose(F.col("event_type"), PROTOCOLS, "").alias("protocol"),
        (F.col("value") * 100).alias("bytes"),
        F.floor("value").cast("double").alias("packets"),
        (F.col("value") / 100).alias("duration"),
        _choose(F.col("event_type"), METHODS, "").alias("http_method"),
        F.when(slot == ITEM_SLOT, item).otherwise(_choose(slot, dict(slots), "")).alias("uri"),
        F.when(F.col("event_type") != "error", F.lit("BENIGN"))
        .when(event % 2 == 0, F.lit("DDoS"))
        .otherwise(F.lit("PortScan"))
        .alias("label"),
        _choose(event % 4, dict(enumerate(SOURCES[:-1])), SOURCES[-1]).alias("source_name"),
    ]


def flows(events: DataFrame, slots: dict[int, str] = URI_SLOTS) -> DataFrame:
    """Flow records with raw text fields: the input of every normaliser test."""
    return events.select(*_flow_columns(tuple(slots.items())))


def flow_view(spark: SparkSession, folder: str, slots: dict[int, str] = URI_SLOTS) -> DataFrame:
    return flows(table(spark, folder, "events"), slots)


def unified_view(spark: SparkSession, folder: str, label_mode: str = "keywords", slots: dict[int, str] = URI_SLOTS) -> DataFrame:
    """The flow view as unified records, keyed by ``event_id``."""
    return unify_records(
        flow_view(spark, folder, slots), F.col("source_name"), label_mode, original_label="label", keep=["event_id"]
    )


def flow_table_view(raw: DataFrame) -> DataFrame:
    """The flow view in the columns of a two-way flow table."""
    text = F.col("event_id") % 3 == 0
    return raw.select(
        "event_id",
        F.col("protocol").alias("proto"),
        F.floor("bytes").cast("long").alias("sbytes"),
        (F.col("event_id") % 1000).alias("dbytes"),
        F.col("packets").cast("long").alias("spkts"),
        (F.col("event_id") % 5).alias("dpkts"),
        F.col("duration").alias("dur"),
        (F.col("http_method") != "").cast("int").alias("ct_flw_http_mthd"),
        (F.col("label") != "BENIGN").cast("int").alias("label"),
        F.when(text, F.lit(" Normal ")).otherwise(F.col("label")).alias("attack_cat"),
    )


def flow_csv_view(raw: DataFrame) -> DataFrame:
    """The flow view in the text columns of a flow-statistics CSV."""
    event = F.col("event_id")
    return raw.select(
        "event_id",
        F.col("src_ip").alias(" Source IP"),
        F.col("src_port").cast("string").alias(" Source Port"),
        F.col("dst_ip").alias(" Destination IP"),
        F.col("dst_port").cast("string").alias(" Destination Port"),
        F.col("protocol").alias(" Protocol"),
        F.floor("bytes").cast("string").alias("Total Length of Fwd Packets"),
        F.when(event % 6 == 0, F.lit("Infinity")).when(event % 6 == 1, F.lit("1d")).otherwise((event % 100).cast("string"))
        .alias(" Total Length of Bwd Packets"),
        F.col("packets").cast("long").cast("string").alias(" Total Fwd Packets"),
        (event % 7).cast("string").alias(" Total Backward Packets"),
        (event * 250).cast("string").alias(" Flow Duration"),
        F.col("label").alias(" Label"),
    )


def firewall_view(raw: DataFrame) -> DataFrame:
    """The flow view in the columns of a firewall log."""
    event = F.col("event_id")
    return raw.select(
        "event_id",
        _choose(event % 5, {0: " Allowed ", 1: "Denied", 2: ""}, "allowed").alias("Log subtype"),
        _choose(event % 11, {0: "WAN-to-FW-Block", 1: "", 2: "deny-all"}, "LAN-to-WAN").alias("Firewall rule name"),
        _choose(event % 13, {0: "0", 1: "n/a"}, "1").alias("Rule type"),
        _choose(event % 17, {0: "invalid flags"}, "  ").alias("Message"),
        F.col("src_ip").alias("Src IP"),
        F.col("dst_ip").alias("Dst IP"),
        F.col("src_port").alias("Src port"),
        F.when(event % 19 == 0, F.lit("70000")).when(event % 19 == 1, F.lit("2.5")).otherwise(F.col("dst_port").cast("string"))
        .alias("Dst port"),
        F.col("protocol").alias("protocol"),
        F.when(event % 23 == 0, F.lit(None).cast("int")).otherwise((event % 9).cast("int")).alias("Log occurrence"),
    )


def payload_view(raw: DataFrame) -> DataFrame:
    return raw.select("event_id", F.col("uri").alias("payload"), (F.col("label") != "BENIGN").cast("int").alias("label"))


def generic_view(raw: DataFrame) -> DataFrame:
    """The flow view under other column names, with labels beyond 0 and 1."""
    return raw.select(
        "event_id",
        F.col("src_ip").alias("Source IP"),
        F.col("dst_ip").alias("destination_ip"),
        F.col("src_port").alias("sport"),
        F.col("dst_port").cast("string").alias("dsport"),
        F.col("protocol").alias("Proto"),
        F.col("bytes").cast("string").alias("Byte Count"),
        F.col("packets").alias("total packets"),
        F.col("duration").alias("dur"),
        F.col("http_method").alias("Method"),
        F.col("uri").alias("Request URI"),
        F.when(F.col("label") == "BENIGN", F.lit("0")).otherwise((F.col("event_id") % 400).cast("string")).alias("class"),
    )


# --- nested event documents -----------------------------------------------------------------

# Ten document layouts by event_id % 10. Names in braces are filled from the flow record; {size} and
# {n} are whole numbers. Together they cover nested and dotted keys, lists, null, empty text, zero
# totals, both duration units and missing counts.
DOCUMENT_LAYOUTS = [
    '{"@timestamp":"{ts}","event":{"module":"suricata","kind":"alert","severity":2,"duration":{nanos}},'
    '"source":{"ip":"{src}","port":{sport},"bytes":{size},"packets":{n}},"destination":{"ip":"{dst}","port":{dport},"bytes":7},'
    '"network":{"transport":"{proto}","bytes":0},"url":{"original":"{uri}"},"rule":{"name":"ET SCAN {n}"},"message":"m{n}"}',
    '{"@timestamp":"{ts}","event.module":"suricata","event.kind":"alert","source.ip":"{src}","source.port":"{sport}",'
    '"destination.ip":"{dst}","destination.port":"{dport}","network.protocol":"{proto}","network.bytes":{size},'
    '"network.packets":{n},"url.path":"/p","url.query":"q={n}","http.request.method":"get","event.action":"allowed"}',
    '{"@timestamp":"{ts}","event":{"module":"pf","kind":"event","action":["block","log"],"reason":"match {n}"},'
    '"source":{"ip":["{src}","10.9.9.9"],"port":[{sport}]},"destination":{"ip":["{dst}"],"port":{dport}},'
    '"network":{"protocol":null,"transport":"{proto}","packets":{n}},"firewall":{"rule":{"name":"wan-block"}},"event.duration":0.74}',
    '{"@timestamp":"{ts}","src_ip":"{src}","dst_ip":"{dst}","src_port":{sport},"dst_port":{dport},"protocol":"{proto}",'
    '"flow":{"bytes_toserver":{size}},"network":{"bytes":""},"source":{"bytes":3},"destination":{"bytes":4},"event":{"reason":""},"message":"pass {n}"}',
    '{"@timestamp":"{ts}","event":{"module":"suricata","kind":"alert"},"suricata":{"eve":{"proto":"{proto}","app_proto":"http2",'
    '"alert":{"signature":"SIG <{n}> & co","severity":"3","category":"Web \\"Attack\\""},"flow":{"age":{n},"bytes_toserver":{size},"bytes_toclient":5,'
    '"pkts_toserver":2,"pkts_toclient":{n}}}},"source":{"address":"{src}"},"destination":{"address":"{dst}"}}',
    '{"@timestamp":"{ts}","event":{"module":"suricata","kind":"alert"},"suricata":{"eve.proto":"{proto}","eve":{"http":{"url":"/s?x={n}",'
    '"http_method":"post","hostname":"h.example","http_user_agent":"ua"},"flow":{"start":"2024-01-01T00:00:00"}}},'
    '"source.ip":"{src}","destination":{"ip":"{dst}"},"network":{"bytes":{size}},"event.severity":"x"}',
    '{"@timestamp":"{ts}","event":{"module":"suricata","kind":"stats"},"source":{"ip":{"v4":"{src}"},"address":"{src}"},'
    '"destination":{"ip":"","address":"{dst}"},"http":{"request":{"line":"GET /line{n}","body":{"content":"{\\"a\\":{n}}"}}},"network":{"application":"HTTP"},"rule":{"category":"cat {n}"}}',
    '{"@timestamp":"{ts}","event":{"module":"suricata","kind":"alert"},"network":{"application":"tls","packets":0},"source":{"packets":{n}},'
    '"suricata":{"eve":{"alert":{"signature":"no uri {n}"},"http":{"hostname":"only-host.example"}}},"source.port":"{sport}.9","destination":{"port":"bad"}}',
    '{"@timestamp":"{ts}","event":{"module":["suricata"],"kind":"alert","duration":2000000},"url":{"path":"","query":"lost"},'
    '"http":{"request":{"referrer":" http://r.example/{n} ","method":["put"]}},"source":{"ip":"{src}","bytes":{size}},"request":{"method":"head"}}',
    '{"event":{"module":"suricata","kind":"alert","severity":4.7},"@timestamp":"{ts}","source":{"ip":"{src}"},"destination":{"ip":"{dst}","port":{dport}},'
    '"network":{"protocol":"{proto}","bytes":null},"rule.name":"{long}","message":"{long}","url.original":"{uri}"}',
]
LONG_TEXT = "a rule text with <angles> & 'quotes' that goes on " * 5
DOCUMENT_URIS = {
    0: "/about",
    2: "/find?c=1;drop table_name having hex(1)=2 union all select cast(a) and 3=3--",
    3: "/a?b=vbscript:x&c=<iframe onfocus=1>",
    7: " /b+c?d=<svg onload=e> ",
}


def documents(raw: DataFrame) -> DataFrame:
    """The flow view as event hits: key columns and ``_index``, ``_id``, ``_source``."""
    event = F.col("event_id")
    # The timestamp keeps whole seconds, so that several events share one.
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:00'Z'")
    fields = {
        "ts": stamp,
        "src": F.col("src_ip"),
        "dst": F.col("dst_ip"),
        "sport": F.col("src_port").cast("string"),
        "dport": F.col("dst_port").cast("string"),
        "proto": F.trim("protocol"),
        "size": F.floor("bytes").cast("string"),
        "n": F.col("packets").cast("long").cast("string"),
        "nanos": (event * 1000).cast("string"),
        "uri": _choose(event % 12, DOCUMENT_URIS, ""),
        "long": F.lit(LONG_TEXT),
    }

    def filled(layout: str) -> Column:
        pieces = re.split(r"\{(" + "|".join(fields) + r")\}", layout)
        return F.concat(*[F.col(f"_{piece}") if n % 2 else F.lit(piece) for n, piece in enumerate(pieces) if piece])

    # A record that lacks any of the values has no document, whichever its layout shows.
    whole = F.lit(True)
    for name in fields:
        whole = whole & F.col(f"_{name}").isNotNull()
    layouts = [filled(layout) for layout in DOCUMENT_LAYOUTS]
    document = F.when(event % 10 == 0, layouts[0])
    for slot, layout in enumerate(layouts[1:-1], start=1):
        document = document.when(event % 10 == slot, layout)
    layout = F.when(whole, document.otherwise(layouts[-1]))
    return raw.select("event_id", "ts", *[value.alias(f"_{name}") for name, value in fields.items()]).select(
        "event_id",
        "ts",
        F.concat(F.lit("idx-"), (event % 3).cast("string")).alias("_index"),
        event.cast("string").alias("_id"),
        layout.alias("_source"),
    )


def document_view(spark: SparkSession, folder: str) -> DataFrame:
    return documents(flow_view(spark, folder))
