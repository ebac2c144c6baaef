import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from netsieve.functions.documents import flatten_document, leaf, plain_texts, repeated_keys_allowed, to_int
from netsieve.operators import events
from netsieve.operators.records import primary_view

CASES = {
    '{"a":{"b":["x","y"]}}': "x", '{"a.b":5}': "5", '{"a":{"b":{"c":1}}}': None, '{"a":{"b":null}}': None,
    '{"a":{"b":[]}}': None, '{"a":{"b":""}}': "", "{}": None, '{"a":{"b":"{\\"q\\":1}"}}': '{"q":1}',
    '{"a":{"b":"[x]"}}': "[x]", '{"a":{"b":0.5}}': "0.5", '{"a":3,"a.b":"lit"}': "lit", "not json": None, "[1]": None,
    '{"a":{"b":"first"},"a.b":"second"}': "second", '{"a.b":"first","a":{"b":"second"}}': "second",
    '{"a.b":{"c":1},"a":{"b":7}}': "7", '{"a":{"b":1},"a":{"b":2}}': "2", '{"x":1,"x":2,"a.b":3}': "3",
}


def test_leaf(spark):
    frame = repeated_keys_allowed(spark.createDataFrame([(j,) for j in CASES], "j string"))
    assert {r.j: r.v for r in frame.select("j", leaf(F.col("j"), "a.b").alias("v")).collect()} == CASES


PATHS = ["a", "a.b", "a.b.c", "a.c", "b.a", "b.a.c.d"]
values = st.one_of(st.none(), st.integers(-5, 5), st.text("xy", max_size=2), st.lists(st.integers(0, 3), max_size=2))
names = st.sampled_from(["a", "b", "c", "d", "a.b", "b.c", "a.c"])
objects = st.recursive(values, lambda inner: st.dictionaries(names, inner, max_size=3), max_leaves=6)
documents = st.dictionaries(names, objects, max_size=4)


def flat(document, paths=PATHS):
    found = {}

    def walk(at, value):
        if isinstance(value, dict):
            for key, inner in value.items():
                walk((*at, key), inner)
        else:
            first = (value[0] if value else None) if isinstance(value, list) else value
            found[".".join(at)] = None if first is None else str(first)

    walk((), document)
    return {p: found[p] for p in paths if p in found}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(documents, min_size=20, max_size=60))
def test_flattening_equals_a_plain_walk(spark, docs):
    frame = spark.createDataFrame([(n, json.dumps(d)) for n, d in enumerate(docs)], "n int, j string")
    rows = frame.select("n", flatten_document(F.col("j"), PATHS).alias("pairs")).collect()
    for row in rows:
        assert {p.path: p.text for p in row.pairs} == flat(docs[row.n])


LEAF_PATHS = ["a.b.c", "a.c", "b.a", "d", "c.a.b.d"]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(documents, min_size=40, max_size=80))
def test_one_pass_equals_a_plain_walk(spark, docs):
    frame = spark.createDataFrame([(n, json.dumps(d)) for n, d in enumerate(docs)], "n int, j string")
    rows = frame.select("n", flatten_document(F.col("j"), LEAF_PATHS).alias("pairs")).collect()
    for row in rows:
        whole = flat(docs[row.n], LEAF_PATHS)
        assert {p.path: p.text for p in row.pairs} == whole


def one(spark, mapper, source):
    frame = spark.createDataFrame([("i", "1", json.dumps(source))], "_index string, _id string, _source string")
    return mapper(frame).first()


def test_byte_rules_differ(spark):
    source = {"network": {"bytes": 0}, "source": {"bytes": 10}, "destination.bytes": 5}
    assert one(spark, events.map_firewall_events, source).bytes == 0.0
    assert one(spark, events.map_single_ids_events, source).bytes == 15.0
    null_total = {"network": {"bytes": None}, "flow": {"bytes_toserver": 9}, "source": {"bytes": 10}}
    assert one(spark, events.map_ids_events, null_total).bytes == 0.0
    no_total = {"flow": {"bytes_toserver": 9}, "source": {"bytes": 10}}
    assert one(spark, events.map_ids_events, no_total).bytes == 10.0


def test_durations_and_packets(spark):
    row = one(spark, events.map_firewall_events, {"event": {"duration": 2_000_000}})
    assert (row.duration, row.packets) == (0.002, 1.0)
    assert one(spark, events.map_firewall_events, {"event.duration": 0.74}).duration == 0.74
    start = {"suricata": {"eve": {"flow": {"start": "2024-01-01"}}}}
    assert one(spark, events.map_ids_events, start).duration == 0.0


def test_true_is_one_and_its_text_is_no_number(spark):
    row = one(spark, events.map_ids_events, {"source": {"port": True, "bytes": [True]}, "destination.port": True, "event": {"severity": "true"}})
    assert (row.src_port, row.dst_port, row.bytes, row.severity) == (1, 1, 1.0, 0)
    assert one(spark, events.map_ids_events, {"network": {"bytes": True, "packets": False}}).bytes == 1.0
    assert one(spark, events.map_firewall_events, {"source": {"port": "true"}}).src_port == 0


def test_keys_with_a_dot_are_found_however_they_are_written(spark):
    cases = {r'{"a\u002eb":1}': "1", '{"a.b" : 2}': "2", '{"a":{"b":"x.y\\":z"}}': 'x.y":z', '{"a":{"b":"1.5"}}': "1.5", '{"é.":0,"a":{"b":3}}': "3"}
    frame = spark.createDataFrame([(j,) for j in cases], "j string")
    assert {r.j: r.v for r in frame.select("j", leaf(F.col("j"), "a.b").alias("v")).collect()} == cases


def test_uri_rules_differ(spark):
    source = {"rule": {"name": "SIG"}, "network": {"application": "HTTP"}, "message": "m"}
    assert one(spark, events.map_firewall_events, source).uri == ""
    assert one(spark, events.map_ids_events, source).uri == "SIG"
    assert one(spark, events.map_single_ids_events, source).uri == "SIG"
    host = {"suricata": {"eve": {"http": {"hostname": "h"}}}, "url": {"query": "q=1"}}
    assert one(spark, events.map_ids_events, host).uri == "h?q=1"
    assert one(spark, events.map_single_ids_events, host).uri == ""


def test_large_ports_stay_in_the_record_and_are_scored_within_range(spark):
    row = one(spark, events.map_firewall_events, {"source": {"port": 99999999999}, "destination.port": -5})
    assert (row.src_port, row.dst_port) == (99999999999, -5)
    frame = spark.createDataFrame([(99999999999, -5)], "src_port long, dst_port long")
    view = primary_view()
    assert tuple(frame.select(view["src_port"], view["dst_port"]).first()) == (65535, 0)
    texts = spark.createDataFrame([("7.9",), ("-7.9",), ("x",), (None,), ("1e30",)], "t string")
    assert [r[0] for r in texts.select(to_int(F.col("t"))).collect()] == [7, -7, 0, 0, 0]


ODD = [
    *CASES, "", "[]", "null", "7", '"a.b"', '{"a":{"b":1}} tail', '{"a":{"b":01}}', '{"a":{"b":NaN}}', '{"a":{"b":-0}}', '{"a":{"b":-0.0}}',
    '{"a":{"b":1.50}}', '{"a":{"b":100.0}}', '{"a":{"b":1e3}}', '{"a":{"b":1.5E-9}}', '{"a":{"b":0.000000000000000000001}}',
    '{"a":{"b":12345678901234567890}}', '{"a":{"b":999999999999999999}}', '{"a":{"b":false}}', '{"a":{"b":true}}', '{"a":{"b":"true"}}',
    '{"a":{"b":[true]}}', '{"a":{"b":[null,1]}}', '{"a":{"b":[[1],2]}}', '{"a":{"b":[{"c":1}]}}', '{"a":{"b":[1.50,2]}}', '{"a":{"b":["p",{"c":1}]}}',
    '{"a":{"b":{}}}', '{"a":{}}', '{"a":[{"b":1}]}', '{"a":{"b":"\\u00e9\\ud83d\\ude00"}}', '{"a":{"b":"\\ud800"}}', '{"a":{"b":"\u00e9"}}', '{"a":{"b":"x\ty"}}',
    '{"a":{"b":"x\\ny\\u0000"}}', ' {"a" : {"b" : 1} } ', '{"a":{"b":1,}}', "{'a':1}", '{"a":{"":{"b":3}},"a..b":1}', '{"a":1,"a":{"b":2}}',
    '{"a":{"b.c":5,"b":{"d":1}}}', '{"a":{"b":{"c":1}},"a.b":{"c":2}}', '{"a.b.c":null,"a":{"b":{"c":4}}}', None,
]


def test_plain_documents_read_in_one_pass_as_variants_do(spark):
    paths = ["a", "a.b", "a.b.c", "a..b", "b"]
    frame = repeated_keys_allowed(spark.createDataFrame(list(enumerate(ODD)), "n int, j string"))
    rows = frame.select("n", plain_texts(F.col("j"), paths).alias("plain"), flatten_document(F.col("j"), paths).alias("pairs")).collect()
    read = {}
    for row in rows:
        if row.plain is not None:
            read[ODD[row.n]] = dict(zip(paths, row.plain))
            occur = row.plain[-1].split("\n") if row.plain[-1] else []
            assert {p: read[ODD[row.n]][p] for p in occur} == {p.path: p.text for p in row.pairs}, ODD[row.n]
    assert read['{"a":{"b":["x","y"]}}']["a.b"] == "x" and read['{"a":{"b":1.50}}']["a.b"] == "1.5" and len(read) > 20
    assert not {'{"a":{"b":true}}', '{"a":{"b":1e3}}', '{"a":{"b":"first"},"a.b":"second"}', '{"a":{"b":1}} tail'} & set(read)


def test_all_documents_give_the_values_of_the_variants(spark):
    paths = ["a", "a.b", "a.b.c", "b"]
    frame = repeated_keys_allowed(spark.createDataFrame(list(enumerate(ODD)), "n int, _source string"))
    found = {r.n: r for r in events.flatten(frame, paths, ["n"]).collect()}
    for row in frame.select("n", flatten_document(F.col("_source"), paths).alias("pairs")).collect():
        wanted = {p.path: p.text for p in row.pairs or []}
        assert dict(zip(paths, found[row.n]._values or [None] * 4)) == {p: wanted.get(p) for p in paths}, ODD[row.n]
        assert sorted(found[row.n]._paths or []) == sorted(wanted), ODD[row.n]


def test_a_path_of_one_segment_is_read_by_name(spark):
    frame = repeated_keys_allowed(spark.createDataFrame(list(enumerate(ODD)), "n int, j string"))
    rows = frame.select("n", leaf(F.col("j"), "a").alias("v"), F.get(flatten_document(F.col("j"), ["a"]), F.lit(0))["text"].alias("w")).collect()
    assert all(row.v == row.w for row in rows), [(ODD[row.n], row.v, row.w) for row in rows if row.v != row.w]
