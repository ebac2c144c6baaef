import datetime

from pyspark.sql import functions as F

import __spark_entry__ as entry
from netsieve.functions import patterns
from netsieve.functions.text import request_text
from netsieve.operators.features import score_features, text_features

COLUMNS = [
    "uri_sql_keyword_hits", "uri_sql_tautology_hits", "uri_sql_comment_hits", "uri_sql_encoded_meta_hits",
    "uri_xss_keyword_hits", "uri_xss_event_handler_hits", "uri_xss_script_tag_hits", "uri_quote_count",
    "uri_angle_bracket_count", "special", "uri_path_depth", "uri_equals_count", "uri_length",
    "sql_attack_score", "xss_attack_score",
]
EXPECTED = {
    "q=9;WAITFOR DELAY char(3)": [2, 0, 1, 0, 0, 0, 0, 0, 0, 6, 0, 1, 25, 5, 0],
    "/cart?sort=price&dir=up": [0, 0, 0, 0, 0, 0, 0, 0, 0, 4, 1, 2, 23, 0, 0],
    "/img/a-1.png": [0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 2, 0, 12, 0, 0],
    "go=javascript:f()&u=data:text/html,x": [0, 0, 0, 0, 2, 0, 0, 0, 0, 8, 1, 2, 36, 0, 4],
    "/p?z=1 AND pg_sleep(2)=2 xor `k`=`k` GROUP BY 1": [2, 1, 0, 0, 0, 0, 0, 4, 0, 17, 1, 3, 47, 8, 0],
    "/find?c=1;drop table_name having hex(1)=2 union all select cast(a) and 3=3--": [7, 1, 2, 0, 0, 0, 0, 0, 0, 18, 1, 3, 76, 19, 0],
    "/a?b=vbscript:x&c=<iframe onfocus=1>": [0, 0, 0, 0, 2, 1, 0, 0, 2, 9, 1, 3, 36, 0, 6.5],
    "/m?t=%3Cbody%20onpageshow%20=1%3E%3C/script%3E#top": [0, 0, 1, 0, 2, 1, 1, 0, 4, 10, 2, 2, 38, 1, 9],
    "v=%2523%2522&w=declare+convert(x)+order++by+dbms_lock": [4, 0, 0, 2, 0, 0, 0, 0, 0, 12, 0, 2, 49, 9, 0],
    "/x?q=%2527%2520or%25201%253D1;drop table t/*c*/": [1, 0, 3, 3, 0, 0, 0, 0, 0, 11, 3, 1, 39, 6.5, 0],
    "/?a=1&b=<img src=x onerror=alert(1)>&c=concat(0x1,database())": [2, 0, 0, 0, 2, 1, 0, 0, 2, 19, 1, 5, 61, 4, 6.5],
    "a=1 and (b=c) xor 'd'=`e`": [0, 2, 0, 0, 0, 0, 0, 4, 0, 13, 0, 3, 25, 7, 0],
}


def test_payload_counts(spark):
    frame = spark.createDataFrame([(u,) for u in EXPECTED], "uri string").withColumn("t", request_text(F.col("uri")))
    counted = text_features(F.col("t"))
    every = counted | score_features(counted) | {"special": patterns.special_characters(F.col("t"))}
    rows = frame.select("uri", *[every[name].alias(name) for name in COLUMNS]).collect()
    for row in rows:
        assert [row[name] for name in COLUMNS] == EXPECTED[row.uri], row.uri


def test_unicode_matching(spark):
    frame = spark.createDataFrame([("ſelect", "or\xa01=1", "onİ=1", "or\x1c1=1")], "k string, t string, h string, s string")
    row = frame.select(
        patterns.sql_keywords(F.col("k")), patterns.sql_tautologies(F.col("t")),
        patterns.xss_event_handlers(F.col("h")), patterns.sql_tautologies(F.col("s")),
    ).first()
    assert list(row) == [1, 1, 1, 1]


def test_suspicion_reads_the_undecoded_uri(spark):
    uris = {"/a%27b": True, "/plain": False, "": False, "/a%2527": False, "/q?x=select": True, " ;": True, "/selected": True, "/?f=database()": True}
    frame = spark.createDataFrame([(u,) for u in uris], "uri string")
    found = {r.uri: r.s for r in frame.select("uri", patterns.is_suspicious(F.col("uri")).alias("s")).collect()}
    assert found == uris


def test_query_on_script_tags_reads_texts_that_hold_them(spark, folder):
    rows = [(n, datetime.datetime(2024, 1, 1), n, "view", 1.0, '{"k": 1}') for n in range(24)]
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/events.parquet")
    found = entry.queries()["d30_uri_xss_script_tag_hits"](spark, folder).collect()
    assert {row.event_id: row.uri_xss_script_tag_hits for row in found} == {n: 2.0 if n % 12 == 3 else 0.0 for n in range(24)}
    assert "%3Cscript%3E" in entry.oracle_sql()["d30_uri_xss_script_tag_hits"]
    assert "%3Cscript%3E" not in entry.oracle_sql()["d29_uri_xss_event_handler_hits"]
