import pytest
from pyspark.sql import functions as F

from netsieve.functions import labels, text


def values(spark, expression, inputs):
    rows = [(n, v) for n, v in enumerate(inputs)]
    frame = spark.createDataFrame(rows, "n int, v string")
    return [row.r for row in frame.select("n", expression(F.col("v")).alias("r")).orderBy("n").collect()]


def test_url_decode(spark):
    cases = {
        "100%": "100%", "%zz%41": "%zzA", "a%2": "a%2", "/a%20b+c": "/a b c", "%ff%fe": "��",
        "%c3%28": "�(", "x%2527": "x%27", "": "", "plain": "plain", " %20 ": " ",
    }
    assert values(spark, text.request_text, list(cases)) == list(cases.values())


def test_payload_text_strips_after_decoding(spark):
    assert values(spark, text.payload_text, ["%20a%20", "+b", None]) == ["a", "b", ""]


def test_numbers(spark):
    cases = {
        "1d": 0.0, "1f": 0.0, "0x10": 0.0, "1,000": 0.0, "1_000": 0.0, "True": 0.0, "nan": 0.0, "": 0.0, " 2 ": 2.0,
        "1e3": 1000.0, "+5": 5.0, ".5": 0.5, "inf": float("inf"), None: 0.0, "0x1p3": 0.0,
    }
    assert values(spark, text.as_number, list(cases)) == list(cases.values())


def test_ports(spark):
    cases = {"0.5": 0, "1.5": 2, "2.5": 2, "70000": 65535, "-3": 0, "inf": 65535, "x": 0}
    assert values(spark, text.as_port, list(cases)) == list(cases.values())


def test_strip_covers_unicode_space(spark):
    space = "\t\x0b\x1c\x1f \x85\xa0   　"
    assert values(spark, text.as_text, [space + "a b" + space]) == ["a b"]


def test_protocol(spark):
    assert values(spark, text.clean_protocol, [" - ", "0", "tcp", None, "a-"]) == ["", "", "TCP", "", "A-"]


@pytest.mark.parametrize(
    "mode, expected",
    [(labels.label_from_words, [0, 1, 1, 0, 1, 0, 1]), (labels.label_from_number, [0, 0, 0, 0, 1, 0, 0])],
)
def test_labels(spark, mode, expected):
    assert values(spark, mode, ["BENIGN", "DDoS", "abnormal", "unknown", "1", "0", "Denied"]) == expected


def test_html_escape(spark):
    escaped = "&lt;a href=&#x27;x&#x27;&gt;&amp;&quot;&lt;/a&gt;"
    assert values(spark, text.html_escape, ["<a href='x'>&\"</a>"]) == [escaped]


def test_truncate(spark):
    shown = values(spark, lambda c: text.truncate(c, 180), ["x" * 180, "y" * 181, "  z  ", None])
    assert shown == ["x" * 180, "y" * 177 + "...", "z", ""]
