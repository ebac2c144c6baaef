import json

import pytest
from pyspark.sql import functions as F

from netsieve.operators import unify
from netsieve.sources import files
from netsieve.sources.columns import canonical_name, detect_format

# one record for each rule under test: no protocol, a text label, a port beyond the range, a blank method
RECORDS = [
    {"uri": "/tiles?z=3", "http_method": " put ", "label": 4, "protocol": "-", "bytes": 77, "packets": 2, "duration": 9, "src_ip": "100.64.7.1",
     "dst_ip": "", "src_port": 1, "dst_port": 8443},
    {"protocol": "sctp", "label": 0, "bytes": 5, "packets": 0, "duration": 0, "src_ip": "fe80::9", "dst_ip": "fe80::1", "src_port": 65535, "dst_port": 0},
    {"protocol": "UDP", "label": 1, "bytes": 61, "packets": 1, "duration": 0.5, "src_ip": "", "dst_ip": "100.64.0.2", "src_port": 68, "dst_port": 67,
     "uri": "note=fine"},
]
# verdict x rule type x rule name: what each decides alone, and together
FIREWALL = [
    {"protocol": "ICMP", "Dst port": 0, "Src port": 0, "Dst IP": "100.64.9.9", "Src IP": "100.64.9.8", "Message": "echo", "Rule type": 2,
     "Firewall rule name": "Drop pings", "Log subtype": "Allowed"},
    {"protocol": "UDP", "Dst port": 123, "Src port": 123, "Dst IP": "100.64.1.1", "Src IP": "100.64.1.2", "Message": "", "Rule type": 2,
     "Firewall rule name": "clock", "Log subtype": "Allowed"},
    {"protocol": "TCP", "Dst port": 25, "Src port": 2525, "Dst IP": "100.64.2.5", "Src IP": "100.64.2.6", "Message": "", "Rule type": 0,
     "Firewall rule name": "mail", "Log subtype": "Allowed"},
    {"protocol": "TCP", "Dst port": 6000, "Src port": 600, "Dst IP": "100.64.3.3", "Src IP": "100.64.3.4", "Message": "two\nlines", "Rule type": 2,
     "Firewall rule name": "screens", "Log subtype": "Denied"},
    {"protocol": "GRE", "Dst port": 7, "Src port": 8, "Dst IP": "100.64.4.4", "Src IP": "100.64.4.5", "Message": "", "Rule type": 1,
     "Firewall rule name": "tunnel", "Log subtype": "Allowed"},
]


def write(folder, name, content):
    path = f"{folder}/{name}"
    with open(path, "wb") as handle:
        handle.write(content if isinstance(content, bytes) else content.encode())
    return path


def test_names():
    assert canonical_name("  Src IP ") == "srcip"
    assert canonical_name("src_ip") == "src_ip"
    assert detect_format(["spkts", "dpkts", "sbytes", "dbytes", "x"]) == "unsw"
    assert detect_format([" Destination Port", "Subflow Fwd Packets"]) == "cic"
    assert detect_format(["Src IP", "Dst IP", "Log subtype"]) == "firewall"
    assert detect_format(["src_ip", "dst_ip", "Log subtype"]) == "generic"
    assert detect_format(["anything"]) == "modsec"


@pytest.mark.parametrize("wrap", [lambda r: r, lambda r: {"records": r}])
def test_json_records(spark, folder, wrap):
    frame = files.inference_json(spark, write(folder, "in.json", json.dumps(wrap(RECORDS))))
    rows = unify.unify_for_inference(frame, keep=["index"]).orderBy("index").collect()
    assert [r["index"] for r in rows] == [0, 1, 2]
    assert [r.label for r in rows] == [4, 0, 1]
    assert [(r.protocol, r.http_method, r.uri) for r in rows] == [("", "PUT", "/tiles?z=3"), ("SCTP", "", ""), ("UDP", "", "note=fine")]
    assert {r.source_name for r in rows} == {"INFERENCE_GENERIC"}
    assert [(r.src_port, r.bytes, r.packets) for r in rows] == [(1, 77.0, 2.0), (65535, 5.0, 0.0), (68, 61.0, 1.0)]


def test_json_object_and_payloads(spark, folder):
    one = files.inference_json(spark, write(folder, "one.json", json.dumps(RECORDS[0], indent=2)))
    assert unify.unify_for_inference(one, keep=["index"]).first().dst_port == 8443
    texts = ["/img/a-1.png", "v=1%20HAVING", None]
    many = files.inference_json(spark, write(folder, "many.json", json.dumps(texts, indent=2)))
    rows = unify.unify_for_inference(many, keep=["index"]).orderBy("index").collect()
    assert [(r.uri, r.bytes, r.protocol, r.http_method) for r in rows] == [
        ("/img/a-1.png", 12.0, "HTTP", "GET"), ("v=1 HAVING", 10.0, "HTTP", "GET"), ("", 0.0, "HTTP", "GET")
    ]
    with pytest.raises(ValueError):
        files.inference_json(spark, write(folder, "bad.json", "17"))


def test_firewall_labels(spark, folder):
    frame = files.inference_json(spark, write(folder, "fw.json", json.dumps(FIREWALL)))
    rows = unify.unify_for_inference(frame, keep=["index"]).orderBy("index").collect()
    assert [r.label for r in rows] == [1, 0, 1, 1, 0]
    assert [r.original_label_text for r in rows] == ["Allowed", "Allowed", "Allowed", "Denied", "Allowed"]
    assert {r.packets for r in rows} == {1.0}


def test_firewall_without_rule_type_is_malicious(spark):
    frame = spark.createDataFrame([("Allowed", "a", "1.1.1.1", "2.2.2.2")], ["Log subtype", "Firewall rule name", "Src IP", "Dst IP"])
    assert unify.unify_firewall_log(frame).first().label == 1


def test_csv_directory(spark, folder):
    header = "Source IP, Source Port,Destination Port, Protocol,Flow Duration,Total Fwd Packets,Total Backward Packets,Label\n"
    write(folder, "b.csv", header + "1.2.3.4,NA,80,6,2500000,3,4,DDoS\n")
    write(folder, "a.csv", (header + "1.2.3.5,5,53,17,nan,1,,BENIGN \xff\n").encode("latin-1"))
    rows = sorted(files.flow_csv(spark, folder).collect(), key=lambda r: r.src_ip)
    assert [(r.src_port, r.dst_port, r.protocol, r.duration, r.packets, r.label) for r in rows] == [
        (0, 80, "6", 2.5, 7.0, 1), (5, 53, "17", 0.0, 1.0, 0)
    ]
    assert rows[1].original_label_text == "BENIGN �"
    assert {r.label for r in files.flow_csv(spark, folder, label_mode="numeric").collect()} == {0}


def test_csv_files_with_different_headers(spark, folder):
    write(folder, "a.csv", "Source IP,Source Port,Destination Port,Protocol,Flow Duration,Label\n1.2.3.4,7,80,6,2500000,DDoS\n")
    write(folder, "b.csv", "Label,Src Port,Src IP,Dst Port,Protocol\nBENIGN,9,1.2.3.5,53,17\n")
    rows = sorted(files.flow_csv(spark, folder).collect(), key=lambda r: r.src_ip)
    assert [(r.src_ip, r.src_port, r.dst_port, r.label) for r in rows] == [("1.2.3.4", 7, 80, 1), ("1.2.3.5", 9, 53, 0)]


def test_line_breaks_inside_quotes(spark, folder):
    write(folder, "a.csv", 'Src IP,Dst IP,Log subtype,Message,Rule type\n1.1.1.1,2.2.2.2,Allowed,"two\nlines",1\n')
    write(folder, "b.csv", 'Src IP,Dst IP,Log subtype,Message,Rule type\n3.3.3.3,2.2.2.2,Denied,"he said ""no"", twice",2\n"4.4.4.4",2.2.2.2,Denied,x,2\n')
    write(folder, "c.csv", 'Src IP,Dst IP,Log subtype,Message,Rule type\n5.5.5.5,2.2.2.2,Denied,5" of cable,2\n6.6.6.6,2.2.2.2,Denied,,2\n')
    rows = files.firewall_csv(spark, folder).collect()
    assert sorted(r.src_ip for r in rows) == ["1.1.1.1", "3.3.3.3", "4.4.4.4", "5.5.5.5", "6.6.6.6"]
    heads = {h.path.rsplit("/", 1)[1]: h.broken for h in files.csv_heads(spark, [f"{folder}/{n}.csv" for n in "abc"])}
    assert heads == {"a.csv": True, "b.csv": False, "c.csv": False}
    assert len(files.firewall_csv(spark, folder, multi_line=False).collect()) == 6


def test_many_csv_files_in_one_job(spark, folder):
    for n in range(60):
        write(folder, f"f{n:03}.csv", f"Src IP,Dst IP,Log subtype{',extra' * (n % 2)}\n9.0.0.{n},2.2.2.2,Denied{',x' * (n % 2)}\n")
    spark.sparkContext.setJobGroup("heads", "headers of many files")
    heads = files.csv_heads(spark, [f"{folder}/f{n:03}.csv" for n in range(60)])
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("heads")
    spark.sparkContext.setJobGroup("", "")
    assert len(heads) == 60 and len(set(h.header for h in heads)) == 2 and len(jobs) <= 3  # the listing, and one job with its shuffle
    assert files.firewall_csv(spark, folder).count() == 60


@pytest.mark.parametrize(("text", "columns"), [("[" + " " * 5000 + '{"src_ip": "1.1.1.1"}]', ["index", "src_ip"]), (" " * 5000 + '["a"]', ["index", "payload"])])
def test_shape_does_not_depend_on_blanks(spark, folder, text, columns):
    assert files.inference_json(spark, write(folder, "in.json", text)).columns == columns


def test_missing_csv(spark, folder):
    with pytest.raises(FileNotFoundError):
        files.flow_csv(spark, folder)


def test_payload_arrays(spark, folder):
    import os

    for name in ("Legitimate", "malicious", "other legitimate"):
        os.makedirs(f"{folder}/{name}")
    write(folder, "Legitimate/x.json", json.dumps(["/a%20b", None, 5], indent=1))
    write(folder, "malicious/y.json", json.dumps(["' or 1=1"]))
    rows = files.payload_json(spark, folder).collect()
    assert sorted((r.uri, r.label) for r in rows) == [("", 0), ("' or 1=1", 1), ("/a b", 0), ("5", 0)]
    os.makedirs(f"{folder}/legitimate")
    write(folder, "legitimate/legitimate_dataset.json", json.dumps(["/only"]))
    assert [(r.uri, r.label) for r in files.payload_json(spark, folder).collect()] == [("/only", 0)]


def test_payload_label_ignores_the_root(spark, folder):
    import os

    root = f"{folder}/legitimate/set"
    os.makedirs(root)
    write(root, "attack.json", json.dumps(["x"]))
    assert files.payload_json(spark, root).first().label == 1


def test_flow_table_label_falls_back_to_text(spark):
    frame = spark.createDataFrame([("tcp", 1, 2, 3, 4, " DoS ")], ["proto", "sbytes", "dbytes", "spkts", "dpkts", "attack_cat"])
    row = unify.unify_flow_table(frame).first()
    assert (row.label, row.original_label_text, row.bytes, row.packets) == (1, "DoS", 3.0, 7.0)
    assert unify.unify_flow_table(frame, label_mode="numeric").first().label == 0


def test_union_keeps_every_row(spark):
    frame = spark.createDataFrame([("x",)], "payload string").withColumn("label", F.lit(1))
    part = unify.unify_payloads(frame)
    assert unify.union_sources(part, part, part).count() == 3
