"""Projections, routing, catalog and gate operators on inline tables."""

import json

from pyspark.sql import functions as F

from flowtable.operators.catalog import build_extract_url, typed_ddl, typed_schema
from flowtable.operators.columns import (lookup_enrich, metric_json,
                                         parse_pairs, put_content, rewrite_extension, split_list)
from flowtable.operators.gate import delay_gate
from flowtable.operators.records import as_json_content, outputs, route_split
from flowtable.operators.routing import busy_nodes, capped_actions, clear_scope, detect_format, purge_keys, purge_report


def test_parse_pairs_rules(spark):
    rows = [(0, "a=1,b=2"), (1, "a=b=c"), (2, "a=1,,b=2"), (3, "a=1,a=2"), (4, "a"), (5, "a==b"), (6, ""), (7, None)]
    df = spark.createDataFrame(rows, "id long, cfg string")
    got = {r.id: (r.pairs, r.route) for r in parse_pairs(df, "cfg").collect()}
    assert got[0] == ({"a": "1", "b": "2"}, "success")
    assert got[1] == ({"a": "b"}, "success")
    assert got[2] == ({"a": "1", "b": "2"}, "success")
    assert got[3] == ({"a": "2"}, "success")
    assert got[4] == (None, "failure")
    assert got[5] == ({"a": "b"}, "success")
    assert got[6] == ({}, "success")
    assert got[7] == ({}, "success")  # null text: no items


def test_split_list(spark):
    df = spark.createDataFrame([("a,,b,",)], "v string")
    assert split_list(df, "v").first().v == ["a", "b"]


def test_put_content_template(spark):
    df = spark.createDataFrame([(1, "x", None)], "id long, name string, extra string")
    out = put_content(df, "id=${id} name=${name} extra=${extra} missing=${nope}!").first().content
    assert out == "id=1 name=x extra= missing=!"


def test_rewrite_extension(spark):
    df = spark.createDataFrame([("a.b.bmp",), ("noext",), ("",), (None,), ("x.",), ("$.bmp",)], "n string")
    got = [r.m for r in rewrite_extension(df, "n", ".jpg", out_col="m").collect()]
    assert got == ["a.b.jpg", "noext", "", None, "x.jpg", "$.jpg"]


def test_lookup_enrich_ignores_case(spark):
    df = spark.createDataFrame([("img_5104.jpg",), ("IMG_5108.JPG",), ("other.jpg",)], "filename string")
    weights = spark.createDataFrame([("IMG_5104.JPG", "130"), ("img_5108.jpg", "263")], "key string, value string")
    got = [r.weight for r in lookup_enrich(df, "filename", weights, out_col="weight",
                                           default="0.0").orderBy("filename").collect()]
    assert got == ["263", "130", "0.0"]


def test_metric_json(spark):
    df = spark.createDataFrame([("t", 1.5), ("t", 2.5)], "obj string, v double")
    assert json.loads(metric_json(df, "obj", "v").first().metric) == {"t": {"Max": "2.5"}}


def test_route_split_and_outputs(spark):
    df = spark.createDataFrame([(1,), (5,), (10,)], "x int")
    routed = route_split(df, [("small", "x < 3"), ("mid", F.col("x") < 8)], default="big")
    outs = outputs(routed, ["small", "mid", "big"])
    assert [r.x for r in outs["mid"].collect()] == [5]
    assert outs["original"].count() == 3 and "route" not in outs["original"].columns


def test_json_content_forms(spark):
    df = spark.createDataFrame([("k", 2, 0.5), ("k", 1, 1.0)], "g string, o int, v double")
    assert as_json_content(df.select("o", "v"), per="table", order_cols=["o"]).first().content == \
        '[{"o":1,"v":1.0},{"o":2,"v":0.5}]'
    assert as_json_content(df, per="group", key_cols=["g"], order_cols=["o"]).first().content == \
        '[{"o":1,"v":1.0},{"o":2,"v":0.5}]'


def test_detect_format_magic(spark):
    df = spark.createDataFrame([(bytearray(b"\x89PNG\r\n\x1a\nrest"),), (bytearray(b"%PDF-1.4"),),
                                (bytearray(b"{\"invalid\": \"true\"}"),)], "c binary")
    got = [(r.mime, r.route, r.reason) for r in detect_format(df, "c").collect()]
    assert got == [("image/png", "success", None), ("application/pdf", "success", None),
                   (None, "failure", "unsupported image format")]


def test_purge_and_report(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "k long")
    tombs = spark.createDataFrame([(2,), (9,)], "k long")
    assert sorted(r.k for r in purge_keys(df, tombs, "k").collect()) == [1, 3]
    assert {r.k: r.route for r in purge_report(df, tombs, "k").collect()} == {2: "success", 9: "failure"}


def test_clear_scope(spark):
    scopes = spark.createDataFrame([("a", True), ("b", True), ("z", False)], "scope string, exists boolean")
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "c")], "id long, s string")
    report, survivors = clear_scope(scopes, df, "s")
    assert {r.scope: (r.n_removed, r.route) for r in report.collect()} == {
        "a": (2, "success"), "b": (0, "empty"), "z": (0, "failure")}
    assert [r.id for r in survivors.collect()] == [3]


def test_capped_actions_global_and_per_key(spark):
    df = spark.createDataFrame([(i, i % 3, 100 - i) for i in range(12)], "id long, k long, t long")
    glob = {r.id: r.route for r in capped_actions(df, ["t", "id"], maximum=5, already=2).collect()}
    assert sorted(i for i, r in glob.items() if r == "act") == [9, 10, 11]
    per = {r.id: r.route for r in capped_actions(df, ["t", "id"], maximum=2, key_col="k").collect()}
    assert sorted(i for i, r in per.items() if r == "act") == [6, 7, 8, 9, 10, 11]
    assert set(capped_actions(df, ["t", "id"], maximum=3, already=3).select("route").distinct()
               .toPandas()["route"]) == {"no action taken"}


def test_busy_nodes_any_depth(spark):
    groups = spark.createDataFrame([("root", None, "Root"), ("a", "root", "A"), ("b", "a", "B")],
                                   "group_id string, parent_id string, name string")
    queues = spark.createDataFrame([("root", "q0", 11), ("a", "q1", 10), ("b", "q2", 50)],
                                   "group_id string, queue_name string, queued_count long")
    got = sorted(tuple(r) for r in busy_nodes(groups, queues).collect())
    assert got == [("Root", 0, "q0", 11), ("Root/A/B", 2, "q2", 50)]


def test_typed_ddl_and_url(spark):
    fields = [{"name": "Id", "type": "ID"}, {"name": "Name", "type": "string"}, {"name": "Tags", "type": "picklist"},
              {"name": "Amount", "type": "currency"}, {"name": "Rate", "type": "double"}, {"name": "Last", "type": "double"}]
    df = spark.createDataFrame([("Account", json.dumps(fields)), ("Empty", "[]"), ("One", '[{"name":"Id","type":"id"}]'),
                                ("Obj", json.dumps({"fields": fields[:2]}))], "sobject_name string, fields_json string")
    got = {r.sobject_name: (r.ddl, r.route) for r in typed_ddl(df).collect()}
    assert got["Account"] == ("CREATE TABLE SALESFORCE.Account(Id VARCHAR PRIMARY KEY,Name VARCHAR,Tags VARCHAR[],"
                              "Amount DOUBLE,Rate DOUBLE,Last VARCHAR)", "success")
    assert got["Empty"] == (None, "failure")
    assert got["One"] == ("CREATE TABLE SALESFORCE.One(Id VARCHAR)", "success")
    url = {r.sobject_name: r.url for r in build_extract_url(df, "https://h", "Account", "2016-01-01T00:00:00Z").collect()}
    assert url["Obj"] == ("https://h/services/data/v36.0/queryAll/?q=SELECT+Id,Name+FROM+Account+WHERE+SYSTEMMODSTAMP"
                          "+>+2016-01-01T00:00:00Z+order+by+SYSTEMMODSTAMP+asc")
    assert typed_schema([("Id", "id"), ("Amount", "currency")]).simpleString() == "struct<Id:string,Amount:double>"


def test_delay_gate_strict_boundary(spark):
    df = spark.createDataFrame([(1, None), (2, 900), (3, 899), (4, 1000)], "id long, stamp long")
    got = {r.id: (r.stamp, r.route) for r in delay_gate(df, "stamp", as_of_ms=1000, delay_ms=100).collect()}
    assert got == {1: (1000, "delay"), 2: (900, "delay"), 3: (899, "ready"), 4: (1000, "delay")}


def test_capped_actions_large_cap_path_is_exact(spark, monkeypatch):
    import flowtable.operators.routing as routing

    df = spark.createDataFrame([(i, (i * 7) % 23) for i in range(200)], "id long, t long").repartition(5)
    small = {r.id: r.route for r in capped_actions(df, ["t", "id"], maximum=37).collect()}
    monkeypatch.setattr(routing, "TOPK_MAX", 10)
    large = {r.id: r.route for r in routing.capped_actions(df, ["t", "id"], maximum=37).collect()}
    assert small == large and sum(r == "act" for r in large.values()) == 37
    everything = {r.route for r in routing.capped_actions(df, ["t", "id"], maximum=500).collect()}
    assert everything == {"act"}


def test_busy_nodes_deep_chain_checkpoints(spark):
    # 20 levels: the walk checkpoints its frontier every 8 levels
    rows = [("g0", None, "n0")] + [(f"g{i}", f"g{i - 1}", f"n{i}") for i in range(1, 20)]
    groups = spark.createDataFrame(rows, "group_id string, parent_id string, name string")
    queues = spark.createDataFrame([("g19", "q", 99)], "group_id string, queue_name string, queued_count long")
    (path, depth, queue, count), = [tuple(r) for r in busy_nodes(groups, queues).collect()]
    assert path == "/".join(f"n{i}" for i in range(20)) and depth == 19 and count == 99


def test_extract_url_encoded_query(spark):
    df = spark.createDataFrame([("Account", '[{"name":"Id","type":"id"},{"name":"Name","type":"string"}]')],
                               "sobject_name string, fields_json string")
    url = build_extract_url(df, "https://h", "Account", "2016-01-01T00:00:00Z", encode_query=True).first().url
    assert url == ("https://h/services/data/v36.0/queryAll/?q=SELECT+Id%2CName+FROM+Account+WHERE+SYSTEMMODSTAMP"
                   "+%3E+2016-01-01T00%3A00%3A00Z+order+by+SYSTEMMODSTAMP+asc")
