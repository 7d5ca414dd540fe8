import json

from tallystone.operators import nested as N

OBS = {"start": "2020-01-01", "end": "2020-03-31", "val": 5, "accn": "a", "fy": 2020, "fp": "Q1", "form": "10-Q", "filed": "2020-05-01"}
DOC = {"cik": 7, "entityName": "X", "facts": {"us-gaap": {"Assets": {"label": "A", "units": {"USD": [OBS, None, {"end": None, "val": 1}, {"end": "2020-06-30", "val": "1,234"}, {"end": "2020-06-30", "val": "n/a"}, dict(OBS, val="5.0")], "EUR": {"end": "2020-06-30", "val": 0}}}, "Bad": None, "Odd": [1]}, "dei": None, "srt": {}}}
SCHEMA = "file_no long, file_name string, payload string, unit string"


def files(*payloads):
    return [(i, f"CIK{99:010d}_sample", p, "clash") for i, p in enumerate(payloads)]


def test_found(spark):
    no_cik = {k: v for k, v in DOC.items() if k != "cik"}
    f = files(json.dumps(DOC), "﻿" + json.dumps({"status": 200, "data": DOC}), json.dumps([DOC]), json.dumps(json.dumps(no_cik)), json.dumps(DOC)[:-1], None, "", "[]", "3", json.dumps({"cik": "0000000007"}), json.dumps(DOC) + " x", json.dumps(dict(DOC, cik="0007")))
    got = sorted(tuple(r) for r in N.found(spark.createDataFrame(f, SCHEMA)).collect())
    one = [("us-gaap", "Assets", "EUR", 0), ("us-gaap", "Assets", "USD", 0), ("us-gaap", "Assets", "USD", 3), ("us-gaap", "Assets", "USD", 5)]
    assert got == sorted((i, 99 if i == 3 else 7, *o) for i in (0, 1, 2, 3, 11) for o in one)
    assert N.found(spark.createDataFrame([], SCHEMA)).collect() == []


def test_identical_objects_are_stored_once(spark):
    n = N.Nested(spark.createDataFrame(files(json.dumps(DOC), json.dumps(DOC)), SCHEMA))
    bridge = n.bridge("observation").collect()
    assert len(bridge) == 12
    nodes = {r["node_id"] for r in n.nodes().collect() if r["kind"] == "observation"}
    assert nodes == {r["node_id"] for r in bridge}
    same = {r["node_id"] for r in bridge if r["unit"] == "USD" and r["ordinal"] in (0, 5)}
    assert len(same) == 1  # 5 and "5.0" are one fact
    parents = {r["node_id"] for r in n.bridge("unit").collect()}
    assert {r["parent_id"] for r in bridge} == parents
    assert {r["parent_id"] for r in n.bridge("unit").collect()} <= {r["node_id"] for r in n.bridge("concept").collect()}
    assert {r["parent_id"] for r in n.bridge("concept").collect()} == {r["node_id"] for r in n.bridge("company").collect()}
    obs = n.observations().where("usable").collect()
    assert {r["val"] for r in obs} == {5.0, 1234.0, 0.0} or {r["val"] for r in obs} == {5.0, None, 0.0}
    assert n.companies().count() == 2 and n.concepts().count() == 2


def test_deep_payload_is_no_crash(spark):
    deep = "[" * 100_000
    assert N.found(spark.createDataFrame(files(deep, "[" * 50 + "]" * 50), SCHEMA)).collect() == []


def test_nothing_nested_is_lost(spark):
    obs = dict(OBS, dims=[{"axis": "Segment", "members": [{"name": "A"}, {"name": "B"}]}, None, "plain", [1, [2]]], note={"text": "n", "by": {"who": "x"}})
    doc = {"cik": 7, "entityName": "X", "addresses": [{"city": "Lunmont"}, {"city": "Dunrado"}], "facts": {"t": {"C": {"label": "L", "weight": 3, "notes": [{"n": 1}], "units": {"USD": [obs, 5]}}, "Odd": [1]}, "bad": "x"}}
    n = N.Nested(spark.createDataFrame(files(json.dumps(doc)), SCHEMA))
    parts = {(r["kind"], r["field"], r["ordinal"], r["body"]) for r in n.parts().collect()}
    assert parts == {
        ("object", "dims", 0, '{"axis":"Segment"}'), ("object", "members", 0, '{"name":"A"}'), ("object", "members", 1, '{"name":"B"}'), ("value", "dims", 2, '{"value":"plain"}'), ("list", "dims", 3, "{}"),
        ("value", "", 0, '{"value":1}'), ("list", "", 1, "{}"), ("value", "", 0, '{"value":2}'), ("object", "note", 0, '{"text":"n"}'), ("object", "by", 0, '{"who":"x"}'),
        ("object", "addresses", 0, '{"city":"Lunmont"}'), ("object", "addresses", 1, '{"city":"Dunrado"}'), ("object", "notes", 0, '{"n":1}'), ("value", "", 1, '{"value":5}'), ("list", "Odd", 0, "{}"), ("value", "bad", 0, '{"value":"x"}'),
    }
    nodes, bridge = {r["node_id"] for r in n.nodes().collect()}, n.bridge().collect()
    assert all(r["parent_id"] in nodes for r in bridge if r["kind"] != "company") and sum(r["parent_id"] is None for r in bridge) == 1
    assert json.loads([r for r in n.nodes("concept").collect()][0]["body"])["weight"] == 3
    other = json.loads(json.dumps(doc))
    other["facts"]["t"]["C"]["units"]["USD"][0]["dims"][0]["members"][1]["name"] = "C"
    changed = N.Nested(spark.createDataFrame(files(json.dumps(other)), SCHEMA))
    ids = lambda x, k: {r["node_id"] for r in x.bridge(k).collect()}
    assert not any(ids(n, k) & ids(changed, k) for k in ("company", "concept", "unit", "observation"))  # an inner change reaches the root


def test_any_number_of_envelopes(spark):
    x = DOC
    for k in range(20):
        x = {"data": x} if k % 3 else json.dumps([x])
    deep = dict(OBS)
    for _ in range(900):
        deep = {"end": "2020-01-01", "val": 1, "in": [deep]}
    doc = {"cik": 8, "facts": {"t": {"C": {"units": {"U": [deep]}}}}}
    f = spark.createDataFrame(files(json.dumps(x), json.dumps(doc)), SCHEMA)
    got = [tuple(r) for r in N.found(f).collect()]
    assert sorted(r[0] for r in got) == [0, 0, 0, 0, 1]
    assert N.Nested(f).parts().where("file_no = 1").count() == 900
