"""Flattened records: shapes, positions, identities, and rebuilding a record from its objects."""

import json

from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from jurisdiff.operators.nested import AXES, MAX_DEPTH, distinct_objects, field_table, flatten_records, parse_json, regulation_nodes, shape_regulation, snake, subtree_rows

AXIS = {"summary": "s", "sources": ["u", "", None, {"url": "v"}], "review": {"by": "x", "marks": [1]}}
BASE = {"axes": {"transparency": AXIS, "penalties": "text", "prohibited_uses": {"summary": " "}, "timeline": {"date": "d"}}, "diff_vs_eu": {"stricter": [{}, {"topic": "t"}], "looser": None}}
WANT = {("axes.transparency", 0), ("axes.transparency.sources", 0), ("axes.transparency.sources", 3), ("axes.penalties", 0), ("axes.timeline", 0), ("diff_vs_eu.stricter", 1)}


def nodes(spark, payloads):
    df = spark.createDataFrame([(i, p, "clash", 1) for i, p in enumerate(payloads)], "id bigint, payload string, node string, pos int")
    out = {i: set() for i in range(len(payloads))}
    for r in regulation_nodes(*flatten_records(df, "id", "payload", shape_regulation)).collect():
        out[r.record_id].add((r.node, r.pos))
    return out


def test_shapes(spark):
    camel = {"axes": BASE["axes"], "diffVsEu": json.dumps(BASE["diff_vs_eu"])}
    shapes = [BASE, [BASE], {"schema": "v2", "record": BASE}, {"data": {"regulation": BASE}, "meta": {}}, camel, json.dumps(BASE)]
    got = nodes(spark, [json.dumps(s) for s in shapes] + ["﻿" + json.dumps(BASE, indent=1)])
    assert all(v == WANT for v in got.values())


def test_no_records(spark):
    deep = '{"axes":' * 3000 + "1" + "}" * 2999
    got = nodes(spark, [None, "", "null", "[]", "3", '"x"', "<html>", json.dumps(BASE)[:-9], '{"axes": NaN}', deep, '{"axes": null, "diff_vs_eu": null}', '{"axes": [], "diff_vs_eu": "no"}'])
    assert all(not v for v in got.values())


def test_equal_objects_are_stored_once(spark):
    df = spark.createDataFrame([(1, json.dumps(BASE)), (2, json.dumps(BASE, indent=2)), (3, json.dumps(dict(reversed(BASE.items()))))], "id bigint, payload string")
    bridge, bodies = flatten_records(df, "id", "payload", shape_regulation)
    objects = distinct_objects(bridge, bodies)
    assert bridge.where("parent_place is null").select("object_id").distinct().count() == 1
    stored = {r.object_id: r for r in objects.collect()}
    assert all(r.occurrences % 3 == 0 for r in stored.values()) and len({r.body for r in stored.values()}) == len(stored)


def test_records_of_one_payload_stay_apart_and_point_to_their_parents(spark):
    two = json.dumps([BASE, {"axes": {"timeline": [{"date": "d"}, {"date": "e", "event": "v"}]}}])
    bridge, objects = flatten_records(spark.createDataFrame([(7, two)], "id bigint, payload string"), "id", "payload", shape_regulation)
    rows = bridge.collect()
    places = {(r.record_no, r.place) for r in rows}
    assert len(places) == len(rows) and all((r.record_no, r.parent_place) in places for r in rows if r.place)
    entries = field_table(bridge, objects, F.col("node") == "axes.timeline", ["date", "event"]).collect()
    assert {(r.record_no, r.place, r.parent_place, r.date, r.event) for r in entries} == {(0, "axes.timeline[0]", "axes", "d", None), (1, "axes.timeline[0]", "axes", "d", None), (1, "axes.timeline[1]", "axes", "e", "v")}
    sources = field_table(bridge, objects, F.col("node") == "axes.transparency.sources", ["url"]).collect()
    assert {(r.place, r.url) for r in sources} == {("axes.transparency.sources[0]", "u"), ("axes.transparency.sources[3]", "v")}


def test_a_field_of_any_depth_keeps_its_record(spark):
    for levels in (MAX_DEPTH - 2, 450, 20_000):
        field = '{"x":[' * levels + '"]}{["' + "]}" * levels
        text = json.dumps({**BASE, "odd": 0}).replace('"odd": 0', f'"odd": {field}')
        assert nodes(spark, [text])[0] == WANT
        assert not nodes(spark, [text.replace('"]}{["', "x")])[0] and not nodes(spark, [text[:-1]])[0]


JSON = st.recursive(st.none() | st.booleans() | st.integers(-9, 9) | st.text(max_size=4), lambda c: st.lists(c, max_size=3) | st.dictionaries(st.text(min_size=1, max_size=3).filter(lambda k: k != "@"), c, max_size=3), max_leaves=12)


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.text(min_size=1, max_size=3).filter(lambda k: k != "@"), JSON, max_size=4))
def test_a_record_can_be_rebuilt(record):
    rows, bodies = subtree_rows(1, record)
    bodies = {k: json.loads(v) for k, v in bodies.items()}

    def build(v):
        if isinstance(v, dict):
            return build(bodies[v["@"]]) if set(v) == {"@"} else {k: build(x) for k, x in v.items()}
        return [build(x) for x in v] if isinstance(v, list) else v

    assert build(bodies[rows[-1][-1]]) == record


def test_names_and_parsing():
    assert [snake(x) for x in ("diffVsEu", "diff_vs_eu", "GPAIObligations", "last-checked")] == ["diff_vs_eu", "diff_vs_eu", "gpai_obligations", "last_checked"]
    assert parse_json("[1") == (None, False) and parse_json("null") == (None, True) and len(AXES) == 6


def test_nested_rules(spark):
    from jurisdiff.operators.validate import regulation_violations

    axis = {"summary": "s", "detail": "d", "sources": []}
    good = {k: "x" for k in ("jurisdiction", "regulation_name", "status", "approach", "last_checked", "last_changed")} | {"axes": {a: axis for a in AXES} | {"timeline": [{"date": "2026-01-01", "event": "e", "source": "u"}]}, "diff_vs_eu": {k: [{"topic": "t", "note": "", "source": "u"}] for k in ("stricter", "looser", "absent", "unique")}}
    bad = json.loads(json.dumps(good)) | {"regulation_name": "", "odd": 1}
    del bad["status"], bad["axes"]["penalties"], bad["axes"]["transparency"]["detail"], bad["diff_vs_eu"]["unique"]
    bad["axes"]["timeline"] = [{"date": "1 May", "event": "", "source": "u"}, None, {"event": "e", "when": 1}]
    bad["diff_vs_eu"]["looser"] = [{"topic": "", "note": "", "source": "u"}, "text"]
    df = spark.createDataFrame([(1, json.dumps(good)), (2, json.dumps(bad)), (3, None), (4, json.dumps(bad))], "id bigint, payload string")
    got = {(r.record_id, r.place, r.field, r.rule) for r in regulation_violations(*flatten_records(df, "id", "payload", shape_regulation)).collect()}
    want = {("", "regulation_name", "minLength"), ("", "odd", "unknown"), ("", "status", "required"), ("axes", "penalties", "required"), ("axes.transparency", "detail", "required"), ("diff_vs_eu", "unique", "required"), ("axes.timeline[0]", "date", "pattern"), ("axes.timeline[0]", "event", "minLength"),
            ("axes.timeline[2]", "date", "required"), ("axes.timeline[2]", "source", "required"), ("axes.timeline[2]", "when", "unknown"), ("diff_vs_eu.looser[0]", "topic", "minLength"), ("diff_vs_eu.looser[1]", "", "type")}
    assert got == {(i, *w) for i in (2, 4) for w in want}
