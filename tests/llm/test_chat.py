import json

import pytest

from reshelve.llm import chat as c

SCHEMA = {"type": "object", "properties": {"q": {"type": "string"}, "n": {
    "type": "integer", "minimum": 1}, "of": {}}, "required": ["q"], "additionalProperties": False}


def tables(spark, messages=(), calls=(), results=()):
    return (spark.createDataFrame([(*m, 0) for m in messages],
                                  "conv_id long, turn long, role string, text string, place int"),
            spark.createDataFrame(list(calls), "conv_id long, turn long, call_id string, "
                                               "name string, arguments string"),
            spark.createDataFrame(list(results),
                                  "conv_id long, turn long, call_id string, text string"))


def rows(spark, **given):
    found = c.format_chat(*tables(spark, **given), {"find": SCHEMA}).collect()
    return found


@pytest.mark.parametrize("value, text", [
    ({"b": 1.0, "a": [True, None, "é\n"]}, '{"a":[true,null,"é\\n"],"b":1}'),
    ({"\U0001F600": 1, "￿": 2}, '{"\U0001F600":1,"￿":2}'), (1e300, "1e+300"), (0.5, "0.5"),
    ({}, "{}"), ("", '""')])
def test_canonical(value, text):
    assert c.canonical(value) == text
    assert json.loads(text) == value


def test_violations():
    assert c.violations({"q": "x", "n": 1.0}, SCHEMA) == []
    assert c.violations({"n": 0, "x": 1}, SCHEMA) == [
        "$.q: required", "$.x: unknown", "$.n: minimum"]
    assert c.violations([], SCHEMA) == ["$: type"]
    assert c.violations({"q": True, "n": True}, SCHEMA) == ["$.q: type", "$.n: type"]
    deep = {"type": "array", "maxItems": 2, "items": {"enum": ["a", "b"]}}
    assert c.violations(["a", "c", "b"], deep) == ["$: maxItems", "$[1]: enum"]


def test_results_follow_calls_and_references(spark):
    given = tables(spark, messages=[(1, 0, "user", "hi")], calls=[
        (1, 1, "late", "find", '{"q": "x", "of": {"$result": "early"}}'),
        (1, 3, "early", "find", '{"n": 2.0, "q": "y"}'),
        (1, 2, "last", "find", '{"q": "z", "of": [{"$result": "late"}, {"$result": "early"}]}'),
    ], results=[(1, 0, "early", "r1"), (1, 9, "late", "r2"), (1, 4, "early", "again")])
    schemas = {"find": SCHEMA}
    found = c.format_chat(*given, schemas).collect()
    order = [(r.part, r.call_id, r.place) for r in found]
    assert order == [(0, None, 0), (1, "early", 3), (2, "early", 3), (2, "early", 4),
                     (1, "late", 5), (2, "late", 9), (1, "last", 10)]  # also the files' order
    assert [r.status for r in found] == ["ok"] * 6 + ["no_result"]
    assert found[1].json == ('{"role":"assistant","tool_call":{"arguments":{"n":2,"q":"y"},'
                             '"id":"early","name":"find"}}')
    assert found[2].json == '{"content":"r1","id":"early","role":"tool"}'
    assert all(c.canonical(json.loads(r.json)) == r.json for r in found)


def test_statuses(spark):
    found = rows(spark, calls=[
        (1, 1, "a", "find", '{"q": "1", "of": {"$result": "b"}}'),
        (1, 2, "b", "find", '{"q": "1", "of": {"$result": "a"}}'),
        (1, 3, "c", "find", '{"q": "1", "of": {"$result": "b"}}'),
        (2, 1, "d", "find", '{"q": "1", "of": {"$result": "gone"}}'), (2, 2, "e", "other", "{}"),
        (2, 3, "f", "find", "{broken"), (2, 4, "g", "find", None), (2, 5, "h", "find", '{"q":"1"}'),
        (2, 6, "h", "find", '{"q":"2"}'), (2, 5, "h", "find", '{"q":"1"}'),
        (2, 7, None, "find", '{"q":"1"}'), (2, 8, "i", "find", '{"q": NaN}')],
        results=[(2, 9, "h", None), (2, 9, "nothing", "x"), (2, 9, None, "y"), (None, None, "h", "z")])
    told = {(r.call_id, r.turn, r.part): (r.status, r.errors) for r in found}
    assert {told[k, t, 1][0] for k, t in (("a", 1), ("b", 2), ("c", 3))} == {"cycle"}
    assert told["d", 1, 1] == ("invalid", ["$: unknown call gone"])
    assert told["e", 2, 1] == ("invalid", ["$: unknown tool"])
    assert told["f", 3, 1] == ("invalid", ["$: not JSON"])
    assert told["g", 4, 1] == ("invalid", ["$.q: required"])
    assert told["i", 8, 1] == ("invalid", ["$: not JSON"])
    assert told["h", 5, 1][0] == "ok" and told["h", 6, 1][0] == "duplicate"
    assert told[None, 7, 1][0] == "no_result"
    assert told["h", 9, 2][0] == "ok" and told["nothing", 9, 2][0] == "no_call"
    assert told[None, 9, 2][0] == "no_call" and told["h", None, 2][0] == "ok"
    assert len(found) == 15


def test_empty(spark):
    assert rows(spark) == []


def test_query_equals_plain_version(spark, folder):
    turns = {tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()}
    asked = {}
    for conv, turn, role, text in sorted(turns):
        if role == "user":
            asked.setdefault((conv, turn), text)
    start = {}
    for conv, turn in sorted(asked):
        start.setdefault(conv, turn)
    ends = {}
    for conv, turn, role, _ in turns:
        if role == "assistant" and (conv, turn - 1) in asked:
            ends[conv, turn - 1] = max(turn, ends.get((conv, turn - 1), 0))
    place = {}
    for conv, turn in sorted(asked):
        first = conv, start[conv]
        place[conv, turn] = turn if turn == first[1] else max(
            turn, max(place[first], ends.get(first, place[first])) + 1)
    found = c.op9_chat(spark, folder).collect()
    calls = {(r.conv_id, r.turn): (r.place, r.status) for r in found
             if r.part == c.CALL and r.status != "duplicate"}
    assert calls == {k: (p, "ok" if k in ends else "no_result") for k, p in place.items()}
    results = [(r.conv_id, r.turn, json.loads(r.json)["content"], r.place) for r in found
               if r.part == c.RESULT]
    assert sorted(results) == sorted(
        (conv, turn, text, max(turn, place.get((conv, turn - 1), turn)))
        for conv, turn, role, text in turns if role == "assistant")
    assert sum(r.part == c.MESSAGE for r in found) == len(turns)
