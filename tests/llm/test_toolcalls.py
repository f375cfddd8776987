import json

import pytest
from pyspark.sql import functions as F

from crossfeed.llm import toolcalls

SCHEMAS = {"find": {"required": ["q"], "additionalProperties": False,
                    "properties": {"q": {"type": "string", "minLength": 1}, "n": {"type": "integer", "minimum": 1, "maximum": 9},
                                   "how": {"enum": ["a", "b"]}}}, "free": {}}
CALLS = "call_id string, seq long, name string, arguments string, parent_id string"


def linked(spark, calls, results):
    frame = toolcalls.link(spark.createDataFrame(calls, CALLS),
                           spark.createDataFrame(results, "call_id string, seq long, content string"), SCHEMAS)
    return {r["call_id"]: r for r in frame.collect() if r["status"] != "repeated"}


@pytest.mark.parametrize("arguments, errors", [
    ('{"q":"x"}', ""), ('{"q":""}', "q: minLength"), ('{"n":3}', "q: required"), ('{"q":1}', "q: type"),
    ('{"q":"x","n":10}', "n: maximum"), ('{"q":"x","n":1.5}', "n: type"), ('{"q":"x","how":"c"}', "how: enum"),
    ('{"q":"x","z":1}', "z: unknown field"), ("[1]", "no object"), ("{", "no object"), (None, "no object"),
])
def test_arguments(spark, arguments, errors):
    assert linked(spark, [("c", 0, "find", arguments, None)], [])["c"]["errors"] == errors


def test_links_order_and_json(spark):
    calls = [(f"c{i}", i, "free", '{"b": 1.0, "a": "é"}', f"c{i - 1}" if i else None) for i in range(40)]
    calls += [("x", 0, "none", "{}", "y"), ("y", 0, "free", "{}", "x"), ("z", 0, "free", "{}", "y"), ("lost", 1, "free", "{}", "gone"),
              ("c3", 99, "free", "{}", None), (None, 1, "free", "{}", None)]
    rows = linked(spark, calls, [("c1", 2, "late"), ("c1", 1, "ok"), ("orphan", 1, "r"), (None, 1, "r"), ("c2", 1, None)])
    assert [rows[f"c{i}"]["depth"] for i in range(40)] == list(range(40))
    assert {rows[k]["status"] for k in "xyz"} == {"cycle"} and rows["x"]["errors"] == "unknown tool"
    assert rows["lost"]["root_id"] == "lost" and rows["orphan"]["status"] == "orphan"
    assert rows["c3"]["n_calls"] == 2 and rows["c1"]["n_results"] == 2 and rows["c2"]["status"] == "answered"
    text = rows["c1"]["json"]
    assert text == json.dumps(json.loads(text), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert json.loads(text) == {"arguments": {"a": "é", "b": 1}, "depth": 1, "errors": [], "id": "c1", "name": "free",
                                "parent": "c0", "result": "ok", "status": "answered"}


def test_empty(spark):
    assert linked(spark, [], []) == {}


def test_canonical(spark):
    texts = ['{"b":[1, 2],"a":null}', '{"a":1,"a":2}', "", None]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = [r["c"] for r in frame.orderBy("i").select(toolcalls.canonical(F.col("t")).alias("c")).collect()]
    assert found == ['{"a":null,"b":[1,2]}', None, None, None]
