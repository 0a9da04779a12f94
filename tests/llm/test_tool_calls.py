"""Tool-call linking."""
from __future__ import annotations

import json
import random

import pytest

from martkit.llm import tool_calls

CALLS = "conv_id long, call_id string, position long, name string, arguments string"
RESULTS = "conv_id long, call_id string, position long, content string"
SCHEMAS = {"add": {"x": ("number", True), "y": ("integer", True), "note": ("string", False)}, "list": {"items": ("array", True), "flag": ("boolean", False), "o": ("object", False)}}


def run(spark, calls, results):
    rows = tool_calls.linked_calls(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), SCHEMAS).collect()
    return {(r.conv_id, r.call_id): r for r in rows}, rows


def test_schemas_and_canonical_json(spark):
    cases = {
        "a": ("add", '{"y": 1, "x": 2.5}', [], '{"x":2.5,"y":1}'),
        "b": ("add", '{"y": "1", "z": 0, "a": 0}', ["missing x", "y is no integer", "unexpected a", "unexpected z"], '{"a":0,"y":"1","z":0}'),
        "c": ("list", '{"o": {"b": [1, {"d": 2, "c": null}], "a": "é\\n"}, "items": [], "flag": true}', [], '{"flag":true,"items":[],"o":{"a":"é\\n","b":[1,{"c":null,"d":2}]}}'),
        "d": ("none", "{}", ["unknown tool none"], "{}"),
        "e": ("add", "[1]", ["arguments are no JSON object"], "[1]"),
        "f": ("add", 'not "json"', ["arguments are no JSON object"], '"not \\"json\\""'),
        "g": (None, "{}", ["unknown tool "], "{}"),
        "h": ("add", None, ["arguments are no JSON object"], None),
        "i": ("add", '{"x": null, "y": 2}', ["x is no number"], '{"x":null,"y":2}'),
    }
    got, _ = run(spark, [(1, k, i, n, a) for i, (k, (n, a, _, _)) in enumerate(cases.items())], [])
    for k, (name, _, errors, canonical) in cases.items():
        assert got[1, k].errors == errors, k
        whole = json.loads(got[1, k].canonical)
        assert list(whole) == sorted(whole) and whole["call_id"] == k and whole.get("name") == name
        assert got[1, k].canonical.startswith('{"arguments":' + canonical + ',"call_id"' if canonical else '{"call_id"')


def test_links_and_copies(spark):
    calls = [(1, "a", 1, "add", "{}"), (1, "a", 5, "add", "{}"), (1, "b", 2, "add", "{}"), (2, "a", 1, "add", "{}"), (None, "n", 1, "add", "{}"), (1, None, 9, "add", "{}")]
    results = [(1, "a", 3, "first"), (1, "a", 4, "second"), (2, "z", 1, "lost"), (1, None, 1, "nameless")]
    got, rows = run(spark, calls, results)
    assert (got[1, "a"].status, got[1, "a"].copies, got[1, "a"].position, json.loads(got[1, "a"].canonical)["result"]) == ("linked", 2, 1, "first")
    assert got[1, "b"].status == got[2, "a"].status == got[None, "n"].status == "open"
    assert got[2, "z"].status == "orphan" and got[1, None].status == "no identifier" and len(rows) == 6
    assert run(spark, [], [])[1] == []


def test_levels(spark):
    rng = random.Random(6)
    calls, want = [], {}
    for conv in range(3):
        level = {}
        for i in range(12):
            uses = rng.sample(range(i), min(i, rng.choice([0, 1, 2])))
            level[i] = 1 + max((level[j] for j in uses), default=-1)
            calls.append((conv, f"c{i}", rng.randrange(50), "add", json.dumps({"note": " ".join(f"${{c{j}}}" for j in uses)})))
        want |= {(conv, f"c{i}"): n for i, n in level.items()}
    calls += [(9, "x", 1, "add", '{"a":"${y}"}'), (9, "y", 1, "add", '{"a":"${x}"}'), (9, "behind", 1, "add", '{"a":"${x} ${free}"}'), (9, "free", 1, "add", '{"a":"${gone}"}')]
    calls += [(10, f"l{i}", i, "add", json.dumps({"note": f"${{l{i - 1}}}" if i else ""})) for i in range(70)]
    calls += [(10, "fork", 100, "add", '{"a":"${l69} ${l3}"}'), (10, "after", 101, "add", '{"a":"${fork}"}'), (10, "on", 102, "add", '{"a":"${after}"}'),
              (10, "both", 103, "add", '{"a":"${on} ${fork}"}')]
    want |= {(10, f"l{i}"): i for i in range(70)} | {(10, "fork"): 70, (10, "after"): 71, (10, "on"): 72, (10, "both"): 73}
    calls += [(11, f"r{i}", i, "add", json.dumps({"note": f"${{r{(i + 1) % 9}}}"})) for i in range(9)] + [(11, "tail", 20, "add", '{"a":"${r3}"}')]
    got, _ = run(spark, calls, [])
    assert {k: got[k].level for k in want} == want
    assert {r.level for k, r in got.items() if k[0] == 11} == {None}
    assert [got[9, k].level for k in ("x", "y", "behind", "free")] == [None, None, None, 0]
    assert "unknown reference gone" in got[9, "free"].errors


@pytest.mark.parametrize("rows", [[], [(1, 0, "user", None), (1, 1, "assistant", None), (None, 1, "assistant", "x"), (1, None, "assistant", "y"), (1, 1, None, "z"), (1, 3, "assistant", "w " * 100_000), (1, 1, "assistant", None)]])
def test_calls_of_awkward_conversations(spark, rows):
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'q' as call_id", "1 as position", "2 as copies")
    got = tool_calls.linked_calls(*tool_calls.calls_of(turns), tool_calls.TOOLS).collect()
    assert len(got) == (5 if rows else 0)
