"""Linking and order of tool calls against a plain version; argument checks."""

import json
import random

import pytest

from gaugeline.llm import chat

CALLS = "conv_id bigint, call_id string, turn int, name string, arguments string, needs array<string>"
RESULTS = "conv_id bigint, call_id string, turn int, content string"
FUNCTIONS = {
    "find": {
        "query": {"kind": "string", "required": True, "longest": 5},
        "limit": {"kind": "integer", "required": False, "least": 1.0, "most": 9.0},
    }
}


def brute_levels(calls):
    """{(conv, call): level or None} of first calls, by walking the needs."""
    firsts = {}
    for conv, call, turn, *_, needs in sorted(calls, key=lambda c: c[2]):
        if conv is not None and call is not None:
            firsts.setdefault((conv, call), needs or [])
    graph = {k: {(k[0], n) for n in needs if (k[0], n) in firsts} for k, needs in firsts.items()}
    found, changed = {}, True
    while changed:
        changed = False
        for call, needs in graph.items():
            if call not in found and all(n in found for n in needs):
                found[call] = max((found[n] + 1 for n in needs), default=0)
                changed = True
    return {call: found.get(call) for call in graph}


def linked(spark, calls, results):
    return chat.link(
        spark.createDataFrame(calls, CALLS).selectExpr("*", "1 as level", "2 as n"),
        spark.createDataFrame(results, RESULTS).selectExpr("*", "1 as answers"),
        chat.schema_table(spark, FUNCTIONS),
    ).collect()


def call(conv, name, turn, *needs):
    return (conv, name, turn, "find", '{"query":"x"}', list(needs))


def test_levels_of_any_graph(spark):
    """Chains, trees, several needs, cycles, chains behind cycles, unknown needs, two conversations."""
    draw = random.Random(4)
    calls = [call(1, f"c{i}", i, *([f"c{i - 1}"] if i else [])) for i in range(70)]
    calls += [call(2, f"c{i}", i, *{f"c{draw.randrange(max(1, i))}" for _ in range(draw.randint(0, 3)) if i}) for i in range(60)]
    calls += [call(3, "a", 0, "b"), call(3, "b", 1, "c"), call(3, "c", 2, "a"), call(3, "d", 3, "c"), call(3, "e", 4, "d")]
    calls += [call(3, "f", 5, "a", "g"), call(3, "g", 6), call(3, "h", 7, "f"), call(3, "self", 8, "self"), call(3, "i", 9, "g", "none")]
    calls += [call(3, "k", 10, "l", "g"), call(3, "l", 11, "k", "g"), call(3, "m", 12, "g", "i"), call(3, "n", 13, "m")]
    rows = linked(spark, calls, [])
    assert {(r.conv_id, r.call_id): r.level for r in rows} == brute_levels(calls)
    cyclic = {r.call_id for r in rows if r.conv_id == 3 and r.status == "cycle"}
    assert cyclic == {"a", "b", "c", "d", "e", "f", "h", "self", "k", "l"}


def test_a_conversation_of_5000_turns(spark):
    """Log rounds, and a plan that does not grow with the depth."""

    def plan(n):
        calls = spark.range(n).selectExpr(
            "7L as conv_id", "string(id) as call_id", "int(id) as turn", "'find' as name",
            "to_json(struct('x' as query)) as arguments", "array(string(id - 1)) as needs",
        )
        results = spark.createDataFrame([], RESULTS)
        return chat.link(calls, results, chat.schema_table(spark, FUNCTIONS))

    long, short = plan(5_000), plan(50)
    assert {(int(r.call_id), r.level) for r in long.collect()} == {(i, i) for i in range(5_000)}
    scans = [df._jdf.queryExecution().optimizedPlan().toString().count("Relation") for df in (long, short)]
    assert scans[0] == scans[1]


def test_status_and_repeats(spark):
    calls = [call(1, "a", 0), call(1, "a", 5), call(1, "a", 5), call(1, "b", 1), call(None, "a", 2), call(1, None, 3)]
    results = [(1, "a", 1, "first"), (1, "a", 2, "later"), (1, "z", 3, "alone"), (None, "a", 4, None), (1, None, 5, "")]
    rows = linked(spark, calls, results)
    found = sorted((str(r.call_id), r.turn, r.status, r.valid) for r in rows)
    assert found == sorted(
        [
            ("a", 0, "linked", True), ("a", 5, "repeated", False), ("a", 5, "repeated", False),
            ("b", 1, "unanswered", False), ("a", 2, "orphan", False), ("None", 3, "orphan", False),
            ("a", 2, "repeated", False), ("z", 3, "orphan", False), ("a", 4, "orphan", False),
            ("None", 5, "orphan", False),
        ]
    )
    message = next(r.message for r in rows if r.status == "linked")
    assert message == '{"arguments":{"query":"x"},"id":"a","name":"find","result":"first","turn":0}'


@pytest.mark.parametrize(
    "arguments,name,errors",
    [
        ('{"query":"abc","limit":3}', "find", None),
        ('{"limit":3}', "find", "missing:query"),
        ('{"query":"abc","more":1}', "find", "unexpected:more"),
        ('{"query":7}', "find", "kind:query"),
        ('{"query":"abcdef","limit":10}', "find", "length:query,range:limit"),
        ('{"query":null}', "find", "kind:query"),
        ("{}", "other", "function"),
        ("{", "find", "arguments"),
        ("[1]", "find", "arguments"),
        (None, "find", "arguments"),
        ("", "find", "arguments"),
    ],
)
def test_arguments(spark, arguments, name, errors):
    (row,) = linked(spark, [(1, "a", 0, name, arguments, None)], [(1, "a", 1, "done")])
    assert (row.errors or None, row.valid) == (errors, errors is None)
    if errors is None:
        assert list(json.loads(row.message)["arguments"]) == ["limit", "query"]


def test_no_rows(spark):
    assert linked(spark, [], []) == []
