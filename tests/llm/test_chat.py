"""Tool-call linking: statuses, topological order, canonical JSON."""

from __future__ import annotations

import json

from kmerscope.llm import chat

SCHEMAS = {"add": {"x": chat.Param("integer"), "y": chat.Param("number", required=False)}}
MESSAGES = "conv_id long, turn long, role string, text string, line string, `place` long"


def call(ident, arguments, after=(), name="add"):
    return json.dumps({"tool_calls": [{"id": ident, "name": name, "arguments": arguments, "after": list(after)}]})


def result(ident, content="done"):
    return json.dumps({"tool_call_id": ident, "content": content})


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], MESSAGES)
    return chat.format_chats(df, SCHEMAS).orderBy("conv_id", "place", "order", "lift").collect()


def test_statuses(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "assistant", call("a", {"y": 1.5, "x": 2})), (1, 2, "tool", result("a")),
            (1, 3, "assistant", call("a", {"x": 1})), (1, 4, "assistant", call("b", {"x": "no"})), (1, 5, "tool", result("b")),
            (1, 6, "assistant", call("c", {})), (1, 7, "tool", result("c")), (1, 8, "assistant", call("d", {"x": 1, "z": 0})),
            (1, 9, "tool", result("d")), (1, 10, "assistant", call("e", {"x": 1}, name="sub")), (1, 11, "tool", result("e")),
            (1, 12, "assistant", call("f", {"x": 1})), (1, 13, "tool", result("g")), (1, 14, "assistant", call("h", "not json {")),
            (1, 15, "tool", result("h")), (1, 16, "assistant", call(None, {"x": 1})), (1, 17, "assistant", "{broken"), (1, 18, "user", None),
            (None, 0, "assistant", call("a", {"x": 1})), (None, 1, "tool", result("a", "é \"q\"\n"))]
    got = {(r.conv_id, r.turn): r for r in run(spark, rows)}
    status = {k: r.status for k, r in got.items()}
    assert [status[1, t] for t in range(19)] == [
        "ok", "valid", "ok", "duplicate", "type:x", "ok", "missing:x", "ok", "extra", "ok", "unknown_tool", "ok", "unanswered",
        "orphan", "not_an_object", "ok", "no_identifier", "ok", "ok"]
    assert status[None, 0] == "valid" and got[None, 1].linked_turn == 0
    assert got[1, 1].json == '{"arguments":{"x":2,"y":1.5},"id":"a","kind":"call","name":"add","role":"assistant"}'
    assert json.loads(got[None, 1].json)["content"] == "é \"q\"\n"
    assert got[1, 14].json.startswith('{"arguments":{"text":"not json {"}')


def test_order_follows_links(spark):
    rows = [(1, 0, "tool", result("b")), (1, 1, "assistant", call("b", {"x": 1}, ["a"])), (1, 2, "tool", result("a")),
            (1, 3, "assistant", call("a", {"x": 1})), (2, 0, "assistant", call("p", {"x": 1}, ["q"])),
            (2, 1, "assistant", call("q", {"x": 1}, ["p"])), (2, 2, "user", "hi"), (3, 0, "assistant", call("s", {"x": 1}, ["s", "none"]))]
    got = run(spark, rows)
    assert [r.turn for r in got if r.conv_id == 1] == [3, 2, 1, 0]
    assert {r.turn: r.status for r in got if r.conv_id == 2} == {0: "cyclic", 1: "cyclic", 2: "ok"}
    assert [r.status for r in got if r.conv_id == 3] == ["unanswered"]


def test_repeated_rows_and_nothing(spark):
    got = run(spark, [(1, 0, "assistant", call("a", {"x": 1}))] * 3 + [(1, 1, "tool", result("a"))] * 2)
    assert sorted(r.status for r in got) == ["duplicate", "duplicate", "ok", "ok", "valid"]
    assert chat.format_chats(spark.createDataFrame([], MESSAGES), SCHEMAS).count() == 0


def test_words_beside_calls_are_a_line_before_them(spark):
    calls = [{"id": i, "name": "add", "arguments": {"x": 1}} for i in "ab"]
    rows = [(1, 0, "assistant", json.dumps({"content": "let me add", "tool_calls": calls})), (1, 1, "tool", result("a")),
            (1, 2, "tool", result("b")), (2, 0, "assistant", json.dumps({"content": "", "tool_calls": calls[:1]})), (2, 1, "tool", result("a")),
            (3, 0, "assistant", json.dumps({"content": None, "tool_calls": [None, calls[0]]})), (3, 1, "tool", result("a"))]
    got = run(spark, rows)
    assert [(r.turn, r.sub, r.kind, r.status) for r in got if r.conv_id == 1] == [
        (0, -1, "message", "ok"), (0, 0, "call", "valid"), (0, 1, "call", "valid"), (1, 0, "result", "ok"), (2, 0, "result", "ok")]
    assert next(r.json for r in got if r.sub == -1) == '{"content":"let me add","kind":"message","role":"assistant"}'
    assert [(r.sub, r.kind) for r in got if r.conv_id == 2] == [(0, "call"), (0, "result")]
    assert [(r.sub, r.kind) for r in got if r.conv_id == 3] == [(0, "call"), (1, "call"), (0, "result")]


def test_white_space_before_json(spark):
    """JSON white space before a call or a result is no part of a message."""
    rows = [(1, 0, "assistant", "\n\t \r" + call("a", {"x": 1})), (1, 1, "tool", "\t\n" + result("a"))]
    got = run(spark, rows)
    assert [(r.kind, r.status) for r in got] == [("call", "valid"), ("result", "ok")] and got[1].linked_turn == 0
