"""Operator 2: linking, order, schema errors, canonical JSON, edge cases."""

import json

from auditlens.llm.chat import depths, format_messages, link_calls


def call(id_, name="measure", arguments=None, after=(), **more):
    return "<tool_call>" + json.dumps({"id": id_, "name": name, "arguments": {"chars": 1} if arguments is None else arguments, "after": list(after), **more}) + "</tool_call>"


def result(id_, content):
    return "<tool_result>" + json.dumps({"id": id_, "content": content}) + "</tool_result>"


def run(spark, rows):
    df = spark.createDataFrame(rows, "conv_id LONG, turn LONG, role STRING, text STRING").selectExpr("*", "'x' AS depth", "1 AS status")
    return link_calls(df).collect()


def test_links_order_and_json(spark):
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "so " + call("b", after=["a"]) + call("a", "search", {"query": "é\"x", "limit": 3}) + " end"),
        (1, 2, "tool", result("a", "found\nit") + result("b", "2")), (1, 3, "tool", result("a", "later")),
        (2, 1, "assistant", call("a")), (2, 2, "tool", None)]
    got = {(r.conv_id, r.call_id): r for r in run(spark, rows)}
    assert [got[1, c].step for c in "ab"] == [0, 1] and [got[1, c].depth for c in "ab"] == [0, 1]
    assert got[1, "a"].status == "ok" and got[1, "a"].result_turn == 2
    assert got[2, "a"].status == "no_result" and got[2, "a"].result_turn is None
    assert got[1, "a"].call_json == ('{"after":[],"arguments":{"limit":3,"query":"é\\"x"},"depth":0,"id":"a","name":"search",'
                                     '"result":"found\\nit","result_turn":2,"status":"ok","turn":1}')


def test_schema_errors(spark):
    cases = {"m1": ("measure", {}), "m2": ("measure", {"chars": "1"}), "m3": ("measure", {"chars": 1, "note": 2, "zz": 1}), "s1": ("search", {"query": "q", "limit": 1.5}),
             "u1": ("nothing", {}), "q1": ("quote", {"query": "q", "exact": "no"}), "ok": ("quote", {"query": "q", "exact": True}), "list": ("measure", [1])}
    text = "".join(call(i, n, a) for i, (n, a) in cases.items()) + '<tool_call>{"id":"none"}</tool_call>'
    got = {r.call_id: r.status for r in run(spark, [(1, 1, "assistant", text)])}
    assert got == {"m1": "missing_chars", "m2": "type_chars", "m3": "type_note,unknown_zz", "s1": "type_limit", "u1": "unknown_tool",
                   "q1": "type_exact", "ok": "no_result", "list": "missing_chars", "none": "unknown_tool"}


def test_cycles_duplicates_malformed(spark):
    rows = [
        (1, 1, "assistant", call("x", after=["y"]) + call("y", after=["x"]) + call("z", after=["y"]) + call("s", after=["s"]) + call("l", after=["nowhere"])),
        (1, 3, "assistant", call("x") + "<tool_call>{bad</tool_call>" + '<tool_call>{"name":"measure"}</tool_call>'),
        (1, 3, "assistant", call("x") + "<tool_call>{bad</tool_call>" + '<tool_call>{"name":"measure"}</tool_call>'),
        (None, None, None, call("n")), (3, 1, "assistant", ""), (3, 2, "assistant", None)]
    got = run(spark, rows)
    status = sorted((r.call_id or "", r.status) for r in got)
    assert status == [("", "malformed"), ("", "malformed"), ("l", "unknown_dependency"), ("n", "no_result"), ("s", "cyclic"),
                      ("x", "cyclic"), ("x", "duplicate"), ("y", "cyclic"), ("z", "cyclic")]
    steps = sorted(r.step for r in got if r.conv_id == 1)
    assert steps == list(range(len(steps)))


def test_long_conversation_is_numbered_in_blocks(spark):
    rows = [(7, t, "assistant", call(f"c{t}", after=[f"c{t - 1}"] if t % 3 else [])) for t in range(2500)]
    got = sorted(run(spark, rows), key=lambda r: r.step)
    assert [r.step for r in got] == list(range(2500))
    assert [(r.depth, r.turn) for r in got] == sorted((r.depth, r.turn) for r in got)


def test_empty(spark):
    none = spark.createDataFrame([], "conv_id LONG, turn LONG, role STRING, text STRING")
    assert run(spark, []) == [] and format_messages(none).collect() == []


def test_a_stray_result_before_the_call_hides_no_later_one(spark):
    rows = [(1, 0, "tool", result("a", "stray")), (1, 1, "assistant", call("a")), (1, 1, "tool", result("a", "same turn")), (1, 2, "tool", result("a", "real")), (1, 3, "tool", result("a", "late"))]
    [r] = run(spark, rows)
    assert (r.status, r.result_turn) == ("ok", 2) and '"result":"real"' in r.call_json


def test_messages_are_formatted_in_order(spark):
    long = "é\"\n" * 30_000
    rows = [(1, 0, "system", "be brief"), (1, 1, "user", None), (1, 2, "assistant", "see " + call("b", after=["a"]) + call("a", "search", {"query": long, "limit": 3}) + " now"),
            (1, 3, "tool", result("a", "r") + " tail"), (1, 3, "tool", result("a", "r") + " tail"), (1, 3, "assistant", "x"), (None, 0, None, call("n")), (2, None, "user", "")]
    df = spark.createDataFrame(rows, "conv_id LONG, turn LONG, role STRING, text STRING").selectExpr("*", "'x' AS position", "1 AS _calls")
    got = {(r.conv_id, r.position): r for r in format_messages(df).collect()}
    assert sorted(got, key=repr) == sorted([(1, 0), (1, 1), (1, 2), (1, 3), (1, 4), (None, 0), (2, 0)], key=repr)
    assert got[1, 0].message_json == '{"calls":[],"content":"be brief","role":"system","turn":0}'
    assert got[1, 1].message_json == '{"calls":[],"content":null,"role":"user","turn":1}'
    whole = json.loads(got[1, 2].message_json)
    assert whole["content"] == "see  now" and [c["id"] for c in whole["calls"]] == ["b", "a"] and whole["calls"][1]["arguments"]["query"] == long
    assert (got[1, 2].n_calls, got[1, 2].n_ok) == (2, 1) and list(whole) == sorted(whole)
    assert [got[1, p].role for p in (3, 4)] == ["assistant", "tool"] and json.loads(got[1, 4].message_json)["content"] == " tail"
    assert json.loads(got[None, 0].message_json)["role"] is None and got[2, 0].turn is None


def test_messages_of_one_turn_keep_their_calls(spark):
    rows = [(1, 1, "assistant", call("a")), (1, 1, "critic", call("a") + call("b")), (1, 1, "critic", "plain")]
    got = sorted(format_messages(spark.createDataFrame(rows, "conv_id LONG, turn LONG, role STRING, text STRING")).collect(), key=lambda r: r.position)
    ids = [[(c["id"], c["status"]) for c in json.loads(r.message_json)["calls"]] for r in got]
    assert sorted(map(len, ids)) == [0, 1, 2]
    assert sorted(x for i in ids for x in i if x[0] == "a") == [("a", "duplicate"), ("a", "no_result")]


def longest_chains(after):
    """Depth of each call by going down its dependencies; none on a cycle."""
    depth, state = {}, {}

    def visit(x):
        if state.get(x) == "open":
            return None
        if x not in state:
            state[x] = "open"
            below = [visit(d) for d in after[x] if d in after]
            depth[x] = None if None in below else max(below, default=-1) + 1
            state[x] = "done"
        return depth[x]

    for x in after:
        visit(x)
    return depth


def test_depths_equal_a_plain_search(spark):
    import random

    rng = random.Random(4)
    rows = []
    for conv in range(12):
        n = rng.choice([1, 5, 30, 60])
        rows += [(str(conv), f"c{i}", sorted({f"c{rng.randrange(max(0, i - 4), i)}" for _ in range(rng.choice([0, 1, 1, 1, 2, 3]))} if i else [])) for i in range(n)]
        if conv % 3 == 0:
            rows += [(str(conv), "x", ["y"]), (str(conv), "y", ["z"]), (str(conv), "z", ["x", "c0"]), (str(conv), "after", ["c0", "x"]), (str(conv), "later", ["after"]), (str(conv), "s", ["s"]), (str(conv), "t", ["s"])]
    got = {(r.conv_id, r.call_id): r.depth for r in depths(spark.createDataFrame(rows, "conv_id STRING, call_id STRING, after ARRAY<STRING>")).collect()}
    want = {}
    for conv in {r[0] for r in rows}:
        after = {i: a for c, i, a in rows if c == conv}
        reach = {}
        for x in after:  # all that a call builds on, itself only on a cycle
            seen, todo = set(), list(after[x])
            while todo:
                d = todo.pop()
                if d in after and d not in seen:
                    seen.add(d)
                    todo += after[d]
            reach[x] = seen
        cyclic = {x for x in after if any(y in reach[y] for y in reach[x] | {x})}
        plain = longest_chains({x: a for x, a in after.items() if x not in cyclic})
        want |= {(conv, x): d for x, d in plain.items()}
    assert got == want


def test_a_chain_of_5000_calls_takes_few_rounds(spark, monkeypatch):
    from auditlens.llm import chat

    names = []
    plain = chat.written
    monkeypatch.setattr(chat, "written", lambda df, name="llm": names.append(name) or plain(df, name))
    calls = spark.range(5000).selectExpr("'1' AS conv_id", "concat('c', id) AS call_id", "if(id > 0, array(concat('c', id - 1)), array()) AS after")
    rows = depths(calls).collect()
    assert all(r.depth == int(r.call_id[1:]) for r in rows) and len(rows) == 5000
    assert names.count("chat-pointers") <= 15
