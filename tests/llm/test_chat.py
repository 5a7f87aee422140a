import json

from cropledger.llm import chat

CALLS = "conv_id long, turn long, call_id string, name string, arguments string, depends_on array<string>, level int"
RESULTS = "conv_id long, turn long, call_id string, content string, status string"


def rows(spark, calls, results=()):
    c = spark.createDataFrame([(*x, 9) for x in calls], CALLS)
    r = spark.createDataFrame([(*x, "s") for x in results], RESULTS)
    return {(r.kind, r.conv_id, r.turn): r for r in chat.link(c, r, chat.schema_table(spark)).collect()}


def test_links_levels_and_violations(spark):
    good = json.dumps({"turn": 1, "query": "a\n\"é/"})
    out = rows(
        spark,
        [
            (1, 0, "a", "search", good, None), (1, 1, "b", "search", good, ["a"]), (1, 2, "c", "lookup", '{"query":1,"turn":2,"more":[]}', ["a", "b", "zz"]),
            (1, 3, "d", "nothing", "{}", ["e"]), (1, 4, "e", "search", "[1]", ["d"]), (1, 5, "f", "search", "oops", ["e"]), (1, 6, "a", "search", None, []), (2, 0, "a", "search", good, ["b"]),
        ],
        [(1, 7, "a", "yes"), (1, 8, "a", None), (1, 9, "q", "lost"), (3, 0, "a", "other"), (None, 1, None, "x")],
    )
    call = lambda t, c=1: out["call", c, t]
    assert [call(t).level for t in range(6)] == [0, 1, 2, None, None, None]
    assert [call(t).status for t in range(7)] == ["linked", "unanswered", "unanswered", "cyclic", "cyclic", "cyclic", "repeated"]
    assert call(0, 2).status == "unanswered" and call(0, 2).level == 0
    assert call(0).violations == "" and call(2).violations == "missing exact; unknown more; wrong type query"
    assert call(3).violations == "unknown tool" and call(4).violations == call(5).violations == "arguments are not an object"
    assert call(0).json == '{"arguments":{"query":"a\\n\\"é/","turn":1},"id":"a","name":"search","type":"call"}'
    assert json.loads(call(5).json)["arguments"] is None
    assert [out["result", 1, t].status for t in (7, 8, 9)] == ["linked", "linked", "orphan"] and out["result", 1, 8].json == '{"call_id":"a","content":null,"type":"result"}'
    assert out["result", 3, 0].status == "orphan" and out["result", None, 1].status == "orphan"


def test_levels_of_any_graph(spark):
    import random

    rng = random.Random(3)
    calls, want = [], {}
    for conv in range(25):
        n = rng.choice([1, 5, 30])
        names = [f"k{i}" for i in range(n)]
        needs = {c: [] for c in names}
        for i, c in enumerate(names):
            needs[c] = rng.sample(names[:i], min(i, rng.choice([0, 1, 1, 1, 2, 3])))
            if conv % 3 == 0 and rng.random() < 0.1:
                needs[c].append(rng.choice(names))
        level = {}
        for _ in names:
            level |= {c: max((level[d] + 1 for d in needs[c]), default=0) for c in names if all(d in level for d in needs[c])}
        calls += [(conv, i, c, None, None, needs[c]) for i, c in enumerate(names)]
        want |= {(conv, c): level.get(c) for c in names}
    calls += [(99, i, f"c{i}", None, None, [f"c{i - 1}"]) for i in range(300)]
    want |= {(99, f"c{i}"): i for i in range(300)}
    got = {(r.conv_id, r.call_id): r.level for r in chat.levels(spark.createDataFrame([(*c, 0) for c in calls], CALLS)).collect()}
    assert all(got.get(k, 0) == v for k, v in want.items())


def test_empty(spark):
    assert rows(spark, []) == {}


def test_every_turn_has_a_row_with_its_whole_text(spark):
    import duckdb

    from cropledger.llm import queries

    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{sf}/conversations.parquet'")
    names = ["conv_id", "turn", "kind", "call_id", "level", "status", "violations", "json"]
    got = [tuple(r) for r in queries.op3_chat(spark, sf).select(*names).collect()]
    assert sorted(got, key=str) == sorted(con.execute(f"select {', '.join(names)} from ({chat.SQL})").fetchall(), key=str)
    turns = con.execute("select conv_id, turn, role, text from conversations").fetchall()
    rows = sorted((r[0], r[1], str(json.loads(r[7]).get("content", ((a := json.loads(r[7]).get("arguments")) or {}).get("query", (a or {}).get("text"))))) for r in got)
    assert rows == sorted((c, t, str(x if r != "user" else x or "")) for c, t, r, x in turns) and len(rows) == 536


def test_turns_of_any_role(spark):
    turns = [(1, 0, "system", "be brief"), (1, 1, None, None), (1, 2, "user", "é\"x"), (1, 3, "assistant", "ok"), (1, 4, "tool", "42"), (None, None, "critic", "no")]
    out = {r.turn: r for r in chat.link_turns(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")).collect()}
    assert len(out) == 6 and [out[t].kind for t in (0, 1, 2, 3, 4, None)] == ["message", "message", "call", "result", "message", "message"]
    assert out[1].json == '{"content":null,"role":null,"type":"message"}' and out[4].json == '{"content":"42","role":"tool","type":"message"}'
    assert json.loads(out[2].json)["arguments"] == {"length": 3, "text": "é\"x", "turn": 2} and out[2].violations == "wrong type turn"


def test_ties_and_nulls(spark):
    calls = spark.createDataFrame(
        [(1, 3, "a", "search", '{"query":"x","turn":1}', None, 0), (1, 3, "a", "search", '{"query":"y","turn":1}', None, 0), (1, 3, "a", "search", '{"query":"y","turn":1}', None, 0), (1, None, "b", "search", None, None, 0), (1, 1, "b", "search", "{}", None, 0), (None, 1, "b", None, None, None, 0)],
        "conv_id long, turn long, call_id string, name string, arguments string, depends_on array<string>, level int",
    )
    results = spark.createDataFrame([(1, 4, "a", None), (None, None, None, "z")], "conv_id long, turn long, call_id string, content string")
    out = chat.link(calls, results, chat.schema_table(spark)).collect()
    status = lambda **k: sorted(r.status for r in out if r.kind == "call" and all(r[c] == v for c, v in k.items()))
    assert len(out) == 8 and status(call_id="a") in (["linked", "repeated", "repeated"], ["linked", "linked", "repeated"])
    assert status(call_id="b", conv_id=1, turn=None) == ["unanswered"] and status(call_id="b", conv_id=1, turn=1) == ["repeated"] and status(conv_id=None) == ["unanswered"]
    assert chat.link(calls.limit(0), results.limit(0), chat.schema_table(spark)).collect() == []


def test_nested_arguments_and_a_diamond_of_calls(spark):
    """An order is planned from two look-ups that both need a search; arguments hold objects and lists, which keep their order."""
    schemas = spark.createDataFrame(
        [("find", "q", "string", True), ("plan", "steps", "array", True), ("plan", "limits", "object", True), ("plan", "share", "number", False), ("plan", "note", "null", False)],
        "name string, parameter string, type string, required boolean",
    )
    plan = {"limits": {"b": [1, {"z": None, "a": True}], "a": {"y": 2.5, "x": "é\n"}}, "steps": [["s", 2], {}, []], "share": 3, "note": None}
    calls = [
        (1, 0, "s", "find", '{"q":"x"}', None), (1, 1, "l", "find", '{"q":"l"}', ["s"]), (1, 2, "r", "find", '{"q":"r"}', ["s", "s"]),
        (1, 5, "p", "plan", json.dumps(plan), ["l", "r", "s"]), (1, 3, "w", "plan", '{"steps":{"a":1},"limits":[],"share":"3"}', ["p"]), (1, 4, "n", "plan", '{"limits":{"steps":[]}}', []),
    ]
    df = spark.createDataFrame([(*x, 0) for x in calls], CALLS)
    answers = spark.createDataFrame([(1, 6, "p", '{"ok": [true]}', "s")], RESULTS)
    out = {(r.kind, r.call_id): r for r in chat.link(df, answers, schemas).collect()}
    assert [out["call", c].level for c in "slrpwn"] == [0, 1, 1, 2, 3, 0]
    assert out["call", "p"].violations == "" and out["call", "p"].status == "linked" and out["result", "p"].level == 2
    assert out["call", "w"].violations == "wrong type limits; wrong type share; wrong type steps" and out["call", "n"].violations == "missing steps"
    want = json.dumps({"arguments": plan, "id": "p", "name": "plan", "type": "call"}, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert out["call", "p"].json == want
    assert json.loads(out["result", "p"].json)["content"] == '{"ok": [true]}'
