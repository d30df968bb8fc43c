"""Chat formatting: links, levels, validation and canonical lines."""

import json
import random

from opstelemetry.llm import chat

EVENTS = "conv_id long, turn int, kind string, call_id string, after_id string, name string, arguments string, content string, level string"


def event(conv, turn, kind, call, after=None, name="search", arguments='{"query": "q", "limit": 3}', content=None):
    own = (name, arguments) if kind == "call" else (None, None)
    return (conv, turn, kind, call, after, *own, content, "clash")


def run(spark, events):
    frame = spark.createDataFrame(events, EVENTS)
    return [r.asDict() for r in chat.formatted(frame, chat.tool_table(spark)).orderBy("conv_id", "position").collect()]


def test_order_links_and_errors(spark):
    events = [
        event(1, 5, "call", "a"),
        event(1, 1, "result", "a", content='say "hi"\n'),
        event(1, 0, "call", "b", after="a"),
        event(1, 2, "result", "b", content=None),
        event(1, 9, "result", "gone"),
        event(1, 9, "result", None),
        event(2, 0, "call", "x", after="y"),
        event(2, 1, "call", "y", after="x"),
        event(2, 2, "result", "y"),
        event(3, 0, "call", "d"),
        event(3, 4, "call", "d"),
        event(None, 0, "call", "n"),
    ]
    got = run(spark, events)
    first = [(r["call_id"], r["kind"], r["level"]) for r in got if r["conv_id"] == 1 and r["link_error"] is None]
    assert first == [("a", "call", 0), ("a", "result", 1), ("b", "call", 2), ("b", "result", 3)]
    assert [r["position"] for r in got if r["conv_id"] == 1] == list(range(6))
    assert {r["link_error"] for r in got if r["conv_id"] == 2} == {"cycle"}
    assert [r["link_error"] for r in got if r["conv_id"] == 3] == [None, "duplicate id"]
    assert len(got) == len(events)
    line = json.loads(next(r["line"] for r in got if r["kind"] == "result" and r["call_id"] == "a"))
    assert line == {"content": 'say "hi"\n', "id": "a", "type": "result"}


def test_validation_and_canonical_json(spark):
    cases = [
        ('{"query": "q", "limit": 3}', ""),
        ('{ "strict": true,\n "query": "é" }', ""),
        ('{"limit": 3}', "missing query"),
        ('{"query": 1}', "type of query"),
        ('{"query": "q", "more": []}', "unknown more"),
        ("[1]", "no JSON object"),
        ("{", "no JSON object"),
        (None, "no JSON object"),
    ]
    got = run(spark, [event(1, i, "call", str(i), arguments=a) for i, (a, _) in enumerate(cases)])
    assert [r["errors"] for r in got] == [e for _, e in cases]
    assert got[1]["line"] == '{"arguments":{"query":"é","strict":true},"id":"1","name":"search","type":"call"}'
    odd = run(spark, [event(1, 0, "call", "1", name="other")])
    assert odd[0]["errors"] == "unknown tool" and not odd[0]["valid"]


def test_long_chain_and_empty(spark):
    chain = [event(1, i, "call", str(i), after=str(i - 1) if i else None) for i in range(40)]
    got = run(spark, chain)
    assert [r["level"] for r in got] == list(range(40))
    assert run(spark, []) == []


def test_messages_and_turns_of_any_role(spark):
    got = run(spark, [event(1, 3, "message", None, name="system", content="be brief"), event(1, 1, None, "a"), event(1, 2, "call", "a")])
    assert [(r["kind"], r["level"], r["link_error"], r["errors"]) for r in got] == [
        (None, 0, None, ""), ("call", 0, None, ""), ("message", 0, None, "")
    ]
    turns = [(1, 0, "system", "s"), (1, 1, "user", "hello"), (1, 2, "assistant", "yes"), (1, 3, None, None), (None, None, "tool", "x"), (1, 0, "system", "s")]
    made = chat.events_of(spark.createDataFrame(turns, "conv_id long, turn int, role string, text string"))
    kinds = sorted((r["kind"], r["name"] or "") for r in made.collect())
    assert kinds[0][0] == "call" and kinds[1:] == [("message", ""), ("message", "system"), ("message", "system"), ("message", "tool"), ("result", "")]
    assert chat.formatted(made, chat.tool_table(spark)).count() == len(turns)


def test_one_form_of_a_number(spark):
    cases = [
        ('{"query": "1.0 1e2 \\\\\\" 3.0", "limit": 3.0}', '{"limit":3,"query":"1.0 1e2 \\\\\\" 3.0"}', ""),
        ('{"query": "q", "limit": 1e2}', '{"limit":100,"query":"q"}', ""),
        ('{"query": "q", "limit": 12345678901234567890}', '{"limit":12345678901234567890,"query":"q"}', ""),
        ('{"query": "q", "limit": -2.50}', '{"limit":-2.5,"query":"q"}', "type of limit"),
        ('{"query": "q", "more": [1.0, {"x": 0.0000001, "y": 1E-7}]}', '{"more":[1,{"x":1.0E-7,"y":1.0E-7}],"query":"q"}', "unknown more"),
        ('{"query": "' + "a-1.0\\\\n" * 20000 + '"}', '{"query":"' + "a-1.0\\\\n" * 20000 + '"}', ""),
    ]
    got = run(spark, [event(1, i, "call", str(i), arguments=a) for i, (a, _, _) in enumerate(cases)])
    for r, (_, text, errors) in zip(got, cases, strict=True):
        assert r["line"].startswith('{"arguments":' + text + ',"id":') and r["errors"] == errors


def brute(events):
    """Links, levels and errors of every event by walking its chain."""
    calls, answers, up = {}, {}, {}
    for conv, turn, kind, call, *_ in events:
        if call is not None and kind in ("call", "result"):
            table = calls if kind == "call" else answers
            table[conv, call] = min(turn, table.get((conv, call), turn))

    def node(conv, turn, kind, call):
        return None if call is None else (conv, "c", call) if kind == "call" else (conv, "r", turn, call)

    def waits(conv, kind, call, after):
        target = after if kind == "call" else call
        if (conv, target) not in calls:
            return None
        return (conv, "r", answers[conv, target], target) if kind == "call" and (conv, target) in answers else (conv, "c", target)

    for conv, turn, kind, call, after, *_ in events:
        if kind in ("call", "result") and (me := node(conv, turn, kind, call)):
            known = [x for x in (up.get(me), waits(conv, kind, call, after)) if x]
            up[me] = min(known, key=lambda x: (x[1], str(x[2]), str(x[-1])), default=None)
    for conv, turn, kind, call, after, *_ in events:
        if kind not in ("call", "result"):
            yield conv, turn, kind, call, 0, None
            continue
        level, at, path = 0, up.get(node(conv, turn, kind, call)), set()
        while at and at not in path:
            path.add(at)
            level, at = level + 1, up[at]
        target = after if kind == "call" else call
        lost = (conv, target) not in calls and (kind == "result" or after is not None)
        error = "duplicate id" if kind == "call" and calls.get((conv, call), turn) < turn else "unlinked" if lost else None
        yield conv, turn, kind, call, None if at else level, "cycle" if at else error


def test_brute_force(spark):
    rnd = random.Random(3)
    ids = ["a", "b", "c", "d", "e", None]
    events = []
    for conv in [*range(25), None]:
        for turn in range(rnd.randint(0, 9)):
            call = rnd.choice(ids)
            # one call of an identifier waits for one other, always the same
            after = {"a": None, "b": "a", "c": "b", "d": "e" if (conv or 0) % 3 else "zz", "e": "d"}.get(call)
            events.append(event(conv, rnd.choice([turn, turn, 1]), rnd.choice(["call", "result", "call", "message"]), call, after))
    events += events[:5]
    got = run(spark, events)
    columns = ("conv_id", "turn", "kind", "call_id", "level", "link_error")
    assert sorted(repr(tuple(r[c] for c in columns)) for r in got) == sorted(map(repr, brute(events)))
    for conv in {e[0] for e in events}:
        own = [r for r in got if r["conv_id"] == conv]
        assert [r["position"] for r in own] == list(range(len(own)))
        order = [(r["level"] is None, r["level"] or 0, r["turn"], r["kind"], r["call_id"] or "") for r in own]
        assert order == sorted(order)
