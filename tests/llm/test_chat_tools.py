from __future__ import annotations

import json
import random
from collections import Counter, defaultdict
from decimal import Decimal

from pyspark.sql import functions as F

from newslake.llm import chat_tools

CALLS = "conv_id long, turn long, call_id string, tool string, arguments string, refers array<string>, status string"
RESULTS = "conv_id long, turn long, call_id string, content string, position long"


def test_linking_order_and_faults(spark):
    ok = '{"query": "x", "limit": 3}'
    calls = [
        (1, 1, "a", "search", ok, None, "s"),
        (1, 3, "b", "search", '{"limit":2.50,"query":"é\\n"}', ["a"], "s"),
        (1, 2, "c", "lookup", '{"key":1,"odd":null}', ["b"], "s"),
        (1, 5, "a", "search", ok, [], "s"),  # an id called twice
        (2, 1, "x", "calculate", '{"left":1,"right":2.5,"operator":"+"}', ["y"], "s"),
        (2, 2, "y", "calculate", '{"left":1,"right":', ["x"], "s"),  # a cycle, and no JSON
        (2, 3, "z", "dance", None, ["gone"], "s"),
        (None, 1, "q", "search", ok, [], "s"),
        (3, 1, None, "search", "[1]", [], "s"),
    ]
    results = [(1, 2, "a", "first", 9), (1, 4, "a", "second", 9), (1, 4, "b", None, 9), (4, 1, "n", "lost", 9), (None, 1, "q", "r", 9)]
    rows = chat_tools.link(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS)).collect()
    assert len(rows) == len(calls) + 3
    by = {(r.conv_id, r.call_id, r.turn): r for r in rows}
    a, b, c = by[1, "a", 1], by[1, "b", 3], by[1, "c", 2]
    assert [r.level for r in (a, b, c)] == [0, 1, 2]
    assert [r.position for r in (a, b, c)] == [1, 2, 3]
    assert (a.status, a.n_results, a.faults) == ("linked", 2, [])
    assert a.canonical == '{"arguments":{"limit":3,"query":"x"},"call_id":"a","result":"first","tool":"search"}'
    assert b.faults == ["limit is not integer"] and json.loads(b.canonical)["result"] is None
    assert c.status == "no result" and c.faults == ["key is not string", "unexpected odd"]
    assert by[1, "a", 5].status == "duplicate"
    assert by[2, "x", 1].level is None and by[2, "y", 2].level is None
    assert by[2, "y", 2].faults == ["malformed arguments"]
    assert by[2, "z", 3].faults == ["malformed arguments", "unknown tool", "unknown reference gone"]
    assert by[None, "q", 1].status in ("unlinked", "no call") and by[4, "n", 1].status == "no call"
    assert by[3, None, 1].status == "unlinked" and by[3, None, 1].faults == ["malformed arguments"]
    further = by[1, "a", 4]
    assert (further.status, further.level, json.loads(further.canonical)["result"]) == ("further result", None, "second")
    for r in rows:
        json.loads(r.canonical)


def test_every_turn_is_in_the_result(spark):
    turns = [(1, 0, "system", "be brief"), (1, 1, "user", "question"), (1, 2, "tool", "said by a tool"), (1, 3, None, "said by nobody"),
             (1, 4, "assistant", "after nobody"), (1, 5, "user", "last words"), (None, 1, "assistant", "nowhere"), (1, None, "assistant", "some time"), (1, 6, "system", None)]
    turns += [(2, 2 * i + k, role, f"{role} {i}") for i in range(60) for k, role in enumerate(("user", "assistant"))]
    calls, results = chat_tools.logged_calls(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    rows = chat_tools.link(calls, results).collect()
    by = {(r.conv_id, r.turn): r for r in rows}
    assert len(by) == len(rows) == len(turns) - 60
    users = {(c, t) for c, t, role, _ in turns if role == "user"}
    for conv, turn, role, text in turns:
        if role == "assistant" and turn is not None and (conv, turn - 1) in users:
            call = by[conv, turn - 1]
            assert call.status == "linked" and json.loads(call.canonical)["result"] == text
        elif role != "user":
            row = by[conv, turn]
            assert row.status == "no call" and json.loads(row.canonical)["result"] == text
            assert (row.call_id is None) == (role != "assistant" or turn is None)
    assert by[1, 1].status == by[1, 5].status == "no result"


def test_empty_tables(spark):
    assert chat_tools.link(spark.createDataFrame([], CALLS), spark.createDataFrame([], RESULTS)).count() == 0


def test_numbers_have_one_form_and_nothing_follows_a_value(spark):
    same = [["1e2", "100", "100.0", "1.00E+2"], ["1e-7", "0.0000001", "100e-9"], ["0", "-0.0", "0e5"], ["-12.3400", "-1234e-2"],
            ["12345678901234567890", "12345678901234567890.0"], ["1.5e300", "15E299"], ["1e-50", "0.1e-49"]]
    bad = ['{"a":1} trailing', '{"a":1},2', '{"a":1}],[2', '{"a":1}},{"x":1', '{"a":1}}', '{"a":01}', "", None, '{"a":1,"a":2}']
    texts = [f'{{"a":{n}}}' for group in same for n in group] + bad
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").withColumn("parsed", chat_tools._parsed(F.col("t")))
    kind = chat_tools._kinds({"t": {"a": ("integer", True)}})["a"]
    got = {r.i: r for r in rows.select("i", chat_tools._canonical(F.col("parsed")).alias("c"), kind.alias("k")).collect()}
    at = 0
    for group in same:
        forms = {got[at + j].c for j in range(len(group))}
        assert len(forms) == 1, forms
        value = Decimal(forms.pop()[5:-1])
        assert value == Decimal(group[0])
        assert {got[at + j].k for j in range(len(group))} == {"INTEGER" if value == value.to_integral_value() else "NUMBER"}
        at += len(group)
    assert all(got[i].c is None and got[i].k is None for i in range(at, len(texts)))
    quoted = json.dumps({"q": 'x "1e2" \\ 3.0 ' + '\\"' * 30000 + "y" * 100000}, separators=(",", ":"))
    long = spark.createDataFrame([(quoted,)], "t string").select(chat_tools._canonical(chat_tools._parsed(F.col("t"))).alias("c"))
    assert json.loads(long.first().c) == json.loads(quoted)


def plain_link(calls, results):
    """(conv, call id, turn, status, level, number of results) of every row, counted."""
    by_id, answers = defaultdict(list), defaultdict(list)
    for c in calls:
        if c[0] is not None and c[2] is not None:
            by_id[c[0], c[2]].append(c)
    heads = {key: min(rows, key=lambda c: c[1]) for key, rows in by_id.items()}
    for r in results:
        answers[r[0], r[2]].append(r)
    levels, grown = {}, True
    while grown:
        grown = False
        for key, c in heads.items():
            on = {(key[0], x) for x in c[5] or []} & set(heads)
            if key not in levels and all(x in levels for x in on):
                levels[key] = max((levels[x] + 1 for x in on), default=0)
                grown = True
    out = Counter()
    for key, rows in by_id.items():
        n = len(answers[key])
        out[key[0], key[1], heads[key][1], "linked" if n else "no result", levels.get(key), n] += 1
        rest = list(rows)
        rest.remove(heads[key])
        out.update((c[0], c[2], c[1], "duplicate", None, 0) for c in rest)
    out.update((c[0], c[2], c[1], "unlinked", None, 0) for c in calls if c[0] is None or c[2] is None)
    for key, rows in answers.items():
        rows = sorted(rows, key=lambda r: r[1])
        known = key in heads
        out.update((r[0], r[2], r[1], "further result" if known else "no call", None, 0) for r in rows[1 if known else 0:])
    return out


def test_against_a_plain_linker(spark):
    rng = random.Random(5)
    calls, results = [], []
    for conv in range(12):
        names = [f"k{i}" for i in range(14)]
        for turn in range(16):
            name = rng.choice(names)
            # Turns are unique but for repeated rows, so the first call by turn is one text.
            refers = rng.sample(names, rng.choice([0, 1, 1, 1, 2, 3])) if conv % 3 else [f"k{max(0, int(name[1:]) - d)}" for d in range(1, rng.choice([2, 2, 3]))]
            refers = [x for x in refers if x != name] if conv % 2 else refers
            call = (conv if rng.random() > 0.05 else None, turn, name if rng.random() > 0.05 else None, "search", '{"query":"x"}', refers, "s")
            calls += [call] * rng.choice([1, 1, 1, 2])
        results += [(conv, 20 + t, rng.choice(names + [None]), f"r{t}", 0) for t in range(15)]
        results += results[-1:]
    chain = [(99, i, f"c{i}", "search", "{}", [f"c{i - 1}"] if i else [], "s") for i in range(70)]
    calls += chain
    rows = chat_tools.link(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS)).collect()
    assert Counter((r.conv_id, r.call_id, r.turn, r.status, r.level, r.n_results) for r in rows) == plain_link(calls, results)
    for conv in {r.conv_id for r in rows}:
        places = sorted((r.position, r.level if r.level is not None else 2**31, r.turn) for r in rows if r.conv_id == conv)
        assert [p[0] for p in places] == list(range(1, len(places) + 1)) and [p[1:] for p in places] == sorted(p[1:] for p in places)
