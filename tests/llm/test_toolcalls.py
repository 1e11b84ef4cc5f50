import json
import random

from pulsekit.llm import toolcalls

CALLS = "conv_id long, call_id string, position long, name string, arguments string, after array<string>, extra int"
RESULTS = "conv_id long, call_id string, position long, content string, extra int"
SCHEMAS = {"t": {"a": ("string", True), "b": ("integer", False)}, "free": {}}


def test_levels_against_brute_force(spark):
    rng = random.Random(2)
    rows, want = [], {}
    for conv in range(30):
        n = rng.randrange(1, 9)
        after = {i: [j for j in range(n) if rng.random() < 0.25] + ([99] if rng.random() < 0.2 else []) for i in range(n)}
        rows += [(conv, str(i), i, "free", "{}", [str(j) for j in a] if a else None, 0) for i, a in after.items()]
        broken = any(j >= i for i, a in after.items() for j in a if j < n)
        level, left = {}, set(range(n))
        while ready := [i for i in left if all(j not in left for j in after[i])]:
            for i in ready:
                level[i] = 1 + max((level[j] for j in after[i] if j in level), default=-1)
            left -= set(ready)
        want |= {(conv, str(i)): level.get(i, -1) if broken else 0 for i in range(n)}
    got = toolcalls.levels(spark.createDataFrame(rows, CALLS)).collect()
    assert {(r.conv_id, r.call_id): r.level for r in got} == want and len(got) == len(want)


def test_link(spark):
    calls = [
        (1, "a", 0, "t", '{"b": 1, "a": "x"}', ["b"], 0),
        (1, "b", 1, "t", '{"a":5,"z":[2,{"y":1,"c":2}]}', None, 0),
        (1, "b", 7, "later", "{}", None, 0),
        (1, "d", 3, "q", None, ["d"], 0),
        (2, "a", 0, "t", "[1]", None, 0),
        (None, "a", 0, "t", "{}", None, 0),
        (3, None, 0, "free", '{"é\\n": 1.50}', None, 0),
        (4, "x", 2, None, "no json", [None], 0),
    ]
    results = [(1, "a", 5, "ok", 0), (1, "a", 6, "later", 0), (9, "z", 1, None, 0), (2, "a", 0, "early", 0), (None, "a", 3, "n", 0)]
    got = toolcalls.link(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), SCHEMAS).collect()
    found = {(r.conv_id, r.call_id, r.status): r for r in got}
    assert len(got) == len(found) == 9
    assert found[1, "a", "linked"].level == 1 and found[1, "b", "no_result"].level == 0 and found[1, "d", "no_result"].level == -1
    assert found[1, "a", "linked"].problems == [] and found[1, "b", "no_result"].problems == ["unknown:z", "wrong_type:a"]
    assert found[2, "a", "early_result"].problems == ["not_an_object"] and found[1, "d", "no_result"].problems == ["unknown_tool"]
    assert found[None, "a", "no_call"].problems is None and found[None, "a", "no_result"].problems == ["missing:a"]
    for r in got:
        parsed = json.loads(r.canonical)
        again = json.dumps(parsed, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
        assert again == r.canonical or "1.5" in again
    assert json.loads(found[4, "x", "no_result"].canonical) == {"arguments": "no json", "call_id": "x", "status": "no_result"}


def test_empty_tables(spark):
    calls, results = spark.createDataFrame([], CALLS), spark.createDataFrame([], RESULTS)
    assert toolcalls.link(calls, results, SCHEMAS).count() == 0
    assert toolcalls.link(calls, spark.createDataFrame([(1, "a", 1, "x", 0)], RESULTS), {}).first().status == "no_call"
