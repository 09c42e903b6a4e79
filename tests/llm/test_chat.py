import json

from wardline.llm import chat as C

CALLS = "conv_id long, call_id string, turn long, tool string, arguments string, parents array<string>, level string, " \
        "result string, there string"
RESULTS = "conv_id long, call_id string, turn long, content string, n_results string, r string"


def run(spark, calls, results):
    c = spark.createDataFrame([(*x, "l", "r", "t") for x in calls], CALLS)
    r = spark.createDataFrame([(*x, "n", "r") for x in results], RESULTS)
    return C.link(c, r).collect()


def test_order_validation_and_messages(spark):
    ok = '{"limit": 3, "query":"q\\u00e9 \\"x\\""}'
    calls = [(1, "a", 0, "search", ok, None), (1, "b", 1, "search", '{"query":"q"}', ["a"]),
             (1, "c", 2, "search", '{"query":1,"limit":2.5}', ["a", "b", "b"]), (1, "d", 3, "nope", ok, ["gone", "c"]),
             (1, "x", 4, "search", ok, ["y"]), (1, "y", 5, "search", ok, ["x"]), (1, "z", 6, "search", ok, ["y"]),
             (1, "s", 6, "search", ok, ["s"]), (2, "a", 0, "search", None, []), (2, "b", 0, "search", "[1]", ["a"]),
             (2, "e", 1, "search", "{broken", ["a"]), (2, "t", 1, None, ok, None), (None, "a", 0, "search", ok, ["b"]),
             (2, None, 0, "search", ok, None), (3, "r", 0, "search", ok, []), (3, "r", 0, "search", ok, [])]
    results = [(1, "a", 9, "late"), (1, "a", 1, "early\n"), (1, "a", None, "never"), (2, "a", 1, None), (1, None, 1, "?"),
               (9, "a", 1, "other"), (3, "r", 1, "R")]
    out = {(r.conv_id, r.call_id): r for r in run(spark, calls, results)}
    assert [out[1, k].level for k in "abcd"] == [0, 1, 2, 3]
    assert [out[1, k].status for k in "abcd"] == ["ok", "invalid", "invalid", "invalid"]
    assert out[1, "b"].problems == "missing:limit" and out[1, "c"].problems == "type:limit,type:query"
    assert out[1, "d"].problems == "unknown_tool" and out[1, "d"].missing == "gone"
    assert {out[1, k].status for k in "xyzs"} == {"cycle"} and out[1, "z"].level is None
    assert out[1, "a"].n_results == 3
    assert out[1, "a"].message == ('{"arguments":{"limit":3,"query":"qé \\"x\\""},"depends_on":[],"id":"a",'
                                   '"result":"early\\n","tool":"search"}')
    assert [out[2, k].problems for k in "abe"] == ["not_an_object"] * 3 and out[2, "t"].problems == "unknown_tool"
    assert out[None, "a"].status == out[2, None].status == "no_identifier"
    assert all(json.loads(r.message)["id"] == r.call_id for r in out.values())
    assert out[3, "r"].status == "ok" and len(run(spark, calls, results)) == len(calls)


def test_empty(spark):
    assert run(spark, [], []) == []


def test_no_python_on_the_executors(spark):
    turns = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", None), (1, 2, "user", None)],
                                  "conv_id long, turn long, role string, text string")
    df = C.link(*C.from_conversations(turns))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    assert sorted((r.call_id, r.level) for r in df.collect()) == [("0", 0), ("2", 1)]
