import json

from pyspark.sql import functions as F

from cohortframe.llm import chat as C

MESSAGES = "conv_id long, turn long, role string, text string"
TOOLS = {"add": {"a": ("integer", True), "b": ("number", True), "note": ("string", False)}, "list": {"items": ("array", True), "opt": ("object", False), "ok": ("boolean", False)},
         "respond": {"text": ("string", True)}}


def call(*calls):
    return json.dumps({"tool_calls": [dict(zip(("id", "name", "arguments", "after"), c)) for c in calls]})


def result(i, content):
    return json.dumps({"tool_call_id": i, "content": content})


def run(spark, rows, prompts=None):
    df = spark.createDataFrame(rows, MESSAGES).withColumns({"status": F.lit("x"), "kind": F.lit("y"), "at": F.lit(1), "call": F.lit(2)})
    return C.format_chats(C.events(df, prompts=prompts), TOOLS).collect()


def test_calls_and_results_are_linked_and_ordered(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "tool", result("c1", "early")), (1, 2, "assistant", call(("c1", "add", {"b": 1.5, "a": 2}), ("c2", "add", '{"a":1,"b":2}', ["c1"]))),
            (1, 3, "tool", result("c2", "three")), (1, 4, "tool", result("zz", "lost")), (1, 5, "assistant", call(("c3", "add", {"a": 1, "b": 1}))), (2, 0, "tool", result("c1", "other conversation"))]
    got = run(spark, rows)
    status = {(r["conv_id"], r["kind"], r["call_id"]): r["status"] for r in got}
    assert status == {(1, "message", None): "message", (1, "result", "c1"): "linked", (1, "call", "c1"): "answered", (1, "call", "c2"): "answered", (1, "result", "c2"): "linked",
                      (1, "result", "zz"): "orphan", (1, "call", "c3"): "unanswered", (2, "result", "c1"): "orphan"}
    order = [(r["kind"], r["call_id"]) for r in sorted((r for r in got if r["conv_id"] == 1), key=lambda r: (r["at"], r["depth"], r["turn"], r["pos"]))]
    assert order.index(("call", "c1")) < order.index(("result", "c1")) < order.index(("call", "c2")) < order.index(("result", "c2"))


def test_order_is_topological_for_long_chains_and_circles(spark):
    n = 7
    rows = [(1, n - k, "assistant", call((f"k{k}", "add", {"a": 1, "b": 1}, [f"k{k - 1}"] if k else []))) for k in range(n)]
    rows += [(2, 0, "assistant", call(("x", "add", {"a": 1, "b": 1}, ["y"]))), (2, 1, "assistant", call(("y", "add", {"a": 1, "b": 1}, ["x"]), ("z", "add", {"a": 1, "b": 1}, ["z", "gone"])))]
    got = run(spark, rows)
    order = [r["call_id"] for r in sorted((r for r in got if r["conv_id"] == 1), key=lambda r: (r["at"], r["depth"]))]
    assert order == [f"k{k}" for k in range(n)]
    assert {r["call_id"]: r["status"] for r in got if r["conv_id"] == 2} == {"x": "circle", "y": "circle", "z": "unanswered"}


def test_arguments_are_held_against_the_schema(spark):
    cases = [("add", {"a": 1, "b": 2.5}, []), ("add", {"a": 1.5, "b": 1}, ["a is no integer"]), ("add", {"a": 1}, ["b is missing"]), ("add", {"a": None, "b": 1}, ["a is missing"]),
             ("add", {"a": 1, "b": 1, "note": 5, "zip": 1, "more": 2}, ["note is no string", "unexpected: more,zip"]), ("add", "[1]", ["arguments are no object"]), ("add", "{bad", ["arguments are no object"]),
             ("add", None, ["arguments are no object"]), ("nope", {}, ["unknown tool"]), (None, {}, ["unknown tool"]), ("list", {"items": [1], "opt": {"x": 1}, "ok": True}, []),
             ("list", {"items": {}, "opt": [], "ok": "yes"}, ["items is no array", "ok is no boolean", "opt is no object"])]
    got = run(spark, [(1, i, "assistant", call((f"c{i}", name, args))) for i, (name, args, _) in enumerate(cases)])
    assert {r["call_id"]: sorted(r["errors"]) for r in got} == {f"c{i}": sorted(e) for i, (_, _, e) in enumerate(cases)}


def test_json_is_canonical(spark):
    got = run(spark, [(1, 0, "assistant", call(("c", "add", '{ "b": 1.5,  "a": 2, "note": "é \\"q\\" \\n" }'))), (1, 1, "user", 'a "b"\n é')])
    for r in got:
        assert json.dumps(json.loads(r["json"]), sort_keys=True, separators=(",", ":"), ensure_ascii=False) == r["json"]
    assert json.loads(next(r["json"] for r in got if r["kind"] == "call"))["arguments"] == {"a": 2, "b": 1.5, "note": 'é "q" \n'}
    assert json.loads(C.schema_text(TOOLS))["add"]["required"] == ["a", "b"]


def test_repeated_ids_do_not_multiply(spark):
    rows = [(1, t, "assistant", call(("c", "add", {"a": 1, "b": 1}))) for t in range(30)] + [(1, 100 + t, "tool", result("c", "r")) for t in range(30)] * 2
    got = run(spark, rows)
    assert len(got) == 90 and sum(r["status"] == "answered" for r in got) == 1 and sum(r["status"] == "duplicate" for r in got) == 29 and sum(r["status"] == "linked" for r in got) == 60


def test_prompts_and_nulls(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (1, 2, "user", None), (1, 4, "assistant", "nobody asked"), (None, 0, "user", "x"), (None, 1, "assistant", "y"),
            (3, None, "user", "no turn"), (3, 0, None, "no role"), (4, 0, "user", "x" * 500_000), (4, 0, "user", "x" * 500_000), (5, 0, "assistant", "{not json"), (5, 1, "tool", "{}"), (5, 2, "assistant", '{"tool_calls":[]}')]
    got = run(spark, rows, prompts="respond")
    assert len(got) == len(rows)
    by = {(r["conv_id"], r["turn"]): r for r in got}
    assert (by[1, 0]["status"], by[1, 1]["status"], by[1, 4]["status"]) == ("answered", "linked", "orphan")
    assert by[1, 2]["errors"] == ["text is missing"] and by[None, 0]["status"] == "unanswered" and by[None, 1]["status"] == "orphan"
    assert by[3, None]["kind"] == "message" and by[3, 0]["kind"] == "message" and by[5, 1]["kind"] == "message"
    assert len(json.loads(by[4, 0]["json"])["arguments"]["text"]) == 500_000


def test_empty_table(spark):
    assert run(spark, []) == []
