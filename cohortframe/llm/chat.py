"""Chat formatting: tool calls linked to their results, ordered, validated and written as canonical JSON.

DataFrame operations only.  Messages become events: a *call*, a *result* or a plain *message*.

* Linking is a hash join of calls and results on (conversation, call id); both sides are aggregated to
  one row for each id first, so repeated ids never multiply.
* The order is topological: a result follows its call, and a call follows the results of the calls it
  names in ``after``.  Each event gets the pair ``(at, depth)`` (the latest turn among itself and what
  it needs, and the steps on the way), which sorts a conversation; no conversation is gathered to one
  task.  Chains of ``after`` are resolved a step a round, each round a join of small tables in the shared
  folder; calls that wait for each other in a circle keep their own turn and are marked.
* Arguments are parsed to variants and held against the tool's schema by column expressions.
* Canonical JSON has its keys in alphabetical order, no blanks, and no fields without a value.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, functions as F

from cohortframe.llm.util import stage_table

#: JSON types a schema may ask for, and how ``schema_of_variant`` names them.
TYPES = {"string": "STRING", "integer": "BIGINT", "number": r"BIGINT|DOUBLE|FLOAT|DECIMAL\(\d+,\d+\)", "boolean": "BOOLEAN", "array": "ARRAY<.*", "object": "OBJECT<.*"}
KEY = ["conv_id", "call_id"]
_CALLS = "struct<tool_calls:array<struct<id:string,name:string,arguments:string,after:array<string>>>>"
_RESULT = "struct<tool_call_id:string,content:string>"


def events(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", prompts: str | None = None) -> DataFrame:
    """``(conv_id, turn, pos, role, kind, call_id, name, arguments, after, content)``, one row or more for each message.

    An assistant's text that is JSON with ``tool_calls`` gives a call for each; a tool's text that is JSON with
    ``tool_call_id`` gives a result.  With ``prompts`` (a tool name) a user's turn is a call of that tool
    with the text as its argument, and the assistant's prose in the next turn is the result.
    All else is a message.
    """
    m = messages.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    looks = F.ltrim("text").startswith("{")
    m = m.withColumn("calls", F.when((F.col("role") == "assistant") & looks, F.from_json("text", _CALLS)["tool_calls"]))
    m = m.withColumn("calls", F.when(F.size("calls") > 0, F.col("calls")))
    m = m.withColumn("result", F.when((F.col("role") == "tool") & looks, F.from_json("text", _RESULT)))
    m = m.select("*", F.posexplode_outer("calls").alias("pos", "call"))
    prose = F.lit(prompts is not None) & F.col("turn").isNotNull()
    asked = prose & (F.col("role") == "user")
    answered = prose & (F.col("role") == "assistant") & F.col("calls").isNull()
    is_result = F.col("result.tool_call_id").isNotNull()
    turn_id = lambda back: F.concat(F.lit("turn:"), (F.col("turn") - back).cast("string"))
    return m.select(
        "conv_id", "turn", F.coalesce("pos", F.lit(0)).alias("pos"), "role",
        F.when(F.col("call").isNotNull() | asked, "call").when(is_result | answered, "result").otherwise("message").alias("kind"),
        F.when(F.col("call").isNotNull(), F.col("call.id")).when(asked, turn_id(0)).when(is_result, F.col("result.tool_call_id")).when(answered, turn_id(1)).alias("call_id"),
        F.when(F.col("call").isNotNull(), F.col("call.name")).when(asked, F.lit(prompts)).alias("name"),
        F.when(F.col("call").isNotNull(), F.col("call.arguments")).when(asked, F.to_json(F.struct("text"))).alias("arguments"),
        F.col("call.after").alias("after"),
        F.when(F.col("call").isNotNull() | asked, F.lit(None)).when(is_result, F.col("result.content")).otherwise(F.col("text")).alias("content"))


def _order(calls: DataFrame) -> DataFrame:
    """``(conv_id, call_id, call_at, call_depth, circle)`` for each distinct call ``(conv_id, call_id, turn, after)``."""
    plain = calls.select(*KEY, F.col("turn").alias("call_at"), F.lit(0).cast("long").alias("call_depth"), F.lit(False).alias("circle"))
    edges = calls.select(*KEY, "turn", F.explode(F.array_distinct("after")).alias("needs")).filter("needs <> call_id")
    edges = stage_table(edges.join(calls.select("conv_id", F.col("call_id").alias("needs")), ["conv_id", "needs"]), "chat-edges")
    if edges.isEmpty():
        return plain
    wanted = stage_table(edges.groupBy(*KEY, "turn").agg(F.count("*").alias("n")), "chat-wanted")
    done = stage_table(plain.join(wanted, KEY, "left_anti"), "chat-done")
    new = done
    while True:
        have = done.select("conv_id", F.col("call_id").alias("needs"), "call_at", "call_depth")
        met = edges.join(have, ["conv_id", "needs"]).groupBy(*KEY).agg(F.count("*").alias("have"), F.max("call_at").alias("at"), F.max("call_depth").alias("depth"))
        ready = wanted.join(done, KEY, "left_anti").join(met, KEY).filter("have = n")
        new = stage_table(ready.select(*KEY, F.greatest("turn", "at").alias("call_at"), (F.col("depth") + 2).alias("call_depth"), F.lit(False).alias("circle")), "chat-ready")
        if new.isEmpty():
            return done.union(plain.join(done, KEY, "left_anti").withColumn("circle", F.lit(True)))
        done = stage_table(done.union(new), "chat-done")


def _path(field: str) -> str:
    return "$['" + field.replace("\\", "\\\\").replace("'", "\\'") + "']"


def errors(schemas: dict[str, dict[str, tuple[str, bool]]], name: Column, arguments: Column) -> Column:
    """What is wrong with a call's arguments: an array of short texts, empty for a valid call.

    ``schemas``: for each tool its fields, each with a JSON type and whether it must be there.
    """
    v = F.try_parse_json(arguments)
    is_object = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    found = [F.when(~F.coalesce(name.isin(list(schemas)), F.lit(False)), F.lit("unknown tool")), F.when(~is_object, F.lit("arguments are no object"))]
    for tool, fields in schemas.items():
        here = (name == tool) & is_object
        for field, (kind, required) in fields.items():
            got = F.coalesce(F.schema_of_variant(F.try_variant_get(v, _path(field), "variant")), F.lit("VOID"))
            if required:
                found.append(F.when(here & (got == "VOID"), F.lit(f"{field} is missing")))
            found.append(F.when(here & (got != "VOID") & ~got.rlike(f"^(?:{TYPES[kind]})$"), F.lit(f"{field} is no {kind}")))
        others = F.array_sort(F.array_except(F.json_object_keys(arguments), F.array(*[F.lit(f) for f in fields]).cast("array<string>")))
        found.append(F.when(here & (F.size(others) > 0), F.concat(F.lit("unexpected: "), F.array_join(others, ","))))
    return F.array_compact(F.array(*found))


def format_chats(found: DataFrame, schemas: dict[str, dict[str, tuple[str, bool]]]) -> DataFrame:
    """``(conv_id, turn, pos, kind, call_id, status, at, depth, errors, json)`` for each event.

    ``status``: a call is ``answered`` or ``unanswered``, a ``duplicate`` if an earlier call of the
    conversation has its id, or part of a ``circle``; a result is ``linked`` or an ``orphan``; a message is
    ``message``.  Sort a conversation by ``at, depth, turn, pos``.  A call without an id, or an event without a
    conversation, links to nothing.  Events without a turn have no ``at`` and sort first; repeated rows give
    a row each and equal texts; an empty table gives none.
    """
    found = stage_table(found, "chat-events")
    calls = found.filter("kind = 'call' and call_id is not null and conv_id is not null").groupBy(*KEY).agg(F.min(F.struct("turn", "pos", "after")).alias("c"))
    calls = stage_table(calls.select(*KEY, "c.turn", "c.pos", "c.after"), "chat-calls")
    results = found.filter("kind = 'result' and call_id is not null").groupBy(*KEY).agg(F.count("*").alias("n_results"))
    links = calls.select(*KEY, F.col("turn").alias("first_turn"), F.col("pos").alias("first_pos")).join(results, KEY, "left").join(_order(calls), KEY)
    out = found.join(links, KEY, "left")
    first = F.col("turn").eqNullSafe(F.col("first_turn")) & (F.col("pos") == F.col("first_pos"))
    known = F.col("first_pos").isNotNull()
    is_call, is_result = F.col("kind") == "call", F.col("kind") == "result"
    status = (F.when(is_call & known & ~first, "duplicate").when(is_call & F.coalesce("circle", F.lit(False)), "circle")
              .when(is_call & F.col("n_results").isNotNull(), "answered").when(is_call, "unanswered")
              .when(is_result & known, "linked").when(is_result, "orphan").otherwise("message"))
    out = out.withColumn("status", status).withColumn("errors", F.when(is_call, errors(schemas, F.col("name"), F.col("arguments"))))
    at = F.when(is_call & first, F.col("call_at")).when(is_result & known, F.greatest("turn", "call_at")).otherwise(F.col("turn"))
    depth = F.when(is_call & first, F.col("call_depth")).when(is_result & known, F.col("call_depth") + 1).otherwise(F.lit(0))
    arguments = F.coalesce(F.try_parse_json("arguments"), F.col("arguments").cast("variant"))
    fields = {"arguments": arguments, "call_id": "call_id", "content": "content", "conv_id": "conv_id", "errors": F.when(F.size("errors") > 0, F.col("errors")),
              "name": "name", "role": "role", "status": "status", "turn": "turn"}
    line = F.to_json(F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in sorted(fields.items())]))
    return out.select("conv_id", "turn", "pos", "kind", "call_id", "status", at.alias("at"), depth.cast("long").alias("depth"), "errors", line.alias("json"))


def schema_text(schemas: dict[str, dict[str, tuple[str, bool]]]) -> str:
    """The schemas in the JSON form that tool definitions have."""
    return json.dumps({tool: {"type": "object", "properties": {f: {"type": t} for f, (t, _) in sorted(fields.items())},
                              "required": sorted(f for f, (_, r) in fields.items() if r), "additionalProperties": False} for tool, fields in sorted(schemas.items())},
                      sort_keys=True, separators=(",", ":"))


ORACLE_SQL = """
WITH m AS (SELECT conv_id, turn, role, text,
  CASE role WHEN 'user' THEN 'call' WHEN 'assistant' THEN 'result' ELSE 'message' END AS kind,
  CASE role WHEN 'user' THEN 'turn:' || turn WHEN 'assistant' THEN 'turn:' || (turn - 1) END AS call_id FROM conversations),
c AS (SELECT DISTINCT conv_id, call_id FROM m WHERE kind = 'call'),
r AS (SELECT DISTINCT conv_id, call_id FROM m WHERE kind = 'result'),
s AS (SELECT m.*, CASE kind WHEN 'call' THEN CASE WHEN r.call_id IS NULL THEN 'unanswered' ELSE 'answered' END
  WHEN 'result' THEN CASE WHEN c.call_id IS NULL THEN 'orphan' ELSE 'linked' END ELSE 'message' END AS status
  FROM m LEFT JOIN c ON m.conv_id = c.conv_id AND m.call_id = c.call_id LEFT JOIN r ON m.conv_id = r.conv_id AND m.call_id = r.call_id)
SELECT conv_id, turn, kind, call_id, status, turn AS at, CAST(CASE status WHEN 'linked' THEN 1 ELSE 0 END AS BIGINT) AS depth, CAST(0 AS BIGINT) AS n_errors,
  CASE kind WHEN 'call' THEN CAST(json_object('arguments', json_object('text', text), 'call_id', call_id, 'conv_id', conv_id, 'name', 'respond', 'role', role, 'status', status, 'turn', turn) AS VARCHAR)
  WHEN 'result' THEN CAST(json_object('call_id', call_id, 'content', text, 'conv_id', conv_id, 'role', role, 'status', status, 'turn', turn) AS VARCHAR)
  ELSE CAST(json_object('content', text, 'conv_id', conv_id, 'role', role, 'status', status, 'turn', turn) AS VARCHAR) END AS json
FROM s
"""
