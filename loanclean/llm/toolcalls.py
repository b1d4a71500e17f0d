"""Tool-call linking: calls meet their results by identifier, in topological order, as canonical JSON.

Everything is DataFrame operations. Calls and results join on (conv_id, call_id).
Dependencies between the calls of a conversation give each call a level, the length of
the longest chain of calls that it needs; (level, position) is a topological order.
Levels are peeled off in rounds, one per level of the deepest chain over all
conversations at once; each round's tables are staged. Arguments are checked against a
schema of the tools. The record is JSON with sorted keys and no white space: arguments,
call_id, result, tool.

Status of a call: ``linked`` or ``open`` (no result); ``cycle`` if it depends on itself
through others, then level is null; ``duplicate`` if an earlier call has its identifier
(it takes no part); ``no_id`` without conv_id or call_id. Results without a call
are ``orphan_result`` rows. Of several results of a call the first by position (then
content) is linked, the others are ``extra_result``. Errors are named in the order: malformed arguments,
unknown tool, missing or wrongly typed parameters, unknown parameters, dependencies
that are no call. Extra columns of the inputs are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loanclean.llm.base import stage, table

#: tool -> parameter -> (type, required); types: string, integer, number, boolean, array, object
Schema = dict[str, dict[str, tuple[str, bool]]]
CHAT_TOOLS: Schema = {
    "configure": {"text": ("string", True), "turn": ("integer", True), "chars": ("integer", True)},
    "reply": {"text": ("string", True), "turn": ("integer", True), "chars": ("integer", True)},
}
_TYPES = {
    "string": "^STRING$", "integer": r"^(BIGINT|DECIMAL\([0-9]+,0\))$", "number": r"^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$",
    "boolean": "^BOOLEAN$", "array": "^ARRAY", "object": "^OBJECT",
}
_KEY = ["conv_id", "call_id"]


def argument_errors(schema: Schema, tool: str = "tool", arguments: str = "arguments") -> Column:
    """Array of the errors of a call's arguments (JSON text) against its tool's schema."""
    parsed = F.try_parse_json(F.coalesce(arguments, F.lit("{}")))
    kind = F.schema_of_variant(parsed)
    fine = F.coalesce(kind.rlike("^OBJECT"), F.lit(False))
    checks = [F.when(~fine, F.lit("malformed")), F.when(~F.coalesce(F.col(tool).isin(list(schema)), F.lit(False)), F.lit("unknown_tool"))]
    for name, parameters in schema.items():
        here = fine & (F.col(tool) == name)
        for parameter, (type_, required) in parameters.items():
            value = F.schema_of_variant(F.try_variant_get(parsed, f"$['{parameter}']", "variant"))
            absent = value.isNull() | (value == "VOID")
            if required:
                checks.append(F.when(here & absent, F.lit(f"missing:{parameter}")))
            checks.append(F.when(here & ~absent & ~value.rlike(_TYPES[type_]), F.lit(f"type:{parameter}")))
    given = F.array_sort(F.coalesce(F.json_object_keys(arguments), F.array().cast("array<string>")))
    unknown = F.array().cast("array<string>")
    for name, parameters in schema.items():
        allowed = F.array(*[F.lit(p) for p in parameters]).cast("array<string>")
        unknown = F.when(fine & (F.col(tool) == name), F.transform(F.array_except(given, allowed), lambda p: F.concat(F.lit("unknown:"), p))).otherwise(unknown)
    return F.concat(F.array_compact(F.array(*checks)), unknown)


def levels(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(conv_id, call_id, level) of the nodes; edges (conv_id, child, parent). Nodes on or behind a cycle have null."""
    pending, edges, done, level = stage(nodes, "pending"), stage(edges, "edges"), [], 0
    while not pending.isEmpty():
        waiting = edges.select("conv_id", F.col("child").alias("call_id")).distinct()
        ready = stage(pending.join(waiting, _KEY, "left_anti"), "ready")
        if ready.isEmpty():
            break
        done.append(ready.withColumn("level", F.lit(level)))
        pending = stage(pending.join(ready, _KEY, "left_anti"), "pending")
        edges = stage(edges.join(ready.select("conv_id", F.col("call_id").alias("parent")), ["conv_id", "parent"], "left_anti"), "edges")
        level += 1
    return reduce(DataFrame.unionByName, done, pending.withColumn("level", F.lit(None).cast("int")))


def _first_by(df: DataFrame, order: list[str]) -> DataFrame:
    """``first__``: is the row the first of its key. Repeats of a key are few; they are ranked in a window."""
    rank = F.row_number().over(Window.partitionBy(*_KEY).orderBy(*order))
    return df.withColumn("first__", rank == 1)


def link_calls(calls: DataFrame, results: DataFrame, schema: Schema) -> DataFrame:
    """Records of calls (conv_id, call_id, position, tool, arguments, depends_on) and results (conv_id, call_id, position, content).

    Returns conv_id, call_id, position, tool, status, level, errors (comma-joined), record.
    """
    whole = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    calls = calls.select(*_KEY, "position", "tool", "arguments", "depends_on")
    named = stage(_first_by(calls.where(whole), ["position", "tool", "arguments"]), "calls")
    owners = named.where("first__").drop("first__")
    answers = stage(_first_by(results.select(*_KEY, F.col("position").alias("result_position"), "content").where(whole), ["result_position", "content"]), "results")
    nodes = owners.select(*_KEY)
    wanted = owners.select("conv_id", F.col("call_id").alias("child"), F.explode("depends_on").alias("parent")).where("parent is not null").distinct()
    parents = nodes.select("conv_id", F.col("call_id").alias("parent"), F.lit(True).alias("there"))
    wanted = stage(wanted.join(parents, ["conv_id", "parent"], "left"), "wanted")
    lost = wanted.where("there is null").groupBy("conv_id", F.col("child").alias("call_id")).agg(F.array_sort(F.collect_set(F.concat(F.lit("no_dependency:"), "parent"))).alias("lost"))
    order = levels(nodes, wanted.where("there").select("conv_id", "child", "parent"))

    first = answers.where("first__").select(*_KEY, "content", F.lit(True).alias("answered"))
    linked = owners.join(first.hint("shuffle_hash"), _KEY, "left").join(order, _KEY).join(lost, _KEY, "left")
    none = F.array().cast("array<string>")
    errors = F.concat_ws(",", F.concat(argument_errors(schema), F.coalesce("lost", none)))
    status = F.when(F.col("level").isNull(), "cycle").when(F.col("answered"), "linked").otherwise("open")
    arguments = F.coalesce(F.try_parse_json("arguments"), F.parse_json(F.lit("null")))
    record = F.to_json(F.struct(arguments.alias("arguments"), "call_id", F.col("content").alias("result"), "tool"), {"ignoreNullFields": "false"})
    out = linked.select(*_KEY, "position", "tool", status.alias("status"), "level", errors.alias("errors"), record.alias("record"))

    def aside(df: DataFrame, position: str, tool: Column, status: str) -> DataFrame:
        text = F.lit(None).cast("string")
        return df.select(*_KEY, F.col(position).alias("position"), tool.alias("tool"), F.lit(status).alias("status"), F.lit(None).cast("int").alias("level"), F.lit("").alias("errors"), text.alias("record"))

    nothing = F.lit(None).cast("string")
    return (
        out.unionByName(aside(named.where("not first__"), "position", F.col("tool"), "duplicate"))
        .unionByName(aside(calls.where(~whole), "position", F.col("tool"), "no_id"))
        .unionByName(aside(answers.where("first__").join(nodes, _KEY, "left_anti"), "result_position", nothing, "orphan_result"))
        .unionByName(aside(answers.where("not first__"), "result_position", nothing, "extra_result"))
    )


def chat_calls(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of a chat: a system or user turn calls a tool, the assistant turn after it is the result.

    A call depends on the conversation's first call and on its first user turn.
    """
    asks = turns.where(F.col("role").isin("system", "user"))
    heads = asks.groupBy("conv_id").agg(F.min("turn").alias("first"), F.min(F.when(F.col("role") == "user", F.col("turn"))).alias("first_user"))
    name = lambda c: F.concat(F.lit("t"), F.col(c).cast("string"))
    tool = F.when(F.col("role") == "system", "configure").otherwise("reply")
    arguments = F.to_json(F.struct("turn", "text", F.length("text").alias("chars")))
    needs = F.array_distinct(F.array_compact(F.array(*[F.when(F.col(c) < F.col("turn"), name(c)) for c in ("first", "first_user")])))
    calls = asks.join(heads, "conv_id", "left").select("conv_id", name("turn").alias("call_id"), F.col("turn").alias("position"), tool.alias("tool"), arguments.alias("arguments"), needs.alias("depends_on"))
    said = turns.where("role = 'assistant'").withColumn("asked", F.col("turn") - 1)
    return calls, said.select("conv_id", name("asked").alias("call_id"), F.col("turn").alias("position"), F.col("text").alias("content"))


def op2_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = chat_calls(table(spark, sf_dir, "conversations"))
    return link_calls(calls, results, CHAT_TOOLS)


OP2_SQL = """
WITH asks AS (
  SELECT conv_id, turn, role, text,
         min(turn) OVER (PARTITION BY conv_id) AS first,
         min(CASE WHEN role = 'user' THEN turn END) OVER (PARTITION BY conv_id) AS first_user
  FROM conversations WHERE role IN ('system', 'user')
), said AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'assistant')
SELECT a.conv_id, 't' || a.turn AS call_id, a.turn AS position,
       CASE WHEN a.role = 'system' THEN 'configure' ELSE 'reply' END AS tool,
       CASE WHEN s.turn IS NULL THEN 'open' ELSE 'linked' END AS status,
       CAST(CASE WHEN a.turn = a.first THEN 0 WHEN a.first_user > a.first AND a.turn > a.first_user THEN 2 ELSE 1 END AS INTEGER) AS level,
       CASE WHEN a.text IS NULL THEN 'missing:text,missing:chars' ELSE '' END AS errors,
       '{"arguments":{' || coalesce('"chars":' || length(a.text) || ',"text":' || to_json(a.text) || ',', '') || '"turn":' || a.turn || '},"call_id":"t' || a.turn
         || '","result":' || coalesce(CAST(to_json(s.text) AS VARCHAR), 'null') || ',"tool":"' || CASE WHEN a.role = 'system' THEN 'configure' ELSE 'reply' END || '"}' AS record
FROM asks a LEFT JOIN said s ON s.conv_id = a.conv_id AND s.turn = a.turn + 1
UNION ALL
SELECT s.conv_id, 't' || (s.turn - 1), s.turn, NULL, 'orphan_result', NULL, '', NULL
FROM said s LEFT JOIN asks a ON s.conv_id = a.conv_id AND s.turn = a.turn + 1 WHERE a.turn IS NULL
"""
