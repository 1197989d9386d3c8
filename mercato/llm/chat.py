"""Tool-call linking and canonical JSON for conversations.

Inputs are three tables:

* calls (conv_id, call_id, turn, name, arguments, after): ``arguments`` is JSON
  text; ``after`` is the call_id whose result the call builds on, or null;
* results (conv_id, call_id, turn, content);
* tools (name, schema): a JSON Schema object of the arguments, joined with the
  calls by name, so there may be any number of them. A null schema is none; of
  several schemas of one name the first by text counts.

Calls and results meet in a join on (conv_id, call_id); of several calls or
results with one identifier the earliest counts and the others are ``repeated``.
Calls are ordered topologically: level 0 builds on nothing, else the level is one
more than that of the call it comes after. Levels are found by pointer doubling
(each round joins every call with the call its pointer names), so a chain of
n calls takes log2(n) rounds and no conversation is gathered in one task. A call
after an unknown call is level 0; calls on a cycle, or that lead to one, have a
null level and status ``cycle``.

Arguments are validated against their tool's schema (type, properties, required,
additionalProperties, items, enum, minimum, maximum, minLength, maxLength) and
each call is written as canonical JSON: keys sorted, no spaces, text unescaped.

Rows with a null conv_id or call_id link with nothing: calls are ``unanswered``,
results ``orphan``. Null or malformed arguments are invalid; a null name has no
schema and is invalid. Empty tables give an empty result.
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.llm.common import stored

PARSED_SCHEMAS = 1_000  # kept by a worker at once

_TYPES = {
    "object": dict, "array": list, "string": str, "boolean": bool, "null": type(None),
    "integer": int, "number": (int, float),
}


def problems(value, schema: dict, at: str = "$") -> list[str]:
    """What of ``value`` breaks ``schema``, as sorted texts."""
    out: list[str] = []
    kinds = schema.get("type")
    if kinds is not None:
        kinds = [kinds] if isinstance(kinds, str) else kinds
        fits = any(isinstance(value, _TYPES[k]) and (k in ("boolean",) or not isinstance(value, bool) or k == "null") for k in kinds)
        if not fits:
            return [f"{at}: not {'/'.join(kinds)}"]
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{at}: not in enum")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in value]
        for k, v in value.items():
            if k in known:
                out += problems(v, known[k], f"{at}.{k}")
            elif schema.get("additionalProperties") is False:
                out.append(f"{at}.{k}: unknown")
    elif isinstance(value, list) and "items" in schema:
        for i, v in enumerate(value):
            out += problems(v, schema["items"], f"{at}[{i}]")
    elif isinstance(value, str):
        if len(value) < schema.get("minLength", 0) or len(value) > schema.get("maxLength", len(value)):
            out.append(f"{at}: length")
    elif isinstance(value, (int, float)) and not isinstance(value, bool):
        if value < schema.get("minimum", value) or value > schema.get("maximum", value):
            out.append(f"{at}: range")
    return sorted(out)


def canonical(value) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def _no_constant(name):
    raise ValueError(name)


def checked(arguments: str | None, schema: dict | None) -> tuple[str | None, list[str]]:
    """Canonical arguments (null if they can't be read) and their problems under their tool's schema."""
    try:
        value = json.loads(arguments, parse_constant=_no_constant) if arguments is not None else None
    except (ValueError, RecursionError):
        return None, ["arguments: not JSON"]
    if arguments is None:
        return None, ["arguments: missing"]
    if schema is None:
        return canonical(value), ["tool: unknown"]
    return canonical(value), problems(value, schema)


def levels(calls: DataFrame, max_rounds: int = 48) -> DataFrame:
    """conv_id, call_id, level of calls (conv_id, call_id, after) with unique identifiers."""
    ids = calls.select("conv_id", "call_id", "after")
    known = ids.select(F.col("conv_id").alias("c2"), F.col("call_id").alias("up"))
    hop = stored(ids.join(known, (F.col("conv_id") == F.col("c2")) & (F.col("after") == F.col("up")), "left")
                 .select("conv_id", "call_id", "up", F.when(F.col("up").isNull(), 0).otherwise(1).cast("long").alias("level")),
                 "levels")
    total = hop.count()
    for _ in range(min(max_rounds, max(1, total).bit_length() + 1)):
        if hop.where("up IS NOT NULL").isEmpty():
            break
        far = hop.select(F.col("conv_id").alias("c2"), F.col("call_id").alias("k2"), F.col("up").alias("up2"), F.col("level").alias("l2"))
        # hop is the pointer's distance so far; what the pointer names adds its own
        hop = stored(hop.join(far, (F.col("conv_id") == F.col("c2")) & (F.col("up") == F.col("k2")), "left")
                     .select("conv_id", "call_id", F.col("up2").alias("up"), (F.col("level") + F.coalesce("l2", F.lit(0))).alias("level")),
                     "levels")
    # a pointer that still points after log2 rounds runs in a cycle
    return hop.select("conv_id", "call_id", F.when(F.col("up").isNull(), F.col("level")).alias("level"))


def _first(rows: DataFrame, *order: str) -> DataFrame:
    """Mark the earliest row of each (conv_id, call_id) in ``place`` = 1."""
    return rows.withColumn("place", F.row_number().over(W.partitionBy("conv_id", "call_id").orderBy(*order)))


def linked_calls(calls: DataFrame, results: DataFrame, tools: DataFrame) -> DataFrame:
    """conv_id, call_id, turn, name, status, level, valid, errors, record of every call and of every result without one."""
    calls = calls.select("conv_id", "call_id", "turn", "name", "arguments", "after")
    results = results.select("conv_id", "call_id", "turn", "content")
    tools = tools.where("name IS NOT NULL AND schema IS NOT NULL").groupBy("name").agg(F.min("schema").alias("schema"))
    named = "conv_id IS NOT NULL AND call_id IS NOT NULL"
    known = stored(_first(calls.where(named), "turn", "name", "arguments", "after"), "calls")
    first = known.where("place = 1").drop("place")
    answers = _first(results.where(named), "turn", "content")
    answer = answers.where("place = 1").select("conv_id", "call_id", F.col("content"), F.lit(True).alias("answered"))
    level = levels(first)
    joined = first.join(answer, ["conv_id", "call_id"], "left").join(level, ["conv_id", "call_id"], "left")
    joined = joined.withColumn("status", F.when(F.col("level").isNull(), "cycle").when(F.col("answered"), "linked").otherwise("unanswered"))
    columns = ["conv_id", "call_id", "turn", "name", "arguments", "after", "content", "level", "status"]
    none = F.lit(None)
    again = known.where("place > 1").select(
        "conv_id", "call_id", "turn", "name", "arguments", "after", none.cast("string").alias("content"),
        none.cast("long").alias("level"), F.lit("repeated").alias("status"))
    nameless = calls.where(f"NOT ({named})").select(
        "conv_id", "call_id", "turn", "name", "arguments", "after", none.cast("string").alias("content"),
        F.lit(0).cast("long").alias("level"), F.lit("unanswered").alias("status"))
    lone = answers.where("place = 1").join(first.select("conv_id", "call_id"), ["conv_id", "call_id"], "left_anti").drop("place")
    lone = lone.unionByName(results.where(f"NOT ({named})"))
    spare = answers.where("place > 1").drop("place")
    of_result = lambda df, status: df.select(
        "conv_id", "call_id", "turn", none.cast("string").alias("name"), none.cast("string").alias("arguments"),
        none.cast("string").alias("after"), "content", none.cast("long").alias("level"), F.lit(status).alias("status"))
    rows = joined.select(columns).unionByName(again).unionByName(nameless)
    rows = rows.unionByName(of_result(lone, "orphan")).unionByName(of_result(spare, "repeated result"))

    rows = rows.join(tools, "name", "left")
    kind = T.StructType([T.StructField("valid", T.BooleanType()), T.StructField("errors", T.StringType()), T.StructField("record", T.StringType())])

    @F.arrow_udf(kind)
    def finish(conv, call, name, arguments, after, content, level, status, schema):
        valid, errors, records, parsed = [], [], [], {None: None}
        for row in zip(*(x.to_pylist() for x in (conv, call, name, arguments, after, content, level, status, schema))):
            v, i, n, a, up, c, lv, s, rules = row
            is_call = not s.endswith("result") and s != "orphan"
            if rules not in parsed:
                if len(parsed) > PARSED_SCHEMAS:
                    parsed = {None: None}
                parsed[rules] = json.loads(rules)
            args, wrong = checked(a, parsed[rules]) if is_call else (None, [])
            valid.append(not wrong if is_call else None)
            errors.append("; ".join(wrong))
            # arguments are canonical already: put them in as they are
            parts = [("after", canonical(up)), ("arguments", args or "null"), ("call_id", canonical(i)), ("conv_id", canonical(v)),
                     ("level", canonical(lv)), ("name", canonical(n)), ("result", canonical(c)), ("status", canonical(s))]
            records.append("{" + ",".join(f'"{k}":{x}' for k, x in parts) + "}")
        return pa.StructArray.from_arrays(
            [pa.array(valid, pa.bool_()), pa.array(errors, pa.string()), pa.array(records, pa.string())], names=["valid", "errors", "record"])

    done = rows.withColumn("f", finish("conv_id", "call_id", "name", "arguments", "after", "content", "level", "status", "schema"))
    return done.select("conv_id", "call_id", "turn", "name", "status", "level", "f.valid", "f.errors", "f.record")


# -- the conversations table ---------------------------------------------------
#: Tools of the derived calls.
TURN_TOOLS = [
    ("ask", '{"type":"object","required":["text","words"],"additionalProperties":false,"properties":'
            '{"text":{"type":"string","minLength":1},"words":{"type":"integer","minimum":1,"maximum":60},"opening":{"type":"boolean"}}}'),
    ("instruct", '{"type":"object","required":["text"],"properties":{"text":{"type":"string","minLength":1}}}'),
]


def calls_of_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Calls, results and tools read from turns.

    A user turn is a call of ``ask`` and a system turn one of ``instruct``; the
    assistant turn after a call is its result, with the identifier of that turn.
    A call builds on the call two turns before. A turn of any other role, or of
    none, is a result that answers nothing: it comes out as an ``orphan``.
    """
    c = conversations.select(F.col("conv_id").cast("string").alias("conv_id"), "turn", "role", "text")
    name = lambda turn: F.concat(F.lit("turn-"), turn.cast("string"))
    words = F.when(F.trim("text") == "", 0).otherwise(F.size(F.split(F.trim("text"), r"\s+")))
    ask = F.to_json(F.struct("text", words.alias("words"), (F.col("turn") == 0).alias("opening")))
    instruct = F.to_json(F.struct("text"))
    calls = c.where("role IN ('user', 'system')").select(
        "conv_id", name(F.col("turn")).alias("call_id"), "turn", F.when(F.col("role") == "user", "ask").otherwise("instruct").alias("name"),
        F.when(F.col("role") == "user", ask).otherwise(instruct).alias("arguments"),
        F.when(F.col("turn") >= 2, name(F.col("turn") - 2)).alias("after"))
    results = c.where("role IS NULL OR role NOT IN ('user', 'system')").select(
        "conv_id", F.when(F.col("role") == "assistant", name(F.col("turn") - 1)).alias("call_id"), "turn", F.col("text").alias("content"))
    tools = conversations.sparkSession.createDataFrame(TURN_TOOLS, "name string, schema string")
    return calls, results, tools
