"""Chat formatting: linked tool calls, in DataFrame and SQL functions only.

Calls and results are two tables. They are hash-joined by the call's
identifier; calls are put in topological order (a call comes after the one it
follows up), which is found by pointer doubling in as many joins as the
logarithm of the longest chain; arguments are validated against the tool's
schema; and every call becomes one line of canonical JSON (keys in order, no
white space, one form for each number).

Nothing is partitioned by conversation, so one conversation may hold any share
of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.staging import stage_table

#: Argument types by the start of a variant's type name.
TYPES = {"string": "STRING", "integer": "BIGINT", "number": "BIGINT|DECIMAL|DOUBLE|FLOAT", "boolean": "BOOLEAN", "array": "ARRAY", "object": "OBJECT"}


def argument_errors(raw: Column, parsed: Column, name: Column, tools: dict[str, dict]) -> Column:
    """What is wrong with a call's arguments (array of texts, empty if nothing).
    ``tools``: name -> {"properties": {argument: {"type", "minimum",
    "maximum", "enum"}}, "required": [argument]}."""
    out = F.array(F.concat(F.lit("unknown tool "), F.coalesce(name, F.lit("null"))))
    for tool, schema in sorted(tools.items()):
        checks = []
        for arg, rule in sorted(schema.get("properties", {}).items()):
            path = f"$['{arg}']"
            kind = F.schema_of_variant(F.try_variant_get(parsed, path, "variant"))
            wrong = ~kind.rlike(f"^({TYPES[rule['type']]})")
            checks.append(F.when(wrong, F.lit(f"{arg}: not {rule['type']}")))
            value = F.try_variant_get(parsed, path, "double")
            for limit, bad in (("minimum", value < rule.get("minimum", 0)), ("maximum", value > rule.get("maximum", 0))):
                if limit in rule:
                    checks.append(F.when(~wrong & bad, F.lit(f"{arg}: beyond {limit}")))
            if "enum" in rule:
                checks.append(F.when(~wrong & ~F.try_variant_get(parsed, path, "string").isin(rule["enum"]), F.lit(f"{arg}: not in enum")))
        for arg in sorted(schema.get("required", [])):
            checks.append(F.when(F.try_variant_get(parsed, f"$['{arg}']", "variant").isNull(), F.lit(f"{arg}: missing")))
        extra = F.array_sort(F.array_except(F.json_object_keys(raw), F.array(*map(F.lit, schema.get("properties", {})))))
        listed = F.transform(F.coalesce(extra, F.array().cast("array<string>")), lambda k: F.concat(k, F.lit(": not allowed")))
        out = F.when(name == tool, F.concat(F.array_compact(F.array(*checks, F.lit(None).cast("string"))), listed)).otherwise(out)
    is_object = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False))
    return F.when(~is_object, F.array(F.lit("arguments: not a JSON object"))).otherwise(out)


#: Strings, numbers and all else of a JSON text without white space.
_TOKEN = r'("[^"\\]*+(?:\\.[^"\\]*+)*+"|-?[0-9][0-9.eE+-]*+|[^"0-9-]++)'


def canonical_numbers(line: Column) -> Column:
    """``line`` (JSON without white space) with whole numbers below 2^53 written
    as integers, whether they came as ``100``, ``100.0`` or ``1e2``; all other
    numbers and all strings stay as they are."""
    value = lambda t: t.try_cast("double")
    whole = lambda t: t.rlike("^-?[0-9]") & t.rlike("[.eE]") & (F.abs(value(t)) < 2.0**53) & (value(t) == F.floor(value(t)))
    write = lambda t: F.when(whole(t), value(t).cast("bigint").cast("string")).otherwise(t)
    spelt = F.array_join(F.transform(F.regexp_extract_all(line, F.lit(_TOKEN), F.lit(1)), write), "")
    return F.when(line.rlike("[0-9][.eE]"), spelt).otherwise(line)


def call_depths(calls: DataFrame) -> DataFrame:
    """(call_id, depth): how many calls come before each one along ``parent_id``;
    a parent that is no call counts as none, and calls in or behind a cycle get
    a null depth. Repeated ids count once, with their least parent."""
    links = calls.filter("call_id is not null").groupBy("call_id").agg(F.min("parent_id").alias("up"))
    ids = links.select(F.col("call_id").alias("up"), F.lit(1).alias("step"))
    state = links.filter("up is not null").join(ids, "up", "left").select(
        "call_id", F.when(F.col("step").isNotNull(), F.col("up")).alias("up"), F.coalesce("step", F.lit(0)).cast("long").alias("depth"))
    state = stage_table(state.unionByName(links.filter("up is null").withColumn("depth", F.lit(0).cast("long"))), "call-depth")
    rounds = max(1, state.count()).bit_length() + 1
    for _ in range(rounds):
        open_ = state.filter("up is not null")
        if open_.isEmpty():
            break
        above = state.select(F.col("call_id").alias("up"), F.col("up").alias("upper"), F.col("depth").alias("more"))
        further = open_.join(above, "up").select("call_id", F.col("upper").alias("up"), (F.col("depth") + F.col("more")).alias("depth"))
        # Calls whose chain has ended would all meet under a null key.
        state = stage_table(further.unionByName(state.filter("up is null")), "call-depth")
    return state.select("call_id", F.when(F.col("up").isNull(), F.col("depth")).alias("depth"))


def link_tool_calls(calls: DataFrame, results: DataFrame, tools: dict[str, dict]) -> DataFrame:
    """One row for each call, and one for each result without a call.

    ``calls``: conv_id, call_id, parent_id, name, arguments (JSON text).
    ``results``: call_id, content; of several results for a call the least
    content stands in the JSON line. Returns conv_id, call_id, name, depth,
    linked (both sides are there), valid, errors, json, results (every content
    of the id, sorted, with how many times it came; null without one). Calls without an id link with nothing
    and have no depth; results without an id are rows without a call. Arguments
    that are null or no JSON object are errors; those that do not parse stand as
    text under ``raw`` in the JSON line. Null and empty contents stay as they are.
    Other columns are ignored; empty tables give no rows. The results of one id
    become one row.
    """
    calls = calls.select("conv_id", "call_id", "parent_id", "name", "arguments")
    results = results.select("call_id", "content")
    found = results.filter("call_id is not null").groupBy("call_id", "content").agg(F.count("*").alias("times"))
    answered = found.groupBy("call_id").agg(
        F.min("content").alias("content"), F.array_sort(F.collect_list(F.struct("content", "times"))).alias("results")).withColumn("answer", F.lit(True))
    nameless = results.filter("call_id is null").withColumn("results", F.array(F.struct("content", F.lit(1).cast("long").alias("times"))))
    asked = calls.withColumn("call", F.lit(True))
    joined = (asked.filter("call_id is not null").join(call_depths(calls), "call_id", "left")
              .join(answered.hint("shuffle_hash"), "call_id", "full_outer"))
    for part in (asked.filter("call_id is null"), nameless):  # an id that is null would be one hot key
        joined = joined.unionByName(part, allowMissingColumns=True)
    joined = joined.withColumn("parsed", F.try_parse_json("arguments"))
    errors = F.when(F.col("call"), argument_errors(F.col("arguments"), F.col("parsed"), F.col("name"), tools))
    raw = F.when(F.col("parsed").isNull(), F.col("arguments")).alias("raw")
    line = canonical_numbers(F.to_json(F.struct(F.col("parsed").alias("arguments"), F.col("depth").alias("depth"), F.col("call_id").alias("id"),
                                                F.col("name").alias("name"), raw, F.col("content").alias("result"))))
    return (joined.withColumn("errors", errors)
            .select("conv_id", "call_id", "name", "depth", (F.coalesce("call", F.lit(False)) & F.coalesce("answer", F.lit(False))).alias("linked"),
                    F.coalesce(F.size("errors") == 0, F.lit(False)).alias("valid"), "errors", line.alias("json"), "results"))


#: The tools that ``calls_from_chat`` derives calls for.
CHAT_TOOLS = {
    "search": {"properties": {"query": {"type": "string"}, "limit": {"type": "integer", "minimum": 1, "maximum": 50}}, "required": ["limit", "query"]},
    "lookup": {"properties": {"key": {"type": "string"}}, "required": ["key"]},
    "count": {"properties": {"words": {"type": "integer", "minimum": 1}, "unit": {"type": "string", "enum": ["word"]}, "text": {"type": "string"}}, "required": ["unit", "words"]},
}


def calls_from_chat(chat: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results from plain turns (conv_id, turn, role, text): every
    assistant turn is a call whose arguments carry its text, which follows up the assistant turn two before; every user turn after the
    first is the result for the turn before it. All other turns are in
    ``messages_from_chat``. A turn without a number or a conversation has no id."""
    ident = lambda turn: F.concat(F.lit("call_"), F.col("conv_id").cast("string"), F.lit("_"), turn.cast("string"))
    text = F.coalesce("text", F.lit(""))
    kind = F.length(text) % 3
    arguments = (F.when(kind == 0, F.to_json(F.struct(text.alias("query"), (F.length(text) % 60).alias("limit"))))
                 .when(kind == 1, F.to_json(F.struct(text.alias("key"))))
                 .otherwise(F.to_json(F.struct((F.length(text) - F.length(F.replace(text, F.lit(" ")))).alias("words"), F.lit("word").alias("unit"), text.alias("text")))))
    calls = chat.filter("role = 'assistant'").select(
        "conv_id", ident(F.col("turn")).alias("call_id"), ident(F.col("turn") - 2).alias("parent_id"),
        F.when(kind == 0, "search").when(kind == 1, "lookup").otherwise("count").alias("name"), arguments.alias("arguments"))
    results = chat.filter("role = 'user' and turn > 0").select(ident(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"))
    return calls, results


def messages_from_chat(chat: DataFrame) -> DataFrame:
    """The turns that ``calls_from_chat`` leaves out (system, opening user and
    any other turns), one row for each with the columns of ``link_tool_calls``;
    the JSON line has the turn's text, role and number, and there is no name."""
    taken = F.coalesce((F.col("role") == "assistant") | ((F.col("role") == "user") & (F.col("turn") > 0)), F.lit(False))
    ident = F.concat_ws("_", F.lit("message"), F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    line = F.to_json(F.struct(F.col("text").alias("content"), ident.alias("id"), "role", "turn"))
    return chat.filter(~taken).select(
        "conv_id", ident.alias("call_id"), F.lit(None).cast("string").alias("name"), F.lit(None).cast("long").alias("depth"),
        F.lit(False).alias("linked"), F.lit(False).alias("valid"), F.lit(None).cast("array<string>").alias("errors"), line.alias("json"),
        F.lit(None).cast("array<struct<content:string,times:bigint>>").alias("results"))
