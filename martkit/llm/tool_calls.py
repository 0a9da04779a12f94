"""Tool-call linking for chat data, in DataFrame expressions only.

Calls and results are hash-joined by conversation and call identifier.  A call may use the results of others (``${id}`` in
its arguments); calls get levels so that each comes after those it uses.  Arguments are checked against the tool's schema, and
each call is written as canonical JSON: keys sorted at every depth, no blanks.

Levels are found in rounds over tables of the shared folder.  Chains of calls with one need each are shortened by pointer
jumping, which halves them in a round.  Then the calls whose needs are met leave, and with them the needs they meet, until
none is left; such rounds are as many as calls with several needs follow one another.  No conversation is ever gathered in
one place.

Defined results: calls of one conversation and identifier are one call, the earliest (``copies`` counts them), so are
results; a result without a call has status ``orphan``; a call without an identifier can't be linked (``no identifier``);
calls that need each other in a circle, or need such calls, have no level; a reference to an unknown call is an error of the
arguments and orders nothing; arguments that are no JSON object are invalid and stand as a JSON string; a null text is empty.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import whole_text, written

#: Types a schema can name, and what Spark calls the values' types.
_TYPES = {"string": "STRING", "integer": "BIGINT", "number": "BIGINT|DOUBLE|FLOAT|DECIMAL.*", "boolean": "BOOLEAN", "object": "OBJECT.*", "array": "ARRAY.*"}
_ID = ["conv_id", "call_id"]
REFERENCE = r"\$\{([A-Za-z0-9_.-]+)\}"
#: tool -> parameter -> (type, required)
Schemas = dict[str, dict[str, tuple[str, bool]]]


def schema_errors(name: Column, arguments: Column, schemas: Schemas) -> Column:
    """What is wrong with a call's arguments, in the order of their schema; empty if nothing is."""
    parsed = F.try_parse_json(arguments)
    is_object = F.schema_of_variant(parsed).startswith("OBJECT")
    by_tool = F.array(F.concat(F.lit("unknown tool "), F.coalesce(name, F.lit(""))))
    for tool, parameters in schemas.items():
        checks = []
        for p, (kind, required) in parameters.items():
            value = F.try_variant_get(parsed, f"$['{p}']", "variant")
            missing = F.lit(f"missing {p}") if required else F.lit(None).cast("string")
            checks.append(F.when(value.isNull(), missing).when(~F.schema_of_variant(value).rlike(f"^({_TYPES[kind]})$"), F.lit(f"{p} is no {kind}")))
        known = F.array(*[F.lit(p) for p in parameters]).cast("array<string>")
        extra = F.transform(F.array_sort(F.array_except(F.json_object_keys(arguments), known)), lambda k: F.concat(F.lit("unexpected "), k))
        found = F.concat(F.filter(F.array(*checks).cast("array<string>"), lambda e: e.isNotNull()), extra)
        by_tool = F.when(name == tool, found).otherwise(by_tool)
    return F.when(F.coalesce(is_object, F.lit(False)), by_tool).otherwise(F.array(F.lit("arguments are no JSON object")))


def levels(needs: DataFrame) -> DataFrame:
    """conv_id, call_id and level of each call with needs; level null for calls in or behind a circle.

    ``needs``: conv_id, call_id, needs (another call of the conversation that exists).
    """
    edges = written(needs.distinct(), "needs")
    nodes = written(edges.groupBy(*_ID).agg(F.count("*").alias("n"), F.min("needs").alias("to")), "nodes")
    free, circular = _jumped(nodes.where("n = 1").select(*_ID, "to", F.lit(1).cast("long").alias("hops")))
    # Calls with several needs, each need replaced by what its chain of single needs ends at.
    chain = free.select("conv_id", F.col("call_id").alias("needs"), "to", "hops")
    left = edges.join(nodes.where("n > 1").select(*_ID), _ID, "left_semi").join(chain, ["conv_id", "needs"], "left")
    left = written(left.select(*_ID, F.coalesce("to", "needs").alias("needs"), (F.coalesce("hops", F.lit(0)) + 1).alias("steps")), "left")
    ready = left.select("conv_id", F.col("needs").alias("call_id")).distinct().join(nodes.select(*_ID), _ID, "left_anti")
    ready = written(ready.withColumn("level", F.lit(0).cast("long")), "ready")
    got, done = None, None
    while not ready.isEmpty():
        level = ready.select("conv_id", F.col("call_id").alias("needs"), "level")
        met = left.join(level, ["conv_id", "needs"]).select(*_ID, (F.col("level") + F.col("steps")).alias("level"))
        got = written((met if got is None else met.unionByName(got)).groupBy(*_ID).agg(F.max("level").alias("level")), "got")
        left = written(left.join(level, ["conv_id", "needs"], "left_anti").select(*_ID, "needs", "steps"), "left")
        open_ = left.select(*_ID).distinct()
        ready = written(got.join(open_, _ID, "left_anti"), "ready")
        got = got.join(open_, _ID, "left_semi")
        done = ready if done is None else done.unionByName(ready)
    stuck = left.select(*_ID).distinct().unionByName(circular.select(*_ID)).withColumn("level", F.lit(None).cast("long"))
    many = stuck if done is None else stuck.unionByName(done)
    # A chain's level counts from its end: a call without needs (level 0), or one with several.
    ends = many.select("conv_id", F.col("call_id").alias("to"), "level", F.lit(True).alias("several"))
    single = free.join(ends, ["conv_id", "to"], "left")
    level = F.when(F.col("several").isNull(), F.col("hops")).otherwise(F.col("level") + F.col("hops"))
    return many.unionByName(single.select(*_ID, level.alias("level")))


def _jumped(single: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls with one need, pointed at the end of their chain, hops away; and those whose chain is a circle.

    Each round doubles the hops, so a chain takes as many rounds as its length has binary digits.
    """
    single = written(single, "single")
    here = ["conv_id", "to"]
    for _ in range(single.count().bit_length() + 1):
        onto = single.select("conv_id", F.col("call_id").alias("to"), F.col("to").alias("next"), F.col("hops").alias("more"))
        moved = single.join(onto, here, "left")
        single = written(moved.select(*_ID, F.coalesce("next", "to").alias("to"), (F.col("hops") + F.coalesce("more", F.lit(0))).alias("hops"),
                                      F.col("next").isNotNull().alias("moved")), "single")
        if single.where("moved").isEmpty():
            break
    onto = single.select("conv_id", F.col("call_id").alias("to"))
    return written(single.join(onto, here, "left_anti").select(*_ID, "to", "hops"), "free"), single.join(onto, here, "left_semi")


def _one(rows: DataFrame, *columns: str) -> DataFrame:
    """The earliest row of each conversation and identifier; ties by content."""
    first = F.min(F.struct("position", *columns)).alias("first")
    return rows.groupBy(*_ID).agg(first, F.count("*").alias("copies")).select(*_ID, "copies", "first.*")


def linked_calls(calls: DataFrame, results: DataFrame, schemas: Schemas) -> DataFrame:
    """A row per call, and per result without a call: conv_id, call_id, name, level, position, status, copies, errors, canonical.

    ``calls``: conv_id, call_id, position, name, arguments (JSON).  ``results``: conv_id, call_id, position, content.
    Order calls of a conversation by (level, position).
    """
    named = calls.where("call_id is not null")
    own = _one(named, "name", "arguments").withColumn("errors", schema_errors(F.col("name"), F.col("arguments"), schemas))
    own = written(own.withColumn("uses", F.array_distinct(F.regexp_extract_all("arguments", F.lit(REFERENCE), F.lit(1)))), "calls")
    wanted = own.select(*_ID, F.explode("uses").alias("needs"))
    there = own.select("conv_id", F.col("call_id").alias("needs"))
    same = ["conv_id", "needs"]
    unknown = wanted.join(there, same, "left_anti").groupBy(*_ID).agg(F.sort_array(F.collect_set("needs")).alias("lost"))
    found = levels(wanted.join(there, same, "left_semi"))
    answers = _one(results.where("call_id is not null"), "content").select(*_ID, "content", F.lit(True).alias("answered"), F.col("position").alias("at"), F.col("copies").alias("n"))
    rows = own.join(answers, _ID, "full").join(found.withColumn("leveled", F.lit(True)), _ID, "left").join(unknown, _ID, "left")
    lost = F.transform(F.coalesce("lost", F.array().cast("array<string>")), lambda x: F.concat(F.lit("unknown reference "), x))
    called = F.col("copies").isNotNull()
    status = F.when(~called, "orphan").when(F.col("answered").isNull(), "open").otherwise("linked")
    rows = rows.select(
        *_ID, "name", F.when(called, F.when(F.col("leveled").isNull(), F.lit(0).cast("long")).otherwise(F.col("level"))).alias("level"),
        F.coalesce("position", "at").alias("position"), status.alias("status"), F.coalesce("copies", "n").alias("copies"),
        F.when(called, F.concat("errors", lost)).alias("errors"), "arguments", "content")
    nameless = calls.where("call_id is null").select(
        *_ID, "name", F.lit(0).cast("long").alias("level"), "position", F.lit("no identifier").alias("status"), F.lit(1).cast("long").alias("copies"),
        schema_errors(F.col("name"), F.col("arguments"), schemas).alias("errors"), "arguments", F.lit(None).cast("string").alias("content"))
    return rows.unionByName(nameless).withColumn("canonical", canonical_json(F.col("arguments"), F.col("call_id"), F.col("content"), F.col("name"))).drop("arguments", "content")


def canonical_json(arguments: Column, call_id: Column, content: Column, name: Column) -> Column:
    """A JSON object of the call with sorted keys at every depth; fields that are null are left out."""
    parsed = F.to_json(F.try_parse_json(arguments))
    plain = F.to_json(F.struct(arguments.alias("v"))).substr(F.lit(6), F.length(F.to_json(F.struct(arguments.alias("v")))) - 6)
    outer = F.to_json(F.struct(call_id.alias("call_id"), name.alias("name"), content.alias("result")))
    whole = F.when(arguments.isNull(), outer).otherwise(F.concat(
        F.lit('{"arguments":'), F.coalesce(parsed, plain), F.when(F.length(outer) > 2, F.concat(F.lit(","), outer.substr(F.lit(2), F.length(outer)))).otherwise(F.lit("}"))))
    return whole


# ---------------------------------------------------------------- calls of plain conversations
#: Tools that the derived calls use.
TOOLS: Schemas = {
    "look_up": {"query": ("string", True), "limit": ("integer", False), "after": ("string", False)},
    "rewrite": {"text": ("string", True), "limit": ("integer", True), "after": ("string", False)},
}


def calls_of(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results from conversations without any: each assistant turn calls a tool with its whole text, after the call
    two turns before it; each user turn is the result of the call just before it.

    Texts of an even number of characters look something up, others rewrite.  Texts whose length can be divided by 7 give their
    limit as a text, and those with several lines name a parameter no tool has, so that schemas are broken as well as kept.
    """
    body, n = whole_text("text"), F.char_length(whole_text("text"))
    look = n % 2 == 0
    after = F.when(F.col("turn") >= 3, F.concat(F.lit("${call_"), (F.col("turn") - 2).cast("string"), F.lit("}")))
    arguments = F.to_json(F.struct(
        F.when(look, body).alias("query"), F.when(~look, body).alias("text"), F.when(n % 7 != 0, n).alias("limit"), after.alias("after"),
        F.when(body.contains("\n"), F.lit(True)).alias("lines")))
    arguments = F.when(n % 7 == 0, F.concat(F.lit('{"limit":"'), n.cast("string"), F.lit('",'), arguments.substr(F.lit(2), F.length(arguments)))).otherwise(arguments)
    calls = turns.where("role = 'assistant'").select(
        "conv_id", F.concat(F.lit("call_"), F.col("turn").cast("string")).alias("call_id"), F.col("turn").alias("position"),
        F.when(look, "look_up").otherwise("rewrite").alias("name"), arguments.alias("arguments"))
    results = turns.where("role = 'user'").select(
        "conv_id", F.concat(F.lit("call_"), (F.col("turn") - 1).cast("string")).alias("call_id"), F.col("turn").alias("position"), body.alias("content"))
    return calls, results
