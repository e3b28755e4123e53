"""Chat formatting: tool calls linked to their results, ordered, validated, as canonical JSON.

An assistant message whose text is a JSON object with ``tool_calls`` makes
calls; a tool message whose text is a JSON object with ``tool_call_id`` gives a
result. Calls and results are joined by (conversation, identifier). An argument
``{"$result": "<identifier>"}`` makes a call wait for an earlier result.

Each message stays a row of its own: conversations of any length are never
collected. ``(place, level, turn)`` orders the messages of a conversation.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import map_batches, materialised, text_or_empty

CALLS = "struct<tool_calls:array<struct<id:string,name:string,arguments:string,function:struct<name:string,arguments:string>>>>"
RESULT = "struct<tool_call_id:string>"
# The identifiers an argument refers to.
REFERENCE = r'"\$result"\s*:\s*"([^"]*)"'

# A schema per tool; a parameter of ``format_messages``.
TOOLS = {
    "search": {
        "type": "object", "required": ["query"], "additionalProperties": False,
        "properties": {"query": {"type": "string"}, "limit": {"type": "integer", "minimum": 1}}},
    "calculate": {
        "type": "object", "required": ["expression"], "properties": {"expression": {"type": "string"}}},
}

_TYPES = {
    "object": dict, "array": list, "string": str, "boolean": bool, "null": type(None),
}


def schema_errors(value, schema: dict, at: str = "$") -> list[str]:
    """What a value breaks of a schema: type, enum, required, properties, additionalProperties, items, minimum, maximum.

    A reference to a result stands for a value of any type.
    """
    if isinstance(value, dict) and "$result" in value:
        return []
    kind = schema.get("type")
    number = isinstance(value, (int, float)) and not isinstance(value, bool)
    fits = {
        "integer": number and (isinstance(value, int) or value.is_integer()), "number": number,
    }.get(kind, kind is None or isinstance(value, _TYPES.get(kind, object)))
    if not fits:
        return [f"{at}: not {kind}"]
    errors = []
    if "enum" in schema and value not in schema["enum"]:
        errors.append(f"{at}: not allowed")
    if number and value < schema.get("minimum", value):
        errors.append(f"{at}: too small")
    if number and value > schema.get("maximum", value):
        errors.append(f"{at}: too large")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        errors += [f"{at}.{name}: missing" for name in schema.get("required", []) if name not in value]
        for name in sorted(value):
            if name in known:
                errors += schema_errors(value[name], known[name], f"{at}.{name}")
            elif schema.get("additionalProperties") is False:
                errors.append(f"{at}.{name}: unknown")
    if isinstance(value, list) and "items" in schema:
        for i, item in enumerate(value):
            errors += schema_errors(item, schema["items"], f"{at}[{i}]")
    return errors


def canonical(value) -> str:
    """JSON with sorted names, no blanks, characters as they are."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def _object(text: str):
    if not text.lstrip().startswith("{"):
        return None
    try:
        value = json.loads(text)
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def message_json(role: str | None, text: str, tools: dict) -> tuple[str, str]:
    """The canonical form of a message, and its validation errors joined by ``; ``."""
    body = _object(text) if role in ("assistant", "tool") else None
    message, errors = {"role": role, "content": text}, []
    if role == "assistant" and body and isinstance(body.get("tool_calls"), list):
        calls = []
        for i, call in enumerate(body["tool_calls"]):
            call = call if isinstance(call, dict) else {}
            inner = call["function"] if isinstance(call.get("function"), dict) else call
            name, arguments = inner.get("name"), inner.get("arguments")
            if isinstance(arguments, str):
                try:
                    arguments = json.loads(arguments)
                except (ValueError, RecursionError):
                    errors.append(f"call {i}: arguments are not JSON")
            if not isinstance(call.get("id"), str):
                errors.append(f"call {i}: no id")
            if not isinstance(name, str) or name not in tools:
                errors.append(f"call {i}: unknown tool")
            else:
                errors += [f"call {i}: {e}" for e in schema_errors(arguments, tools[name])]
            calls.append({"id": call.get("id"), "name": name, "arguments": arguments})
        message = {"role": role, "content": body.get("content"), "tool_calls": calls}
    elif role == "tool" and body and "tool_call_id" in body:
        message = {"role": role, "content": body.get("content"), "tool_call_id": body["tool_call_id"]}
    return canonical(message), "; ".join(errors)


def _parsed(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    c = text_or_empty(F.col(text))
    object_like = F.ltrim(c).startswith("{")
    return conversations.select(
        F.col(conv).cast("bigint").alias("conv_id"), F.col(turn).cast("bigint").alias("turn"),
        F.col(role).cast("string").alias("role"), c.alias("text"),
        F.when((F.col(role) == "assistant") & object_like & c.contains("tool_calls"),
               F.from_json(c, CALLS)["tool_calls"]).alias("_calls"),
        F.when((F.col(role) == "tool") & object_like, F.from_json(c, RESULT)["tool_call_id"]).alias("call_id"),
    )


def _levels(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``conv_id, turn, level, reach`` of every message that must follow another, and those in or behind a cycle.

    Edges ``conv_id, a, b`` (b after a) are peeled: what remains in round k are
    edges whose source follows k - 1 others, so the rounds are as many as the
    longest chain. ``reach`` is the latest turn among all a message follows.
    """
    left = materialised(edges.select("conv_id", "a", "b", F.col("a").alias("reach")), "chat-edges")
    levels = left.limit(0).select("conv_id", F.col("b").alias("turn"), F.lit(0).alias("level"), "reach")
    cycles = left.limit(0).select("conv_id", F.col("b").alias("turn"))
    n, level = left.count(), 0
    while n:
        level += 1
        targets = materialised(left.groupBy("conv_id", "b").agg(F.max("reach").alias("reach")), "chat-level")
        levels = levels.unionByName(targets.select("conv_id", F.col("b").alias("turn"), F.lit(level).alias("level"), "reach"))
        behind = targets.select("conv_id", F.col("b").alias("a"), F.col("reach").alias("_reach"))
        left = materialised(
            left.join(behind, ["conv_id", "a"])
            .groupBy("conv_id", "a", "b").agg(F.max(F.greatest("reach", "_reach")).alias("reach")), "chat-edges")
        before, n = n, left.count()
        if n and n == before:
            cycles = left.select("conv_id", F.col("b").alias("turn")).distinct()
            break
    return levels.groupBy("conv_id", "turn").agg(F.max("level").alias("level"), F.max("reach").alias("reach")), cycles


def format_messages(
    conversations: DataFrame, tools: dict = TOOLS, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """One row per message: ``conv_id, turn, role, kind, call_id, call_turn, place, level, errors, json``.

    ``kind`` is message, call, result, orphan (a result whose call is nowhere) or
    cycle (a message in or behind a circle of references). ``call_turn`` is the
    turn of the result's call; of calls with one identifier the first turn counts.
    Sorting a conversation by (place, level, turn) keeps the turns and puts every
    result after its call and every call after the results it refers to.

    A text that is not the JSON described above is plain content. NULL texts are
    empty; NULL conversations or identifiers link to nothing; NULL roles stay
    NULL. Repeated rows stay repeated. Other columns are not read; an empty table
    gives an empty table. Plain messages pass through without a shuffle.
    """
    rows = _parsed(conversations, conv, turn, role, text)
    tool = F.col("_calls").isNotNull() | F.col("call_id").isNotNull()
    plain = rows.where(~tool).select(
        "conv_id", "turn", "role", "text", F.lit("message").alias("kind"), "call_id",
        F.lit(None).cast("bigint").alias("call_turn"), F.col("turn").alias("place"), F.lit(0).alias("level"))
    special = materialised(rows.where(tool), "chat-tool")
    made = plain
    if not special.isEmpty():
        each = special.select("conv_id", "turn", F.explode("_calls").alias("c")).select(
            "conv_id", "turn", F.col("c.id").alias("call_id"),
            F.coalesce("c.arguments", "c.function.arguments", F.lit("")).alias("arguments"))
        calls = materialised(
            each.where(F.col("call_id").isNotNull()).groupBy("conv_id", "call_id").agg(F.min("turn").alias("call_turn")), "chat-calls")
        linked = materialised(special.join(calls, ["conv_id", "call_id"], "left"), "chat-linked")
        links = linked.where("call_turn IS NOT NULL")
        results = materialised(
            links.groupBy("conv_id", "call_id").agg(F.min("turn").alias("a")), "chat-results")
        # An argument in a string is escaped JSON; both spellings name the same identifier.
        wanted = each.withColumn("arguments", F.replace("arguments", F.lit('\\"'), F.lit('"'))).select(
            "conv_id", F.col("turn").alias("b"), F.explode(F.regexp_extract_all("arguments", F.lit(REFERENCE), F.lit(1))).alias("call_id"))
        edges = links.select("conv_id", F.col("call_turn").alias("a"), F.col("turn").alias("b")).unionByName(
            wanted.join(results, ["conv_id", "call_id"]).select("conv_id", "a", "b")).distinct()
        levels, cycles = _levels(edges)
        levels, cycles = materialised(levels, "chat-levels"), materialised(cycles.withColumn("_cycle", F.lit(True)), "chat-cycles")
        kind = (
            F.when(F.col("_cycle"), "cycle").when(F.col("_calls").isNotNull(), "call")
            .when(F.col("call_turn").isNotNull(), "result").otherwise("orphan"))
        ordered = linked.join(levels, ["conv_id", "turn"], "left").join(cycles, ["conv_id", "turn"], "left")
        made = plain.unionByName(ordered.select(
            "conv_id", "turn", "role", "text", kind.alias("kind"), "call_id", "call_turn",
            F.greatest("turn", "reach").alias("place"), F.coalesce("level", F.lit(0)).alias("level")))

    def open_task():
        def work(conv_id, turn, role, text, kind, call_id, call_turn, place, level):
            done = [message_json(r, t, tools) for r, t in zip(role, text)]
            return conv_id, turn, role, kind, call_id, call_turn, place, level, [e for _, e in done], [j for j, _ in done]

        return work

    return map_batches(made, open_task, {
        "conv_id": "bigint", "turn": "bigint", "role": "string", "kind": "string", "call_id": "string", "call_turn": "bigint",
        "place": "bigint", "level": "int", "errors": "string", "json": "string"})
