"""Chat formatting by tool-call linking.

Messages are read into items: plain messages, calls and results.  Calls and results are hash-joined on
their identifier, items are ordered so that each follows what it depends on, arguments are validated against
the tool's schema, and every item is written as canonical JSON (sorted keys, no spaces).
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import bounded_batches
from tallyloom.operators.groups import concat_group
from tallyloom.scale import written

TYPES = {"string": str, "boolean": bool, "object": dict, "array": list, "null": type(None)}


_LONE = re.compile("[\ud800-\udfff]")


def canonical(value) -> str:
    """Sorted keys, no spaces, characters as they are; halves of surrogate pairs, which no text can hold, stay escaped."""
    text = json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"), allow_nan=False)
    return _LONE.sub(lambda m: f"\\u{ord(m[0]):04x}", text)


def _finite(text: str) -> float:
    value = float(text)
    if not math.isfinite(value):
        raise ValueError(f"{text} is no number in JSON")
    return value


def _no_constant(name: str):
    raise ValueError(f"{name} is no value in JSON")


def parsed_json(text: str):
    """The value of a JSON text.  NaN, Infinity and numbers too large for a float are errors: canonical JSON cannot hold them."""
    return json.loads(text, parse_constant=_no_constant, parse_float=_finite)


def _name(value) -> str | None:
    """An identifier or a name as text: other values as their JSON, null and texts that no column can hold as none."""
    if value is None or (isinstance(value, str) and _LONE.search(value)):
        return None
    return value if isinstance(value, str) else canonical(value)


def check_schema(schema: dict, at: str = "$") -> None:
    """Raises for types that no value can be checked against."""
    kinds = schema.get("type")
    for kind in [kinds] if isinstance(kinds, str) else kinds or []:
        if kind not in TYPES and kind not in ("integer", "number"):
            raise ValueError(f"{at}: unknown type {kind!r}")
    for name, part in schema.get("properties", {}).items():
        check_schema(part, f"{at}.{name}")
    if "items" in schema:
        check_schema(schema["items"], f"{at}[]")


def _is(value, kind: str) -> bool:
    if kind == "integer":
        return (isinstance(value, int) and not isinstance(value, bool)) or (isinstance(value, float) and value.is_integer())
    if kind == "number":
        return isinstance(value, (int, float)) and not isinstance(value, bool) and math.isfinite(value)
    return isinstance(value, TYPES[kind])


def schema_error(value, schema: dict, at: str = "$") -> str | None:
    """The first way in which `value` breaks `schema`, or None.

    Understands type, enum, required, properties, additionalProperties (false), items, minimum, maximum,
    minLength and maxLength.
    """
    kinds = schema.get("type")
    if kinds is not None and not any(_is(value, k) for k in ([kinds] if isinstance(kinds, str) else kinds)):
        return f"{at}: not {kinds if isinstance(kinds, str) else ' or '.join(kinds)}"
    if "enum" in schema and value not in schema["enum"]:
        return f"{at}: not in enum"
    if isinstance(value, dict):
        for name in schema.get("required", []):
            if name not in value:
                return f"{at}.{name}: missing"
        known = schema.get("properties", {})
        for name in sorted(value):
            if name in known:
                error = schema_error(value[name], known[name], f"{at}.{name}")
                if error:
                    return error
            elif schema.get("additionalProperties") is False:
                return f"{at}.{name}: unknown"
    if isinstance(value, list) and "items" in schema:
        for k, item in enumerate(value):
            error = schema_error(item, schema["items"], f"{at}[{k}]")
            if error:
                return error
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if value < schema.get("minimum", value) or value > schema.get("maximum", value):
            return f"{at}: out of range"
    if isinstance(value, str) and not schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", len(value)):
        return f"{at}: wrong length"
    return None


def references(value) -> list[str]:
    """Identifiers of calls whose results the arguments use, written {"$result": id} at any depth."""
    found, todo = [], [value]
    while todo:
        v = todo.pop()
        if isinstance(v, dict):
            if isinstance(v.get("$result"), str) and not _LONE.search(v["$result"]):
                found.append(v["$result"])
            todo += v.values()
        elif isinstance(v, list):
            todo += v
    return sorted(set(found))


def message_items(role: str | None, text: str | None, schemas: dict[str, dict]) -> list[tuple]:
    """(kind, call_id, name, refs, error, json) of each item of a message.

    A message is an object in JSON with `tool_calls` (a list of {id, name, arguments}), or with `tool_call_id` and
    `content` (a result); any other text is a plain message, itself.  Arguments may be an object or JSON text.
    """
    try:
        body = parsed_json(text) if text and text.lstrip()[:1] == "{" else None
    except (ValueError, RecursionError):
        body = None
    if isinstance(body, dict) and isinstance(body.get("tool_calls"), list) and body["tool_calls"]:
        out = []
        for call in body["tool_calls"]:
            call = call if isinstance(call, dict) else {}
            ident, name, arguments = call.get("id"), call.get("name"), call.get("arguments", {})
            ident = _name(ident)
            if isinstance(arguments, str):
                try:
                    arguments = parsed_json(arguments)
                except (ValueError, RecursionError):
                    pass
            if ident is None:
                error = "no id"
            elif not isinstance(name, str) or name not in schemas:
                error = "unknown tool"
            else:
                error = schema_error(arguments, schemas[name])
            made = {"role": role, "tool_call": {"id": ident, "name": name, "arguments": arguments}}
            out.append(("call", ident, _name(name) if isinstance(name, str) else None, references(arguments), error and _LONE.sub("?", error), canonical(made)))
        return out
    if isinstance(body, dict) and "tool_call_id" in body:
        ident = body["tool_call_id"]
        ident = _name(ident)
        return [("result", ident, None, [], None, canonical({"role": role, "tool_call_id": ident, "content": body.get("content")}))]
    return [("message", None, None, [], None, canonical({"role": role, "content": text}))]


ITEM = "conv_id long, turn long, item long, kind string, call_id string, name string, refs array<string>, error string, json string"


def read_items(messages: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """ITEM rows of `messages` (conv_id, turn, role, text); `item` numbers those of a message from 0."""

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.list_(pa.string()), pa.string(), pa.string()]
        names = [f.split()[0] for f in ITEM.split(", ")]
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text"))
            out = [(conv, turn, k, *x) for conv, turn, role, text in zip(*columns, strict=True) for k, x in enumerate(message_items(role, text, schemas))]
            made = list(zip(*out, strict=True)) or [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(made, kinds, strict=True)], names=names)

    return messages.mapInArrow(parsed, ITEM)


def linked(messages: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per item: (conv_id, turn, item, kind, call_id, name, status, error, sort_turn, level, json).

    `status`: for calls "linked", "pending" (no result) or "invalid" (the arguments break the schema; `error` says how); for
    results "linked" or "orphan" (no call); "cycle" for items whose references never resolve; null for plain messages.  The n-th result
    of an identifier belongs to its n-th call, in order of turns; a reference means the first.

    Sorting by (conv_id, sort_turn, level, turn, item) puts every item behind those it depends on: a result behind its call, a call
    behind the results its arguments use.  `sort_turn` is the last turn among an item and all before it, so a conversation in order
    keeps its order.  Levels are found in rounds, as many as the longest chain of references.

    NaN, infinite numbers and halves of surrogate pairs: text with the first two is no JSON; an identifier with the last is none, elsewhere
    they stay escaped.  A schema with an unknown type is an error before anything runs.

    Null ids never link; null roles and texts are kept as null in the JSON; text that is not such JSON, empty or very long, is a plain
    message; repeated rows are items of their own; an empty table gives no rows; other columns are not read.
    """
    for name, schema in schemas.items():
        check_schema(schema, name)
    bounded_batches(messages.sparkSession)
    items = written(read_items(messages.select("conv_id", "turn", "role", "text"), schemas).withColumn("key", F.monotonically_increasing_id()))
    nth = F.row_number().over(Window.partitionBy("kind", "conv_id", "call_id").orderBy("turn", "item", "key"))
    joinable = items.where("kind <> 'message' and call_id is not null and conv_id is not null").select("key", "kind", "conv_id", "call_id", nth.alias("nth"))
    calls = joinable.where("kind = 'call'").select(F.col("key").alias("call_key"), "conv_id", "call_id", "nth")
    results = joinable.where("kind = 'result'").select(F.col("key").alias("result_key"), "conv_id", "call_id", "nth")
    pairs = written(calls.join(results, ["conv_id", "call_id", "nth"]).select("call_key", "result_key", "conv_id", "call_id", "nth"))
    # what must come first: a result's call, and the results that a call's arguments use
    uses = items.where("kind = 'call'").select(F.col("key").alias("later"), "conv_id", F.explode("refs").alias("call_id"))
    used = uses.join(pairs.where("nth = 1"), ["conv_id", "call_id"]).select("later", F.col("result_key").alias("earlier"))
    edges = written(used.unionByName(pairs.select(F.col("result_key").alias("later"), F.col("call_key").alias("earlier"))).distinct())
    placed = _levels(items.select("key", "turn"), edges)
    met = pairs.select(F.col("call_key").alias("pair_key")).unionByName(pairs.select(F.col("result_key").alias("pair_key")))
    status = F.when(F.col("kind") == "message", F.lit(None)).when(F.col("level").isNull(), "cycle").when(F.col("error").isNotNull(), "invalid") \
        .when(F.col("pair_key").isNotNull(), "linked").when(F.col("kind") == "call", "pending").otherwise("orphan")
    return items.join(placed, "key").join(met, F.col("key") == F.col("pair_key"), "left") \
        .select("conv_id", "turn", "item", "kind", "call_id", "name", status.alias("status"), "error", "sort_turn", "level", "json")


def _levels(items: DataFrame, edges: DataFrame) -> DataFrame:
    """(key, sort_turn, level) of `items` (key, turn): level 0 depends on nothing; null where a cycle is in the way."""
    waiting = edges.select(F.col("later").alias("key")).distinct()
    done = written(items.join(waiting, "key", "left_anti").select("key", F.col("turn").alias("sort_turn"), F.lit(0).alias("level")))
    out, fresh, open_edges = done, done, edges
    while True:
        seen = fresh.select(F.col("key").alias("earlier"), F.col("sort_turn").alias("t"), F.col("level").alias("l"))
        if open_edges.isEmpty():
            break
        # an edge keeps what it has learned of its earlier end; an item is ready when all its edges have
        if "et" not in open_edges.columns:
            open_edges = open_edges.withColumn("et", F.lit(None).cast("long")).withColumn("el", F.lit(None).cast("int"))
        told = written(open_edges.join(seen, "earlier", "left").select("later", "earlier", F.coalesce("et", "t").alias("et"), F.coalesce("el", "l").alias("el")))
        ready = told.groupBy("later").agg(F.count("*").alias("n"), F.count("el").alias("known"), F.max("et").alias("et"), F.max("el").alias("el")) \
            .where("n = known").select(F.col("later").alias("key"), "et", "el")
        fresh = written(ready.join(items, "key").select("key", F.greatest("turn", "et").alias("sort_turn"), (F.col("el") + 1).alias("level")))
        if fresh.isEmpty():
            break
        out = out.unionByName(fresh)
        open_edges = told.join(fresh.select(F.col("key").alias("later")), "later", "left_anti")
    stuck = items.join(out.select("key"), "key", "left_anti").select("key", F.col("turn").alias("sort_turn"), F.lit(None).cast("int").alias("level"))
    return out.unionByName(stuck)


def transcripts(items: DataFrame) -> DataFrame:
    """(conv_id, transcript): the items of each conversation that `linked` has placed, a line of canonical JSON each, in their order.

    Items on a cycle come last.  A conversation is one text, joined from slices; one beyond Spark's value size is an error.
    """
    place = F.struct(F.coalesce("sort_turn", "turn").alias("sort_turn"), F.coalesce("level", F.lit(1 << 30)).alias("level"), "turn", "item")
    cycles = F.struct(F.col("level").isNull().alias("late"), place.alias("place"))
    return concat_group(items.withColumn("_order", cycles), ["conv_id"], "json", "_order", sep="\n", out="transcript")
