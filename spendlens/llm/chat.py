"""Tool calls in conversations: linked to their results, ordered, validated and written as canonical JSON."""

from __future__ import annotations

import json
import math
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.session import materialize

from .batches import arrow_map, slices, texts_of

#: JSON types by the name that a schema gives them. A boolean is no number.
JSON_TYPES = {
    "string": lambda v: isinstance(v, str), "boolean": lambda v: isinstance(v, bool), "null": lambda v: v is None,
    "integer": lambda v: isinstance(v, int) and not isinstance(v, bool) or isinstance(v, float) and v.is_integer(),
    "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool),
    "array": lambda v: isinstance(v, list), "object": lambda v: isinstance(v, dict),
}


def canonical(value: object) -> str:
    """JSON with sorted keys and without blanks; whole numbers without a point, text unescaped where JSON allows."""
    return json.dumps(plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def plain(value: object) -> object:
    if isinstance(value, dict):
        return {k: plain(v) for k, v in value.items()}
    if isinstance(value, list):
        return [plain(v) for v in value]
    return int(value) if isinstance(value, float) and value.is_integer() and abs(value) < 2**53 else value


def parsed(text: str | None) -> object:
    """The JSON value of a text; None if it is none, or has no canonical form: NaN, infinities and numbers too large for
    a double, halves of a surrogate pair, nesting too deep to read or write."""

    def refuse(name: str):
        raise ValueError(name)

    def number(digits: str) -> float:
        value = float(digits)
        return value if math.isfinite(value) else refuse(digits)

    try:
        value = json.loads(text, parse_constant=refuse, parse_float=number) if text else None
        canonical(value).encode()
    except (ValueError, RecursionError):
        return None
    return value


def violations(value: object, schema: dict, at: str = "") -> list[str]:
    """Where a value breaks a JSON schema: type, enum, required, properties, additionalProperties, items."""
    name = at or "arguments"
    kinds = schema.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(JSON_TYPES[k](value) for k in kinds):
        return [f"{name}: not {' or '.join(kinds)}"]
    out = [f"{name}: not one of the values"] if "enum" in schema and value not in schema["enum"] else []
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{name}.{k}: missing" for k in schema.get("required", []) if k not in value]
        for key in sorted(value):
            if key in known:
                out += violations(value[key], known[key], f"{name}.{key}")
            elif schema.get("additionalProperties") is False:
                out.append(f"{name}.{key}: unknown")
    if isinstance(value, list) and isinstance(schema.get("items"), dict):
        for k, item in enumerate(value):
            out += violations(item, schema["items"], f"{name}[{k}]")
    return out


CALLS = "conv_id {kind}, turn long, place int, call_id string, name string, arguments string, after array<string>"
RESULTS = "conv_id {kind}, turn long, call_id string, content string"


def _rows(names: list[str], kinds: Iterable[pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def text_or_none(value: object) -> str | None:
    return value if isinstance(value, str) else None if value is None else canonical(value)


def calls_of(messages: DataFrame) -> DataFrame:
    """Tool calls of the assistant's messages (conv_id, turn, role, text), one row each.

    A message that makes calls is JSON: {"tool_calls": [{"id", "function": {"name", "arguments"}, "after": [ids]}]}.
    Other texts make none. Calls without an id get a NULL one.
    """
    rows = messages.where("role = 'assistant'").select("conv_id", F.col("turn").cast("long").alias("turn"), "text")
    names = ["conv_id", "turn", "place", "call_id", "name", "arguments", "after"]

    def step(batches):
        for batch in slices(batches, "text"):
            out = []
            heads = zip(batch.column("conv_id").to_pylist(), batch.column("turn").to_pylist(), texts_of(batch, "text"))
            for conv, turn, text in heads:
                value = parsed(text) if text[:1] == "{" else None
                calls = value.get("tool_calls") if isinstance(value, dict) else None
                for place, call in enumerate(calls if isinstance(calls, list) else []):
                    if not isinstance(call, dict):
                        continue
                    function = call["function"] if isinstance(call.get("function"), dict) else {}
                    after = call["after"] if isinstance(call.get("after"), list) else []
                    out.append((
                        conv, turn, place, text_or_none(call.get("id")), text_or_none(function.get("name")),
                        text_or_none(function.get("arguments")), [a for a in after if isinstance(a, str)],
                    ))
            kinds = [batch.schema.field("conv_id").type, pa.int64(), pa.int32(), *[pa.string()] * 3, pa.list_(pa.string())]
            yield _rows(names, kinds, out)

    return arrow_map(rows, step, CALLS.format(kind=rows.schema["conv_id"].dataType.simpleString()))


def results_of(messages: DataFrame) -> DataFrame:
    """Results in the tool's messages, JSON like {"tool_call_id", "content"}; other texts are no results."""
    rows = messages.where("role = 'tool'").select("conv_id", F.col("turn").cast("long").alias("turn"), "text")

    def step(batches):
        for batch in slices(batches, "text"):
            out = []
            heads = zip(batch.column("conv_id").to_pylist(), batch.column("turn").to_pylist(), texts_of(batch, "text"))
            for conv, turn, text in heads:
                value = parsed(text) if text[:1] == "{" else None
                if isinstance(value, dict) and "tool_call_id" in value:
                    out.append((conv, turn, text_or_none(value["tool_call_id"]), text_or_none(value.get("content"))))
            kinds = [batch.schema.field("conv_id").type, pa.int64(), pa.string(), pa.string()]
            yield _rows(["conv_id", "turn", "call_id", "content"], kinds, out)

    return arrow_map(rows, step, RESULTS.format(kind=rows.schema["conv_id"].dataType.simpleString()))


KEY = ["conv_id", "call_id"]


def linked(calls: DataFrame, results: DataFrame) -> DataFrame:
    """Calls joined with results by conversation and identifier; one row for each identifier.

    The first call (turn, place, name, arguments) and the first result (turn, content) of an identifier count;
    ``n_calls`` and ``n_results`` tell how many there are. ``status``: linked, early (the result stands before the
    call), unanswered, orphan (a result without a call). Calls and results without an identifier stay rows of their
    own: unanswered or orphan.
    """
    order = F.struct("turn", "place", "name", "arguments", "after")
    named = calls.where("call_id is not null and conv_id is not null")
    first = named.groupBy(*KEY).agg(F.min(order).alias("call"), F.count("*").alias("n_calls"))
    answers = results.where("call_id is not null and conv_id is not null").groupBy(*KEY).agg(
        F.min(F.struct("turn", "content")).alias("result"), F.count("*").alias("n_results")
    )
    both = first.join(answers, KEY, "full")
    lone = calls.where("call_id is null or conv_id is null").select(
        *KEY, order.alias("call"), F.lit(1).cast("long").alias("n_calls"), F.lit(None).alias("result"), F.lit(0).cast("long").alias("n_results")
    )
    stray = results.where("call_id is null or conv_id is null").select(
        *KEY, F.lit(None).alias("call"), F.lit(0).cast("long").alias("n_calls"), F.struct("turn", "content").alias("result"),
        F.lit(1).cast("long").alias("n_results"),
    )
    status = (
        F.when(F.col("call").isNull(), "orphan").when(F.col("result").isNull(), "unanswered")
        .when(F.col("result.turn") < F.col("call.turn"), "early").otherwise("linked")
    )
    return both.unionByName(lone).unionByName(stray).withColumn("status", status).select(
        *KEY, F.col("call.turn").alias("turn"), F.col("call.place").alias("place"), F.col("call.name").alias("name"),
        F.col("call.arguments").alias("arguments"), F.coalesce("call.after", F.array()).alias("after"),
        F.col("result.turn").alias("result_turn"), F.col("result.content").alias("content"), "status",
        F.coalesce("n_calls", F.lit(0)).alias("n_calls"), F.coalesce("n_results", F.lit(0)).alias("n_results"),
    )


def levels(rows: DataFrame) -> DataFrame:
    """Topological level of each named call: 0 without calls to wait for, else one more than the highest of those.

    Identifiers that are no calls of the conversation are not waited for. Jumps of 1, 2, 4, ... waits are made of two
    jumps of half their length; a call's level is then the sum of the jumps that it can make one after the other,
    longest first. So the longest chain of n calls takes about 2 log n rounds, in all conversations at once. A path as
    long as its conversation has calls means a cycle: calls in one, or after one, get no row.
    """
    calls = rows.where("call_id is not null and conv_id is not null and status != 'orphan'").select(*KEY, "after")
    calls = materialize(calls, "calls")
    waits = calls.select(*KEY, F.explode(F.array_distinct("after")).alias("other"))
    known = calls.select("conv_id", F.col("call_id").alias("other"))
    jumps = [materialize(waits.join(known, ["conv_id", "other"], "left_semi"), "waits")]
    sizes = calls.groupBy("conv_id").agg(F.count("*").alias("size"))
    longest = sizes.agg(F.max("size")).first()[0] or 0
    # a path of so many waits passes some call twice
    while not jumps[-1].isEmpty() and 1 << len(jumps) - 1 < longest:
        half = jumps[-1]
        on = half.select("conv_id", F.col("call_id").alias("other"), F.col("other").alias("next"))
        jumps.append(materialize(half.join(on, ["conv_id", "other"]).select(*KEY, F.col("next").alias("other")).distinct(), "jumps"))
    endless = jumps[-1].select(*KEY).distinct()
    at = calls.select(*KEY).join(endless, KEY, "left_anti").select(*KEY, F.col("call_id").alias("other"), F.lit(0).alias("level"))
    for k in reversed(range(len(jumps) - 1)):
        step = jumps[k].select("conv_id", F.col("call_id").alias("other"), F.col("other").alias("next"))
        gone = at.join(step, ["conv_id", "other"]).select(*KEY, F.col("next").alias("other"), (F.col("level") + (1 << k)).alias("level"))
        gone = materialize(gone.distinct(), "gone")
        at = materialize(gone.unionByName(at.join(gone.select(*KEY).distinct(), KEY, "left_anti")), "levels")
    return at.select(*KEY, "level").distinct()


def formatted(rows: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """``rows`` with ``valid``, ``errors`` (where arguments break their function's schema) and ``line``, the call and
    its result as canonical JSON. Orphans are neither valid nor not (NULL). Unknown functions and arguments that are no
    JSON object are errors."""
    names = [*rows.columns, "valid", "errors", "line"]

    def step(batches):
        for batch in slices(batches, "content"):
            out: list[list] = [[], [], []]
            fields = ["call_id", "name", "arguments", "content", "status", "level"]
            for key, name, arguments, content, status, level in zip(*(batch.column(f).to_pylist() for f in fields)):
                value = parsed(arguments)
                errors = []
                if status != "orphan":
                    if name not in schemas:
                        errors.append("unknown function")
                    elif not isinstance(value, dict):
                        errors.append("arguments: not a JSON object")
                    else:
                        errors += violations(value, schemas[name])
                    if level is None and key is not None:
                        errors.append("after: waits for itself")
                call = None if status == "orphan" else {"name": name, "arguments": value if value is not None else arguments}
                line = {"id": key, "call": call, "result": content, "status": status}
                out[0].append(None if status == "orphan" else not errors)
                out[1].append(errors)
                out[2].append(canonical(line))
            kinds = [pa.bool_(), pa.list_(pa.string()), pa.string()]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, k) for c, k in zip(out, kinds))], names=names)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return arrow_map(rows, step, f"{schema}, valid boolean, errors array<string>, line string")


def link_tool_calls(messages: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """All calls and results of ``messages`` (conv_id, turn, role, text), linked, ordered, checked and serialised.

    One row for each call identifier and each stray result: conv_id, call_id, turn, place, name, result_turn, status,
    n_calls, n_results, level, valid, errors, line. Sorting a conversation by (level, turn, place, call_id) is a
    topological order; a NULL level means a cycle, or no identifier. Messages that neither call nor answer give no
    rows; empty tables give none. Null texts are empty. Extra columns do not matter.
    """
    rows = materialize(linked(calls_of(messages), results_of(messages)), "calls")
    ordered = rows.join(levels(rows), KEY, "left")
    return formatted(ordered, schemas).drop("arguments", "after", "content")
