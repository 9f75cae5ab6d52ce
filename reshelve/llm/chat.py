"""Chat formatting: tool calls linked to their results, ordered, validated and written as JSON.

Calls and results are joined by identifier. A call may refer to results of other calls as
``{"$result": id}`` anywhere in its arguments; it is placed after them, and a result after its
call, by Kahn's method: each round places the calls all of whose references are placed. Arguments
are checked against the schema of their tool, and every row is written as canonical JSON: keys
sorted, no white space, whole numbers without a fraction.

The result has a row per message, call and result. Within a conversation, `place`, `part`, `turn`
and `json` give the order; rows are range-partitioned and sorted by them, so a conversation of any
size is split over tasks.

Results in odd cases, told in `status`:

* `no_result` and `no_call`: a call never answered, a result of an unknown call or a null identifier.
* `duplicate`: of several calls with an identifier the first by conversation, turn and content
  counts; the others are written, but linked to nothing. Rows that are wholly equal count once.
* `cycle`: calls that wait for one another or on such calls stay at their own turn.
* `invalid`: arguments that are no JSON, break the schema, name an unknown tool or refer to an
  unknown call; `errors` says which. A null text is the empty string, null arguments are `{}`.
* Several results of a call are all kept. Null conversations and turns come first.
* Empty tables give an empty result; other columns are dropped.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from reshelve.session import stored

MESSAGE, CALL, RESULT = range(3)

ANSWER_SCHEMA = {
    "type": "object",
    "properties": {
        "prompt": {"type": "string", "minLength": 1},
        "turn": {"type": "integer", "minimum": 0},
        "context": {"type": "object", "properties": {"$result": {"type": "string"}},
                    "required": ["$result"], "additionalProperties": False}},
    "required": ["prompt", "turn"], "additionalProperties": False}


def canonical(value) -> str:
    """Canonical JSON of a parsed value."""
    if isinstance(value, dict):
        keys = sorted(value, key=lambda k: k.encode("utf-16-be", "surrogatepass"))
        return "{" + ",".join(f"{canonical(k)}:{canonical(value[k])}" for k in keys) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(canonical, value)) + "]"
    if isinstance(value, float) and value.is_integer() and abs(value) < 1 << 53:
        value = int(value)
    return json.dumps(value, ensure_ascii=False, allow_nan=False)


_TYPES = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}


def _is_type(value, name: str) -> bool:
    number = isinstance(value, (int, float)) and not isinstance(value, bool)
    if name == "integer":
        return number and float(value).is_integer()
    return number if name == "number" else isinstance(value, _TYPES[name])


def violations(value, schema: dict, at: str = "$") -> list[str]:
    """Where a value breaks a schema; the usual keywords for types, bounds, members and choices."""
    kinds = schema.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_is_type(value, k) for k in kinds):
        return [f"{at}: type"]
    found = []
    if "enum" in schema and value not in schema["enum"]:
        found.append(f"{at}: enum")
    if _is_type(value, "number"):
        found += [f"{at}: {key}" for key, broken in (
            ("minimum", value < schema.get("minimum", value)),
            ("maximum", value > schema.get("maximum", value))) if broken]
    if isinstance(value, (str, list)):
        low, high = ("minLength", "maxLength") if isinstance(value, str) else \
            ("minItems", "maxItems")
        found += [f"{at}: {key}" for key, broken in (
            (low, len(value) < schema.get(low, 0)),
            (high, len(value) > schema.get(high, len(value)))) if broken]
    if isinstance(value, list) and "items" in schema:
        for i, item in enumerate(value):
            found += violations(item, schema["items"], f"{at}[{i}]")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        found += [f"{at}.{key}: required" for key in schema.get("required", [])
                  if key not in value]
        if schema.get("additionalProperties") is False:
            found += [f"{at}.{key}: unknown" for key in sorted(value) if key not in known]
        for key in known:
            if key in value:
                found += violations(value[key], known[key], f"{at}.{key}")
    return found


def references(value) -> list[str]:
    """The identifiers that a value refers to."""
    if isinstance(value, dict):
        if isinstance(value.get("$result"), str):
            return [value["$result"]]
        value = list(value.values())
    if isinstance(value, list):
        return sorted({r for item in value for r in references(item)})
    return []


def _refuse(constant):
    raise ValueError(constant)


def read_calls(calls: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """Calls with their canonical arguments, references and violations; schemas are a parameter."""

    @F.pandas_udf("canonical string, refs array<string>, errors array<string>")
    def checked(names: pd.Series, arguments: pd.Series) -> pd.DataFrame:
        rows = []
        for name, text in zip(names, arguments):
            try:
                value = json.loads("{}" if text is None else text, parse_constant=_refuse)
            except (ValueError, RecursionError):
                rows.append((canonical(text), [], ["$: not JSON"]))
                continue
            errors = violations(value, schemas[name]) if name in schemas else ["$: unknown tool"]
            rows.append((canonical(value), references(value), errors))
        return pd.DataFrame(rows, columns=["canonical", "refs", "errors"])

    rows = calls.withColumn("read", checked("name", "arguments"))
    return rows.select("conv_id", "turn", "call_id", "name", "read.*")


def place_calls(calls: DataFrame, results: DataFrame) -> DataFrame:
    """(call_id, place, cycle) of first calls (call_id, turn, refs); one round per level."""
    answered = results.groupBy("call_id").agg(F.max("turn").alias("last"))
    edges = calls.select("call_id", F.explode("refs").alias("ref")).distinct()
    edges = stored(edges.join(calls.select(F.col("call_id").alias("ref")), "ref"))
    turns = calls.select("call_id", "turn")
    done = stored(turns.join(edges, "call_id", "left_anti").select(
        "call_id", F.col("turn").alias("place")))
    while not edges.isEmpty():
        ends = done.join(answered, "call_id", "left").select(
            F.col("call_id").alias("ref"), F.greatest("place", "last").alias("end"))
        ready = stored(
            edges.join(ends, "ref", "left").groupBy("call_id")
            .agg(F.max("end").alias("end"), F.count_if(F.col("end").isNull()).alias("open"))
            .where("open = 0").join(turns, "call_id")
            .select("call_id", F.greatest("turn", F.col("end") + 1).alias("place")))
        if ready.isEmpty():
            break
        done = done.union(ready)
        edges = stored(edges.join(ready, "call_id", "left_anti"))
    waiting = edges.select("call_id").distinct().join(turns, "call_id")
    return done.withColumn("cycle", F.lit(False)).union(
        waiting.select("call_id", F.col("turn").alias("place"), F.lit(True).alias("cycle")))


def _json(**members: Column) -> Column:
    """One JSON object of members that are already canonical JSON, in the order of their keys."""
    parts = [F.concat(F.lit(f'"{key}":'), members[key]) for key in sorted(members)]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def format_chat(messages: DataFrame, calls: DataFrame, results: DataFrame,
                schemas: dict[str, dict]) -> DataFrame:
    """All rows as JSON with their order and status.

    messages: conv_id, turn, role, text; calls: conv_id, turn, call_id, name, arguments;
    results: conv_id, turn, call_id, text.
    """

    @F.pandas_udf("string")
    def quoted(texts: pd.Series) -> pd.Series:
        return pd.Series([canonical("" if t is None else t) for t in texts], dtype=object)

    calls = stored(read_calls(
        calls.select("conv_id", "turn", "call_id", "name", "arguments").distinct(), schemas))
    results = results.select("conv_id", "turn", "call_id", "text").distinct()
    # Calls of one identifier are few by nature; the window's limit is applied before its shuffle.
    order = Window.partitionBy("call_id").orderBy("conv_id", "turn", "name", "canonical")
    first = stored(calls.where("call_id is not null").withColumn(
        "nth", F.row_number().over(order)).where("nth = 1").drop("nth"))
    placed = place_calls(first, results)
    unknown = (first.select("call_id", F.explode("refs").alias("ref"))
               .join(first.select(F.col("call_id").alias("ref")), "ref", "left_anti")
               .groupBy("call_id").agg(F.sort_array(F.collect_set(
                   F.concat(F.lit("$: unknown call "), "ref"))).alias("strange")))
    replied = results.select("call_id").distinct().withColumn("replied", F.lit(True))
    linked = (first.join(placed, "call_id").join(unknown, "call_id", "left")
              .join(replied, "call_id", "left"))
    errors = F.concat("errors", F.coalesce("strange", F.array().cast("array<string>")))
    linked = linked.select(
        "conv_id", "turn", "call_id", "name", "canonical", "place", errors.alias("errors"),
        F.when(F.col("cycle"), "cycle").when(F.size(errors) > 0, "invalid")
        .when(F.col("replied").isNull(), "no_result").otherwise("ok").alias("status"))
    same = ("conv_id", "turn", "call_id", "name", "canonical")
    counted = first.select(*[F.col(c).alias(f"first_{c}") for c in same])
    again = calls.join(counted, [F.col(c).eqNullSafe(F.col(f"first_{c}")) for c in same],
                       "left_anti")
    again = again.select(*same, F.col("turn").alias("place"), "errors", F.when(
        F.col("call_id").isNull(), "no_result").otherwise("duplicate").alias("status"))
    written = linked.union(again).select(
        "conv_id", "place", "turn", F.lit(CALL).alias("part"), "call_id", "status", "errors",
        _json(role=F.lit('"assistant"'), tool_call=_json(
            id=quoted("call_id"), name=quoted("name"), arguments=F.col("canonical"))).alias("json"))
    ends = placed.select("call_id", F.col("place").alias("start"))
    none = F.array().cast("array<string>")
    answers = results.join(ends, "call_id", "left").select(
        "conv_id", F.greatest("turn", "start").alias("place"), "turn", F.lit(RESULT).alias("part"),
        "call_id", F.when(F.col("start").isNull(), "no_call").otherwise("ok").alias("status"),
        none.alias("errors"),
        _json(role=F.lit('"tool"'), id=quoted("call_id"), content=quoted("text")).alias("json"))
    plain = messages.select("conv_id", "turn", "role", "text").distinct().select(
        "conv_id", F.col("turn").alias("place"), "turn", F.lit(MESSAGE).alias("part"),
        F.lit(None).cast("string").alias("call_id"), F.lit("ok").alias("status"),
        none.alias("errors"),
        _json(role=quoted("role"), content=quoted("text")).alias("json"))
    order = ["conv_id", "place", "part", "turn", "json"]
    return plain.union(written).union(answers).repartitionByRange(*order).sortWithinPartitions(
        *order)


def op9_chat(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation with its questions as tool calls and its answers as their results.

    The table holds plain turns, so a user's turn also makes a call of the tool `answer`, with
    the conversation and turn as identifier; later ones refer to the result of the conversation's
    first. The assistant's next turn is its result.
    """
    turns = spark.read.parquet(f"{folder}/conversations.parquet").select(
        "conv_id", "turn", "role", "text")
    key = F.concat_ws(":", "conv_id", "turn")
    asked = turns.where("role = 'user'").select("conv_id", "turn", "text", key.alias("call_id"))
    first = asked.groupBy("conv_id").agg(F.min("turn").alias("first"))
    asked = asked.join(first, "conv_id")
    context = F.when(F.col("turn") > F.col("first"), F.struct(
        F.concat_ws(":", "conv_id", "first").alias("$result")))
    calls = asked.select("conv_id", "turn", "call_id", F.lit("answer").alias("name"), F.to_json(
        F.struct(F.coalesce("text", F.lit("")).alias("prompt"), "turn",
                 context.alias("context"))).alias("arguments"))
    results = turns.where("role = 'assistant'").select(
        "conv_id", "turn", F.concat_ws(":", "conv_id", F.col("turn") - 1).alias("call_id"), "text")
    return format_chat(turns, calls, results, {"answer": ANSWER_SCHEMA})
