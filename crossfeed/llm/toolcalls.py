"""Chat formatting: tool calls linked to their results, ordered, validated and written as canonical JSON.

Calls and results meet by a hash join on the call's identifier. A call may name a parent whose result it uses; the depth
of a call is the number of calls above it, so sorting by (root_id, depth, call_id) is a topological order. Depths come
from pointer doubling: a chain of n calls takes log2(n) joins, and what is open after that many lies on or below a cycle.
Arguments are checked against JSON schemas by expressions made from the schemas. Everything is DataFrame operations.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crossfeed.llm.common import settled

#: Variant types, as Spark names them, of each JSON schema type.
JSON_TYPES = {
    "string": ["STRING"], "boolean": ["BOOLEAN"], "null": ["VOID"], "integer": ["BIGINT"],
    "number": ["BIGINT", "DOUBLE", "FLOAT", "DECIMAL"], "object": ["OBJECT"], "array": ["ARRAY"],
}


def canonical(json: Column) -> Column:
    """JSON text with sorted keys, no blanks and plain numbers; NULL where it is no JSON or a key comes twice."""
    return F.to_json(F.try_parse_json(json))


def _kind(value: Column) -> Column:
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def _field_errors(name: str, rule: dict, value: Column) -> Column:
    """The first rule of a field that a present value breaks; NULL if it keeps all. Rules are JSON schema's."""
    kind = _kind(value)
    text = F.when(kind == "STRING", F.try_variant_get(value, "$", "string"))
    number = F.when(kind.isin(JSON_TYPES["number"]), F.try_variant_get(value, "$", "double"))
    broken = []
    if "type" in rule:
        wanted = [rule["type"]] if isinstance(rule["type"], str) else rule["type"]
        broken.append((~kind.isin([k for t in wanted for k in JSON_TYPES[t]]), "type"))
    for key, test in (("minLength", lambda x: F.length(text) < x), ("maxLength", lambda x: F.length(text) > x),
                      ("minimum", lambda x: number < x), ("maximum", lambda x: number > x),
                      ("enum", lambda x: ~text.isin(x))):
        if key in rule:
            broken.append((test(rule[key]), key))
    error = F.lit(None).cast("string")
    for wrong, key in reversed(broken):
        error = F.when(F.coalesce(wrong, F.lit(False)), F.lit(f"{name}: {key}")).otherwise(error)
    return error


def validate(name: Column, arguments: Column, schemas: dict[str, dict]) -> Column:
    """What is wrong with a call's arguments (JSON text): an array of texts, empty for a valid call.

    Known of JSON schema: required, additionalProperties false, and per property type, enum (of texts), minLength,
    maxLength, minimum, maximum. NULL or broken JSON gives ``no object``; an unknown or NULL name ``unknown tool``.
    """
    parsed = F.try_parse_json(arguments)
    is_object = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False))
    fields = F.when(is_object, parsed.cast("map<string,variant>"))
    result = F.array(F.lit("unknown tool"))
    for tool, schema in schemas.items():
        properties, errors = schema.get("properties", {}), []
        for field in schema.get("required", []):
            errors.append(F.when(~F.map_contains_key(fields, field), F.lit(f"{field}: required")))
        for field, rule in properties.items():
            value = F.try_element_at(fields, F.lit(field))
            errors.append(F.when(F.map_contains_key(fields, field), _field_errors(field, rule, value)))
        if schema.get("additionalProperties") is False:
            known = F.array(*[F.lit(f) for f in properties]) if properties else F.array().cast("array<string>")
            extra = F.array_sort(F.array_except(F.map_keys(fields), known))
            errors.append(F.when(F.size(extra) > 0, F.concat(F.get(extra, F.lit(0)), F.lit(": unknown field"))))
        listed = F.array_compact(F.array(*errors)) if errors else F.array().cast("array<string>")
        result = F.when(name == tool, listed).otherwise(result)
    return F.when(is_object, result).otherwise(F.array(F.lit("no object")))


def depths(calls: DataFrame) -> DataFrame:
    """(call_id, root_id, depth) of calls (call_id unique, parent_id); both NULL on and below a cycle.

    A parent that is not among the calls counts as none.
    """
    known = calls.select(F.col("call_id").alias("known_id"))
    linked = calls.join(known, F.col("parent_id") == F.col("known_id"), "left")
    state = settled(linked.select(
        "call_id", F.col("known_id").alias("hop"), F.when(F.col("known_id").isNull(), F.col("call_id")).alias("root_id"),
        F.when(F.col("known_id").isNull(), 0).otherwise(1).cast("long").alias("depth")))
    total, left = state.count(), state.filter("hop IS NOT NULL").count()
    for _ in range(math.ceil(math.log2(max(total, 2))) + 1):
        if not left:
            break
        step = state.select(F.col("call_id").alias("hop_id"), F.col("hop").alias("next_hop"),
                            F.col("root_id").alias("next_root"), F.col("depth").alias("more"))
        moved = (state.filter("hop IS NOT NULL").join(step, F.col("hop") == F.col("hop_id"))
                 .select("call_id", F.col("next_hop").alias("hop"), F.col("next_root").alias("root_id"),
                         (F.col("depth") + F.col("more")).alias("depth")))
        state = settled(state.filter("hop IS NULL").unionByName(moved))
        left = state.filter("hop IS NOT NULL").count()
    return state.select("call_id", "root_id", F.when(F.col("hop").isNull(), F.col("depth")).alias("depth"))


def _first_of_each(rows: DataFrame, order: list[str]) -> DataFrame:
    """Settled rows (key, call_id, ...), with ``first`` and ``n``: whether a row stands for its identifier, and its count.

    The first row by ``order`` stands for an identifier; rows without one stand for nothing. Both by a combined minimum,
    so rows that share an identifier are not brought together.
    """
    lowest = F.min(F.struct(*[part for name in order for part in (F.col(name).isNull(), F.col(name))], "key"))
    firsts = (rows.filter("call_id IS NOT NULL").groupBy("call_id").agg(lowest["key"].alias("first_key"), F.count("*").alias("n"))
              .select("first_key", "n"))
    joined = rows.join(firsts, F.col("key") == F.col("first_key"), "left")
    return joined.withColumn("first", F.col("first_key").isNotNull()).drop("first_key")


def link(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """Every call (call_id, seq, name, arguments, parent_id) and every result (call_id, seq, content), linked by identifier.

    call_id, name, root_id, depth, status, errors, n_calls, n_results, json. There is one row per identifier with its
    call and its result: ``answered``, ``open`` (no result), ``orphan`` (a result of no call) or ``cycle``. Where an
    identifier comes several times the call and the result with the lowest seq, then the smallest content, stand for it and
    the counts tell how many there are; each of the others is a row of its own, ``repeated``. So is every call or result
    without an identifier: ``open`` or ``orphan``, linked to nothing; as is a call whose parent is NULL or unknown to the
    top. Empty texts are content like others; NULL content is a result without content. Equal rows stay rows. ``json`` has
    sorted keys, canonical arguments and explicit nulls. Empty tables give an empty result.
    """
    called = settled(calls.select("call_id", "seq", "name", "arguments", "parent_id").withColumn("key", F.monotonically_increasing_id()))
    called = settled(_first_of_each(called, ["seq", "name", "arguments", "parent_id"]))
    answered = settled(results.select("call_id", "seq", "content").withColumn("key", F.monotonically_increasing_id()))
    answered = settled(_first_of_each(answered, ["seq", "content"]))
    first = called.filter("first").select("call_id", "name", "arguments", "parent_id", F.col("n").alias("n_calls"))
    replies = answered.filter("first").select(F.col("call_id").alias("result_id"), "content", F.col("n").alias("n_results"))
    order = depths(first.select("call_id", "parent_id")).withColumnRenamed("call_id", "order_id")
    both = (first.join(order, F.col("call_id") == F.col("order_id"), "left")
            .join(replies, F.col("call_id") == F.col("result_id"), "full"))
    status = (F.when(F.col("call_id").isNull(), "orphan").when(F.col("depth").isNull(), "cycle")
              .when(F.col("result_id").isNull(), "open").otherwise("answered"))
    both = (both.withColumn("status", status).withColumn("is_call", F.col("call_id").isNotNull())
            .withColumn("call_id", F.coalesce("call_id", "result_id")))
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    more_calls = called.filter("NOT first").select(
        "call_id", "name", "arguments", "parent_id", one.alias("n_calls"), none.alias("n_results"), F.lit(True).alias("is_call"),
        F.when(F.col("call_id").isNull(), "open").otherwise("repeated").alias("status"))
    more_results = answered.filter("NOT first").select(
        "call_id", "content", none.alias("n_calls"), one.alias("n_results"), F.lit(False).alias("is_call"),
        F.when(F.col("call_id").isNull(), "orphan").otherwise("repeated").alias("status"))
    rows = (both.drop("order_id", "result_id").unionByName(more_calls, allowMissingColumns=True)
            .unionByName(more_results, allowMissingColumns=True))
    rows = rows.withColumn("errors", F.when(F.col("is_call"), validate(F.col("name"), F.col("arguments"), schemas)))
    record = F.struct(F.try_parse_json("arguments").alias("arguments"), "depth", "errors", F.col("call_id").alias("id"),
                      "name", F.col("parent_id").alias("parent"), F.col("content").alias("result"), "status")
    return rows.select(
        "call_id", "name", "root_id", "depth", "status", F.array_join("errors", "; ").alias("errors"),
        F.coalesce("n_calls", none).alias("n_calls"), F.coalesce("n_results", none).alias("n_results"),
        F.to_json(record, {"ignoreNullFields": "false"}).alias("json"))
