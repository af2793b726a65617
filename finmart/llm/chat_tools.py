"""Tool calls in conversations: linked, ordered, validated, in canonical JSON.

Everything is DataFrame and SQL functions.  Calls and results meet in a hash
join on the identifier.  A call may cite earlier ones whose results it needs
(``after``), so the calls of a conversation form a graph; a call's place is the
longest path of citations to it.  Stretches in which every call cites one other
are skipped by pointer doubling (each round every unresolved call jumps over as
many steps as all rounds before together), with all conversations at once; calls
that cite several are then placed as soon as all they cite are, one round per such
call on a path.  A call has level 2d, its result 2d + 1, so sorting by level is a
topological order; calls that are never placed stand in a cycle or after one.
Arguments are parsed once (variant), checked against the tool's schema by a column
expression compiled from it (nested objects and arrays too; patterns are Java's; a
keyword that isn't checked, such as $ref or format, raises an error), and written
with sorted keys and no white space.

``with_tool_messages`` derives tool messages from plain conversations: the
given table has none.  An assistant turn becomes a call whose tool and
arguments (faulty ones among them) follow from its whole text, the user turn after
it is the call's result.

Defined results: one row per message; a null conv_id is a conversation of its
own; messages without identifier, results without call, citations of unknown
calls, identifiers used twice (all their calls; they count as one call that cites
what any of them does), cycles and faulty arguments
are kept and say so in ``error``; the JSON of a call also has the text beside it
(``content``), and malformed arguments as their raw string; null text is null
content, which the JSON leaves out; repeated rows are kept each; citations may be
an array or one string, repeated and null ones don't count; extra columns are
ignored, whatever their names; texts of any length are kept whole; an empty
table gives an empty table.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finmart.llm.common import checkpointed, only_columns

#: JSON schemas of the tools that ``op4`` knows.
TOOLS = {
    "search": {"type": "object", "required": ["query"], "additionalProperties": False,
               "properties": {"query": {"type": "string"},
                              "limit": {"type": "integer", "minimum": 1, "maximum": 10}}},
    "summarise": {"type": "object", "required": ["text"], "additionalProperties": False,
                  "properties": {"text": {"type": "string"},
                                 "max_words": {"type": "integer", "minimum": 1}}},
    "translate": {"type": "object", "required": ["text", "to"], "additionalProperties": False,
                  "properties": {"text": {"type": "string"},
                                 "to": {"type": "string", "enum": ["en", "de", "fr", "es"]}}},
}

_TYPES = {"string": "STRING", "integer": "BIGINT|DECIMAL\\(\\d+, ?0\\)", "boolean": "BOOLEAN",
          "number": "BIGINT|DECIMAL\\(.*\\)|DOUBLE", "object": "OBJECT<.*>", "array": "ARRAY<.*>",
          "null": "VOID"}


def with_tool_messages(conversations: DataFrame) -> DataFrame:
    """Plain turns as tool messages: adds kind, call_id, name, arguments, after."""
    rows = only_columns(conversations, "conv_id", "turn", "role", "text")
    n = F.coalesce(F.length("text"), F.lit(0))
    name = F.get(F.array(*map(F.lit, ["search", "summarise", "translate", "lookup"])), n % 4)
    has_main = n % 11 != 0
    main = F.when(has_main, F.col("text"))
    to = F.get(F.array(*map(F.lit, ["en", "de", "fr", "es", "xx"])), n % 5)
    number = F.when(n % 5 == 0, F.concat(F.lit('"'), (n % 7).cast("string"), F.lit('"'))).otherwise(
        (n % 7).cast("string"))
    given = F.when(name == "search", F.to_json(F.struct(main.alias("query"), (n % 13).alias("limit")))) \
        .when(name == "summarise", F.concat(
            F.lit('{"max_words": '), number,
            F.when(has_main, F.concat(F.lit(", "), F.expr("substring(to_json(struct(text)), 2)")))
            .otherwise(F.lit("}")))) \
        .when(name == "translate", F.to_json(F.struct(to.alias("to"), main.alias("text")))) \
        .otherwise(F.to_json(F.struct(main.alias("key"))))
    cut = F.when(n % 17 == 0, F.expr("left(_given, length(_given) - 1)")).otherwise(F.col("_given"))
    called, answer = F.col("role") == "assistant", F.col("role") == "user"
    of = lambda back: F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"),
                               (F.col("turn") - back).cast("string"))
    rows = rows.withColumn("_given", given)
    return rows.select(
        "conv_id", "turn", "role", "text",
        F.when(called, "call").when(answer, "result").otherwise("message").alias("kind"),
        F.when(called, of(0)).when(answer, of(1)).alias("call_id"),
        F.when(called, name).alias("name"), F.when(called, cut).alias("arguments"),
        F.when(called & (n % 6 == 0), F.array(of(2), of(4)))
         .when(called & (n % 3 == 0), F.array(of(2))).alias("after"))


#: Schema keywords that say nothing about a value, and those that are checked.
_NOTES = frozenset("title description default examples deprecated readOnly writeOnly $schema $id $comment".split())
_CHECKED = frozenset(
    "type enum const minimum maximum exclusiveMinimum exclusiveMaximum minLength maxLength pattern "
    "properties required additionalProperties minProperties maxProperties items minItems maxItems "
    "allOf anyOf oneOf not".split())


def _equals(value: Column, kind: Column, wanted) -> Column:
    """Whether a value is the given JSON value."""
    if isinstance(wanted, str):
        return kind.rlike("^STRING$") & (F.try_variant_get(value, "$", "string") == wanted)
    if isinstance(wanted, (int, float)) and not isinstance(wanted, bool):
        return kind.rlike(f"^({_TYPES['number']})$") & (F.try_variant_get(value, "$", "double") == float(wanted))
    text = json.dumps(wanted, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    return F.to_json(value) == text


def _any(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, [F.coalesce(t, F.lit(False)) for t in tests], F.lit(False))


def value_errors(schema: dict | bool, value: Column, label: str = "") -> Column:
    """What a schema finds wrong with a value (a variant; null: not there), as an
    array of texts.  Raises ``ValueError`` for keywords that it can't check."""
    none = F.array().cast("array<string>")
    name, there = label or "arguments", value.isNotNull()
    if isinstance(schema, bool):
        return none if schema else F.when(there, F.array(F.lit(f"{name} not allowed"))).otherwise(none)
    unknown = set(schema) - _NOTES - _CHECKED
    if unknown:
        raise ValueError(f"schema keywords not supported: {sorted(unknown)}")
    kind = F.schema_of_variant(value)
    found: list[Column] = []
    say = lambda test, text: found.append(F.array(F.when(there & test, F.lit(text))))
    inner = lambda key: f"{label}.{key}" if label else key

    types = schema.get("type", [])
    types = [types] if isinstance(types, str) else types
    if types and label:  # arguments are an object in any case
        say(~kind.rlike(f"^({'|'.join(_TYPES[t] for t in types)})$"), f"wrong type of {name}")
    for allowed in [schema[k] if k == "enum" else [schema[k]] for k in ("enum", "const") if k in schema]:
        say(~_any([_equals(value, kind, x) for x in allowed]), f"{name} not allowed")
    amount = F.when(kind.rlike(f"^({_TYPES['number']})$"), F.try_variant_get(value, "$", "double"))
    text = F.when(kind.rlike("^STRING$"), F.try_variant_get(value, "$", "string"))
    entries = F.when(kind.rlike("^OBJECT<"), F.try_variant_get(value, "$", "map<string,variant>"))
    array = F.when(kind.rlike("^ARRAY<"), F.try_variant_get(value, "$", "array<variant>"))
    for key, test, what in (
            ("minimum", lambda x: amount < x, "too small"), ("maximum", lambda x: amount > x, "too large"),
            ("exclusiveMinimum", lambda x: amount <= x, "too small"),
            ("exclusiveMaximum", lambda x: amount >= x, "too large"),
            ("minLength", lambda x: F.length(text) < x, "too short"),
            ("maxLength", lambda x: F.length(text) > x, "too long"),
            ("pattern", lambda x: ~text.rlike(x), "doesn't match its pattern"),
            ("minItems", lambda x: F.size(array) < x, "has too few items"),
            ("maxItems", lambda x: F.size(array) > x, "has too many items"),
            ("minProperties", lambda x: F.size(F.map_keys(entries)) < x, "has too few properties"),
            ("maxProperties", lambda x: F.size(F.map_keys(entries)) > x, "has too many properties")):
        if key in schema:
            on = array if "Items" in key else entries if "Properties" in key else F.lit(True)
            say(on.isNotNull() & test(schema[key]), f"{name} {what}")

    properties, required = schema.get("properties", {}), schema.get("required", [])
    for key in [*properties, *(k for k in required if k not in properties)]:
        path = "$['" + key.replace("'", "\\'") + "']"
        of_key = F.when(entries.isNotNull() if label else there, F.try_variant_get(value, path, "variant"))
        if key in required:
            say((entries.isNotNull() if label else F.lit(True)) & of_key.isNull(), f"missing {inner(key)}")
        found.append(value_errors(properties.get(key, True), of_key, inner(key)))
    more = schema.get("additionalProperties", True)
    if more is not True:
        known = F.array(*map(F.lit, properties)).cast("array<string>")
        if more is False:
            say(F.size(F.array_except(F.map_keys(entries), known)) > 0,
                f"unexpected argument in {label}" if label else "unexpected argument")
        else:
            others = F.map_values(F.map_filter(entries, lambda k, v: ~F.array_contains(known, k)))
            found.append(F.flatten(F.transform(others, lambda v: value_errors(more, v, inner("*")))))
    if "items" in schema:
        found.append(F.flatten(F.transform(array, lambda v: value_errors(schema["items"], v, f"{name}[]"))))

    fits = lambda s: F.size(value_errors(s, value, label)) == 0
    found += [value_errors(s, value, label) for s in schema.get("allOf", [])]
    if "anyOf" in schema:
        say(~_any([fits(s) for s in schema["anyOf"]]), f"{name} fits none of its schemas")
    if "oneOf" in schema:
        say(sum((fits(s).cast("int") for s in schema["oneOf"]), F.lit(0)) != 1, f"{name} doesn't fit one of its schemas")
    if "not" in schema:
        say(fits(schema["not"]), f"{name} fits an excluded schema")
    found = [F.coalesce(f, none) for f in found]
    return F.array_distinct(F.array_compact(F.concat(none, *found)))


def schema_errors(schemas: dict[str, dict], name: str, arguments: str, parsed: str) -> Column:
    """What is wrong with a call's arguments: an array of texts, empty if nothing."""
    found = [F.array(F.when(F.col(parsed).isNull(), F.lit("malformed arguments")),
                     F.when(F.col(name).isNull() | ~F.col(name).isin(list(schemas)), F.lit("unknown tool")))]
    for tool, schema in schemas.items():
        own = (F.col(name) == tool) & F.col(parsed).isNotNull()
        kind = F.schema_of_variant(F.col(parsed))
        found.append(F.array(F.when(own & ~kind.rlike("^OBJECT<"), F.lit("arguments are no object"))))
        found.append(F.when(own, value_errors(schema, F.col(parsed))).otherwise(F.array().cast("array<string>")))
    return F.array_compact(F.concat(*found))


def call_levels(calls: DataFrame) -> DataFrame:
    """The longest path of citations to every call (0, 1 ...; null in or after a
    cycle): ``calls`` holds a distinct ``node`` and the nodes it cites in ``parents``
    (distinct, not null).  Adds ``unknown``: a cited call isn't there."""
    there = calls.select(F.col("node").alias("_there"))
    cited = calls.select("node", F.explode("parents").alias("parent")).join(
        there, F.col("parent") == F.col("_there"), "left")
    cited = checkpointed(cited.select("node", F.col("_there").alias("parent")))
    known = cited.filter("parent IS NOT NULL")
    degrees = cited.groupBy("node").agg(F.count("parent").alias("cites"),
                                        F.max(F.col("parent").isNull()).alias("unknown"),
                                        F.min("parent").alias("only"))
    nodes = calls.select("node").join(degrees, "node", "left").select(
        "node", F.coalesce("cites", F.lit(0)).alias("cites"), F.coalesce("unknown", F.lit(False)).alias("unknown"),
        F.when(F.col("cites") == 1, F.col("only")).alias("only"))

    # how far from a call that cites none or several: by jumps, all at once
    state = checkpointed(nodes.select(
        "node", "cites", "unknown", F.col("only").alias("_at"), F.coalesce("only", "node").alias("_end"),
        F.when(F.col("only").isNull(), 0).otherwise(1).cast("bigint").alias("_steps")))
    left = state.filter("_at IS NOT NULL").count()
    while left:
        jump = state.select(F.col("node").alias("_n"), F.col("_at").alias("_further"),
                            F.col("_end").alias("_last"), F.col("_steps").alias("_more"))
        state = checkpointed(state.filter("_at IS NULL").union(
            state.filter("_at IS NOT NULL").join(jump, F.col("_at") == F.col("_n")).select(
                "node", "cites", "unknown", "_further", "_last", F.col("_steps") + F.col("_more"))))
        before, left = left, state.filter("_at IS NOT NULL").count()
        if left == before:  # a round resolves some of every stretch that has a beginning
            break

    # calls that cite several: placed once all they cite are
    ends = state.filter("_at IS NULL").select("node", "_end", "_steps")
    joins = state.filter("cites > 1").select("node", F.col("cites").alias("_cites"))
    waits = checkpointed(
        known.join(joins, "node").join(ends.withColumnRenamed("node", "parent"), "parent")
        .select("node", "_cites", "_end", "_steps"))
    placed = checkpointed(state.filter("cites = 0").select(
        F.col("node").alias("_end"), F.lit(0).cast("bigint").alias("_depth")))
    number = placed.count()
    while True:
        ready = (waits.join(placed, "_end").groupBy("node", "_cites")
                 .agg(F.count(F.lit(1)).alias("_n"), F.max(F.col("_depth") + F.col("_steps") + 1).alias("_depth"))
                 .filter("_n = _cites").select(F.col("node").alias("_end"), "_depth"))
        placed = checkpointed(ready.union(state.filter("cites = 0").select(
            F.col("node").alias("_end"), F.lit(0).cast("bigint").alias("_depth"))))
        before, number = number, placed.count()
        if number == before:
            break
    depth = F.when(F.col("_at").isNull(), F.col("_depth") + F.col("_steps"))
    return state.join(placed, "_end", "left").select("node", depth.alias("depth"), "unknown")


def link_tool_calls(messages: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per message: its level, whether it is linked, its errors and its
    canonical JSON; sorted by conversation, level and turn."""
    messages = only_columns(messages, "conv_id", "turn", "role", "text", "kind", "call_id", "name",
                            "arguments", "after")
    if messages.schema["after"].dataType.simpleString() == "string":
        messages = messages.withColumn("after", F.when(F.col("after").isNotNull(), F.array("after")))
    conv = F.col("conv_id").cast("string")
    conv = F.when(conv.isNull(), F.lit("-")).otherwise(F.concat_ws(":", F.length(conv).cast("string"), conv))
    node = lambda c: F.concat(conv, F.lit("/"), c)
    rows = messages.withColumn("node", F.when(F.col("kind") != "message", node(F.col("call_id"))))
    cites = F.transform(F.coalesce("after", F.array().cast("array<string>")), node)
    calls = checkpointed(
        rows.filter("kind = 'call' AND node IS NOT NULL").groupBy("node").agg(
            F.count(F.lit(1)).alias("copies"),
            F.array_compact(F.array_distinct(F.flatten(F.collect_set(cites)))).alias("parents")))
    answers = rows.filter("kind = 'result' AND node IS NOT NULL").groupBy("node").agg(
        F.count(F.lit(1)).alias("results"))
    info = checkpointed(calls.join(call_levels(calls.select("node", "parents")), "node")
                        .join(answers, "node", "left").drop("parents"))
    known = rows.filter("node IS NOT NULL").join(info, "node", "left")
    rest = rows.filter("node IS NULL")
    for c in ("copies", "depth", "unknown", "results"):
        rest = rest.withColumn(c, F.lit(None).cast(info.schema[c].dataType))
    rows = known.unionByName(rest).withColumn("_v", F.try_parse_json("arguments"))

    is_call, is_result = F.col("kind") == "call", F.col("kind") == "result"
    linked = (is_call & F.col("results").isNotNull()) | (is_result & F.col("copies").isNotNull())
    links = F.array_compact(F.array(
        F.when((is_call | is_result) & F.col("call_id").isNull(), F.lit("no identifier")),
        F.when(is_result & F.col("call_id").isNotNull() & F.col("copies").isNull(), F.lit("no such call")),
        F.when(is_call & (F.col("copies") > 1), F.lit("identifier used twice")),
        F.when(is_call & F.col("unknown"), F.lit("unknown citation")),
        F.when(is_call & F.col("copies").isNotNull() & F.col("depth").isNull(), F.lit("cycle"))))
    wrong = F.when(is_call, schema_errors(schemas, "name", "arguments", "_v")).otherwise(
        F.array().cast("array<string>"))
    given = F.coalesce("_v", F.col("arguments").cast("variant"))
    canonical = F.when(is_call, F.to_json(F.struct(
        "after", given.alias("arguments"), F.col("text").alias("content"), F.col("call_id").alias("id"), "name",
        F.lit("call").alias("type")))).when(is_result, F.to_json(F.struct(
            F.col("text").alias("content"), F.col("call_id").alias("id"), F.lit("result").alias("type")))
    ).otherwise(F.to_json(F.struct(F.col("text").alias("content"), "role", F.lit("message").alias("type"))))
    rows = rows.select(
        "conv_id", "turn", "kind", "call_id", "name",
        (F.col("depth") * 2 + F.when(is_result, 1).otherwise(0)).cast("int").alias("level"),
        F.coalesce(linked, F.lit(False)).alias("linked"),
        F.array_join(F.concat(links, wrong), "; ").alias("error"), canonical.alias("canonical"))
    return rows.orderBy("conv_id", F.col("level").asc_nulls_last(), "turn", "canonical")


#: A broken call's arguments as they came: without the closing brace.
_RAW = """CASE m.name
  WHEN 'search' THEN '{' || CASE WHEN bare THEN '' ELSE '"query":' || to_json(text) || ',' END || '"limit":' || (n % 13)
  WHEN 'summarise' THEN '{"max_words": ' || CASE WHEN n % 5 = 0 THEN '"' || (n % 7) || '"' ELSE CAST(n % 7 AS VARCHAR) END
                        || CASE WHEN bare THEN '' ELSE ', "text":' || to_json(text) END
  WHEN 'translate' THEN '{"to":"' || lang || '"' || CASE WHEN bare THEN '' ELSE ',"text":' || to_json(text) END
  ELSE '{' || CASE WHEN bare THEN '' ELSE '"key":' || to_json(text) END END"""

#: The same rows in DuckDB SQL (levels by recursion along all paths).
ORACLE = """
WITH RECURSIVE r AS (
  SELECT conv_id, turn, role, text, coalesce(length(text), 0) AS n,
         CASE role WHEN 'assistant' THEN 'call' WHEN 'user' THEN 'result' ELSE 'message' END AS kind
  FROM conversations),
m AS (
  SELECT *, CASE WHEN kind = 'call' THEN 'c' || conv_id || '-' || turn
                 WHEN kind = 'result' THEN 'c' || conv_id || '-' || (turn - 1) END AS call_id,
         CASE WHEN kind = 'call' THEN ['search', 'summarise', 'translate', 'lookup'][n % 4 + 1] END AS name,
         CASE WHEN kind = 'call' AND n % 6 = 0 THEN ['c' || conv_id || '-' || (turn - 2), 'c' || conv_id || '-' || (turn - 4)]
              WHEN kind = 'call' AND n % 3 = 0 THEN ['c' || conv_id || '-' || (turn - 2)] END AS after,
         ['en', 'de', 'fr', 'es', 'xx'][n % 5 + 1] AS lang, n % 11 = 0 AS bare, n % 17 = 0 AS broken
  FROM r),
cited AS (SELECT call_id, unnest(after) AS parent FROM m WHERE kind = 'call'),
calls AS (SELECT DISTINCT call_id FROM m WHERE kind = 'call'),
path AS (
  SELECT call_id, 0 AS depth FROM calls
  WHERE call_id NOT IN (SELECT c.call_id FROM cited c JOIN calls p ON c.parent = p.call_id)
  UNION
  SELECT c.call_id, p.depth + 1 FROM cited c JOIN path p ON c.parent = p.call_id),
chain AS (SELECT call_id, max(depth) AS depth FROM path GROUP BY call_id),
lost AS (SELECT DISTINCT call_id FROM cited WHERE parent NOT IN (SELECT call_id FROM calls)),
answered AS (SELECT DISTINCT call_id FROM m WHERE kind = 'result')
SELECT m.conv_id, m.turn, m.kind, m.call_id, m.name,
       CAST(c.depth * 2 + CASE WHEN kind = 'result' THEN 1 ELSE 0 END AS INTEGER) AS level,
       CASE kind WHEN 'call' THEN a.call_id IS NOT NULL WHEN 'result' THEN c.call_id IS NOT NULL
                 ELSE false END AS linked,
       concat_ws('; ',
         CASE WHEN kind = 'result' AND c.call_id IS NULL THEN 'no such call' END,
         CASE WHEN kind = 'call' AND l.call_id IS NOT NULL THEN 'unknown citation' END,
         CASE WHEN kind = 'call' AND broken THEN 'malformed arguments' END,
         CASE WHEN m.name = 'lookup' THEN 'unknown tool' END,
         CASE WHEN m.name = 'search' AND bare AND NOT broken THEN 'missing query' END,
         CASE WHEN m.name = 'search' AND n % 13 < 1 AND NOT broken THEN 'limit too small' END,
         CASE WHEN m.name = 'search' AND n % 13 > 10 AND NOT broken THEN 'limit too large' END,
         CASE WHEN m.name IN ('summarise', 'translate') AND bare AND NOT broken THEN 'missing text' END,
         CASE WHEN m.name = 'summarise' AND n % 5 = 0 AND NOT broken THEN 'wrong type of max_words' END,
         CASE WHEN m.name = 'summarise' AND n % 5 <> 0 AND n % 7 < 1 AND NOT broken THEN 'max_words too small' END,
         CASE WHEN m.name = 'translate' AND lang = 'xx' AND NOT broken THEN 'to not allowed' END) AS error,
       CASE kind
         WHEN 'result' THEN '{"content":' || to_json(text) || ',"id":' || to_json(m.call_id) || ',"type":"result"}'
         WHEN 'message' THEN '{"content":' || to_json(text) || ',"role":' || to_json(role) || ',"type":"message"}'
         ELSE '{' || CASE WHEN m.after IS NULL THEN '' ELSE '"after":' || to_json(m.after) || ',' END
              || CASE WHEN broken THEN '"arguments":' || to_json(""" + _RAW + """) || ','
                 ELSE '"arguments":{' || CASE m.name
                   WHEN 'search' THEN '"limit":' || (n % 13) || CASE WHEN bare THEN '' ELSE ',"query":' || to_json(text) END
                   WHEN 'summarise' THEN '"max_words":' || CASE WHEN n % 5 = 0 THEN '"' || (n % 7) || '"'
                                                               ELSE CAST(n % 7 AS VARCHAR) END
                                         || CASE WHEN bare THEN '' ELSE ',"text":' || to_json(text) END
                   WHEN 'translate' THEN CASE WHEN bare THEN '' ELSE '"text":' || to_json(text) || ',' END
                                         || '"to":"' || lang || '"'
                   ELSE CASE WHEN bare THEN '' ELSE '"key":' || to_json(text) END END || '},' END
              || CASE WHEN text IS NULL THEN '' ELSE '"content":' || to_json(text) || ',' END
              || '"id":' || to_json(m.call_id) || ',"name":"' || m.name || '","type":"call"}'
       END AS canonical
FROM m LEFT JOIN chain c ON m.call_id = c.call_id
LEFT JOIN answered a ON m.call_id = a.call_id
LEFT JOIN lost l ON m.call_id = l.call_id"""
