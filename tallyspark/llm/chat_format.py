"""Chat formatting: tool calls and results linked by identifier, ordered, validated and written as canonical JSON.

Calls and results meet in a hash join on their identifier, each folded to one row before it. A call may name any number
of earlier calls whose results it uses; its level in the topological order is the length of the longest chain of them.
Conversations that parents connect are a group. The calls of a group of `GROUP` calls and parents at most are gathered by
number and identifier, without their texts, and their levels are folded in that row, so jobs don't grow with the length of
a conversation. Larger groups take rounds: chains of calls with one parent are shortened by pointer doubling, in rounds
that grow with the logarithm of their length, then calls with several parents are settled level by level.
Arguments are parsed natively and checked against the schema of the tool that is called; a JSON variant has its keys in
order, so writing it gives one form. No conversation is gathered: each call and each other turn is a row, and
`write_conversations` sorts rows across the cluster so that a conversation's messages follow one another.

Every turn that is neither call nor result, whatever its role, is a row of its own with status `other`, its role as name
and its text as result.

Edge cases: equal calls, in all their fields, are one row and `copies` counts them; equal results are one. Of different
calls or results of one identifier the least is linked, each other one is a row with status `duplicate`; those without an
identifier are a row each with status `unidentified`; these have no level. A call without result is `pending`, a result
without call `orphan`, a call above which a chain never ends `cyclic` with null level; a parent that doesn't exist, or
null, is none; a tool without schema, null arguments and arguments that aren't JSON are invalid; arguments that can't be
parsed are written null; null and very long texts are written whole; extra columns stay out; empty tables give an empty
result.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bind, cut_lineage, discard, stored
from .components import connected_components

Schema = Mapping[str, Any]
#: How a variant's schema begins for each type; integers are told by how they are written.
_KINDS = {"string": "STRING", "boolean": "BOOLEAN", "object": "OBJECT", "array": "ARRAY", "null": "VOID"}
_WRITTEN = {"integer": r"^-?[0-9]+$", "number": r"^-?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?$"}
#: What schemas may say.
KEYWORDS = {"type", "enum", "properties", "required", "additionalProperties", "items", "minimum", "maximum", "minLength", "maxLength", "minItems", "maxItems"}


def fits(value: Column, schema: Schema) -> Column:
    """Whether a variant that isn't SQL null fits a schema in the words of JSON Schema, of `KEYWORDS` alone: objects and
    arrays nest as deep as the schema does. Properties that an object schema doesn't name are refused unless
    additionalProperties is true."""
    if unknown := set(schema) - KEYWORDS:
        raise ValueError(f"schema words that aren't known: {', '.join(sorted(unknown))}")
    ok, kind, written = F.lit(True), schema.get("type"), F.to_json(value)
    if kind in _WRITTEN:
        ok &= written.rlike(_WRITTEN[kind])
    elif kind is not None:
        ok &= F.schema_of_variant(value).startswith(_KINDS[kind])
    if "enum" in schema:
        ok &= written.isin([json_of(x) for x in schema["enum"]])
    number, text = F.try_variant_get(value, "$", "double"), F.try_variant_get(value, "$", "string")
    for word, test in (("minimum", lambda n: number >= n), ("maximum", lambda n: number <= n), ("minLength", lambda n: F.length(text) >= n), ("maxLength", lambda n: F.length(text) <= n)):
        if word in schema:
            ok &= test(schema[word])
    if kind == "object":
        properties = schema.get("properties", {})
        for name, inner in properties.items():
            part = F.try_variant_get(value, f'$["{name}"]', "variant")
            ok &= F.when(part.isNull(), F.lit(name not in schema.get("required", ()))).otherwise(bind(part, _fitting(inner)))
        if not schema.get("additionalProperties", False):
            named = F.array(*[F.lit(n) for n in properties]) if properties else F.array().cast("array<string>")
            ok &= F.size(F.array_except(F.json_object_keys(written), named)) == 0
    if kind == "array":
        items = F.try_variant_get(value, "$", "array<variant>")
        for word, test in (("minItems", lambda n: F.size(items) >= n), ("maxItems", lambda n: F.size(items) <= n)):
            if word in schema:
                ok &= test(schema[word])
        if "items" in schema:
            ok &= F.forall(items, lambda v: fits(v, schema["items"]))
    return F.coalesce(ok, F.lit(False))


def _fitting(schema: Schema):
    """A test of one variant; Spark tells an element's function from one of element and place by its parameters."""
    return lambda value: F.when(value.isNull(), False).otherwise(fits(value, schema))


def json_of(x: Any) -> str:
    return json.dumps(x, separators=(",", ":"), ensure_ascii=False, sort_keys=True)


def valid_arguments(name: Column, arguments: Column, schemas: Mapping[str, Schema]) -> Column:
    """Whether JSON arguments fit the schema of the tool of that name."""
    verdict = F.lit(False)
    for tool, schema in schemas.items():
        verdict = F.when(name == tool, bind(F.try_parse_json(arguments), _fitting(schema))).otherwise(verdict)
    return F.coalesce(verdict, F.lit(False))


def canonical(text: Column) -> Column:
    """JSON with keys in order and without blanks; null if it can't be parsed."""
    return F.to_json(F.try_parse_json(text))


#: Calls and parents of a group of conversations whose levels are worked out in one row.
GROUP = 4_000


def _edges(calls: DataFrame) -> DataFrame:
    """(call_id, parent): different parents that exist."""
    known = calls.select(F.col("call_id").alias("parent"))
    return cut_lineage(calls.select("call_id", F.explode("parents").alias("parent")).distinct().join(known, "parent", "left_semi").select("call_id", "parent"))


def levels(calls: DataFrame, group: int = GROUP) -> DataFrame:
    """(call_id, level) from unique (call_id, conv_id, parents array<string>): the length of the longest chain of calls
    that each comes after; null where that never ends. Conversations that parents connect are one group; a group of at
    most `group` calls and parents is folded within one row, others take rounds over all of them."""
    edges = _edges(calls)
    placed = cut_lineage(calls.select("call_id", F.when(F.col("conv_id").isNull(), F.xxhash64("call_id", F.lit(1))).otherwise(F.xxhash64("conv_id")).alias("conv")))
    above = placed.select(F.col("call_id").alias("parent"), F.col("conv").alias("conv_above"))
    # by hashes: two conversations that share one are folded together, which changes no level
    across = edges.join(placed, "call_id").join(above, "parent").filter("conv != conv_above").select("conv", "conv_above").distinct()
    united = connected_components(across, "conv", "conv_above").select(F.col("vertex").alias("conv"), "component")
    grouped = placed.join(united, "conv", "left").select("call_id", F.coalesce("component", "conv").alias("group"))
    ups = edges.groupBy("call_id").agg(F.count("*").alias("ups"))
    sizes = grouped.join(ups, "call_id", "left").groupBy("group").agg(F.sum(1 + F.coalesce("ups", F.lit(0))).alias("size"))
    sized = cut_lineage(grouped.join(sizes, "group"))
    small, large = sized.filter(F.col("size") <= group).select("call_id", "group"), sized.filter(F.col("size") > group).select("call_id")
    folded = _folded(small, edges)
    if large.isEmpty():
        return folded
    return folded.union(_by_rounds(large, edges.join(large, "call_id", "left_semi")))


def _folded(calls: DataFrame, edges: DataFrame) -> DataFrame:
    """(call_id, level) of calls (call_id, group) of small groups, each gathered as numbers and identifiers alone."""
    seat = F.row_number().over(Window.partitionBy("group").orderBy("call_id")) - 1
    seated = cut_lineage(calls.withColumn("seat", seat))
    over = edges.join(seated.select(F.col("call_id").alias("parent"), F.col("seat").alias("up")), "parent").groupBy("call_id").agg(F.collect_list("up").alias("ups"))
    one = F.struct("seat", "call_id", F.coalesce("ups", F.array().cast("array<int>")).alias("ups"))
    gathered = seated.join(over, "call_id", "left").groupBy("group").agg(F.array_sort(F.collect_list(one)).alias("all"))

    def settle(now: Column) -> Column:
        """Levels after one more round; -1 where a parent has none yet."""
        at = lambda p: F.get(now, p)
        return F.transform("all", lambda x: F.when(F.forall(x["ups"], lambda p: at(p) >= 0), F.coalesce(F.array_max(F.transform(x["ups"], at)) + 1, F.lit(0))).otherwise(-1))

    def round_(state: Column, _: Column) -> Column:
        after = bind(settle(state["now"]), lambda new: F.struct(new.alias("now"), (new == state["now"]).alias("done")))
        return F.when(state["done"], state).otherwise(after)

    start = F.struct(F.transform("all", lambda x: F.lit(-1)).alias("now"), F.lit(False).alias("done"))
    known = gathered.select("all", F.aggregate(F.sequence(F.lit(0), F.size("all")), start, round_, lambda x: x["now"]).alias("levels"))
    pairs = known.select(F.explode(F.arrays_zip("all", "levels")).alias("x"))
    return pairs.select(F.col("x.all.call_id").alias("call_id"), F.when(F.col("x.levels") >= 0, F.col("x.levels")).cast("long").alias("level"))


def _by_rounds(known: DataFrame, edges: DataFrame) -> DataFrame:
    """(call_id, level) of calls (call_id) and edges of large groups."""
    degrees = edges.groupBy("call_id").agg(F.count("*").alias("degree"), F.min("parent").alias("only"))
    # chains: of a call with one parent the call above it, and how far that is
    start = cut_lineage(known.join(degrees, "call_id", "left").select("call_id", F.when(F.col("degree") == 1, F.col("only")).alias("up"), F.coalesce("degree", F.lit(0)).alias("degree")))
    now = cut_lineage(start.select("call_id", F.coalesce("up", "call_id").alias("top"), F.col("up").isNull().alias("ended"), F.when(F.col("up").isNull(), 0).otherwise(1).cast("long").alias("far")))
    rounds = now.count().bit_length() + 1  # what hasn't ended after that goes round
    while rounds and not now.filter("not ended").isEmpty():
        above = now.select(F.col("call_id").alias("top"), F.col("top").alias("next"), F.col("ended").alias("ends"), F.col("far").alias("more"))
        now = cut_lineage(now.join(above, "top").select("call_id", F.col("next").alias("top"), F.col("ends").alias("ended"), (F.col("far") + F.col("more")).alias("far")))
        rounds -= 1
    chains = now.filter("ended").select("call_id", "top", "far")
    # calls with several parents, each named by the top of its chain; a round settles those whose parents all are
    many = start.filter("degree > 1").select("call_id", "degree")
    over = stored(edges.join(many, "call_id").join(chains.withColumnRenamed("call_id", "parent"), "parent").select("call_id", "degree", "top", (F.col("far") + 1).alias("far")))
    fresh = stored(start.filter("degree = 0").select(F.col("call_id").alias("top"), F.lit(0).cast("long").alias("level")))
    found = [fresh]
    counted = stored(many.select("call_id", "degree", F.lit(0).cast("long").alias("n"), F.lit(-1).cast("long").alias("level")))
    while not fresh.isEmpty():
        met = over.join(fresh, "top").groupBy("call_id").agg(F.count("*").alias("more"), F.max(F.col("level") + F.col("far")).alias("next"))
        after = stored(counted.join(met, "call_id", "left").select("call_id", "degree", (F.col("n") + F.coalesce("more", F.lit(0))).alias("n"), F.greatest("level", "next").alias("level")))
        fresh = stored(after.filter("n = degree").select(F.col("call_id").alias("top"), "level"))
        left = stored(after.filter("n < degree"))
        discard(counted, after)
        counted = left
        found.append(fresh)
        if len(found) > 64:  # a plan of few tables
            found = [stored(reduce(DataFrame.union, found))]
    settled = reduce(DataFrame.union, found)
    return known.join(chains.join(settled, "top").select("call_id", (F.col("far") + F.col("level")).alias("level")), "call_id", "left")


def link_calls(calls: DataFrame, results: DataFrame, schemas: Mapping[str, Schema], others: DataFrame | None = None) -> DataFrame:
    """(call_id, conv_id, level, status, valid, copies, json) from calls (conv_id, call_id, name, arguments, parents),
    results (conv_id, call_id, content) and other turns (conv_id, call_id, name, content)."""
    asked, told = ["arguments", "name", "parents", "conv_id"], ["content", "conv_id"]
    alike = cut_lineage(calls.filter("call_id is not null").groupBy("call_id", *asked).agg(F.count("*").alias("copies")))
    once = cut_lineage(alike.groupBy("call_id").agg(F.min(F.struct(*asked, "copies")).alias("c")).select("call_id", "c.*"))
    distinct = cut_lineage(results.filter("call_id is not null").select("call_id", *told).distinct())
    first = cut_lineage(distinct.groupBy("call_id").agg(F.min(F.struct(*told)).alias("r")).select("call_id", "r.*"))
    answers = first.select("call_id", "content", F.col("conv_id").alias("answer_conv"), F.lit(True).alias("answered"))
    joined = once.withColumn("called", F.lit(True)).join(answers, "call_id", "full").join(levels(once.select("call_id", "conv_id", "parents")), "call_id", "left")
    status = F.when(F.col("called").isNull(), "orphan").when(F.col("level").isNull(), "cyclic").when(F.col("answered").isNull(), "pending").otherwise("linked")
    columns = ["call_id", "conv_id", "level", "status", "name", "arguments", "content", "copies"]
    rows = joined.withColumns({"conv_id": F.coalesce("conv_id", "answer_conv"), "status": status}).select(columns)

    def apart(df: DataFrame, status: str) -> DataFrame:
        kinds = {"level": "long", "name": "string", "arguments": "string", "content": "string", "copies": "long"}
        return df.withColumns({c: F.lit(None).cast(t) for c, t in kinds.items() if c not in df.columns} | {"status": F.lit(status)}).select(columns)

    rows = rows.union(apart(alike.exceptAll(once.select(alike.columns)), "duplicate")).union(apart(distinct.exceptAll(first.select(distinct.columns)), "duplicate"))
    rows = rows.union(apart(calls.filter("call_id is null").withColumn("copies", F.lit(1).cast("long")), "unidentified")).union(apart(results.filter("call_id is null"), "unidentified"))
    if others is not None:
        rows = rows.union(apart(others, "other"))
    checked = rows.withColumns({"valid": valid_arguments(F.col("name"), F.col("arguments"), schemas), "copies": F.coalesce("copies", F.lit(0)).cast("long")})
    inner = F.struct(F.col("call_id").alias("id"), "level", "name", F.col("content").alias("result"), "status", "valid")
    written = F.concat(F.lit('{"arguments":'), F.coalesce(canonical(F.col("arguments")), F.lit("null")), F.lit(","), F.substr(F.to_json(inner, {"ignoreNullFields": "false"}), F.lit(2)))
    return checked.select("call_id", "conv_id", "level", "status", "valid", "copies", written.alias("json"))


def write_conversations(linked: DataFrame, path: str) -> None:
    """Linked rows as lines of JSON: conversation after conversation, in each what no call waits for first (system turns),
    then calls by level. Rows are sorted across the cluster, so a conversation of any length is never gathered."""
    seat = F.coalesce("level", F.lit(-1))
    linked.orderBy("conv_id", seat, "call_id", "json").select("json").write.text(path)


#: The tools of a plain conversation: a user's turn asks one, the assistant's next turn answers. A text of one line is
#: asked, one of several lines recited.
TOOLS: dict[str, Schema] = {
    "ask": {"type": "object", "properties": {"prompt": {"type": "string", "minLength": 1}, "turn": {"type": "integer", "minimum": 0}}, "required": ["prompt", "turn"]},
    "recite": {
        "type": "object",
        "properties": {
            "at": {"type": "object", "properties": {"turn": {"type": "integer"}, "size": {"type": "string", "enum": ["short", "middle"]}}, "required": ["turn", "size"]},
            "lines": {"type": "array", "items": {"type": "string"}, "minItems": 2},
        },
        "required": ["at", "lines"],
    },
}
#: Characters from which a recited text is middle, and long.
MIDDLE, LONG = 200, 600


def _address(back: int) -> Column:
    """The identifier of the turn some turns before; null without a conversation or turn."""
    return F.concat(F.col("conv_id").cast("string"), F.lit("-"), (F.col("turn") - back).cast("string"))


def conversation_calls(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of a table of turns (conv_id, turn, role, text): each user turn is a call that comes after the
    calls two and four turns before, each assistant turn the result of the call one turn before."""
    size = F.when(F.length("text") < MIDDLE, "short").when(F.length("text") < LONG, "middle").otherwise("long")
    several = F.coalesce(F.col("text").contains("\n"), F.lit(False))
    recited = F.to_json(F.struct(F.split("text", "\n", -1).alias("lines"), F.struct("turn", size.alias("size")).alias("at")))
    arguments = F.when(several, recited).otherwise(F.to_json(F.struct("turn", F.col("text").alias("prompt"))))
    name = F.when(several, "recite").otherwise("ask")
    calls = turns.filter("role = 'user'").select("conv_id", _address(0).alias("call_id"), name.alias("name"), arguments.alias("arguments"), F.array(_address(2), _address(4)).alias("parents"))
    results = turns.filter("role = 'assistant'").select("conv_id", _address(1).alias("call_id"), F.col("text").alias("content"))
    return calls, results


def other_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, call_id, name, content) of the turns that are neither calls nor results."""
    return turns.filter("role is null or role not in ('user', 'assistant')").select("conv_id", _address(0).alias("call_id"), F.col("role").alias("name"), F.col("text").alias("content"))
