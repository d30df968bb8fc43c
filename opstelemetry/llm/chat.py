"""Chat formatting: link tool calls and results, order them, validate arguments, write canonical JSON.

Input is one row per event: conv_id, turn, kind, call_id, after_id (the call whose result a call waits
for, or null), name, arguments (JSON of a call) and content (text of a result). Kinds other than "call" and
"result", null among them, are messages: they link to nothing, have level 0 and no errors.

* Linking is a hash join of results with calls on conversation and identifier. If calls share an
  identifier the earliest is linked and the others have the error "duplicate id"; every result of an
  identifier is linked to that call. Results without a call, and calls that wait for an unknown one, are
  roots with the error "unlinked".
* A result comes after its call, and a call after the first result of the call that it waits for (after
  that call, if it has none). So each event waits for one other at most, and its level is the length
  of its chain, found by doubling the reach of every event's pointer: rounds grow with the logarithm of the
  longest chain. Events on a cycle, or behind one, never reach a root: their level is null, their error
  "cycle", and they come last.
* ``position`` counts a conversation's events by level, turn, kind and identifier, from 0. It comes from
  range-sorted running sums, so a conversation may hold any share of all rows.
* Arguments are checked against the tool's schema: unknown tool, no JSON object, missing or unknown
  parameter, or wrong type. The JSON line has sorted keys, no white space and one form of a number: with
  a fraction or an exponent it is a double, without them where it is whole and below 10^18; digits
  alone stay as they are. Types are those of the written form, so 3.0 and 3e0 are the integer 3.

Null conversations, identifiers and texts are kept: a null identifier links to nothing. Events repeated in
full are events of their own, but one that others wait for counts once. Ties beyond the order of ``position``
have equal lines. Arguments beyond Spark's size of a variant (128 MB) are no JSON object. Further columns
of the input are left out, whatever their names; no events give no rows. Column expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opstelemetry.functions.scale import lookup_join, settle
from opstelemetry.llm.ordering import running

#: Types of JSON values by the names that Spark gives them.
_KINDS = (("integer", "^(BIGINT|DECIMAL.[0-9]+,0.)$"), ("number", "^(BIGINT|DOUBLE|DECIMAL.*)$"), ("string", "^STRING$"), ("boolean", "^BOOLEAN$"), ("array", "^ARRAY.*$"), ("object", "^OBJECT.*$"))

#: A string, a number, or what stands between them in JSON text.
_PIECE = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"|-?[0-9][0-9.eE+-]*+|[^"0-9-]++'
_WHOLE_BELOW = 1e18


def linked(events: DataFrame) -> DataFrame:
    """Add ``node`` (name of the event), ``parent`` (name of the event waited for) and ``link_error``."""
    call, result = (F.col("kind").eqNullSafe(kind) for kind in ("call", "result"))
    first = (
        events.where(call & F.col("call_id").isNotNull())
        .groupBy(F.col("conv_id").alias("c"), F.col("call_id").alias("i"))
        .agg(F.min("turn").alias("at"))
    )
    answer = (
        events.where(result & F.col("call_id").isNotNull())
        .groupBy(F.col("conv_id").alias("rc"), F.col("call_id").alias("ri"))
        .agg(F.min("turn").alias("answered"))
    )
    known = first.join(answer, F.col("c").eqNullSafe(F.col("rc")) & (F.col("i") == F.col("ri")), "left").select("c", "i", "at", "answered")
    own = F.when(call, F.concat(F.lit("c:"), "call_id")).when(result, F.concat_ws(":", F.lit("r"), F.col("turn"), F.col("call_id")))
    target = F.when(call, F.col("after_id")).when(result, F.col("call_id"))
    rows = events.withColumns({"node": own, "__target": target})
    seen = rows.join(known, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("__target") == F.col("i")), "left")
    waits = F.when(call & F.col("answered").isNotNull(), F.concat_ws(":", F.lit("r"), F.col("answered"), F.col("i")))
    parent = F.when(F.col("at").isNotNull(), F.coalesce(waits, F.concat(F.lit("c:"), "i")))
    lost = F.col("at").isNull() & F.when(call, F.col("after_id").isNotNull()).otherwise(result)
    rows = seen.select(*events.columns, "node", parent.alias("parent"), F.when(lost, "unlinked").alias("__lost"))
    again = first.withColumnsRenamed({"c": "c2", "i": "i2", "at": "at2"})
    same = F.col("conv_id").eqNullSafe(F.col("c2")) & (F.col("call_id") == F.col("i2")) & call
    twice = F.when(F.col("at2") < F.col("turn"), "duplicate id")
    return rows.join(again, same, "left").select(*events.columns, "node", "parent", F.coalesce(twice, "__lost").alias("link_error"))


def levels(nodes: DataFrame) -> DataFrame:
    """(conv_id, node, level) of distinct nodes by pointer doubling; the level is null on and behind cycles.

    A round joins only the nodes that have not reached a root yet.
    """
    now = settle(
        nodes.where(F.col("node").isNotNull())
        .groupBy("conv_id", "node")
        .agg(F.min("parent").alias("up"))
        .withColumn("level", F.when(F.col("up").isNull(), 0).otherwise(1).cast("bigint"))
    )
    rounds = max(1, now.count()).bit_length() + 1
    known, waiting = now.where("up is null"), now.where("up is not null")
    for _ in range(rounds):
        if waiting.isEmpty():
            break
        reach = known.unionByName(waiting)
        above = reach.select(F.col("conv_id").alias("c"), F.col("node").alias("n"), F.col("up").alias("up2"), F.col("level").alias("l2"))
        met = waiting.join(above, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("up") == F.col("n")), "left")
        now = settle(met.select("conv_id", "node", F.col("up2").alias("up"), (F.col("level") + F.coalesce("l2", F.lit(0))).alias("level")))
        known, waiting = known.unionByName(now.where("up is null")), now.where("up is not null")
    return known.unionByName(waiting.withColumn("level", F.lit(None).cast("bigint"))).select("conv_id", "node", "level")


def _mistakes(given: Column, parameters: Column) -> Column:
    """What is wrong with a map of variants, for parameters of (name, type, required)."""
    def wrong(p: Column) -> Column:
        value = F.schema_of_variant(F.element_at(given, p["name"]))
        fits = F.lit(False)
        for kind, pattern in _KINDS:
            fits = fits | ((p["type"] == kind) & value.rlike(pattern))
        return (
            F.when(~F.map_contains_key(given, p["name"]), F.when(p["required"], F.concat(F.lit("missing "), p["name"])))
            .when(~F.coalesce(fits, F.lit(False)), F.concat(F.lit("type of "), p["name"]))
        )

    names = F.transform(parameters, lambda p: p["name"])
    unknown = F.transform(F.array_except(F.map_keys(given), names), lambda n: F.concat(F.lit("unknown "), n))
    found = F.filter(F.transform(parameters, wrong), lambda x: x.isNotNull())
    return F.array_sort(F.concat(found, unknown))


def _one_number_form(json: Column) -> Column:
    """JSON text in which equal numbers look alike, other than whole ones from 10^18 on."""

    def piece(p: Column) -> Column:
        value = p.try_cast("double")
        whole = (F.abs(value) < _WHOLE_BELOW) & (value == F.rint(value))
        form = F.when(whole, value.cast("bigint").cast("string")).otherwise(value.cast("string"))
        return F.when(p.rlike("^-?[0-9].*[.eE]"), form).otherwise(p)

    pieces = F.transform(F.regexp_extract_all(json, F.lit(_PIECE), F.lit(0)), piece)
    return F.when(json.rlike("[0-9][.eE]"), F.array_join(pieces, "")).otherwise(json)


def validated(events: DataFrame, tools: DataFrame) -> DataFrame:
    """Add ``arguments_json`` (canonical) and ``errors`` for calls, against tools (name, parameters)."""
    schema = tools.select(F.col("name").alias("__tool"), F.col("parameters"), F.lit(True).alias("__has"))
    rows = lookup_join(events, schema, {"name": "__tool"})
    value = F.try_parse_json("arguments")
    is_object = F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))
    rows = rows.withColumn("arguments_json", F.when(is_object, _one_number_form(F.to_json(value))))
    rows = rows.withColumn("__given", F.from_json("arguments_json", "map<string,variant>"))
    errors = (
        F.when(~F.col("kind").eqNullSafe("call"), F.array().cast("array<string>"))
        .when(F.col("__has").isNull(), F.array(F.lit("unknown tool")))
        .when(F.col("__given").isNull(), F.array(F.lit("no JSON object")))
        .otherwise(_mistakes(F.col("__given"), F.col("parameters")))
    )
    return rows.withColumn("errors", errors).drop("__given", "parameters", "__has")


def _json(column: str) -> Column:
    """The JSON text of a string; null for null."""
    whole = F.to_json(F.array(column))
    return F.when(F.col(column).isNotNull(), F.substr(whole, F.lit(2), F.char_length(whole) - 2))


def formatted(events: DataFrame, tools: DataFrame) -> DataFrame:
    """One row per event: conv_id, position, level, kind, call_id, link_error, errors, valid, line."""
    wanted = ("conv_id", "turn", "kind", "call_id", "after_id", "name", "arguments", "content")
    rows = settle(linked(events.select(*wanted)))
    deep = levels(rows).withColumnsRenamed({"conv_id": "c", "node": "n"})
    rows = rows.join(deep, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("node") == F.col("n")), "left").drop("c")
    looped = F.col("n").isNotNull() & F.col("level").isNull()
    rows = rows.withColumns(
        {
            "link_error": F.when(looped, "cycle").otherwise(F.col("link_error")),
            "level": F.when(looped, F.lit(None)).otherwise(F.coalesce("level", F.lit(0))),
        }
    ).drop("n")
    rows = validated(rows, tools)
    order = [F.col("level").asc_nulls_last(), "turn", "kind", "call_id", "arguments_json", "content"]
    placed, _ = running(rows, "conv_id", order, F.lit(1), "position")
    parts = {"arguments": F.col("arguments_json")} | {k: _json(k) for k in ("content", "call_id", "name", "kind")}
    fields = [
        F.when(parts[k].isNotNull(), F.concat(F.lit(f'"{label}":'), parts[k]))
        for label, k in (("arguments", "arguments"), ("content", "content"), ("id", "call_id"), ("name", "name"), ("type", "kind"))
    ]
    line = F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}"))
    valid = (F.size("errors") == 0) & F.col("link_error").isNull()
    return placed.select("conv_id", "position", "level", "turn", "kind", "call_id", "link_error", F.array_join("errors", "; ").alias("errors"), valid.alias("valid"), line.alias("line"))


# -- events of a table of plain turns ------------------------------------------------------

#: Tools of the derived calls: name and (parameter, type, required).
TOOLS = (
    ("search", (("query", "string", True), ("limit", "integer", False), ("strict", "boolean", False))),
    ("translate", (("text", "string", True), ("score", "number", False))),
    ("summarize", (("text", "string", True), ("words", "array", False))),
)


def tool_table(spark) -> DataFrame:
    return spark.createDataFrame(TOOLS, "name string, parameters array<struct<name:string,type:string,required:boolean>>")


def events_of(conversations: DataFrame) -> DataFrame:
    """Every user turn as a call, every assistant turn as the result of the turn before, and others as messages.

    A message's name is its role, which may be null.

    The tool and the quality of the arguments follow from the text's length: some lack a parameter,
    some have one of another type, some are cut off.
    """
    n = F.coalesce(F.char_length("text"), F.lit(0))
    before = F.concat_ws(":", "conv_id", (F.col("turn") - 1).cast("string"))
    call, result = (F.col("role").eqNullSafe(role) for role in ("user", "assistant"))
    tool = F.element_at(F.array(*[F.lit(name) for name, _ in TOOLS]), n % len(TOOLS) + 1)
    query = F.to_json(F.struct(F.when(n % 11 > 0, n).alias("limit"), F.when(n % 7 > 0, F.col("text")).alias("query"), (n % 2 == 0).alias("strict")))
    other = F.to_json(F.struct(F.when(n % 5 > 0, F.col("text")).otherwise(F.lit(None)).alias("text"), (n / 8).alias("score")))
    words = F.to_json(F.struct(F.col("text"), F.when(n % 4 > 0, F.slice(F.split("text", " "), 1, 3)).alias("words")))
    arguments = F.when(tool == "search", query).when(tool == "translate", other).otherwise(words)
    arguments = F.when(n % 13 == 0, F.concat(F.lit(" "), arguments, F.lit("}"))).otherwise(arguments)
    return conversations.select(
        "conv_id",
        "turn",
        F.when(call, "call").when(result, "result").otherwise("message").alias("kind"),
        F.when(call, F.concat_ws(":", "conv_id", F.col("turn").cast("string"))).when(result, before).alias("call_id"),
        F.when(call & (F.col("turn") > 1), F.concat_ws(":", "conv_id", (F.col("turn") - 2).cast("string"))).alias("after_id"),
        F.when(call, tool).when(~result, F.col("role")).alias("name"),
        F.when(call, arguments).alias("arguments"),
        F.when(~call, F.col("text")).alias("content"),
    )
