"""Chat formatting with tool-call linking, in DataFrame expressions only.

Messages carry tool calls as JSON: an assistant message may be an object with
``tool_calls`` (a list of ``id, name, arguments, after``; ``after`` lists calls
whose results it needs), a tool message an object with ``tool_call_id`` and
``content``.  Every call and every other message becomes one line, and so do the
words (``content``) beside calls, as a message before the first of them (``sub`` -1):

1. Results are joined to calls on conversation and identifier.  Of several calls
   of one identifier the earliest is linked, the others are duplicates.
2. Lines are put in topological order: a result after its call, a call after the
   results it needs.  Lines start in the order of turns; only along links that
   run backward is a line lifted behind what it waits for, until none runs
   backward.  Lines that still move after as many rounds as a conversation has
   linked lines wait for each other: they are marked cyclic.
3. Arguments are validated against schemas.
4. Each line is serialised as canonical JSON: keys in code point order, no white
   space.

No conversation is ever gathered: its lines in order are
``orderBy(conv_id, place, order, lift)``.

Defined results: null or malformed texts are plain messages (a null content); a
null conversation is one conversation; repeated rows give repeated lines, their
calls being duplicates of the first; an identifier without a call or a result
is reported as such; an empty table gives no lines.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, quoted

_JSON = ("struct<tool_calls:array<struct<id:string,name:string,arguments:string,after:array<string>>>,"
         "tool_call_id:string,content:string>")


@dataclass(frozen=True)
class Param:
    """A parameter of a tool: its JSON type (string, integer, number, boolean, array, object) and whether it must be there."""
    kind: str
    required: bool = True


_VARIANT_TYPES = {"string": "STRING", "integer": "BIGINT", "number": "BIGINT|DOUBLE|FLOAT|DECIMAL.*", "boolean": "BOOLEAN",
                  "array": "ARRAY.*", "object": "OBJECT.*"}


def validity(name: Column, arguments: Column, schemas: dict[str, dict[str, Param]]) -> Column:
    """``valid``, or the first fault: not an object, unknown tool, missing, extra or ill-typed parameter."""
    value = F.try_parse_json(arguments)
    keys = F.json_object_keys(arguments)
    out = F.when(~F.coalesce(F.schema_of_variant(value), F.lit("")).startswith("OBJECT"), "not_an_object")
    known = F.lit(False)
    for tool, params in sorted(schemas.items()):
        mine = F.coalesce(name == tool, F.lit(False))
        known = known | mine
        out = out.when(mine & (F.size(F.array_except(keys, F.array(*map(F.lit, sorted(params))).cast("array<string>"))) > 0), "extra")
        for p, spec in sorted(params.items()):
            kind = F.schema_of_variant(F.try_variant_get(value, f"$['{p}']", "variant"))
            there = F.array_contains(keys, p)
            if spec.required:
                out = out.when(mine & ~there, f"missing:{p}")
            out = out.when(mine & there & ~F.coalesce(kind.rlike(f"^({_VARIANT_TYPES[spec.kind]})$"), F.lit(False)), f"type:{p}")
    return out.when(~known, "unknown_tool").otherwise("valid")


def _lines(messages: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv, turn, sub, role, kind, call_id, name, arguments, after, content`` for every call, result, plain message and words beside calls."""
    m = messages.select(quoted(conv).alias("conv"), quoted(turn).cast("long").alias("turn"), quoted(role).alias("role"),
                        quoted(text).alias("text"))
    m = m.withColumn("json", F.when(F.col("role").isin("assistant", "tool") & F.ltrim("text", F.lit(" \t\r\n")).startswith("{"),
                                    F.from_json("text", _JSON)))
    calls = F.coalesce(F.size("json.tool_calls"), F.lit(0)) > 0
    is_call = (F.col("role") == "assistant") & calls
    is_result = (F.col("role") == "tool") & F.col("json.tool_call_id").isNotNull()
    m = m.withColumn("kind", F.when(is_call, "call").when(is_result, "result").otherwise("message"))
    beside = is_call & (F.coalesce(F.col("json.content"), F.lit("")) != "")
    # One row for a message without calls: an outer explode of null.  Words beside calls go before them, as a null call.
    parts = F.when(beside, F.concat(F.array(F.get("json.tool_calls", F.lit(-1))), "json.tool_calls")).when(is_call, F.col("json.tool_calls"))
    m = m.select("*", beside.alias("beside"), F.posexplode_outer(parts).alias("sub", "call"))
    m = m.withColumn("sub", F.col("sub") - F.col("beside").cast("int"))
    m = m.withColumn("kind", F.when(F.col("sub") < 0, "message").otherwise(F.col("kind")))
    result = F.col("kind") == "result"
    return m.select(
        "conv", "turn", F.coalesce("sub", F.lit(0)).alias("sub"), "role", "kind",
        F.when(result, F.col("json.tool_call_id")).otherwise(F.col("call.id")).alias("call_id"),
        F.col("call.name").alias("name"), F.col("call.arguments").alias("arguments"),
        F.coalesce("call.after", F.array().cast("array<string>")).alias("after"),
        F.when(result, F.col("json.content")).when(F.col("sub") < 0, F.col("json.content"))
        .when(F.col("kind") == "message", F.col("text")).alias("content"))


def _place(prefix: str = "") -> Column:
    return F.struct(*[F.col(prefix + c) for c in ("place", "sub", "lift")])


def _ordered(lines: DataFrame) -> DataFrame:
    """``lines`` (with ``line``, ``call_line`` and ``after_lines``) and ``place, order, lift, cyclic``."""
    start = lines.withColumn("place", F.col("turn")).withColumn("lift", F.lit(0))
    links = lines.select(F.col("line").alias("child"), F.explode(F.array_distinct(F.concat(
        F.when(F.col("kind") == "result", F.array("call_line")).otherwise(F.array().cast("array<long>")), "after_lines"))).alias("parent"))
    links = links.where(F.col("parent").isNotNull() & (F.col("parent") != F.col("child")))
    state = start.select("line", "place", "sub", "lift")
    rounds, most = 0, 0
    while True:
        parents = state.select(F.col("line").alias("parent"), *[F.col(c).alias("p_" + c) for c in ("place", "sub", "lift")])
        waits = links.join(parents, "parent").join(state, F.col("child") == F.col("line"))
        late = waits.where(_place("p_") >= _place()).groupBy("line").agg(F.max(_place("p_")).alias("p"))
        late = late.select("line", "p.p_place", "p.p_sub", (F.col("p.p_lift") + 1).alias("p_lift"))
        if not late.limit(1).count():
            break
        if not rounds:
            links = materialise(links, "links")
            owner = lines.select(F.col("line").alias("child"), "conv")
            most = links.join(owner, "child").groupBy("conv").count().agg(F.max("count")).first()[0]
        rounds += 1
        # Without a cycle no line is lifted over more links than its conversation has; in one, all are by then.
        if rounds > 3 * most + 1:
            break
        state = materialise(state.join(late, "line", "left").select(
            "line", *[F.coalesce("p_" + c, c).alias(c) for c in ("place", "sub", "lift")]), "places")
    placed = state.withColumnRenamed("sub", "order")
    return lines.join(placed, "line").withColumn("cyclic", (F.col("lift") > most) & F.lit(rounds > 0))


def format_chats(messages: DataFrame, schemas: dict[str, dict[str, Param]], conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, turn, sub, place, order, lift, kind, call_id, linked_turn, status, json`` for every line."""
    lines = _lines(messages, conv_col, turn_col, role_col, text_col)
    lines = materialise(lines.withColumn("line", F.monotonically_increasing_id()), "chat-lines")
    def earliest(kind: str, as_: str) -> DataFrame:
        some = lines.where((F.col("kind") == kind) & F.col("call_id").isNotNull())
        return some.groupBy(F.col("conv").alias(as_ + "_conv"), F.col("call_id").alias(as_ + "_id")).agg(
            F.min(F.struct("turn", "sub", "line")).alias(as_))

    # One row for each identifier, so a hot one joins its many lines to a single row.
    pair = (earliest("call", "c").join(earliest("result", "r"), F.col("c_conv").eqNullSafe(F.col("r_conv"))
                                       & (F.col("c_id") == F.col("r_id")), "full")
            .select(F.coalesce("c_conv", "r_conv").alias("p_conv"), F.coalesce("c_id", "r_id").alias("p_id"), "c", "r"))
    here = F.col("conv").eqNullSafe(F.col("p_conv"))
    linked = lines.join(pair, here & (F.col("call_id") == F.col("p_id")), "left").drop("p_conv", "p_id")

    needs = lines.where(F.size("after") > 0).select("line", "conv", F.explode("after").alias("need"))
    ready = pair.select("p_conv", "p_id", F.coalesce("r.line", "c.line").alias("at"))
    after = (needs.join(ready, here & (F.col("need") == F.col("p_id")))
             .groupBy("line").agg(F.collect_set("at").alias("after_lines")))
    linked = linked.join(after, "line", "left").withColumn("after_lines", F.coalesce("after_lines", F.array().cast("array<long>")))
    ordered = _ordered(linked.withColumn("call_line", F.col("c.line")))

    is_call, is_result = F.col("kind") == "call", F.col("kind") == "result"
    status = (F.when(F.col("cyclic"), "cyclic")
              .when((is_call | is_result) & F.col("call_id").isNull(), "no_identifier")
              .when(is_call & (F.col("c.line") != F.col("line")), "duplicate")
              .when(is_call & F.col("r").isNull(), "unanswered")
              .when(is_result & F.col("c").isNull(), "orphan")
              .when(is_call, validity(F.col("name"), F.col("arguments"), schemas))
              .otherwise("ok"))
    value = F.coalesce(F.try_parse_json("arguments"), F.try_parse_json(F.to_json(F.struct(F.col("arguments").alias("text")))))
    js = (F.when(is_call, F.to_json(F.struct(value.alias("arguments"), F.col("call_id").alias("id"), "kind", "name", "role")))
          .when(is_result, F.to_json(F.struct("content", F.col("call_id").alias("id"), "kind", "role")))
          .otherwise(F.to_json(F.struct("content", "kind", "role"))))
    return ordered.select(
        F.col("conv").alias(conv_col), "turn", "sub", "place", "order", "lift", "kind", "call_id",
        F.when(is_call, F.col("r.turn")).when(is_result, F.col("c.turn")).alias("linked_turn"), status.alias("status"), js.alias("json"))


def exchanges_as_calls(conversations: DataFrame) -> DataFrame:
    """Turns as tool traffic: what a user says calls the tool ``reply``, what the assistant answers is its result.

    Identifiers are ``conversation:turn`` of the user's turn, and an answer
    belongs to the turn before it; a call waits for the exchange before it.
    System turns stay messages.
    """
    c, t, text = F.col("conv_id"), F.col("turn"), F.col("text")

    def ident(turn: Column) -> Column:
        return F.concat_ws(":", c.cast("string"), turn.cast("string"))

    n = F.size(F.filter(F.split(F.coalesce(text, F.lit("")), r"[ \t\n\x0B\f\r]+"), lambda w: w != ""))
    call = F.struct(ident(t).alias("id"), F.lit("reply").alias("name"),
                    F.struct(n.alias("words"), text.alias("prompt")).alias("arguments"),
                    F.when(t >= 2, F.array(ident(t - 2))).alias("after"))
    return conversations.select(
        "conv_id", "turn",
        F.when(F.col("role") == "user", "assistant").when(F.col("role") == "assistant", "tool").otherwise(F.col("role")).alias("role"),
        F.when(F.col("role") == "user", F.to_json(F.struct(F.array(call).alias("tool_calls"))))
        .when(F.col("role") == "assistant", F.to_json(F.struct(ident(t - 1).alias("tool_call_id"), text.alias("content"))))
        .otherwise(text).alias("text"))
