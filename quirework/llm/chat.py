"""Chat formatting with linked tool calls (DataFrame functions only).

A message's text may be a JSON object with ``tool_calls`` (each ``{"id", "name", "arguments"}``, or
these inside ``"function"``; arguments may be an object or a string that holds one) or with
``tool_call_id``; any other text is plain content.  Objects are read as variants, so numbers, strings,
lists and nested values keep their types.  Calls of assistant messages and results in tool messages
are equi-joined by (conversation, identifier); a result is placed after its call, whichever came
first; arguments are validated against the tool's schema; every message is serialised as canonical
JSON (sorted keys, no blanks, numbers in one spelling).  Whatever else an object holds stands under
``extra``, so nothing is lost, whoever sent it.

One row per message, never per conversation, so a conversation of any length is no single row:
(conv_id, at_turn, at_rank, turn) is the topological order.

Defined cases: null text and role count as empty; text that looks like an object and is none is
content as it is; a repeated call identifier belongs to its smallest turn, and there counts once; a
call without identifier is never answered; a message is 'answered' when each identifier that belongs
to it has a result; a result without a call keeps its place and is 'orphan'; an unknown tool,
arguments that do not fit its schema, unknown arguments or arguments that are no object make a call
invalid, missing ones count as none; tool calls of others than assistants and results of others than
tools are kept and not linked; repeated rows are formatted each; very long texts are one message; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, text_or_empty

#: Tool -> argument -> (type, required).
SCHEMAS = {
    "search": {"query": ("string", True), "limit": ("integer", False)},
    "calculate": {"expression": ("string", True)},
    "fetch": {"url": ("string", True), "timeout": ("number", False)},
}
#: What schema_of_variant says of values of each type.
_TYPES = {"string": "STRING", "integer": r"BIGINT|DECIMAL\([0-9]+,0\)", "number": r"BIGINT|DOUBLE|FLOAT|DECIMAL\(.*", "boolean": "BOOLEAN", "array": "ARRAY<.*", "object": "OBJECT<.*"}


def _get(c: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(c, path, kind)


def _rest(m: Column, *known: str) -> Column:
    """The entries of a map but for some, null without any."""
    rest = F.map_filter(m, lambda k, _: ~k.isin(*known))
    return F.when(F.size(rest) > 0, rest)


def valid_call(name: Column, fields_of: Column, schemas: dict = SCHEMAS) -> Column:
    """Whether the arguments of a call, a map of variants or null if they are none, fit the schema of its tool."""
    out = F.lit(False)
    for tool, fields in sorted(schemas.items()):
        fits = F.size(F.array_except(F.map_keys(fields_of), F.array(*map(F.lit, sorted(fields))))) == 0
        for field, (kind, required) in sorted(fields.items()):
            v = F.element_at(fields_of, F.lit(field))
            fits = fits & F.when(v.isNull(), F.lit(not required)).otherwise(F.schema_of_variant(v).rlike(f"^(?:{_TYPES[kind]})$"))
        out = F.when(name == tool, fits).otherwise(out)
    return F.coalesce(out, F.lit(False))


def _opened(c: Column) -> Column:
    """A call as given with what is read from it; each step is a column of its own, for lambdas share nothing."""
    return F.struct(
        c.alias("c"), _get(c, "$", "map<string,variant>").alias("own"), _get(c, "$.function", "map<string,variant>").alias("inner"), _get(c, "$.name", "string").alias("name"),
        _get(c, "$.function.name", "string").alias("inner_name"), _get(c, "$.arguments", "variant").alias("args"), _get(c, "$.function.arguments", "variant").alias("inner_args"),
    )


def _arguments(x: Column) -> Column:
    """With the arguments as an object, where they are or hold one."""
    raw = F.coalesce(x["args"], x["inner_args"])
    args = F.when(F.schema_of_variant(raw) == "STRING", F.coalesce(F.try_parse_json(raw.cast("string")), raw)).otherwise(raw)
    return F.struct(x.alias("x"), args.alias("args"))


def _fields(y: Column) -> Column:
    none = y["args"].isNull() | F.is_variant_null(y["args"])
    return F.struct(y["x"].alias("x"), y["args"].alias("args"), F.when(none, F.create_map().cast("map<string,variant>")).otherwise(_get(y["args"], "$", "map<string,variant>")).alias("fields"))


def _call(z: Column, schemas: dict) -> Column:
    """One call in canonical form; keys stand in sorted order."""
    x = z["x"]
    name = F.coalesce(x["name"], x["inner_name"])
    # what is no object is kept whole
    extra = F.when(x["own"].isNull(), F.create_map(F.lit("value"), x["c"])).otherwise(_rest(x["own"], "id", "name", "arguments", "function"))
    # a function that is no object, or a second name or arguments in it
    odd = F.when(x["inner"].isNull(), _get(x["c"], "$.function", "variant"))
    twice = F.when(x["name"].isNotNull() & x["inner_name"].isNotNull(), x["inner"]["name"])
    again = F.when(x["args"].isNotNull(), x["inner_args"])
    return F.struct(
        z["args"].alias("arguments"), extra.alias("extra"), F.coalesce(odd, again).alias("function"), _rest(x["inner"], "name", "arguments").alias("function_extra"), twice.alias("function_name"),
        _get(x["c"], "$.id", "string").alias("id"), name.alias("name"), valid_call(name, z["fields"], schemas).alias("valid"),
    )


def read_messages(messages: DataFrame, schemas: dict = SCHEMAS) -> DataFrame:
    """conv_id, turn, role, ids (of calls that link), answers, n_calls, n_valid, message."""
    text = text_or_empty("text")
    # only what looks like such an object is parsed
    looks = F.ltrim(text).startswith("{") & (text.contains('"tool_calls"') | text.contains('"tool_call_id"'))
    m = messages.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), text.alias("text"), F.when(looks, F.try_parse_json(text)).alias("v"))
    m = m.withColumn("o", _get(F.col("v"), "$", "map<string,variant>"))
    known = F.map_contains_key("o", "tool_calls") | F.map_contains_key("o", "tool_call_id")
    m = m.withColumn("raw", F.when(known, _get(F.col("v"), "$.tool_calls", "array<variant>"))).withColumn("known", F.coalesce(known, F.lit(False)))
    for step in (_opened, _arguments, _fields, lambda z: _call(z, schemas)):
        m = m.withColumn("calls", F.transform("calls" if "calls" in m.columns else "raw", step))
    # calls that are no list, and a role of the object's own, are kept as extra
    extra = F.when(F.col("raw").isNull(), _rest(F.col("o"), "content", "tool_call_id")).otherwise(_rest(F.col("o"), "content", "tool_call_id", "tool_calls"))
    full = F.struct(F.col("o")["content"].alias("content"), extra.alias("extra"), "role", F.col("o")["tool_call_id"].alias("tool_call_id"), F.when(F.size("calls") > 0, F.col("calls")).alias("tool_calls"))
    plain = F.struct(F.col("text").alias("content"), "role")
    made = F.when(F.col("role") == "assistant", F.col("calls"))
    return m.select(
        "conv_id", "turn", "role",
        F.coalesce(F.transform(made, lambda c: c["id"]), F.array().cast("array<string>")).alias("ids"),
        F.when(F.col("known") & (F.col("role") == "tool"), _get(F.col("v"), "$.tool_call_id", "string")).alias("answers"),
        F.coalesce(F.size(F.filter(made, lambda c: c["valid"])), F.lit(0)).cast("long").alias("n_valid"),
        F.when(F.col("known"), F.to_json(full)).otherwise(F.to_json(plain)).alias("message"),
    )


def format_messages(messages: DataFrame, schemas: dict = SCHEMAS) -> DataFrame:
    """conv_id, turn, role, at_turn, at_rank, n_calls, n_valid, n_answered, status, message (canonical JSON)."""
    m = materialise(read_messages(messages, schemas), "messages")  # texts are parsed once
    # a hot conversation is reduced before the shuffle, and joins are by (conversation, identifier)
    made = m.where(F.size("ids") > 0).select("conv_id", "turn", F.explode("ids").alias("id")).groupBy("conv_id", "id").agg(F.min("turn").alias("call_turn"))
    given = m.where("answers is not null").groupBy(F.col("conv_id").alias("g_conv"), F.col("answers").alias("g_id")).agg(F.count("*").alias("n"))
    linked = made.join(given, made["conv_id"].eqNullSafe(given["g_conv"]) & made["id"].eqNullSafe(given["g_id"]), "left")
    per = linked.groupBy(F.col("conv_id").alias("c_conv"), F.col("call_turn").alias("c_turn")).agg(F.count("n").alias("n_answered"), F.count("*").alias("n_own"))
    calls = m.where(F.size("ids") > 0)
    calls = calls.join(per, calls["conv_id"].eqNullSafe(per["c_conv"]) & calls["turn"].eqNullSafe(per["c_turn"]), "left")
    results = m.where("answers is not null")
    target = made.select(F.col("conv_id").alias("c_conv"), F.col("id").alias("c_id"), "call_turn", F.lit(True).alias("found"))
    results = results.join(target, results["conv_id"].eqNullSafe(target["c_conv"]) & (results["answers"] == target["c_id"]), "left")
    plain = m.where(F.col("answers").isNull() & (F.size("ids") == 0))

    def shaped(df: DataFrame, call_turn: Column, answered: Column, status: Column) -> DataFrame:
        late = F.coalesce(call_turn > F.col("turn"), F.lit(False))
        return df.select(
            "conv_id", "turn", "role",
            F.when(late, call_turn).otherwise(F.col("turn")).cast("long").alias("at_turn"), late.cast("int").alias("at_rank"),
            F.size("ids").cast("long").alias("n_calls"), "n_valid", answered.cast("long").alias("n_answered"), status.alias("status"), "message",
        )

    n = F.coalesce("n_answered", F.lit(0))
    return (
        shaped(plain, F.lit(None).cast("long"), F.lit(0), F.lit("plain"))
        .union(shaped(calls, F.lit(None).cast("long"), n, F.when((n > 0) & (n == F.col("n_own")), "answered").otherwise("unanswered")))
        .union(shaped(results, F.col("call_turn"), F.lit(0), F.when(F.col("found"), "linked").otherwise("orphan")))
    )
