"""Chat formatting: tool-call linking, with DataFrame and SQL functions only.

Calls and results of a conversation are hash-joined by identifier.  A call may
name calls it depends on; calls are put in topological order by levels: a call
is one level after the last of those it depends on.  Arguments are parsed as
JSON and validated against the tool's schema (fields with a type, required or
not), and each call is serialised as canonical JSON: keys in code-point order,
no white space, absent values as null.

The levels are found round by round, each round placing the calls whose
dependencies are all placed, so the number of rounds is the depth of the deepest
conversation plus one, whatever the number of rows.

Defined cases: a call or result without conversation or identifier is linked
with nothing (status 'no_identifier'; it keeps its place at level 0); several
results for one call: the one that comes first (smallest ``turn``, then
content) is linked and their number reported; repeated calls of one identifier
are ordered and linked each; a dependency that no call of the conversation has
is reported in ``missing`` and does not hold a call back; a cycle leaves level
null and status 'cycle'; arguments that are null or not a JSON object are
invalid; a tool without schema is invalid ('unknown_tool').  Other columns are
not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

#: Tools of the query: field name -> (JSON type, required).
SCHEMAS: dict[str, dict[str, tuple[str, bool]]] = {
    "search": {"query": ("string", True), "limit": ("integer", True), "exact": ("boolean", False)},
    "translate": {"text": ("string", True), "target": ("string", True)},
    "summarize": {"text": ("string", True), "max_words": ("integer", True), "style": ("string", True)},
}


def _kind(value: Column, field: str) -> Column:
    """JSON type of a field of a variant, or null where it is absent."""
    name = F.schema_of_variant(F.try_variant_get(value, f"$.{field}", "variant"))
    return (F.when(name == "BIGINT", "integer").when(name == "STRING", "string").when(name == "BOOLEAN", "boolean")
            .when(name.startswith("DECIMAL") | name.isin("DOUBLE", "FLOAT"), "number")
            .when(name.startswith("ARRAY"), "array").when(name.startswith("OBJECT"), "object")
            .when(name == "VOID", "null"))


def problems(tool: Column, arguments: Column, value: Column, schemas: dict) -> Column:
    """Sorted list of what is wrong with the arguments of a call."""
    is_object = F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))
    none = F.array().cast("array<string>")
    found = F.when(~tool.isin(*schemas) | tool.isNull(), F.array(F.lit("unknown_tool")))
    for name, fields in sorted(schemas.items()):
        checks = []
        for field, (kind, required) in sorted(fields.items()):
            have = _kind(value, field)
            fits = have.isin("integer", "number") if kind == "number" else have == kind
            checks.append(F.when(have.isNull(), F.lit(f"missing:{field}") if required else F.lit(None).cast("string"))
                          .when(~fits, F.lit(f"type:{field}")))
        found = found.when(tool == name, F.when(~is_object, F.array(F.lit("not_an_object")))
                           .otherwise(F.array_compact(F.array(*checks))))
    return F.coalesce(found, none)


def levels(calls: DataFrame, scratch: Scratch) -> DataFrame:
    """conv_id, call_id, level, missing of every identifier of ``calls`` (conv_id, call_id, parents array)."""
    known = scratch.keep(
        calls.where("conv_id is not null and call_id is not null").groupBy("conv_id", "call_id")
        .agg(F.array_distinct(F.flatten(F.collect_set(F.coalesce("parents", F.array().cast("array<string>")))))
             .alias("parents")), "calls")
    wanted = known.select("conv_id", "call_id", F.explode("parents").alias("parent"))
    names = known.select("conv_id", F.col("call_id").alias("parent"), F.lit(True).alias("there"))
    edges = scratch.keep(wanted.join(names, ["conv_id", "parent"], "left")
                         .select("conv_id", "call_id", "parent", F.coalesce("there", F.lit(False)).alias("there")),
                         "edges")
    missing = edges.where("not there").groupBy("conv_id", "call_id").agg(
        F.array_sort(F.collect_set("parent")).alias("missing"))
    held = edges.where("there").select("conv_id", "call_id", "parent")
    placed = scratch.keep(known.select("conv_id", "call_id").join(held.select("conv_id", "call_id").distinct(),
                                                                  ["conv_id", "call_id"], "left_anti")
                          .withColumn("level", F.lit(0)), "level0")
    step = 0
    while True:
        step += 1
        # a call is placed once its dependencies are: its level is one more than the largest of theirs
        at = held.join(placed.select("conv_id", F.col("call_id").alias("parent"), F.col("level").alias("before")),
                       ["conv_id", "parent"], "left")
        ready = (at.groupBy("conv_id", "call_id")
                 .agg(F.max("before").alias("before"), F.count_if(F.col("before").isNull()).alias("open"))
                 .where("open = 0").where(F.col("before") == step - 1)
                 .select("conv_id", "call_id", (F.col("before") + 1).alias("level")))
        new = scratch.keep(ready, f"level{step}", rows=F.count(F.lit(1)))
        if not new.measured["rows"]:
            break
        placed = placed.union(new)
    return (known.select("conv_id", "call_id").join(placed, ["conv_id", "call_id"], "left")
            .join(missing, ["conv_id", "call_id"], "left"))


def link(calls: DataFrame, results: DataFrame, schemas: dict | None = None, scratch: Scratch | None = None) -> DataFrame:
    """One row per row of ``calls`` (conv_id, call_id, turn, tool, arguments, parents), linked and serialised.

    ``results``: conv_id, call_id, turn, content.  Output: conv_id, call_id,
    turn, level (topological), n_results, status, problems, missing, message
    (canonical JSON).
    """
    schemas = SCHEMAS if schemas is None else schemas
    scratch = scratch or Scratch(calls.sparkSession, "tool-calls")
    order = levels(calls, scratch)
    first = (results.where("conv_id is not null and call_id is not null").groupBy("conv_id", "call_id")
             .agg(F.min(F.struct(F.col("turn").isNull().alias("none"), "turn", "content")).alias("r"),
                  F.count(F.lit(1)).alias("n_results"))
             .select("conv_id", "call_id", F.col("r.content").alias("result"), "n_results"))
    rows = calls.select("conv_id", "call_id", "turn", "tool", "arguments", "parents")
    joined = (rows.join(order, ["conv_id", "call_id"], "left")
              .join(first.hint("shuffle_hash"), ["conv_id", "call_id"], "left"))
    value = F.try_parse_json("arguments")
    named = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    out = joined.select(
        "conv_id", "call_id", "turn", "tool", "result", "missing", "parents", value.alias("value"),
        F.when(named, F.col("level")).otherwise(F.lit(0)).alias("level"),
        F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"),
        problems(F.col("tool"), F.col("arguments"), value, schemas).alias("problems"))
    status = (F.when(~named, "no_identifier").when(F.col("level").isNull(), "cycle")
              .when(F.size("problems") > 0, "invalid").when(F.col("n_results") == 0, "no_result").otherwise("ok"))
    message = F.concat(
        F.lit('{"arguments":'), F.coalesce(F.to_json("value"), F.lit("null")),
        F.lit(',"depends_on":'), F.to_json(F.array_sort(F.array_distinct(
            F.coalesce("parents", F.array().cast("array<string>"))))),
        F.lit(',"id":'), _string(F.col("call_id")), F.lit(',"result":'), _string(F.col("result")),
        F.lit(',"tool":'), _string(F.col("tool")), F.lit("}"))
    none = F.array().cast("array<string>")
    return out.select("conv_id", "call_id", "turn", F.col("level").cast("long").alias("level"), "n_results",
                      status.alias("status"), F.array_join("problems", ",").alias("problems"),
                      F.array_join(F.coalesce("missing", none), ",").alias("missing"), message.alias("message"))


def _string(value: Column) -> Column:
    """A string as JSON; null as null."""
    inner = F.to_json(F.array(F.coalesce(value, F.lit(""))))
    return F.when(value.isNull(), "null").otherwise(F.substring(inner, F.lit(2), F.length(inner) - 2))


def from_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tool calls and results of plain conversations (conv_id, turn, role, text).

    Every user turn is a call whose identifier is its turn, every assistant
    turn the result of the turn before it.  The tool goes round by turn; a call
    depends on the conversation's first call and the call at half its turn.
    Every eleventh turn-and-length leaves out a required argument, so that
    validation has something to find.
    """
    turn, text = F.col("turn"), F.coalesce("text", F.lit(""))
    size = F.length(text)
    pick = F.pmod(turn + F.col("conv_id"), F.lit(3))
    tool = F.when(pick == 0, "search").when(pick == 1, "translate").otherwise("summarize")
    short = F.pmod(turn + size, F.lit(11)) == 0
    arguments = (
        F.when(pick == 0, F.to_json(F.struct(text.alias("query"), F.when(~short, size).alias("limit"),
                                             (size > 100).alias("exact"))))
        .when(pick == 1, F.to_json(F.struct(text.alias("text"), F.when(~short, F.lit("en")).alias("target"))))
        .otherwise(F.to_json(F.struct(text.alias("text"), F.when(~short, F.lit("plain")).alias("style"),
                                      (size % 50).alias("max_words")))))
    parents = F.array_distinct(F.filter(
        F.array(F.when(turn > 1, F.lit(0)), F.when(turn > 1, F.floor(turn / 2))), lambda p: p.isNotNull()))
    calls = turns.where("role = 'user'").select(
        "conv_id", turn.cast("string").alias("call_id"), "turn", tool.alias("tool"), arguments.alias("arguments"),
        F.transform(parents, lambda p: p.cast("string")).alias("parents"))
    results = turns.where("role = 'assistant'").select(
        "conv_id", (turn - 1).cast("string").alias("call_id"), "turn", F.col("text").alias("content"))
    return calls, results


ORACLE = r"""
with calls as (
  select conv_id, turn, text, length(coalesce(text, '')) as size, (turn + conv_id) % 3 as pick,
         (turn + length(coalesce(text, ''))) % 11 = 0 as short,
         case when turn > 1 then list_distinct([0, turn // 2]) else [] end as parents
  from conversations where role = 'user'),
edges as (select conv_id, turn, unnest(parents) as parent from calls),
held as (select e.* from edges e join calls c on c.conv_id = e.conv_id and c.turn = e.parent),
missing as (
  select conv_id, turn, string_agg(parent::varchar, ',' order by parent::varchar) as missing
  from edges e where not exists (select 1 from calls c where c.conv_id = e.conv_id and c.turn = e.parent)
  group by conv_id, turn),
walk as (
  with recursive w(conv_id, turn, depth) as (
    select conv_id, turn, 0 from calls
    union all
    select h.conv_id, h.turn, w.depth + 1 from w join held h on h.conv_id = w.conv_id and h.parent = w.turn)
  select conv_id, turn, cast(max(depth) as bigint) as level from w group by conv_id, turn),
results as (
  select conv_id, turn - 1 as turn, count(*) as n, first(text order by turn, text) as result
  from conversations where role = 'assistant' group by conv_id, turn - 1),
built as (
  select c.*, w.level, coalesce(r.n, 0) as n_results, r.result, coalesce(m.missing, '') as missing,
         case when not short then '' when pick = 0 then 'missing:limit' when pick = 1 then 'missing:target'
              else 'missing:style' end as problems,
         case pick when 0 then 'search' when 1 then 'translate' else 'summarize' end as tool,
         to_json(coalesce(text, '')) as body
  from calls c join walk w using (conv_id, turn) left join results r using (conv_id, turn)
       left join missing m using (conv_id, turn))
select conv_id, turn::varchar as call_id, turn, level, n_results,
       case when problems <> '' then 'invalid' when n_results = 0 then 'no_result' else 'ok' end as status,
       problems, missing,
       '{"arguments":' ||
       case pick
         when 0 then '{"exact":' || (size > 100)::varchar || case when short then '' else ',"limit":' || size end
                     || ',"query":' || body || '}'
         when 1 then '{' || case when short then '' else '"target":"en",' end || '"text":' || body || '}'
         else '{"max_words":' || (size % 50) || case when short then '' else ',"style":"plain"' end
              || ',"text":' || body || '}' end
       || ',"depends_on":[' || array_to_string(list_transform(list_sort(list_transform(parents, lambda p: p::varchar)),
                                               lambda p: '"' || p || '"'), ',')
       || '],"id":"' || turn || '","result":' || coalesce(to_json(result)::varchar, 'null')
       || ',"tool":"' || tool || '"}' as message
from built
"""
