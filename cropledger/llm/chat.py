"""Chat formatting: tool calls linked to results, ordered, validated and written as canonical JSON. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise

#: Example tools as (tool, parameter, JSON type, required).
SCHEMAS = [
    ("search", "query", "string", True),
    ("search", "turn", "integer", True),
    ("lookup", "query", "string", True),
    ("lookup", "turn", "integer", True),
    ("lookup", "exact", "boolean", True),
    ("measure", "length", "integer", True),
    ("measure", "turn", "string", True),
    ("measure", "text", "string", True),
]


def schema_table(spark: SparkSession, schemas=None) -> DataFrame:
    return spark.createDataFrame(schemas or SCHEMAS, "name string, parameter string, type string, required boolean")


def _json_type(value: Column) -> Column:
    """JSON type of a variant."""
    kind = F.schema_of_variant(value)
    return (
        F.when(kind.startswith("OBJECT"), "object").when(kind.startswith("ARRAY"), "array").when(kind == "STRING", "string").when(kind == "BOOLEAN", "boolean")
        .when(kind == "BIGINT", "integer").when(kind.startswith("DECIMAL") | (kind == "DOUBLE"), "number").otherwise("null")
    )


def validate(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """(conv_id, call_id, turn, violations): an array of sorted texts for each call; empty if its arguments fit the tool's schema.

    The schema table has one row per parameter; it is grouped to one row per tool, and a call is checked within its row.
    """
    tools = schemas.groupBy("name").agg(F.map_from_entries(F.collect_list(F.struct("parameter", F.struct("type", "required")))).alias("parameters"))
    parsed = calls.join(tools, "name", "left").withColumn("value", F.try_parse_json("arguments")).withColumn("given", F.expr("try_cast(value as map<string, variant>)"))
    names = F.array_sort(F.map_keys("parameters"))
    missing = F.transform(F.filter(names, lambda p: F.col("parameters")[p]["required"] & ~F.map_contains_key("given", p)), lambda p: F.concat(F.lit("missing "), p))
    unknown = F.transform(F.filter(F.map_keys("given"), lambda p: ~F.map_contains_key("parameters", p)), lambda p: F.concat(F.lit("unknown "), p))
    wrong = F.filter(names, lambda p: F.map_contains_key("given", p) & ~((_json_type(F.col("given")[p]) == F.col("parameters")[p]["type"]) | ((F.col("parameters")[p]["type"] == "number") & (_json_type(F.col("given")[p]) == "integer"))))
    wrong = F.transform(wrong, lambda p: F.concat(F.lit("wrong type "), p))
    found = F.when(F.col("parameters").isNull(), F.array(F.lit("unknown tool"))).when(F.col("given").isNull(), F.array(F.lit("arguments are not an object"))).otherwise(F.array_sort(F.concat(missing, unknown, wrong)))
    return parsed.withColumn("violations", found).drop("parameters", "given", "value")


def _followed(single: DataFrame) -> DataFrame:
    """single with each call's need followed through other such calls, by pointer doubling; calls on or before a cycle left out.

    A row (up, low, more) says that a level is max(low, level of up + more), and two such rows compose to another.
    """
    most = single.groupBy("conv_id").agg(F.count("*").alias("n")).agg(F.max("n")).collect()[0][0] or 0
    ends = single.withColumn("open", F.lit(True))
    for _ in range(most.bit_length()):  # no chain of single needs has more links than the conversation has such calls
        over = ends.select("conv_id", F.col("call_id").alias("up"), F.col("up").alias("up_2"), F.col("low").alias("low_2"), F.col("more").alias("more_2"))
        joined = ends.join(over, ["conv_id", "up"], "left")
        ends = materialise(
            joined.select(
                "conv_id", "call_id", F.coalesce("up_2", "up").alias("up"), F.greatest("low", F.col("low_2") + F.col("more")).alias("low"),
                (F.col("more") + F.coalesce("more_2", F.lit(0))).alias("more"), F.col("up_2").isNotNull().alias("open"),
            ),
            "followed",
        )
        if ends.where("open").isEmpty():
            break
    return ends.join(single.select("conv_id", F.col("call_id").alias("up")), ["conv_id", "up"], "left_anti").select("conv_id", "call_id", "up", "low", "more")


def levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, level) of calls that depend on others of their conversation or are needed: the longest chain of calls before it.

    A state row (call, up, low, more) says that the call's level is at least max(low, level of up + more); up is null
    where all is known. In each round, calls with one open need are followed to the end of their chain in a number
    of joins that is logarithmic in its length, and rows whose up is then settled or such a call are replaced. A chain of any
    length takes one round; only calls with several open needs each may ask for more. Calls on a cycle, or
    after one, never settle: their level is null.
    """
    known = calls.groupBy("conv_id", "call_id").agg(F.max("turn").alias("turn")).drop("turn")
    needs = calls.select("conv_id", "call_id", F.explode("depends_on").alias("up")).distinct()
    needs = materialise(needs.join(known.withColumnRenamed("call_id", "up"), ["conv_id", "up"], "left_semi"), "needs")
    nodes = needs.select("conv_id", "call_id").union(needs.select("conv_id", "up")).distinct()
    zero = F.lit(0).cast("long")
    state = needs.select("conv_id", "call_id", "up", zero.alias("low"), (zero + 1).alias("more"))
    state = materialise(state.unionByName(nodes.select("conv_id", "call_id", F.lit(None).cast("string").alias("up"), zero.alias("low"), zero.alias("more"))), "levels")
    while True:
        node = materialise(state.groupBy("conv_id", "call_id").agg(F.count("up").alias("n"), F.max("up").alias("up"), F.max("low").alias("low"), F.max(F.when(F.col("up").isNotNull(), F.col("more"))).alias("more")), "level_nodes")
        if node.where("n > 0").isEmpty():
            break
        ends = _followed(node.where("n = 1").drop("n"))
        settled = node.where("n = 0").select("conv_id", "call_id", "up", "low", "more")
        rest = state.join(ends.select("conv_id", "call_id"), ["conv_id", "call_id"], "left_anti")
        onward = settled.unionByName(ends).select("conv_id", F.col("call_id").alias("up"), F.col("up").alias("up_2"), F.col("low").alias("low_2"), F.col("more").alias("more_2"))
        joined = rest.unionByName(ends).join(onward, ["conv_id", "up"], "left")
        hit = F.col("low_2").isNotNull()
        replaced = joined.select(
            "conv_id", "call_id", F.when(hit, F.col("up_2")).otherwise(F.col("up")).alias("up"), F.greatest("low", F.col("low_2") + F.col("more")).alias("low"), (F.col("more") + F.coalesce("more_2", F.lit(0))).alias("more"), hit.alias("hit"),
        )
        merged = replaced.groupBy("conv_id", "call_id", "up").agg(F.max("low").alias("low"), F.max("more").alias("more"), F.max("hit").alias("hit"))
        merged = materialise(merged, "levels")
        state = merged.drop("hit")
        if merged.where("hit").isEmpty():
            break
    return state.groupBy("conv_id", "call_id").agg(F.when(F.count("up") == 0, F.max("low")).cast("int").alias("level"))


def link(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per call and per result: conv_id, turn, kind, call_id, level, status, violations, json.

    calls: conv_id, turn, call_id, name, arguments (JSON text), depends_on (array of call ids, or null); results: conv_id, turn,
    call_id, content. Results join calls by (conv_id, call_id); if several calls share an id, the first by turn
    holds it (a null turn is first) and the others are `repeated`. Of calls that share turn and id, the one with the least hash of name
    and arguments holds it; calls alike in these too share its status. Empty tables give no rows of their kind; texts of any
    length are taken whole; repeated rows are all returned; further columns are not read. A call is linked, unanswered, or cyclic; a result linked or orphan.
    A result's level is its call's, so (conv_id, level, turn, kind) is a topological order. json has sorted keys, no
    white space, and arguments as parsed JSON with sorted keys; arguments that aren't JSON are null there. Null ids link with nothing.
    """
    key = ["conv_id", "call_id"]
    calls = calls.select("conv_id", "turn", "call_id", "name", "arguments", "depends_on")
    results = results.select("conv_id", "turn", "call_id", "content")
    checked = validate(calls, schemas)
    place = F.struct("turn", F.xxhash64("name", "arguments").alias("hash"))
    first = calls.where("conv_id is not null and call_id is not null").groupBy(key).agg(F.min(place).alias("first_turn"))
    level = levels(calls.where("conv_id is not null and call_id is not null")).withColumn("depends", F.lit(True))
    answered = results.groupBy(key).agg(F.count("*").alias("answers"))
    known = first.join(answered, key, "left").join(level, key, "left").select(*key, "first_turn", "answers", F.when(F.col("depends"), F.col("level")).otherwise(0).alias("level"))
    known = materialise(known, "call_keys")
    status = (
        F.when(F.col("first_turn").isNotNull() & (place > F.col("first_turn")), "repeated").when(F.col("first_turn").isNotNull() & F.col("level").isNull(), "cyclic")
        .when(F.col("answers") > 0, "linked").otherwise("unanswered")
    )
    body = F.to_json(F.struct(F.try_parse_json("arguments").alias("arguments"), F.col("call_id").alias("id"), "name", F.lit("call").alias("type")), {"ignoreNullFields": "false"})
    asked = checked.join(known, key, "left").select("conv_id", "turn", F.lit("call").alias("kind"), "call_id", "level", status.alias("status"), F.array_join("violations", "; ").alias("violations"), body.alias("json"))
    answer = F.to_json(F.struct("call_id", "content", F.lit("result").alias("type")), {"ignoreNullFields": "false"})
    given = results.join(known, key, "left").select(
        "conv_id", "turn", F.lit("result").alias("kind"), "call_id", "level", F.when(F.col("first_turn").isNotNull(), "linked").otherwise("orphan").alias("status"), F.lit("").alias("violations"), answer.alias("json")
    )
    return asked.unionByName(given)


def calls_of(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tool calls and results made from plain turns: each user turn asks a tool that its turn number names, and needs the
    answer of the user turn two before it; an assistant turn answers the turn before it. Turns of any other role give nothing here; messages_of() has them."""
    tool = F.element_at(F.array(F.lit("search"), F.lit("lookup"), F.lit("measure")), (F.col("turn") % 3 + 1).cast("int"))
    text = F.coalesce("text", F.lit(""))
    arguments = (
        F.when(F.col("turn") % 3 == 0, F.to_json(F.struct("turn", text.alias("query"))))
        .when(F.col("turn") % 3 == 1, F.to_json(F.struct("turn", text.alias("query"), (F.length(text) % 2 == 0).alias("exact"))))
        .otherwise(F.to_json(F.struct(F.length(text).alias("length"), text.alias("text"), "turn")))
    )
    name = lambda t: F.concat(F.lit("call_"), t.cast("string"))
    asked = turns.where("role = 'user'").select("conv_id", "turn", name(F.col("turn")).alias("call_id"), tool.alias("name"), arguments.alias("arguments"), F.array(name(F.col("turn") - 2)).alias("depends_on"))
    given = turns.where("role = 'assistant'").select("conv_id", "turn", name(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"))
    return asked, given


def messages_of(turns: DataFrame) -> DataFrame:
    """link()'s columns for the turns that calls_of() makes nothing of (system, null or any further role): kind 'message', level 0."""
    other = turns.where("not (role <=> 'user') and not (role <=> 'assistant')")
    body = F.to_json(F.struct(F.col("text").alias("content"), "role", F.lit("message").alias("type")), {"ignoreNullFields": "false"})
    return other.select("conv_id", "turn", F.lit("message").alias("kind"), F.lit(None).cast("string").alias("call_id"), F.lit(0).alias("level"), F.lit("unlinked").alias("status"), F.lit("").alias("violations"), body.alias("json"))


def link_turns(turns: DataFrame) -> DataFrame:
    """link()'s columns with one row for every turn, each with its whole text."""
    return link(*calls_of(turns), schema_table(turns.sparkSession)).unionByName(messages_of(turns))


#: DuckDB SQL for link_turns(conversations).
SQL = """
with asked as (
  select conv_id, turn, 'call_' || turn as call_id, ['search', 'lookup', 'measure'][(turn % 3 + 1)::int] as name, coalesce(text, '') as text,
         row_number() over (partition by conv_id, turn % 2 order by turn) as rn
  from conversations where role = 'user'),
ordered as (
  select *, (row_number() over (partition by conv_id, turn % 2, turn - 2 * rn order by turn) - 1)::int as level from asked),
given as (
  select conv_id, turn, 'call_' || (turn - 1) as call_id, text as content from conversations where role = 'assistant'),
args as (
  select *, case turn % 3
      when 0 then '{"query":' || to_json(text)::varchar || ',"turn":' || turn || '}'
      when 1 then '{"exact":' || (length(text) % 2 = 0)::varchar || ',"query":' || to_json(text)::varchar || ',"turn":' || turn || '}'
      else '{"length":' || length(text) || ',"text":' || to_json(text)::varchar || ',"turn":' || turn || '}' end as arguments
  from ordered)
select a.conv_id, a.turn, 'call' as kind, a.call_id, a.level,
       case when g.call_id is null then 'unanswered' else 'linked' end as status,
       case when a.turn % 3 = 2 then 'wrong type turn' else '' end as violations,
       '{"arguments":' || arguments || ',"id":"' || a.call_id || '","name":"' || name || '","type":"call"}' as json
from args a left join (select distinct conv_id, call_id from given) g using (conv_id, call_id)
union all
select g.conv_id, g.turn, 'result', g.call_id, o.level, case when o.call_id is null then 'orphan' else 'linked' end, '',
       '{"call_id":"' || g.call_id || '","content":' || coalesce(to_json(content)::varchar, 'null') || ',"type":"result"}'
from given g left join ordered o using (conv_id, call_id)
union all
select conv_id, turn, 'message', null, 0, 'unlinked', '',
       '{"content":' || coalesce(to_json(text)::varchar, 'null') || ',"role":' || coalesce(to_json(role)::varchar, 'null') || ',"type":"message"}'
from conversations where role is distinct from 'user' and role is distinct from 'assistant'
"""
