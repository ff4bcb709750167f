"""Chat formatting: tool calls linked to their results, conversations as
canonical JSON.

Messages may hold `<tool_call>{...}</tool_call>` with id, name, arguments and
after (ids that the call builds on), and `<tool_result>{...}</tool_result>`
with id and content.  Calls and results are taken out of the texts, joined by
conversation and identifier, put into topological order, their arguments held
against the tools' schemas, and each call is written as canonical JSON (keys
sorted, no blanks).  ``format_messages`` gives every message its place in the
conversation and its canonical JSON: role, text without markup and its calls.

Everything is built-in SQL functions; JSON is parsed into variants.  A call's
depth is the length of the longest chain of calls it builds on.  Calls that
build on one call point to it, and pointers are doubled until they end at a
call that builds on none or on several: a chain of n calls takes log2(n)
rounds.  Calls that build on several follow in one round a level of such
calls.  `step` numbers a conversation's calls by depth, turn and place in the
message, `position` its messages by turn, role and text.  Both are made of
counts per block of turns and one window per block, so a conversation with a
third of all messages is not gathered in one task.

Null texts hold nothing and have null content.  Markup that is no valid JSON,
or has no id, gives a call with status `malformed` and no link.  The first
result after a call (by turn) with its id counts, others are left; a repeated
call id within a conversation is `duplicate` beyond the first and gets no
link.  Ids in after that name no other call of the conversation are ignored in
the order but make the status `unknown_dependency`; calls in a cycle, or that
build on one, have no depth, come last and are `cyclic`.  Rows repeated with
the same conversation, turn, role and text are read once; different messages
of one turn each keep their calls.  Texts are read whole, however long; one
message's calls are one list.  An empty table gives no rows; columns other
than conv_id, turn, role and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from auditlens.llm.common import discard, written

#: Turns of a conversation whose calls one window numbers.
BLOCK = 1000

#: tool -> parameter -> (variant type, required)
SCHEMAS = {
    "search": {"query": ("STRING", True), "limit": ("BIGINT", True)},
    "measure": {"chars": ("BIGINT", True), "note": ("STRING", False)},
    "quote": {"query": ("STRING", True), "exact": ("BOOLEAN", False)},
}


def markup(text: Column, tag: str) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(rf"(?s)<{tag}>(.*?)</{tag}>"), F.lit(1))


def _string(value: Column, path: str) -> Column:
    return F.try_variant_get(value, f"$.{path}", "string")


def argument_errors(name: Column, arguments: Column, schemas: dict = SCHEMAS) -> Column:
    """What is wrong with a call's arguments (a variant): the tool is not
    known, a parameter misses, has another type or is not known."""
    given = F.map_keys(F.coalesce(F.try_variant_get(arguments, "$", "map<string,variant>"), F.create_map().cast("map<string,variant>")))
    out = F.array(F.lit("unknown_tool"))
    for tool, params in sorted(schemas.items()):
        wrong = []
        for param, (kind, required) in sorted(params.items()):
            value = F.try_variant_get(arguments, f"$.{param}", "variant")
            if required:
                wrong.append(F.when(value.isNull(), F.lit(f"missing_{param}")))
            wrong.append(F.when(value.isNotNull() & (F.schema_of_variant(value) != kind), F.lit(f"type_{param}")))
        unknown = F.transform(F.array_sort(F.array_except(given, F.array(*[F.lit(p) for p in params]))), lambda p: F.concat(F.lit("unknown_"), p))
        out = F.when(name == tool, F.concat(F.array_compact(F.array(*wrong)), unknown)).otherwise(out)
    return out


def keyed(messages: DataFrame) -> DataFrame:
    """The distinct messages: conv_id as text, a null one as the empty text, so
    that null conversations link too; turn, role, text and _msg, which tells
    the messages of a turn apart."""
    role = F.col("role").cast("string") if "role" in messages.columns else F.lit(None).cast("string")
    rows = messages.select(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), "text")
    mark = F.md5(F.to_json(F.struct("role", "text")))
    return rows.withColumn("_msg", mark).groupBy("conv_id", "turn", "_msg").agg(F.first("role").alias("role"), F.first("text").alias("text"))


def parse_calls(messages: DataFrame, schemas: dict = SCHEMAS) -> DataFrame:
    """conv_id, turn, _msg, nth, call_id, name, arguments (canonical JSON),
    errors and after of every call in the texts."""
    found = messages.select("conv_id", "turn", "_msg", F.posexplode(markup(F.col("text"), "tool_call")).alias("nth", "body"))
    v = found.withColumn("v", F.try_parse_json("body"))
    arguments = F.try_variant_get("v", "$.arguments", "variant")
    name = F.coalesce(_string(F.col("v"), "name"), F.lit(""))
    after = F.coalesce(F.try_variant_get("v", "$.after", "array<string>"), F.array().cast("array<string>"))
    return v.select("conv_id", "turn", "_msg", "nth", _string(F.col("v"), "id").alias("call_id"), name.alias("name"),
                    F.coalesce(F.to_json(arguments), F.lit("{}")).alias("arguments"), argument_errors(name, arguments, schemas).alias("errors"),
                    F.array_sort(F.array_distinct(after)).alias("after"))


def parse_results(messages: DataFrame, calls: DataFrame) -> DataFrame:
    """The first result after each of ``calls`` (one an id): conv_id, call_id,
    result_turn, result."""
    found = messages.select("conv_id", "turn", F.posexplode(markup(F.col("text"), "tool_result")).alias("nth", "body"))
    v = found.withColumn("v", F.try_parse_json("body"))
    named = v.select("conv_id", "turn", "nth", _string(F.col("v"), "id").alias("call_id"), _string(F.col("v"), "content").alias("content")).where("call_id is not null")
    asked = calls.select("conv_id", "call_id", F.col("turn").alias("_asked"))
    later = named.join(asked.hint("shuffle_hash"), ["conv_id", "call_id"]).where(F.col("turn") > F.col("_asked"))
    first = later.groupBy("conv_id", "call_id").agg(F.min(F.struct("turn", "nth", "content")).alias("r"))
    return first.select("conv_id", "call_id", F.col("r.turn").alias("result_turn"), F.col("r.content").alias("result"))


def pointers(nodes: DataFrame, edges: DataFrame, needs: DataFrame) -> DataFrame:
    """conv_id, call_id, anchor and dist of each call: the first call down its
    chain that builds on none or on several, and the steps to it.  Calls whose
    chain runs into a cycle have none."""
    single = edges.join(needs.where("needs = 1").select("conv_id", "call_id"), ["conv_id", "call_id"]).select("conv_id", "call_id", "dep")
    start = nodes.join(single, ["conv_id", "call_id"], "left").select(
        "conv_id", "call_id", F.coalesce("dep", "call_id").alias("anchor"), F.col("dep").isNotNull().cast("long").alias("dist"), F.col("dep").isNotNull().alias("open"))
    at = written(start, "chat-pointers")
    longest = nodes.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
    reach = 1
    while reach < 2 * longest and at.where("open").limit(1).count():  # beyond, what is still open goes round in a cycle
        onward = at.select("conv_id", F.col("call_id").alias("anchor"), F.col("anchor").alias("_to"), F.col("dist").alias("_more"), F.col("open").alias("_open"))
        moved = at.where("open").join(onward, ["conv_id", "anchor"]).select("conv_id", "call_id", F.col("_to").alias("anchor"), (F.col("dist") + F.col("_more")).alias("dist"), F.col("_open").alias("open"))
        before, at = at, written(at.where("not open").unionByName(moved), "chat-pointers")
        discard(before)
        reach *= 2
    return at.where("not open").drop("open")


def depths(calls: DataFrame) -> DataFrame:
    """conv_id, call_id and depth of the calls (first of each id) that are in
    no cycle and follow none."""
    nodes = calls.select("conv_id", "call_id")
    named = calls.select("conv_id", "call_id", F.explode("after").alias("dep"))
    edges = written(named.join(nodes.select("conv_id", F.col("call_id").alias("dep")).hint("shuffle_hash"), ["conv_id", "dep"]), "chat-edges")
    needs = written(edges.groupBy("conv_id", "call_id").agg(F.count(F.lit(1)).alias("needs")), "chat-needs")
    ends = written(pointers(nodes, edges, needs), "chat-ends")
    several = needs.where("needs > 1")
    down = ends.select("conv_id", F.col("call_id").alias("dep"), "anchor", "dist")
    steps = written(edges.join(several.select("conv_id", "call_id"), ["conv_id", "call_id"]).join(down, ["conv_id", "dep"]), "chat-steps")
    known = written(nodes.join(needs.select("conv_id", "call_id"), ["conv_id", "call_id"], "left_anti").withColumn("depth", F.lit(0).cast("long")), "chat-depth")
    done = known
    while steps.limit(1).count() and known.limit(1).count():  # a round for each level of calls that build on several
        ready = steps.join(done.select("conv_id", F.col("call_id").alias("anchor"), "depth"), ["conv_id", "anchor"]).groupBy("conv_id", "call_id").agg(
            F.count(F.lit(1)).alias("met"), (F.max(F.col("depth") + F.col("dist")) + 1).alias("depth"))
        fresh = ready.join(several, ["conv_id", "call_id"]).where("met = needs").select("conv_id", "call_id", "depth")
        known = written(fresh.join(done, ["conv_id", "call_id"], "left_anti"), "chat-depth")
        done = written(done.unionByName(known), "chat-done")
    base = done.select("conv_id", F.col("call_id").alias("anchor"), "depth")
    return ends.join(base, ["conv_id", "anchor"]).select("conv_id", "call_id", (F.col("depth") + F.col("dist")).cast("int").alias("depth"))


def gapless(rows: DataFrame, levels: list[str], order: list[str], out: str) -> DataFrame:
    """``rows`` with ``out``, gapless from 0 in each conversation, ordered by
    ``levels``, blocks of turns and ``order``."""
    placed = rows.withColumn("_block", F.floor(F.coalesce("turn", F.lit(0)) / BLOCK))
    cell = ["conv_id", *levels, "_block"]
    counts = placed.groupBy(*cell).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("conv_id").orderBy(*levels, "_block").rowsBetween(Window.unboundedPreceding, -1)
    cells = written(counts.select(*cell, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")), "chat-cells")
    inside = placed.withColumn("_nth", F.row_number().over(Window.partitionBy(*cell).orderBy(*order)) - 1)
    same = inside["conv_id"] == cells["conv_id"]
    for c in cell[1:]:
        same = same & inside[c].eqNullSafe(cells[c])
    return inside.join(cells, same).select(*[inside[c] for c in rows.columns], (F.col("_before") + F.col("_nth")).alias(out))


def linked_calls(messages: DataFrame, schemas: dict = SCHEMAS) -> DataFrame:
    """One row a call of ``keyed`` messages: conv_id, turn, _msg, nth, step,
    depth, call_id, name, status, result_turn and the canonical JSON."""
    parsed = written(parse_calls(messages, schemas), "chat-calls")
    place = ["turn", "nth", "arguments", "name", "_msg"]
    first = parsed.where("call_id is not null").groupBy("conv_id", "call_id").agg(F.min(F.struct(*place)).alias("_f"))
    same = F.col("_f").isNotNull()
    for c in place:
        same = same & F.col(c).eqNullSafe(F.col(f"_f.{c}"))
    calls = written(parsed.join(first, ["conv_id", "call_id"], "left").withColumn("_first", same).drop("_f"), "chat-first")
    unique = calls.where("_first")
    deep = depths(unique.select("conv_id", "call_id", "after"))
    named = unique.select("conv_id", "call_id", F.explode("after").alias("dep"))
    lost = named.join(unique.select("conv_id", F.col("call_id").alias("dep")), ["conv_id", "dep"], "left_anti").select("conv_id", "call_id", F.lit(True).alias("_lost")).distinct()
    linked = (unique.join(parse_results(messages, unique).hint("shuffle_hash"), ["conv_id", "call_id"], "left").join(deep, ["conv_id", "call_id"], "left")
              .join(lost, ["conv_id", "call_id"], "left"))
    rest = calls.where("not _first").withColumns({"result_turn": F.lit(None).cast("long"), "result": F.lit(None).cast("string"),
                                                  "depth": F.lit(None).cast("int"), "_lost": F.lit(None).cast("boolean")})
    every = linked.unionByName(rest)
    status = (F.when(F.col("call_id").isNull(), "malformed").when(~F.col("_first"), "duplicate")
              .when(F.size("errors") > 0, F.array_join("errors", ",")).when(F.col("depth").isNull(), "cyclic")
              .when(F.col("_lost"), "unknown_dependency").when(F.col("result_turn").isNotNull(), "ok").otherwise("no_result"))
    body = F.to_json(F.struct("after", F.parse_json("arguments").alias("arguments"), "depth", F.col("call_id").alias("id"), "name", "result", "result_turn", "status", "turn"),
                     {"ignoreNullFields": "false"})
    judged = every.withColumn("status", status).withColumn("call_json", body).withColumn("_late", F.col("depth").isNull().cast("int"))
    numbered = gapless(judged, ["_late", "depth"], ["turn", "nth", "arguments", "_msg"], "step")
    return numbered.select("conv_id", "turn", "_msg", "nth", "step", "depth", "call_id", "name", "status", "result_turn", "call_json")


def own_conversation(messages: DataFrame) -> Column:
    """conv_id in the type it came in, null again where it was."""
    return F.when(F.col("conv_id") != "", F.col("conv_id").cast(messages.schema["conv_id"].dataType)).alias("conv_id")


def link_calls(messages: DataFrame, schemas: dict = SCHEMAS) -> DataFrame:
    """One row a call: conv_id, turn, step, depth, call_id, name, status,
    result_turn and the canonical JSON."""
    return linked_calls(keyed(messages), schemas).select(
        own_conversation(messages), "turn", "step", "depth", "call_id", "name", "status", "result_turn", "call_json")


def format_messages(messages: DataFrame, schemas: dict = SCHEMAS) -> DataFrame:
    """One row a message: conv_id, turn, role, position, n_calls, n_ok and
    message_json, the canonical JSON of role, text without markup and calls
    (each as in ``link_calls``, in the order of the text)."""
    base = written(keyed(messages), "chat-messages")
    calls = linked_calls(base, schemas)
    lists = calls.groupBy("conv_id", "turn", "_msg").agg(
        F.array_sort(F.collect_list(F.struct("nth", "call_json"))).alias("_calls"), F.count_if(F.col("status") == "ok").alias("_ok"))  # one message's calls
    placed = gapless(base, [], ["turn", "role", "_msg"], "position")
    joined = placed.join(lists.withColumnRenamed("turn", "_turn"), (placed["conv_id"] == lists["conv_id"]) & placed["turn"].eqNullSafe(F.col("_turn")) & (placed["_msg"] == lists["_msg"]), "left").select(
        *[placed[c] for c in placed.columns], "_calls", "_ok")
    content = F.regexp_replace("text", r"(?s)<tool_call>.*?</tool_call>|<tool_result>.*?</tool_result>", "")
    head = F.to_json(F.struct(content.alias("content"), "role", "turn"), {"ignoreNullFields": "false"})
    listed = F.array_join(F.transform(F.coalesce("_calls", F.array().cast(calls_type())), lambda c: c["call_json"]), ",")
    return joined.select(own_conversation(messages), "turn", "role", "position", F.coalesce(F.size("_calls"), F.lit(0)).alias("n_calls"), F.coalesce("_ok", F.lit(0)).alias("n_ok"),
                         F.concat(F.lit('{"calls":['), listed, F.lit("],"), F.substring(head, F.lit(2), F.length(head))).alias("message_json"))


def calls_type() -> str:
    return "array<struct<nth:int,call_json:string>>"


def with_tool_turns(conversations: DataFrame) -> DataFrame:
    """The conversations with tool markup derived from their turns: every
    assistant turn makes a call (tool and arguments follow from its text, some
    of them against the schema), the next user turn carries the result."""
    text = F.coalesce("text", F.lit(""))
    chars = F.length(text).cast("long")
    arguments = (F.when(chars % 3 == 0, F.when(chars % 5 == 0, F.to_json(F.struct(text.alias("query"), F.lit("many").alias("limit"))))
                        .otherwise(F.to_json(F.struct(text.alias("query"), (chars % 7).alias("limit")))))
                 .when(chars % 3 == 1, F.to_json(F.struct(F.lit("all").alias("note"), chars.alias("chars"))))
                 .otherwise(F.to_json(F.struct(F.lit(True).alias("exact"), F.lit(1).alias("pages")))))
    name = F.when(chars % 3 == 0, "search").when(chars % 3 == 1, "measure").otherwise("quote")
    before = F.when(F.floor(F.col("turn") / 2) % 4 != 0, F.array(F.concat(F.lit("c"), (F.col("turn") - 2).cast("string")))).otherwise(F.array().cast("array<string>"))
    call = F.to_json(F.struct(F.concat(F.lit("c"), F.col("turn").cast("string")).alias("id"), name.alias("name"), F.parse_json(arguments).alias("arguments"), before.alias("after")))
    result = F.to_json(F.struct(F.concat(F.lit("c"), (F.col("turn") - 1).cast("string")).alias("id"), text.alias("content")))
    marked = (F.when(F.col("role") == "assistant", F.concat(text, F.lit("<tool_call>"), call, F.lit("</tool_call>")))
              .when((F.col("role") == "user") & (F.col("turn") > 0), F.concat(text, F.lit("<tool_result>"), result, F.lit("</tool_result>"))).otherwise(F.col("text")))
    return conversations.select("conv_id", "turn", "role", marked.alias("text"))


def op2_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message of the conversations, formatted, with its linked calls."""
    return format_messages(with_tool_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


OP2_SQL = """
WITH m AS (SELECT DISTINCT conv_id, turn, role, text, coalesce(text, '') AS t FROM conversations),
calls AS (SELECT *, 'c' || turn AS call_id, length(t) AS n, (turn // 2) % 4 <> 0 AS chained FROM m WHERE role = 'assistant'),
r0 AS (SELECT conv_id, 'c' || (turn - 1) AS call_id, turn AS result_turn, t AS result FROM m WHERE role = 'user' AND turn > 0),
linked AS (
  SELECT c.*, r.result_turn, r.result, p.conv_id IS NOT NULL AS found
  FROM calls c LEFT JOIN r0 r USING (conv_id, call_id)
  LEFT JOIN calls p ON p.conv_id = c.conv_id AND p.turn = c.turn - 2 AND c.chained),
deep AS (
  SELECT l.*, CASE WHEN NOT l.chained OR NOT l.found THEN 0
    WHEN NOT p1.chained OR NOT p1.found THEN 1 WHEN NOT p2.chained OR NOT p2.found THEN 2 ELSE 3 END AS depth
  FROM linked l LEFT JOIN linked p1 ON p1.conv_id = l.conv_id AND p1.turn = l.turn - 2
  LEFT JOIN linked p2 ON p2.conv_id = l.conv_id AND p2.turn = l.turn - 4),
judged AS (
  SELECT *, CASE WHEN n % 3 = 0 THEN 'search' WHEN n % 3 = 1 THEN 'measure' ELSE 'quote' END AS name,
    CASE WHEN n % 3 = 0 AND n % 5 = 0 THEN 'type_limit' WHEN n % 3 = 2 THEN 'missing_query,unknown_pages'
      WHEN chained AND NOT found THEN 'unknown_dependency' WHEN result_turn IS NOT NULL THEN 'ok' ELSE 'no_result' END AS status,
    CASE WHEN n % 3 = 0 AND n % 5 = 0 THEN '{"limit":"many","query":' || to_json(t) || '}'
      WHEN n % 3 = 0 THEN '{"limit":' || (n % 7) || ',"query":' || to_json(t) || '}'
      WHEN n % 3 = 1 THEN '{"chars":' || n || ',"note":"all"}' ELSE '{"exact":true,"pages":1}' END AS arguments
  FROM deep),
formatted AS (
  SELECT conv_id, turn, role, text, status, '{"after":[' || CASE WHEN chained THEN '"c' || (turn - 2) || '"' ELSE '' END || '],"arguments":' || arguments
    || ',"depth":' || depth || ',"id":"' || call_id || '","name":"' || name || '","result":' || coalesce(to_json(result)::VARCHAR, 'null')
    || ',"result_turn":' || coalesce(result_turn::VARCHAR, 'null') || ',"status":"' || status || '","turn":' || turn || '}' AS call_json
  FROM judged)
SELECT m.conv_id, m.turn, m.role, row_number() OVER (PARTITION BY m.conv_id ORDER BY m.turn, m.role) - 1 AS position,
  CASE WHEN f.call_json IS NULL THEN 0 ELSE 1 END AS n_calls, CASE WHEN f.status = 'ok' THEN 1 ELSE 0 END AS n_ok,
  '{"calls":[' || coalesce(f.call_json, '') || '],"content":'
  || CASE WHEN m.text IS NULL AND m.role <> 'assistant' AND NOT (m.role = 'user' AND m.turn > 0) THEN 'null' ELSE to_json(m.t)::VARCHAR END
  || ',"role":' || coalesce(to_json(m.role)::VARCHAR, 'null') || ',"turn":' || m.turn || '}' AS message_json
FROM m LEFT JOIN formatted f ON f.conv_id = m.conv_id AND f.turn = m.turn AND f.role = m.role AND f.text IS NOT DISTINCT FROM m.text
"""
