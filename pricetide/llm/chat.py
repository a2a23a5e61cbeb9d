"""Operator 6: linking tool calls to their results (native).

Calls and results are joined by (conversation, call id).  Calls that use others come
after them: a call's depth is 0 without known dependencies, else one more than that of
its deepest one.  Chains of calls with one dependency each are shortened by pointer
jumping, in as many rounds as the logarithm of their length; rounds of joins over the
calls with several dependencies work out the rest.  What is left goes round in a circle.
A call's place counts the calls of its conversation by (depth, turn, id).  Arguments are
checked against the tool's schema (known tool, JSON object, required parameters, types,
no unknown parameters), and each call is written as canonical JSON: sorted keys, no
white space, arguments as in the Variant type, whose objects are sorted by key.

Status, the first that holds: duplicate (an earlier turn has the id), unknown_tool,
invalid, cycle, missing_dependency, no_result, ok; a result without a call is a row of
its own, orphan_result.  Several results of a call: the earliest turn, then the smallest
text.

Only Spark expressions run here, and no conversation is gathered into one row.  Null
arguments are no JSON object; null ids link to nothing; a null turn comes first.  Rows
that repeat are duplicates of each other and one is kept as the call.  An empty table
gives no rows.  Extra columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricetide.llm.common import written

#: parameters of each tool: name -> (type, required); types: string, integer, number, boolean
Schemas = dict[str, dict[str, tuple[str, bool]]]
SCHEMAS: Schemas = {
    "search": {"query": ("string", True), "limit": ("integer", True), "after": ("string", False)},
    "lookup": {"key": ("string", True), "exact": ("boolean", True), "after": ("string", False)},
    "calculate": {"expression": ("string", True), "precision": ("number", False), "after": ("string", False)},
}
_TYPES = {"string": ["STRING"], "integer": ["BIGINT"], "number": ["BIGINT", "DOUBLE", "DECIMAL"], "boolean": ["BOOLEAN"]}
SEGMENT = 1024                   # turns that are ranked together
DEPTHS = 1024                    # depths whose numbers are added up together


def argument_errors(name: Column, arguments: Column, schemas: Schemas) -> Column:
    """What is wrong with the arguments of a call, as an array of texts."""
    value = F.try_parse_json(arguments)
    keys = F.json_object_keys(arguments)
    is_object = F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))
    out = F.array(F.lit("unknown_tool"))
    for tool, params in schemas.items():
        wrong = []
        for p, (kind, required) in params.items():
            there = F.array_contains(keys, p)
            got = F.regexp_extract(F.schema_of_variant(F.try_variant_get(value, f"$.{p}", "variant")), "^[A-Z]+", 0)
            wrong.append(F.when(there & ~F.coalesce(got.isin(_TYPES[kind]), F.lit(False)), f"type:{p}"))
            if required:
                wrong.append(F.when(~there, f"missing:{p}"))
        unknown = F.transform(F.array_sort(F.array_except(keys, F.array(*map(F.lit, params)))), lambda k: F.concat(F.lit("unknown:"), k))
        errors = F.when(is_object, F.concat(F.array_compact(F.array(*wrong)), unknown)).otherwise(F.array(F.lit("not_an_object")))
        out = F.when(name == tool, errors).otherwise(out)
    return out


def depths(calls: DataFrame) -> DataFrame:
    """conv_id, call_id, depth (null: in a circle or behind one) of unique calls
    (conv_id, call_id, depends_on)."""
    key = ["conv_id", "call_id"]
    ids = calls.select(*key)
    need = calls.select(*key, F.explode(F.array_distinct("depends_on")).alias("on"))
    known = written(need.join(ids.select("conv_id", F.col("call_id").alias("on")), ["conv_id", "on"]).select(*key, "on"), "needs")
    number = known.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    roots = ids.join(number, key, "left_anti")
    several = written(known.join(number.where("n > 1"), key, "left_semi"), "several")

    # calls with one dependency: the call that their chain begins behind, and how far it is
    chain = written(known.join(number.where("n = 1"), key, "left_semi").select(*key, "on", F.lit(1).cast("long").alias("far")), "chain")
    rounds = chain.count().bit_length()                     # a chain is no longer than that doubles
    for _ in range(rounds):
        on = chain.select("conv_id", F.col("call_id").alias("on"), F.col("on").alias("next"), F.col("far").alias("more"))
        step = written(chain.join(on, ["conv_id", "on"], "left")
                       .select(*key, F.coalesce("next", "on").alias("on"), (F.col("far") + F.coalesce("more", F.lit(0))).alias("far"), F.col("next").isNotNull().alias("went")), "chain")
        chain = step.drop("went")
        if step.where("went").isEmpty():
            break
    # what still points into a chain goes round in a circle
    chain = chain.join(chain.select("conv_id", F.col("call_id").alias("on")), ["conv_id", "on"], "left_anti")

    done = written(roots.select(*key, F.lit(0).cast("long").alias("depth")), "depth")
    if not several.isEmpty():
        first = chain.select("conv_id", F.col("call_id").alias("on"), F.col("on").alias("start"), "far")
        # dependencies as the calls that their chains begin behind; one in a circle is never solved
        open_ = written(several.join(first, ["conv_id", "on"], "left")
                        .select(*key, F.coalesce("start", "on").alias("on"), (F.coalesce("far", F.lit(0)) + 1).alias("far"), F.lit(0).cast("long").alias("depth")), "open")
        last = done
        while True:
            solved = last.select("conv_id", F.col("call_id").alias("on"), F.col("depth").alias("base"))
            tried = written(open_.join(solved, ["conv_id", "on"], "left"), "tried")
            upto = tried.groupBy(*key).agg(F.max(F.coalesce(F.col("base") + F.col("far"), F.lit(0))).alias("reached"), F.max("depth").alias("depth"),
                                           F.count_if(F.col("base").isNull()).alias("left"))
            upto = written(upto.select(*key, F.greatest("reached", "depth").alias("depth"), "left"), "upto")
            last = written(upto.where("left = 0").select(*key, "depth"), "depth")
            if last.isEmpty():
                break
            done = written(done.unionByName(last), "depth")
            open_ = written(tried.where("base IS NULL").drop("base", "depth").join(upto.select(*key, "depth"), key), "open")
    behind = (chain.join(done.select("conv_id", F.col("call_id").alias("on"), "depth"), ["conv_id", "on"])
              .select(*key, (F.col("depth") + F.col("far")).alias("depth")))
    solved = done.unionByName(behind)
    lost = ids.join(solved, key, "left_anti").select(*key, F.lit(None).cast("long").alias("depth"))
    return solved.unionByName(lost).withColumn("depth", F.col("depth").cast("int"))


def link(calls: DataFrame, results: DataFrame, schemas: Schemas | None = None) -> DataFrame:
    """conv_id, call_id, turn, name, depth, place, status, errors and json: a row per call
    (conv_id, call_id, turn, name, arguments, depends_on) and per orphaned result
    (conv_id, call_id, turn, content)."""
    schemas = SCHEMAS if schemas is None else schemas
    calls = calls.select("conv_id", F.col("call_id").cast("string"), F.col("turn").cast("long"), F.col("name").cast("string"), F.col("arguments").cast("string"),
                         F.coalesce("depends_on", F.array().cast("array<string>")).alias("depends_on"))
    calls = written(calls.withColumn("uid", F.monotonically_increasing_id()), "calls")
    key = ["conv_id", "call_id"]
    first = calls.where("call_id IS NOT NULL AND conv_id IS NOT NULL").groupBy(*key).agg(F.min(F.struct("turn", "uid"))["uid"].alias("uid"))
    unique = calls.join(first.select("uid"), "uid", "left_semi")
    depth = depths(unique.select(*key, "depends_on"))
    answer = results.select("conv_id", F.col("call_id").cast("string"), F.col("turn").cast("long").alias("turn"), F.col("content").cast("string").alias("content"))
    kept = answer.groupBy(*key).agg(F.min(F.struct("turn", "content")).alias("r")).select(*key, F.col("r.content").alias("result"), F.col("r.turn").alias("r_turn"))
    missing = (unique.select(*key, F.explode("depends_on").alias("on"))
               .join(unique.select("conv_id", F.col("call_id").alias("on")), ["conv_id", "on"], "left_anti").select(*key).distinct().withColumn("lost", F.lit(True)))
    linked = unique.join(depth, key, "left").join(kept, key, "left").join(missing, key, "left")
    errors = argument_errors(F.col("name"), F.col("arguments"), schemas)
    status = (F.when(F.array_contains("errors", "unknown_tool"), "unknown_tool").when(F.size("errors") > 0, "invalid").when(F.col("depth").isNull(), "cycle")
              .when(F.col("lost"), "missing_dependency").when(F.col("r_turn").isNull() & F.col("result").isNull(), "no_result").otherwise("ok"))
    linked = linked.withColumn("errors", errors).withColumn("status", status)
    other = (calls.join(first.select("uid"), "uid", "left_anti").withColumn("depth", F.lit(None).cast("int")).withColumn("errors", F.array().cast("array<string>"))
             .withColumn("status", F.lit("duplicate")).withColumn("result", F.lit(None).cast("string")))
    orphan = (kept.join(unique.select(*key), key, "left_anti")
              .select(*key, F.col("r_turn").alias("turn"), F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("arguments"),
                      F.array().cast("array<string>").alias("depends_on"), F.lit(None).cast("int").alias("depth"), F.array().cast("array<string>").alias("errors"),
                      F.lit("orphan_result").alias("status"), "result"))
    cols = ["conv_id", "call_id", "turn", "name", "arguments", "depends_on", "depth", "errors", "status", "result"]
    rows = linked.select(*cols).unionByName(other.select(*cols)).unionByName(orphan.select(*cols))
    record = F.to_json(F.struct(F.try_parse_json("arguments").alias("arguments"), F.array_sort("depends_on").alias("depends_on"), F.col("call_id").alias("id"),
                                "name", "result", "status"), {"ignoreNullFields": "false"})
    return _placed(rows.select("conv_id", "call_id", "turn", "name", "depth", "status", F.array_join("errors", ",").alias("errors"), record.alias("json")))


def counts_before(sizes: DataFrame) -> DataFrame:
    """c, d2, s2 (conversation, depth and segment) and n_before, the rows in front of each,
    from n rows per conv_id, d and segment. Segments are added up within their depth, depths
    within blocks of DEPTHS, and blocks: a chain with one call per depth is no single window."""
    def in_front(by: list[str], order: str) -> Column:
        return F.coalesce(F.sum("n").over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    depths_n = sizes.groupBy("conv_id", "d", F.floor(F.col("d") / DEPTHS).alias("block")).agg(F.sum("n").alias("n"))
    blocks = (depths_n.groupBy("conv_id", "block").agg(F.sum("n").alias("n"))
              .select(F.col("conv_id").alias("c3"), F.col("block").alias("b3"), in_front(["conv_id"], "block").alias("of_blocks")))
    upto = (depths_n.select("conv_id", "d", "block", in_front(["conv_id", "block"], "d").alias("of_depths"))
            .join(blocks, F.col("conv_id").eqNullSafe(F.col("c3")) & (F.col("block") == F.col("b3")))
            .select(F.col("conv_id").alias("c4"), F.col("d").alias("d4"), (F.col("of_depths") + F.col("of_blocks")).alias("of_both")))
    return (sizes.select("conv_id", "d", "segment", in_front(["conv_id", "d"], "segment").alias("of_segments"))
            .join(upto, F.col("conv_id").eqNullSafe(F.col("c4")) & (F.col("d") == F.col("d4")))
            .select(F.col("conv_id").alias("c"), F.col("d").alias("d2"), F.col("segment").alias("s2"), (F.col("of_segments") + F.col("of_both")).alias("n_before")))


def _placed(rows: DataFrame) -> DataFrame:
    """Adds place. Rows are ranked within segments of SEGMENT turns, and segments counted
    before: a conversation of any length is spread over tasks."""
    part = ["conv_id", F.coalesce("depth", F.lit(1 << 30)).alias("d"), F.floor(F.coalesce("turn", F.lit(-1)) / SEGMENT).alias("segment")]
    rows = rows.select("*", part[1], part[2])
    sizes = counts_before(rows.groupBy("conv_id", "d", "segment").agg(F.count(F.lit(1)).alias("n")))
    within = Window.partitionBy("conv_id", "d", "segment").orderBy("turn", "call_id", "status", "json")
    return (rows.withColumn("k", F.row_number().over(within))
            .join(sizes, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("d") == F.col("d2")) & (F.col("segment") == F.col("s2")))
            .select("conv_id", "call_id", "turn", "name", "depth", (F.col("n_before") + F.col("k")).cast("long").alias("place"), "status", "errors", "json"))


def conversation_calls(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results that the turns of conversations stand for: a user turn calls a
    tool with its text, the next turn's text by the assistant is the result, and a user's
    turn two places on uses that call.  Tools and argument forms follow the conversation's
    number and the text's length, so that all kinds of arguments occur."""
    t = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", F.coalesce("text", F.lit("")).alias("text"))
    call_id = lambda back: F.concat(F.col("conv_id").cast("string"), F.lit("-"), (F.col("turn") - back).cast("string"))
    n = F.length("text")
    asks = t.where("role = 'user'").withColumn("after", F.when(F.col("turn") >= 2, call_id(2)))
    limit = F.when(n % 7 == 0, F.to_json(F.struct(F.col("text").alias("query"), F.lit("many").alias("limit"), "after"))).otherwise(
        F.to_json(F.struct(F.col("text").alias("query"), (n % 10).alias("limit"), "after")))
    exact = F.when(n % 11 == 0, F.to_json(F.struct((n % 2 == 0).alias("exact"), "after"))).otherwise(
        F.to_json(F.struct(F.split("text", " ")[0].alias("key"), (n % 2 == 0).alias("exact"), "after")))
    number = F.when(n % 13 == 0, F.to_json(F.struct("text", F.col("text").alias("expression"), "after"))).otherwise(
        F.to_json(F.struct(F.col("text").alias("expression"), (n % 5).alias("precision"), "after")))
    kind = F.pmod(F.col("conv_id") + F.col("turn"), F.lit(4))
    calls = asks.select("conv_id", call_id(0).alias("call_id"), "turn",
                        F.when(kind == 0, "search").when(kind == 1, "lookup").when(kind == 2, "calculate").otherwise(F.when(n % 17 == 0, "translate").otherwise("search")).alias("name"),
                        F.when(kind == 1, exact).when(kind == 2, number).otherwise(limit).alias("arguments"),
                        F.when(F.col("after").isNotNull(), F.array("after")).alias("depends_on"))
    results = t.where("role = 'assistant'").select("conv_id", call_id(1).alias("call_id"), "turn", F.col("text").alias("content"))
    return calls, results


def link_conversations(turns: DataFrame) -> DataFrame:
    return link(*conversation_calls(turns))


def oracle(conversations: str = "conversations") -> str:
    """The same in DuckDB SQL (calls of these conversations have one dependency at most)."""
    return f"""
WITH RECURSIVE t AS (SELECT conv_id, turn, role, coalesce(text, '') AS text, length(coalesce(text, '')) AS n FROM {conversations}),
asks AS (
  SELECT *, conv_id || '-' || turn AS call_id, CASE WHEN turn >= 2 THEN conv_id || '-' || (turn - 2) END AS after, (conv_id + turn) % 4 AS kind
  FROM t WHERE role = 'user'),
calls AS (
  SELECT conv_id, turn, call_id, after,
         CASE WHEN kind = 0 THEN 'search' WHEN kind = 1 THEN 'lookup' WHEN kind = 2 THEN 'calculate' WHEN n % 17 = 0 THEN 'translate' ELSE 'search' END AS name,
         CASE WHEN kind = 1 THEN
                CASE WHEN n % 11 = 0 THEN json_object('after', after, 'exact', n % 2 = 0) ELSE json_object('after', after, 'exact', n % 2 = 0, 'key', string_split(text, ' ')[1]) END
              WHEN kind = 2 THEN
                CASE WHEN n % 13 = 0 THEN json_object('after', after, 'expression', text, 'text', text) ELSE json_object('after', after, 'expression', text, 'precision', n % 5) END
              WHEN n % 7 = 0 THEN json_object('after', after, 'limit', 'many', 'query', text)
              ELSE json_object('after', after, 'limit', n % 10, 'query', text) END AS raw,
         CASE WHEN kind = 1 THEN CASE WHEN n % 11 = 0 THEN 'missing:key' ELSE '' END
              WHEN kind = 2 THEN CASE WHEN n % 13 = 0 THEN 'unknown:text' ELSE '' END
              WHEN kind = 3 AND n % 17 = 0 THEN 'unknown_tool'
              WHEN n % 7 = 0 THEN 'type:limit' ELSE '' END AS errors
  FROM asks),
clean AS (SELECT * EXCLUDE (raw), CASE WHEN after IS NULL THEN replace(CAST(raw AS VARCHAR), '"after":null,', '') ELSE CAST(raw AS VARCHAR) END AS arguments FROM calls),
chain AS (
  SELECT c.conv_id, c.call_id, 0 AS depth FROM clean c LEFT JOIN clean p ON p.conv_id = c.conv_id AND p.call_id = c.after WHERE p.call_id IS NULL
  UNION ALL
  SELECT c.conv_id, c.call_id, chain.depth + 1 FROM clean c JOIN chain ON chain.conv_id = c.conv_id AND chain.call_id = c.after),
results AS (SELECT conv_id, turn, conv_id || '-' || (turn - 1) AS call_id, text AS result FROM t WHERE role = 'assistant'),
linked AS (
  SELECT c.conv_id, c.call_id, c.turn, c.name, d.depth, c.errors, c.after, c.arguments, r.result,
         CASE WHEN c.errors = 'unknown_tool' THEN 'unknown_tool' WHEN c.errors <> '' THEN 'invalid'
              WHEN c.after IS NOT NULL AND p.call_id IS NULL THEN 'missing_dependency' WHEN r.call_id IS NULL THEN 'no_result' ELSE 'ok' END AS status
  FROM clean c JOIN chain d ON d.conv_id = c.conv_id AND d.call_id = c.call_id
  LEFT JOIN clean p ON p.conv_id = c.conv_id AND p.call_id = c.after
  LEFT JOIN results r ON r.conv_id = c.conv_id AND r.call_id = c.call_id
  UNION ALL
  SELECT r.conv_id, r.call_id, r.turn, NULL, NULL, '', NULL, NULL, r.result, 'orphan_result'
  FROM results r LEFT JOIN clean c ON r.conv_id = c.conv_id AND r.call_id = c.call_id WHERE c.call_id IS NULL)
SELECT conv_id, call_id, turn, name, depth,
       row_number() OVER (PARTITION BY conv_id ORDER BY depth NULLS LAST, turn, call_id) AS place, status, errors,
       '{{"arguments":' || coalesce(arguments, 'null') || ',"depends_on":' || CASE WHEN after IS NULL THEN '[]' ELSE '["' || after || '"]' END
       || ',"id":"' || call_id || '","name":' || coalesce('"' || name || '"', 'null') || ',"result":' || coalesce(CAST(to_json(result) AS VARCHAR), 'null')
       || ',"status":"' || status || '"}}' AS json
FROM linked
"""
