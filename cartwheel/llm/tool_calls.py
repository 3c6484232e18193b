"""Tool calls of chats linked to their results, ordered, validated and written as canonical JSON (operator 4).

DataFrame functions only.  Calls and results meet in a hash join on (conversation, call id); where one id is used many
times, uses are first folded to the earliest one, and rows of hot ids meet it by a broadcast of the few hot keys.  For
the topological order, chains of calls that need one call each are jumped over by doubling, so a chain of any length takes a
logarithmic number of rounds; calls that need several are placed in rounds, once all of those are placed.  What can't be
placed waits for itself in a circle.  Arguments are parsed to variants, whose types are compared with the schema of the
tool, and written again with sorted keys and without blanks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cartwheel.llm.spread import dropped, join_key, written

#: JSON types as schemas name them, and how the type of a variant shows
KINDS = {"string": "STRING", "integer": "BIGINT", "number": "(BIGINT|DOUBLE|FLOAT|DECIMAL.*)", "boolean": "BOOLEAN",
         "array": "ARRAY.*", "object": "OBJECT.*"}


def canonical(text: Column) -> Column:
    """JSON text with object keys in order and no blanks; null where it does not parse."""
    return F.to_json(F.try_parse_json(text))


def validated(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """The calls with ``problems``: a sorted array, empty for a valid call.

    ``schemas`` has a row per tool parameter (name, param, kind, required); the tools of a chat format are few, and their
    table is folded to one row per tool before it is joined.
    """
    tools = schemas.groupBy("name").agg(F.sort_array(F.collect_list(F.struct("param", "kind", "required"))).alias("params"))
    rows = calls.join(tools, "name", "left").withColumn("given", F.expr(
        "transform_values(try_variant_get(try_parse_json(arguments), '$', 'map<string, variant>'),"
        " (k, v) -> schema_of_variant(v))"))
    patterns = F.create_map(*[F.lit(x) for kind, pattern in KINDS.items() for x in (kind, f"^{pattern}$")])
    checks = F.transform("params", lambda p: F.when(
        ~F.map_contains_key("given", p["param"]), F.when(p["required"], F.concat(F.lit("missing "), p["param"])))
        .when(~F.rlike(F.element_at("given", p["param"]), F.element_at(patterns, p["kind"])),
              F.concat(F.lit("type of "), p["param"])))
    known = F.transform("params", lambda p: p["param"])
    extra = F.transform(F.array_except(F.map_keys("given"), known), lambda k: F.concat(F.lit("unknown "), k))
    problems = (F.when(F.col("params").isNull(), F.array(F.lit("unknown tool")))
                .when(F.col("given").isNull(), F.array(F.lit("arguments are no object")))
                .otherwise(F.array_sort(F.concat(F.filter(checks, lambda c: c.isNotNull()), extra))))
    return rows.withColumn("problems", problems).drop("params", "given")


def ordered(calls: DataFrame) -> DataFrame:
    """The calls with ``step``: 0 without dependencies, else one more than the latest of them; null inside a circle.

    ``needs`` lists call ids of the same conversation.  Ids that no call has are not waited for; they are told in
    ``unknown``.  Every round is a table of short rows in the shared folder, removed once the next one is written.
    """
    spark = calls.sparkSession
    ids = calls.where("key is not null").select("key").distinct()
    asked = calls.select("conv_id", "key", F.explode(F.array_distinct("needs")).alias("call_id"))
    asked = asked.select("key", F.col("call_id").alias("id"), _key().alias("need")).where("need is not null")
    asked = asked.join(ids.select(F.col("key").alias("need"), F.lit(True).alias("known")), "need", "left")
    asked = written(spark, asked.distinct(), "needs")
    unknown = asked.where("known is null").groupBy("key").agg(F.array_sort(F.collect_list("id")).alias("unknown"))
    edges = asked.where("known").select("key", "need")
    counts = edges.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("need").alias("only"))
    jumps = _jumped(spark, counts.where("n = 1").select("key", F.col("only").alias("to")))
    # anchors need no call or several; each call that one needs stands some steps above an anchor, or in a circle
    heads = ids.join(edges.select("key").distinct(), "key", "left_anti").select("key", F.lit(0).alias("step"))
    several = edges.join(counts.where("n > 1").select("key"), "key", "left_semi")
    above = several.join(jumps.select(F.col("key").alias("need"), "to", "far", "done"), "need", "left").select(
        "key", F.coalesce("to", "need").alias("to"), F.coalesce("far", F.lit(0)).alias("far"),
        F.coalesce("done", F.lit(True)).alias("done"))
    waiting = written(spark, above.withColumn("met", F.lit(None).cast("int")), "waiting")
    parts = [written(spark, heads, "placed")]
    while not waiting.isEmpty():
        reached = waiting.join(parts[-1].select(F.col("key").alias("to"), "step"), "to", "left").select(
            "key", "to", "far", "done", F.coalesce("met", F.when(F.col("done"), F.col("step") + F.col("far"))).alias("met"))
        before, waiting = waiting, written(spark, reached, "waiting")
        ready = waiting.groupBy("key").agg(F.max("met").alias("most"), F.count_if(F.col("met").isNull()).alias("open"))
        placed = written(spark, ready.where("open = 0").select("key", (F.col("most") + 1).alias("step")), "placed")
        dropped(spark, before)
        if placed.isEmpty():
            break
        parts.append(placed)
        before, waiting = waiting, written(spark, waiting.join(placed.select("key"), "key", "left_anti"), "waiting")
        dropped(spark, before)
    anchors = reduce(DataFrame.unionByName, parts)
    chained = jumps.where("done").join(anchors.select(F.col("key").alias("to"), "step"), "to").select(
        "key", (F.col("step") + F.col("far")).alias("step"))
    return calls.join(anchors.unionByName(chained), "key", "left").join(unknown, "key", "left")


def _jumped(spark: SparkSession, single: DataFrame) -> DataFrame:
    """(key, to, far, done) for calls that need one call each: the first call up the chain that is not such a call, and how
    far it is; not done are those whose chain never ends."""
    names = written(spark, single, "single")
    jumps = written(spark, names.join(names.select(F.col("key").alias("to"), F.lit(False).alias("ends")), "to", "left").select(
        "key", "to", F.lit(1).alias("far"), F.coalesce("ends", F.lit(True)).alias("done")), "jumps")
    dropped(spark, names)
    # after r rounds a jump is done or spans 2^r calls: once that is more than there are, it runs in a circle
    calls, span = jumps.count(), 1
    while span <= calls and not jumps.where(~F.col("done")).isEmpty():
        longer = jumps.where(~F.col("done")).select("key", "to", "far").join(
            jumps.select(F.col("key").alias("to"), F.col("to").alias("on"), F.col("far").alias("more"), "done"), "to").select(
            "key", F.col("on").alias("to"), (F.col("far") + F.col("more")).alias("far"), "done")
        before, jumps = jumps, written(spark, jumps.where("done").unionByName(longer), "jumps")
        dropped(spark, before)
        span *= 2
    return jumps


def link(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per call and per result without a call of its own.

    ``calls``: conv_id, turn, call_id, name, arguments (JSON text), needs (array of call ids).  ``results``: conv_id, turn,
    call_id, content.  Columns out: conv_id, turn, call_id, name, step, status, problems, json.  Only these columns are
    read.  Within a conversation (step, turn, call_id) is a topological order; results follow their call inside its row.

    Status: ``ok``, ``invalid`` (problems with the arguments), ``circular``, ``unanswered``; ``repeated`` for all but the
    first use of an id by a call (the first by turn, then by arguments), ``orphan`` for a result without a call or after
    the first one for a call.  Null ids, names and arguments: a call without an id links with nothing, one without a name is
    of an unknown tool, missing arguments are no object.  Fully equal rows count once.  Empty tables give no rows.
    """
    spark = calls.sparkSession
    calls = calls.select("conv_id", F.col("turn").cast("long").alias("turn"), "call_id", "name", "arguments", "needs").distinct()
    results = results.select("conv_id", F.col("turn").cast("long").alias("turn"), "call_id", "content").distinct()
    calls = written(spark, calls.withColumn("key", _key()).withColumn("order", _order("name", "arguments", "needs")), "calls")
    results = written(spark, results.withColumn("key", _key()).withColumn("order", _order("content")), "results")
    first_call, first_result = (written(spark, t.where("key is not null").groupBy("key").agg(
        F.min("order").alias("first"), F.count(F.lit(1)).alias("copies")), "first") for t in (calls, results))
    chosen, again = _split(calls, first_call)
    answer, late = _split(results, first_result)
    chosen = written(spark, validated(ordered(chosen), schemas), "checked")
    answer, again, late = (written(spark, t, name) for t, name in ((answer, "answers"), (again, "again"), (late, "late")))
    dropped(spark, calls, results, first_call, first_result)
    both = chosen.join(answer.select("key", F.col("content").alias("result"), F.lit(True).alias("answered")).hint(
        "shuffle_hash"), "key", "left")
    status = (F.when(F.col("step").isNull() & F.col("call_id").isNotNull(), "circular")
              .when(F.size("problems") > 0, "invalid").when(F.col("answered").isNull(), "unanswered").otherwise("ok"))
    linked = both.withColumn("status", status)
    none = F.array().cast("array<string>")
    more = again.select("*", F.lit(None).cast("int").alias("step"), none.alias("unknown"), none.alias("problems"),
                        F.lit(None).cast("string").alias("result"), F.lit("repeated").alias("status"))
    alone = answer.join(chosen.select("key"), "key", "left_anti")
    orphans = late.unionByName(alone.select(late.columns)).select(
        "conv_id", "turn", "call_id", F.lit(None).cast("string").alias("name"),
        F.lit(None).cast("string").alias("arguments"), F.lit(None).cast("int").alias("step"), none.alias("unknown"),
        none.alias("problems"), F.col("content").alias("result"), F.lit("orphan").alias("status"))
    names = orphans.columns
    every = linked.select(names).unionByName(more.select(names)).unionByName(orphans)
    return every.select("conv_id", "turn", "call_id", "name", "step", "status", "problems", _json().alias("json"))


def _key() -> Column:
    return F.when(F.col("call_id").isNotNull(), F.to_json(F.struct("conv_id", "call_id")))


def _order(*more: str) -> Column:
    """A number of fixed width that sorts by turn (null last), then by 60 bits of a hash of the rest of the row.

    Two different uses of one id in one turn that share those bits would both count as the first one; among a million such
    uses the chance is below 10^-6.
    """
    turn = F.coalesce("turn", F.lit((1 << 63) - 1)).cast("decimal(19,0)")
    rest = F.shiftrightunsigned(F.xxhash64(F.to_json(F.struct(*more))), 4).cast("decimal(19,0)")
    return (turn * F.lit(1 << 60).cast("decimal(19,0)") + rest).cast("decimal(38,0)")


def _split(rows: DataFrame, first: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The first row of every key (and rows without one), and the others."""
    known = join_key(rows.where("key is not null"), first, "key", "copies")
    lead = known.where("order = first").drop("first", "copies").unionByName(rows.where("key is null"))
    return lead, known.where("order != first").drop("first", "copies")


def _json() -> Column:
    """Keys in order, absent parts left out, arguments canonical where they parse and a text where they don't."""
    def part(name: str, value: Column) -> Column:
        return F.when(value.isNotNull(), F.concat(F.lit(f'"{name}":'), value))
    def quoted(name: str) -> Column:
        listed = F.to_json(F.array(F.col(name)))
        return F.when(F.col(name).isNotNull(), listed.substr(F.lit(2), F.length(listed) - 2))
    body = F.concat_ws(",", part("arguments", F.coalesce(canonical(F.col("arguments")), quoted("arguments"))),
                       part("id", quoted("call_id")), part("name", quoted("name")), part("result", quoted("result")),
                       part("status", quoted("status")), part("step", F.col("step").cast("string")))
    return F.concat(F.lit("{"), body, F.lit("}"))
