"""Which questions an answer cache would have served, as pointers that are doubled.

An answer is kept for a fixed time from the moment it was stored, and a hit does not prolong it.  So whether a question
is answered anew depends on the last one that was, a chain along time.  Each moment of a text points to the first one
after its own answer would have expired; the answered moments are those that the pointers reach from a sure start, which
is a moment with no other of its text in the time before.  Pointers that are joined with themselves jump 1, 2, 4, ...
steps, so the rounds grow with the logarithm of the longest chain, and a log without chains needs none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from cartwheel import schemas as S
from cartwheel.functions.skew import previous_value
from cartwheel.session import written


def _first_after(moments: DataFrame, seconds: int) -> DataFrame:
    """(Node, Next, NextSure): the first moment of the text that is at least ``seconds`` later, for those that have one.

    A text is cut into stretches of that length.  What a moment looks for lies in the stretch after its own or is the
    head of a later one, so a task sorts at most two rows for each second of a stretch.
    """
    part = F.floor(F.col("Second") / seconds)
    looked = F.struct("Node", "Sure")
    found = moments.select("Key", part.alias("Part"), F.col("Second").alias("At"), looked.alias("Found"),
                           F.lit(None).cast("long").alias("For"))
    probes = moments.select("Key", (part + 1).alias("Part"), (F.col("Second") + seconds).alias("At"),
                            F.lit(None).cast(found.schema["Found"].dataType).alias("Found"), F.col("Node").alias("For"))
    both = found.unionByName(probes)
    # from the end backwards, so that both frames grow; a moment counts for a probe of its own second
    here = F.last("Found", ignorenulls=True).over(
        Window.partitionBy("Key", "Part").orderBy(F.desc("At"), F.col("For").isNotNull())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    heads = (both.groupBy("Key", "Part").agg(F.min_by("Found", F.when(F.col("For").isNull(), F.col("At"))).alias("_head"))
             .withColumn("_later", F.last("_head", ignorenulls=True).over(
                 Window.partitionBy("Key").orderBy(F.desc("Part")).rowsBetween(Window.unboundedPreceding, -1)))
             .select("Key", "Part", "_later"))
    answers = (both.withColumn("_here", here).where("For is not null").join(heads, ["Key", "Part"])
               .select(F.col("For").alias("Node"), F.coalesce("_here", "_later").alias("_next")))
    return answers.where("_next is not null").select("Node", F.col("_next.Node").alias("Next"),
                                                     F.col("_next.Sure").alias("NextSure"))


def cache_hits(log: DataFrame, seconds: int = S.ANSWER_TTL_SECONDS) -> DataFrame:
    """Per question that is no error: its text in normal form, and whether the cache would have answered it.

    Times count in whole seconds: all askings of a text in one second fold to one moment before the shuffle, and the
    one with the smallest id is the one that may be answered.  A null text is a text like others; an asking without a
    time is a hit.  Every round is a table of (id, id) in the shared work folder.
    """
    spark = log.sparkSession
    question = F.lower(F.trim("Question"))
    asked = log.where("Status <> 'Error'").select(
        "AskId", question.alias("QuestionKey"), F.unix_seconds(F.col("AskedAt").cast("timestamp")).alias("Second"))
    moments = (asked.where("Second is not null")
               .groupBy(F.coalesce(F.concat(F.lit("="), "QuestionKey"), F.lit("")).alias("Key"), "Second")
               .agg(F.min("AskId").alias("Node")))
    seen = previous_value(moments, ["Key"], ["Second"], F.floor(F.col("Second") / seconds), "Second", "_before")
    sure = F.coalesce(F.col("Second") - F.col("_before") >= seconds, F.lit(True))
    known = written(spark, seen.withColumn("Sure", sure).drop("_before"), "cache-moments")
    answered = known.where("Sure").select("Node")
    jumps = written(spark, _first_after(known, seconds).where("not NextSure").select("Node", "Next"), "cache-jumps")
    while not jumps.isEmpty():
        reached = answered.join(jumps, "Node").select(F.col("Next").alias("Node"))
        answered = written(spark, answered.unionByName(reached), "cache-answered")
        further = jumps.select(F.col("Node").alias("Next"), F.col("Next").alias("_far"))
        jumps = written(spark, jumps.join(further, "Next").select("Node", F.col("_far").alias("Next")), "cache-jumps")
    stored = answered.select(F.col("Node").alias("AskId"), F.lit(True).alias("_stored"))
    return (asked.join(stored, "AskId", "left")
            .select("AskId", "QuestionKey", F.col("_stored").isNull().alias("CacheHit")))
