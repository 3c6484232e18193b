"""Exact duplicates through an extendible-hash index on shared files (operator 7); DataFrame functions only.

The index has entries (bucket, key, chain, sha, keep_id, copies) for every key that more than one row has; the key is a
64-bit hash of the text.  A row whose key no other row has is equal to none, and its text is never moved.

* Keys are counted first, combined before their shuffle.  The directory maps the leading bits of a key to a bucket.  It
  starts with one bucket and doubles: every bucket that holds more than ``capacity`` keys is split on its next bit, until
  none is overfull.  Only counts are moved for that.
* Texts of repeated keys are routed to the owners of their buckets and compared byte by byte with the head of the key's
  chain, its least text.  Those that are equal form the entry; texts that collide go on to the next link of the chain, whose
  head is the least text left, until none is left.  Rows of a hot key don't move: its head is broadcast to them (at most
  1 / HOT_SHARE heads, by their counts), and their entry is combined before its shuffle.
* A map of fixed size tells which rows may have a repeated key; the join after it is exact.
* Entries are dealt to files by ranges of buckets and keys below ``spark.checkpoint.dir``.  Each row then looks its key up
  and takes the entry of its chain with the same SHA-256.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cartwheel.llm.spread import dropped, join_key, written

CAPACITY = 100_000
#: bits by which the directory is deepened at once while it doubles
STEP = 6
DEEPEST = 60
#: places of the map of repeated keys: 64 of them in each of at most 2^18 rows of it
PLACES = 1 << 24
#: copies of one row that are dealt out again at a time
AT_ONCE = 1000


def _slot(depth: int) -> Column:
    """The leading ``depth`` bits of the key."""
    return F.shiftrightunsigned("key", 64 - depth) if depth else F.lit(0).cast("long")


def directory(entries: DataFrame, capacity: int = CAPACITY) -> tuple[DataFrame, int]:
    """(slot, bucket, depth) for every used slot, and the directory's global depth.

    ``entries`` holds one row per ``key``.  A bucket is named by its depth and leading bits.  Equal keys cannot be split;
    their bucket stays overfull.
    """
    top = STEP
    while True:
        leaves = entries.groupBy(_slot(top).alias("slot")).agg(F.count(F.lit(1)).alias("n"))
        if top >= DEEPEST or leaves.where(F.col("n") > capacity).isEmpty():
            break
        top += STEP
    leaves = written(entries.sparkSession, leaves, "leaves")
    # every leaf counts in the bucket of each depth above it; it belongs to the shallowest one that is not overfull
    above = leaves.withColumn("depth", F.explode(F.sequence(F.lit(0), F.lit(top))))
    above = above.withColumn("bits", F.expr(f"shiftrightunsigned(slot, {top} - depth)"))
    full = above.groupBy("depth", "bits").agg(F.sum("n").alias("held"))
    fits = above.join(full, ["depth", "bits"]).where((F.col("held") <= capacity) | (F.col("depth") == top))
    local = fits.groupBy("slot").agg(F.min("depth").alias("depth"))
    bucket = F.expr(f"shiftleft(shiftrightunsigned(slot, {top} - depth), {top} - depth)")
    return local.select("slot", bucket.alias("bucket"), "depth"), top


def _repeated(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows whose key may be among the keys, by a broadcast map of at most PLACES / 64 numbers."""
    place = F.pmod(F.col("key"), F.lit(PLACES))
    word, bit = F.shiftrightunsigned(place, 6), (place % 64).cast("int")
    held = keys.groupBy(word.alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("bits"))
    near = rows.withColumn("word", word).join(F.broadcast(held), "word")
    return near.where(F.call_function("getbit", F.col("bits"), bit) == 1).drop("word", "bits")


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max",
                normalise: Callable[[Column], Column] | None = None, capacity: int = CAPACITY,
                hashed: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """The index, read again from its files: bucket, key, chain, sha, keep_id, copies."""
    spark = docs.sparkSession
    pick = F.max if keep == "max" else F.min
    rows = docs.select(F.col(id_col).alias("id"), _text(text_col, normalise).alias("text"))
    rows = rows.withColumn("key", hashed(F.col("text")))
    keys = written(spark, rows.groupBy("key").agg(F.count(F.lit(1)).alias("copies")), "keys")
    slots, depth = directory(keys, capacity)
    # the directory as a table: a row for each used slot, far fewer than keys
    slots = written(spark, slots.drop("depth"), "directory")
    open_ = _repeated(rows, keys.where("copies > 1")).withColumn("slot", _slot(depth)).join(slots, "slot").drop("slot")
    links, chain, parts = [], 0, []
    while True:
        chain += 1
        heads = written(spark, open_.groupBy("bucket", "key").agg(F.min("text").alias("head"), F.count(F.lit(1)).alias("copies"))
                        .where("copies > 1 or " + ("true" if chain > 1 else "false")).drop("bucket"), "heads")
        met = join_key(open_, heads, "key", "copies")
        same = F.col("text") == F.col("head")
        met = met.select("bucket", "key", "id", F.when(~same, F.col("text")).alias("text"),
                         F.when(same, F.sha2("head", 256)).alias("sha"))
        # a text is written only where it collides
        met = written(spark, met, "met")
        parts += [heads, met]
        links.append(met.where("text is null").groupBy("bucket", "key").agg(
            F.min("sha").alias("sha"), pick("id").alias("keep_id"), F.count(F.lit(1)).alias("copies"))
            .withColumn("chain", F.lit(chain)))
        open_ = met.where("text is not null").drop("sha")
        if open_.isEmpty():
            break
    entries = reduce(DataFrame.unionByName, links).repartitionByRange("bucket", "key").sortWithinPartitions("bucket", "key", "chain")
    index = written(spark, entries.select("bucket", "key", "chain", "sha", "keep_id", "copies"), "index")
    dropped(spark, keys, slots, *parts)
    return index


def _text(text_col: str, normalise: Callable[[Column], Column] | None) -> Column:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return normalise(text) if normalise else text


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max",
                 normalise: Callable[[Column], Column] | None = None, capacity: int = CAPACITY,
                 hashed: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after ``normalise`` (default: no change); a null text counts as empty.  The row with
    the largest (``keep="min"``: smallest) id of a group stays; null ids come last, and only a group without any id has a
    null ``keep_id``.  Of repeated rows (same id and text) one is marked kept.  Texts of any length are hashed and compared
    whole.  Other columns are not read.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    index = build_index(docs, id_col, text_col, keep, normalise, capacity, hashed)
    text = _text(text_col, normalise)
    rows = docs.select(F.col(id_col).alias("id"), hashed(text).alias("key"), F.sha2(text, 256).alias("sha"))
    # equal rows are interchangeable: count them, and number them when they are dealt out again
    rows = written(spark, rows.groupBy("id", "key", "sha").agg(F.count(F.lit(1)).alias("times")), "rows")
    entries = index.select("key", F.col("sha").alias("entry"), "keep_id", "copies")
    found = join_key(rows, entries, "key", "copies").where("sha = entry").drop("entry")
    alone = rows.join(entries.select("key"), "key", "left_anti").withColumn("keep_id", F.col("id")).withColumn("copies", F.col("times"))
    found = _dealt_out(found.unionByName(alone))
    return found.select(F.col("id").alias(id_col), "keep_id", F.col("copies").alias("group_size"),
                        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"),
                        F.col("sha").alias("text_sha256"))


def _dealt_out(rows: DataFrame) -> DataFrame:
    """Each row as often as ``times`` says, numbered by ``nth``: many copies first as parts, which are dealt to all tasks."""
    few = rows.where(F.col("times") <= AT_ONCE).withColumn("first", F.lit(0).cast("long"))
    many = rows.where(F.col("times") > AT_ONCE).withColumn("part", F.explode(F.expr(
        f"sequence(0L, (times - 1) div {AT_ONCE * AT_ONCE})")))
    # twice, so that no array has more than a thousand places or as many as times is millions
    size = F.expr(f"least({AT_ONCE * AT_ONCE}, times - part * {AT_ONCE * AT_ONCE})")
    many = many.withColumn("size", size).withColumn("piece", F.explode(F.expr(f"sequence(0L, (size - 1) div {AT_ONCE})")))
    many = many.withColumn("first", F.expr(f"part * {AT_ONCE * AT_ONCE} + piece * {AT_ONCE}")).withColumn(
        "times", F.expr(f"least({AT_ONCE}, size - piece * {AT_ONCE})")).drop("part", "size", "piece").repartition("sha", "first")
    every = few.unionByName(many)
    every = every.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    return every.withColumn("nth", F.col("first") + F.col("nth"))
