"""Near duplicates by the Jaccard overlap of word shingles, found with PartEnum signatures (operator 8).

Two sets of sizes a and b with ``den * |A and B| >= num * |A or B|`` differ in at most
``(den - num) * (a + b) / (den + num)`` elements.  Sizes are cut into bands.  For a band whose largest size is r that
gives one bound k.  The domain of shingle hashes is cut into n1 ranges, each into n2 smaller ones.  Two similar sets differ
by more than k2 elements in at most ``g = k // (k2 + 1)`` of the n1 ranges; in every other one they agree on all of some
``n2 - k2`` of its smaller ranges.  Each choice of ``n2 - k2`` smaller ranges gives a signature (a hash of the elements in
them), and similar sets share one.  A set signs in its own band and in those above it that a partner may lie in.

Signatures of few elements say little, and those of none are shared by every set that happens to have none there.  If more
than g ranges of a set have at least t elements in each of their choices, then one of those ranges is among those that it
agrees on with a given partner.  So a set leaves out all signatures of fewer elements than t, for the largest such t.  Its
partner has a t of its own; the range found from the larger of the two is signed by both, so no link is lost.  A set
without such a t keeps every signature.  ``scheme`` picks n1, n2 and k2 by the signatures and the holder pairs that they
are expected to give.

From signatures to components:

1. One scan turns every text into its set's size, two fingerprints and its signatures.  Equal sets become one node, named
   by the smallest document.
2. Signatures given more than once are kept: their count is combined before its shuffle, and a map of fixed size keeps
   most other rows from moving; the join after it is exact.  In rounds, every holder is compared with one pivot of each signature;
   holders found to be linked join one component.
3. A signature whose holders all lie in one component is settled, and one stands for all that have the same holders.  Of
   the others, holders in different components are compared in blocks: parity sketches (their differing bits never exceed
   the number of differing elements) discard pairs that cannot link, and only the rest is emitted and compared exactly.
   Where a signature has many holders the sketches are as wide as the sets are large; a pair that shares many signatures
   is emitted at the first of them, and seldom at others.  Nothing is capped, no link is lost.  The second turn with
   pivots is left out where a holder meets no more than a block of others on average: comparing them costs less.
4. Components come from repeated minimum propagation over the links, written to ``spark.checkpoint.dir`` each round.

Exact comparison intersects whole sets of 64-bit shingle hashes.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations
from math import ceil, comb, erf, exp, sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window, functions as F

from cartwheel.llm import text as T
from cartwheel.llm.spread import dropped, join_key, written

#: separators are blank and 0x09-0x0D
WORD = ~T.byte_class((0x20, 0x20), (0x09, 0x0D))
SKETCH = 8
BAND = 1.5
#: what ``scheme`` reckons with: sets that share a fourth of a set's elements, and sets of a band at 100 TB
SHARING, SHARED, PEERS = 30, 0.25, 1_000_000
#: bits of the maps that spare rows a shuffle before an exact join
BITS = 1 << 24


@lru_cache(maxsize=None)
def bands(num: int, den: int, largest: int) -> tuple[tuple[int, int], ...]:
    """Size bands (smallest, largest size) that together cover 1 to at least ``largest``."""
    out, low = [], 1
    while not out or out[-1][1] < largest:
        out.append((low, max(low, int(low * BAND))))
        low = out[-1][1] + 1
    return tuple(out)


def differing(num: int, den: int, a: int, b: int) -> int:
    """The most elements in which linked sets of these sizes can differ."""
    return (den - num) * (a + b) // (den + num)


def _at_most(n: int, p: float, most: int) -> float:
    """The chance that at most so many of n ranges are of a kind that has chance p."""
    if n <= 60:
        return sum(comb(n, j) * p ** j * (1 - p) ** (n - j) for j in range(most + 1))
    return (1 + erf((most + 0.5 - n * p) / sqrt(2 * n * p * (1 - p) + 1e-12))) / 2


@lru_cache(maxsize=None)
def scheme(num: int, den: int, low: int, high: int) -> tuple[int, int, int, tuple[tuple[int, ...], ...]]:
    """n1, n2, g and the chosen subsets of the n2 ranges: the least signatures and expected chance holders together."""
    k = differing(num, den, high, high)
    best = None
    for k2 in range(3):
        g = k // (k2 + 1)
        for n1 in sorted({ceil((g + 1) * more) for more in (1, 1.25, 1.5)}):
            for n2 in range(k2 + 1, k2 + 5) if k2 else (1,):
                held = low / n1 * (n2 - k2) / n2                   # elements of a signature
                none = exp(-low / n1 / n2)
                full = sum(comb(n2, j) * none ** j * (1 - none) ** (n2 - j) for j in range(n2 - k2))
                # two sets meet by chance where neither has an element of its own; where a set keeps empty signatures, it
                # meets all that have none there either
                chance = SHARING * exp(-2 * held * (1 - SHARED)) + PEERS * _at_most(n1, full, g) * exp(-2 * held)
                rank = n1 * comb(n2, k2) * (1 + chance)
                if best is None or rank < best[0]:
                    best = rank, n1, n2, g, tuple(combinations(range(n2), n2 - k2))
    return best[1:]


@lru_cache(maxsize=4096)
def _limits(parts: int) -> np.ndarray:
    """Where each of so many equal ranges of the 64-bit numbers begins, and their end."""
    return np.array([-(-(i << 64) // parts) for i in range(parts)], np.uint64)


def signatures(shingles: np.ndarray, num: int, den: int) -> np.ndarray:
    """The PartEnum signatures of one set, given as sorted distinct 64-bit numbers."""
    n = len(shingles)
    reach = n * den // num                       # the largest set that may link
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(T.mix(shingles ^ np.uint64(0x5851F42D4C957F2D)), out=total[1:])
    out = []
    for index, (low, high) in enumerate(bands(num, den, reach)):
        if high < n or low > reach or differing(num, den, high, high) == 0:
            continue
        n1, n2, g, subsets = scheme(num, den, low, high)
        at = np.append(np.searchsorted(shingles, _limits(n1 * n2)), n)
        sums = (total[at[1:]] - total[at[:-1]]).reshape(n1, n2)
        counts = np.diff(at).reshape(n1, n2)
        place = T.mix(np.arange(n1 * len(subsets), dtype=np.uint64) + np.uint64((index + 1) << 40))
        chosen = np.stack([sums[:, list(s)].sum(axis=1, dtype=np.uint64) for s in subsets], axis=1)
        held = np.stack([counts[:, list(s)].sum(axis=1) for s in subsets], axis=1)
        # more than g ranges have at least so many elements in each of their choices
        least = np.partition(held.min(axis=1), n1 - 1 - g)[n1 - 1 - g]
        out.append(T.mix(chosen.ravel() + place)[(held >= least).ravel()])
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def shingle_sets(column: pa.Array, words: int):
    """For every text of a batch the sorted distinct hashes of its shingles; a shorter text that has words is one."""
    data, offsets = T.utf8(column)
    data = T.LOWER[data]
    starts, ends, bounds = T.words(data, offsets, WORD)
    hashes = T.range_hashes(data, starts, ends)
    grams = T.windows(hashes, words)
    for first, last in zip(bounds[:-1], bounds[1:]):
        if last - first >= words:
            yield np.unique(grams[first:last - words + 1])
        elif last > first:
            yield T.windows(hashes[first:last], last - first)
        else:
            yield np.zeros(0, np.uint64)


def sketch(shingles: np.ndarray, bits: int = 64 * SKETCH) -> np.ndarray:
    """The parity of the number of elements in each of so many slots (a power of two), packed to bytes."""
    slots = (shingles >> np.uint64(7)).astype(np.int64) & (bits - 1)
    return np.packbits((np.bincount(slots, minlength=bits) & 1).astype(np.uint8))


def wide_sketch(shingles: np.ndarray) -> bytes:
    """A sketch with at least twice as many slots as there are elements."""
    return sketch(shingles, max(64 * SKETCH, 1 << (2 * len(shingles) - 1).bit_length())).tobytes()


def least_apart(one: bytes | np.ndarray, two: bytes | np.ndarray) -> int:
    """At least so many elements are in one of two sets only; the longer sketch is folded to the shorter."""
    a, b = sorted((np.frombuffer(x, np.uint8) for x in (one, two)), key=len)
    b = np.bitwise_xor.reduce(b.reshape(-1, len(a)), axis=0)
    return int(np.bitwise_count(a ^ b).sum())


def fingerprints(shingles: np.ndarray) -> tuple[int, int]:
    """Two independent 64-bit hashes of a set, as signed numbers."""
    one = T.mix(shingles ^ np.uint64(0x2545F4914F6CDD1D)).sum(dtype=np.uint64)
    two = T.mix(shingles + np.uint64(0x632BE59BD9B4E019)).sum(dtype=np.uint64)
    return int(one.view(np.int64)), int(two.view(np.int64))


# ---- Spark -----------------------------------------------------------------------------------------------------------
#: turns with pivots before the rest is compared in blocks
ROUNDS = 2
BLOCK = 512
#: holders from which on pairs of a signature are told apart by wide sketches too, and signatures that a pair looks back on
MANY, RECENT = 4, 8
#: nodes that a task contracts at a time
FOREST = 1 << 18
_BITS = [f"s{i}" for i in range(SKETCH)]
_SCAN = ("id long, n long, fp long, fp2 long, sigs array<long>, "
         + ", ".join(f"{c} long" for c in _BITS) + ", wide array<long>")
_SETS = "fp long, shingles binary"


def _signed(docs: DataFrame, words: int, num: int, den: int, seed: int) -> DataFrame:
    """Per document the size, fingerprints, signatures and parity sketch of its set; a copy seen before in the same task
    has no signatures.  A column ``sha`` goes along where there is one."""
    more = [c for c in docs.columns if c == "sha"]

    def run(batches):
        seen: set[int] = set()
        for part in T.slices(batches, "text"):
            n, one, two, sigs, odd, wide = [], [], [], [], [], []
            for x in shingle_sets(part.column("text"), words):
                a, b = fingerprints(x ^ np.uint64(seed))
                fresh = len(x) > 0 and a not in seen
                if fresh:
                    seen.add(a)
                n.append(len(x)), one.append(a), two.append(b), odd.append(sketch(x).view(np.int64))
                wide.append(np.frombuffer(wide_sketch(x), np.int64) if fresh else None)
                sigs.append(signatures(x, num, den).view(np.int64) if fresh else np.zeros(0, np.int64))
            ends = np.cumsum([0, *map(len, sigs)]).astype(np.int32)
            odd = np.array(odd, np.int64).reshape(-1, SKETCH)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(n, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sigs))),
                 *(pa.array(odd[:, i]) for i in range(SKETCH)), pa.array(wide, pa.list_(pa.int64())),
                 *(part.column(c) for c in more)],
                ["id", "n", "fp", "fp2", "sigs", *_BITS, "wide", *more])
    return T.mapped(docs, run, _SCAN + "".join(f", {c} binary" for c in more))


def _membership(slots: DataFrame) -> np.ndarray:
    """A map of the slots (column b, below BITS) that occur; its size is fixed, whatever the number of rows."""
    words = slots.groupBy(F.shiftright("b", 5).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(b % 32 as int))")).alias("v")).toArrow()
    out = np.zeros(BITS // 32, np.uint32)
    out[words.column("w").to_numpy()] = words.column("v").to_numpy().astype(np.uint32)
    return out


def _held(signed: DataFrame) -> DataFrame:
    """(sig, fp, n) of signatures that more than one task or node has given; a map of those drops most others early."""
    spark = signed.sparkSession
    shared = signed.select(F.explode("sigs").alias("sig")).groupBy("sig").count().where("count > 1").select("sig")
    shared = written(spark, shared, "shared")
    bitmap = spark.sparkContext.broadcast(_membership(shared.select(F.pmod("sig", F.lit(BITS)).alias("b"))))

    def run(batches):
        for part in batches:
            sig = part.column("sigs").flatten()
            slot = sig.to_numpy().astype(np.int64) & (BITS - 1)
            keep = (bitmap.value[slot >> 5] >> (slot & 31).astype(np.uint32)) & 1 > 0
            row = pa.compute.list_parent_indices(part.column("sigs")).to_numpy()[keep]
            yield pa.RecordBatch.from_arrays([sig.filter(pa.array(keep)), *(part.column(c).take(pa.array(row))
                                                                            for c in ("fp", "n"))], ["sig", "fp", "n"])
    near = T.mapped(signed.select("fp", "n", "sigs").where("size(sigs) > 0"), run, "sig long, fp long, n long")
    held = written(spark, near.join(shared, "sig").distinct(), "held")
    dropped(spark, shared)
    return held


def _slot() -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(BITS))


def _sets(docs: DataFrame, nodes: DataFrame, words: int, seed: int) -> DataFrame:
    """The shingles of the given nodes (fp, id; any number of times), from a second scan of the texts.

    A bitmap of bounded size spares most other documents the trip; the join after it is exact.
    """
    bitmap = docs.sparkSession.sparkContext.broadcast(_membership(nodes.select(_slot().alias("b"))))

    def run(batches):
        seen: set[int] = set()
        for part in T.slices(batches, "text"):
            slot = part.column("slot").to_numpy()
            part = part.filter(pa.array((bitmap.value[slot >> 5] >> (slot & 31).astype(np.uint32)) & 1 > 0))
            rows = []
            for x in shingle_sets(part.column("text"), words):
                fp = fingerprints(x ^ np.uint64(seed))[0]
                if fp in seen or not len(x):
                    continue
                seen.add(fp)
                rows.append((fp, x.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in
                                              enumerate((pa.int64(), pa.binary()))], ["fp", "shingles"])
    found = T.mapped(docs.withColumn("slot", _slot()), run, _SETS)
    return found.join(nodes, "fp", "left_semi")


def _screened(pairs: DataFrame, sketches: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) that sizes and sketches allow to link, with the ids that name the two.

    Each side is looked up once: a wide sketch takes about an eighth of a byte to a quarter for an element.
    """
    for side in "ab":
        pairs = pairs.join(sketches.select(*[F.col(c).alias(side if c == "fp" else side + c) for c in sketches.columns]),
                           side)

    def raw(x):                                      # binary or longs
        return x.as_buffer() if isinstance(x, pa.BinaryScalar) else x.values.to_numpy()

    def run(batches):
        for part in batches:
            near = [(den + num) * least_apart(raw(x), raw(y)) <= (den - num) * n
                    for x, y, n in zip(part.column("awide"), part.column("bwide"), part.column("size").to_pylist())]
            yield part.filter(pa.array(near, pa.bool_())).select(["a", "b", "aid", "bid"])
    possible = pairs.where(_possible(num, den)).select("a", "b", "aid", "bid", F.expr("an + bn").alias("size"), "awide",
                                                       "bwide")
    return T.mapped(possible, run, "a long, b long, aid long, bid long")


def _possible(num: int, den: int) -> str:
    apart = " + ".join(f"bit_count(as{i} ^ bs{i})" for i in range(SKETCH))
    return (f"{num} * greatest(an, bn) <= {den} * least(an, bn) "
            f"and ({apart}) * {den + num} <= {den - num} * (an + bn)")


def _possible_by_wide(num: int, den: int) -> str:
    """The same by wide sketches (awide, bwide); one of twice the length is folded.  True where there is none, or a longer one."""
    def folded(x, y):
        return (f"if(size({x}) = 2 * size({y}), zip_with(slice({x}, 1, size({y})), slice({x}, size({y}) + 1, size({y})), "
                f"(p, q) -> p ^ q), {x})")
    apart = (f"aggregate(zip_with({folded('awide', 'bwide')}, {folded('bwide', 'awide')}, (p, q) -> bit_count(p ^ q)), 0, "
             "(s, c) -> s + c)")
    return f"coalesce({apart} * {den + num} <= {den - num} * (an + bn), true)"


def _linked(docs: DataFrame, pairs: DataFrame, used: list[DataFrame], words: int, num: int, den: int,
            seed: int) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the threshold, as a table; ``used`` goes once the pairs are written."""
    spark = docs.sparkSession
    pairs = written(spark, pairs, "pairs")
    dropped(spark, *used)
    if pairs.isEmpty():
        return pairs.select("a", "b")
    nodes = pairs.selectExpr("a as fp", "aid as id").unionByName(pairs.selectExpr("b as fp", "bid as id"))
    full = written(spark, _sets(docs, nodes, words, seed), "sets")
    both = (pairs.select("a", "b").join(full.select(F.col("fp").alias("a"), F.col("shingles").alias("x")), "a")
            .join(full.select(F.col("fp").alias("b"), F.col("shingles").alias("y")), "b"))

    def run(batches):
        for part in batches:
            keep = []
            for x, y in zip(part.column("x"), part.column("y")):
                one, two = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
                inter = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(den * inter >= num * (len(one) + len(two) - inter))
            yield part.filter(pa.array(keep, pa.bool_())).select(["a", "b"])
    links = written(spark, T.mapped(both, run, "a long, b long"), "links")
    dropped(spark, pairs, full)
    return links


def _contracted(edges: DataFrame) -> DataFrame:
    """Edges (u, v), u > v, that connect the same nodes, never more of them: a task ties what its own edges connect to the
    smallest node of it.  A task holds at most about FOREST nodes and a batch at a time."""
    def run(batches):
        over: dict[int, int] = {}                    # a smaller node of the same component; roots have none

        def top(x):
            while (y := over.get(x)) is not None:
                if (z := over.get(y)) is not None:
                    over[x] = z
                x = y
            return x

        def tied():
            nodes = list(over)
            return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([top(x) for x in nodes], pa.int64())],
                                              ["u", "v"])
        for part in batches:
            for u, v in zip(part.column("u").to_pylist(), part.column("v").to_pylist()):
                u, v = top(u), top(v)
                if u != v:
                    over[max(u, v)] = min(u, v)
            if len(over) >= FOREST:
                yield tied()
                over.clear()
        yield tied()
    return T.mapped(edges, run, "u long, v long")


def _smallest(around: DataFrame) -> DataFrame:
    """Per node u of the edges the smallest and the largest neighbour v, and the edges that it has; a table."""
    return written(around.sparkSession, around.groupBy("u").agg(F.min("v").alias("low"), F.max("v").alias("high"),
                                                                F.count(F.lit(1)).alias("copies")), "least")


def components(links: DataFrame) -> DataFrame:
    """(fp, root) for the nodes of the links (a, b) but the roots themselves: the smallest name each can reach; a table.

    Alternating large and small stars until every component is one star: around every node its larger neighbours move to
    the smallest of all (which keeps everything connected: by induction every node stays tied to its smallest neighbour),
    then its smaller ones and itself.  Edges never become more; what a task has of them is contracted before it is written.
    No node's neighbours are ever gathered.
    """
    spark = links.sparkSession
    edges = written(spark, _contracted(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                                       .where("u != v")), "edges")
    while True:
        down = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
        least = _smallest(edges.unionByName(down))
        # a star: its centre has larger neighbours only, every other node just one
        if least.where("low < u and low < high").isEmpty():
            roots = written(spark, least.where("low < u").select(F.col("u").alias("fp"), F.col("low").alias("root")), "roots")
            dropped(spark, least, edges)
            return roots
        least_of = least.select("u", F.least("low", "u").alias("m"), "copies")
        large = written(spark, _contracted(join_key(down, least_of, "u", "copies", narrow=True)
                                           .select(F.col("v").alias("u"), F.col("m").alias("v"))), "edges")
        dropped(spark, least, edges)
        least = _smallest(large)
        least_of = least.select("u", F.col("low").alias("m"), "copies")
        moved = join_key(large, least_of, "u", "copies", narrow=True).where("v != m").select(F.col("v").alias("u"),
                                                                                            F.col("m").alias("v"))
        own = least_of.select("u", F.col("m").alias("v"))
        edges = written(spark, _contracted(moved.unionByName(own)), "edges")
        dropped(spark, least, large)


def _mixed(held: DataFrame, roots: DataFrame | None) -> tuple[DataFrame, float]:
    """The holders, with their component, of signatures whose holders lie in more than one (of signatures that have the same
    holders, one); how many holders of a signature one of them meets on average (infinite where no components are known yet)."""
    if roots is None:
        return held.withColumn("root", F.col("fp")), float("inf")      # no table of its own
    spark = held.sparkSession
    named = written(spark, held.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "named")
    who = [F.bit_xor(F.xxhash64("fp", F.lit(i))).alias(f"who{i}") for i in range(2)]
    per = named.groupBy("sig").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count(F.lit(1)).alias("copies"), *who)
    per = written(spark, per.where("x < y").select("sig", "copies", "who0", "who1"), "open")
    met = per.agg(F.sum(F.col("copies").cast("double") * F.col("copies")) / F.sum("copies")).first()[0] or 0.0
    # signatures of the same holders, told by 128 bits and their number, give the same pairs
    one = written(spark, per.groupBy("who0", "who1", "copies").agg(F.min("sig").alias("sig")).select("sig", "copies"), "one")
    mixed = written(spark, join_key(named, one, "sig", "copies", narrow=True).drop("copies"), "mixed")
    dropped(spark, named, per, one)
    return mixed, met


def _to_pivots(holders: DataFrame, turn: int, used: list[DataFrame]) -> DataFrame:
    """Each holder of a signature with the signature's pivot, if they lie in different components.

    Every turn has its own order of nodes, the same for all signatures, so that pivots recur and pairs stay few.  Tables
    that the pairs are made from are added to ``used``.
    """
    order = F.lit((0x2545F4914F6CDD1D * turn) & (2 ** 63 - 1)).cast("long")
    place = F.col("fp").bitwiseXOR(order)
    pivot = written(holders.sparkSession, holders.groupBy("sig").agg(
        F.min(place).bitwiseXOR(order).alias("b"), F.min_by("root", place).alias("broot"),
        F.count(F.lit(1)).alias("copies")), "pivots")
    used.append(pivot)
    apart = join_key(holders, pivot, "sig", "copies", narrow=True).where("root != broot")
    return apart.select(F.col("fp").alias("a"), "b").distinct()


def _in_blocks(holders: DataFrame, sketches: DataFrame, num: int, den: int, used: list[DataFrame]) -> DataFrame:
    """Pairs of holders of a signature in different components that sizes and sketches allow to link.

    A signature's holders are dealt to blocks of about BLOCK rows, and blocks meet two at a time, so no task or buffer
    holds a whole signature and only pairs that pass are emitted.
    """
    spark = holders.sparkSession
    blocks = written(spark, holders.groupBy("sig").agg(F.count(F.lit(1)).alias("copies")), "blocks")
    rows = join_key(holders, blocks, "sig", "copies", narrow=True).withColumn("blocks", F.ceil(F.col("copies") / BLOCK))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")))
    rows = rows.join(sketches.select("fp", "wide", *_BITS), "fp")
    rows = rows.withColumn("wide", F.when(F.col("copies") > MANY, F.col("wide")))
    before = Window.partitionBy("fp").orderBy("sig").rowsBetween(-RECENT, -1)
    rows = rows.withColumn("recent", F.collect_list("sig").over(before))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = written(spark, rows.select("sig", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                                      "own", "fp", "n", "root", "recent", "wide", *_BITS), "blocked")
    dropped(spark, blocks)
    used.append(rows)
    return _meetings(rows, num, den).distinct()


def _meetings(rows: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) of the blocks, at the first signature that a and b share and seldom at another.

    A pair is passed over where both have signed the same just before: among the RECENT signatures that precede this one in
    their own order, which is that of the numbers.  None precedes the first that they share, so there it is emitted.
    """
    a, b = (rows.select("sig", "i", "j", *[F.col(c).alias(side + c) for c in rows.columns[3:]]).alias(side)
            for side in "ab")
    test = (f"aroot != broot and afp < bfp and (a.i = a.j or aown != bown) and {_possible(num, den)} "
            f"and not arrays_overlap(arecent, brecent) and {_possible_by_wide(num, den)}")
    on = (F.col("a.sig") == F.col("b.sig")) & (F.col("a.i") == F.col("b.i")) & (F.col("a.j") == F.col("b.j"))
    return a.join(b, on & F.expr(test)).select(F.col("afp").alias("a"), F.col("bfp").alias("b"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
                       num: int = 80, den: int = 100, grouped: bool = False) -> DataFrame:
    """One row per input row: id, n_shingles, component (the smallest id reachable by links), copies (rows of equal set).

    ``grouped`` adds two columns: group, which tells components apart even if they share a name (null without shingles),
    and sha, the digest of the row's text.

    Two rows link when the Jaccard overlap of their distinct ``words``-word shingles is at least ``num / den``.  Null and
    blank texts have no shingles, link with nothing and are their own component.  A text with fewer words is one shingle.
    Repeated rows each get a row; a null id is never the name of a component unless all its members lack one.  Other
    columns of ``docs`` are not read, so clashing names don't matter.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    more = ["group", "sha"] if grouped else []
    signable = docs.withColumn("sha", text_digest()) if grouped else docs
    for seed in (0x0, 0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179):
        signed = written(spark, _signed(signable, words, num, den, seed), "signed")
        nodes = written(spark, signed.where("n > 0").groupBy("fp").agg(
            F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), F.min("fp2").alias("x"), F.max("fp2").alias("y")),
            "nodes")
        if nodes.where("x != y").isEmpty():      # else two sets share a 64-bit name: take other hashes
            break
        dropped(spark, signed, nodes)
    else:
        raise RuntimeError("fingerprints of different sets collide under every seed")
    held = _held(signed)
    # the signatures take most of the space and are not read again
    slim = written(spark, signed.drop("sigs"), "rows")
    dropped(spark, signed)
    signed = slim
    roots = _search(docs, signed, held, words, num, den, seed)
    named = nodes.select("fp", "id", "copies")
    if roots is not None:
        named = written(spark, named.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "rooted")
        dropped(spark, nodes, roots)
        top = named.groupBy("root").agg(F.min("id").alias("component"), F.count(F.lit(1)).alias("weight"))
        named = join_key(named, written(spark, top, "components"), "root", "weight", narrow=True)
    else:
        named = named.withColumn("component", F.col("id")).withColumn("root", F.col("fp"))
    named = written(spark, named.select("fp", "component", "copies", F.col("root").alias("group")), "named")
    rows = signed.select("id", "n", "fp", *more[1:])
    with_words = join_key(rows.where("n > 0"), named, "fp", "copies", narrow=True)
    without = rows.where("n = 0").withColumn("component", F.col("id")).withColumn("copies", F.lit(1).cast("long")).withColumn(
        "group", F.lit(None).cast("long"))
    return with_words.unionByName(without).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component",
                                                  "copies", *more)


def text_digest(text_col: str = "text"):
    """What tells texts apart; a null text is empty."""
    return F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))


def _search(docs: DataFrame, signed: DataFrame, held: DataFrame, words: int, num: int, den: int,
            seed: int) -> DataFrame | None:
    """The components of the links between different sets (None where there are no candidates)."""
    spark = docs.sparkSession
    if held.isEmpty():
        return None
    sketches = written(spark, signed.where("n > 0").join(held.select("fp").distinct(), "fp", "left_semi").groupBy("fp")
                       .agg(F.min("n").alias("n"), F.min("id").alias("id"), *[F.min(c).alias(c) for c in _BITS], F.min("wide").alias("wide")),
                       "sketches")
    roots = None
    for turn in range(ROUNDS + 1):
        mixed, met = _mixed(held, roots)
        used = [mixed]
        # all holders are compared after the last turn, and before it where one meets no more others than a block holds
        last = turn == ROUNDS or met <= BLOCK
        pairs = _in_blocks(mixed, sketches, num, den, used) if last else _to_pivots(mixed, turn, used)
        found = _linked(docs, _screened(pairs, sketches, num, den), used, words, num, den, seed)
        # the components are followed to their ends, so that in blocks no pair within a large group is emitted
        if roots is None or not found.isEmpty():
            known = found if roots is None else found.unionByName(roots.selectExpr("fp as a", "root as b"))
            before, roots = roots, components(known)
            dropped(spark, before)
        if last:
            break
    dropped(spark, held, sketches)
    return roots
