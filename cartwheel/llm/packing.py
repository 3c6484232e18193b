"""Best-fit packing of documents into sequences by bin completion (operator 10).

Documents are tokenised and cut once, on Spark.  What has to be packed is then only a count for each length from 1 to
``capacity``: pieces of equal length are interchangeable.  That table has at most ``capacity`` rows at any input size, and
the search runs over it.  Its result, a plan, says which ranks of each length share a sequence; it has a few rows for each
length, however many pieces there are.  Every piece finds its sequence by its rank among the pieces of its length.  Ranks
come from counts of (length, slot) groups; a slot is a stretch of ``SLOT_ROWS`` rows of one file of the written pieces, so
no length is ever gathered, and a row that makes up a third of the table stays spread over the files it was written to.

The search is branch and bound over completions of the largest piece left: the fillings of the room beside it are
enumerated by increasing waste, those that another one dominates by an exchange are left out, a branch ends when its waste
rules out a better packing, and the best packing so far (best fit decreasing, to begin with) is the incumbent.  A node stands
for a whole run of equal sequences: a filling is repeated as often as its lengths last, and any fewer times in branches of
their own.  Only ``NODES`` stops the search early; a packing is called proven when it meets the bound or the tree is complete.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from cartwheel.llm import text as T
from cartwheel.llm.spread import written
from cartwheel.llm.tokens import encoder

Run = tuple[tuple[int, ...], int]
#: branches and left-out fillings the search may look at before the incumbent is final
NODES = 20_000
SLOT_ROWS = 50_000


# ---- the search, over counts of lengths ------------------------------------------------------------------------------
def best_fit(counts: dict[int, int], capacity: int) -> list[Run]:
    """Best fit decreasing, for whole runs of equal bins at a time."""
    open_: dict[int, dict[tuple[int, ...], int]] = {}
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            rooms = [r for r in open_ if r >= length]
            if rooms:
                room = min(rooms)
                bins = open_[room]
                filled, have = bins.popitem()
                if not bins:
                    del open_[room]
            else:
                # a new bin takes as many of this length as it holds
                room, filled, have = capacity, (), left
            each = min(room // length, left)
            used = min(have, left // each)
            if have > used:
                if filled:
                    open_.setdefault(room, {})[filled] = have - used
            rest = room - each * length
            bins = open_.setdefault(rest, {})
            now = filled + (length,) * each
            bins[now] = bins.get(now, 0) + used
            left -= each * used
    return [(filled, n) for bins in open_.values() for filled, n in bins.items()]


def undominated(counts: dict[int, int], room: int, allowed=lambda waste: True):
    """All fillings of the room that no other one dominates, least waste first; None for every dominated one met.

    A filling is dominated when some of its members, or none, can be replaced by one length left over that is at least
    their sum and still fits: the exchange never needs another bin.  One member must be replaced by a larger one.
    Sums that the lengths can reach are kept as bits of one number, smaller lengths first, so there are no dead ends.
    It ends at the first waste that is not ``allowed``.
    """
    sizes = sorted(s for s, n in counts.items() if n > 0 and s <= room)
    mask, reach, table = (1 << (room + 1)) - 1, 1, [1]
    for s in sizes:
        times, step = min(counts[s], room // s), 1
        while times > 0:
            take = min(step, times)
            reach |= (reach << (s * take)) & mask
            times -= take
            step *= 2
        table.append(reach)
    spare, small, i = sum(1 << s for s in sizes), 0, 0
    for waste in range(room + 1):
        # lengths that fit into the waste must all be used up
        while i < len(sizes) and sizes[i] <= waste:
            small += sizes[i] * counts[sizes[i]]
            i += 1
        if small > room - waste or not allowed(waste):
            return
        for filling in _read(table, sizes, counts, len(sizes) - 1, room - waste):
            yield None if _dominated(filling, counts, spare, waste) else filling


def _read(table: list[int], sizes: list[int], counts: dict[int, int], top: int, total: int):
    """All fillings with the given sum from ``sizes[:top + 1]``, larger members first."""
    if not total:
        yield ()
        return
    while top >= 0 and table[top + 1] >> total & 1:
        size = sizes[top]
        for k in range(min(counts[size], total // size), 0, -1):
            if table[top] >> (total - k * size) & 1:
                for rest in _read(table, sizes, counts, top - 1, total - k * size):
                    yield (size,) * k + rest
        top -= 1


def _dominated(filling: tuple[int, ...], counts: dict[int, int], spare: int, waste: int) -> bool:
    """Whether a length left over, a bit of ``spare``, can replace members with no larger sum within the waste."""
    one = more = 0
    for s in filling:
        more |= (more | one) << s
        one |= 1 << s
    for s in set(filling):
        if counts[s] == filling.count(s):
            spare ^= 1 << s
    # everything above a sum by 1 to waste
    above, covered = (more | one | 1) << 1 if waste else 0, 1
    while covered < waste:
        step = min(covered, waste - covered)
        above |= above << step
        covered += step
    return bool(spare & (more | above))


def _branches(left: dict[int, int], capacity: int, barred: frozenset, allowed):
    """(members, repeats, fillings barred below) for the bins of the largest length; None where a filling is left out.

    Every undominated filling comes with every number of repeats: first each with halvings of the most, then the others.
    A branch holds all bins of its filling, so below it, while the largest length is the same, its filling is barred, and
    so are those before it, which have branches of their own.
    """
    largest = max(left)
    rest = left | {largest: left[largest] - 1}
    tried: list[tuple[tuple[int, ...], int]] = []

    def branch(i: int, n: int):
        members = (largest, *tried[i][0])
        last = n * members.count(largest) == left[largest]
        return members, n, frozenset() if last else barred.union(f for f, _ in tried[:i + 1])

    for filling in undominated(rest, capacity - largest, allowed):
        if filling is None or filling in barred:
            yield None
            continue
        members = (largest, *filling)
        most = n = min(left[s] // members.count(s) for s in set(members))
        tried.append((filling, most))
        while n:
            yield branch(len(tried) - 1, n)
            n //= 2
    for i, (_, most) in enumerate(tried):
        halving = {most >> k for k in range(most.bit_length())}
        for n in range(most - 1, 0, -1):
            if n not in halving:
                yield branch(i, n)


def pack(counts: dict[int, int], capacity: int, nodes: int = NODES) -> tuple[list[Run], bool]:
    """Runs (lengths of a sequence, number of such sequences), and whether their number is proven to be the least."""
    counts = {s: n for s, n in counts.items() if n > 0}
    total = sum(s * n for s, n in counts.items())
    alone = sum(n for s, n in counts.items() if 2 * s > capacity)
    bound = max(-(-total // capacity), alone)
    best = best_fit(counts, capacity)
    bins = sum(n for _, n in best)
    opened = 0

    def better(waste: int) -> bool:
        """Whether a packing that wastes this much may still have fewer bins than the incumbent."""
        return total + waste <= (bins - 1) * capacity

    # one entry for each level: the counts left, the waste so far, the branches still to try
    def level(left: dict[int, int], waste: int, barred: frozenset):
        return left, waste, _branches(left, capacity, barred, lambda more: better(waste + more))

    stack, runs = ([level(counts, 0, frozenset())] if counts else []), []
    while stack and bins > bound and opened < nodes:
        left, waste, branches = stack[-1]
        # nothing below a level is better once its own waste is too much
        branch = next(branches, ()) if better(waste) else ()
        if branch == ():
            stack.pop()
            if runs:
                runs.pop()
            continue
        opened += 1
        if branch is None:
            continue
        members, times, barred = branch
        lost = waste + (capacity - sum(members)) * times
        if not better(lost):
            continue
        after = {s: n for s, n in ((s, n - members.count(s) * times) for s, n in left.items()) if n}
        runs.append((members, times))
        if after:
            stack.append(level(after, lost, barred))
            continue
        best, bins = list(runs), sum(n for _, n in runs)
        runs.pop()
    return best, bins == bound or not stack


# ---- Spark -----------------------------------------------------------------------------------------------------------
_PIECES = "id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, id_col: str = "doc_id", text_col: str = "text",
           keep_ids: bool = False) -> DataFrame:
    """Per piece: id, piece, start, length, ids_crc32 (and its ids).

    A document is its ids and then ``end_id``; a null text is empty.  A longer one is cut into pieces of ``capacity``, of
    which the first may be shorter.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        ids, at = encoder(tokenizer)([t or "" for t in part.column("text").to_pylist()])
        row, piece, start, length, crc, kept = [], [], [], [], [], []
        for i in range(part.num_rows):
            own = np.append(ids[at[i]:at[i + 1]], np.uint32(end_id)).astype("<u4")
            cuts = [0, *range(len(own) % capacity or capacity, len(own) + 1, capacity)]
            for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                row.append(i), piece.append(k), start.append(a), length.append(b - a)
                crc.append(zlib.crc32(own[a:b].tobytes()))
                if keep_ids:
                    kept.append(own[a:b].astype(np.int64))
        out = [part.column("id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
               *(pa.array(x, pa.int64()) for x in (start, length, crc))]
        if keep_ids:
            out.append(pa.array(kept, pa.list_(pa.int64())))
        return pa.RecordBatch.from_arrays(out, ["id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids)
    return T.mapped(rows, T.per_slice(work, "text"), _PIECES + ", ids array<long>" * keep_ids)


class Plan:
    """For each length the first rank, first sequence and offset of every stretch of ranks."""

    def __init__(self, runs: list[Run]):
        used: dict[int, int] = {}
        self.stretches: dict[int, tuple[list, list, list]] = {}
        sequence = 0
        for members, times in sorted(runs, reverse=True):
            offset = 0
            for length in members:
                ranks, sequences, offsets = self.stretches.setdefault(length, ([], [], []))
                ranks.append(used.get(length, 0)), sequences.append(sequence), offsets.append(offset)
                used[length] = used.get(length, 0) + times
                offset += length
            sequence += times

    def place(self, length: int, rank: int) -> tuple[int, int]:
        ranks, sequences, offsets = self.stretches[length]
        i = bisect_right(ranks, rank) - 1
        return sequences[i] + rank - ranks[i], offsets[i]


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id",
                   text_col: str = "text", nodes: int = NODES, keep_ids: bool = False) -> DataFrame:
    """Per piece: id, piece, start, length, ids_crc32, sequence_id, offset (and its ids).

    Every sequence is filled from 0 without gaps to at most ``capacity``.  Null and empty texts are the single end id.
    Repeated rows and null ids are packed like others; ids are whole numbers, others end in Spark's cast error.  Texts of
    any length are tokenised whole, by one task each.  Other columns are not read.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    cut = written(spark, pieces(docs, tokenizer, end_id, capacity, id_col, text_col, keep_ids), "pieces")
    # the table is fixed, so every task sees a row at the same place
    place = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    cut = cut.select("*", place[0].alias("file"), place[1].alias("at")).withColumn(
        "slot", F.xxhash64("file", F.expr(f"at div {SLOT_ROWS}")))
    groups = written(spark, cut.groupBy("length", "slot").agg(F.count(F.lit(1)).alias("n")), "groups")
    counts = {r["length"]: r["n"] for r in groups.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = spark.sparkContext.broadcast(Plan(pack(counts, capacity, nodes)[0]))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("slot")) - F.col("n")
    nth = F.row_number().over(Window.partitionBy("length", "slot").orderBy("file", "at"))
    names = ["id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids
    ranked = (cut.withColumn("nth", nth).join(groups.withColumn("base", before).drop("n"), ["length", "slot"])
              .select(*names, (F.col("base") + F.col("nth") - 1).alias("rank")))

    def run(batches):
        for part in batches:
            placed = [plan.value.place(a, b) for a, b in
                      zip(part.column("length").to_pylist(), part.column("rank").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in names), *(pa.array([p[i] for p in placed], pa.int64()) for i in (0, 1))],
                [*names, "sequence_id", "offset"])
    schema = _PIECES + ", ids array<long>" * keep_ids + ", sequence_id long, offset long"
    return T.mapped(ranked, run, schema).withColumnRenamed("id", id_col)
