"""Nearest neighbours by largest inner product, as a join of int8 matrix blocks (operator 13).

Every vector x is a step times small integers plus a rest: x = s * q + e, with entries of q from -127 to 127.  The product
of two vectors lies within ``|s q| |e'| + |e| |x'|`` of ``s s' (q . q')``, so a tile of integer products gives every pair an
upper and a lower bound.  Tiles are multiplied as single-precision matrices, which hold integers of this size exactly.

Queries are dealt to blocks of about ``query_block`` rows and all rows to groups of about ``block``; a tile is one block
met with one group, and tiles are what Spark shuffles.  In a task a tile's queries come first, its candidates then pass in
batches.  A pair whose upper bound is below the query's k-th best so far is out; the others are multiplied again in
double precision, component after component, and enter the query's heap.  Of many candidates with one vector only as many
as a heap can hold are met.  At the end the heaps of a query's tiles merge.
Bounds hold for every pair, so the result is exact: recall is 1 by construction.
"""

from __future__ import annotations

from heapq import heappush, heapreplace
from math import ceil, inf

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from cartwheel.llm import vectors as V
from cartwheel.llm.spread import written

#: queries multiplied at a time, which bounds a tile's arrays
STRIP = 256
#: pairs multiplied again at a time
AGAIN = 1 << 16
#: above the rounding of a product of a few thousand components, relative to the norms
ROUNDING = 1e-12


def quantised(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes, step, norm of the rest and norm of every row; rows are neither zero nor without components."""
    top = np.abs(rows).max(axis=1)
    step = top / 127
    step = np.where(step > 0, step, top)                  # of the smallest numbers there are
    codes = np.rint(rows / step[:, None]).astype(np.int8)
    rest = np.linalg.norm(rows - codes * step[:, None], axis=1)
    norm = np.linalg.norm(rows, axis=1)
    return codes, step, rest * (1 + ROUNDING) + norm * ROUNDING, norm * (1 + ROUNDING)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of paired rows in double precision, added up from the first component to the last."""
    out = np.zeros(len(a))
    for i in range(a.shape[1]):
        out += a[:, i] * b[:, i]
    return out


class Block:
    """The queries of a tile with vectors of one width, and the best of each so far."""

    def __init__(self, part: dict[str, np.ndarray], k: int):
        self.part, self.k = part, k
        self.heaps: list[list] = [[] for _ in part["row"]]
        self.least = np.full(len(self.heaps), -inf)       # the k-th best score, once there are k

    def meet(self, other: dict[str, np.ndarray]) -> None:
        """All pairs of the block's queries and these candidates, a strip of queries at a time."""
        codes = other["codes"].astype(np.float32).T
        for at in range(0, len(self.heaps), STRIP):
            own = slice(at, at + STRIP)
            p = {c: v[own] for c, v in self.part.items()}
            about = (p["codes"].astype(np.float32) @ codes) * (p["step"][:, None] * other["step"])
            off = (p["norm"] + p["rest"])[:, None] * other["rest"] + p["rest"][:, None] * other["norm"]
            least = self.least[own]
            if len(other["row"]) > self.k + 1 and np.isinf(least).any():
                # one more than k, as the query's own row may be among them
                low = np.partition(about - off, -self.k - 1, axis=1)[:, -self.k - 1]
                least = np.fmax(least, low)
            q, c = np.nonzero(~(about + off < least[:, None]))
            different = p["row"][q] != other["row"][c]
            q, c = q[different], c[different]
            for first in range(0, len(q), AGAIN):
                self._enter(at, p, least, other, q[first:first + AGAIN], c[first:first + AGAIN])

    def _enter(self, at: int, p: dict, least: np.ndarray, other: dict, q: np.ndarray, c: np.ndarray) -> None:
        scores = products(p["vector"][q], other["vector"][c])
        near = scores >= least[q]
        for i, score, name in zip((q[near] + at).tolist(), scores[near].tolist(), other["key"][c[near]].tolist()):
            heap = self.heaps[i]
            if len(heap) < self.k:
                heappush(heap, (score, name))
            elif (score, name) > heap[0]:
                heapreplace(heap, (score, name))
            if len(heap) == self.k:
                self.least[i] = heap[0][0]


def _arrays(part: pa.RecordBatch, width: int) -> dict[str, np.ndarray]:
    out = {c: part.column(c).to_numpy() for c in ("row", "step", "rest", "norm")}
    out["vector"] = V.unpacked(part.column("vector"), np.float64, width)
    out["codes"] = V.unpacked(part.column("codes"), np.int8, width)
    # the larger, the sooner of equal scores: minus the id, and null ids last
    ids = part.column("id")
    out["key"] = np.array([-inf if v is None else -v for v in ids.to_pylist()], object)
    return out


def _few_copies(rows: dict[str, np.ndarray], k: int) -> dict[str, np.ndarray]:
    """Of candidates with one vector the k + 1 that win ties: no query takes more of them, its own row left out."""
    vectors = rows["vector"]
    whole = np.ascontiguousarray(vectors).view(np.dtype((np.void, vectors.shape[1] * 8))).ravel()
    _, group, copies = np.unique(whole, return_inverse=True, return_counts=True)
    if copies.max() <= k + 1:
        return rows
    keep = (copies <= k + 1)[group]
    for g in np.flatnonzero(copies > k + 1):
        own = np.flatnonzero(group == g)
        keep[sorted(own.tolist(), key=lambda i: rows["key"][i], reverse=True)[:k + 1]] = True
    return {c: v[keep] for c, v in rows.items()}


def _tiles(k: int):
    """For ``mapInArrow`` over rows sorted by tile and kind: the k best candidates of every query within its tile."""
    def finished(blocks: dict[int, Block]):
        for block in blocks.values():
            found = [(i, score, None if key == -inf else -key) for i, heap in enumerate(block.heaps) for score, key in heap]
            if found:
                at, scores, ids = zip(*found)
                own = np.array(at)
                names = block.part["key"][own].tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block.part["row"][own]), pa.array([None if v == -inf else -v for v in names], pa.int64()),
                     pa.array(ids, pa.int64()), pa.array(scores, pa.float64())], ["row", "query_id", "id", "score"])

    def run(batches):
        tile, parts, blocks = None, {}, {}
        for batch in batches:
            place = np.stack([batch.column(c).to_numpy() for c in ("tile", "kind", "width")])
            edges = [0, *(np.flatnonzero((place[:, 1:] != place[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for first, end in zip(edges, edges[1:]):
                if first == end:
                    continue
                now, kind, width = (int(v) for v in place[:, first])
                if now != tile:
                    yield from finished(blocks)
                    tile, parts, blocks = now, {}, {}
                rows = _arrays(batch.slice(first, end - first), width)
                if kind == 0:
                    parts.setdefault(width, []).append(rows)
                    continue
                if width in parts:
                    own = parts.pop(width)
                    blocks[width] = Block({c: np.concatenate([x[c] for x in own]) for c in own[0]}, k)
                if width in blocks:
                    blocks[width].meet(_few_copies(rows, k))
        yield from finished(blocks)
    return run


def nearest(rows: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
            query_block: int = 8192, block: int = 32768) -> DataFrame:
    """For every row that is a query, the k other rows of largest inner product: query_id, rank (from 1), id, score.

    Ids are whole numbers.  Nearest come first, ties go to the smaller id, null ids last.  Vectors that are null, empty,
    zero or hold null or non-finite components take no part; vectors of different widths don't meet.  With fewer
    candidates there are fewer ranks.  A repeated row is a candidate for its copies and a query of its own, so its answers
    come once for each copy.  Other columns are read by ``is_query`` only.  An empty table gives no rows.  Products beyond
    the range of doubles count as what double arithmetic makes of them.
    """
    spark = rows.sparkSession
    table = rows.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"),
                        F.coalesce(is_query, F.lit(False)).alias("asks"), F.col(vector_col).cast("array<double>").alias("v"))
    table = table.withColumn("width", F.size("v")).where(f"{V.finite('v')} and exists(v, x -> x != 0)")

    def prepare(batches):
        for part in batches:
            widths = part.column("width").to_numpy()
            for width in np.unique(widths).tolist():
                own = part.filter(pa.array(widths == width))
                vectors = V.matrix(own.column("v"), width)
                codes, *numbers = quantised(vectors)
                yield pa.RecordBatch.from_arrays(
                    [*(own.column(c) for c in ("row", "id", "asks", "width")), V.packed(vectors), V.packed(codes),
                     *map(pa.array, numbers)], ["row", "id", "asks", "width", "vector", "codes", "step", "rest", "norm"])
    # row numbers are written down, so a task that runs again deals the same rows
    table = written(spark, table.mapInArrow(
        prepare, "row long, id long, asks boolean, width int, vector binary, codes binary, step double, rest double, norm double"),
        "vectors")
    every, asking = table.agg(F.count(F.lit(1)), F.count(F.when(F.col("asks"), 1))).first()
    blocks = max(1, ceil(asking / query_block))
    groups = max(1, ceil(every / block), ceil(2 * spark.sparkContext.defaultParallelism / blocks))

    def dealt(name: str, n: int) -> Column:
        return F.pmod(F.xxhash64("row", F.lit(name)), F.lit(n))

    def every_one(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    columns = ["kind", "row", "id", "width", "vector", "codes", "step", "rest", "norm"]
    asked = (table.where("asks").withColumn("kind", F.lit(0)).withColumn("b", dealt("block", blocks))
             .withColumn("g", every_one(groups)))
    offered = table.withColumn("kind", F.lit(1)).withColumn("g", dealt("group", groups)).withColumn("b", every_one(blocks))
    tiles = asked.unionByName(offered).select((F.col("b") * groups + F.col("g")).alias("tile"), *columns)
    tasks = min(blocks * groups, max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1) * 16)
    found = (tiles.repartition(tasks, "tile").sortWithinPartitions("tile", "kind", "width")
             .mapInArrow(_tiles(k), "row long, query_id long, id long, score double"))
    order = Window.partitionBy("row").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", F.col("id").alias(id_col), "score")
