"""Clusters of integer vectors around centroids, searched progressively in Walsh-Hadamard coefficients (operator 12).

The transform with entries 1 and -1 keeps integers exact, and squared distances between transforms are ``width`` times
those between vectors.  Vectors are transformed once.  In every round the coefficient differences of a vector and all
centroids are added up from coarse (few sign changes) to fine.  After the coarsest ones the leading centroid is finished;
a centroid whose partial sum is already strictly above that whole distance is worse and drops out, checked again after
every finer group.  What is left has all coefficients, so its distance and every tie are exact.

Each round is one scan: tasks add up coefficients per cluster, and the driver gets ``k`` times ``width`` sums.  The transform
is linear, so the sums of the vectors themselves come back from those.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cartwheel.llm import text as T, vectors as V
from cartwheel.llm.spread import written

#: scaled components stay below this, so that every transform fits 64 bits
LARGEST = 1 << 46
#: where no coefficient is larger, squared distances of up to 64 coefficients fit 64 bits as well
PLAIN = 1 << 27


def transform(rows: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of every row, coefficients by their number of sign changes."""
    n, width = rows.shape
    out, step = rows, 1
    while step < width:
        pairs = out.reshape(n, -1, 2, step)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, width)
        step *= 2
    return out[:, _order(width)]


def _order(width: int) -> np.ndarray:
    """Rows of the matrix by their number of sign changes."""
    bits = np.bitwise_count(np.arange(width)[:, None] & np.arange(width)) & 1
    return np.argsort((bits[:, 1:] != bits[:, :-1]).sum(axis=1))


def inverse(sums: list[int]) -> list[int]:
    """The vector whose transform this is."""
    width = len(sums)
    plain = [0] * width
    for place, value in zip(_order(width), sums):
        plain[place] = value
    # in its own order the matrix is its own inverse, times the width
    own = np.array([plain], object)
    back = np.empty(width, object)
    back[_order(width)] = transform(own)[0]
    return [int(v) // width for v in back]


def nearest(rows: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For transformed rows the number of the nearest centre, the smallest of equally near ones, and ``width`` times the
    squared distance."""
    n, width = rows.shape
    largest = max([int(np.abs(x).max()) for x in (rows, centres) if x.size], default=0)
    if largest >= PLAIN or width > 64:
        rows, centres = rows.astype(object), centres.astype(object)
    kind = rows.dtype
    total = np.zeros((n, len(centres)), kind)
    alive = np.ones((n, len(centres)), bool)
    whole = np.zeros(n, kind)
    at, size = 0, min(8, width)
    while at < width:
        for c, centre in enumerate(centres):
            those = slice(None) if alive[:, c].all() else np.flatnonzero(alive[:, c])
            apart = rows[those, at:at + size] - centre[at:at + size]
            total[those, c] += (apart * apart).sum(axis=1)
        if not at:
            apart = rows - centres[np.argmin(total, axis=1)]
            whole = (apart * apart).sum(axis=1)
        at, size = at + size, at + size
        alive &= total <= whole[:, None]
    # partial sums of those that dropped out are above the distance of the leader
    best = np.argmin(total, axis=1)
    return best, total[np.arange(n), best]


def _totals(table: DataFrame, centres: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Per cluster that has vectors, how many, and the sums of their coefficients."""
    width = centres.shape[1]
    shared = table.sparkSession.sparkContext.broadcast(centres)

    def run(batches):
        counts = np.zeros(len(shared.value), np.int64)
        sums = np.zeros((len(shared.value), width), object)
        for part in batches:
            rows = V.unpacked(part.column("coefs"), np.int64, width)
            found, _ = nearest(rows, shared.value)
            for c in np.unique(found):
                own = rows[found == c]
                counts[c] += len(own)
                # halves of 32 bits: their sums stay far below 64 bits, whatever the size of a batch
                sums[c] += (own >> 32).sum(axis=0).astype(object) * (1 << 32) + (own & 0xFFFFFFFF).sum(axis=0).astype(object)
        full = np.flatnonzero(counts)
        values = [[int(counts[c]), *map(int, sums[c])] for c in full]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(full, width + 1), pa.int32()), pa.array(list(range(width + 1)) * len(full), pa.int32()),
             pa.array([str(v) for own in values for v in own], pa.string())], ["cluster", "place", "value"])
    parts = table.select("coefs").mapInArrow(run, "cluster int, place int, value string")
    out: dict[int, list[int]] = {}
    for r in parts.groupBy("cluster", "place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("v")).collect():
        out.setdefault(r["cluster"], [0] * (width + 1))[r["place"]] = int(r["v"])
    return {c: (v[0], v[1:]) for c, v in out.items()}


def cluster(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", width: int = 64, scale: int = 1024,
            k: int = 8, rounds: int = 10, salt: str = "3:") -> DataFrame:
    """Per kept vector: id, cluster, distance (squared, to the final centroid), cluster_inertia and inertia (distances
    added up over the cluster and over all) and centroid (its components).

    Kept are vectors of ``width`` components (a power of two), none null or not finite; each component x becomes
    floor(scale * x).  Null, empty and other vectors give no row; an empty table gives none.  The k kept rows whose
    lower-case hex sha256 of salt and id is smallest start as centroids; null ids come last, ties go by components, and
    with fewer rows there are fewer centroids.  Repeated rows each count and each get a row.  Other columns are not read.
    Scaled components must be below 2^46, larger ones are not kept; a distance beyond a long is null, and so are the
    sums it enters.
    """
    spark = rows.sparkSession
    rows = rows.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    kept = rows.where(f"size(v) = {width} and {V.finite('v')} and forall(v, x -> abs(x) * {scale} < {LARGEST})")

    def prepare(batches):
        for part in batches:
            scaled = np.floor(V.matrix(part.column("v"), width) * scale).astype(np.int64)
            yield pa.RecordBatch.from_arrays([part.column("id"), V.packed(transform(scaled))], ["id", "coefs"])
    kind = dict(rows.dtypes)["id"]
    table = written(spark, kept.mapInArrow(prepare, f"id {kind}, coefs binary"), "coefs")
    key = F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256)
    seeds = table.orderBy(key.asc_nulls_last(), "coefs").limit(k).select("coefs").toArrow()
    centres = V.unpacked(seeds.column("coefs").combine_chunks(), np.int64, width)
    for _ in range(rounds if len(centres) else 0):
        for c, (n, sums) in _totals(table, centres).items():
            mean = np.array([[v // n for v in inverse(sums)]], np.int64)
            centres[c] = transform(mean)[0]
    shared = spark.sparkContext.broadcast(centres)

    def assign(batches):
        for part in batches:
            found, far = nearest(V.unpacked(part.column("coefs"), np.int64, width), shared.value)
            far = far // width
            if far.dtype == object:
                far = [int(v) if v < 1 << 63 else None for v in far]
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(found, pa.int32()), pa.array(far, pa.int64())],
                                             ["id", "cluster", "distance"])
    if not len(centres):
        found = table.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
    else:
        found = written(spark, table.mapInArrow(assign, f"id {kind}, cluster int, distance long"), "clusters")
    # a few rows: one for each centroid
    sums = {r["cluster"]: int(r["s"]) if r["whole"] else None for r in found.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(20,0)")).alias("s"),
        (F.count("distance") == F.count(F.lit(1))).alias("whole")).collect()}
    long = lambda v: v if v is not None and v < 1 << 63 else None
    inertia = long(None if None in sums.values() else sum(sums.values()))
    per = [(c, long(sums.get(c)), inertia, inverse([int(v) for v in centres[c]])) for c in range(len(centres))]
    per = spark.createDataFrame(per, "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return found.join(F.broadcast(per), "cluster").select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia",
                                                          "inertia", "centroid")
