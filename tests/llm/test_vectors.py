"""Operators 12 and 13 against brute force."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F, types as S

from cartwheel.llm import centroids as C, matrix_join as M

ROWS = S.StructType([S.StructField("vec_id", S.LongType()), S.StructField("embedding", S.ArrayType(S.DoubleType())),
                     S.StructField("id", S.StringType()), S.StructField("cluster", S.StringType()),
                     S.StructField("row", S.StringType()), S.StructField("score", S.StringType())])


@pytest.fixture(scope="session")
def vectors(spark):
    return lambda rows: spark.createDataFrame([(i, v, "i", "c", "r", "s") for i, v in rows], ROWS).repartition(4)


def some(n=300, width=64, seed=2):
    rng = np.random.default_rng(seed)
    around = rng.normal(size=(9, width))
    out = [(int(i), (around[rng.integers(9)] + rng.normal(size=width) * 0.4).tolist()) for i in rng.permutation(n)]
    hot = out[3][1]
    return out + [(int(i) + n, hot) for i in range(n // 3)]      # one vector holds many rows


ODD = [(None, [0.5] * 64), (None, [0.5] * 64), (9000, None), (9001, []), (9002, [1.0] * 63), (9003, [1.0] * 63 + [None]),
       (9004, [math.nan] + [1.0] * 63), (9005, [math.inf] + [1.0] * 63), (9006, [0.0] * 64), (9007, [-0.0001] * 64),
       (20, [1.0] * 65), (40, [2.0] * 65), (9020, [1e-300] * 64), (9040, [3.0] * 64), (9040, [3.0] * 64)]


def brute_clusters(rows, k=8, rounds=10):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest())
    centres = [v for _, v in sorted(kept, key=key)[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v: min((far(v, c), n) for n, c in enumerate(centres))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        for n in set(own):
            those = [v for (_, v), o in zip(kept, own) if o == n]
            centres[n] = [sum(x) // len(those) for x in zip(*those)]
    last = [(i, *near(v)) for i, v in kept]
    sums = Counter()
    for _, d, n in last:
        sums[n] += d
    return Counter((i, n, d, sums[n], sum(sums.values()), tuple(centres[n])) for i, d, n in last)


def listed(frame):
    return Counter((r["vec_id"], r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], tuple(r["centroid"]))
                   for r in frame.collect())


@pytest.mark.parametrize("rows", [some() + ODD, some(40), [(i, [float(i % 3)] * 64) for i in range(30)], [(1, [1.5] * 64)],
                                  [(i, [1e9 * (i % 5) - i] * 64) for i in range(40)]])
def test_clusters_equal_brute_force(vectors, rows):
    want = Counter({(i, n, d if d < 1 << 63 else None, s if s < 1 << 63 else None, t if t < 1 << 63 else None, c): times
                    for (i, n, d, s, t, c), times in brute_clusters(rows).items()})
    assert listed(C.cluster(vectors(rows))) == want


def test_no_vector_no_cluster(vectors):
    assert C.cluster(vectors([])).collect() == []
    assert C.cluster(vectors([(9002, [1.0]), (1, None)])).collect() == []
    far = C.cluster(vectors([(1, [1e30] * 64), (2, [1.0] * 64)])).collect()
    assert [r["vec_id"] for r in far] == [2]


def test_transform_is_exact_and_orthogonal():
    rng = np.random.default_rng(0)
    rows = rng.integers(-1 << 46, 1 << 46, (50, 64))
    there = C.transform(rows)
    assert [C.inverse(r.tolist()) for r in there] == rows.tolist()
    small = rng.integers(-1000, 1000, (2, 64))
    a, b = C.transform(small)
    assert ((a - b) ** 2).sum() == 64 * ((small[0] - small[1]) ** 2).sum()
    changes = [(np.diff(np.sign(C.transform(np.eye(64, dtype=np.int64))[:, i])) != 0).sum() for i in range(64)]
    assert changes == list(range(64))


@pytest.mark.parametrize("size", [5, 1000, 1 << 50])
def test_progressive_search_equals_whole_distances(size):
    rng = np.random.default_rng(3)
    rows, centres = (rng.integers(-size, size, (n, 64)) for n in (400, 12))
    centres[7] = centres[2]
    rows[:50] = centres[rng.integers(0, 12, 50)]
    whole = ((rows[:, None].astype(object) - centres.astype(object)) ** 2).sum(axis=2)
    found, far = C.nearest(rows, centres)
    assert found.tolist() == whole.argmin(axis=1).tolist()
    assert far.tolist() == whole.min(axis=1).tolist()


def brute_nearest(rows, k):
    sound = [(n, i, v) for n, (i, v) in enumerate(rows)
             if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = Counter()
    for n, i, v in sound:
        if i is None or i % 20:
            continue
        found = []
        for m, j, w in sound:
            if m != n and len(w) == len(v):
                s = 0.0
                for x, y in zip(v, w):
                    s += x * y
                found.append((-s, j is None, j))
        out.update((i, rank, j, -s) for rank, (s, _, j) in enumerate(sorted(found, key=lambda f: f[:2] + (f[2] or 0,))[:k], 1))
    return out


@pytest.mark.parametrize("k, query_block, block", [(20, 8192, 32768), (3, 4, 30)])
def test_neighbours_equal_brute_force(vectors, k, query_block, block):
    rows = some() + ODD + [(i, [1.0, float(i % 4), 0.5]) for i in range(0, 300, 7)] + [(60, [5e-324] * 2), (61, [1.0, 2.0])]
    got = M.nearest(vectors(rows), F.col("vec_id") % 20 == 0, k, query_block=query_block, block=block).collect()
    assert Counter((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == brute_nearest(rows, k)


def test_no_query_no_neighbour(vectors):
    asks = F.col("vec_id") % 20 == 0
    assert M.nearest(vectors([]), asks).collect() == []
    assert M.nearest(vectors([(1, [1.0]), (2, [2.0])]), asks).collect() == []
    assert M.nearest(vectors([(20, [1.0]), (2, None)]), asks).collect() == []


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(5)
    rows = rng.normal(size=(500, 64)) * np.exp(rng.normal(size=(500, 1)) * 3)
    codes, step, rest, norm = M.quantised(rows)
    about = (codes.astype(np.int64) @ codes.astype(np.int64).T) * (step[:, None] * step)
    off = (norm + rest)[:, None] * rest + rest[:, None] * norm
    true = np.array([M.products(np.repeat(rows[i:i + 1], 500, 0), rows) for i in range(500)])
    assert (np.abs(true - about) <= off).all()
    assert np.median(off / (norm[:, None] * norm)) < 0.03
