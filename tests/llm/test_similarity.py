"""Operators 1, 7 and 8 against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cartwheel.llm import decontaminate, exact_dedup, jaccard_join as J, spread


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute_components(rows, k, num, den):
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))
    def top(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and den * both >= num * len(sets[i] | sets[j]):
                root[top(i)] = top(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[top(i)].append(d)
    return Counter((d, len(sets[i]), min((x for x in least[top(i)] if x is not None), default=None))
                   for i, (d, _) in enumerate(rows))


def variants(seed, n=160):
    rng = random.Random(seed)
    bases = [[f"w{rng.randint(0, 400)}" for _ in range(rng.choice((4, 9, 12, 20, 45, 150)))] for _ in range(12)]
    rows = []
    for d in range(n):
        words = list(rng.choice(bases))
        for _ in range(rng.choice((0, 0, 1, 1, 2, 3))):
            words[rng.randrange(len(words))] = f"x{rng.randint(0, 5000)}"
        rows.append((d * 7 % 1000, " ".join(words)))
    return rows


@pytest.mark.parametrize("k, num, den", [(5, 80, 100)])
def test_components_equal_brute_force(frame, k, num, den):
    rows = variants(k)
    got = J.jaccard_components(frame(rows), words=k, num=num, den=den).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component"]) for r in got) == brute_components(rows, k, num, den)


def test_blocks_and_pivots_alone_lose_nothing(frame, monkeypatch):
    rows = variants(5)
    want = brute_components(rows, 3, 80, 100)
    for rounds, block in ((1, 4),):
        monkeypatch.setattr(J, "ROUNDS", rounds)
        monkeypatch.setattr(J, "BLOCK", block)
        got = J.jaccard_components(frame(rows), words=3, num=80, den=100).collect()
        assert Counter((r["doc_id"], r["n_shingles"], r["component"]) for r in got) == want


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(1)
    for n in (1, 2, 9, 10, 11, 19, 25, 60, 333, 2000):
        for num, den in ((90, 100), (80, 100), (60, 100)):
            a = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64) * np.uint64(2))
            most = J.differing(num, den, n, n)
            b = np.unique(np.concatenate([a[most // 2:], rng.integers(0, 2 ** 63, most // 2).astype(np.uint64)]))
            both = len(np.intersect1d(a, b))
            if den * both >= num * (len(a) + len(b) - both) and len(np.setxor1d(a, b)):
                assert set(J.signatures(a, num, den)) & set(J.signatures(b, num, den)), (n, num)


def test_schemes_enumerate_subsets_where_that_is_cheaper():
    for num, least in ((80, 5), (90, 1)):
        used = [len(J.scheme(num, 100, low, high)[3]) for low, high in J.bands(num, 100, 100_000)
                if J.differing(num, 100, high, high)]
        assert sum(n > 1 for n in used) >= least and used[-1] == 1


def test_few_signatures_are_empty_and_no_similar_sets_are_lost():
    """Sets on a small domain, so that ranges are uneven, against all pairs."""
    rng = np.random.default_rng(8)
    for num, size, domain in ((80, 12, 2 ** 64 - 1), (80, 40, 2 ** 64 - 1), (80, 150, 2 ** 64 - 1), (90, 30, 2 ** 64 - 1),
                              (70, 60, 2 ** 58)):
        base = [np.unique(rng.integers(0, domain, size, np.uint64)) for _ in range(30)]
        sets = list(base)
        for x in base:
            for apart in range(1, size // 4, max(1, size // 12)):
                sets.append(np.unique(np.concatenate([rng.permutation(x)[apart // 2:],
                                                      rng.integers(0, domain, apart // 2 + 1, np.uint64)])))
        signed = [set(J.signatures(x, num, 100).tolist()) for x in sets]
        linked = chance = 0
        for i in range(len(sets)):
            for j in range(i):
                both = len(np.intersect1d(sets[i], sets[j]))
                if 100 * both >= num * (len(sets[i]) + len(sets[j]) - both):
                    linked += 1
                    assert signed[i] & signed[j], (num, size, len(sets[i]), len(sets[j]), both)
                elif not both and domain > 2 ** 63:
                    chance += bool(signed[i] & signed[j])
        assert linked >= 30 and chance < len(sets) ** 2 * 0.004, (linked, chance, len(sets))


def test_pairs_of_a_large_group_that_do_not_link_are_seldom_emitted(frame, monkeypatch):
    rng = random.Random(4)
    rows = []
    for d in range(60):                          # 1770 pairs just below the threshold that share many signatures
        words = [f"w{i}" for i in range(600)]
        for at in rng.sample(range(600), 8):
            words[at] = f"x{d}.{at}"
        rows.append((d, " ".join(words)))
    emitted, meetings = [], J._meetings
    monkeypatch.setattr(J, "_meetings", lambda *a: emitted.append(meetings(*a).count()) or meetings(*a))
    got = J.jaccard_components(frame(rows), words=5, num=80, den=100).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component"]) for r in got) == brute_components(rows, 5, 80, 100)
    assert emitted and sum(emitted) < 900, emitted


def test_of_signatures_with_the_same_holders_one_is_compared(spark):
    given = {10: (1, 2, 3), 11: (1, 2, 3), 12: (1, 2), 13: (3, 2, 1), 14: (2, 3), 15: (4, 5)}
    held = spark.createDataFrame([(s, fp, 9) for s, fps in given.items() for fp in fps], "sig long, fp long, n long")
    mixed, met = J._mixed(held, spark.createDataFrame([(5, 4)], "fp long, root long"))
    assert sorted((r["sig"], r["fp"]) for r in mixed.collect()) == [(s, fp) for s in (10, 12, 14) for fp in sorted(given[s])]
    assert met == (3 * 9 + 2 * 4) / 13


def test_a_pair_is_met_where_it_first_shares_a_signature(spark, monkeypatch):
    monkeypatch.setattr(J, "RECENT", 2)
    rng = random.Random(2)
    for density in (0.1, 0.9):
        signed = {fp: [s for s in range(40) if rng.random() < density] or [0] for fp in range(1, 25)}
        holders = spark.createDataFrame([(s, fp, 9, fp) for fp, sigs in signed.items() for s in sigs],
                                        "sig long, fp long, n long, root long")
        sketches = spark.createDataFrame([(fp, 9, fp, *[0] * J.SKETCH, [0] * J.SKETCH) for fp in signed],
                                         "fp long, n long, id long, " + ", ".join(f"{c} long" for c in J._BITS) + ", wide array<long>")
        want = {(a, b) for a in signed for b in signed if a < b and set(signed[a]) & set(signed[b])}
        assert sorted((*r,) for r in J._in_blocks(holders, sketches, 80, 100, []).collect()) == sorted(want)


def test_wide_sketches_in_sql_tell_what_they_tell_in_tasks(spark):
    rng = np.random.default_rng(3)
    rows, want = [], []
    for n, m in ((400, 420), (1000, 1040), (1100, 1000), (1020, 1030), (30, 5000), (2000, 2060)):
        a = rng.integers(0, 2 ** 63, max(n, m)).astype(np.uint64)
        for apart in (0.05, 0.1, 0.2, 0.6):
            one, two = np.unique(a[:n]), np.unique(np.concatenate([a[int(m * apart):m],
                                                                   rng.integers(0, 2 ** 63, int(m * apart)).astype(np.uint64)]))
            x, y = J.wide_sketch(one), J.wide_sketch(two)
            rows.append((len(want), *(np.frombuffer(w, np.int64).tolist() for w in (x, y)), len(one), len(two)))
            ratio = max(len(x), len(y)) // min(len(x), len(y))
            want.append(ratio > 2 or 180 * J.least_apart(x, y) <= 20 * (len(one) + len(two)))
    rows.append((len(want), None, rows[0][2], 400, 420))
    want.append(True)
    got = spark.createDataFrame(rows, "at int, awide array<long>, bwide array<long>, an long, bn long").selectExpr(
        "at", J._possible_by_wide(80, 100) + " AS possible").collect()
    assert [r["possible"] for r in sorted(got)] == want and set(want) == {True, False}


def test_sketches_never_tell_too_much():
    rng = np.random.default_rng(6)
    for n, m in ((1, 1), (5, 700), (600, 500), (3000, 2900), (4096, 4097)):
        a, b = (np.unique(rng.integers(0, 5000, k).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for k in (n, m))
        assert J.least_apart(J.wide_sketch(a), J.wide_sketch(b)) <= len(np.setxor1d(a, b))
        assert J.least_apart(J.wide_sketch(a), J.wide_sketch(a)) == 0


def test_components_of_odd_rows(odd, frame):
    got = J.jaccard_components(odd, words=3, num=80, den=100)
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert Counter((r["doc_id"], r["n_shingles"], r["component"]) for r in got.collect()) == brute_components(
        rows, 3, 80, 100)
    assert J.jaccard_components(frame([])).count() == 0


def test_long_chain_is_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (102, 101)], "a long, b long")
    got = {r["fp"]: r["root"] for r in J.components(links).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {101: 100, 102: 100}


def test_exact_groups(odd, frame):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    groups = defaultdict(list)
    for d, t in rows:
        groups[t or ""].append(d)
    got = exact_dedup.exact_groups(odd).collect()
    assert len(got) == len(rows)
    keep = {t: max((d for d in ds if d is not None), default=None) for t, ds in groups.items()}
    want = Counter((d, keep[t or ""], len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest())
                   for d, t in rows)
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == want
    assert Counter(r["text_sha256"] for r in got if r["kept"]) == Counter(
        hashlib.sha256(t.encode()).hexdigest() for t in groups)
    assert exact_dedup.exact_groups(frame([])).count() == 0


def brute_groups(rows):
    groups = defaultdict(list)
    for d, t in rows:
        groups[t or ""].append(d)
    return Counter((d, max((x for x in groups[t or ""] if x is not None), default=None), len(groups[t or ""]),
                    hashlib.sha256((t or "").encode()).hexdigest()) for d, t in rows)


def test_colliding_keys_are_chained_and_compared(odd, frame):
    rng = random.Random(9)
    rows = [(rng.randint(0, 80) or None, rng.choice("abcdefgh") * rng.randint(0, 2)) for _ in range(300)] + [(5, "hot")] * 400
    docs = frame(rows)
    for weak in (lambda t: (F.length(t) % 2).cast("long"), lambda t: F.shiftleft(F.length(t).cast("long"), 61)):
        got = exact_dedup.exact_groups(docs, capacity=3, hashed=weak).collect()
        assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == brute_groups(rows)
        index = exact_dedup.build_index(docs, capacity=3, hashed=weak).collect()
        chains = defaultdict(list)
        for r in index:
            chains[r["key"]].append(r["chain"])
        assert max(map(len, chains.values())) > 4
        assert all(sorted(c) == list(range(1, len(c) + 1)) for c in chains.values())


def test_a_row_repeated_many_times_is_dealt_out_in_parts(spark):
    rows = spark.range(2_500_001).selectExpr("3 AS doc_id", "'same' AS text")
    got = exact_dedup.exact_groups(rows).groupBy("doc_id", "keep_id", "group_size", "kept").count().collect()
    assert sorted((*r,) for r in got) == [(3, 3, 2_500_001, False, 2_500_000), (3, 3, 2_500_001, True, 1)]


def test_directory_splits_overfull_buckets(spark):
    keys = spark.range(3000).selectExpr("xxhash64(id) AS key").union(spark.range(5).selectExpr("shiftleft(id, 2) AS key"))
    slots, depth = exact_dedup.directory(keys, 40)
    held = keys.withColumn("slot", exact_dedup._slot(depth)).join(slots, "slot").groupBy("bucket", "depth").count().collect()
    assert sum(r["count"] for r in held) == 3005 and max(r["count"] for r in held) <= 40
    # a bucket is split only where its parent would be overfull
    for r in held:
        if r["depth"]:
            low = r["bucket"] >> (depth - r["depth"] + 1) << (depth - r["depth"] + 1)
            high = low + (1 << (depth - r["depth"] + 1))
            assert sum(x["count"] for x in held if low <= x["bucket"] < high) > 40


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def brute_hits(text, items, n=10):
    own, hit, names = words(text), set(), set()
    for name, item in items:
        w = words(item)
        size = min(n, len(w))
        for i in range(len(w) - size + 1 if size else 0):
            for j in range(len(own) - size + 1):
                if own[j:j + size] == w[i:i + size]:
                    hit |= set(range(j, j + size))
                    names.add("" if name is None else str(name))
    return len(own), len(hit), sorted(names)


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_decontamination_equals_brute_force(spark, odd, frame, block_bytes):
    items = [(3, "One, two; THREE four five six seven eight nine ten eleven"), (20, "two words"), (100, ""), (None, "end"),
             (7, None), (3, "emoji"), (8, "É é")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find(odd, bench, block_bytes=block_bytes).collect()
    short = [(r["doc_id"], r["text"]) for r in odd.collect() if len(r["text"] or "") < 1000]
    have = Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in got if r["n_words"] < 1000)
    assert {(d, *brute_hits(t, items)[:2], tuple(brute_hits(t, items)[2])) for d, t in short} <= set(have)
    assert len(got) == odd.count()
    assert decontaminate.find(frame([]), bench).count() == 0
    assert {r["n_hit"] for r in decontaminate.find(odd, bench.limit(0)).collect()} == {0}


def test_blocks_of_the_benchmark_are_bounded(spark, frame, monkeypatch):
    blocks, real = [], decontaminate._scan
    def kept(rows, block, *more):
        blocks.append(block)
        return real(rows, block, *more)
    monkeypatch.setattr(decontaminate, "_scan", kept)
    items = [(i, f"item number {i} of the benchmark") for i in range(40)] + [(99, "alpha beta gamma delta")] * 60
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = frame([(1, "an alpha beta gamma delta"), (2, "item number 7 of the benchmark"), (3, "nothing")])
    got = decontaminate.find(docs, bench, block_windows=60).collect()
    assert {r["doc_id"]: r["items"] for r in got} == {1: ["99"], 2: ["7"], 3: []}
    assert len(blocks) > 1 and sum(map(len, blocks)) == 41
    assert max(sum(len(words(t)) for _, t in b) for b in blocks) <= 120


def test_windows_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(decontaminate.T, "windows", lambda h, n: np.zeros(max(0, len(h) - n + 1), np.uint64))
    items = [("1", "a b c d"), ("2", "x a b c"), ("2", "a b c"), ("3", "q"), ("4", ""), ("5", "b c d")]
    grams, text = decontaminate.Grams(items, 3), "a b c d q x"
    T = decontaminate.T
    data, offsets = T.utf8(pa.array([text], pa.string()))
    starts, ends, bounds = T.words(data, offsets, decontaminate.WORD)
    hits = list(grams.hits(data.tobytes(), starts, ends, bounds, T.range_hashes(data, starts, ends)))
    assert {(first, n): set(names) for _, first, n, names in hits} == {
        (0, 3): {"1", "2"}, (1, 3): {"1", "5"}, (4, 1): {"3"}}


def test_decontamination_removes_documents_or_spans(spark, frame):
    bench = spark.createDataFrame([(1, "alpha beta gamma delta")], "item_id long, text string")
    docs = frame([(1, "start alpha, BETA gamma-delta end"), (2, "alpha beta gamma"), (3, None)])
    assert {r["doc_id"] for r in decontaminate.clean(docs, bench).collect()} == {2, 3}
    cut = decontaminate.clean(docs, bench, "spans")
    assert cut.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in cut.collect()} == {1: "start  end", 2: "alpha beta gamma", 3: None}


def test_components_of_chains_cliques_and_stars_however_little_a_task_contracts(spark, monkeypatch):
    rng = np.random.default_rng(4)
    pairs = [(i, i + 1) for i in range(40)] + [(100 + i, 100 + j) for i in range(12) for j in range(i)]
    pairs += [(200, 201 + i) for i in range(30)] + [(int(a), int(b)) for a, b in rng.integers(300, 420, (90, 2))]
    pairs += [(7, 7)] + pairs[:50]
    top = {x: x for p in pairs for x in p}
    for _ in top:
        for a, b in pairs:
            top[a] = top[b] = min(top[a], top[b])
    want = {x: r for x, r in top.items() if x != r}
    for forest in (1, J.FOREST):
        monkeypatch.setattr(J, "FOREST", forest)
        links = spark.createDataFrame(pairs, "a long, b long").repartition(5)
        got = [tuple(r) for r in J.components(links).select("fp", "root").collect()]
        assert len(got) == len(want) and dict(got) == want


def tables_written(spark, monkeypatch, rows, frame, words=3, num=80):
    """The components of the rows, and the names of the tables that the search writes."""
    names, plain = [], J.written

    def noted(spark, frame, name):
        names.append(name)
        return plain(spark, frame, name)
    monkeypatch.setattr(J, "written", noted)
    got = J.jaccard_components(frame(rows), words=words, num=num, den=100).collect()
    return Counter((r["doc_id"], r["n_shingles"], r["component"]) for r in got), names


def test_search_takes_few_tables_and_loses_nothing(spark, frame, monkeypatch):
    rows = variants(5)
    got, names = tables_written(spark, monkeypatch, rows, frame)
    assert got == brute_components(rows, 3, 80, 100)
    # one turn with pivots, then the blocks
    assert names.count("pivots") == 1 and names.count("blocked") == 1 and names.count("roots") <= 2


def test_holders_that_meet_many_others_take_the_second_turn(spark, frame, monkeypatch):
    rows = variants(5)
    monkeypatch.setattr(J, "BLOCK", 1)
    got, names = tables_written(spark, monkeypatch, rows, frame)
    assert got == brute_components(rows, 3, 80, 100)
    assert names.count("pivots") == 2


def test_a_screened_pair_costs_two_lookups(spark):
    sketches = spark.createDataFrame([(i, 3, i, *[0] * J.SKETCH, bytearray(64)) for i in range(4)],
                                     "fp long, n long, id long, " + ", ".join(f"{c} long" for c in J._BITS) + ", wide binary")
    pairs = spark.createDataFrame([(0, 1), (2, 3)], "a long, b long")
    found = J._screened(pairs, sketches, 80, 100)
    assert sorted(map(tuple, found.select("a", "b", "aid", "bid").collect())) == [(0, 1, 0, 1), (2, 3, 2, 3)]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 2


def test_few_keys_are_joined_without_a_shuffle_of_the_rows(spark, monkeypatch):
    rows = spark.createDataFrame([(i % 7, i) for i in range(50)] + [(None, 1), (99, 1)], "key long, i long")
    per_key = rows.groupBy("key").agg(F.count(F.lit(1)).alias("copies")).where("key < 90")
    want = Counter(map(tuple, spread.join_key(rows, per_key, "key", "copies").collect()))
    few = spread.join_key(rows, per_key, "key", "copies", narrow=True)
    assert Counter(map(tuple, few.collect())) == want and sum(want.values()) == 50
    assert few._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
    monkeypatch.setattr(spread, "FEW_KEYS", 3)
    assert Counter(map(tuple, spread.join_key(rows, per_key, "key", "copies", narrow=True).collect())) == want
