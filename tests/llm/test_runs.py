"""Operator 11 against brute force."""

import hashlib
import random
import re
import zlib

import pytest
from hypothesis import given, settings, strategies as st

from cartwheel.llm import periodic_runs as R, queries


def brute_runs(w, least=24, times=3):
    """Every maximal stretch of each period that has no smaller one."""
    n, found = len(w), {}
    for q in range(1, n // times + 1):
        i = q
        while i < n:
            a = i
            while i < n and w[i] == w[i - q]:
                i += 1
            size = i - a + q
            if size >= max(least, times * q) and not any((a - q, size) == (s, z) for s, z, _ in found):
                found[a - q, size, q] = q
            i += 1
    return sorted(found)


def rewritten(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def brute_row(doc_id, text):
    w = rewritten(doc_id, re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    runs = brute_runs(w)
    drop = {i for s, z, q in runs for i in range(s + q, s + z)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{z},{q}\n" for s, z, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in drop)))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 12)), max_size=6),
       st.sampled_from([(24, 3), (6, 3), (3, 3), (10, 4), (9, 5)]))
def test_runs_equal_brute_force(parts, limits):
    words = [x for part, again in parts for x in part * again]
    want = brute_runs(words, *limits)
    assert sorted(R.automaton_runs(words, *limits)) == want
    assert R.text_runs([b"%d" % x for x in words], *limits) == want


def test_one_word_many_times_and_a_fibonacci_text_stay_fast():
    assert R.automaton_runs([7] * 60_000) == [(0, 60_000, 1)]
    a, b = [0], [0, 1]
    while len(b) < 20_000:
        a, b = b, b + a
    found = R.automaton_runs(b, 24, 3)
    assert all(z >= max(24, 3 * q) and b[s + q:s + z] == b[s:s + z - q] for s, z, q in found)
    assert sorted(x for x in found if x[0] + x[1] < 1500) == [x for x in brute_runs(b[:1800]) if x[0] + x[1] < 1500]


def test_fewer_than_three_periods_are_refused():
    with pytest.raises(ValueError):
        R.automaton_runs([1, 2], 4, 2)


def texts():
    rng = random.Random(4)
    rows = [(None, None), (1, None), (2, ""), (3, " \n\t "), (4, "word"), (4, "word"), (5, "a " * 9_000)]
    for i in range(6, 260):
        words = [f"w{rng.randint(0, 500)}" for _ in range(rng.choice((1, 20, 60, 300)))]
        if i % 3 == 0:
            at = rng.randrange(len(words))
            words[at:at] = [f"p{k}" for k in range(rng.randint(1, 12))] * rng.randint(2, 30)
        rows.append((i, rng.choice(" \n\x0b").join(words) + rng.choice(("", " é é"))))
    return rows


def test_query_equals_brute_force(spark, frame, tmp_path):
    rows = texts()
    frame(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op11_periodic_runs(spark, str(tmp_path)).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect()
    # a null id has no digits: its text is not rewritten
    want = [brute_row(d, t) for d, t in rows if d is not None] + [(None, 0, None, None, None, None, *brute_row(1, "")[6:])]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert sum(r[1] for r in want) > 60


def test_real_output_and_odd_rows(odd, spark):
    got = R.find(odd).collect()
    assert len(got) == odd.count()
    assert {r["doc_id"]: (r["n_words"], len(r["runs"])) for r in got if r["doc_id"] in (1, 2, 3, 8)} == {
        1: (0, 0), 2: (0, 0), 3: (0, 0), 8: (50_001, 1)}
    assert next(r["collapsed"] for r in got if r["doc_id"] == 8) == "É end"
    assert R.find(odd.limit(0)).collect() == []
