"""Periodic runs of words, found on a suffix automaton whose link tree is kept as a link-cut tree (operator 11).

A run is a stretch of words with smallest period q that is at least ``times`` periods and ``least`` words long and that no
neighbouring word extends.  Words are appended to the automaton one at a time.  Its link tree is cut into vertical paths;
all states of a path ended last at the same word, the colour of the path.  Appending word i recolours the path from the
new state to the root.  Every piece of an old path on the way tells that its longest state, L words long, ended at the old
colour j before it ended at i: the words from j - L + 1 to i have period d = i - j.  With L >= 2 d no smaller distance can
hide d, so every run of three periods shows at its last word, once, and with its whole length L + d.  Splay trees hold
the paths, so the pieces of all steps together take O(n log n).

Before the automaton, a text is cut to the stretches that can hold a run at all: every window of ``window(least, times)``
words inside a run occurs again one period away, so a run lies in one unbroken stretch of windows that occur twice in the
text.  Equal windows have equal hashes; a collision only makes a stretch longer.  A run that reached beyond its stretch
would have been part of it, so what is maximal in the stretch is maximal in the text.

Memory follows the longest stretch of a single text, about a kilobyte for each of its words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cartwheel.llm import text as T

RUN = "struct<start:long,length:long,period:long>"


def window(least: int, times: int) -> int:
    """The longest window that occurs twice, one period apart, wherever it stands in a run."""
    most = least // times                                   # the largest period to which ``least`` is what counts
    return max(1, min(least - 2 * most, (times - 2) * (most + 1)))


def automaton_runs(words: list[int], least: int = 24, times: int = 3) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, in the order of their ends."""
    if times < 3:
        raise ValueError("runs of fewer than three periods may hide behind shorter distances")
    n, out = len(words), []
    # states: 0 is none, 1 the root; a state's strings end at its colour, which is right at the roots of splay trees only
    length, link, following = [0, 0], [0, 0], [{}, {}]
    left, right, up, colour = [0, 0], [0, 0], [0, 0], [-1, -1]

    def rotate(x: int) -> None:
        p = up[x]
        g = up[p]
        if left[p] == x:
            b = left[p] = right[x]
            right[x] = p
        else:
            b = right[p] = left[x]
            left[x] = p
        if b:
            up[b] = p
        up[p], up[x] = x, g
        if g:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x

    def splay(x: int) -> None:
        """Make x the root of its path's tree; shallower states stand to the left."""
        top, p = x, up[x]
        while p and (left[p] == top or right[p] == top):
            top, p = p, up[p]
        if top == x:
            return
        colour[x] = colour[top]
        while True:
            p = up[x]
            if not p or (left[p] != x and right[p] != x):
                return
            g = up[p]
            if g and (left[g] == p or right[g] == p):
                rotate(p if (left[g] == p) == (left[p] == x) else x)
            rotate(x)

    def state(size: int, to: dict, parent: int) -> int:
        length.append(size), following.append(to), link.append(parent)
        left.append(0), right.append(0), up.append(parent), colour.append(-1)
        return len(length) - 1

    last = 1
    for i, word in enumerate(words):
        p, new = last, state(length[last] + 1, {}, 1)
        while p and word not in following[p]:
            following[p][word] = new
            p = link[p]
        if p:
            q = following[p][word]
            if length[p] + 1 < length[q]:
                # the clone stands right above q, on the same path
                clone = state(length[p] + 1, following[q].copy(), link[q])
                splay(q)
                below = left[clone] = left[q]
                if below:
                    up[below] = clone
                left[q], up[clone], link[q] = clone, q, clone
                while p and following[p].get(word) == q:
                    following[p][word] = clone
                    p = link[p]
                q = clone
            link[new] = up[new] = q
        last = new
        # access: from the new state to the root, one piece of an old path after the other
        below, v = new, up[new]
        while v:
            splay(v)
            old, long = colour[v], length[v]
            apart = i - old
            if (old >= 0 and long >= (times - 1) * apart and long + apart >= least
                    and (i + 1 == n or words[i + 1] != words[i + 1 - apart])):
                out.append((old - long + 1, long + apart, apart))
            deeper = right[v]
            if deeper:
                colour[deeper] = old
            right[v] = below
            below, v = v, up[v]
        colour[below] = i
    return out


def stretches(words: np.ndarray, size: int, least: int) -> list[tuple[int, int]]:
    """(first word, end) of every stretch of windows of ``size`` words that each occur more than once, if it can hold
    ``least`` words."""
    hashes = T.windows(T.mix(words.astype(np.uint64) + np.uint64(1)), size)
    if len(hashes) <= least - size:
        return []
    ordered = np.sort(hashes)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return []
    again = np.zeros(len(hashes) + 2, np.int8)
    again[1:-1] = twice[np.minimum(np.searchsorted(twice, hashes), len(twice) - 1)] == hashes
    edge = np.diff(again)
    first, end = np.flatnonzero(edge > 0), np.flatnonzero(edge < 0) + size - 1
    return [(int(a), int(b)) for a, b in zip(first, end) if b - a >= least]


def text_runs(words: list[bytes], least: int = 24, times: int = 3) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a text, by start, then period."""
    if len(words) < least:
        return []
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    if len(number) == len(words):
        return []
    return sorted((a + start, size, period) for a, b in stretches(ids, window(least, times), least)
                  for start, size, period in automaton_runs(ids[a:b].tolist(), least, times))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by a blank, each run cut to its first period."""
    if not runs:
        return b" ".join(words)
    covered = np.zeros(len(words) + 1, np.int64)
    for start, size, period in runs:
        covered[start + period] += 1
        covered[start + size] -= 1
    return b" ".join(w for w, c in zip(words, np.cumsum(covered).tolist()) if not c)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 24, times: int = 3) -> DataFrame:
    """Per input row: id, n_words, runs (start, length and period, by start, then period) and collapsed (the words that
    are kept, joined by a blank).

    Words are what stands between blanks and 0x09-0x0D.  A null, empty or blank text has no words, no runs and an empty
    collapsed text.  Texts of any length are read whole, each by one task.  Repeated rows and null ids each get a row;
    other columns are not read, so clashing names don't matter; an empty table gives no rows.
    """
    window(least, times)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        counts, found, ends, kept = [], [], [0], []
        for text in part.column("text").cast(pa.large_binary()):
            # bytes.split() parts at the same six signs
            words = (text.as_py() or b"").split()
            runs = text_runs(words, least, times)
            counts.append(len(words)), found.extend(runs), ends.append(len(found)), kept.append(collapsed(words, runs))
        columns = np.array(found, np.int64).reshape(-1, 3)
        runs = pa.StructArray.from_arrays([pa.array(columns[:, i]) for i in range(3)], ["start", "length", "period"])
        return pa.RecordBatch.from_arrays(
            [part.column("id"), pa.array(counts, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), runs),
             pa.array(kept, pa.binary()).cast(pa.string())], ["id", "n_words", "runs", "collapsed"])
    schema = f"id {dict(rows.dtypes)['id']}, n_words long, runs array<{RUN}>, collapsed string"
    return T.mapped(rows, T.per_slice(work, "text"), schema).withColumnRenamed("id", id_col)
