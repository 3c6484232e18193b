"""Toxicity scores from a bidirectional gated recurrent network with attention pooling (operator 2), trained in numpy.

A word's input joins a word part (an embedding by the hash of the word) and a character part (the mean and the largest of
the embeddings of its byte n-grams, blanks around the word included).  The first number of every embedding is the log odds
of the label given the bucket, counted over the sample; training rows take it from the other half of the sample, so it does
not tell them their own label.  The rest is random.  Texts are cut into windows of ``WINDOW`` words that overlap, all of
them are scored, and a text's score is that of its worst window, on a fitted logistic curve.  Training is multiple-instance:
a text is judged by its highest windows.

The sample is bounded (``per_class`` rows of each label, together of at most ``per_class * most_chars`` signs); its texts
are whole, and every text is scored whole.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cartwheel.llm import text as T
from cartwheel.llm.labelled import Adam, calibrate, sample_rows, trained

WINDOW, STRIDE = 64, 52
HIDDEN, ATTEND, RANDOM = 8, 8, 3
WORD_BITS, GRAM_BITS, GRAMS = 16, 17, (3, 5)
#: words counted at once for the tables
AT_ONCE = 50_000
#: letters, digits and everything beyond ASCII
WORD = T.byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))


class Words:
    """The distinct words of a batch, where each occurrence's is, and their buckets."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        data = T.LOWER[data]
        starts, ends, self.bounds = T.words(data, offsets, WORD)
        self.which, hashes = pd.factorize(T.range_hashes(data, starts, ends))
        self.word = (hashes >> np.uint64(64 - WORD_BITS)).astype(np.int64)
        # the bytes of the distinct words, one blank before and after each
        first = np.empty(len(hashes), np.int64)
        first[self.which[::-1]] = np.arange(len(self.which))[::-1]
        size = ends[first] - starts[first] + 2
        self.end = np.cumsum(size)
        begin = self.end - size
        at = np.arange(self.end[-1] if len(size) else 0)
        inner = at + np.repeat(starts[first] - begin - 1, size)
        chars = np.full(len(at), 0x20, np.uint8)
        body = np.ones(len(at), bool)
        body[begin], body[self.end - 1] = False, False
        chars[body] = data[inner[body]]
        codes = chars.astype(np.uint64)
        own = np.repeat(np.arange(len(size), dtype=np.int32), size)
        grams, owner = [], []
        for n in GRAMS:
            if len(codes) < n:
                continue
            code = codes[:len(codes) - n + 1].copy()
            for i in range(1, n):
                code = code << np.uint64(8) | codes[i:len(codes) - n + 1 + i]
            whole = own[:len(code)] == own[n - 1:]
            grams.append((T.mix(code[whole] + np.uint64(n << 50)) >> np.uint64(64 - GRAM_BITS)).astype(np.int32))
            owner.append(own[:len(code)][whole])
        grams, owner = (np.concatenate(x) if x else np.zeros(0, np.int32) for x in (grams, owner))
        order = np.argsort(owner, kind="stable")
        self.gram, self.owner = grams[order], owner[order]
        # every word has at least one n-gram: a letter between two blanks
        self.gram_at = np.searchsorted(self.owner, np.arange(len(size)))

    def inputs(self, tables: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """One row per distinct word."""
        word, gram = tables
        if not len(self.word):
            return np.zeros((0, INPUT), np.float32)
        parts = gram[self.gram]
        share = np.diff(np.append(self.gram_at, len(self.gram)))[:, None].astype(np.float32)
        mean = np.add.reduceat(parts, self.gram_at) / share
        top = np.maximum.reduceat(parts[:, :1], self.gram_at)
        return np.concatenate([word[self.word], mean, top], axis=1)

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct-word numbers per window (-1 beyond its end), and the text of each window.  No word: one window."""
        n = np.diff(self.bounds)
        count = np.maximum(1, -(-(n - WINDOW) // STRIDE) + 1)
        doc = np.repeat(np.arange(len(n)), count)
        start = (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)) * STRIDE
        at = start[:, None] + np.arange(WINDOW)
        inside = at < n[doc][:, None]
        if not len(self.which):
            return np.full(at.shape, -1), doc
        found = self.which[np.minimum(at + self.bounds[doc][:, None], len(self.which) - 1)]
        return np.where(inside, found, -1), doc


INPUT = 2 * (RANDOM + 1) + 1


def tables(batches: list[Words], labels: list[np.ndarray], seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Embeddings of words and n-grams; the first number is the damped log odds of the label over texts."""
    out = []
    for bits, buckets in ((WORD_BITS, _word_texts), (GRAM_BITS, _gram_texts)):
        with_, without = np.zeros(1 << bits), np.zeros(1 << bits)
        n1 = n0 = 1.0
        for w, y in zip(batches, labels):
            # whole texts of some words at a time: their counts add up
            for a, b in _stretches(w.bounds, AT_ONCE):
                bucket, doc = buckets(w, a, b)
                pairs = np.unique(doc << bits | bucket)
                doc, bucket = pairs >> bits, pairs & ((1 << bits) - 1)
                with_ += np.bincount(bucket[y[doc] > 0], minlength=1 << bits)
                without += np.bincount(bucket[y[doc] == 0], minlength=1 << bits)
            n1, n0 = n1 + (y > 0).sum(), n0 + (y == 0).sum()
        odds = np.log((with_ / n1 + 1 / (n1 + n0)) / (without / n0 + 1 / (n1 + n0)))
        seen = with_ + without
        rest = np.random.default_rng(seed).normal(0, 0.3, (1 << bits, RANDOM))
        out.append(np.concatenate([(odds * seen / (seen + 4))[:, None], rest], axis=1).astype(np.float32))
    return out[0], out[1]


def _stretches(bounds: np.ndarray, words: int) -> list[tuple[int, int]]:
    """Stretches of rows with about that many words each; a longer row is one by itself or ends one."""
    cuts = np.unique(np.append(np.searchsorted(bounds[:-1], np.arange(0, bounds[-1], words)), [0, len(bounds) - 1]))
    return list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))


def _word_texts(w: Words, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every word of the texts from ``a`` to ``b``, and its text."""
    return w.word[w.which[w.bounds[a]:w.bounds[b]]], np.repeat(np.arange(a, b), np.diff(w.bounds[a:b + 1]))


def _gram_texts(w: Words, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
    """Every n-gram of every distinct word of each of those texts, and its text."""
    texts = np.repeat(np.arange(a, b), np.diff(w.bounds[a:b + 1]))
    size = len(w.word) or 1
    seen = np.unique(texts * size + w.which[w.bounds[a]:w.bounds[b]])
    texts, words = seen // size, seen % size
    count = np.diff(np.append(w.gram_at, len(w.gram)))[words]
    total = np.cumsum(count)
    at = np.arange(total[-1] if len(total) else 0) + np.repeat(w.gram_at[words] - (total - count), count)
    return w.gram[at], np.repeat(texts, count)


class Network:
    """Two gated recurrent layers, one for each direction, attention over their states, and a logistic output."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        def start(*shape):
            return rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
        self.w = {"x": start(INPUT, 6 * HIDDEN), "bx": np.zeros(6 * HIDDEN, np.float32),
                  "att": start(2 * HIDDEN, ATTEND), "v": start(ATTEND), "out": start(2 * HIDDEN),
                  "bias": np.zeros(1, np.float32)}
        for d in "fb":
            self.w[d + "zr"], self.w[d + "n"] = start(HIDDEN, 2 * HIDDEN), start(HIDDEN, HIDDEN)

    def forward(self, inputs: np.ndarray, windows: np.ndarray, keep: list | None = None) -> np.ndarray:
        """The logit of every window; ``keep`` collects what the backward pass needs."""
        w, size = self.w, len(windows)
        # a last row of zeros stands for the places beyond a window's end
        gates = np.concatenate([inputs @ w["x"] + w["bx"], np.zeros((1, 6 * HIDDEN), np.float32)])
        inside = (windows >= 0).astype(np.float32)
        states = np.empty((WINDOW, size, 2 * HIDDEN), np.float32)
        for side, d in enumerate("fb"):
            own = np.ascontiguousarray(gates[:, side * 3 * HIDDEN:(side + 1) * 3 * HIDDEN])
            h = np.zeros((size, HIDDEN), np.float32)
            for t in range(WINDOW) if d == "f" else range(WINDOW - 1, -1, -1):
                g = own[windows[:, t]]
                zr = _sigmoid(g[:, :2 * HIDDEN] + h @ w[d + "zr"])
                z, r = zr[:, :HIDDEN] * inside[:, t:t + 1], zr[:, HIDDEN:]
                n = np.tanh(g[:, 2 * HIDDEN:] + (r * h) @ w[d + "n"])
                if keep is not None:
                    keep.append((d, t, h, z, r, n))
                h = h + z * (n - h)
                states[t, :, side * HIDDEN:(side + 1) * HIDDEN] = h
        tone = np.tanh(states @ w["att"])
        score = np.where(inside.T > 0, tone @ w["v"], -30.0)
        share = np.exp(score - score.max(axis=0))
        share *= inside.T
        share /= np.maximum(share.sum(axis=0), 1e-9)
        pooled = (share[:, :, None] * states).sum(axis=0)
        if keep is not None:
            keep.append((states, tone, share, pooled, inside))
        return pooled @ w["out"] + w["bias"][0]

    def gradients(self, inputs: np.ndarray, windows: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        w, kept = self.w, []
        logit = self.forward(inputs, windows, kept)
        states, tone, share, pooled, inside = kept.pop()
        d_logit = ((1 / (1 + np.exp(-logit)) - y) / len(y)).astype(np.float32)
        grad = {k: np.zeros_like(v) for k, v in w.items()}
        grad["out"], grad["bias"] = pooled.T @ d_logit, np.array([d_logit.sum()], np.float32)
        d_pooled = d_logit[:, None] * w["out"]
        along = (states * d_pooled).sum(axis=2)
        d_states = share[:, :, None] * d_pooled
        d_score = share * (along - (share * along).sum(axis=0))
        grad["v"] = np.tensordot(d_score, tone, ([0, 1], [0, 1]))
        d_tone = d_score[:, :, None] * w["v"] * (1 - tone ** 2)
        grad["att"] = np.tensordot(states, d_tone, ([0, 1], [0, 1]))
        d_states = d_states + d_tone @ w["att"].T
        table = np.concatenate([inputs, np.zeros((1, INPUT), np.float32)])
        carry = {d: np.zeros((len(y), HIDDEN), np.float32) for d in "fb"}
        for d, t, h, z, r, n in reversed(kept):
            side = 0 if d == "f" else 1
            dh = carry[d] + d_states[t, :, side * HIDDEN:(side + 1) * HIDDEN]
            d_n = dh * z * (1 - n ** 2)
            d_rh = d_n @ w[d + "n"].T
            gate = z * (1 - z) * (inside[:, t:t + 1])
            d_zr = np.concatenate([dh * (n - h) * gate, d_rh * h * r * (1 - r)], axis=1)
            grad[d + "n"] += (r * h).T @ d_n
            grad[d + "zr"] += h.T @ d_zr
            carry[d] = dh * (1 - z) + d_rh * r + d_zr @ w[d + "zr"].T
            d_gate = np.concatenate([d_zr, d_n], axis=1) * inside[:, t:t + 1]
            part = slice(side * 3 * HIDDEN, (side + 1) * 3 * HIDDEN)
            grad["x"][:, part] += table[windows[:, t]].T @ d_gate
            grad["bx"][part] += d_gate.sum(axis=0)
        return grad


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class Model:
    """A trained network with its tables and its logistic curve; a constant where there was nothing to learn from."""

    def __init__(self, texts: list[str], y: np.ndarray, weight: np.ndarray, turns: int = 6, steps: int = 35, batch: int = 64):
        self.network, self.scale, self.shift = Network(), 1.0, 0.0
        share = float((weight * y).sum()) if len(y) else 0.0
        self.constant = None if 0 < share < 1 else share
        if self.constant is not None:
            return
        rng = np.random.default_rng(11)
        # a text without words is an example of label 0 in either half
        texts, y, weight = [*texts, "", ""], np.append(y, [0, 0]).astype(np.float32), np.append(weight, [weight.mean()] * 2)
        half = np.append(rng.permutation(len(y) - 2) % 2, [0, 1])
        words, labels = [], []
        for k in (0, 1):
            own = np.flatnonzero(half == k)
            words.append(Words(*T.utf8(pa.array([texts[i] for i in own], pa.string()))))
            labels.append(y[own])
        self.tables = tables(words, labels)
        # each half is seen through what the other half tells
        fold = [tables(words[1 - k:2 - k], labels[1 - k:2 - k]) for k in (0, 1)]
        inputs = [w.inputs(f) for w, f in zip(words, fold)]
        cut = [w.windows() for w in words]
        hint = [_loudest(inputs[k], cut[k][0]) for k in (0, 1)]
        adam = Adam(self.network.w, 0.02)
        for turn in range(turns):
            adam.rate = 0.02 * (1 - turn / turns)
            score = hint if not turn else [self._logits(inputs[k], cut[k][0]) for k in (0, 1)]
            # the highest window of a text of label 1, the two highest of one of label 0
            high = []
            for k in (0, 1):
                order = np.lexsort((-score[k], cut[k][1]))
                place = np.arange(len(order)) - np.searchsorted(cut[k][1], cut[k][1])
                doc = cut[k][1][order]
                high.append(order[place < np.where(labels[k][doc] > 0, 1, 2)])
            for step in range(steps):
                k = step % 2
                rows = rng.choice(high[k], min(batch, len(high[k])), replace=False)
                adam.step(self.network.gradients(inputs[k], cut[k][0][rows], labels[k][cut[k][1][rows]]))
        raw = [_worst(self._logits(inputs[k], cut[k][0]), cut[k][1], len(labels[k])) for k in (0, 1)]
        own = np.concatenate([np.flatnonzero(half == k) for k in (0, 1)])
        self.scale, self.shift = calibrate(np.concatenate(raw), y[own], weight[own])

    def _logits(self, inputs: np.ndarray, windows: np.ndarray, at_once: int = 2048) -> np.ndarray:
        return np.concatenate([self.network.forward(inputs, windows[i:i + at_once])
                               for i in range(0, len(windows), at_once)] or [np.zeros(0, np.float32)])

    def score(self, column: pa.Array) -> np.ndarray:
        """The probability of label 1 for every text of a column."""
        if self.constant is not None:
            return np.full(len(column), self.constant)
        words = Words(*T.utf8(column))
        windows, doc = words.windows()
        raw = _worst(self._logits(words.inputs(self.tables), windows), doc, len(column)).astype(np.float64)
        return 1 / (1 + np.exp(-np.clip(self.scale * raw + self.shift, -40, 40)))


def _loudest(inputs: np.ndarray, windows: np.ndarray) -> np.ndarray:
    odds = np.append(inputs[:, 0] + inputs[:, -1], -9)
    return odds[windows].max(axis=1)


def _worst(logits: np.ndarray, doc: np.ndarray, texts: int) -> np.ndarray:
    return np.maximum.reduceat(logits, np.searchsorted(doc, np.arange(texts))) if texts else logits


def train(docs: DataFrame, labels: DataFrame, may_learn: Column, label: str = "toxic", per_class: int = 1000,
          most_chars: int = 8_000, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model from a bounded sample of the labelled rows that ``may_learn`` (a condition on ``id``) admits."""
    return trained(sample_rows(docs, labels, label, may_learn, per_class, most_chars, id_col, text_col), Model)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          keep_text: bool = False) -> DataFrame:
    """Per input row: id, (the text,) and score (0 to 1).  Null and empty texts are scored like a text without words.

    Repeated rows each get a row; other columns are not read.  An empty table gives no rows; a model without labels of
    both classes gives every text the share of label 1.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        names = ["id"] + ["text"] * keep_text
        return pa.RecordBatch.from_arrays([*map(part.column, names), pa.array(shared.value.score(part.column("text")))],
                                          [*names, "score"])
    schema = f"id {dict(rows.dtypes)['id']}, " + "text string, " * keep_text + "score double"
    found = T.mapped(rows, T.per_slice(work, "text"), schema)
    return found.select(F.col("id").alias(id_col), *[F.col("text").alias(text_col)] * keep_text, "score")
