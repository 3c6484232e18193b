"""Quality scores from a byte-level convolutional network (operator 9), trained in numpy.

Every byte has a learned embedding; learned filters of ``WIDTH`` bytes slide over the whole text.  A text is cut into chunks
of ``CHUNK`` positions of which each overlaps the next by half.  Within a chunk every filter keeps its largest answer; a
dense layer turns these into the chunk's doubt about the text; the largest and the mean doubt of all chunks are combined
into one logistic probability of label 1.  Training is multiple-instance: a text of label 0 is judged by its most doubtful
chunk, one of label 1 by its two most doubtful.

The sample is bounded (``per_class`` rows of each label, of at most ``most_chars`` signs); every text is scored whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cartwheel.llm import text as T
from cartwheel.llm.labelled import Adam, calibrate, sample_rows, trained

EMBED, WIDTH, FILTERS, DENSE = 4, 8, 16, 8
HALF = 128
CHUNK = 2 * HALF
#: rows of bytes per matrix product, so that they stay in the cache
AT_ONCE = 1 << 14


def padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one array, each followed by zeros up to whole half chunks, and the first half chunk of each (one entry
    more than texts)."""
    size = np.diff(offsets)
    first = np.append(0, np.cumsum(np.maximum(1, -(-size // HALF))))
    out = np.zeros(first[-1] * HALF + WIDTH - 1, np.uint8)
    shift = np.repeat(first[:-1] * HALF - offsets[:-1], size)
    out[np.arange(len(data)) + shift] = data
    return out, first


class Network:
    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        def start(*shape):
            return rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
        self.w = {"embed": rng.normal(0, 0.5, (256, EMBED)).astype(np.float32), "conv": start(WIDTH * EMBED, FILTERS),
                  "shift": np.zeros(FILTERS, np.float32), "dense": start(FILTERS, DENSE),
                  "dshift": np.zeros(DENSE, np.float32), "out": start(DENSE), "bias": np.zeros(1, np.float32)}

    def _answers(self, rows: np.ndarray) -> np.ndarray:
        """Filter answers at every position but the last WIDTH - 1 of each row of bytes."""
        seen = self.w["embed"][rows].reshape(len(rows), -1)
        views = np.lib.stride_tricks.sliding_window_view(seen, WIDTH * EMBED, axis=1)[:, ::EMBED]
        return np.ascontiguousarray(views) @ self.w["conv"]

    def halves(self, data: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The largest answer of every filter in every half chunk; beyond a text's last one filters see zeros."""
        rows = np.lib.stride_tricks.sliding_window_view(data, HALF + WIDTH - 1)[::HALF]
        out = np.empty((first[-1], FILTERS), np.float32)
        last = np.zeros(first[-1], bool)
        last[first[1:] - 1] = True
        step = AT_ONCE // HALF
        for i in range(0, len(out), step):
            some = rows[i:i + step].copy()
            some[last[i:i + step], HALF:] = 0
            out[i:i + step] = self._answers(some).max(axis=1)
        return out

    def doubt(self, largest: np.ndarray) -> np.ndarray:
        w = self.w
        return np.tanh(np.maximum(largest + w["shift"], 0) @ w["dense"] + w["dshift"]) @ w["out"] + w["bias"][0]

    def gradients(self, chunks: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """For chunks of CHUNK + WIDTH - 1 bytes; only the positions with the largest answers have a part in it."""
        w, size = self.w, len(y)
        answers = self._answers(chunks)
        at = answers.argmax(axis=1)
        raw = np.take_along_axis(answers, at[:, None, :], axis=1)[:, 0] + w["shift"]
        top = np.maximum(raw, 0)
        mid = np.tanh(top @ w["dense"] + w["dshift"])
        logit = mid @ w["out"] + w["bias"][0]
        d_logit = ((1 / (1 + np.exp(-logit)) - y) / size).astype(np.float32)
        d_mid = d_logit[:, None] * w["out"] * (1 - mid ** 2)
        d_top = d_mid @ w["dense"].T * (raw > 0)
        seen = chunks[np.arange(size)[:, None, None], at[:, :, None] + np.arange(WIDTH)]
        views = w["embed"][seen].reshape(size, FILTERS, WIDTH * EMBED)
        d_embed = np.zeros_like(w["embed"])
        d_views = (d_top[:, :, None] * w["conv"].T).reshape(size, FILTERS, WIDTH, EMBED)
        np.add.at(d_embed, seen.ravel(), d_views.reshape(-1, EMBED))
        return {"embed": d_embed, "conv": np.einsum("bf,bfk->kf", d_top, views), "shift": d_top.sum(axis=0),
                "dense": top.T @ d_mid, "dshift": d_mid.sum(axis=0), "out": mid.T @ d_logit,
                "bias": np.array([d_logit.sum()], np.float32)}


def _chunks(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and second half of every chunk (the same where a text has one half), and the text of each chunk."""
    halves = np.diff(first)
    count = np.maximum(1, halves - 1)
    doc = np.repeat(np.arange(len(halves)), count)
    one = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count) + first[doc]
    return one, np.minimum(one + 1, first[doc + 1] - 1), doc


class Model:
    """A trained network and its logistic curve; a constant where there was nothing to learn from."""

    def __init__(self, texts: list[str], y: np.ndarray, weight: np.ndarray, turns: int = 6, steps: int = 60,
                 batch: int = 64):
        self.network, self.scale, self.shift, self.mean_part = Network(), 1.0, 0.0, 0.0
        share = float((weight * y).sum()) if len(y) else 0.0
        self.constant = None if 0 < share < 1 else share
        if self.constant is not None:
            return
        rng = np.random.default_rng(13)
        data, first = padded(*T.utf8(pa.array(texts, pa.string())))
        one, two, doc = _chunks(first)
        adam = Adam(self.network.w, 0.01)
        for turn in range(turns):
            adam.rate = 0.01 * (1 - turn / turns)
            score = self._doubts(data, first, one, two) if turn else rng.random(len(doc)).astype(np.float32)
            order = np.lexsort((-score, doc))
            place = np.arange(len(order)) - np.searchsorted(doc, doc)
            high = order[place < np.where(y[doc[order]] > 0, 2, 1)]
            classes = [high[y[doc[high]] == k] for k in (0, 1)]
            for _ in range(steps):
                rows = np.concatenate([rng.choice(c, batch // 2) for c in classes])
                at = one[rows][:, None] * HALF + np.arange(CHUNK + WIDTH - 1)
                beyond = at >= first[doc[rows] + 1][:, None] * HALF
                chunks = np.where(beyond, 0, data[np.minimum(at, len(data) - 1)])
                adam.step(self.network.gradients(chunks, 1 - y[doc[rows]]))
        most, mean = self._pooled(self._doubts(data, first, one, two), doc, len(texts))
        # how much the mean adds to the largest doubt: the share that parts the sample best
        def loss(part: float) -> float:
            raw = -(most + part * mean)
            scale, shift = calibrate(raw, y, weight)
            p = 1 / (1 + np.exp(-np.clip(scale * raw + shift, -30, 30)))
            return float(-(weight * np.log(np.where(y > 0, p, 1 - p).clip(1e-6))).sum())
        self.mean_part = min((0.0, 0.25, 0.5, 1.0), key=loss)
        self.scale, self.shift = calibrate(-(most + self.mean_part * mean), y, weight)

    def _doubts(self, data: np.ndarray, first: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        halves = self.network.halves(data, first)
        return self.network.doubt(np.maximum(halves[one], halves[two]))

    @staticmethod
    def _pooled(doubts: np.ndarray, doc: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(doc, np.arange(texts))
        mean = np.add.reduceat(doubts.astype(np.float64), at) / np.bincount(doc, minlength=texts)
        return np.maximum.reduceat(doubts, at).astype(np.float64), mean

    def score(self, column: pa.Array) -> np.ndarray:
        """The probability of label 1 for every text of a column."""
        if self.constant is not None or not len(column):
            return np.full(len(column), self.constant or 0.0)
        data, first = padded(*T.utf8(column))
        one, two, doc = _chunks(first)
        most, mean = self._pooled(self._doubts(data, first, one, two), doc, len(column))
        return 1 / (1 + np.exp(-np.clip(self.scale * -(most + self.mean_part * mean) + self.shift, -40, 40)))


def train(docs: DataFrame, labels: DataFrame, may_learn: Column, label: str = "quality", per_class: int = 1000,
          most_chars: int = 20_000, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model from a bounded sample of the labelled rows that ``may_learn`` (a condition on ``id``) admits."""
    return trained(sample_rows(docs, labels, label, may_learn, per_class, most_chars, id_col, text_col), Model)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row: id and score (0 to 1).  Null and empty texts are one chunk of zeros.

    Repeated rows each get a row; other columns are not read.  An empty table gives no rows; a model without labels of
    both classes gives every text the share of label 1.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([part.column("id"), pa.array(shared.value.score(part.column("text")))],
                                          ["id", "score"])
    kind = dict(rows.dtypes)["id"]
    return T.mapped(rows, T.per_slice(work, "text"), f"id {kind}, score double").withColumnRenamed("id", id_col)
