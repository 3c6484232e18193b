"""Labelled rows for classifiers: who may be learned from, and a bounded balanced sample."""

from __future__ import annotations

import gc
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cartwheel.llm import text as T
from cartwheel.llm.spread import written


def held_out(id_col: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text has this remainder; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds == fold


def sample_rows(docs: DataFrame, labels: DataFrame, label: str, may_learn: Column, per_class: int, most_chars: int,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(y, n, place, text) of at most ``per_class`` learnable rows of each class; n: how many learnable rows it has.

    Rows are taken whole in the order of a hash of their id, long ones too, until the next one would bring the class above
    ``per_class * most_chars`` signs; only a text longer than that by itself is passed over.  Learnable are rows that
    ``may_learn`` admits and that have text, id and label.
    """
    rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
            .where(may_learn).where(F.col("text").isNotNull()))
    marked = labels.where(F.col(label).isin(0, 1)).groupBy(F.col(id_col).alias("id")).agg(F.max(label).alias("y"))
    marked = marked.where(F.col("id").isNotNull()).where(may_learn)
    known = written(docs.sparkSession, rows.select("id", F.length("text").alias("chars")).join(marked, "id"), "labelled")
    totals = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts, room = [], per_class * most_chars
    for value in (0, 1):
        order = F.xxhash64("id")
        first = (known.where((F.col("y") == value) & (F.col("chars") <= room)).orderBy(order, "id", "chars")
                 .limit(per_class).select("id", "chars").toArrow())
        taken = int((np.cumsum(first.column("chars").to_numpy().astype(np.int64)) <= room).sum())
        some = docs.sparkSession.createDataFrame(first.slice(0, taken).select(["id"])).distinct()
        place = F.struct(order.alias("h"), F.col("id"), F.length("text").alias("chars")).alias("place")
        parts.append(rows.where(F.length("text") <= room).join(F.broadcast(some), "id").select(place, "text")
                     .orderBy("place", "text").limit(taken)
                     .select(F.lit(value).alias("y"), F.lit(totals.get(value, 0)).cast("long").alias("n"), "place", "text"))
    return parts[0].unionByName(parts[1])


def weighted(y: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Weights that bring the classes of a sample back to their shares ``n`` among all learnable rows."""
    if not len(y):
        return np.zeros(0)
    weights = n / np.where(y > 0, (y > 0).sum(), (y == 0).sum())
    return weights / weights.sum()


def trained(rows: DataFrame, model: type):
    """``model(texts, labels, weights)`` for a sample, fitted by one task: the texts do not come to the driver."""
    def run(batches):
        parts = list(batches)
        if not parts:
            return
        table = pa.Table.from_batches(parts)
        y, n = (table.column(c).to_numpy() for c in ("y", "n"))
        fitted = model(table.column("text").to_pylist(), y.astype(np.float32), weighted(y, n))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fitted)], pa.binary())], ["model"])
        # the worker that has trained goes on to score
        del parts, table, fitted
        gc.collect()
    one = rows.repartition(1).sortWithinPartitions("y", "place", "text").select("y", "n", "text")
    found = T.mapped(one, run, "model binary").collect()
    # no row, no batch
    return pickle.loads(found[0]["model"]) if found else model([], np.zeros(0, np.float32), np.zeros(0))


def calibrate(raw: np.ndarray, y: np.ndarray, weight: np.ndarray, cut: float = 0.3,
              steps: int = 400) -> tuple[float, float]:
    """Scale and shift of a logistic curve over raw scores.

    The scale comes from weighted, slightly damped maximum likelihood; the shift gives the value ``cut`` to the raw score
    that parts the classes with the least weighted error (the middle of the stretch, if several do).
    """
    if not len(raw) or y.min() == y.max():
        return 1.0, 0.0
    middle, spread = float(np.average(raw, weights=weight)), float(raw.std()) or 1.0
    x, scale, shift = (raw - middle) / spread, 1.0, 0.0
    target = np.where(y > 0, 0.995, 0.005)
    for _ in range(steps):
        off = 1 / (1 + np.exp(-(scale * x + shift))) - target
        scale -= 2 * float((weight * off * x).sum())
        shift -= 2 * float((weight * off).sum())
    scale = max(scale, 0.5)
    order = np.argsort(x, kind="stable")
    x, one, zero = x[order], (weight * (y > 0))[order], (weight * (y == 0))[order]
    # the error of a cut before each sorted score, and after the last
    error = np.append(0, np.cumsum(one)) + np.append(np.cumsum(zero[::-1])[::-1], 0)
    edges = np.concatenate([[x[0] - 1], (x[1:] + x[:-1]) / 2, [x[-1] + 1]])
    least = edges[error <= error.min() + 1e-12]
    parting = float((least[0] + least[-1]) / 2)
    shift = np.log(cut / (1 - cut)) - scale * parting
    return scale / spread, shift - scale * middle / spread


class Adam:
    """Adam steps over a dictionary of arrays."""

    def __init__(self, weights: dict[str, np.ndarray], rate: float):
        self.weights, self.rate, self.t = weights, rate, 0
        self.first = {k: np.zeros_like(v) for k, v in weights.items()}
        self.second = {k: np.zeros_like(v) for k, v in weights.items()}

    def step(self, grads: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, g in grads.items():
            np.clip(g, -1, 1, out=g)
            self.first[k] += 0.1 * (g - self.first[k])
            self.second[k] += 0.001 * (g * g - self.second[k])
            fair = self.first[k] / (1 - 0.9 ** self.t), self.second[k] / (1 - 0.999 ** self.t)
            self.weights[k] -= self.rate * fair[0] / (np.sqrt(fair[1]) + 1e-8)
