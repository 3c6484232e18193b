"""Language identification by hyperdimensional profiles (operator 6).

Every letter has a random vector of +1 and -1 (drawn from its code point, so all tasks agree).  A run of three signs is
bound by multiplying their vectors after rotating the first twice and the second once.  A text's profile is the bundle
(sum) of its runs; runs of anything but letters count as one blank.  A language's prototype bundles the unit profiles of a
bounded sample of its documents, less what all languages have in common.  A text gets the language with the largest cosine.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from cartwheel.llm import text as T
from cartwheel.llm.spread import written
from cartwheel.llm.tokens import LETTER, _classes

DIMENSIONS = 1024
ROWS = 256
BLANK = 0x20
UNKNOWN = "und"


@lru_cache(maxsize=100_000)
def letter(point: int) -> np.ndarray:
    bits = np.random.default_rng(point + 1).integers(0, 2, DIMENSIONS, np.int8)
    return bits * np.int8(2) - np.int8(1)


def _bound(codes: np.ndarray) -> np.ndarray:
    """The vector of every run of three, given as one number with 21 bits a sign."""
    parts = []
    for turn in (2, 1, 0):
        points, which = np.unique(codes >> np.uint64(21 * turn) & np.uint64(0x1FFFFF), return_inverse=True)
        parts.append(np.stack([np.roll(letter(p), turn) for p in points.tolist()])[which])
    return (parts[0] * parts[1] * parts[2]).astype(np.float32)


def runs(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct runs of three signs, then which one stands where and in which text."""
    if not texts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    texts = [t.lower() for t in texts]
    points = np.frombuffer("".join(f" {t} " for t in texts).encode("utf-32-le"), np.uint32)
    doc = np.repeat(np.arange(len(texts)), [len(t) + 2 for t in texts])
    letters = _classes()[points] == LETTER
    points = np.where(letters, points, BLANK)
    # one blank for several
    keep = letters.copy()
    keep[0] = True
    keep[1:] |= letters[:-1] | (doc[1:] != doc[:-1])
    points, doc = points[keep].astype(np.uint64), doc[keep]
    if len(points) < 3:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = points[:-2] << np.uint64(42) | points[1:-1] << np.uint64(21) | points[2:]
    whole = (doc[:-2] == doc[2:])
    which, codes = pd.factorize(code[whole])
    return codes, which, doc[:-2][whole]


def profiles(texts: list[str]):
    """Blocks of unit profiles, one row per text; zeros where a text has no letter."""
    codes, which, doc = runs(texts)
    vectors = _bound(codes) if len(codes) else np.zeros((0, DIMENSIONS), np.float32)
    edges = np.searchsorted(doc, np.arange(0, len(texts) + ROWS, ROWS))
    for block, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
        rows = min(ROWS, len(texts) - block * ROWS)
        if rows <= 0:
            return
        # only the runs that stand in this block
        used, own = np.unique(which[a:b], return_inverse=True)
        counts = np.bincount((doc[a:b] - block * ROWS) * len(used) + own, minlength=rows * len(used))
        bundle = counts.reshape(rows, len(used)).astype(np.float32) @ vectors[used]
        size = np.sqrt((bundle ** 2).sum(axis=1, keepdims=True))
        yield bundle / np.maximum(size, 1e-9)


class Prototypes:
    def __init__(self, texts: list[str], languages: list[str]):
        self.names = sorted(set(languages))
        place = {n: i for i, n in enumerate(self.names)}
        sums = np.zeros((len(self.names), DIMENSIONS))
        at = 0
        for block in profiles(texts):
            np.add.at(sums, [place[n] for n in languages[at:at + len(block)]], block)
            at += len(block)
        sums /= np.maximum(np.sqrt((sums ** 2).sum(axis=1, keepdims=True)), 1e-9)
        common = sums.mean(axis=0) if len(self.names) > 1 else 0.0
        sums = sums - common
        self.common = common
        self.rows = (sums / np.maximum(np.sqrt((sums ** 2).sum(axis=1, keepdims=True)), 1e-9)).astype(np.float32)

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        names, scores = [], []
        for block in profiles(texts):
            blank = ~block.any(axis=1)
            own = block - self.common
            own = own / np.maximum(np.sqrt((own ** 2).sum(axis=1, keepdims=True)), 1e-9)
            if not self.names:
                names += [UNKNOWN] * len(block)
                scores.append(np.zeros(len(block)))
                continue
            cosine = own @ self.rows.T
            best = cosine.argmax(axis=1)
            names += [UNKNOWN if b else self.names[i] for i, b in zip(best.tolist(), blank.tolist())]
            scores.append(np.where(blank, 0.0, cosine.max(axis=1).clip(0, 1)).astype(np.float64))
        return names, np.concatenate(scores) if scores else np.zeros(0)


def train(docs: DataFrame, may_learn: Column, per_language: int = 500, most_chars: int = 20_000, id_col: str = "doc_id",
          text_col: str = "text", lang_col: str = "lang", most_rows: int = 20_000) -> Prototypes:
    """Prototypes from at most ``per_language`` documents of each language that ``may_learn`` (a condition on ``id``) admits.

    Documents are taken whole, long ones too, in the order of a hash of their id, as long as those of a language together
    have at most ``per_language * most_chars`` signs.  With so many languages that this would be more than ``most_rows``
    documents, each gives fewer.
    """
    rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                        F.col(lang_col).cast("string").alias("lang"))
            .where(may_learn).where("text is not null and lang is not null"))
    languages = rows.select("lang").distinct().count()
    each = max(1, min(per_language, most_rows // max(1, languages)))
    room = each * most_chars
    order = F.xxhash64("id"), F.col("id"), F.col("chars"), F.col("digest")
    few = rows.select("id", "lang", F.length("text").alias("chars"), F.xxhash64("text").alias("digest")).where(F.col("chars") <= room)
    # first within 64 parts of a language, so that no task gets more rows the more tasks there are
    few = few.withColumn("part", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(64)))
    for key in (["lang", "part"], ["lang"]):
        nth = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
        few = few.withColumn("nth", nth).where(F.col("nth") <= each)
    before = F.sum("chars").over(Window.partitionBy("lang").orderBy("nth"))
    few = written(docs.sparkSession, few.withColumn("upto", before).where(F.col("upto") <= room).select("id", "lang", "digest")
                  .distinct(), "few")
    # at most ``most_rows`` rows of three short columns: the texts of all others stay where they are
    found = rows.withColumn("digest", F.xxhash64("text")).join(F.broadcast(few), ["id", "lang", "digest"])
    taken = found.select("text", "lang").distinct().toArrow()
    texts, names = taken.column("text").to_pylist(), taken.column("lang").to_pylist()
    order = sorted(range(len(texts)), key=lambda i: (names[i], texts[i]))
    return Prototypes([texts[i] for i in order], [names[i] for i in order])


def identify(docs: DataFrame, prototypes: Prototypes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row: id, lang_pred and score (the cosine, 0 to 1).

    A null text or one without a letter is ``und`` with score 0; so is every text when no language was learned.  Ties go to
    the first name.  Repeated rows each get a row; other columns are not read; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(prototypes)

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        names, scores = shared.value.predict([t or "" for t in part.column("text").to_pylist()])
        return pa.RecordBatch.from_arrays([part.column("id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                          ["id", "lang_pred", "score"])
    schema = f"id {dict(rows.dtypes)['id']}, lang_pred string, score double"
    return T.mapped(rows, T.per_slice(work, "text"), schema).withColumnRenamed("id", id_col)
