"""Benchmark decontamination by a broadcast set of word n-grams (operator 1).

The distinct items of the benchmark become windows of ``n`` normalised words.  Their hashes are broadcast in blocks of items
of about a bounded size (``block_bytes`` of text and ``block_windows`` windows, some 50 bytes each); every document word
window is looked up, first in a bitmap, then among the sorted hashes, and each hit is verified by comparing the words with
those of the item's text.  Only an item larger than a block is a block of more.  A larger benchmark takes several blocks, one pass after the
other over a written table, so what is broadcast at once never grows with the benchmark.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cartwheel.llm import text as T
from cartwheel.llm.spread import written

#: after A-Z are lower-cased: digits, a-z and everything beyond ASCII
WORD = T.byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
BITS = 22


class Grams:
    """The windows of one block of items."""

    def __init__(self, items: list[tuple[str, str | None]], n: int):
        data, offsets = T.utf8(pa.array([text for _, text in items], pa.string()))
        data = T.LOWER[data]
        starts, ends, bounds = T.words(data, offsets, WORD)
        hashes = T.range_hashes(data, starts, ends)
        self.raw, self.starts, self.ends = data.tobytes(), starts, ends
        names, name = np.unique(np.array([name for name, _ in items], object), return_inverse=True)
        self.names = names.tolist()
        #: owners of windows that share the hash of others, by their words
        self.others: dict[bytes, set[str]] = {}
        size = np.minimum(n, np.diff(bounds))
        item = np.repeat(np.arange(len(size)), np.diff(bounds))
        self.lengths = {}
        for length in np.unique(size[size > 0]).tolist():
            at = np.arange(len(starts) - length + 1)
            at = at[(size[item[at]] == length) & (at + length <= bounds[item[at] + 1])]
            own, owner = T.windows(hashes, length)[at], name[item[at]].astype(np.int32)
            order = np.lexsort((owner, own))
            at, own, owner = at[order], own[order], owner[order]
            fresh = np.append(True, own[1:] != own[:-1])
            group = np.cumsum(fresh) - 1
            first = at[fresh]
            # windows of one hash nearly always have the same words; the few others are kept by their words
            same = fresh.copy()
            for i in np.flatnonzero(~fresh).tolist():
                words = self._words(int(at[i]), length)
                same[i] = words == self._words(int(first[group[i]]), length)
                if not same[i]:
                    self.others.setdefault(words, set()).add(self.names[owner[i]])
            own, owner, group = own[same], owner[same], group[same]
            once = np.append(True, (group[1:] != group[:-1]) | (owner[1:] != owner[:-1]))
            own, owner = own[once], owner[once]
            known, begin = np.unique(own, return_index=True)
            bitmap = np.zeros(1 << BITS, bool)
            bitmap[known >> np.uint64(64 - BITS)] = True
            self.lengths[length] = known, bitmap, first, np.append(begin, len(own)), owner

    def _words(self, first: int, n: int) -> bytes:
        return _words(self.raw, self.starts, self.ends, first, n)

    def hits(self, raw: bytes, starts, ends, bounds, hashes):
        """(document, first word, length, owners) of every verified window of a batch."""
        for length, (known, bitmap, window, begin, owner) in self.lengths.items():
            own = T.windows(hashes, length)
            at = np.flatnonzero(bitmap[own >> np.uint64(64 - BITS)])
            doc = np.searchsorted(bounds, at, side="right") - 1
            inside = at + length <= bounds[doc + 1]
            at, doc = at[inside], doc[inside]
            near = np.minimum(np.searchsorted(known, own[at]), len(known) - 1)
            same = known[near] == own[at]
            for first, row, i in zip(at[same].tolist(), doc[same].tolist(), near[same].tolist()):
                words = _words(raw, starts, ends, first, length)
                if words == self._words(int(window[i]), length):
                    owners = {self.names[k] for k in owner[begin[i]:begin[i + 1]].tolist()}
                else:
                    owners = self.others.get(words)
                if owners:
                    yield row, first, length, owners


def _words(raw: bytes, starts, ends, first: int, n: int) -> bytes:
    return b" ".join(raw[starts[i]:ends[i]] for i in range(first, first + n))


_FOUND = "n_words long, spans array<struct<start: int, end: int>>, items array<string>"
_SPAN = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _scan(rows: DataFrame, block: list[tuple[str, str | None]], n: int, keep_text: bool) -> DataFrame:
    """Adds the block's hits to those in ``spans`` (ranges of words, merged) and ``items``."""
    grams = rows.sparkSession.sparkContext.broadcast(Grams(block, n))
    names = [c for c in rows.columns if c not in ("text", "n_words", "spans", "items")]
    names += ["text"] * keep_text + ["n_words", "spans", "items"]

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = T.utf8(part.column("text"))
        data = T.LOWER[data]
        starts, ends, bounds = T.words(data, offsets, WORD)
        spans, items = part.column("spans").to_pylist(), part.column("items").to_pylist()
        more: dict[int, tuple[list, set]] = {}
        hashes = T.range_hashes(data, starts, ends)
        for row, first, length, owners in grams.value.hits(data.tobytes(), starts, ends, bounds, hashes):
            place, names_ = more.setdefault(row, ([], set()))
            place.append((int(first - bounds[row]), int(first - bounds[row]) + length))
            names_ |= owners
        for row, (place, names_) in more.items():
            spans[row] = merged([(s["start"], s["end"]) for s in spans[row]] + place)
            items[row] = sorted({*items[row], *names_})
        done = {"n_words": pa.array(np.diff(bounds), pa.int64()), "spans": pa.array(spans, _SPAN),
                "items": pa.array(items, pa.list_(pa.string()))}
        return pa.RecordBatch.from_arrays([done[c] if c in done else part.column(c) for c in names], names)

    kinds = dict(rows.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in names[:-3]) + ", " + _FOUND
    return T.mapped(rows.drop("n_words"), T.per_slice(work, "text"), schema)


def merged(spans: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Overlapping or touching ranges joined, in order."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [{"start": s, "end": e} for s, e in out]


def find(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text: str = "text", n: int = 10, block_bytes: int = 32 << 20,
         block_windows: int = 1 << 20, keep_text: bool = False) -> DataFrame:
    """Per input row: id, (text,) n_words, n_hit, spans (merged ranges of hit words), items (sorted ids as strings).

    A null or empty text has no words.  Items without words have no window; an item shorter than ``n`` words is one
    window.  A null item id is the empty string; items that repeat count once by their id.  Repeated rows each get a row.
    Other columns are not read, whatever their names.  Empty tables on either side give no hits.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
                             F.col(item_text).cast("string").alias("text")).where("text is not null")
    items = written(spark, items.distinct(), "items")
    # between any two words there is a sign that is none of theirs, so this is no less than the words
    words = F.size(F.split("text", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))
    size = items.agg(F.sum(F.octet_length("text") + 64).alias("bytes"), F.sum(words).alias("words")).first()
    blocks = max(1, -(-int(size["bytes"] or 0) // block_bytes), -(-int(size["words"] or 0) // block_windows))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                       F.expr("cast(array() as array<struct<start: int, end: int>>)").alias("spans"),
                       F.expr("cast(array() as array<string>)").alias("items"))
    for i in range(blocks):
        block = [(r["item"], r["text"]) for r in
                 items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == i).toLocalIterator()]
        last = i == blocks - 1
        rows = _scan(rows, block, n, keep_text or not last)
        if not last:
            rows = written(spark, rows, "decontaminated")
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return rows.select(F.col("id").alias(id_col), *(["text"] if keep_text else []), "n_words", hit.alias("n_hit"), "spans",
                       "items")


def without_spans(text: str | None, spans: list) -> str | None:
    """The text with its hit words, and what stands between the words of one span, cut out."""
    if text is None or not spans:
        return text
    data = np.frombuffer(text.encode(), np.uint8)
    starts, ends, _ = T.words(T.LOWER[data], np.array([0, len(data)]), WORD)
    raw, out, at = data.tobytes(), [], 0
    for span in spans:
        out.append(raw[at:starts[span["start"]]])
        at = int(ends[span["end"] - 1])
    return b"".join([*out, raw[at:]]).decode()


def clean(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", id_col: str = "doc_id",
          text_col: str = "text", **options) -> DataFrame:
    """The rows without contaminated documents (``remove="documents"``) or without their hit spans (``"spans"``).

    Columns stay as they are.  A row is judged by its own text, so repeated rows and null ids need no key.
    """
    packed = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col(text_col).alias("doc"))
    found = find(packed, benchmark, "row", "doc", keep_text=remove == "spans", **options)
    if remove == "documents":
        return found.where(F.size("spans") == 0).select("row.*")
    cut = F.udf(without_spans, "string")
    other = [F.col(f"row.`{c}`") for c in docs.columns if c != text_col]
    text = F.when(F.size("spans") > 0, cut("text", "spans")).otherwise(F.col("text"))
    return found.select(*other, text.alias(text_col)).select(docs.columns)
