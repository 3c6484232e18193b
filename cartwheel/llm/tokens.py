"""Token ids of many texts at once, equal to those of the ``tokenizers`` library for a byte-level BPE file.

The pattern of the byte-level split (contractions, then letters, digits or other signs with at most one blank before them,
then white space) is applied to whole batches as array operations; each distinct piece is encoded once per
worker and its ids are looked up afterwards.  Pieces are told apart by 64-bit hashes: a worker remembers at most REMEMBERED
pieces and those of one batch, so the chance that any two of them share a hash is below 10^-8.  Added tokens (such as an
end mark spelled out in a text) are cut out first and get their own ids, as the library does it.

The vocabulary is read by ``tokenizers`` from its file; single pieces are merged by ``tiktoken`` with the same ranks, which
takes a quarter of the time.  The tests compare the ids with those of ``tokenizers`` itself.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pandas as pd
import tiktoken
from tokenizers import Tokenizer

from cartwheel.llm import text as T

OTHER, LETTER, DIGIT, SPACE = range(4)
#: white space as the split's pattern means it (fixed values)
BLANKS = (*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
REMEMBERED = 300_000
#: the split of the byte-level BPE file (fixed value)
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    kinds = {"L": LETTER, "N": DIGIT}
    table = np.array([kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], np.uint8)
    table[list(BLANKS)] = SPACE
    return table


def split(points: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where each piece begins in the code points of texts that begin at ``offsets`` (one entry more than texts)."""
    size = len(points)
    if not size:
        return np.zeros(0, np.int64)
    kind = _classes()[points]
    head = np.zeros(size + 1, bool)
    head[offsets[offsets <= size]] = True
    head[size] = True
    run = head[:-1].copy()
    run[1:] |= kind[1:] != kind[:-1]
    blank, space = points == 0x20, kind == SPACE
    begins = run.copy()
    # a blank right before other signs belongs to them
    after_blank = np.zeros(size, bool)
    after_blank[1:] = blank[:-1] & ~head[1:-1]
    begins &= ~(after_blank & ~space)
    # the last white space before other signs stands apart from those before it
    before = np.zeros(size, bool)
    before[:-1] = space[:-1] & ~space[1:] & ~head[1:-1]
    begins |= before
    # contractions: an apostrophe alone, not after a blank, then one of the endings
    mark = np.flatnonzero((points == 0x27) & run & ~after_blank)
    mark = mark[mark + 1 < size]
    mark = mark[~head[mark + 1] & (kind[mark + 1] == LETTER)]
    if len(mark):
        one = points[mark + 1]
        room = mark + 2 < size
        two = np.where(room, points[np.minimum(mark + 2, size - 1)], 0)
        two = np.where(room & ~head[np.minimum(mark + 2, size)], two, 0)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = np.zeros(len(mark), bool)
        for ending in ("re", "ve", "ll"):
            long |= (one == ord(ending[0])) & (two == ord(ending[1]))
        begins[mark[short | long] + 1] = False
        for chosen, length in ((short, 2), (long & ~short, 3)):
            rest = mark[chosen] + length
            rest = rest[rest < size]
            begins[rest[~head[rest] & (kind[rest] == LETTER)]] = True
    return np.flatnonzero(begins)


def _byte_letters() -> dict[int, int]:
    """How byte-level BPE spells a byte: as its own sign where that is printable, else as one from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    odd = [b for b in range(256) if b not in set(plain)]
    return {b: b for b in plain} | {b: 256 + i for i, b in enumerate(odd)}


class Encoder:
    """Ids by a tokenizer file; keeps the ids of the pieces it has seen, up to REMEMBERED."""

    def __init__(self, path: str):
        told = json.loads(Tokenizer.from_file(path).to_str())
        odd = [t["content"] for t in told["added_tokens"] if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]]
        if odd:
            raise ValueError(f"added tokens that take in their surroundings are not supported: {odd}")
        self.added = {t["content"]: t["id"] for t in told["added_tokens"]}
        # of tokens that begin at the same place the longest counts
        self.marks = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) or "(?!)")
        special = set(self.added.values())
        letters = {chr(sign): byte for byte, sign in _byte_letters().items()}
        ranks = {bytes(map(letters.__getitem__, piece)): i for piece, i in told["model"]["vocab"].items()
                 if i not in special}
        self.pieces = tiktoken.Encoding("pieces", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._reset()

    def _reset(self) -> None:
        self.known: dict[int, int] = {}
        self.begin, self.count, self.ids = (np.zeros(0, kind) for kind in (np.int64, np.int64, np.uint32))

    def _learn(self, hashes: list[int], pieces: list[str]) -> None:
        got = list(map(self.pieces.encode_ordinary, pieces))
        self.known.update(zip(hashes, range(len(self.count), len(self.count) + len(hashes))))
        count = np.array([len(x) for x in got], np.int64)
        self.begin = np.append(self.begin, len(self.ids) + np.cumsum(count) - count)
        self.count = np.append(self.count, count)
        self.ids = np.append(self.ids, np.array([i for x in got for i in x], np.uint32))

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and where each text's begin (one entry more than texts)."""
        if not any(mark in text for mark in self.added for text in texts):
            return self._encode(texts)
        parts, marks, first = [], [], [0]
        for text in texts:
            at = 0
            for found in self.marks.finditer(text):
                parts.append(text[at:found.start()]), marks.append([self.added[found[0]]])
                at = found.end()
            parts.append(text[at:]), marks.append([])
            first.append(len(parts))
        ids, at = self._encode(parts)
        joined = [np.append(ids[a:b], np.array(mark, np.uint32)) for a, b, mark in zip(at, at[1:], marks)]
        ends = np.append(0, np.cumsum([len(x) for x in joined]))
        return np.concatenate(joined), ends[first]

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts without added tokens."""
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        offsets = np.cumsum([0, *map(len, texts)])
        begins = split(points, offsets)
        if not len(begins):
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        ends = np.append(begins[1:], len(points))
        which, hashes = pd.factorize(T.range_hashes(points, begins, ends))
        if len(self.known) > REMEMBERED:
            self._reset()
        keys = hashes.tolist()
        place = list(map(self.known.get, keys))
        new = [i for i, p in enumerate(place) if p is None]
        if new:
            first = np.empty(len(keys), np.int64)
            first[which[::-1]] = np.arange(len(which))[::-1]
            spans = zip(begins[first[new]].tolist(), ends[first[new]].tolist())
            self._learn([keys[i] for i in new],
                        [points[b:e].tobytes().decode("utf-32-le") for b, e in spans])
            place = list(map(self.known.get, keys))
        at = np.array(place, np.int64)[which]
        sizes = self.count[at]
        total = np.cumsum(sizes)
        ids = self.ids[np.arange(total[-1]) + np.repeat(self.begin[at] - (total - sizes), sizes)]
        # pieces never cross texts
        return ids, np.append(0, total)[np.searchsorted(begins, offsets)]


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)
