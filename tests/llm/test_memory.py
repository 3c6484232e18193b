"""What tasks over texts hold: bounded batches on the way in, and nothing that they have freed when they end."""

import sys

import numpy as np
import pytest

from cartwheel.llm import decontaminate, jaccard_join, packing, text, toxicity
from cartwheel.llm.queries import tokenizer_path

OPERATORS = {
    "toxicity": lambda docs: toxicity.score(docs, toxicity.Model([], np.zeros(0, np.float32), np.zeros(0))),
    "decontaminate": lambda docs: decontaminate.find(docs, docs.selectExpr("doc_id as item_id", "'a b' as text").limit(1)),
    "jaccard_join": lambda docs: jaccard_join.jaccard_components(docs),
    "packing": lambda docs: packing.pack_documents(docs, tokenizer_path(), 1024, 2),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_rows_reach_a_task_in_bounded_batches(spark, name, monkeypatch):
    docs = spark.range(0, 2400, 1, 1).selectExpr("id as doc_id", "concat(id, repeat(' some words', 400)) as text")
    kind, most = type(docs), text.BATCH + (64 << 10)
    given = kind.mapInArrow

    def watched(self, run, schema, *rest):
        def checked(batches):
            for batch in batches:
                assert batch.nbytes <= most, batch.nbytes
                yield batch
        return given(self, lambda batches: run(checked(batches)), schema, *rest)
    monkeypatch.setattr(kind, "mapInArrow", watched)
    assert OPERATORS[name](docs).select("doc_id").distinct().count() == 2400


def held_mb():
    """The resident memory of this process."""
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * 4096 / 1e6


@pytest.mark.skipif(sys.platform != "linux", reason="only glibc can be told to hand memory back")
def test_a_task_that_ends_hands_freed_memory_back():
    pinned = []

    def run(batches):
        # small pieces, and one after them that stays: the space before it is free but not at the end
        pieces = [bytearray(50_000) for _ in range(4_000)]
        pinned.append(bytearray(50_000))
        yield len(pieces)
    text.give_back()
    before = held_mb()
    assert list(text.lean(run)(iter([]))) == [4_000]
    assert held_mb() < before + 50
