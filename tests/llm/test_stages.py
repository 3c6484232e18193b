"""The stages of the pipeline against brute force."""

import hashlib
import zlib
from collections import Counter, defaultdict

import pyarrow as pa

import corpus_pipeline
from cartwheel.llm import labelled, toxicity
from test_records import reference_ids
from test_similarity import brute_components, brute_hits, shingles, variants


def sha(text):
    return hashlib.sha256((text or "").encode()).digest()


def brute_firsts(rows, k=5, num=80, den=100):
    """One (id, text) of every group of near copies: the smallest id, null ids last, then the smallest digest."""
    # brute_components names rows by ids, so every row gets its own
    names = {c[0]: c[2] for c in brute_components(list(enumerate(t for _, t in rows)), k, num, den)}
    groups = defaultdict(list)
    for i, (d, t) in enumerate(rows):
        groups[names[i] if shingles(t, k) else ("alone", d, t or "")].append((d is None, d or 0, sha(t), i))
    return sorted((rows[min(g)[3]][0] or -1, rows[min(g)[3]][1] or "") for g in groups.values())


def test_one_row_of_every_group_of_near_copies_stays(spark, frame):
    words = [f"w{i}" for i in range(40)]
    a, near_a, other = " ".join(words), " ".join([*words[:39], "x"]), " ".join(f"o{i}" for i in range(30))
    near_other = other + " z"
    rows = [(5, a), (None, near_a), (None, "a lone text of more than five words"), (None, other), (None, near_other),
            (7, "one id on two texts and a near copy of the second"), (7, a + " y"), (None, None), (None, " "), (8, ""),
            (5, a), (5, "text that leads its own group here"), (9, "Text that leads its own group here")]
    rows += [(d % 9 or None, t) for d, t in variants(3, 60)]
    kept = corpus_pipeline.drop_near_copies(spark, frame(rows), "")
    assert sorted((r["doc_id"] or -1, r["text"] or "") for r in kept.collect()) == brute_firsts(rows)


def listed(frame):
    return Counter((r["doc_id"], r["text"]) for r in frame.collect())


def test_copies_keep_the_largest_id(spark, frame):
    rows = [(3, "a"), (9, "a"), (None, "a"), (9, "a"), (9, "b"), (None, "c"), (None, "c"), (4, None), (6, ""), (5, " ")]
    assert listed(corpus_pipeline.drop_copies(spark, frame(rows), "")) == Counter(
        [(9, "a"), (9, "b"), (None, "c"), (6, ""), (5, " ")])


def test_toxicity_rejects_by_the_score_of_the_whole_text(spark, frame, tmp_path):
    rows = [(i, f"you {'awful vile' if i % 4 == 0 else 'kind calm'} thing {i}") for i in range(240)]
    rows += [(500, "calm words " * 900 + "awful vile"), (501, "calm words " * 900), (None, "awful vile"), (502, None)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(240)], "doc_id long, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs = frame(rows)
    model = toxicity.train(docs, labels, ~labelled.held_out("id", 4, 2))
    scores = model.score(pa.array([t for _, t in rows]))
    kept = listed(corpus_pipeline.drop_toxic(spark, docs, str(tmp_path)))
    assert kept == Counter(r for r, s in zip(rows, scores) if s < corpus_pipeline.TOXIC)
    assert sum((d, t) in kept for d, t in rows[:240] if d % 4 == 0) <= 3
    assert sum((d, t) in kept for d, t in rows[:240] if d % 4) >= 177


def test_contaminated_documents_go(spark, frame, tmp_path):
    item = " ".join(f"w{i}" for i in range(14))
    rows = [(1, f"x {item} y"), (1, "clean"), (None, " ".join(item.split()[3:13])), (None, " ".join(item.split()[:9])),
            (2, "Short, ITEM here"), (3, None), (3, None), (4, item.replace(" ", "-"))]
    bench = [(1, item), (2, "short item"), (3, None)]
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = listed(corpus_pipeline.drop_contaminated(spark, frame(rows), str(tmp_path)))
    assert kept == Counter((d, t) for d, t in rows if not brute_hits(t, bench)[1])
    assert sum(kept.values()) == 4


def test_all_pieces_of_what_is_left_are_packed(spark, odd):
    got = corpus_pipeline.pack(spark, odd, "").collect()
    rows = [(r["doc_id"], r["text"] or "") for r in odd.collect()]
    ids = reference_ids([t for _, t in rows])
    want = Counter()
    for (d, _), own in zip(rows, ids):
        own = [*own, corpus_pipeline.END_ID]
        at = [0, *range(len(own) % 1024 or 1024, len(own) + 1, 1024)]
        for k, (a, b) in enumerate(zip(at, at[1:])):
            want[d, k, a, b - a, zlib.crc32(b"".join(i.to_bytes(4, "little") for i in own[a:b]))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    ends = defaultdict(int)
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends[r["sequence_id"]]
        ends[r["sequence_id"]] += r["length"]
    assert max(ends.values()) <= 1024
