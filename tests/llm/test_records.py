"""Operators 3, 4 and 10 and the pipeline."""

import gzip
import io
import json
import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from cartwheel.llm import packing, queries, tool_calls, warc
from cartwheel.llm.tokens import Encoder


# ---- archives --------------------------------------------------------------------------------------------------------
def test_round_trip(spark):
    rows = [(5, "http://a", "same"), (2, "http://b", "same"), (9, None, None), (3, "u", ""), (None, "n", "other"),
            (7, "u\r\nX: y", "WARC/1.1\r\nfake\r\n\r\n é"), (2, "http://b", "same")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = defaultdict(set)
    found = warc.round_trip(pages).collect()
    assert len(found) == len(rows)
    for r in found:
        got[r["page_id"]].add((r["payload_bytes"], r["payload_digest"], r["type"], r["refers_to"]))
    def told(text, kind, first=None):
        return {(len(text.encode()), warc.digest(text.encode()), kind, first)}
    assert got == {5: told("same", "revisit", 2), 2: told("same", "response"), 9: told("", "revisit", 3),
                   3: told("", "response"), None: told("other", "response"), 7: told(rows[5][2], "response")}
    assert warc.round_trip(pages.limit(0)).count() == 0
    large = warc.round_trip(pages, least_bytes=10)
    assert {r["type"] for r in large.collect()} == {"response"}


def archive(texts, packed):
    records = [warc.record(i, f"u{i}", t, None, False) for i, t in enumerate(texts)]
    return [gzip.compress(r) for r in records] if packed else records


def salvaged(data):
    return list(warc.salvage(pa.PythonFile(io.BytesIO(data), mode="r")))


@pytest.mark.parametrize("packed", [True, False])
def test_salvage_recovers_what_is_whole(packed):
    rng = random.Random(3)
    texts = [bytes(rng.randrange(256) for _ in range(rng.choice((0, 10, 5000)))) for _ in range(12)]
    texts[4] += b"WARC/1.1\r\n\r\n" + warc.MAGIC
    parts = archive(texts, packed)
    assert [r[4] for r in salvaged(b"".join(parts))] == texts
    for _ in range(40):
        bad = sorted(rng.sample(range(12), 2))
        damaged = list(parts)
        for b in bad:
            kind = rng.randrange(3)
            at = rng.randrange(len(parts[b]) // 4, len(parts[b]) // 2 + 1)
            damaged[b] = (damaged[b][:at] + bytes([damaged[b][at] ^ 0x55]) + damaged[b][at + 1:] if kind == 0
                          else damaged[b][:at] if kind == 1 else b"noise" + damaged[b])
        data, found = b"".join(damaged), salvaged(b"".join(damaged))
        # every byte is in a record or in a gap, in order
        assert [r[0] for r in found] == [0, *(r[1] for r in found[:-1])] and found[-1][1] == len(data)
        names = {r[3].get("warc-target-uri"): r[4] for r in found if r[2] is None}
        for i, text in enumerate(texts):
            if i not in bad:
                assert names[f"u{i}"] == text


@pytest.mark.parametrize("packed", [True, False])
def test_salvage_survives_any_damage_to_headers(packed, tmp_path, spark):
    rng = random.Random(11)
    parts = [warc.record(i, f"u{i}", b"text %d" % i, i - 1, i % 3 == 2) for i in range(6)]
    signs = ["\u00b2".encode(), b"9" * 5000, b"-1", b"\r\n", b":", b"\xff", b"\x00", b" ", b"WARC/", b"<urn:uuid:1>", b""]
    paths = []
    for turn in range(300):
        damaged = [*parts]
        b = rng.randrange(6)
        at = (damaged[b].find(b"Content-Length: ") + 16 if turn % 4 == 0 else
              damaged[b].find(b"urn:page") + 9 if turn % 4 == 1 else rng.randrange(damaged[b].find(warc.END)))
        damaged[b] = damaged[b][:at] + rng.choice(signs) + damaged[b][at + rng.randrange(3):]
        data = b"".join(gzip.compress(r) if packed else r for r in damaged)
        found = salvaged(data)
        assert [r[0] for r in found] == [0, *(r[1] for r in found[:-1])] and found[-1][1] == len(data)
        names = {r[3].get("warc-target-uri") for r in found if r[2] is None}
        assert {f"u{i}" for i in range(6) if i != b and (packed or i != b + 1)} <= names
        if turn % 10 == 0:
            paths.append(str(tmp_path / f"{turn}.warc"))
            (tmp_path / f"{turn}.warc").write_bytes(data)
    got = warc.read(spark.createDataFrame([(x,) for x in paths], "path string"), keep_payload=True).collect()
    assert {r["path"] for r in got} == set(paths)


def test_archives_of_others(tmp_path, spark):
    page = b"<html>\r\n\r\nbody</html>"
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n" + page
    sha1 = warc.digest(block)
    def one(kind, name, content, **fields):
        told = "".join(f"{k.replace('_', '-')}: {v}\r\n" for k, v in fields.items())
        return (f"WARC/1.0\r\nwarc-type: {kind}\r\nWARC-RECORD-ID: {name}\r\n{told}content-length:{len(content)}\r\n"
                "\r\n").encode() + content + warc.END
    records = [one("warcinfo", "<urn:uuid:0>", b"software: x\r\n"),
               one("response", "<urn:uuid:1>", block, content_type="application/http; msgtype=response",
                   WARC_Payload_Digest="sha1:" + warc.digest(page), warc_block_digest="SHA1:" + sha1),
               one("response", "<urn:uuid:2>", block, warc_block_digest="sha1:" + warc.digest(page)),
               one("resource", "<urn:page:7>", b"plain", warc_block_digest="md5:0123")]
    for name, data in (("plain", b"".join(records)), ("packed", b"".join(map(gzip.compress, records)))):
        (tmp_path / name).write_bytes(data)
        got = sorted(warc.read(spark.createDataFrame([(str(tmp_path / name),)], "path string"), keep_payload=True).collect(),
                     key=lambda r: r["start"])
        assert [(r["type"], r["record_id"], r["page_id"], r["reason"]) for r in got] == [
            ("warcinfo", "<urn:uuid:0>", None, None), ("response", "<urn:uuid:1>", None, None),
            (None, None, None, "block digest differs"), ("resource", "<urn:page:7>", 7, None)]
        assert bytes(got[1]["payload"]) == page and got[1]["payload_bytes"] == len(page)


def test_pages_with_long_payloads_and_clashing_names(spark):
    rows = [(1, "u", "x" * 3_000_000, "p", "s"), (2, "u", "x" * 3_000_000, "p", "s"), (3, "v", "short", "p", "s")]
    got = warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string, path string, sha string")).collect()
    assert {r["page_id"]: (r["type"], r["payload_bytes"], r["refers_to"]) for r in got} == {
        1: ("response", 3_000_000, None), 2: ("revisit", 3_000_000, 1), 3: ("response", 5, None)}


def test_salvage_of_nothing_and_of_junk():
    assert salvaged(b"") == []
    assert [r[:2] for r in salvaged(b"junk" * 1000)] == [(0, 4000)]


# ---- tool calls ------------------------------------------------------------------------------------------------------
TOOLS = [("search", "query", "string", True), ("search", "top", "integer", False), ("sum", "of", "array", True),
         ("sum", "exact", "boolean", False), ("sum", "by", "number", False), ("sum", "more", "object", False)]


def linked(spark, calls, results):
    c = spark.createDataFrame(calls, "conv_id long, turn long, call_id string, name string, arguments string, "
                                     "needs array<string>")
    r = spark.createDataFrame(results, "conv_id long, turn long, call_id string, content string")
    s = spark.createDataFrame(TOOLS, "name string, param string, kind string, required boolean")
    return tool_calls.link(c, r, s).collect()


def test_calls(spark):
    calls = [(1, 1, "a", "search", '{"top": 3,  "query": "é\\n\\"x"}', []),
             (1, 1, "b", "sum", '{"of": [1, 2.5], "by": 1.5, "exact": true, "more": {"z": 1, "a": null}}', ["a"]),
             (1, 3, "c", "sum", '{"of": 3, "what": 1}', ["b", "gone"]), (1, 5, "d", "nothing", "{}", ["e"]),
             (1, 5, "e", "search", "[1]", ["d"]), (1, 7, "a", "search", '{"query": 1}', None),
             (2, 1, None, "search", None, None), (2, 1, "a", None, "{bad", []), (None, 1, "z", "search", '{"query": ""}', [])]
    results = [(1, 2, "a", "first"), (1, 4, "a", "late"), (1, 2, "b", None), (3, 1, "q", "lost"), (2, 2, None, "no id")]
    got = {(r["conv_id"], r["turn"], r["call_id"]): r for r in linked(spark, calls, results)}
    assert len(got) == len(calls) + 3
    told = {k: (r["status"], r["step"], r["problems"]) for k, r in got.items()}
    assert told[1, 1, "a"] == ("ok", 0, []) and told[1, 1, "b"] == ("ok", 1, [])
    assert told[1, 3, "c"] == ("invalid", 2, ["type of of", "unknown what"])
    assert told[1, 5, "d"][:2] == told[1, 5, "e"][:2] == ("circular", None)
    assert told[1, 7, "a"][0] == "repeated" and told[1, 4, "a"][0] == "orphan" and told[3, 1, "q"][0] == "orphan"
    assert told[2, 1, "a"] == ("invalid", 0, ["unknown tool"])
    assert told[2, 1, None][2] == ["arguments are no object"] and told[None, 1, "z"][0] == "unanswered"
    text = got[1, 1, "a"]["json"]
    parsed = json.loads(text)
    assert parsed == {"arguments": {"query": 'é\n"x', "top": 3}, "id": "a", "name": "search", "result": "first",
                      "status": "ok", "step": 0}
    assert text == json.dumps(parsed, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert linked(spark, [], []) == []


def brute_steps(needs):
    """The step of every call, by names; None in or above a circle."""
    step = {}
    while True:
        free = [c for c in needs if c not in step and all(n in step for n in needs[c] if n in needs)]
        if not free:
            return {c: step.get(c) for c in needs}
        step |= {c: 1 + max((step[n] for n in needs[c] if n in needs), default=-1) for c in free}


def test_steps_of_long_chains_and_meshes_equal_brute_force(spark):
    rng = random.Random(2)
    needs = {f"c{i}": [f"c{i - 1}"] if i else [] for i in range(300)}                         # one long chain
    needs |= {f"m{i}": [f"m{rng.randrange(i)}" for _ in range(rng.choice((0, 1, 1, 1, 2, 3)))] if i else [] for i in range(150)}
    needs |= {"o0": ["o2"], "o1": ["o0"], "o2": ["o1"], "o3": ["o2"], "o4": ["o3", "c5"], "o5": ["o4"], "s": ["s"], "g": ["gone"]}
    calls = [(1, rng.randrange(50), c, "search", '{"query": "x"}', n) for c, n in needs.items()]
    got = {r["call_id"]: r["step"] for r in linked(spark, calls, [])}
    assert got == brute_steps(needs) and got["c299"] == 299 and got["o5"] is None and got["g"] == 0


def test_calls_with_long_arguments_clashing_names_and_one_side_only(spark):
    long = '{"query": "' + "y" * 2_000_000 + '"}'
    calls = spark.createDataFrame([(1, 1, "a", "search", long, [], 5, "k")], "conv_id long, turn long, call_id string, "
                                  "name string, arguments string, needs array<string>, step int, key string")
    results = spark.createDataFrame([(1, 2, "a", "z", 7)], "conv_id long, turn long, call_id string, content string, step int")
    schemas = spark.createDataFrame(TOOLS, "name string, param string, kind string, required boolean")
    both = tool_calls.link(calls, results, schemas).collect()
    assert [(r["status"], r["step"], len(r["json"]) > 2_000_000) for r in both] == [("ok", 0, True)]
    assert [r["status"] for r in tool_calls.link(calls, results.limit(0), schemas).collect()] == ["unanswered"]
    assert [r["status"] for r in tool_calls.link(calls.limit(0), results, schemas).collect()] == ["orphan"]
    assert [r["status"] for r in tool_calls.link(calls, results, schemas.limit(0)).collect()] == ["invalid"]


# ---- packing ---------------------------------------------------------------------------------------------------------
def filled(runs):
    got = defaultdict(int)
    for members, times in runs:
        assert times > 0
        for m in members:
            got[m] += times
    return dict(got)


def fewest(counts, capacity):
    items = sorted((s for s, n in counts.items() for _ in range(n)), reverse=True)
    best = len(items)
    def go(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(items):
            best = len(rooms)
            return
        for j in {r: j for j, r in enumerate(rooms)}.values():
            if rooms[j] >= items[i]:
                go(i + 1, [*rooms[:j], rooms[j] - items[i], *rooms[j + 1:]])
        go(i + 1, [*rooms, capacity - items[i]])
    go(0, [])
    return best


def test_search_is_whole_and_near_the_least():
    rng = random.Random(8)
    for _ in range(150):
        counts = defaultdict(int)
        for _ in range(rng.randint(0, 9)):
            counts[rng.randint(1, 20)] += 1
        runs, proven = packing.pack(dict(counts), 20)
        assert filled(runs) == dict(counts) and all(sum(m) <= 20 for m, _ in runs)
        least, used = fewest(counts, 20), sum(n for _, n in runs)
        assert used <= least + 1 and (used == least or not proven or used - least <= 1)
        assert used <= sum(n for _, n in packing.best_fit(dict(counts), 20))


def test_a_proven_packing_is_the_least():
    # 9 + 8 + 3 and 9 + 7 + 4 are no best fits
    runs, proven = packing.pack({10: 1, 9: 2, 8: 1, 7: 1, 5: 2, 4: 1, 3: 1}, 20)
    assert proven and sum(n for _, n in runs) == 3
    rng = random.Random(5)
    for _ in range(300):
        lengths = rng.choice((range(1, 21), (3, 4, 5, 7, 8, 9, 10, 11)))
        counts = Counter(rng.choice(lengths) for _ in range(rng.randint(1, 12)))
        runs, proven = packing.pack(dict(counts), 20)
        assert proven and filled(runs) == dict(counts) and sum(n for _, n in runs) == fewest(counts, 20)
    # too few nodes for a whole tree
    assert not packing.pack({10: 1, 9: 2, 8: 1, 7: 1, 5: 2, 4: 1, 3: 1}, 20, nodes=1)[1]


def test_undominated_fillings_equal_brute_force():
    rng = random.Random(6)
    for _ in range(60):
        counts, room = Counter(rng.randint(1, 12) for _ in range(rng.randint(1, 8))), rng.randint(1, 20)
        every = {tuple(sorted(c, reverse=True)) for k in range(9) for c in combinations(counts.elements(), k)
                 if sum(c) <= room}
        def dominated(f):
            spare = counts - Counter(f)
            parts = [p for k in range(len(f) + 1) for p in combinations(f, k)]
            return any(x >= sum(p) and x not in p and sum(f) - sum(p) + x <= room for x in spare for p in parts)
        got = [f for f in packing.undominated(dict(counts), room) if f is not None]
        assert len(got) == len(set(got)) and set(got) == {f for f in every if not dominated(f)}


def test_search_over_large_counts():
    rng = random.Random(9)
    counts = {s: rng.randint(1, 10 ** 9) for s in range(1, 1025)}
    runs, _ = packing.pack(counts, 1024, nodes=3000)
    assert filled(runs) == counts and all(sum(m) <= 1024 for m, _ in runs) and len(runs) < 20_000
    total = sum(s * n for s, n in counts.items())
    alone = sum(n for s, n in counts.items() if s > 512)
    assert sum(n for _, n in runs) < 1.01 * max(total / 1024, alone)


def reference_ids(texts):
    t = Tokenizer.from_file(queries.tokenizer_path())
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_ids_equal_the_library():
    rng = random.Random(1)
    signs = list("a's't're've'll'm'dS'  \n\t 　é1²½٣,.!\u0085\u001c​中日\U0001d4b3́") + ["<|endoftext|>", "don't", "\r\n"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    texts += ["", " ", "it's", "'re", " 's", "''s", "x'", "'", "x <|endoftext|> y", "<|endoftext|><|endoftext|>", "a<|endoftext|"]
    ids, at = Encoder(queries.tokenizer_path())(texts)
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == reference_ids(texts)


def test_packed_documents(odd, frame):
    got = packing.pack_documents(odd, queries.tokenizer_path(), 64, 2, keep_ids=True).collect()
    texts = [r["text"] or "" for r in odd.collect()]
    want = sorted(tuple([*ids, 2]) for ids in reference_ids(texts))
    by_start = defaultdict(list)
    for r in got:
        assert zlib.crc32(b"".join(i.to_bytes(4, "little") for i in r["ids"])) == r["ids_crc32"]
        assert len(r["ids"]) == r["length"] <= 64
        by_start[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by_start.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(r["length"] for r in got)
    assert total == sum(map(len, want)) and len(by_start) <= -(-total // 64) + 1
    for r in (r for r in got if r["piece"]):
        assert r["length"] == 64
    assert packing.pack_documents(frame([]), queries.tokenizer_path()).count() == 0


def test_a_row_that_repeats_is_ranked_in_slots_of_its_place(spark, frame, monkeypatch):
    monkeypatch.setattr(packing, "SLOT_ROWS", 50)
    rows = spark.range(0, 4000, 1, 6).selectExpr("7 AS doc_id", "if(id % 3 = 0, 'one <|endoftext|> two', 'one') AS text")
    got = packing.pack_documents(rows, queries.tokenizer_path(), 64, 2).collect()
    assert len(got) == 4000 and len({(r["sequence_id"], r["offset"]) for r in got}) == 4000
    ends = defaultdict(int)
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends[r["sequence_id"]]
        ends[r["sequence_id"]] += r["length"]
    assert max(ends.values()) <= 64 and len(ends) == -(-sum(ends.values()) // 64)


# ---- pipeline --------------------------------------------------------------------------------------------------------
def test_stages_keep_the_columns_and_what_is_clean(spark, odd):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        kept = stage(spark, docs, folder)
        assert kept.columns == docs.columns, name
        assert 0 < kept.count() <= docs.count()
        again = stage(spark, odd, folder)
        assert again.columns == odd.columns and again.count() > 0
    copies = corpus_pipeline.drop_copies(spark, odd, folder)
    assert copies.count() == odd.selectExpr("coalesce(text, '') AS t").distinct().count()


def test_pipeline(spark):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert got.count() > 0
