"""Operators 2, 5, 6, 9: held-out accuracy, brute force and odd rows."""

import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cartwheel.llm import labelled, langid, pii, quality, queries, toxicity

FOLDER = "/root/testdata/sf0.01"


def joined(spark, found, label):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rows = found.join(labels, "doc_id").where("held_out").select("score", label).collect()
    return np.array([r["score"] for r in rows]), np.array([r[label] for r in rows])


def auc(score, y):
    rank = np.argsort(np.argsort(score))
    one = y == 1
    return (rank[one].sum() - one.sum() * (one.sum() - 1) / 2) / (one.sum() * (~one).sum())


def test_toxicity_on_held_out_rows(spark):
    found = queries.op2_toxicity(spark, FOLDER)
    assert found.count() == 1000
    assert auc(*joined(spark, found, "toxic")) > 0.8


def test_quality_on_held_out_rows(spark):
    found = queries.op9_quality(spark, FOLDER)
    assert auc(*joined(spark, found, "quality")) > 0.9


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    rows = queries.op6_language(spark, FOLDER).join(docs, "doc_id").where("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.9


def numeric_gradient(network, inputs, windows, y, name, at, step=1e-3):
    def loss():
        logit = network.forward(inputs, windows)
        return float(np.mean(np.log1p(np.exp(-np.abs(logit))) + np.maximum(logit, 0) - logit * y))
    kept = network.w[name][at]
    network.w[name][at] = kept + step
    high = loss()
    network.w[name][at] = kept - step
    low = loss()
    network.w[name][at] = kept
    return (high - low) / (2 * step)


def test_recurrent_gradients_are_right():
    rng = np.random.default_rng(2)
    network = toxicity.Network()
    for k in network.w:
        network.w[k] = network.w[k].astype(np.float64)
    inputs = rng.normal(size=(9, toxicity.INPUT))
    windows = rng.integers(0, 9, (3, toxicity.WINDOW))
    windows[1, 20:] = -1
    y = np.array([1.0, 0.0, 1.0])
    grads = network.gradients(inputs, windows, y)
    for name, at in (("x", (2, 5)), ("fzr", (1, 3)), ("bn", (0, 2)), ("att", (3, 1)), ("v", (2,)), ("out", (4,)), ("bx", (7,))):
        assert grads[name][at] == pytest.approx(numeric_gradient(network, inputs, windows, y, name, at), abs=1e-4)


def test_sample_has_long_texts_and_counts_the_learnable(frame):
    spark = frame([]).sparkSession
    docs = frame([(i, f"t{i} " * (1000 if i % 10 == 9 else 1)) for i in range(60)] + [(60, None)])
    # ids from 30 on are held out, those from 100 on have no text
    labels = spark.createDataFrame([(i, int(i % 3 == 0 or 30 <= i < 60)) for i in [*range(61), *range(100, 140)]],
                                   "doc_id long, toxic int")

    def sample(*limits):
        rows = labelled.sample_rows(docs, labels, "toxic", F.col("id") < 30, *limits).orderBy("y", "place", "text").collect()
        y, n = (np.array([r[c] for r in rows]) for c in ("y", "n"))
        return [r["text"] for r in rows], y, labelled.weighted(y, n)
    texts, y, weight = sample(40, 500)
    assert sorted(texts) == sorted(f"t{i} " * (1000 if i % 10 == 9 else 1) for i in range(30))
    assert np.isclose(weight[y > 0].sum(), 1 / 3)
    # together at most 10 times 450 signs of a label, whole texts in one order
    some, y, weight = sample(10, 450)
    assert 0 < len(some) <= 20 and set(some) <= set(texts) and np.isclose(weight[y > 0].sum(), 1 / 3)
    assert all(sum(len(t) for t, k in zip(some, y) if k == v) <= 4500 for v in (0, 1))


def test_tables_do_not_depend_on_the_stretches(monkeypatch):
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice(["a", "bad", "word", "é"], n)) for n in (0, 3, 40, 0, 1, 7, 100, 0)]
    words = toxicity.Words(*toxicity.T.utf8(pa.array(texts, pa.string())))
    y = (np.arange(len(texts)) % 2).astype(np.float32)
    whole = toxicity.tables([words], [y])
    for size in (1, 5, 60):
        monkeypatch.setattr(toxicity, "AT_ONCE", size)
        assert all((a == b).all() for a, b in zip(whole, toxicity.tables([words], [y])))


def test_every_word_lies_in_a_window():
    texts = [" ".join(f"w{i}" for i in range(n)) for n in (0, 1, 63, 64, 65, 300)]
    w = toxicity.Words(*toxicity.T.utf8(pa.array(texts)))
    windows, doc = w.windows()
    for row, n in enumerate((0, 1, 63, 64, 65, 300)):
        assert len(set(windows[doc == row].ravel()) - {-1}) == n


def test_a_late_word_counts(spark):
    filler = "calm words flow on and on through quiet fields " * 30
    texts = [filler + ("vile" if i % 2 else "mild") + " tail " + filler for i in range(60)]
    model = toxicity.Model(texts, np.arange(60, dtype=np.float32) % 2, np.full(60, 1 / 60))
    clean, toxic, empty = model.score(pa.array([filler * 3, filler * 20 + "vile", ""]))
    assert toxic > 0.3 > max(clean, empty)


def test_chunks_cover_the_whole_text():
    junk = "@#$%^&*!" * 40
    plain = "the quiet river runs along the old stone road "
    texts = [plain * 40 + (junk if i % 2 else "") for i in range(40)]
    model = quality.Model(texts, 1 - np.arange(40, dtype=np.float32) % 2, np.full(40, 1 / 40))
    good, late, early = model.score(pa.array([plain * 100, plain * 300 + junk, junk + plain * 300]))
    assert good > 0.3 > max(late, early)


def test_a_text_is_scored_alike_in_any_batch():
    texts = ["short", "", "a longer text " * 100, "été " * 400]
    y, w = np.array([1, 0, 1, 0], np.float32), np.full(4, 0.25)
    for module in (toxicity, quality):
        model = module.Model(texts, y, w)
        whole = model.score(pa.array(texts))
        assert whole == pytest.approx([model.score(pa.array([t]))[0] for t in texts], abs=1e-5)


@pytest.mark.parametrize("module, label", [(toxicity, "toxic"), (quality, "quality")])
def test_classifiers_on_odd_rows(spark, odd, frame, module, label):
    labels = spark.createDataFrame([(4, 0), (6, 1), (7, 1), (8, 0), (None, 1), (9, None)], f"doc_id long, {label} int")
    model = module.train(odd, labels, ~labelled.held_out("id", 4, 9))
    rows = module.score(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert module.score(frame([]), model).count() == 0
    none = module.train(odd, labels.limit(0), ~labelled.held_out("id", 4, 9))
    assert {r["score"] for r in module.score(odd, none).collect()} == {0.0}


def test_language_of_odd_rows(odd, frame):
    model = langid.train(odd, ~labelled.held_out("id", 5, 9))
    rows = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(odd, model).collect()}
    assert rows[1] == rows[2] == rows[3] == ("und", 0.0) and rows[9][0] == "en"
    assert langid.identify(frame([]), model).count() == 0
    assert langid.identify(odd, langid.train(frame([]), ~labelled.held_out("id", 5, 9))).where(
        "lang_pred != 'und'").count() == 0


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_luhn(digits):
    twice = [int(c) * (2 if i % 2 else 1) for i, c in enumerate(digits[::-1])]
    return sum(x - 9 if x > 9 else x for x in twice) % 10 == 0


def brute_spans(text):
    out = [(m.start(), 0, m.end(), "email") for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end(), "ip") for m in IP.finditer(text) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in CARD.finditer(text):
        d = re.sub(r"[^0-9]", "", m.group())
        if 14 <= len(d) <= 19 and plain_luhn(d):
            out.append((m.start(), 2, m.end(), "card"))
    out += [(m.start(), 3, m.end(), "phone") for m in PHONE.finditer(text)
            if 10 <= len(re.sub(r"[^0-9]", "", m.group())) <= 15]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


def test_base_spans_equal_the_patterns():
    rng = np.random.default_rng(4)
    signs = list("0123456789.@-+ ()aZé_%") + ["1.2.3.4", "4111111111111111", "a@b.co", "+1 (603) 555-8791", "255.", "4111 1111-1111 1111"]
    for _ in range(6000):
        text = "".join(rng.choice(signs, rng.integers(0, 30)))
        assert pii.listed(pii.base_spans(text)) == brute_spans(text), text


def test_base_spans_of_the_given_texts(spark):
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect():
        assert pii.listed(pii.base_spans(r["text"])) == brute_spans(r["text"])


def test_added_spans():
    text = "iban DE89 3704 0044 0532 0130 00 or DE88 3704 0044 0532 0130 00; call 030 1234 5678, order 030 1234 5678"
    base = pii.base_spans(text)
    found = [(text[a:b], k) for a, b, k, _ in pii.added_spans(text, base)]
    assert found == [("DE89 3704 0044 0532 0130 00", "iban"), ("030 1234 5678", "localphone")]


def test_personal_data_in_odd_rows(odd, frame):
    assert pii.find(odd).count() == odd.count()
    assert pii.find(frame([])).count() == 0
    long = ["1" * 200_000, "1." * 100_000, "a" * 200_000 + "@", "@" * 100_000, "+1" * 100_000, "A1" * 100_000]
    for text in long:
        pii.base_spans(text), pii.added_spans(text, [])
    assert pii.redacted("to a@b.co", [{"start": 3, "end": 9, "kind": "email"}]) == "to [email]"
