"""Held-out accuracy on the small tables and the awkward cases."""

import zlib

import numpy as np

from tests.llm.fixtures import ROWS, documents
from waymesh.llm import langid, toxicity

SF = "/root/testdata/sf0.01"


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r["doc_id"]: r for r in langid.op9_language_id(docs).collect()}
    rows = docs.select("doc_id", "lang").collect()
    assert len(got) == len(rows)
    assert all(got[r["doc_id"]]["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if got[r["doc_id"]]["held_out"]]
    assert sum(got[r["doc_id"]]["lang_pred"] == r["lang"] for r in held) >= 0.97 * len(held)


def test_language_awkward_texts(spark):
    docs = documents(spark)
    got = langid.op9_language_id(docs).collect()
    assert len(got) == len(ROWS)
    by = {r["doc_id"]: r for r in got}
    assert all(by[k]["lang_pred"] == "und" and by[k]["score"] == 0 for k in (0, 1, 2, 14))
    assert by[5]["lang_pred"] in ("de", "en") and all(0 <= r["score"] <= 1 for r in got)
    assert langid.op9_language_id(documents(spark, [])).count() == 0
    none = documents(spark, [(1, "some words", None, None)])
    assert langid.op9_language_id(none).first()["lang_pred"] == "und"
    kept = langid.keep_identified(docs, langid.fit(langid.learned_part(docs)))
    assert kept.columns == docs.columns and {0, 1, 2}.isdisjoint({r["doc_id"] for r in kept.collect()})


def test_long_text_is_read_whole(monkeypatch):
    text = " ".join(f"wort{k}" for k in range(500))
    whole = langid.ngram_counts(text)
    monkeypatch.setattr(langid, "CHUNK", 64)
    assert np.array_equal(langid.ngram_counts(text), whole)


def test_codewords_are_apart():
    for n in (2, 3, 4, 5, 12, 40):
        code = langid.codewords(n)
        assert len(code) == n and len({tuple(r) for r in code}) == n


def test_toxicity_held_out(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = {r["doc_id"]: r for r in toxicity.op5_toxicity(docs, labels).collect()}
    held = [r for r in labels.collect() if got[r["doc_id"]]["held_out"] and r["toxic"] is not None]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got.values())
    clean = [r for r in held if not r["toxic"]]
    assert sum(got[r["doc_id"]]["predicted"] for r in clean) <= 0.05 * len(clean)
    assert sum(got[r["doc_id"]]["predicted"] == r["toxic"] for r in held) >= 0.88 * len(held)


def test_toxicity_locates_the_sentence(spark):
    plain = [f"a calm sentence number {k % 17}. Another one here." for k in range(300)]
    rows = [(k, t if k % 3 else t + " You are a grobian today.", "en", "s") for k, t in enumerate(plain)]
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(300)], "doc_id long, toxic int")
    model = toxicity.fit(toxicity.learned_part(documents(spark, rows), labels))
    text = "A calm sentence. You are a grobian today! Another one."
    found = model.locate(text)
    assert [text[a:b].strip() for a, b, _ in found] == ["You are a grobian today!"]
    assert model.score(text) > 0.7 > model.score("A calm sentence.")
    assert abs(model.score(text) - (1 - np.prod([1 - model.sentence(s) for s in ("A calm sentence.", "You are a grobian today!", "Another one.")]))) < 1e-9


def test_toxicity_awkward_texts(spark):
    docs = documents(spark)
    empty = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity.op5_toxicity(docs, empty).collect()} == {0.0}
    ones = spark.createDataFrame([(k, 1) for k in range(16)], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity.op5_toxicity(docs, ones).collect()} == {1.0}
    assert toxicity.op5_toxicity(documents(spark, []), empty).count() == 0


def test_decoding_is_the_nearest_codeword(spark):
    """The language of each text by plain loops over codewords, bits and features."""
    import math

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = langid.fit(langid.learned_part(docs))
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.op9_language_id(docs).collect()}
    for r in docs.limit(60).collect():
        x = langid.features(r["text"])
        if x is None:
            assert got[r["doc_id"]] == ("und", 0.0)
            continue
        losses = []
        for word in model.code:
            margins = [sum(float(a) * float(w) for a, w in zip(x, model.weights[:, b]) if a) + float(model.bias[b]) for b in range(len(word))]
            losses.append(sum(math.log1p(math.exp(-float(s) * m)) * float(t) for s, m, t in zip(word, margins, model.bit_weight)))
        best = min(range(len(losses)), key=lambda k: losses[k])
        share = 1 / sum(math.exp(losses[best] - v) for v in losses)
        assert got[r["doc_id"]][0] == model.languages[best] and abs(got[r["doc_id"]][1] - share) < 1e-3


def test_toxicity_score_and_spans_are_those_of_the_sentences(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(toxicity.learned_part(docs, labels))
    got = {r["doc_id"]: r for r in toxicity.op5_toxicity(docs, labels).collect()}
    for r in docs.collect():
        each = [(a, b, model.sentence((r["text"] or "")[a:b])) for a, b in toxicity.sentences(r["text"])]
        score = 1 - np.prod([1 - p for *_, p in each])
        said = got[r["doc_id"]]
        assert abs(said["score"] - score) < 1e-9
        want = [x for x in each if x[2] >= 0.5] or [max(each, key=lambda x: (x[2], -x[0]))]
        assert said["offending"] == (",".join(f"{a}:{b}" for a, b, _ in want) if said["predicted"] else "")
    assert any(r["predicted"] for r in got.values())
