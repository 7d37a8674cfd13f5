import math
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece

from tests.llm.fixtures import ROWS, documents
from waymesh.llm import sp_sampling

MODEL = public_tokenizers.path("piece_bpe_32k.model")
VOCABULARY = sp_sampling.Vocabulary(MODEL)


def everything(text):
    """All segmentations of a text with their probabilities."""
    text = " " + text
    parts = {0: [((), 0.0)]}
    for j in range(1, len(text) + 1):
        parts[j] = []
        for i in range(max(0, j - VOCABULARY.longest), j):
            p = VOCABULARY.log.get(text[i:j])
            if p is None and j == i + 1:
                p = (VOCABULARY.size + ord(text[i]), sp_sampling.BYTE_LOG)
            if p is not None:
                parts[j] += [((*s, p[0]), x + p[1]) for s, x in parts[i]]
    total = sum(math.exp(x) for _, x in parts[len(text)])
    return {tuple(VOCABULARY.symbols(np.array(s)).tolist()): math.exp(x) / total for s, x in parts[len(text)]}


def test_probabilities_and_order_of_draws():
    for text in ("in an", "a", "to be 中\U0001f680"):
        exact, n, k = everything(text), 6000, 3
        drawn = sp_sampling.Sampler(VOCABULARY, k).sample([f"row{i}" for i in range(n)], [text] * n)
        first, second = Counter(), Counter()
        for samples in drawn:
            ids = [tuple(s[0].tolist()) for s in samples]
            assert len(set(ids)) == len(ids) == min(k, len(exact))
            values = [s[2] for s in samples]
            assert values == sorted(values, reverse=True)
            for i, s in zip(ids, samples):
                assert math.isclose(math.exp(s[1]), exact[i], rel_tol=1e-9)
                assert 0 < s[3] <= 1
            first[ids[0]] += 1
            if len(ids) > 1:
                second[ids[1]] += 1
        for ids, p in exact.items():
            assert abs(first[ids] / n - p) < 4.5 * math.sqrt(p * (1 - p) / n) + 1e-9
            q = sum(x * p / (1 - x) for i, x in exact.items() if i != ids and x < 1)
            assert abs(second[ids] / n - q) < 4.5 * math.sqrt(max(q * (1 - q), 1e-12) / n) + 1e-9


def test_inclusion_weights_are_unbiased():
    """Sum of weights p / inclusion over the sample estimates 1."""
    exact, n = everything("the inner"), 3000
    drawn = sp_sampling.Sampler(VOCABULARY, 4).sample([str(i) for i in range(n)], ["the inner"] * n)
    sums = [sum(math.exp(s[1]) / s[3] for s in samples) for samples in drawn]
    assert abs(np.mean(sums) - 1) < 0.05 and len(exact) > 4


def test_samples_do_not_depend_on_the_batch():
    texts = [t for _, t, *_ in ROWS]
    keys = [str(k) for k in range(len(texts))]
    together = sp_sampling.Sampler(VOCABULARY, 2).sample(keys, texts)
    for k in (0, 5, 6, 9, 13):
        alone = sp_sampling.Sampler(VOCABULARY, 2).sample([keys[k]], [texts[k]])[0]
        assert [(a[0].tolist(), a[2]) for a in alone] == [(b[0].tolist(), b[2]) for b in together[k]] or all(np.allclose(a[1:], b[1:]) and (a[0] == b[0]).all() for a, b in zip(alone, together[k]))


def test_all_rows_round_trip(spark):
    rows = [*ROWS, (70, "x▁y  ▁ z", None, None), (71, "w" * 5000, None, None), (72, " lead and trail  ", None, None)]
    got = sp_sampling.sample_segmentations(documents(spark, rows), MODEL, k=3)
    made = sp_sampling.decoded(got, MODEL).collect()
    assert all(r["round_trip"] for r in made)
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert all(library.decode(np.frombuffer(r["ids"], dtype="<u4").tolist()) == r["decoded"] for r in made)
    texts = {}
    for d, t, *_ in rows:
        texts.setdefault(d, set()).add(t or "")
    assert all(r["decoded"] in texts[r["doc_id"]] for r in made)
    per = Counter((r["doc_id"], r["sample"]) for r in made)
    assert per[(0, 0)] == per[(1, 0)] == 1 and (0, 1) not in per  # null and empty
    assert per[(5, 0)] == per[(5, 2)] == 2  # a repeated row
    again = {(r["doc_id"], r["sample"], bytes(r["ids"])) for r in got.repartition(3).collect()}
    assert again == {(r["doc_id"], r["sample"], bytes(r["ids"])) for r in made}
    assert sp_sampling.op4_segmentation_sampling(documents(spark, []), MODEL).count() == 0

