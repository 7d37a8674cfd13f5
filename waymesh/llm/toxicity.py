"""Toxicity by multiple-instance learning.

A document is a bag of sentences. Each sentence gets a probability from a logistic model
of its words; the document's score is their noisy-or, 1 - prod(1 - p). Only documents
carry labels: training follows the gradient through the noisy-or, so the weight settles
on the words of the sentences that explain the label. The same sentence scores then say
where the offending sentences are (``locate``).

A label may also be set without any offending sentence; the share of such labels is
fitted along with the weights, and is no part of a score.

Defined cases: a null or empty text, and one without a word, is a bag of one empty
sentence and gets the (small) probability of that. With no labelled rows, or only one kind
of label, every score is the share of label 1 (0 without rows), and no sentence is blamed.
Repeated rows are scored alike. Texts are read whole.

Bounds of learning, all of them parameters or constants here: ``rows`` labelled rows,
``most_features`` features, and no feature from words of over ``LONGEST_WORD`` characters.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymesh.llm.common import fold, fresh

SENTENCE_END = re.compile(r"[.!?\n]+")
WORD = re.compile(r"\w+")
#: Longer words are never features. Words whose weights are kept at hand while scoring.
LONGEST_WORD, CACHED_WORDS = 40, 150_000


def sentences(text: str | None) -> Iterator[tuple[int, int]]:
    """Start and end of each sentence that isn't blank; one empty sentence if there is none."""
    at, found = 0, False
    for m in SENTENCE_END.finditer(text or ""):
        if WORD.search(text, at, m.start()):
            found = True
            yield at, m.end()
        at = m.end()
    if text and WORD.search(text, at):
        yield at, len(text)
    elif not found:
        yield 0, 0


def parts(word: str) -> list[str]:
    """Features of a word: itself, and its beginnings of 3 to 8 characters that don't reach
    its end. Inflected and compounded forms share the latter."""
    return [word, *(word[:k] + "-" for k in range(3, min(9, len(word))))]


def bag(text: str | None, known: dict[str, int]) -> list[list[int]]:
    """Per sentence the distinct known features, by number."""
    found = []
    for part in SENTENCE_END.split((text or "").lower()):
        if words := set(WORD.findall(part)):
            found.append(sorted({known[f] for w in words for f in parts(w) if f in known}))
    return found or [[]]


@dataclass(frozen=True)
class ToxicityModel:
    bias: float
    weights: dict[str, float] = field(default_factory=dict)
    constant: float | None = None

    def word(self, word: str) -> float:
        weights = self.weights
        return math.fsum(weights[f] for f in parts(word) if f in weights)

    def sentence(self, part: str) -> float:
        """Probability that one sentence offends."""
        x = self.bias + math.fsum(map(self.word, set(WORD.findall(part.lower()))))
        return 1 / (1 + math.exp(-x)) if x > -700 else 0.0

    def score(self, text: str | None, cache: dict[str, float] | None = None) -> float:
        """``cache``: weights of words met before; kept within ``CACHED_WORDS``."""
        if self.constant is not None:
            return self.constant
        cache = {} if cache is None else cache
        if len(cache) > CACHED_WORDS:
            cache.clear()
        plain = math.log1p(math.exp(self.bias))
        total, any_words = 0.0, False
        for part in SENTENCE_END.split((text or "").lower()):
            words = WORD.findall(part)
            if not words:
                continue
            any_words, sum_ = True, 0.0
            for w in sorted(set(words)) if len(words) > 1 else words:
                if (v := cache.get(w)) is None:
                    v = cache[w] = self.word(w)
                sum_ += v
            if sum_:
                x = self.bias + sum_
                total += x + math.log1p(math.exp(-x)) if x > 0 else math.log1p(math.exp(x))
            else:
                total += plain
        return -math.expm1(-(total if any_words else plain))

    def locate(self, text: str | None, threshold: float = 0.5) -> list[tuple[int, int, float]]:
        """(start, end, probability) of the sentences at or over ``threshold``."""
        if self.constant is not None:
            return []
        found = [(a, b, self.sentence(text[a:b])) for a, b in sentences(text) if b]
        return [x for x in found if x[2] >= threshold]

    def blamed(self, text: str | None, threshold: float = 0.5) -> list[tuple[int, int, float]]:
        """The sentences that ``locate`` gives, or the worst if it gives none: a document can
        be toxic by many sentences of middling probability."""
        found = self.locate(text, 0.0)
        return [x for x in found if x[2] >= threshold] or sorted(found, key=lambda x: (-x[2], x[0]))[:1]


def learn(bags: list[list[list[int]]], labels: np.ndarray, words: list[str], rounds: int = 250, decay: float = 2e-5) -> ToxicityModel:
    """Full-batch Adam on the log-likelihood of the document labels."""
    share = float(labels.mean()) if len(labels) else 0.0
    if share in (0.0, 1.0):
        return ToxicityModel(0.0, {}, share)
    lengths = [len(s) for b in bags for s in b]
    sentence_of = np.repeat(np.arange(len(lengths)), lengths)
    doc_of = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    ids = np.fromiter((w for b in bags for s in b for w in s), dtype=np.int64, count=len(sentence_of))
    y, n = labels.astype(np.float64), len(bags)
    at = np.concatenate((np.zeros(len(words)), [-5.0, -3.0]))  # weights, bias, logit of the share of unexplained labels
    first, second = np.zeros_like(at), np.zeros_like(at)
    for k in range(1, rounds + 1):
        x = at[-2] + np.bincount(sentence_of, at[ids], minlength=len(lengths))
        mass = np.bincount(doc_of, np.logaddexp(0, x), minlength=n)
        noise = 1 / (1 + np.exp(-at[-1]))
        clean = np.exp(-mass)  # probability of no offending sentence
        p = np.clip(1 - (1 - noise) * clean, 1e-9, 1 - 1e-9)
        by_p = (1 - y) / (1 - p) - y / p
        by_x = (by_p * (1 - noise) * clean)[doc_of] / (1 + np.exp(-x))
        slope = np.concatenate((np.bincount(ids, by_x[sentence_of], minlength=len(words)), [by_x.sum(), (by_p * clean).sum() * noise * (1 - noise)])) / n
        slope[:-2] += decay * at[:-2]
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        at = at - 0.15 * (first / (1 - 0.9**k)) / (np.sqrt(second / (1 - 0.99**k)) + 1e-8)
    return ToxicityModel(float(at[-2]), {w: float(v) for w, v in zip(words, at) if abs(v) > 0.05})


def fit(labelled: DataFrame, text: str = "text", label: str = "toxic", key: str = "doc_id", rows: int = 4000, most_features: int = 4000) -> ToxicityModel:
    """Fit on at most about ``rows`` labelled rows, chosen by the hash of ``key``.

    The features are those most strongly tied to the label: a likelihood-ratio test of their
    presence in the chosen rows, ``most_features`` at most and each in five rows at least.
    The driver gets feature numbers, not texts."""
    labelled = labelled.where(F.col(label).isin(0, 1) & F.col(key).isNotNull())
    kinds = {r[0]: r[1] for r in labelled.groupBy(label).count().collect()}
    total = sum(kinds.values())
    if not total:
        return ToxicityModel(0.0, {}, 0.0)
    place = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(1 << 30))
    chosen = labelled.where(place < int(min(1.0, rows / total) * (1 << 30)))

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: tuple[Counter, Counter] = (Counter(), Counter())
            for t, y in zip(batch["t"], batch["y"], strict=True):
                seen[y].update({f for w in set(WORD.findall((t or "").lower())) if len(w) <= LONGEST_WORD for f in parts(w)})
            names = list(seen[0].keys() | seen[1].keys())
            yield pd.DataFrame({"f": names, "n0": [seen[0][f] for f in names], "n1": [seen[1][f] for f in names]})

    sizes = chosen.groupBy(label).count().collect()
    size = {0: 0, 1: 0} | {r[0]: r[1] for r in sizes}
    tally = chosen.select(F.col(text).alias("t"), F.col(label).alias("y")).mapInPandas(counted, "f string, n0 long, n1 long")
    n, share = F.col("n0") + F.col("n1"), max(size[1], 1e-9) / max(size[0] + size[1], 1)
    # twice the log-likelihood gained by giving the rows with the feature a share of their own
    own = F.col("n1") / n
    gain = F.when(own > 0, F.col("n1") * F.log(own / share)).otherwise(0.0) + F.when(own < 1, F.col("n0") * F.log((1 - own) / (1 - share))).otherwise(0.0)
    strong = tally.groupBy("f").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).where(n >= 5)
    words = sorted(r["f"] for r in strong.orderBy(F.desc(F.round(gain, 6)), "f").limit(most_features).collect()) if 0 < share < 1 else []
    known = {w: k for k, w in enumerate(words)}

    @F.pandas_udf("binary")
    def numbered(texts: pd.Series) -> pd.Series:
        made = []
        for t in texts:
            sets = bag(t, known)
            made.append(np.array([len(sets), *map(len, sets), *(w for s in sets for w in s)], dtype=np.int32).tobytes())
        return pd.Series(made)

    got = chosen.select(place.alias("p"), F.col(label).alias("y"), numbered(text).alias("b")).limit(2 * rows)
    read = sorted((r["p"], r["y"], bytes(r["b"])) for r in got.collect())
    bags = []
    for _, _, packed in read:
        flat = np.frombuffer(packed, dtype=np.int32)
        ends = np.cumsum(flat[1 : 1 + flat[0]])
        bags.append([x.tolist() for x in np.split(flat[1 + flat[0] :], ends[:-1])])
    return learn(bags, np.array([r[1] for r in read]), words)


def scored(model: ToxicityModel, text: Column | str) -> Column:
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cache: dict[str, float] = {}
        for texts in batches:
            yield pd.Series([model.score(t, cache) for t in texts], dtype="float64")

    return score(text)


def offending(model: ToxicityModel, text: Column | str, threshold: float = 0.5) -> Column:
    """Array of (start, end, probability), code points, of the offending sentences."""

    @F.pandas_udf("array<struct<start: long, end: long, probability: double>>")
    def located(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"start": a, "end": b, "probability": p} for a, b, p in model.locate(t, threshold)] for t in texts])

    return located(text)


def judged(model: ToxicityModel, text: Column | str, threshold: float, at_least: float = 0.5) -> Column:
    """A struct (score, offending): ``offending`` says start:end, code points, of the sentences
    at or over ``at_least``, or of the worst where none is, comma-joined, in texts that score
    ``threshold`` or more; it is empty in others."""

    @F.pandas_udf("score double, offending string")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        cache: dict[str, float] = {}
        for texts in batches:
            scores = [model.score(t, cache) for t in texts]
            spans = ["" if s < threshold else ",".join(f"{a}:{b}" for a, b, _ in model.blamed(t, at_least)) for s, t in zip(scores, texts, strict=True)]
            yield pd.DataFrame({"score": np.array(scores, dtype=np.float64), "offending": spans})

    return judge(text)


def learned_part(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Texts and labels of the documents that a model may learn from."""
    docs = docs.where(fold("doc_id", 3) != 1).select("doc_id", "text")
    return docs.join(labels.select("doc_id", "toxic"), "doc_id")


def op5_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    model = fit(learned_part(docs, labels))
    made = docs.select("doc_id", F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"), judged(model, "text", threshold).alias("j"))
    return made.select("doc_id", "held_out", "j.score", (F.col("j.score") >= threshold).cast("int").alias("predicted"), "j.offending")


def drop_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = 0.7) -> DataFrame:
    """The documents that score under ``threshold``, with their columns."""
    name = fresh(docs, "toxicity")
    return docs.withColumn(name, scored(model, "text")).where(F.col(name) < threshold).drop(name)
