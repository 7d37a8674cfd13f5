"""Language identification by error-correcting output codes.

Every language has a codeword of +1/-1 bits. One binary classifier per bit reads hashed
character n-grams; a text gets the language whose codeword has the least loss-weighted
distance to the classifiers' margins. Texts whose two best codewords are close are flagged.

Defined cases: a null text, an empty text or one without a letter is ``und`` with score 0
and not ambiguous. With no labelled row at all every text is ``und``; with one language
every text with a letter has that one. Repeated rows are each predicted; extra columns of
the input are kept, and clashing names are resolved in favour of the input's columns.
Texts are read whole, in chunks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymesh.llm.common import fold, fresh

UNDETERMINED = "und"
#: Hashed n-gram features, and code points handled at once.
FEATURES, CHUNK = 4096, 1 << 20
_letters: np.ndarray | None = None


def letter_table() -> np.ndarray:
    """For every code point whether it is a letter."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    return _letters


def ngram_counts(text: str) -> np.ndarray | None:
    """Counts of the hashed 1-, 2- and 3-grams of the letters, other characters being one
    blank between words. None if there is no letter. A chunk starts with the last two
    code points of the one before, so no n-gram is lost or counted twice."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    is_letter = letter_table()[points]
    if not is_letter.any():
        return None
    points = np.where(is_letter, points, 32)
    blank = points == 32
    points = points[~(blank & np.concatenate(([False], blank[:-1])))].astype(np.uint64)
    counts = np.zeros(FEATURES, dtype=np.float64)
    for n in (1, 2, 3):
        for at in range(0, len(points) - n + 1, CHUNK):
            part = points[at : at + CHUNK + n - 1]
            size = len(part) - n + 1
            mixed = np.full(size, n * 0x9E3779B97F4A7C15 & (1 << 64) - 1, dtype=np.uint64)
            for k in range(n):
                mixed = (mixed ^ part[k : k + size]) * np.uint64(0xBF58476D1CE4E5B9)
                mixed ^= mixed >> np.uint64(29)
            counts += np.bincount((mixed & np.uint64(FEATURES - 1)).astype(np.int64), minlength=FEATURES)
    return counts


def features(text: str | None) -> np.ndarray | None:
    counts = None if text is None else ngram_counts(text)
    if counts is None:
        return None
    root = np.sqrt(counts)
    return (root / np.linalg.norm(root)).astype(np.float32)


def codewords(classes: int) -> np.ndarray:
    """A +1/-1 row per class. Up to 5 classes: every split of the classes into two parts.
    Beyond: the random code, of 64 drawn with fixed seeds, with the largest least distance."""
    if classes <= 1:
        return np.ones((classes, 1), dtype=np.float32)
    if classes <= 5:
        bits = [[1 if split >> k & 1 else -1 for k in range(classes)] for split in range(1, 1 << (classes - 1))]
        return np.array(bits, dtype=np.float32).T
    width, best, most = 15 * int(np.ceil(np.log2(classes))), None, -1
    for seed in range(64):
        code = np.random.default_rng(seed).choice(np.array([-1, 1], dtype=np.float32), size=(classes, width))
        code = code[:, np.abs(code.sum(0)) < classes]
        agree = code @ code.T - 2 * code.shape[1] * np.eye(classes)
        least = (code.shape[1] - agree.max()) / 2
        if least > most:
            best, most = code, least
    return best


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    code: np.ndarray  # classes x bits
    weights: np.ndarray  # features x bits
    bias: np.ndarray
    bit_weight: np.ndarray  # trust in each bit
    margin: float  # least lead of the best codeword that isn't ambiguous

    def decode(self, x: np.ndarray) -> tuple[str, float, bool]:
        margins = x @ self.weights + self.bias
        loss = (np.logaddexp(0.0, -self.code * margins) * self.bit_weight).sum(1)
        share = np.exp(loss.min() - loss)
        share /= share.sum()
        order = np.argsort(loss, kind="stable")
        lead = 1.0 if len(order) == 1 else float(share[order[0]] - share[order[1]])
        return self.languages[order[0]], float(share[order[0]]), lead < self.margin


def learn(rows: Iterable[tuple[str, np.ndarray]], margin: float = 0.2, rounds: int = 150) -> LanguageModel | None:
    """Fit one logistic classifier per bit by accelerated gradient descent; None without rows."""
    rows = list(rows)
    if not rows:
        return None
    languages = tuple(sorted({r[0] for r in rows}))
    code = codewords(len(languages))
    x = np.stack([r[1] for r in rows])
    which = np.array([languages.index(r[0]) for r in rows])
    y = code[which]
    share = (1.0 / np.bincount(which, minlength=len(languages)))[which]
    share = (share / share.sum()).astype(np.float32)[:, None]
    weights, bias = np.zeros((x.shape[1], code.shape[1]), dtype=np.float32), np.zeros(code.shape[1], dtype=np.float32)
    ahead, ahead_bias, step, decay = weights, bias, np.float32(16.0), np.float32(1e-4)
    for k in range(rounds):
        pull = -y * share / (1 + np.exp(np.clip(y * (x @ ahead + ahead_bias), -30, 30)))
        new, new_bias = ahead - step * (x.T @ pull + decay * ahead), ahead_bias - step / 4 * pull.sum(0)
        keep = np.float32(k / (k + 3))
        ahead, ahead_bias = new + keep * (new - weights), new_bias + keep * (new_bias - bias)
        weights, bias = new, new_bias
    right = ((x @ weights + bias) * y > 0).mean(0)
    trust = np.clip(right, 0.5, 0.9999)
    trust = np.log(trust / (1 - trust)) + 1e-3
    return LanguageModel(languages, code, weights, bias, (trust / trust.mean()).astype(np.float32), margin)


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", rows_per_language: int = 500, most_rows: int = 4096) -> LanguageModel | None:
    """Fit on at most about ``rows_per_language`` rows of each language, chosen by the hash
    of ``key``. Features are made where the rows are; the driver gets one small vector each
    and never more than ``most_rows`` rows in all."""
    labelled = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(key).isNotNull())
    counts = {r[0]: r[1] for r in labelled.groupBy(lang).count().collect()}
    if not counts:
        return None
    size = min(rows_per_language, max(1, most_rows // len(counts)))
    place = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(1 << 30))
    limits = F.create_map(*[x for k, n in sorted(counts.items()) for x in (F.lit(k), F.lit(int(min(1.0, size / n) * (1 << 30))))])

    @F.pandas_udf("binary")
    def vector(texts: pd.Series) -> pd.Series:
        made = (features(t) for t in texts)
        return pd.Series([None if v is None else v.astype(np.float16).tobytes() for v in made])

    # no filter on what the UDF returns: it would be computed twice
    chosen = labelled.where((place < limits[F.col(lang)]) & F.col(text).rlike(r"\p{L}")).select(F.col(lang).alias("l"), place.alias("p"), vector(text).alias("v")).orderBy("p", "l").limit(most_rows)
    rows = sorted((r["l"], r["p"], bytes(r["v"])) for r in chosen.collect() if r["v"] is not None)
    return learn((r[0], np.frombuffer(r[2], dtype=np.float16).astype(np.float32)) for r in rows)


def prediction(model: LanguageModel | None, text: Column | str) -> Column:
    """A struct (lang_pred, score, ambiguous) for a text column."""

    @F.pandas_udf("lang_pred string, score double, ambiguous boolean")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            made = []
            for t in texts:
                x = None if model is None else features(t)
                made.append((UNDETERMINED, 0.0, False) if x is None else model.decode(x))
            yield pd.DataFrame(made, columns=["lang_pred", "score", "ambiguous"])

    return predicted(text)


def identify(df: DataFrame, model: LanguageModel | None, text: str = "text") -> DataFrame:
    """``df`` with one more struct column ``language`` (renamed if taken): lang_pred, score, ambiguous."""
    return df.withColumn(fresh(df, "language"), prediction(model, text))


def learned_part(docs: DataFrame) -> DataFrame:
    """The rows that a language model may learn from."""
    return docs.where(fold("doc_id", 4) != 2)


def op9_language_id(docs: DataFrame) -> DataFrame:
    model = fit(learned_part(docs))
    said = docs.select("doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), prediction(model, "text").alias("p"))
    return said.select("doc_id", "held_out", "p.lang_pred", "p.score", "p.ambiguous")


def keep_identified(docs: DataFrame, model: LanguageModel | None, letters: int = 200) -> DataFrame:
    """Drop documents without a language: ``und``, or still ambiguous over at least
    ``letters`` letters. Short ambiguous texts get the benefit of the doubt."""
    name = fresh(docs, "language")
    marked = docs.withColumn(name, prediction(model, "text"))
    mixed = F.col(f"{name}.ambiguous") & (F.length(F.regexp_replace("text", r"\P{L}+", "")) >= letters)
    return marked.where((F.col(f"{name}.lang_pred") != UNDETERMINED) & ~mixed).drop(name)
