"""Quality rules as a short-circuit cascade, DataFrame operations only.

A rule is a boolean expression that is true where a document fails. The cascade measures, on
a bounded sample, what each rule costs and which share it rejects, orders the rules by
rejection per cost (the cheap and selective first), and evaluates them in one CASE
expression that stops at the first failure. A rule is a function of counts, and a count can
be a column or an expression over the text: in ``kept_documents`` it is the latter, so the
dear counts are made only for documents that the rules before let pass. The order changes
what is computed, never the verdict: a document is kept if no rule fails.

Defined cases: a null, empty or blank text has no words, zero counts and fails the base
rule. A rule that is null doesn't fail. Repeated rows are judged alike; extra columns are
ignored. With no row to measure the rules stay in their order. Texts are read whole.

Windows of three words are compared by 64-bit hashes of the words; two different windows
of one text meet with a probability of some 1e-11 for a text of 20,000 words.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymesh.llm.common import let
from waymesh.plans.durable import checkpointed

BLANKS, SYMBOLS = " \t\n\x0b\x0c\r", "#*$%&|<>"
WORD_BREAK, A_WORD = r"[\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]"


def without(text: Column, characters: str) -> Column:
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def words(text: Column) -> Column:
    return F.filter(F.split(text, WORD_BREAK), lambda w: w != "")


def duplicate_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(A_WORD))
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def window_hashes(word_list: Column) -> Column:
    """A hash for every window of three words, in order; empty for fewer words."""
    shifted = F.arrays_zip(word_list.alias("a"), F.slice(word_list, 2, F.size(word_list)).alias("b"), F.slice(word_list, 3, F.size(word_list)).alias("c"))
    return F.when(F.size(word_list) < 3, F.array().cast("array<long>")).otherwise(F.transform(F.slice(shifted, 1, F.size(word_list) - 2), lambda x: F.xxhash64(x["a"], x["b"], x["c"])))


def repeated_words(word_list: Column) -> Column:
    """Words in windows of three that are there twice or more."""

    def covered(at: Column) -> Column:
        return F.aggregate(F.transform(at, lambda i, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - i, F.lit(3)))), F.lit(0).cast("long"), lambda a, x: a + x)

    def places(p: Column) -> Column:
        same = lambda x, at: F.coalesce(F.get(p, at)["h"] == x["h"], F.lit(False))
        return F.sort_array(F.transform(F.filter(p, lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["i"]))

    def among(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda v, i: F.struct(v.alias("h"), i.alias("i"))))
        return F.when(F.size(h) > F.size(F.array_distinct(h)), let(let(pairs, places), covered)).otherwise(F.lit(0).cast("long"))

    return let(window_hashes(word_list), among)


@dataclass(frozen=True)
class Counts:
    text: Column
    n_words: Column
    word_chars: Column
    n_symbols: Column
    n_dup_lines: Column
    n_repeat_words: Column


def counts_of(text: Column, word_list: Column | None = None) -> Counts:
    """The counts as expressions over a text (not null); each is computed where it is used."""
    w = words(text) if word_list is None else word_list
    return Counts(
        text,
        F.size(w).cast("long"),
        F.length(without(text, BLANKS)).cast("long"),
        (F.length(text) - F.length(without(text, SYMBOLS))).cast("long"),
        duplicate_lines(text),
        let(w, repeated_words) if word_list is None else repeated_words(w),
    )


def counted() -> Counts:
    """The counts as the columns of ``with_base``."""
    return Counts(*map(F.col, ("text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")))


def with_base(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, text and the base counts n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    made = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("w", words(F.col("text")))
    c = counts_of(F.col("text"), F.col("w"))
    return made.select("doc_id", "text", c.n_words.alias("n_words"), c.word_chars.alias("word_chars"), c.n_symbols.alias("n_symbols"), c.n_dup_lines.alias("n_dup_lines"), c.n_repeat_words.alias("n_repeat_words"))


@dataclass(frozen=True)
class Rule:
    name: str
    fails: Callable[[Counts], Column]


def base_failed(c: Counts) -> Column:
    return (c.n_words < 50) | (100 * c.n_repeat_words > 50 * c.n_words)


def _letters(c: Counts) -> Column:
    return F.length(F.regexp_replace(c.text, r"\P{L}+", ""))


def standard_rules() -> list[Rule]:
    """The base rule and those beyond it."""
    return [
        Rule("base", base_failed),
        Rule("word_length", lambda c: (c.word_chars < 2 * c.n_words) | (c.word_chars > 15 * c.n_words)),
        Rule("symbols", lambda c: 10 * c.n_symbols > c.n_words),
        Rule("duplicate_lines", lambda c: 100 * c.n_dup_lines > 30 * F.size(F.filter(F.split(c.text, "\n"), lambda x: x.rlike(A_WORD)))),
        Rule("letters", lambda c: 100 * _letters(c) < 60 * c.word_chars),
        Rule("capitals", lambda c: 100 * F.length(F.regexp_replace(c.text, r"\P{Lu}+", "")) > 40 * _letters(c)),
        Rule("too_long", lambda c: c.n_words > 100_000),
    ]


def sampled(docs: DataFrame, text: str = "text", key: str = "doc_id", rows: int = 400) -> DataFrame:
    """At most ``rows`` texts, chosen by the hash of their key, in one partition.

    The keys are chosen first, from their column alone; then the texts are read by a filter
    on those keys that reaches the scan, so row groups without any are passed over."""
    keyed = docs.where(F.col(key).isNotNull())
    share = min(1.0, 1.5 * rows / max(1, keyed.count()))
    place = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(1 << 30))
    keys = [r[0] for r in keyed.where(place < int(share * (1 << 30))).select(key, place.alias("p")).orderBy("p").limit(rows).collect()]
    return checkpointed(docs.where(F.col(key).isin(keys)).select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).limit(rows))


def ordered(sample: DataFrame, rules: list[Rule], counts: Counts, repeats: int = 8) -> list[Rule]:
    """Rules by rejected share per second on ``sample``.

    A rule's seconds are those of a job that computes it, and the counts it needs, for every
    row ``repeats`` times, less those of a job that computes nothing; each job runs twice
    and the faster counts, as the first one is compiled."""
    many = sample.select("*", F.explode(F.sequence(F.lit(1), F.lit(repeats))).alias("again"))

    def seconds(fails: Column) -> tuple[float, int, int]:
        took, n, failed = [], 0, 0
        for _ in range(2):
            began = time.perf_counter()
            n, failed = many.agg(F.count("*"), F.count_if(fails)).first()
            took.append(time.perf_counter() - began)
        return min(took), n, failed

    idle, n, _ = seconds(F.lit(False))
    if not n:
        return list(rules)
    ranked = []
    for k, rule in enumerate(rules):
        took, _, failed = seconds(rule.fails(counts))
        ranked.append((-(failed + 0.5) / n / max(took - idle, 1e-3), k, rule))
    return [rule for *_, rule in sorted(ranked, key=lambda x: x[:2])]


def cascade(rules: list[Rule], counts: Counts) -> Column:
    """Name of the first rule that fails, in the given order; null where none does."""
    made: Column | None = None
    for rule in rules:
        made = F.when(rule.fails(counts), F.lit(rule.name)) if made is None else made.when(rule.fails(counts), F.lit(rule.name))
    return F.lit(None).cast("string") if made is None else made


def kept_documents(docs: DataFrame, rules: list[Rule] | None = None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The documents that no rule rejects, with their columns; counts are made as far as
    the cascade needs them."""
    rules = standard_rules() if rules is None else rules
    order = ordered(sampled(docs, text, key), rules, counts_of(F.col("text")))
    return docs.where(cascade(order, counts_of(F.coalesce(F.col(text), F.lit("")))).isNull())


def op7_quality_rules(docs: DataFrame) -> DataFrame:
    """The base counts are asked for every document, so here they are columns and the cascade
    saves what the rules compute beyond them; they are columns of the sample too."""
    c, base = counted(), with_base(docs)
    rules = ordered(checkpointed(with_base(sampled(docs))), standard_rules(), c)
    return base.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", F.coalesce(base_failed(c), F.lit(False)).alias("base_failed"), cascade(rules, c).isNull().alias("kept"))
