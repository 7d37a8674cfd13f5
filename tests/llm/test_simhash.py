import re

import xxhash

from tests.llm.fixtures import ROWS, documents
from waymesh.llm import simhash


def brute_print(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words]
    parts = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] if len(words) >= 3 else ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """Least id reachable by chains of pairs within distance 2."""
    values = sorted(set(prints.values()))
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    least = {}
    for d, v in prints.items():
        least[find(v)] = min(d, least.get(find(v), d))
    return {d: least[find(v)] for d, v in prints.items()}


def signed(v):
    return v - (1 << 64) if v >> 63 else v


def test_fingerprints_and_components_match_brute_force(spark):
    docs = documents(spark, [r for r in ROWS if r[0] is not None and len(r[1] or "") < 10_000])
    got = {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.op6_simhash_dedup(docs).collect()}
    prints = {r[0]: brute_print(r[1]) for r in ROWS if r[0] is not None and len(r[1] or "") < 10_000}
    least = brute_components(prints)
    assert got == {(d, f"{v:016x}", least[d]) for d, v in prints.items()}


def test_components_with_crowded_entries(spark):
    import random

    rnd = random.Random(1)
    base = [rnd.getrandbits(64) for _ in range(20)]
    values = list(base) + [0, 1 << 63, (1 << 64) - 1]
    for _ in range(600):
        v = rnd.choice(base[:2])
        for _ in range(rnd.randint(0, 4)):
            v ^= 1 << rnd.randrange(64)
        values.append(v)
    prints = dict(enumerate(values))
    frame = spark.createDataFrame([(d, signed(v)) for d, v in prints.items()], "doc_id long, fp long")
    least = brute_components(prints)
    for most in (1, 8, 1000):  # all, some, no entries are crowded
        comp = {r["fp"]: r["component_id"] for r in simhash.components(frame, most).collect()}
        assert {d: comp[signed(v)] for d, v in prints.items()} == least


def test_stage_keeps_one_of_each_group(spark):
    docs = documents(spark)
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    ids = sorted(r["doc_id"] for r in kept.collect())
    full = {r["doc_id"]: r["component_id"] for r in simhash.op6_simhash_dedup(docs).collect()}
    assert ids == sorted({c for c in full.values() if c is not None})


def test_empty_table(spark):
    assert simhash.op6_simhash_dedup(documents(spark, [])).count() == 0
    assert simhash.keep_first(documents(spark, [])).count() == 0
