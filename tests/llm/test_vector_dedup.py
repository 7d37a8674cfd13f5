import math

import numpy as np
import pytest

from waymesh.llm import vector_dedup


def brute(rows, cosine=0.9):
    good = [k for k, (_, v) in enumerate(rows) if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links = {k: set() for k in range(len(rows))}
    for i in good:
        for j in good:
            if i != j and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], dtype=np.float64), np.array(rows[j][1], dtype=np.float64)
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= cosine:
                    links[i].add(j)
    least = {}
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        least[i] = min(rows[j][0] for j in seen)
    return sorted((rows[k][0], len(links[k]), least[k], rows[k][0] == least[k]) for k in links)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS n_links", "'x' AS copies", "2 AS cid")


def sample(seed, alone=150, groups=25, hot=0):
    rng = np.random.default_rng(seed)
    out = [rng.standard_normal(24) for _ in range(alone)]
    for _ in range(groups):
        base = rng.standard_normal(24)
        out += [base, base, base + rng.standard_normal(24) * 0.15, base + rng.standard_normal(24) * 0.3]
    base = rng.standard_normal(24)
    out += [base + rng.standard_normal(24) * 0.2 for _ in range(hot)]
    return [(k, [float(np.float32(x)) for x in v]) for k, v in enumerate(out)]


ODD = [(9000, None), (9001, []), (9002, [0.0] * 24), (9003, [None] + [1.0] * 23), (9004, [float("nan")] + [1.0] * 23), (9005, [float("inf")] * 24), (9006, [1.0, 2.0]), (9007, [2.0, 4.0])]


def test_links_match_brute_force(spark):
    rows = sample(1) + ODD
    got = sorted(tuple(r) for r in vector_dedup.near_vectors(vectors(spark, rows), recall=0.999).collect())
    want = brute(rows)
    assert [r[0] for r in got] == [r[0] for r in want]
    assert all(g[1] <= w[1] for g, w in zip(got, want))  # nothing below the cosine
    assert sum(g[1] for g in got) >= 0.97 * sum(w[1] for w in want)
    assert {g for g in got if g[0] >= 9000} == {w for w in want if w[0] >= 9000}


def test_crowded_lists_are_exact(spark):
    rows = sample(2, alone=60, groups=5, hot=120)
    got = sorted(tuple(r) for r in vector_dedup.near_vectors(vectors(spark, rows), most_in_list=16, recall=0.999).collect())
    want = brute(rows)
    assert sum(g[1] for g in got) >= 0.99 * sum(w[1] for w in want)
    hot = [k for k, r in enumerate(rows) if k >= 80]
    assert [got[k] for k in hot] == [want[k] for k in hot]


def test_pairs_of_ends_find_as_many(spark, monkeypatch):
    plan = vector_dedup.calibrated(20_000, 0.9)
    assert plan.together == 2 and plan.recall >= 0.98
    rows = sample(3)
    monkeypatch.setattr(vector_dedup, "calibrated", lambda *a, **k: plan)
    got = sorted(tuple(r) for r in vector_dedup.near_vectors(vectors(spark, rows)).collect())
    want = brute(rows)
    assert all(g[1] <= w[1] for g, w in zip(got, want))
    assert sum(g[1] for g in got) >= 0.97 * sum(w[1] for w in want)


def test_recall_at_the_least_cosine_with_the_query_s_setting(spark):
    """Pairs planted at cosine 0.90 to 0.92, the hardest there are, in 64 dimensions."""
    rng = np.random.default_rng(8)
    base = rng.standard_normal((600, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    other = rng.standard_normal((600, 64))
    other -= (other * base).sum(1, keepdims=True) * base
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    c = rng.uniform(0.9001, 0.92, (600, 1))
    whole = np.concatenate((base, c * base + np.sqrt(1 - c * c) * other, rng.standard_normal((1500, 64)))).astype(np.float32)
    rows = [(k, [float(x) for x in v]) for k, v in enumerate(whole)]
    unit = whole.astype(np.float64) / np.linalg.norm(whole.astype(np.float64), axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.9
    np.fill_diagonal(linked, False)
    got = {r["vec_id"]: r["n_links"] for r in vector_dedup.op3_embedding_dedup(vectors(spark, rows)).collect()}
    want = linked.sum(1)
    assert all(got[k] <= want[k] for k in got)
    assert want.sum() >= 1200 and sum(got.values()) >= 0.96 * want.sum()


def test_counts_matter_at_any_size():
    for n in (100, 10_000, 1_000_000, 100_000_000):
        plan = vector_dedup.calibrated(n, 0.9)
        assert plan.least_count >= 2 and plan.recall >= 0.98


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0]), (1, [1.0, 2.0])]])
def test_small_tables(spark, rows):
    got = sorted(tuple(r) for r in vector_dedup.near_vectors(vectors(spark, rows)).collect())
    assert got == brute(rows)


def test_lists_of_one_length_are_compared_at_once(monkeypatch):
    """Lists of many lengths give the pairs that each gives by itself, however many are taken at once."""
    rng, plan = np.random.default_rng(4), vector_dedup.Plan(20, 10, 2, 2, 0.98)
    sizes = rng.integers(1, 40, 60)
    rows = np.zeros(sizes.sum(), dtype=vector_dedup.record(8, plan))
    rows["list"], rows["cid"] = np.repeat(np.arange(60) * 7, sizes), rng.permutation(len(rows))
    rows["copy"], rows["hot"] = rng.integers(-127, 128, (len(rows), 8)), rng.random(len(rows)) < 0.3
    rows["places"], rows["error"] = rng.random((len(rows), 2)) * 3, 0.05
    x, want = rows["copy"] / np.linalg.norm(rows["copy"].astype(float), axis=1, keepdims=True), []
    for i in range(len(rows)):
        for j in range(i + 1, len(rows)):
            p, q = rows[i], rows[j]
            if p["list"] == q["list"] and not (p["hot"] and q["hot"]) and (np.abs(p["places"] - q["places"]) <= vector_dedup.WINDOW).all() and x[i] @ x[j] >= 0.5 - 1e-4 - 0.1:
                want.append((min(p["cid"], q["cid"]), max(p["cid"], q["cid"])))
    for cells in (100, 20_000, 2_000_000):
        monkeypatch.setattr(vector_dedup, "CELLS", cells)
        assert sorted(zip(*map(list, vector_dedup.near_in_lists(rows, 0.5)))) == sorted(want) and want


def test_single_precision_decides_only_where_it_is_sure(monkeypatch):
    rng = np.random.default_rng(6)
    x = vector_dedup.unit(rng.standard_normal((50, 6)))
    whole = np.einsum("ik,jk->ij", x, x)
    monkeypatch.setattr(vector_dedup, "TILE", 16)
    for cosine in (0.6, float(whole[3, 17]), float(np.nextafter(whole[5, 31], 2))):
        got = {(int(a), int(b)) for i, j in vector_dedup.linked_pairs(x, x, cosine) for a, b in zip(i, j)}
        assert got == {(int(a), int(b)) for a, b in zip(*np.nonzero(whole >= cosine))}
