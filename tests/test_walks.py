"""Searches in whole components: the rows of the searches by joins, and no table a hop."""

import random

import pytest

from waymesh.operators import graph, routes

ROUNDS = {
    "bounded": lambda e, s: graph.bounded_paths(e, s, 6.0, 50.0, 5),
    "without_loops": lambda e, s: graph.bounded_paths(e, s, 6.0, 50.0, 4, loops=False, least_hops=2),
    "cycles": lambda e, s: graph.cycles(e, 8.0, 6),
    "shortest": lambda e, s: graph.shortest_paths(e, s, cutoff=5.0),
    "all": lambda e, s: graph.shortest_paths(e, s),
}


@pytest.fixture(scope="module")
def network(spark):
    rng, rows = random.Random(5), []
    for part in range(6):
        for _ in range(9):
            a, b = rng.randrange(6), rng.randrange(6)
            rows.append((len(rows) + 100, part * 10 + a, part * 10 + b, rng.choice([0.5, 1.0, 1.5, 2.0]), float(rng.randrange(20))))
    edges = spark.createDataFrame([*rows, (900, 1, None, 1.0, 1.0), (901, 1, 2, None, 1.0), (902, 1, 2, 1.0, None)], "id long, source long, target long, length_km double, elevation_gain double")
    starts = spark.createDataFrame([(k,) for k in [*range(0, 60, 3), 777]], "id long")
    return edges.cache(), starts.cache()


def rows_of(found):
    return sorted(tuple(str(r[c]) for c in sorted(found.columns)) for r in found.collect())


@pytest.mark.parametrize("name", ROUNDS)
def test_components_give_what_joins_give(network, monkeypatch, name):
    edges, starts = network
    if name in ("shortest", "all"):
        edges = edges.where("target IS NOT NULL AND length_km IS NOT NULL")
    whole = rows_of(ROUNDS[name](edges, starts))
    monkeypatch.setattr(graph, "LARGE", 5)  # some components go by joins, others don't
    assert rows_of(ROUNDS[name](edges, starts)) == whole
    monkeypatch.setattr(graph, "LARGE", 1)
    assert rows_of(ROUNDS[name](edges, starts)) == whole and whole


@pytest.mark.parametrize("name", ROUNDS)
def test_no_hop_is_written(network, monkeypatch, name):
    edges, starts = network
    met = []
    for what in ("checkpointed", "written"):
        real = getattr(graph, what, None)
        if real is not None:
            monkeypatch.setattr(graph, what, lambda df, *more, real=real: met.append(set(df.columns)) or real(df, *more))
    ROUNDS[name](edges, starts).count()
    assert not any(c & {"path", "edge_ids", "hops", "start"} for c in met)


def test_few_ties_need_no_rounds(spark, monkeypatch):
    from waymesh.operators import components

    monkeypatch.setattr(components, "OF_A_TASK", 100)
    monkeypatch.setattr(components, "_by_stars", lambda *_: pytest.fail("rounds of joins"))
    rows = [(k, k + 1) for k in range(0, 400) if k % 50 != 49]
    found = components.connected_components(spark.createDataFrame(rows, "source long, target long")).collect()
    assert {(r.node, r.component) for r in found} == {(k, k // 50 * 50) for k in range(400)}


def test_greedy_cover_writes_its_routes_once(spark, monkeypatch):
    met = []
    for what in ("checkpointed", "written"):
        real = getattr(routes, what, None)
        if real is not None:
            monkeypatch.setattr(routes, what, lambda df, *more, real=real: met.append(df.columns) or real(df, *more))
    rows = [("a", 9.0, [1, 2]), ("b", 5.0, [2, 3, 4]), ("c", 5.0, [3, 4, 5]), ("d", 1.0, [1, 2])]
    found = routes.greedy_cover(spark.createDataFrame(rows, "route_id string, total_km double, edge_ids array<long>"), 5).collect()
    assert [tuple(r) for r in found] == [(1, "a", 2, 2), (2, "c", 3, 5)] and len(met) == 1


def test_k_shortest_paths_solve_many_components_in_a_task(spark, network, monkeypatch):
    from pyspark.sql.pandas.group_ops import PandasCogroupedOps

    monkeypatch.setattr(PandasCogroupedOps, "applyInPandas", lambda *_: pytest.fail("a call of Python for each component"))
    edges = network[0].where("target IS NOT NULL AND length_km IS NOT NULL AND elevation_gain IS NOT NULL")
    pairs = spark.createDataFrame([(10 * p + a, 10 * p + b) for p in range(6) for a in range(3) for b in range(6)] + [(0, 11), (777, 0)], "start long, goal long")
    found = routes.ksp(edges, pairs, 4).collect()
    ways = [(r["source"], r["target"], r["length_km"], r["id"]) for r in edges.collect()]
    ways += [(t, s, km, i) for s, t, km, i in ways]

    def simple(at, goal, path, used):  # all paths, by trying every way
        if at == goal:
            yield used, path
            return
        for s, t, km, i in ways:
            if s == at and t not in path:
                yield from simple(t, goal, [*path, t], [*used, (km, i)])

    known = {w[0] for w in ways}
    want = {}
    for s, g in {(r["start"], r["goal"]) for r in pairs.collect()}:
        all_ = sorted(round(sum(km for km, _ in used), 6) for used, _ in simple(s, g, [s], [])) if s in known and g in known else []
        if all_:
            want[s, g] = all_[:4]
    got = {}
    for r in sorted(found, key=lambda r: r["path_id"]):
        got.setdefault((r["start"], r["goal"]), []).append(round(r["cost"], 6))
        assert r["path"][0] == r["start"] and r["path"][-1] == r["goal"] and len(set(r["path"])) == len(r["path"]) == len(r["edge_ids"]) + 1
    assert got == want and any(len(v) > 2 for v in got.values())
    assert len({(r["start"], r["goal"], tuple(r["edge_ids"])) for r in found}) == len(found)


def test_routes_are_compared_where_they_are_found(spark, network, monkeypatch):
    from pyspark.sql import functions as F

    from waymesh.operators import walks

    edges = network[0].where("target IS NOT NULL AND length_km IS NOT NULL AND elevation_gain IS NOT NULL")
    starts = graph.incident(edges).select(F.col("node").alias("id")).distinct()
    found = routes.search(edges, starts, 5.0, 40.0, 20.0, 6).withColumn("route_id", routes.route_name(F.col("start"), F.col("edge_ids"))).withColumn("similarity", F.round("similarity", 6))
    want = rows_of(routes.without_similar(found, "route_id", "edge_ids", "similarity", 60.0).select("route_id", "similarity"))
    assert len(want) > 5 and found.count() > 3 * len(want)
    monkeypatch.setattr(walks, "STARTS", 8)
    seen = []
    for module in (graph, routes):
        for what in ("checkpointed", "written"):
            real = getattr(module, what)
            monkeypatch.setattr(module, what, lambda df, *more, real=real: seen.append(set(df.columns)) or real(df, *more))
    made = routes.search_without_similar(edges, starts, 5.0, 40.0, 20.0, 6, 60.0).select("route_id", "similarity")
    assert rows_of(made) == want and not any(c & {"ids", "edge_ids", "few", "e", "k"} for c in seen)
    monkeypatch.setattr(graph, "LARGE", 5)  # some components go by joins
    assert rows_of(routes.search_without_similar(edges, starts, 5.0, 40.0, 20.0, 6, 60.0).select("route_id", "similarity")) == want


@pytest.mark.parametrize("many", [10**9, 2])
@pytest.mark.parametrize("percent", [34.0, 60.0, 100.0])
def test_beaten_routes(monkeypatch, many, percent):
    import numpy as np

    from waymesh.operators import walks

    monkeypatch.setattr(walks, "MANY", many)
    monkeypatch.setattr(walks, "TILE", 7)
    rng = random.Random(int(percent))
    sets = [rng.sample(range(500, 512), rng.randrange(1, 6)) for _ in range(60)]
    edges = np.array([s + [-1] * (5 - len(s)) for s in sets], dtype=np.int64)
    score, names = np.array([rng.choice([0.2, 0.5, 0.9]) for _ in sets]), np.array([f"{k * 37 % 60:02}" for k in range(60)], dtype="S2")
    found = walks.beaten(edges, np.array([len(s) for s in sets]), score, lambda k: names[k], percent)
    near = lambda a, b: len(set(sets[a]) & set(sets[b])) * 100 >= max(len(sets[a]), len(sets[b])) * percent
    want = [any(near(a, b) and (score[b] > score[a] or score[b] == score[a] and names[b] < names[a]) for b in range(60) if b != a) for a in range(60)]
    assert found.tolist() == want and 0 < sum(want) < 60
