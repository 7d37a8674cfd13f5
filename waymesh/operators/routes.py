"""Routes over a network: path search, recommendations, loops, k shortest paths."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymesh.functions import scoring
from waymesh.operators import graph, walks
from waymesh.plans.durable import checkpointed, written


def search(edges: DataFrame, starts: DataFrame, target_km: float, target_gain: float, tolerance: float, max_hops: int = 8) -> DataFrame:
    """Walks within the tolerance (per cent) of both targets, with shape and similarity."""
    paths = graph.bounded_paths(edges, starts, target_km * (1 + tolerance / 100), target_gain * (1 + tolerance / 100), max_hops)
    near = paths.where(scoring.in_band(F.col("total_km"), target_km, tolerance) & scoring.in_band(F.col("total_gain"), target_gain, tolerance))
    return near.withColumn("shape", scoring.shape_of(F.col("path"), F.col("edge_ids"))).withColumn("similarity", scoring.similarity_deviation(F.col("total_km"), target_km, F.col("total_gain"), target_gain))


def two_edge_paths(edges: DataFrame, closed: bool) -> DataFrame:
    """(id1, id2, start, mid, end, km, gain): edge pairs a to b to c; with ``closed`` back to a."""
    a = edges.select(F.col("id").alias("id1"), F.col("source").alias("start"), F.col("target").alias("mid"), F.col("length_km").alias("k1"), F.col("elevation_gain").alias("g1"))
    b = edges.select(F.col("id").alias("id2"), F.col("source").alias("mid"), F.col("target").alias("end"), F.col("length_km").alias("k2"), F.col("elevation_gain").alias("g2"))
    joined = a.join(b, "mid").where("id1 <> id2 AND start <> mid AND mid <> end").where("start = end" if closed else "start <> end")
    return joined.select("id1", "id2", "start", "mid", "end", (F.col("k1") + F.col("k2")).alias("km"), (F.col("g1") + F.col("g2")).alias("gain"))


def adaptive_level(found: DataFrame, patterns: DataFrame, quota: int, first: int = 20, step: int = 10, rounds: int = 5, most: int = 50) -> DataFrame:
    """(pattern, tolerance, n): the least tolerance whose band holds ``quota`` routes, or the
    widest. ``found``: routes (pattern, total_km, total_gain) of the widest band."""
    levels = [t for t in range(first, first + step * rounds, step) if t <= most]
    joined = found.join(F.broadcast(patterns), "pattern")
    miss = F.greatest(F.abs(F.col("total_km") - F.col("target_km")) / F.col("target_km"), F.abs(F.col("total_gain") - F.col("target_gain")) / F.col("target_gain")) * 100
    counts = joined.withColumn("miss", miss).groupBy("pattern").agg(*[F.count_if(F.col("miss") <= t).alias(f"n{t}") for t in levels])
    rows = counts.select("pattern", F.explode(F.array(*[F.struct(F.lit(t).alias("tolerance"), F.col(f"n{t}").alias("n")) for t in levels])).alias("r")).select("pattern", "r.*")
    enough = F.when((F.col("n") >= quota) | (F.col("tolerance") == levels[-1]), F.struct("tolerance", "n"))
    return rows.groupBy("pattern").agg(F.min(enough).alias("r")).select("pattern", "r.tolerance", "r.n")


def boundary_ends(nodes: DataFrame, edges: DataFrame, n: int | None) -> DataFrame:
    """(id, margin): the ``n`` vertices of degree 1 nearest to the edge of the network's box, or all."""
    box = nodes.agg(F.min("lng").alias("x0"), F.max("lng").alias("x1"), F.min("lat").alias("y0"), F.max("lat").alias("y1"))
    one = nodes.join(graph.degrees(edges).where("degree = 1").select(F.col("node").alias("id")), "id").crossJoin(F.broadcast(box))
    margin = F.least(F.col("lng") - F.col("x0"), F.col("x1") - F.col("lng"), F.col("lat") - F.col("y0"), F.col("y1") - F.col("lat"))
    placed = one.select("id", F.round(margin, 6).alias("margin"))
    return placed if n is None else placed.orderBy("margin", "id").limit(n)


def similar_sets(members: DataFrame, key: str, member: str, least: float) -> DataFrame:
    """(id1, id2, jaccard) of all pairs of sets over ``least``, by counting shared members:
    sets without one in common never meet."""
    m = members.select(F.col(key).alias("k"), F.col(member).alias("m")).distinct()
    sizes = m.groupBy("k").agg(F.count("*").alias("n"))
    shared = m.withColumnRenamed("k", "id1").join(m.withColumnRenamed("k", "id2"), "m").where("id1 < id2").groupBy("id1", "id2").agg(F.count("*").alias("both"))
    sized = shared.join(sizes.withColumnsRenamed({"k": "id1", "n": "n1"}), "id1").join(sizes.withColumnsRenamed({"k": "id2", "n": "n2"}), "id2")
    return sized.withColumn("jaccard", F.col("both") / (F.col("n1") + F.col("n2") - F.col("both"))).where(F.col("jaccard") > least).select("id1", "id2", "jaccard")


def without_similar(routes: DataFrame, key: str, edge_ids: str, score: str, least_percent: float) -> DataFrame:
    """Drop a route if a better one shares ``least_percent`` or more of the longer one's edges.

    Two such routes share so many edges that, with all edges in one order, rare ones first,
    they meet under one of the first few of each; only these are joined, and a route is
    looked at no further once a better one is found."""
    sets = routes.select(F.col(key).alias("k"), F.col(score).alias("s"), F.array_distinct(edge_ids).alias("ids"))
    steps = checkpointed(sets.select("k", F.explode("ids").alias("e")))
    ranked = steps.join(steps.groupBy("e").agg(F.count("*").alias("uses")), "e").groupBy("k").agg(F.sort_array(F.collect_list(F.struct("uses", "e"))).alias("o"))
    n = F.size("o")
    few = F.transform(F.slice("o", F.lit(1), n - F.ceil(n * least_percent / 100 - 1e-9).cast("int") + 1), lambda x: x["e"])
    listed = checkpointed(ranked.select("k", few.alias("few")).join(sets, "k").select("k", "s", "ids", F.explode("few").alias("e")))
    one, two = (listed.select(*[F.col(c).alias(f"{c}{i}") for c in ("k", "s", "ids", "e")]) for i in (1, 2))
    better = (F.col("s2") > F.col("s1")) | ((F.col("s2") == F.col("s1")) & (F.col("k2") < F.col("k1")))
    shared = F.size(F.array_intersect("ids1", "ids2")) * 100 >= F.greatest(F.size("ids1"), F.size("ids2")) * least_percent
    worse = one.join(two, (F.col("e1") == F.col("e2")) & better & shared, "left_semi")
    return routes.join(worse.select(F.col("k1").alias(key)).distinct(), key, "left_anti")


def search_without_similar(edges: DataFrame, starts: DataFrame, target_km: float, target_gain: float, tolerance: float, max_hops: int, least_percent: float) -> DataFrame:
    """(route_id, start, edge_ids, total_km, total_gain, similarity): ``search`` and ``without_similar`` in one, by similarity
    to six digits and then by name (``route_name``). Routes are compared in the task that finds them and never written."""
    bounds = [(t * (1 - tolerance / 100), t * (1 + tolerance / 100)) for t in (float(target_km), float(target_gain))]

    def score(km: np.ndarray, gain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        taken = (km >= bounds[0][0]) & (km <= bounds[0][1]) & (gain >= bounds[1][0]) & (gain <= bounds[1][1])
        misses = [np.abs(a - t) / t if t else np.zeros(len(a)) for a, t in ((km, float(target_km)), (gain, float(target_gain)))]
        return taken, np.floor(np.maximum(0.0, 1 - (misses[0] + misses[1]) / 2) * 1e6 + 0.5) / 1e6

    def by_joins(some: DataFrame, begin: DataFrame) -> DataFrame:
        found = search(some, begin, target_km, target_gain, tolerance, max_hops).withColumn("similarity", F.floor(F.col("similarity") * 1e6 + 0.5) / 1e6)
        found = written(found.select(route_name(F.col("start"), F.col("edge_ids")).alias("route_id"), "start", "edge_ids", "total_km", "total_gain", "similarity"), "routes")
        return without_similar(found, "route_id", "edge_ids", "similarity", least_percent)

    return graph.in_components(edges, starts, "length_km", "elevation_gain", walks.dissimilar(bounds[0][1], bounds[1][1], max_hops, score, least_percent), walks.ROUTES, by_joins)


def route_name(start: Column, edge_ids: Column) -> Column:
    """The MD5 of a route's start and edges."""
    return F.md5(F.concat(start.cast("string"), F.lit(":"), F.array_join(F.transform(edge_ids, lambda x: x.cast("string")), ",")).cast("binary"))


def out_and_back(routes: DataFrame) -> DataFrame:
    """Point-to-point routes (path, edge_ids, total_km, total_gain, total_loss) walked there and back."""
    back = F.slice(F.reverse("path"), F.lit(2), F.size("path"))
    return routes.withColumns({
        "path": F.concat("path", back), "edge_ids": F.concat("edge_ids", F.reverse("edge_ids")), "total_km": F.col("total_km") * 2,
        "total_gain": F.col("total_gain") + F.col("total_loss"), "total_loss": F.col("total_gain") + F.col("total_loss"), "shape": F.lit("out-and-back"),
    })


def constituents(routes: DataFrame, edges: DataFrame, key: str = "route_id") -> DataFrame:
    """(route, trail_name, n_edges, km, gain): what each route is made of."""
    steps = routes.select(key, F.explode("edge_ids").alias("id"))
    return steps.join(edges, "id").groupBy(key, "trail_name").agg(F.count("*").alias("n_edges"), F.sum("length_km").alias("km"), F.sum("elevation_gain").alias("gain"))


# ---- searches inside one component, in Python

def _adjacency(rows: pd.DataFrame) -> dict[int, list[tuple[int, float, int]]]:
    ways: dict[int, list[tuple[int, float, int]]] = {}
    for i, s, t, km in zip(rows["id"], rows["source"], rows["target"], rows["length_km"], strict=True):
        ways.setdefault(int(s), []).append((int(t), float(km), int(i)))
        ways.setdefault(int(t), []).append((int(s), float(km), int(i)))
    return {k: sorted(v) for k, v in ways.items()}


def dijkstra(ways: dict, start: int, goal: int, banned_nodes: frozenset = frozenset(), banned_edges: frozenset = frozenset()) -> tuple[float, list[int], list[int]] | None:
    """(cost, nodes, edges) of a cheapest path; ties by node and edge ids."""
    heap, done = [(0.0, (start,), ())], set()
    while heap:
        cost, path, used = heapq.heappop(heap)
        at = path[-1]
        if at == goal:
            return cost, list(path), list(used)
        if at in done:
            continue
        done.add(at)
        for to, km, i in ways.get(at, ()):
            if to not in done and to not in banned_nodes and i not in banned_edges:
                heapq.heappush(heap, (cost + km, (*path, to), (*used, i)))
    return None


def _by_component(edges: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges with their component, of the components that a pair starts in, and the pairs."""
    labels = graph.components(edges)
    asked = checkpointed(pairs.join(labels.withColumnRenamed("node", "start"), "start").select(F.col("component").alias("part"), "start", "goal"))
    wanted = labels.join(asked.select(F.col("part").alias("component")).distinct(), "component", "left_semi")
    placed = edges.join(wanted.withColumnRenamed("node", "source"), "source").select("component", "id", "source", "target", "length_km")
    return placed, asked


def ksp(edges: DataFrame, pairs: DataFrame, k: int, labels: DataFrame | None = None) -> DataFrame:
    """(start, goal, path_id, path, edge_ids, cost) for rows (start, goal). A pair is solved
    in the task that holds its component, many components to a task. ``labels``: the components, if known."""
    kept = written(edges.select(*[F.col(c).cast("long").alias(c) for c in ("id", "source", "target")], F.col("length_km").cast("double").alias("cost")).dropna(), "edges")
    labels = graph.components(kept) if labels is None else labels
    placed = kept.join(labels.withColumnRenamed("node", "source"), "source").select("component", "id", "source", "target", "cost")
    asked = pairs.join(labels.withColumnRenamed("node", "start"), "start").where("goal IS NOT NULL")
    asked = asked.select("component", F.lit(None).cast("long").alias("id"), F.col("start").cast("long").alias("source"), F.col("goal").cast("long").alias("target"), F.lit(0.0).alias("cost"))
    tasks = max(edges.sparkSession.sparkContext.defaultParallelism, -(-kept.count() // graph.OF_A_TASK))
    return placed.unionByName(asked).repartition(tasks, "component").mapInArrow(walks.k_shortest(k), walks.PATHS)


def lollipops(edges: DataFrame, target_km: float, anchors: int = 20, k: int = 3) -> DataFrame:
    """(anchor, goal, path, edge_ids, total_km, overlap): out to a node between 0.2 and 0.8 of
    the target and back by the way that shares fewest edges; the longest per anchor and goal."""
    starts = graph.degrees(edges).orderBy(F.desc("degree"), "node").limit(anchors).select(F.col("node").alias("id"))
    reach = graph.shortest_paths(edges, starts, cutoff=0.8 * target_km).where(F.col("cost") >= 0.2 * target_km)
    ways = ksp(edges, reach.select("start", F.col("node").alias("goal")), k)
    out = ways.where("path_id = 1").select("start", "goal", F.col("path").alias("p1"), F.col("edge_ids").alias("e1"), F.col("cost").alias("c1"))
    both = out.join(ways.where("path_id > 1"), ["start", "goal"]).withColumn("overlap", F.size(F.array_intersect("e1", "edge_ids")))
    best = Window.partitionBy("start", "goal").orderBy("overlap", F.desc("cost"), "path_id")
    picked = both.withColumn("_k", F.row_number().over(best)).where("_k = 1")
    back = F.slice(F.reverse("path"), F.lit(2), F.size("path"))
    return picked.select(F.col("start").alias("anchor"), "goal", F.concat("p1", back).alias("path"), F.concat("e1", F.reverse("edge_ids")).alias("edge_ids"), (F.col("c1") + F.col("cost")).alias("total_km"), "overlap")


def greedy_cover(routes: DataFrame, n: int, key: str = "route_id") -> DataFrame:
    """(rank, route, new_edges, covered): the longest route first, then at each step the one with
    most edges not yet covered; ties by edges, km and id. ``n`` rounds, each of which keeps one
    row of the routes' counts."""
    left = written(routes.select(key, F.round("total_km", 6).alias("total_km"), F.array_distinct("edge_ids").alias("ids")), "routes")
    picked, taken = [], []
    for rank in range(1, n + 1):
        new = F.size(F.array_except("ids", F.array(*map(F.lit, taken)).cast(left.schema["ids"].dataType)))
        order = [F.desc("total_km"), F.desc("new"), key] if rank == 1 else [F.desc("new"), F.desc("total_km"), key]
        best = left.withColumn("new", new).where("new > 0").orderBy(*order).limit(1).collect()
        if not best:
            break
        taken += [i for i in best[0]["ids"] if i not in taken]
        picked.append((rank, best[0][key], best[0]["new"], len(taken)))
    return routes.sparkSession.createDataFrame(picked, f"rank int, {key} {routes.schema[key].dataType.simpleString()}, new_edges long, covered long")


def recommend(edges: DataFrame, patterns: DataFrame, tolerance: float, most_km: float, most_gain: float, max_hops: int, per_pattern: int) -> DataFrame:
    """(pattern, rank, start, end, edge_ids, total_km, total_gain, shape, similarity): the best
    ``per_pattern`` routes for each row (pattern, target_km, target_gain) of ``patterns``. All
    patterns share one search; their largest bounds are ``most_km`` and ``most_gain``."""
    starts = graph.incident(edges).select(F.col("node").alias("id")).distinct()
    paths = graph.bounded_paths(edges, starts, most_km, most_gain, max_hops)
    km, gain = F.col("total_km"), F.col("total_gain")
    met = paths.join(F.broadcast(patterns), scoring.in_band(km, F.col("target_km"), tolerance) & scoring.in_band(gain, F.col("target_gain"), tolerance))
    met = met.withColumn("similarity", F.round(scoring.similarity_deviation(km, F.col("target_km"), gain, F.col("target_gain")), 6)).withColumn("shape", scoring.shape_of(F.col("path"), F.col("edge_ids")))
    best = Window.partitionBy("pattern").orderBy(F.desc("similarity"), F.round("total_km", 6), "start", "edge_ids")
    ranked = met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= per_pattern)
    return ranked.select("pattern", "rank", "start", "end", "edge_ids", "total_km", "total_gain", "shape", "similarity")


def route_trails(routes: DataFrame, edges: DataFrame, key: list[str]) -> DataFrame:
    """(key, seq, edge_id, trail_id, trail_name, length_km): the rows that store a route's trails."""
    steps = routes.select(*key, F.posexplode("edge_ids").alias("seq", "id"))
    return steps.join(edges.select("id", "trail_id", "trail_name", "length_km"), "id").select(*key, (F.col("seq") + 1).alias("seq"), F.col("id").alias("edge_id"), "trail_id", "trail_name", "length_km")


def matched(distance: dict[tuple[int, int], float], odd: list[int], most_exact: int = 16) -> tuple[float, bool]:
    """Least sum of distances that pairs all of ``odd``, and whether it is proven to be: beyond
    ``most_exact`` nodes, pairs of nearest nodes that are then exchanged while that helps."""
    if len(odd) <= most_exact:
        best = {0: 0.0}
        for size in range(2, len(odd) + 1, 2):
            for chosen in combinations(range(len(odd)), size):
                mask, first = sum(1 << k for k in chosen), chosen[0]
                best[mask] = min(distance[odd[first], odd[k]] + best[mask ^ 1 << first ^ 1 << k] for k in chosen[1:])
        return best[(1 << len(odd)) - 1], True
    left, pairs = sorted(odd), []
    for _, u, v in sorted((distance[u, v], u, v) for u, v in combinations(left, 2)):
        if u in left and v in left:
            pairs.append((u, v))
            left = [x for x in left if x not in (u, v)]
    better = True
    while better:
        better = False
        for i, j in combinations(range(len(pairs)), 2):
            (a, b), (c, d) = pairs[i], pairs[j]
            for one, two in (((a, c), (b, d)), ((a, d), (b, c))):
                if distance[one] + distance[two] < distance[pairs[i]] + distance[pairs[j]] - 1e-12:
                    pairs[i], pairs[j], better = one, two, True
    return sum(distance[p] for p in pairs), False


def postman(edges: DataFrame) -> DataFrame:
    """(component, n_edges, once_km, again_km, exact): the length of a component's edges, and the least
    length that has to be walked again so that a round walks all of them: the pairing of nodes of odd
    degree at least cost. A component is solved in one task."""
    labels = graph.components(edges)
    placed = edges.join(labels.withColumnRenamed("node", "source"), "source").select("component", "id", "source", "target", "length_km")

    def solve(network: pd.DataFrame) -> pd.DataFrame:
        ways = _adjacency(network)
        odd = sorted(n for n, w in ways.items() if len(w) % 2)
        distance = {}
        for u in odd:
            costs = _costs(ways, u)
            distance |= {(u, v): costs[v] for v in odd}
        again, exact = matched(distance, odd)
        return pd.DataFrame([(network["component"].iloc[0], len(network), float(network["length_km"].sum()), again, exact)], columns=["component", "n_edges", "once_km", "again_km", "exact"])

    return placed.groupBy("component").applyInPandas(solve, "component long, n_edges long, once_km double, again_km double, exact boolean")


def _costs(ways: dict, start: int) -> dict[int, float]:
    """Least cost from a node to all that it reaches."""
    heap, done = [(0.0, start)], {}
    while heap:
        cost, at = heapq.heappop(heap)
        if at not in done:
            done[at] = cost
            for to, km, _ in ways.get(at, ()):
                if to not in done:
                    heapq.heappush(heap, (cost + km, to))
    return done


def loops_by_return(edges: DataFrame, pairs: DataFrame) -> DataFrame:
    """(start, goal, path, edge_ids, total_km): out to the goal by a cheapest path and back by a
    cheapest one that uses none of its edges; pairs without such a way back have no row. A
    pair is solved in the task that holds its component."""
    placed, asked = _by_component(edges, pairs)

    def solve(network: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        ways, out = _adjacency(network), []
        for s, g in sorted(set(zip(wanted["start"], wanted["goal"], strict=True))):
            there = dijkstra(ways, int(s), int(g))
            back = there and dijkstra(ways, int(g), int(s), banned_edges=frozenset(there[2]))
            if back:
                out.append((int(s), int(g), there[1] + back[1][1:], there[2] + back[2], there[0] + back[0]))
        return pd.DataFrame(out, columns=["start", "goal", "path", "edge_ids", "total_km"])

    return placed.groupBy("component").cogroup(asked.groupBy("part")).applyInPandas(solve, "start long, goal long, path array<long>, edge_ids array<long>, total_km double")


def anchor_loops(edges: DataFrame, anchors: int, target_km: float, least_km: float, most_km: float, least_trails: int) -> DataFrame:
    """``loops_by_return`` from the ``anchors`` vertices of largest degree to all that lie between 0.2
    and 0.5 of the target away; of the lengths asked for, and over enough trails."""
    clean = graph.without_loops(edges)
    starts = graph.degrees(clean).orderBy(F.desc("degree"), "node").limit(anchors).select(F.col("node").alias("id"))
    reach = graph.shortest_paths(clean, starts, cutoff=0.5 * target_km).where(F.col("cost") >= 0.2 * target_km)
    found = loops_by_return(clean, reach.select("start", F.col("node").alias("goal"))).where(F.col("total_km").between(least_km, most_km))
    trails = found.select("start", "goal", F.explode("edge_ids").alias("id")).join(clean.select("id", "trail_id"), "id").groupBy("start", "goal").agg(F.count_distinct("trail_id").alias("n_trails"))
    return found.join(trails.where(F.col("n_trails") >= least_trails), ["start", "goal"])


def bridges(edges: DataFrame) -> DataFrame:
    """(kind, id): 'bridge' edges and 'articulation' nodes, found per component."""
    labels = graph.components(edges)
    placed = edges.join(labels.withColumnRenamed("node", "source"), "source").select("component", "id", "source", "target")

    def find(network: pd.DataFrame) -> pd.DataFrame:
        ways: dict[int, list[tuple[int, int]]] = {}
        for i, s, t in zip(network["id"], network["source"], network["target"], strict=True):
            ways.setdefault(s, []).append((t, i))
            ways.setdefault(t, []).append((s, i))
        order: dict[int, int] = {}
        low: dict[int, int] = {}
        out = set()
        for root in sorted(ways):
            if root in order:
                continue
            order[root] = low[root] = len(order)
            stack: list[tuple[int, int | None, Iterator]] = [(root, None, iter(ways[root]))]
            children = 0
            while stack:
                at, by, rest = stack[-1]
                step = next(rest, None)
                if step is None:
                    stack.pop()
                    if stack:
                        parent = stack[-1][0]
                        low[parent] = min(low[parent], low[at])
                        if low[at] > order[parent]:
                            out.add(("bridge", by))
                        if parent == root:
                            children += 1
                        elif low[at] >= order[parent]:
                            out.add(("articulation", parent))
                elif step[1] != by:
                    if step[0] in order:
                        low[at] = min(low[at], order[step[0]])
                    else:
                        order[step[0]] = low[step[0]] = len(order)
                        stack.append((step[0], step[1], iter(ways[step[0]])))
            if children > 1:
                out.add(("articulation", root))
        return pd.DataFrame(sorted(out), columns=["kind", "id"])

    return placed.groupBy("component").applyInPandas(find, "kind string, id long")
