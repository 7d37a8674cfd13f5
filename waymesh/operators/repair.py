"""Repair of a network: bypasses, pairs, near vertices, missing connections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymesh.operators import graph, spatial, validation
from waymesh.plans.durable import Latest, checkpointed, remove, written


def bypass_edges(nodes: DataFrame, edges: DataFrame, metres: float, max_hops: int = 10, sheet: spatial.Sheet = None) -> DataFrame:
    """(id) of edges that pass within ``metres`` of other vertices and can be replaced: a path of at
    most ``max_hops`` other edges joins their ends by way of passed vertices only."""
    clean = graph.without_loops(edges)
    spark, candidates, fronts, reached = edges.sparkSession, Latest("passed"), Latest("front"), Latest("seen")
    passed = candidates.put(validation.bypass_candidates(nodes, edges, metres, sheet))
    asked = written(clean.join(passed.select("id").distinct(), "id", "left_semi").select("id", "source", "target"), "asked")
    allowed = written(passed.unionByName(asked.select("id", F.col("target").alias("node"))).distinct(), "allowed")
    remove(spark, candidates.path)
    ways = written(graph.symmetric(clean).select("src", "dst", "edge_id"), "ways")
    front, seen = (t.put(asked.select("id", F.col("source").alias("node"))) for t in (fronts, reached))
    for _ in range(max_hops):
        on = front.join(ways, F.col("node") == F.col("src")).where("edge_id <> id").select("id", F.col("dst").alias("node")).distinct()
        front = fronts.put(on.join(allowed, ["id", "node"], "left_semi").join(seen, ["id", "node"], "left_anti"))
        if front.isEmpty():
            break
        seen = reached.put(seen.unionByName(front))
    return asked.join(seen.withColumnRenamed("node", "target"), ["id", "target"], "left_semi").select("id")


def without_bypasses(nodes: DataFrame, edges: DataFrame, metres: float, max_hops: int = 10, sheet: spatial.Sheet = None) -> DataFrame:
    return edges.join(bypass_edges(nodes, edges, metres, max_hops, sheet), "id", "left_anti")


def compact_pairs(edges: DataFrame) -> DataFrame:
    """``edges`` after one round of merging: two edges that alone meet at a vertex become one, named
    by the lesser id, if that vertex is the least such vertex of both."""
    clean = graph.without_loops(edges)
    at = graph.incident(clean).join(graph.degrees(clean).where("degree = 2").select("node"), "node", "left_semi")
    least = at.groupBy("id").agg(F.min("node").alias("node"))
    pairs = least.groupBy("node").agg(F.count("*").alias("n"), F.min("id").alias("id1"), F.max("id").alias("id2")).where("n = 2")
    member = pairs.select("node", F.explode(F.array("id1", "id2")).alias("id"), F.col("id1").alias("into"))
    joined = clean.join(member, "id", "left")
    far = F.when(F.col("source") == F.col("node"), F.col("target")).otherwise(F.col("source"))
    merged = joined.where("node IS NOT NULL").withColumn("far", far).groupBy("into").agg(
        F.min("far").alias("source"), F.max("far").alias("target"), *[F.sum(c).alias(c) for c in ("length_km", "elevation_gain", "elevation_loss")]
    )
    kept = joined.where("node IS NULL").select("id", "source", "target", "length_km", "elevation_gain", "elevation_loss")
    return kept.unionByName(merged.withColumnRenamed("into", "id"))


def optimised(edges: DataFrame, rounds: int = 20) -> tuple[DataFrame, int]:
    """Pairs are merged, loops dropped and parallel edges reduced to the shortest, until the number
    of edges stays; the network and the number of rounds."""
    kept = Latest("network")
    now, count = kept.put(graph.dedupe_edges(graph.without_loops(edges))), -1
    for done in range(rounds):
        size = now.count()
        if size == count:
            return now, done
        now, count = kept.put(graph.dedupe_edges(graph.without_loops(compact_pairs(now)))), size
    return now, rounds


def snapped_vertices(nodes: DataFrame, edges: DataFrame, metres: float, sheet: spatial.Sheet = None) -> DataFrame:
    """(id, to): vertices of degree 1 that move to the nearest vertex of degree 2 or more within
    ``metres``, ties by id."""
    known = nodes.join(graph.degrees(edges).withColumnRenamed("node", "id"), "id")
    one = known.where("degree = 1").select("id", F.col("lng").alias("x"), F.col("lat").alias("y"))
    many = known.where("degree >= 2").select(F.col("id").alias("other"), F.col("lng").alias("x2"), F.col("lat").alias("y2"))
    best = spatial.within_distance(one, many, metres, sheets=sheet and (sheet(F.col("id")), sheet(F.col("other")))).groupBy("id").agg(F.min(F.struct("metres", "other")).alias("m"))
    return best.select("id", F.col("m.other").alias("to"))


def with_snapped_vertices(nodes: DataFrame, edges: DataFrame, metres: float, sheet: spatial.Sheet = None) -> DataFrame:
    """``edges`` with those vertices moved; what becomes a loop goes."""
    to = snapped_vertices(nodes, edges, metres, sheet)
    s, t = (to.select(F.col("id").alias(c), F.col("to").alias(f"_{c}")) for c in ("source", "target"))
    moved = edges.join(s, "source", "left").join(t, "target", "left").withColumn("source", F.coalesce("_source", "source")).withColumn("target", F.coalesce("_target", "target"))
    return moved.select(*edges.columns).where("source <> target")


def connections(nodes: DataFrame, edges: DataFrame, metres: float, sheet: spatial.Sheet = None) -> DataFrame:
    """(component, node, other, other_component, metres): for each component the shortest way to
    another one within ``metres``, ties by node ids."""
    labels = graph.components(graph.without_loops(edges))
    at = nodes.join(labels.withColumnRenamed("node", "id"), "id")
    a = at.select(F.col("id").alias("node"), "component", F.col("lng").alias("x"), F.col("lat").alias("y"))
    b = at.select(F.col("id").alias("other"), F.col("component").alias("other_component"), F.col("lng").alias("x2"), F.col("lat").alias("y2"))
    near = spatial.within_distance(a, b, metres, sheets=sheet and (sheet(F.col("node")), sheet(F.col("other")))).where("component <> other_component")
    best = near.groupBy("component").agg(F.min(F.struct("metres", "node", "other", "other_component")).alias("m"))
    return best.select("component", "m.node", "m.other", "m.other_component", "m.metres")


def with_connections(nodes: DataFrame, edges: DataFrame, metres: float, sheet: spatial.Sheet = None) -> DataFrame:
    """``edges`` (id, source, target, length_km) and a connector for each of ``connections``, with
    ids below zero; two components that are nearest to each other get one."""
    found = connections(nodes, edges, metres, sheet)
    ways = found.select(F.least("node", "other").alias("source"), F.greatest("node", "other").alias("target"), (F.col("metres") / 1000).alias("length_km")).dropDuplicates(["source", "target"])
    made = ways.withColumn("id", -F.abs(F.xxhash64("source", "target")))
    return edges.select("id", "source", "target", "length_km").unionByName(made.select("id", "source", "target", "length_km"))


def missing_connections(nodes: DataFrame, edges: DataFrame, metres: float, sheet: spatial.Sheet = None) -> DataFrame:
    """(id1, id2, metres, score): dead ends within ``metres`` that no edge joins. The score, up to
    100, is 70 for nearness and 30 for joining two components."""
    labels = graph.components(graph.without_loops(edges))
    ends = nodes.join(graph.degrees(edges).where("degree = 1").select(F.col("node").alias("id")), "id").join(labels.withColumnRenamed("node", "id"), "id", "left")
    a = ends.select(F.col("id").alias("id1"), F.col("component").alias("c1"), F.col("lng").alias("x"), F.col("lat").alias("y"))
    b = ends.select(F.col("id").alias("id2"), F.col("component").alias("c2"), F.col("lng").alias("x2"), F.col("lat").alias("y2"))
    joined = edges.select(F.least("source", "target").alias("id1"), F.greatest("source", "target").alias("id2"))
    near = spatial.within_distance(a, b, metres, sheets=sheet and (sheet(F.col("id1")), sheet(F.col("id2")))).where("id1 < id2").join(joined, ["id1", "id2"], "left_anti")
    score = 70 * (1 - F.col("metres") / metres) + F.when(F.col("c1") == F.col("c2"), 0.0).otherwise(30.0)
    return near.select("id1", "id2", "metres", score.alias("score"))


def reachability(edges: DataFrame) -> DataFrame:
    """Share of all pairs of vertices that can reach each other, in per cent."""
    sizes = graph.components(graph.without_loops(edges)).groupBy("component").agg(F.count("*").alias("n"))
    return sizes.agg(F.sum("n").alias("nodes"), (F.sum(F.col("n") * F.col("n")) * 100 / (F.sum("n") * F.sum("n"))).alias("reachable_pct"))


def coloured(nodes: DataFrame, edges: DataFrame, colours: tuple[str, ...]) -> DataFrame:
    """(id, component, colour, degree, is_endpoint) for a map of the network; a vertex without an
    edge is a component of its own."""
    labels = graph.components(graph.without_loops(edges)).withColumnRenamed("node", "id")
    at = nodes.select("id").join(labels, "id", "left").join(graph.degrees(edges).withColumnRenamed("node", "id"), "id", "left")
    at = at.withColumn("component", F.coalesce("component", "id")).withColumn("degree", F.coalesce("degree", F.lit(0)))
    colour = F.get(F.array(*map(F.lit, colours)), F.pmod("component", F.lit(len(colours))).cast("int"))
    return at.select("id", "component", colour.alias("colour"), "degree", (F.col("degree") == 1).alias("is_endpoint"))


def apart(routes: DataFrame, metres: float, key: str = "route_id", score: str = "score", sheet: spatial.Sheet = None) -> DataFrame:
    """Routes (key, score, x, y) taken best first, passing over those within ``metres`` of one
    taken before, ties by key. In rounds: a route that is better than all that are near it is
    taken, and what is near it goes; that gives what going through the list would."""
    a = routes.select(F.col(key).alias("k1"), F.col(score).alias("s1"), "x", "y")
    b = routes.select(F.col(key).alias("k2"), F.col(score).alias("s2"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    near = checkpointed(spatial.within_distance(a, b, metres, sheets=sheet and (sheet(F.col("k1")), sheet(F.col("k2")))).where("k1 <> k2").select("k1", "s1", "k2", "s2"))
    left, taken = checkpointed(routes.select(F.col(key).alias("k1"))), None
    while not left.isEmpty():
        here = near.join(left, "k1", "left_semi").join(left.withColumnRenamed("k1", "k2"), "k2", "left_semi")
        beaten = here.where((F.col("s2") > F.col("s1")) | ((F.col("s2") == F.col("s1")) & (F.col("k2") < F.col("k1")))).select("k1").distinct()
        best = checkpointed(left.join(beaten, "k1", "left_anti"))
        taken = best if taken is None else checkpointed(taken.unionByName(best))
        gone = here.join(best.withColumnRenamed("k1", "k2"), "k2", "left_semi").select("k1").unionByName(best)
        left = checkpointed(left.join(gone.distinct(), "k1", "left_anti"))
    return routes.limit(0) if taken is None else routes.join(taken.withColumnRenamed("k1", key), key, "left_semi")

