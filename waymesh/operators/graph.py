"""Operators on a network: edges (id, source, target, length_km, ...), nodes (id, ...)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymesh.operators import walks
from waymesh.operators.components import connected_components
from waymesh.plans.durable import checkpointed, written

#: Edges of a task that solves whole components; nodes from which on a component is left to joins.
OF_A_TASK, LARGE = 10_000, 20_000


def incident(edges: DataFrame) -> DataFrame:
    """(node, id): each edge at each of its ends, a loop once. Two equi-joins can follow
    where a disjunction of ends would be a nested loop."""
    return edges.select(F.explode(F.array_distinct(F.array("source", "target"))).alias("node"), "id")


def degrees(edges: DataFrame) -> DataFrame:
    """(node, degree): number of distinct edges at a node."""
    return incident(edges).groupBy("node").agg(F.count_distinct("id").alias("degree"))


def endpoint_usage(edges: DataFrame) -> DataFrame:
    """(node, uses): ends at a node, a loop counting twice."""
    return edges.select(F.explode(F.array("source", "target")).alias("node")).groupBy("node").agg(F.count("*").alias("uses"))


def node_type(degree: Column) -> Column:
    return F.when(degree >= 3, "intersection").when(degree == 2, "connector").when(degree == 1, "endpoint").otherwise("unknown")


def nodes_with_degree(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    joined = nodes.join(degrees(edges).withColumnRenamed("node", "id"), "id", "left").withColumn("degree", F.coalesce("degree", F.lit(0)))
    return joined.withColumn("node_type", node_type(F.col("degree")))


def orphan_nodes(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    return nodes.join(incident(edges).select(F.col("node").alias("id")), "id", "left_anti")


def orphan_edges(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges with an end that isn't a node."""
    known = nodes.select("id")
    missing = edges.join(known.select(F.col("id").alias("source")), "source", "left_anti").select("id").unionAll(edges.join(known.select(F.col("id").alias("target")), "target", "left_anti").select("id"))
    return edges.join(missing.distinct(), "id", "left_semi")


def without_loops(edges: DataFrame) -> DataFrame:
    return edges.where("source <> target")


def dedupe_edges(edges: DataFrame, both_ways: bool = True) -> DataFrame:
    """The shortest edge between two nodes, the least id among equals."""
    ends = [F.least("source", "target"), F.greatest("source", "target")] if both_ways else [F.col("source"), F.col("target")]
    best = Window.partitionBy(*ends).orderBy("length_km", "id")
    return edges.withColumn("_k", F.row_number().over(best)).where("_k = 1").drop("_k")


def dead_ends(edges: DataFrame) -> DataFrame:
    """(node, n_in, n_out) where one of them is 0."""
    n_out = edges.groupBy(F.col("source").alias("node")).agg(F.count("*").alias("n_out"))
    n_in = edges.groupBy(F.col("target").alias("node")).agg(F.count("*").alias("n_in"))
    both = n_out.join(n_in, "node", "full").select("node", F.coalesce("n_in", F.lit(0)).alias("n_in"), F.coalesce("n_out", F.lit(0)).alias("n_out"))
    return both.where("n_in = 0 OR n_out = 0")


def symmetric(edges: DataFrame, cost: str = "length_km") -> DataFrame:
    """(src, dst, edge_id, cost) in both directions."""
    return edges.select(F.col("source").alias("src"), F.col("target").alias("dst"), F.col("id").alias("edge_id"), F.col(cost).alias("cost")).unionAll(
        edges.select(F.col("target"), F.col("source"), F.col("id"), F.col(cost))
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, component)."""
    return connected_components(edges)


def degree2_chains(edges: DataFrame) -> DataFrame:
    """(chain_id, n_edges, length_km, elevation_gain, elevation_loss, source, target): maximal
    paths whose inner vertices have degree 2, as one edge each. A closed chain without
    another vertex has its least node at both ends."""
    clean = without_loops(edges)
    inner = degrees(clean).where("degree = 2").select("node")
    at = incident(clean).join(inner, "node", "left_semi")
    linked = at.groupBy("node").agg(F.min("id").alias("source"), F.max("id").alias("target")).where("source <> target")
    chains = connected_components(linked).select(F.col("node").alias("id"), F.col("component").alias("chain"))
    labelled = clean.join(chains, "id", "left").withColumn("chain_id", F.coalesce("chain", "id")).drop("chain")
    sums = labelled.groupBy("chain_id").agg(F.count("*").alias("n_edges"), *[F.sum(c).alias(c) for c in ("length_km", "elevation_gain", "elevation_loss")])
    ends = labelled.select("chain_id", F.explode(F.array("source", "target")).alias("node")).groupBy("chain_id", "node").agg(F.count("*").alias("n"))
    outer = ends.groupBy("chain_id").agg(F.min(F.when(F.col("n") == 1, F.col("node"))).alias("s"), F.max(F.when(F.col("n") == 1, F.col("node"))).alias("t"), F.min("node").alias("least"))
    return sums.join(outer, "chain_id").select("chain_id", "n_edges", "length_km", "elevation_gain", "elevation_loss", F.coalesce("s", "least").alias("source"), F.coalesce("t", "least").alias("target"))


def merge_vertices(pairs: DataFrame, edges: DataFrame) -> DataFrame:
    """``edges`` with the ends of each group of coinciding vertices (pairs source, target) moved
    to its least id; edges that become loops go."""
    to = connected_components(pairs)
    s = to.select(F.col("node").alias("source"), F.col("component").alias("_s"))
    t = to.select(F.col("node").alias("target"), F.col("component").alias("_t"))
    moved = edges.join(s, "source", "left").join(t, "target", "left").withColumn("source", F.coalesce("_s", "source")).withColumn("target", F.coalesce("_t", "target"))
    return moved.select(*edges.columns).where("source <> target")


def in_components(edges: DataFrame, starts: DataFrame | None, cost: str, gain: str | None, solve: Callable, schema: str, by_joins: Callable[[DataFrame, DataFrame | None], DataFrame]) -> DataFrame:
    """The rows that ``solve`` makes of whole components, many to a task: nothing is written for a hop, and
    what a walk needs is never shuffled. Components of ``LARGE`` nodes or more, and ids that are no whole
    numbers, go ``by_joins``. ``starts``: ids to start from, or None for all nodes."""
    whole = ("bigint", "int", "smallint", "tinyint")
    ids = edges.select("id", "source", "target").dtypes + ([] if starts is None else starts.select("id").dtypes)
    if not all(t in whole for _, t in ids):
        return by_joins(edges, starts)
    least = edges.select(
        *[F.col(c).cast("long").alias(c) for c in ("id", "source", "target")], F.col(cost).cast("double").alias("cost"), (F.lit(0.0) if gain is None else F.col(gain).cast("double")).alias("gain")
    )
    kept = written(least.where("id IS NOT NULL AND source IS NOT NULL AND target IS NOT NULL AND cost IS NOT NULL"), "edges")
    labels = connected_components(kept)
    placed = kept.join(labels.withColumnRenamed("node", "source"), "source").select("component", "id", "source", "target", "cost", "gain")
    if starts is not None:
        # a start is a row without an edge
        asked = starts.select(F.col("id").cast("long").alias("node")).where("node IS NOT NULL").distinct().join(labels, "node", "left")
        placed = placed.unionByName(asked.select(F.coalesce("component", "node").alias("component"), F.lit(None).cast("long").alias("id"), F.col("node").alias("source"), F.col("node").alias("target"), F.lit(0.0).alias("cost"), F.lit(0.0).alias("gain")))
    large = checkpointed(labels.groupBy("component").count().where(F.col("count") >= LARGE).select("component"))
    apart = large.isEmpty()
    if not apart:
        placed = placed.join(F.broadcast(large), "component", "left_anti")
    tasks = max(edges.sparkSession.sparkContext.defaultParallelism, -(-kept.count() // OF_A_TASK))
    found = placed.repartition(tasks, "component").mapInArrow(solve, schema)
    if apart:
        return found
    of_large = labels.join(F.broadcast(large), "component", "left_semi").select(F.col("node").alias("source"))
    some = edges.join(of_large, "source", "left_semi")
    begin = None if starts is None else starts.join(of_large.withColumnRenamed("source", "id"), "id", "left_semi")
    return found.unionByName(by_joins(some, begin))


def shortest_paths(edges: DataFrame, sources: DataFrame, cutoff: float | None = None, cost: str = "length_km", max_rounds: int = 200) -> DataFrame:
    """(start, node, cost, hops): least cost from each start to every node it reaches, all
    starts at once."""
    return in_components(
        edges, sources, cost, None, walks.shortest(cutoff, max_rounds), "start long, node long, cost double, hops int",
        lambda some, begin: _shortest_by_joins(some, begin, cutoff, cost, max_rounds),
    )


def bounded_paths(edges: DataFrame, starts: DataFrame, max_km: float, max_gain: float, max_hops: int, loops: bool = True, least_hops: int = 1) -> DataFrame:
    """(start, end, path, edge_ids, total_km, total_gain, hops, closed): walks from ``starts``
    over edges in both directions that repeat no node, but may return to the start by a third
    or later edge not used before, within the bounds."""
    return in_components(
        edges, starts, "length_km", "elevation_gain", walks.bounded(max_km, max_gain, max_hops, loops, least_hops), walks.BOUNDED,
        lambda some, begin: _bounded_by_joins(some, begin, max_km, max_gain, max_hops, loops, least_hops),
    )


def cycles(edges: DataFrame, max_km: float, max_hops: int) -> DataFrame:
    """(path, edge_ids, total_km, total_gain, hops): simple cycles of three edges or more,
    once each: from their least node, towards the lesser of its two neighbours."""
    clean = without_loops(edges)
    return in_components(
        clean, None, "length_km", "elevation_gain", walks.cycles(max_km, max_hops), walks.BOUNDED,
        lambda some, _: _cycles_by_joins(some, max_km, max_hops).select(F.col("path")[0].alias("start"), F.col("path")[0].alias("end"), "path", "edge_ids", "total_km", "total_gain", "hops", F.lit(True).alias("closed")),
    ).select("path", "edge_ids", "total_km", "total_gain", "hops")


def _shortest_by_joins(edges: DataFrame, sources: DataFrame, cutoff: float | None = None, cost: str = "length_km", max_rounds: int = 200) -> DataFrame:
    """``shortest_paths`` of large components. Rounds relax only what the last round made cheaper; the table of
    best costs is partitioned by (start, node) throughout."""
    ways = checkpointed(symmetric(edges, cost).groupBy("src", "dst").agg(F.min("cost").alias("w")))
    best = checkpointed(sources.select(F.col("id").alias("start"), F.col("id").alias("node"), F.lit(0.0).alias("cost"), F.lit(0).alias("hops")))
    frontier = best
    for _ in range(max_rounds):
        found = frontier.join(ways, frontier["node"] == ways["src"]).select("start", F.col("dst").alias("node"), (F.col("cost") + F.col("w")).alias("cost"), (F.col("hops") + 1).alias("hops"))
        if cutoff is not None:
            found = found.where(F.col("cost") <= cutoff)
        found = found.groupBy("start", "node").agg(F.min(F.struct("cost", "hops")).alias("n"))
        joined = checkpointed(best.join(found, ["start", "node"], "full").select("start", "node", F.struct(best["cost"], best["hops"]).alias("o"), best["cost"].isNotNull().alias("had"), "n"))
        better = F.col("n").isNotNull() & (~F.col("had") | (F.col("n.cost") < F.col("o.cost")))
        pick = F.when(better, F.col("n")).otherwise(F.col("o"))
        frontier = joined.where(better).select("start", "node", "n.cost", "n.hops")
        best = joined.select("start", "node", pick["cost"].alias("cost"), pick["hops"].alias("hops"))
        if frontier.isEmpty():
            return best
    raise RuntimeError(f"costs didn't settle in {max_rounds} rounds")


def _bounded_by_joins(edges: DataFrame, starts: DataFrame, max_km: float, max_gain: float, max_hops: int, loops: bool = True, least_hops: int = 1) -> DataFrame:
    """``bounded_paths`` of large components. One join a hop; what is over the bounds goes before the next."""
    ways = symmetric(edges).join(edges.select(F.col("id").alias("edge_id"), F.col("elevation_gain").alias("gain")), "edge_id").where("src <> dst")
    ways = checkpointed(ways.where((F.col("cost") <= max_km) & (F.col("gain") <= max_gain)))
    at = starts.select(F.col("id").alias("start"), F.col("id").alias("end"), F.array("id").alias("path"), F.array().cast("array<bigint>").alias("edge_ids"), F.lit(0.0).alias("total_km"), F.lit(0.0).alias("total_gain"), F.lit(0).alias("hops"), F.lit(False).alias("closed"))
    levels = []
    for hop in range(1, max_hops + 1):
        on = at.where("NOT closed").join(ways, F.col("end") == F.col("src"))
        back = (F.col("dst") == F.col("start")) & F.lit(loops and hop >= 3) & ~F.array_contains("edge_ids", F.col("edge_id"))
        on = on.where(back | ~F.array_contains("path", F.col("dst"))).where((F.col("total_km") + F.col("cost") <= max_km) & (F.col("total_gain") + F.col("gain") <= max_gain))
        at = on.select(
            "start", F.col("dst").alias("end"), F.array_append("path", F.col("dst")).alias("path"), F.array_append("edge_ids", F.col("edge_id")).alias("edge_ids"),
            (F.col("total_km") + F.col("cost")).alias("total_km"), (F.col("total_gain") + F.col("gain")).alias("total_gain"), F.lit(hop).alias("hops"), (F.col("dst") == F.col("start")).alias("closed"),
        )
        at = checkpointed(at)
        if hop >= least_hops:
            levels.append(at)
    made = levels[0]
    for level in levels[1:]:
        made = made.unionAll(level)
    return made


def _cycles_by_joins(edges: DataFrame, max_km: float, max_hops: int) -> DataFrame:
    """``cycles`` of large components, by one join a hop."""
    clean = without_loops(edges)
    ends = clean.select(F.col("source").alias("id")).unionAll(clean.select("target")).distinct()
    ways = symmetric(clean).join(clean.select(F.col("id").alias("edge_id"), F.col("elevation_gain").alias("gain")), "edge_id")
    ways = checkpointed(ways)
    at = ends.select(F.col("id").alias("start"), F.col("id").alias("end"), F.array("id").alias("path"), F.array().cast("array<bigint>").alias("edge_ids"), F.lit(0.0).alias("total_km"), F.lit(0.0).alias("total_gain"))
    found = None
    for hop in range(1, max_hops + 1):
        on = at.join(ways, F.col("end") == F.col("src")).where((F.col("dst") >= F.col("start")) & (F.col("total_km") + F.col("cost") <= max_km))
        on = on.where(~F.array_contains("edge_ids", F.col("edge_id")) & ((F.col("dst") == F.col("start")) | ~F.array_contains("path", F.col("dst"))))
        on = checkpointed(on.select("start", F.col("dst").alias("end"), F.array_append("path", F.col("dst")).alias("path"), F.array_append("edge_ids", F.col("edge_id")).alias("edge_ids"), (F.col("total_km") + F.col("cost")).alias("total_km"), (F.col("total_gain") + F.col("gain")).alias("total_gain")))
        at = on.where("end <> start")
        if hop >= 3:
            closed = on.where(F.col("end") == F.col("start")).where(F.element_at("path", 2) < F.element_at("path", -2)).select("path", "edge_ids", "total_km", "total_gain", F.lit(hop).alias("hops"))
            found = closed if found is None else found.unionAll(closed)
    return found


def gaps(nodes: DataFrame, edges: DataFrame, metres: float, x: str = "lng", y: str = "lat", sheet=None) -> DataFrame:
    """(end, other, metres): a vertex of degree 1 and one of degree 2 or more within
    ``metres`` that no edge joins."""
    from waymesh.operators.spatial import within_distance

    known = nodes.join(degrees(edges).withColumnRenamed("node", "id"), "id")
    one = known.where("degree = 1").select(F.col("id").alias("end"), F.col(x).alias("x"), F.col(y).alias("y"))
    many = known.where("degree >= 2").select(F.col("id").alias("other"), F.col(x).alias("x2"), F.col(y).alias("y2"))
    joined = symmetric(edges).select(F.col("src").alias("end"), F.col("dst").alias("other"))
    return within_distance(one, many, metres, sheets=sheet and (sheet(F.col("end")), sheet(F.col("other")))).select("end", "other", "metres").join(joined, ["end", "other"], "left_anti")
