"""Connected components of an undirected graph given as an edge table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymesh.plans.durable import checkpointed, written
from waymesh.plans.hot import unique_join

#: Edges from which on the nodes with very many edges are joined by themselves; edges of a task.
MANY_EDGES, OF_A_TASK = 50_000, 250_000


def roots_of(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of edges (a, b), ascending, and the least node that each reaches."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    i, j, root = at[: len(a)], at[len(a) :], np.arange(len(nodes))
    while True:
        low, high = np.minimum(root[i], root[j]), np.maximum(root[i], root[j])
        if (low == high).all():
            return nodes, nodes[root]
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]


def _by_ranges(pairs: DataFrame, max_rounds: int) -> DataFrame:
    """(node, component) from (a, b) of whole numbers. Edges of near ids are solved in one task; only where
    a node has edges in several, their results are tied, and most graphs have few of these ties. More than a
    task takes are left to ``_by_stars``."""
    pairs = written(pairs, "edges")

    def solve(batches: Iterator[pa.RecordBatch], names: tuple[str, str] = ("node", "root")) -> Iterator[pa.RecordBatch]:
        rows = [(x.column(0).to_numpy(), x.column(1).to_numpy()) for x in batches]
        if rows:
            nodes, roots = roots_of(*(np.concatenate(c) for c in zip(*rows, strict=True)))
            for k in range(0, len(nodes), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(nodes[k : k + 50_000]), pa.array(roots[k : k + 50_000])], names=list(names))

    tasks = max(1, -(-pairs.count() // OF_A_TASK))
    solved = written(pairs.repartitionByRange(tasks, "b", "a").mapInArrow(solve, "node long, root long"), "roots")
    found = solved.groupBy("node").agg(F.min("root").alias("root"), F.max("root").alias("other"))
    split = found.where("root <> other").select("node", F.col("root").alias("m"))
    ties = written(solved.join(split, "node").where("root <> m").select(F.col("root").alias("a"), F.col("m").alias("b")).distinct(), "ties")
    n = ties.count()
    if not n:
        return found.select("node", F.col("root").alias("component"))
    # few ties need no rounds: they are solved in one task as well
    tied = ties.coalesce(1).mapInArrow(lambda rows: solve(rows, ("root", "component")), "root long, component long") if n <= OF_A_TASK else _by_stars(ties, max_rounds).withColumnRenamed("node", "root")
    return found.select("node", "root").join(tied, "root", "left").select("node", F.coalesce("component", "root").alias("component"))


def _with_least(pairs: DataFrame, key: str, other: str, many: bool, counted: Column) -> DataFrame:
    """``pairs`` where ``counted`` with ``m``, the least of ``key`` and its ``other``s."""
    least = pairs.groupBy(key).agg(F.min(other).alias("m"), F.count_if(counted).alias("uses")).where("uses > 0").select(key, F.least(key, "m").alias("m"), "uses")
    rows = pairs.where(counted)
    return unique_join(rows, checkpointed(least), key, "uses") if many else rows.join(least.drop("uses"), key)


def _mark(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    return row[0], row[1]


def connected_components(edges: DataFrame, source: str = "source", target: str = "target", max_rounds: int = 200) -> DataFrame:
    """(node, component): the least node that can be reached, for every node of an edge. Self-loops
    and nulls are ignored except that a node with only a self-loop is its own component."""
    pairs = edges.select(F.greatest(source, target).alias("a"), F.least(source, target).alias("b"), F.col(source).alias("s"), F.col(target).alias("t")).where("s is not null and t is not null").select("a", "b")
    if all(t in ("bigint", "int", "smallint", "tinyint") for _, t in pairs.dtypes):
        kind = pairs.schema["a"].dataType
        found = _by_ranges(pairs.select(F.col("a").cast("long"), F.col("b").cast("long")), max_rounds)
        return found.select(F.col("node").cast(kind), F.col("component").cast(kind))
    return _by_stars(pairs, max_rounds)


def _by_stars(pairs: DataFrame, max_rounds: int) -> DataFrame:
    """(node, component) from (a, b), a not less than b.

    Alternates two star operations: each node first ties its larger neighbours to the least
    node it sees, then its smaller ones. Every round is a few equi-joins and combinable
    minima, so a node with many edges is never gathered in one task; the number of rounds
    grows with the logarithm of the longest path."""
    lone = pairs.where("a = b").select(F.col("a").alias("node")).distinct()
    stars = checkpointed(pairs.where("a <> b").select("a", "b").distinct())
    mark = _mark(stars)
    for _ in range(max_rounds):
        if not mark[0]:
            break
        ends = stars.select(F.col("a").alias("n"), F.col("b").alias("o")).unionAll(stars.select(F.col("b").alias("n"), F.col("a").alias("o")))
        many = mark[0] > MANY_EDGES
        large = _with_least(ends, "n", "o", many, F.col("o") > F.col("n")).where("o <> m").select(F.col("o").alias("a"), F.col("m").alias("b")).distinct()
        large = checkpointed(large) if many else large
        met = _with_least(large, "a", "b", many, F.lit(True))
        small = met.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(met.select("a", F.col("m").alias("b"))).distinct()
        stars, before = checkpointed(small), mark
        mark = _mark(stars)
        if mark == before:
            break
    else:
        raise RuntimeError(f"components didn't settle in {max_rounds} rounds")
    roots = stars.select(F.col("b").alias("node")).distinct()
    found = stars.select(F.col("a").alias("node"), F.col("b").alias("component"))
    alone = roots.unionAll(lone).distinct().select("node", F.col("node").alias("component"))
    return found.unionAll(alone.join(found.select("node"), "node", "left_anti"))
