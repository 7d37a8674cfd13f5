"""Near-duplicate vectors by collision-counting projections.

Every vector is projected on many random lines. Near a line's middle any two vectors are
near each other; only far out do neighbours stand apart from the rest. So each vector is
listed at the ends where it lies farthest out (``ends_each`` of them), or, for large
tables, at every pair or triple of those, so that a list holds some dozens of vectors
whatever the size of the table. Lists are sorted by projection; a vector collides with those
within a window around its own value. Collisions are counted per pair, and pairs with enough
of them are verified by the cosine in double precision.

A projection on a Gaussian line has the standard normal distribution for any unit vector,
and that of a pair depends on its angle only. So the share of pairs at exactly the least
cosine that reach a count is found by simulation, whatever the data: ``calibrated`` takes
the largest count that keeps ``recall`` of them, and takes more ends where that count would be
under ``LEAST_COUNT``. Closer pairs do better.

Before a collision is counted, an 8-bit copy of both vectors, with a bound of its error,
rules out pairs that can't reach the cosine; without that every list would send all of its
pairs through a shuffle.

Lists of more than ``most_in_list`` vectors come from large groups of near copies. Their
vectors are compared with each other in blocks, exactly and without emitting pairs: a block
gives each vector's number of links and edges that tie its local components together. A
vector outside shares no such list with them, so its pairs are found as before.

Equal vectors are one class with a number of copies. Defined cases: vectors that are null,
empty, zero, or hold a null or non-finite component link with nothing. Vectors of different
lengths don't link. Repeated rows are copies. A null id counts as a copy and is never a
component's id. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymesh.operators.components import connected_components, roots_of
from waymesh.plans.durable import checkpointed
from waymesh.plans.hot import unique_join

#: Vectors that a list should hold; vectors of a block; vectors of it that are compared at once.
IN_LIST, BLOCK, TILE = 48, 4096, 1024
#: By how much a cosine in single precision may be off at most.
SURE = 1e-5
#: Half the width of a window, in standard deviations of a projection.
WINDOW = 1.0
#: Collisions that a pair needs at least, whatever the size of the table: one alone proves little.
LEAST_COUNT = 2
#: Rows of lists that are packed and compared together; numbers in the copies, or cosines, of lists compared at once.
OF_A_BUCKET, CELLS = 100_000, 2_000_000
LISTED = np.dtype([("list", "<i8"), ("cid", "<i8")])


@dataclass(frozen=True)
class Plan:
    lines: int  # random lines; each has two ends
    ends_each: int  # ends where a vector is listed
    together: int  # ends that make one list
    least_count: int  # collisions that a pair needs
    recall: float  # share of pairs at the least cosine that have them


def calibrated(vectors: int, cosine: float, recall: float = 0.98, seed: int = 7, trials: int = 4000) -> Plan:
    """Lines, ends and the least count for a table of ``vectors`` distinct vectors."""
    together = 1 if vectors <= 1 << 13 else 2 if vectors <= 1 << 26 else 3
    ends = {1: 14, 2: 10, 3: 9}[together]
    while True:
        # a vector is at an end with probability ends / (2 lines)
        lines = max(ends, math.ceil(ends / 2 * max(1.0, vectors / IN_LIST) ** (1 / together)))
        rng, shared = np.random.default_rng(seed), []
        for _ in range(0, trials, 250):
            x = rng.standard_normal((250, lines), dtype=np.float32)
            y = cosine * x + math.sqrt(1 - cosine * cosine) * rng.standard_normal((250, lines), dtype=np.float32)
            a, b = farthest(x, ends), farthest(y, ends)
            near = np.abs(np.take_along_axis(x, a % lines, 1) - np.take_along_axis(y, a % lines, 1)) <= WINDOW
            shared.append(((a[:, :, None] == b[:, None, :]).any(2) & near).sum(1))
        counts = np.array([math.comb(int(s), together) for s in np.concatenate(shared)])
        good = [c for c in range(LEAST_COUNT, 7) if (counts >= c).mean() >= recall]
        if good:
            return Plan(lines, ends, together, good[-1], float((counts >= good[-1]).mean()))
        ends += 2


def farthest(projected: np.ndarray, ends: int) -> np.ndarray:
    """Per row the ``ends`` ends where it lies farthest out, ascending: line, or line + number
    of lines for the negative end."""
    lines = projected.shape[1]
    line = np.argpartition(-np.abs(projected), min(ends, lines) - 1, axis=1)[:, :ends]
    return np.sort(line + lines * (np.take_along_axis(projected, line, 1) < 0), axis=1)


def directions(size: int, lines: int, seed: int = 11) -> np.ndarray:
    return np.random.default_rng([seed, size]).standard_normal((size, lines)).astype(np.float32)


def unit(values: np.ndarray) -> np.ndarray:
    values = values.astype(np.float64)
    values /= np.abs(values).max(1, keepdims=True)  # so that squares neither overflow nor vanish
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def matrix(column: pa.Array) -> np.ndarray:
    """The vectors of a list column of equal lengths."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def record(size: int, plan: Plan) -> np.dtype:
    """A vector in one of its lists: its projections there, its 8-bit copy and the bound of that copy's error."""
    return np.dtype([("list", "<i8"), ("cid", "<i8"), ("hot", "?"), ("places", "<f4", (plan.together,)), ("error", "<f4"), ("copy", "i1", (size,))])


def in_buckets(classes: DataFrame, size: int, plan: Plan, number: int, copies: bool) -> DataFrame:
    """Rows (bucket, rows): the records of ``number`` vectors in each of their lists but those in their ``left_out``,
    or with ``copies`` false list and cid only, packed by buckets of lists, sorted and in one task a bucket.
    A list is whole in one bucket."""
    buckets = max(1, number * math.comb(plan.ends_each, plan.together) // OF_A_BUCKET)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines, kind = directions(size, plan.lines), record(size, plan)
        picks = np.array(list(combinations(range(plan.ends_each), plan.together)))
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                batch = whole.slice(at, 2000)
                x = unit(matrix(batch.column(1)))
                y = x.astype(np.float32) @ lines
                ends = farthest(y, plan.ends_each)
                key = np.zeros((len(x), len(picks)), dtype=np.int64)
                for k in range(plan.together):
                    key = key * (2 * plan.lines) + ends[:, picks[:, k]]
                each = np.repeat(np.arange(len(x)), len(picks))
                made = np.zeros(len(each), dtype=kind if copies else LISTED)
                made["list"], made["cid"] = key.ravel(), batch.column(0).to_numpy()[each]
                if copies:
                    most = np.abs(x).max(1)
                    out = np.take_along_axis(np.abs(y), ends % plan.lines, 1)
                    made["places"] = out[:, picks].reshape(len(each), -1)
                    # a component is off by half a step at most, and each vector's norm by as much again
                    made["error"] = (math.sqrt(size) * most / 127)[each]
                    made["copy"] = np.rint(x / most[:, None] * 127).astype(np.int8)[each]
                    left = batch.column(2)
                    hot = left.is_valid().to_numpy(zero_copy_only=False)
                    made["hot"] = hot[each]
                    keep = np.ones(key.shape, dtype=bool)
                    for k in np.flatnonzero(hot):
                        keep[k] = ~np.isin(key[k], left[int(k)].values.to_numpy())
                    made = made[keep.ravel()]
                bucket = (made["list"].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)) % np.uint64(buckets)
                order = np.argsort(bucket, kind="stable")
                made, bucket = made[order], bucket[order].astype(np.int64)
                starts = np.flatnonzero(np.diff(bucket, prepend=-1))
                blobs = [made[i:j].tobytes() for i, j in zip(starts, [*starts[1:], len(made)], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(bucket[starts]), pa.array(blobs, pa.binary())], names=["bucket", "rows"])

    tasks = max(classes.sparkSession.sparkContext.defaultParallelism, buckets // 4)
    return classes.select("cid", "embedding", "left_out").mapInArrow(rows, "bucket long, rows binary").repartition(tasks, "bucket").sortWithinPartitions("bucket")


def whole_buckets(batches: Iterator[pa.RecordBatch], kind: np.dtype) -> Iterator[np.ndarray]:
    """The records of each bucket, by list."""
    now, blobs = None, []
    for batch in batches:
        for bucket, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if bucket != now and blobs:
                yield by_list(blobs, kind)
                blobs = []
            now = bucket
            blobs.append(blob.as_buffer())
    if blobs:
        yield by_list(blobs, kind)


def by_list(blobs: list, kind: np.dtype) -> np.ndarray:
    rows = np.frombuffer(b"".join(blobs), dtype=kind)
    return rows[np.argsort(rows["list"], kind="stable")]


def spans(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each list begins, and how many rows it has."""
    begins = np.flatnonzero(np.concatenate(([True], rows["list"][1:] != rows["list"][:-1])))
    return begins, np.diff(np.append(begins, len(rows)))


def crowded_lists(classes: DataFrame, size: int, plan: Plan, number: int, most_in_list: int) -> DataFrame:
    """(cid, left_out): the lists of over ``most_in_list`` vectors that a vector is in."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_buckets(batches, LISTED):
            _, counts = spans(rows)
            rows = rows[np.repeat(counts > most_in_list, counts)]
            if len(rows):
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(rows[c])) for c in ("cid", "list")], names=["cid", "list"])

    return in_buckets(classes, size, plan, number, False).mapInArrow(found, "cid long, list long").groupBy("cid").agg(F.collect_list("list").alias("left_out"))


def near_in_lists(rows: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """(a, b) for every list in which two vectors collide and may reach the cosine. Lists of about one
    length are compared at once."""
    begins, counts = spans(rows)
    order = np.argsort(counts, kind="stable")
    order = order[np.searchsorted(counts[order], 2) :]
    at, found = 0, []
    while at < len(order):
        # as many lists as fit, none much shorter than the last
        least = int(counts[order[at]])
        upto = int(np.searchsorted(counts[order], least + least // 4, side="right"))
        width = int(counts[order[upto - 1]])
        some = order[at : min(upto, at + max(1, CELLS // (width * max(width, rows["copy"].shape[1]))))]
        width = int(counts[some[-1]])
        place = begins[some][:, None] + np.minimum(np.arange(width), counts[some][:, None] - 1)
        small = rows["copy"][place].astype(np.float32)
        small /= np.linalg.norm(small, axis=2, keepdims=True)
        error = rows["error"][place]
        near = small @ small.transpose(0, 2, 1) >= (cosine - 1e-4) - error[:, :, None] - error[:, None, :]
        k, i, j = np.nonzero(near)
        keep = (i < j) & (j < counts[some][k])
        one, two = rows[place[k[keep], i[keep]]], rows[place[k[keep], j[keep]]]
        keep = (np.abs(one["places"] - two["places"]) <= WINDOW).all(1) & ~(one["hot"] & two["hot"])
        found.append((one["cid"][keep], two["cid"][keep]))
        at += len(some)
    a, b = (np.concatenate([f[c] for f in found]) if found else np.zeros(0, dtype=np.int64) for c in (0, 1))
    return np.minimum(a, b), np.maximum(a, b)


def collisions(classes: DataFrame, size: int, plan: Plan, number: int, cosine: float) -> DataFrame:
    """(a, b) for every list in which two vectors collide and may reach the cosine."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_buckets(batches, record(size, plan)):
            a, b = near_in_lists(rows, cosine)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return in_buckets(classes, size, plan, number, True).mapInArrow(found, "a long, b long")


def cosine_of(x: Column | str, y: Column | str) -> Column:
    @F.pandas_udf("double")
    def made(xs: pd.Series, ys: pd.Series) -> pd.Series:
        a, b = (np.stack(s.to_list()).astype(np.float64) if len(s) else np.zeros((0, 1)) for s in (xs, ys))
        return pd.Series((unit(a) * unit(b)).sum(1))

    return made(x, y)


def linked_pairs(x: np.ndarray, y: np.ndarray, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j) of unit vectors of ``x`` and ``y`` whose cosine reaches the least one. Single precision decides where
    it is sure, double precision the rest."""
    small, other = x.astype(np.float32), y.astype(np.float32)
    for at in range(0, len(x), TILE):
        for to in range(0, len(y), TILE):
            near = small[at : at + TILE] @ other[to : to + TILE].T
            i, j = np.nonzero(near >= cosine - SURE)
            i, j, near = i + at, j + to, near[i, j]
            doubt = np.flatnonzero(near <= cosine + SURE)
            keep = np.ones(len(i), dtype=bool)
            keep[doubt] = np.einsum("ij,ij->i", x[i[doubt]], y[j[doubt]]) >= cosine
            yield i[keep], j[keep]


def in_blocks(hot: DataFrame, number: int, cosine: float) -> tuple[DataFrame, DataFrame]:
    """Links per vector (cid, links) and edges (a, b) among the vectors of ``hot``."""
    blocks = max(1, math.ceil(number / BLOCK))
    own = F.pmod(F.xxhash64("cid"), F.lit(blocks)).cast("int")
    rows = hot.select("cid", "embedding", "copies", own.alias("own"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("other"))
    rows = rows.select("cid", "embedding", "copies", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        cid, copies, own = (table.column(c).to_numpy() for c in ("cid", "copies", "own"))
        x = unit(matrix(table.column("embedding").combine_chunks()))
        one, two = np.flatnonzero(own == own.min()), np.flatnonzero(own == own.max())
        same, links, ties = table.column("i")[0] == table.column("j")[0], np.zeros(len(cid), dtype=np.int64), []
        if not same and own.min() == own.max():
            one = one[:0]  # nothing on the other side
        for i, j in linked_pairs(x[one], x[two], cosine):
            i, j = one[i], two[j]
            i, j = (i[i != j], j[i != j]) if same else (i, j)
            np.add.at(links, i, copies[j])
            if not same:
                np.add.at(links, j, copies[i])
            if len(i):
                # of many links only what ties their vectors together is kept
                nodes, roots = roots_of(i, j)
                ties.append((nodes[nodes != roots], roots[nodes != roots]))
        nodes, roots = roots_of(*(np.concatenate(c) for c in zip(*ties, strict=True))) if ties else (np.zeros(0, dtype=np.int64),) * 2
        tied = nodes != roots
        a, b = np.concatenate((cid, cid[nodes[tied]])), np.concatenate((np.full(len(cid), -1), cid[roots[tied]]))
        return pa.table({"a": a, "b": b, "links": np.concatenate((links, np.full(int(tied.sum()), -1)))})

    made = checkpointed(rows.groupBy("i", "j").applyInArrow(compare, "a long, b long, links long").where("links <> 0"))
    return made.where("links > 0").groupBy(F.col("a").alias("cid")).agg(F.sum("links").alias("links")), made.where("links < 0").select("a", "b")


def linked_classes(classes: DataFrame, size: int, cosine: float, most_in_list: int, recall: float) -> tuple[DataFrame, DataFrame]:
    """Links per class (cid, links) to other classes' vectors, and edges (a, b)."""
    number = classes.count()
    plan = calibrated(number, cosine, recall)
    classes = classes.withColumn("left_out", F.lit(None).cast("array<bigint>"))
    crowded = checkpointed(crowded_lists(classes, size, plan, number, most_in_list))
    marked = classes if crowded.isEmpty() else checkpointed(classes.drop("left_out").join(crowded, "cid", "left"))
    met = collisions(marked, size, plan, number, cosine).groupBy("a", "b").count().where(F.col("count") >= plan.least_count).select("a", "b")
    x, y = (marked.select(F.col("cid").alias(c), F.col("embedding").alias(f"v{c}"), F.col("copies").alias(f"n{c}")) for c in "ab")
    pairs = checkpointed(met.join(x, "a").join(y, "b").where(cosine_of("va", "vb") >= cosine).select("a", "b", "na", "nb"))
    links = pairs.select(F.col("a").alias("cid"), F.col("nb").alias("links")).unionAll(pairs.select(F.col("b").alias("cid"), F.col("na").alias("links")))
    edges = pairs.select("a", "b")
    if not crowded.isEmpty():
        dense = marked.where("left_out IS NOT NULL")
        more, ties = in_blocks(dense, dense.count(), cosine)
        links, edges = links.unionByName(more), edges.unionByName(ties)
    return links.groupBy("cid").agg(F.sum("links").alias("links")), edges


def near_vectors(vectors: DataFrame, cosine: float = 0.9, most_in_list: int = 512, recall: float = 0.98) -> DataFrame:
    """Per row of (vec_id, embedding): vec_id, n_links, component_id, kept."""
    sound = F.coalesce((F.size("embedding") > 0) & F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("embedding", lambda v: v != 0), F.lit(False))
    rows = vectors.select("vec_id", "embedding", sound.alias("sound"))
    classes = rows.where("sound").groupBy("embedding").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies"))
    classes = checkpointed(classes.withColumn("cid", F.monotonically_increasing_id()))
    links = edges = None
    for size in sorted(r[0] for r in classes.select(F.size("embedding")).distinct().collect()):
        more = linked_classes(classes.where(F.size("embedding") == size), size, cosine, most_in_list, recall)
        links, edges = more if links is None else (links.unionByName(more[0]), edges.unionByName(more[1]))
    if links is None:
        joined = classes.select("embedding", F.lit(0).cast("long").alias("n_links"), F.col("first_id").alias("component_id"), "copies")
    else:
        tied = connected_components(edges, "a", "b").select(F.col("node").alias("cid"), "component")
        placed = classes.join(links, "cid", "left").join(tied, "cid", "left").withColumn("component", F.coalesce("component", "cid"))
        least = placed.groupBy("component").agg(F.min("first_id").alias("component_id"))
        joined = placed.join(least, "component").select("embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"), "component_id", "copies")
    found = unique_join(rows.where("sound").select("vec_id", "embedding"), checkpointed(joined), "embedding", "copies").select("vec_id", "n_links", "component_id")
    alone = rows.where("NOT sound").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return found.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op3_embedding_dedup(vectors: DataFrame) -> DataFrame:
    return near_vectors(vectors)
