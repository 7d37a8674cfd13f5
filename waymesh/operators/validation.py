"""Checks, reports and derived statistics of trails and networks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymesh.functions import geo
from waymesh.operators import graph, spatial


@dataclass(frozen=True)
class Check:
    name: str
    severity: str  # error or warning
    holds: Column


def report(df: DataFrame, checks: list[Check]) -> DataFrame:
    """(rule, severity, failed, status) of all checks in one pass. A null doesn't hold."""
    counts = df.agg(*[F.count_if(~F.coalesce(c.holds, F.lit(False))).alias(f"c{k}") for k, c in enumerate(checks)])
    rows = F.array(*[F.struct(F.lit(c.name).alias("rule"), F.lit(c.severity).alias("severity"), F.col(f"c{k}").alias("failed")) for k, c in enumerate(checks)])
    made = counts.select(F.explode(rows).alias("r")).select("r.*")
    return made.withColumn("status", F.when(F.col("failed") == 0, "PASS").when(F.col("severity") == "error", "FAIL").otherwise("WARNING"))


def line_counts(lines: DataFrame, line: str = "coords") -> DataFrame:
    n, m = F.size(line), geo.length_m(line)
    return lines.agg(F.count("*").alias("total"), F.count_if(m == 0).alias("zero_length"), F.count_if(n < 2).alias("single_point"), F.count_if(geo.is_closed(line) & (n >= 2)).alias("self_loops"))


def connectivity(edges: DataFrame) -> DataFrame:
    """Number of components and nodes, and the largest's size and share."""
    sizes = graph.components(edges).groupBy("component").agg(F.count("*").alias("n"))
    made = sizes.agg(F.count("*").alias("components"), F.sum("n").alias("nodes"), F.max("n").alias("largest"))
    return made.withColumn("largest_pct", F.round(F.col("largest") * 100.0 / F.col("nodes"), 4))


def composition(parts: DataFrame, edge: str, trail: str) -> DataFrame:
    """(edge_id, trail_id, seq, pct): which trails an edge was made of."""
    sums = parts.groupBy(F.col(edge).alias("edge_id"), F.col(trail).alias("trail_id")).agg(F.sum("length_km").alias("km"))
    w = Window.partitionBy("edge_id")
    return sums.select("edge_id", "trail_id", F.row_number().over(w.orderBy("trail_id")).alias("seq"), F.round(F.col("km") * 100 / F.sum("km").over(w), 4).alias("pct"))


def short_connectors(edges: DataFrame, km: float) -> DataFrame:
    """Edges under ``km`` that lead to a vertex of degree 1."""
    ends = graph.degrees(edges).where("degree = 1").select("node")
    at = graph.incident(edges.where(F.col("length_km") < km)).join(ends, "node", "left_semi")
    return edges.join(at.select("id").distinct(), "id", "left_semi")


def bypass_candidates(nodes: DataFrame, edges: DataFrame, metres: float, sheet: spatial.Sheet = None) -> DataFrame:
    """(id, node): other vertices within ``metres`` of an edge, drawn straight between its ends."""
    size, margin = 0.05, metres / geo.METRES_PER_DEGREE * 2.5
    at = nodes.select("id", geo.point(F.col("lng"), F.col("lat")).alias("p"))
    drawn = graph.without_loops(edges).select("id", "source", "target").join(at.select(F.col("id").alias("source"), F.col("p").alias("a")), "source").join(at.select(F.col("id").alias("target"), F.col("p").alias("b")), "target")
    on = lambda k: F.lit(0) if sheet is None else sheet(F.col(k))
    cells = spatial.covering(drawn.withColumn("_sheet", on("source")), size, margin)
    near = at.select(F.col("id").alias("node"), "p", F.floor(F.col("p.x") / size).alias("gx"), F.floor(F.col("p.y") / size).alias("gy"), on("id").alias("_sheet"))
    met = cells.hint("merge").join(near.hint("merge"), ["_sheet", "gx", "gy"]).where("node <> source AND node <> target")
    return met.where(geo.distance(F.col("p"), geo.between(F.col("a"), F.col("b"), geo.nearest_ratio(F.col("p"), F.col("a"), F.col("b")))) <= metres).select("id", "node")


def subdivided(points: DataFrame, n: int, x: str = "x", y: str = "y") -> DataFrame:
    """``points`` with gx, gy: their cell of an n by n grid over their box."""
    box = points.agg(F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1"))
    cell = lambda c, a, b: F.least(F.lit(n - 1), F.floor(F.coalesce(F.try_divide(F.col(c) - F.col(a), F.col(b) - F.col(a)), F.lit(0.0)) * n)).cast("long")
    return points.crossJoin(F.broadcast(box)).withColumn("gx", cell(x, "x0", "x1")).withColumn("gy", cell(y, "y0", "y1")).drop("x0", "x1", "y0", "y1")


def node_features(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, x, y, elevation, degree, avg_km)."""
    at = graph.incident(edges).join(edges.select("id", "length_km"), "id").groupBy(F.col("node").alias("id")).agg(F.count("*").alias("degree"), F.avg("length_km").alias("avg_km"))
    joined = nodes.join(at, "id", "left")
    return joined.select("id", F.col("lng").alias("x"), F.col("lat").alias("y"), "elevation", F.coalesce("degree", F.lit(0)).alias("degree"), F.coalesce("avg_km", F.lit(0.0)).alias("avg_km"))


def node_label(degree: Column) -> Column:
    """1: two edges to merge; 2: four or more to split; 0: leave."""
    return F.when(degree == 2, 1).when(degree >= 4, 2).otherwise(0)


def part_of(key: Column) -> Column:
    """train, val or test (7, 2 and 1 of 10) by a hash of the key."""
    h = F.conv(F.substring(F.md5(key.cast("string").cast("binary")), 1, 7), 16, 10).cast("long") % 10
    return F.when(h < 7, "train").when(h < 9, "val").otherwise("test")


def is_uuid(text: Column) -> Column:
    """A UUID of versions 1 to 5 and the usual variant."""
    return F.lower(text).rlike("^[0-9a-f]{8}-[0-9a-f]{4}-[1-5][0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$")


def dimensions(points: DataFrame) -> DataFrame:
    """Counts over points (x, y, z): without elevation, outside the globe, not numbers, all."""
    x, y = F.col("x"), F.col("y")
    return points.agg(F.count_if(F.col("z").isNull()).alias("flat"), F.count_if(~x.between(-180, 180) | ~y.between(-90, 90)).alias("outside"), F.count_if(F.isnan(x) | F.isnan(y)).alias("not_numbers"), F.count("*").alias("points"))


def issues(df: DataFrame, key: str, found: dict[str, Column]) -> DataFrame:
    """(issue, key): a row for each issue that a row of ``df`` has, in one pass."""
    each = F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in found.items()])
    return df.select(F.explode(F.array_compact(each)).alias("issue"), key)


def distributions(df: DataFrame, columns: list[str], unique: list[str]) -> DataFrame:
    """(what, value, n): counts by the values of each column, and how many combinations of
    ``unique`` occur more than once."""
    pairs = F.array(*[F.struct(F.lit(c).alias("what"), F.col(c).cast("string").alias("value")) for c in columns])
    counts = df.select(F.explode(pairs).alias("p")).groupBy("p.what", "p.value").agg(F.count("*").alias("n"))
    twice = df.groupBy(*unique).count().where("count > 1").agg(F.count("*").alias("n"))
    return counts.unionByName(twice.select(F.lit("duplicate").alias("what"), F.lit(unique[0]).alias("value"), "n"))


def schema_diff(df: DataFrame, expected: dict[str, str]) -> DataFrame:
    """(name, expected, found, status): 'same', 'changed', 'missing' or 'extra' for each column."""
    found = dict(df.dtypes)
    rows = [(n, t, found.get(n), "missing" if n not in found else "same" if found[n] == t else "changed") for n, t in expected.items()]
    rows += [(n, None, t, "extra") for n, t in found.items() if n not in expected]
    return df.sparkSession.createDataFrame(rows, "name string, expected string, found string, status string")


def routing_graph(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(rule, failed): what keeps a network from being routed over."""
    clean = graph.without_loops(edges)
    parallel = clean.groupBy(F.least("source", "target"), F.greatest("source", "target")).count().where("count > 1")
    parts = {
        "orphan_nodes": graph.orphan_nodes(nodes, edges), "unknown_ends": graph.orphan_edges(nodes, edges), "loops": edges.where("source = target"),
        "parallel": parallel, "no_length": edges.where(~F.coalesce(F.col("length_km") > 0, F.lit(False))),
    }
    made = [d.agg(F.count("*").alias("failed")).select(F.lit(name).alias("rule"), "failed") for name, d in parts.items()]
    whole = made[0]
    for one in made[1:]:
        whole = whole.unionByName(one)
    return whole
