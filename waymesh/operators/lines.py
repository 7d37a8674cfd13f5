"""Trails as lines: intersections, splitting, snapping, gaps, duplicates, merging."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymesh.functions import geo
from waymesh.operators import spatial
from waymesh.operators.components import connected_components
from waymesh.plans.durable import checkpointed


def _sheets(sheet: spatial.Sheet, one: str, two: str) -> tuple[Column, Column] | None:
    return None if sheet is None else (sheet(F.col(one)), sheet(F.col(two)))


def with_derived(lines: DataFrame, line: str = "coords") -> DataFrame:
    """Length, box and elevation columns of each line."""
    e, b = geo.elevation(line), geo.bbox(line)
    made = lines.withColumn("_e", e).withColumn("_b", b).withColumn("length_m", geo.length_m(line))
    return made.select("*", "_b.*", F.col("_e.gain").alias("elevation_gain"), F.col("_e.loss").alias("elevation_loss"), "_e.min_z", "_e.max_z", "_e.avg_z").drop("_e", "_b")


def valid_lines(lines: DataFrame, least_m: float = 0.0, line: str = "coords") -> DataFrame:
    return lines.where(F.col(line).isNotNull() & (F.size(line) >= 2) & geo.is_valid(line) & (geo.length_m(line) >= least_m))


def without_repeated_points(lines: DataFrame, line: str = "coords") -> DataFrame:
    return lines.withColumn(line, geo.without_repeats(line))


def multi_crossings(crossings: DataFrame) -> DataFrame:
    """(id1, id2, n, kind): pairs by number of crossing points: x, dual, or p for three and more."""
    n = crossings.groupBy("id1", "id2").agg(F.count("*").alias("n"))
    return n.withColumn("kind", F.when(F.col("n") == 1, "x_intersection").when(F.col("n") == 2, "dual_intersection").otherwise("p_intersection"))


def crossing_points(crossings: DataFrame, key: str = "trail_id") -> DataFrame:
    """(key, seg, t, x, y, z): a crossing's place on both of its lines."""
    one = crossings.select(F.col("id1").alias(key), F.col("seg1").alias("seg"), F.col("ratio").alias("t"), "x", "y", "z")
    return one.unionAll(crossings.select("id2", "seg2", "ratio2", "x", "y", "z"))


def touching_points(touches: DataFrame, key: str = "trail_id") -> DataFrame:
    """The same for what ``points_on_lines`` finds, on the visited line."""
    return touches.select(F.col("visited").alias(key), "seg", "t", "x", "y", "z")


def measured_segments(lines: DataFrame, key: str = "trail_id", line: str = "coords") -> DataFrame:
    """(key, seg, from_m, len_m, total_m): where each segment lies along its line."""
    s = spatial.segment_rows(lines, key, line).select(key, "seg", geo.distance(F.col("a"), F.col("b")).alias("len_m"))
    along = Window.partitionBy(key).orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    return s.select(key, "seg", F.coalesce(F.sum("len_m").over(along), F.lit(0.0)).alias("from_m"), "len_m", F.sum("len_m").over(Window.partitionBy(key)).alias("total_m"))


def cuts(lines: DataFrame, points: DataFrame, key: str = "trail_id", line: str = "coords", least: float = 0.0015, least_m: float = 0.0) -> DataFrame:
    """(key, r, p): where each line is to be cut, as a share of its length, and the point
    there; points at one share, to nine places, are one, and those within ``least`` (of the
    length) or ``least_m`` of an end are none."""
    placed = points.join(measured_segments(lines, key, line), [key, "seg"]).withColumn("r", (F.col("from_m") + F.col("t") * F.col("len_m")) / F.col("total_m"))
    inner = placed.where(F.col("r").between(least, 1 - least) & (F.col("r") * F.col("total_m") >= least_m) & ((1 - F.col("r")) * F.col("total_m") >= least_m))
    return inner.groupBy(key, F.round("r", 9).alias("r")).agg(F.min(F.struct("x", "y", "z")).alias("p"))


def split(lines: DataFrame, cuts: DataFrame, key: str = "trail_id", line: str = "coords") -> DataFrame:
    """(parent, part, id, coords): every line cut at all of its cuts; others whole.

    A line's points and cuts are rows in the order of their place; the part of a row is the
    number of cuts before it, and a cut ends one part and begins the next. So the work grows
    with the points and not with points times cuts."""
    along = Window.partitionBy(key).orderBy("i")
    points = lines.select(key, F.posexplode(line).alias("i", "p"))
    step = F.coalesce(geo.distance(F.lag("p").over(along), F.col("p")), F.lit(0.0))
    points = points.withColumn("m", step).withColumn("at", F.sum("m").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    total = F.sum("m").over(Window.partitionBy(key))
    points = points.select(key, F.when(total > 0, F.col("at") / total).otherwise(0.0).alias("r"), (F.col("i") + 1).alias("i"), "p")
    rows = points.unionByName(cuts.select(key, "r", F.lit(0).alias("i"), "p"))
    before = Window.partitionBy(key).orderBy("r", "i").rowsBetween(Window.unboundedPreceding, -1)
    is_cut = F.col("i") == 0
    rows = rows.withColumn("part", F.coalesce(F.sum(is_cut.cast("int")).over(before), F.lit(0)).cast("int")).withColumn("last_cut", F.last(F.when(is_cut, F.col("r")), True).over(before))
    rows = rows.where(is_cut | F.col("last_cut").isNull() | (F.col("last_cut") != F.col("r")))
    rows = rows.withColumn("part", F.explode(F.when(is_cut, F.array("part", F.col("part") + 1)).otherwise(F.array("part"))))
    made = rows.groupBy(F.col(key).alias("parent"), "part").agg(F.sort_array(F.collect_list(F.struct("r", "i", "p"))).alias("c"))
    made = made.select("parent", "part", F.transform("c", lambda v: v["p"]).alias("coords"))
    made = made.unionByName(lines.where(F.coalesce(F.size(line) <= 0, F.lit(True))).select(F.col(key).alias("parent"), F.lit(0).alias("part"), F.col(line).alias("coords")))
    return made.select("parent", "part", part_id(F.col("parent"), F.col("part")).alias("id"), "coords")


def part_id(parent: Column, part: Column) -> Column:
    """An id that the same cut of the same line always gets."""
    return F.sha2(F.concat_ws("#", parent.cast("string"), part.cast("string")), 256)


def split_everywhere(lines: DataFrame, touch_m: float | None = None, key: str = "trail_id", line: str = "coords", crossing: bool = True, sheet: spatial.Sheet = None) -> DataFrame:
    """Lines cut at all crossings (unless ``crossing`` is false) and, with ``touch_m``, where
    ends of others touch them."""
    lines = checkpointed(lines)
    points = crossing_points(spatial.crossings(lines, key, line, sheet=sheet), key) if crossing else None
    if touch_m is not None:
        touching = touching_points(spatial.ends_on_lines(lines, touch_m, key, line, sheet=sheet), key)
        points = touching if points is None else points.unionByName(touching)
    return lines.select(F.col(key).alias("parent"), F.lit(0).alias("part"), part_id(F.col(key), F.lit(0)).alias("id"), F.col(line).alias("coords")) if points is None else split(lines, cuts(lines, points, key, line), key, line)


def split_doubles(lines: DataFrame, key: str = "trail_id", line: str = "coords", sheet: spatial.Sheet = None) -> DataFrame:
    """Lines cut where they cross another one exactly twice."""
    found = spatial.crossings(lines, key, line, sheet=sheet)
    twice = multi_crossings(found).where("n = 2").select("id1", "id2")
    return split(lines, cuts(lines, crossing_points(found.join(twice, ["id1", "id2"], "left_semi"), key), key, line), key, line)


def split_at_points(lines: DataFrame, points: DataFrame, metres: float, key: str = "trail_id", line: str = "coords", sheets: tuple[spatial.Sheet, spatial.Sheet] = (None, None)) -> DataFrame:
    """Lines cut at the nearest point to each of ``points`` (point, x, y, z) within ``metres``."""
    return split(lines, cuts(lines, touching_points(spatial.points_on_lines(points, lines, metres, ["point"], key, line, sheets=sheets), key), key, line), key, line)


def split_until_stable(lines: DataFrame, metres: float, rounds: int = 10, key: str = "trail_id", line: str = "coords") -> DataFrame:
    """(id, root, coords): ends moved onto a line within ``metres``, and that line cut there, round
    after round until nothing is cut (``rounds`` at most, the surveyed limit). Cuts leave no part
    shorter than ``metres``, so the number of parts is bounded by the length. ``root`` is the
    key of the line that a part comes from."""
    now = checkpointed(lines.select(F.col(key).cast("string").alias("id"), F.col(key).alias("root"), F.col(line).alias("coords")))
    for _ in range(rounds):
        moved = checkpointed(snap_ends(now, metres, "id", "coords"))
        touches = spatial.ends_on_lines(moved, metres, "id", "coords")
        found = checkpointed(cuts(moved, touching_points(touches, "id"), "id", "coords", least_m=metres))
        if found.isEmpty():
            return moved
        parts = split(moved, found, "id", "coords").withColumn("many", F.count("*").over(Window.partitionBy("parent")) > 1)
        named = parts.select("parent", F.when(F.col("many"), F.col("id")).otherwise(F.col("parent")).alias("id"), "coords")
        now = checkpointed(named.join(moved.select(F.col("id").alias("parent"), "root"), "parent").select("id", "root", "coords"))
    return now


def split_rows(lines: DataFrame, parts: DataFrame, key: str = "trail_id", line: str = "coords") -> DataFrame:
    """The geometry ledger of a split: (key, change, n_parts, before_hash, after_hash): 'split',
    'kept' or 'deleted' for each line, with hashes of the coordinates before and after."""
    said = lambda c: F.md5(F.to_json(c).cast("binary"))
    after = parts.groupBy(F.col("parent").alias(key)).agg(F.count("*").alias("n_parts"), F.md5(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", said("coords").alias("h")))), lambda x: x["h"]), "").cast("binary")).alias("after_hash"))
    joined = lines.select(key, said(line).alias("before_hash")).join(after, key, "left")
    change = F.when(F.col("n_parts").isNull(), "deleted").when(F.col("n_parts") > 1, "split").otherwise("kept")
    return joined.select(key, change.alias("change"), F.coalesce("n_parts", F.lit(0)).alias("n_parts"), "before_hash", "after_hash")


def proximity_groups(lines: DataFrame, metres: float, key: str = "trail_id", line: str = "coords", sheet: spatial.Sheet = None) -> DataFrame:
    """Lines with the ends of each group of near ends moved to its mean, and then cut where an
    end of another line lies on them."""
    moved = checkpointed(consolidated_ends(lines, metres, key, line, sheet))
    return split_everywhere(moved, metres, key, line, crossing=False, sheet=sheet)


def dedupe_by_distance(lines: DataFrame, metres: float, key: str = "trail_id", line: str = "coords", sheet: spatial.Sheet = None) -> DataFrame:
    """Of each group of lines whose starts and ends lie within ``metres`` of each other's, the
    longest, the least key among equals."""
    e = lines.select(F.col(key).alias("k"), geo.start_point(line).alias("s"), geo.end_point(line).alias("t"))
    a = e.select(F.col("k").alias("id1"), F.col("t").alias("t1"), F.col("s.x").alias("x"), F.col("s.y").alias("y"))
    b = e.select(F.col("k").alias("id2"), F.col("t").alias("t2"), F.col("s.x").alias("x2"), F.col("s.y").alias("y2"))
    pairs = spatial.within_distance(a, b, metres, sheets=_sheets(sheet, "id1", "id2")).where("id1 < id2").where(geo.distance(F.col("t1"), F.col("t2")) <= metres)
    groups = connected_components(pairs, "id1", "id2").select(F.col("node").alias(key), "component")
    tied = lines.join(groups, key, "left").withColumn("component", F.coalesce("component", key))
    best = Window.partitionBy("component").orderBy(F.round(geo.length_m(line), 6).desc(), key)
    return tied.withColumn("_k", F.row_number().over(best)).where("_k = 1").drop("_k", "component")


def simplified(lines: DataFrame, metres: float, line: str = "coords") -> DataFrame:
    """Lines without the points that lie within ``metres`` of the straight way between the points
    kept before and after them, by halving at the farthest point."""
    @F.pandas_udf(geo.LINE)
    def made(column: pd.Series) -> pd.Series:
        return pd.Series([None if c is None else thinned(list(c), metres) for c in column])

    return lines.withColumn(line, made(line))


def thinned(points: list[dict], metres: float) -> list[dict]:
    """The points that ``simplified`` keeps; distances on the plane around the first point."""
    if len(points) < 3:
        return points
    xyz = np.array([(p["x"], p["y"]) for p in points], dtype=float) * geo.METRES_PER_DEGREE
    xyz[:, 0] *= np.cos(np.radians(points[0]["y"]))
    keep, open_ = {0, len(points) - 1}, [(0, len(points) - 1)]
    while open_:
        i, j = open_.pop()
        if j - i < 2:
            continue
        d, between = xyz[j] - xyz[i], xyz[i + 1 : j] - xyz[i]
        squared = float(d @ d)
        t = np.clip(between @ d / squared, 0, 1) if squared else np.zeros(len(between))
        far = np.hypot(*(between - t[:, None] * d).T)
        k = int(far.argmax())
        if far[k] > metres:
            keep.add(i + 1 + k)
            open_ += [(i, i + 1 + k), (i + 1 + k, j)]
    return [points[k] for k in sorted(keep)]


def self_split(lines: DataFrame, key: str = "trail_id", line: str = "coords") -> DataFrame:
    """Lines that cross themselves cut at those points, into simple parts."""
    s = F.transform(geo.segments(line), lambda p, i: F.struct(i.alias("j"), p["a"].alias("a"), p["b"].alias("b")))
    hits = F.flatten(F.transform(s, lambda p, i: F.transform(F.filter(F.slice(s, i + 3, F.size(s)), lambda q: geo.proper_crossing(p["a"], p["b"], q["a"], q["b"])), lambda q: F.struct(i.alias("i"), q["j"].alias("j"), p.alias("p"), q.alias("q")))))
    found = lines.select(key, F.explode(hits).alias("h"))
    p, q, i, j = F.col("h.p"), F.col("h.q"), F.col("h.i"), F.col("h.j")
    one, two = geo.crossing_ratio(p["a"], p["b"], q["a"], q["b"]), geo.crossing_ratio(q["a"], q["b"], p["a"], p["b"])
    both = found.select(key, one.alias("t1"), two.alias("t2"), i.alias("i"), j.alias("j"), geo.between(p["a"], p["b"], one).alias("at"))
    points = both.select(key, F.col("i").alias("seg"), F.col("t1").alias("t"), "at.*").unionAll(both.select(key, "j", "t2", "at.*"))
    return split(lines, cuts(lines, points, key, line, 0.0), key, line)


def missed_intersections(lines: DataFrame, metres: float, n: int, key: str = "trail_id", line: str = "coords", sheet: spatial.Sheet = None) -> DataFrame:
    """(id1, id2, metres): lines whose ends are within ``metres`` but that don't cross; closest first."""
    e = spatial.endpoints(lines, key, line)
    a, b = e.select(F.col(key).alias("id1"), "x", "y"), e.select(F.col(key).alias("id2"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    near = spatial.within_distance(a, b, metres, sheets=_sheets(sheet, "id1", "id2")).where("id1 < id2").groupBy("id1", "id2").agg(F.min("metres").alias("metres"))
    apart = near.join(spatial.crossings(lines, key, line, sheet=sheet).select("id1", "id2").distinct(), ["id1", "id2"], "left_anti")
    return apart.orderBy("metres", "id1", "id2").limit(n)


def gap_connectors(lines: DataFrame, metres: float, least_m: float = 0.0, key: str = "trail_id", line: str = "coords", sheet: spatial.Sheet = None) -> DataFrame:
    """(id1, end1, id2, end2, metres, coords): a connector for the closest pairing of ends of two
    lines that lie within ``metres`` and over ``least_m`` apart."""
    e = spatial.endpoints(lines, key, line)
    a = e.select(F.col(key).alias("id1"), F.col("end").alias("end1"), "x", "y", "z")
    b = e.select(F.col(key).alias("id2"), F.col("end").alias("end2"), F.col("x").alias("x2"), F.col("y").alias("y2"), F.col("z").alias("z2"))
    near = spatial.within_distance(a, b, metres, sheets=_sheets(sheet, "id1", "id2")).where("id1 < id2").where(F.col("metres") > least_m)
    made = near.withColumn("coords", F.array(geo.point(F.col("x"), F.col("y"), F.col("z")), geo.point(F.col("x2"), F.col("y2"), F.col("z2"))))
    best = made.groupBy("id1", "id2").agg(F.min(F.struct("metres", "end1", "end2", "coords")).alias("m"))
    return best.select("id1", "m.end1", "id2", "m.end2", "m.metres", "m.coords")


def snap_ends(lines: DataFrame, metres: float, key: str = "trail_id", line: str = "coords", sheet: spatial.Sheet = None) -> DataFrame:
    """Each end moved to the nearest point of the nearest other line within ``metres``."""
    touches = spatial.ends_on_lines(lines, metres, key, line, sheet=sheet)
    best = touches.groupBy(F.col("visitor").alias(key), "end").agg(F.min(F.struct("metres", "visited", "x", "y")).alias("m"))
    ends = best.groupBy(key).agg(*[F.first(F.when(F.col("end") == e, F.struct("m.x", "m.y")), ignorenulls=True).alias(e) for e in ("start", "end")])
    s, t = F.col("start"), F.col("end")
    moved = lines.join(ends, key, "left")
    new = F.when(s.isNotNull(), geo.set_point(line, 0, geo.point(s["x"], s["y"], geo.start_point(line)["z"]))).otherwise(F.col(line))
    moved = moved.withColumn(line, new)
    new = F.when(t.isNotNull(), geo.set_point(line, -1, geo.point(t["x"], t["y"], geo.end_point(line)["z"]))).otherwise(F.col(line))
    return moved.withColumn(line, new).select(*lines.columns)


def endpoint_clusters(lines: DataFrame, metres: float, key: str = "trail_id", line: str = "coords", sheet: spatial.Sheet = None) -> DataFrame:
    """(key, end, x, y, cluster): ends that are linked by steps of at most ``metres`` are one
    cluster, named by its least end. Ends at one place count as one point."""
    e = spatial.endpoints(lines, key, line).withColumn("_sheet", F.lit(0) if sheet is None else sheet(F.col(key)))
    e = e.withColumn("place", F.xxhash64("x", "y") if sheet is None else F.xxhash64("_sheet", "x", "y"))
    places = checkpointed(e.groupBy("place").agg(F.first("x").alias("x"), F.first("y").alias("y"), F.first("_sheet").alias("s1")))
    near = spatial.within_distance(places.select(F.col("place").alias("p1"), "x", "y", "s1"), places.select(F.col("place").alias("p2"), F.col("x").alias("x2"), F.col("y").alias("y2"), F.col("s1").alias("s2")), metres, sheets=(F.col("s1"), F.col("s2")))
    groups = connected_components(near.where("p1 <= p2").select("p1", "p2"), "p1", "p2")
    named = e.join(groups.withColumnRenamed("node", "place"), "place")
    return named.select(key, "end", "x", "y", F.min(F.struct(F.col(key), "end")).over(Window.partitionBy("component")).alias("cluster"))


def consolidated_ends(lines: DataFrame, metres: float, key: str = "trail_id", line: str = "coords", sheet: spatial.Sheet = None) -> DataFrame:
    """Lines with every end moved to the mean of its cluster."""
    c = endpoint_clusters(lines, metres, key, line, sheet)
    means = c.groupBy("cluster").agg(F.avg("x").alias("mx"), F.avg("y").alias("my"))
    ends = c.join(means, "cluster").groupBy(key).agg(*[F.first(F.when(F.col("end") == e, F.struct("mx", "my")), ignorenulls=True).alias(e) for e in ("start", "end")])
    joined = lines.join(ends, key)
    moved = joined.withColumn(line, geo.set_point(line, 0, geo.point(F.col("start.mx"), F.col("start.my"), geo.start_point(line)["z"])))
    return moved.withColumn(line, geo.set_point(line, -1, geo.point(F.col("end.mx"), F.col("end.my"), geo.end_point(line)["z"]))).select(*lines.columns)


def duplicates(lines: DataFrame, metres: float, key: str = "trail_id", name: str = "name", line: str = "coords", sheet: spatial.Sheet = None) -> DataFrame:
    """(id1, id2, metres): lines of one name whose starts are within ``metres``."""
    s = lines.select(key, name, geo.start_point(line).alias("p"))
    a = s.select(F.col(key).alias("id1"), F.col(name).alias("n1"), F.col("p.x").alias("x"), F.col("p.y").alias("y"))
    b = s.select(F.col(key).alias("id2"), F.col(name).alias("n2"), F.col("p.x").alias("x2"), F.col("p.y").alias("y2"))
    return spatial.within_distance(a, b, metres, sheets=_sheets(sheet, "id1", "id2")).where("id1 < id2 AND n1 = n2").select("id1", "id2", "metres")


def dedupe_overlaps(lines: DataFrame, metres: float, share: float = 0.8, key: str = "trail_id", line: str = "coords", sheet: spatial.Sheet = None) -> DataFrame:
    """Lines but for those of which ``share`` of the points lie within ``metres`` of a longer
    one (or, equally long, one with a lesser key)."""
    size = max(spatial.cell_size(metres) * 4, 0.01)
    margin = metres / geo.METRES_PER_DEGREE * 2.5
    points = lines.select(F.col(key).alias("k"), F.posexplode(line).alias("i", "p")).withColumn("gx", F.floor(F.col("p.x") / size)).withColumn("gy", F.floor(F.col("p.y") / size))
    on = lambda k: (F.lit(0) if sheet is None else sheet(F.col(k))).alias("_sheet")
    points = points.select("*", on("k"))
    s = spatial.covering(spatial.segment_rows(lines, key, line), size, margin).select(F.col(key).alias("other"), "a", "b", on(key), "gx", "gy")
    near = points.hint("merge").join(s.hint("merge"), ["_sheet", "gx", "gy"]).where("k <> other").where(geo.distance(F.col("p"), geo.between(F.col("a"), F.col("b"), geo.nearest_ratio(F.col("p"), F.col("a"), F.col("b")))) <= metres)
    met = near.groupBy("k", "other").agg(F.count_distinct("i").alias("n"))
    info = lines.select(F.col(key).alias("k"), F.round(geo.length_m(line), 6).alias("m"), F.size(line).alias("points"))
    both = met.join(info, "k").join(info.select(F.col("k").alias("other"), F.col("m").alias("m2")), "other")
    lost = both.where((F.col("n") >= F.col("points") * share) & ((F.col("m2") > F.col("m")) | ((F.col("m2") == F.col("m")) & (F.col("other") < F.col("k")))))
    return lines.join(lost.select(F.col("k").alias(key)).distinct(), key, "left_anti")


def name_similarity(a: Column, b: Column) -> Column:
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, 1.0).otherwise(1 - F.levenshtein(F.lower(a), F.lower(b)) / longest)


def merge_pairs(trails: DataFrame, metres: float = 50.0, least_name: float = 0.7, least_length: float = 0.8, sheet: spatial.Sheet = None) -> DataFrame:
    """(id1, id2, name_similarity, length_similarity, metres) of trails (trail_id, name,
    length_km, x, y: the centre) that are one trail from different sources."""
    a = trails.select(F.col("trail_id").alias("id1"), F.col("name").alias("n1"), F.col("length_km").alias("k1"), "x", "y")
    b = trails.select(F.col("trail_id").alias("id2"), F.col("name").alias("n2"), F.col("length_km").alias("k2"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    near = spatial.within_distance(a, b, metres, sheets=_sheets(sheet, "id1", "id2")).where("id1 < id2")
    scored = near.withColumn("name_similarity", name_similarity(F.col("n1"), F.col("n2"))).withColumn("length_similarity", F.try_divide(F.least("k1", "k2"), F.greatest("k1", "k2")))
    return scored.where((F.col("name_similarity") >= least_name) & (F.col("length_similarity") >= least_length)).select("id1", "id2", "name_similarity", "length_similarity", "metres")


def merged_trails(trails: DataFrame, pairs: DataFrame, order: list[Column]) -> DataFrame:
    """One trail of each group of pairs, the first in ``order``, with the ids it stands for."""
    groups = connected_components(pairs, "id1", "id2").select(F.col("node").alias("trail_id"), "component")
    tied = trails.join(groups, "trail_id", "left").withColumn("component", F.coalesce("component", "trail_id"))
    best = Window.partitionBy("component").orderBy(*order, "trail_id")
    ids = F.collect_list("trail_id").over(Window.partitionBy("component"))
    return tied.withColumn("merged_from", F.sort_array(ids)).withColumn("_k", F.row_number().over(best)).where("_k = 1").drop("_k", "component")


def split_check(parents: DataFrame, parts: DataFrame, key: str = "trail_id", line: str = "coords") -> DataFrame:
    """(key, parent_m, parts_m, ok): lengths of the parts against the whole; ok within a metre
    and a thousandth."""
    whole = parents.select(key, geo.length_m(line).alias("parent_m"))
    sums = parts.groupBy(F.col("parent").alias(key)).agg(F.sum(geo.length_m("coords")).alias("parts_m"))
    joined = whole.join(sums, key, "left").withColumn("parts_m", F.coalesce("parts_m", F.lit(0.0)))
    miss = F.abs(F.col("parent_m") - F.col("parts_m"))
    return joined.withColumn("ok", (miss <= 1) & (miss <= F.col("parent_m") * 0.001 + 1e-9))


def grid_nodes(lines: DataFrame, degrees: float = 0.000045, key: str = "trail_id", line: str = "coords") -> DataFrame:
    """(gx, gy, x, y, uses): ends snapped to a grid, one vertex a cell."""
    e = spatial.endpoints(lines, key, line).withColumn("gx", F.round(F.col("x") / degrees).cast("long")).withColumn("gy", F.round(F.col("y") / degrees).cast("long"))
    return e.groupBy("gx", "gy").agg(F.avg("x").alias("x"), F.avg("y").alias("y"), F.count("*").alias("uses"))


def network_from_lines(lines: DataFrame, degrees: float = 0.000045, key: str = "trail_id", line: str = "coords") -> tuple[DataFrame, DataFrame]:
    """(nodes, edges): a vertex for each grid cell with an end, an edge for each line that
    joins two of them. A vertex's id is the hash of its cell, so no distance is searched."""
    node = lambda p: F.xxhash64(F.round(p["x"] / degrees).cast("long"), F.round(p["y"] / degrees).cast("long"))
    edges = lines.select(F.col(key).alias("id"), node(geo.start_point(line)).alias("source"), node(geo.end_point(line)).alias("target"), (geo.length_m(line) / 1000).alias("length_km"), geo.elevation(line).alias("e"), line)
    edges = edges.where("source <> target").select("id", "source", "target", "length_km", F.col("e.gain").alias("elevation_gain"), F.col("e.loss").alias("elevation_loss"), line)
    nodes = grid_nodes(lines, degrees, key, line).select(F.xxhash64("gx", "gy").alias("id"), F.col("x").alias("lng"), F.col("y").alias("lat"), "uses")
    return nodes, edges


def cleaned(lines: DataFrame, steps: list[tuple[str, Callable[[DataFrame], DataFrame]]], line: str = "coords") -> tuple[DataFrame, DataFrame]:
    """The lines after all steps, each of them written before the next, and a report (seq, step,
    lines_before, lines_after, km_before, km_after)."""
    state = lambda d: tuple(d.agg(F.count("*"), F.round(F.coalesce(F.sum(geo.length_m(line)), F.lit(0.0)) / 1000, 3)).first())
    now, rows = lines, []
    before = state(now)
    for k, (name, step) in enumerate(steps):
        now = checkpointed(step(now))
        after = state(now)
        rows.append((k + 1, name, before[0], after[0], before[1], after[1]))
        before = after
    return now, lines.sparkSession.createDataFrame(rows, "seq int, step string, lines_before long, lines_after long, km_before double, km_after double")
