"""Spatial joins as equi-joins on grid cells followed by the exact predicate.

A cell is a latitude band and a column whose width follows the band, so a distance in metres
never spans more than one neighbour. A pair of points meets in one cell only, so nothing has
to be made distinct afterwards. Where lines or vertices lie on several sheets of land with
coordinates of their own, ``sheet`` says a key's sheet, and only what is on one sheet meets. Crowded cells are dealt out to several tasks. Longitudes don't wrap; latitudes stay below 89 degrees.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymesh.functions import geo
from waymesh.plans.durable import checkpointed

#: Rows of a cell from which on it is dealt out, and crowded cells that are broadcast at most.
CROWDED, BROADCAST_CELLS = 4096, 100_000

#: The sheet of a key.
Sheet = Callable[[Column], Column] | None


def _sheet(sheet: Sheet, key: str) -> Column:
    return F.lit(0).cast("long") if sheet is None else sheet(F.col(key))


def _band(y: Column, size: float) -> Column:
    return F.floor(y / size)


def _width(band: Column, size: float) -> Column:
    """Column width in degrees, enough for the metres of ``size`` anywhere in the band."""
    edge = F.greatest(F.abs(band), F.abs(band + 1)) * size
    return F.lit(size) / F.greatest(F.cos(F.radians(edge)), F.lit(0.01))


def cell_size(metres: float) -> float:
    return metres / geo.METRES_PER_DEGREE * 1.01


def in_cells(df: DataFrame, x: Column, y: Column, metres: float, around: bool) -> DataFrame:
    """``df`` with _band and _column: a point's own cell, or with ``around`` the nine around it."""
    size = cell_size(metres)
    if around:
        df = df.withColumn("_band", F.explode(F.array(*[_band(y, size) + d for d in (-1, 0, 1)])))
        return df.withColumn("_column", F.explode(F.array(*[F.floor(x / _width(F.col("_band"), size)) + d for d in (-1, 0, 1)])))
    return df.withColumn("_band", _band(y, size)).withColumn("_column", F.floor(x / _width(F.col("_band"), size)))


def _once(value: Column) -> Column:
    """``value`` as a column that the optimizer doesn't write out again where it is used."""
    return F.explode(F.array(value))


def cell_join(left: DataFrame, right: DataFrame, cells: list[str]) -> DataFrame:
    """Inner join on ``cells``. A cell with over ``CROWDED`` rows of ``right`` is dealt out: each of
    its left rows goes to one of several tasks and its right rows to all of them. Neither side is
    broadcast: both come out of an explode, of which the optimizer knows no size."""
    counts = right.groupBy(*cells).count().where(F.col("count") > CROWDED)
    crowded = checkpointed(counts.select(*cells, F.ceil(F.col("count") / CROWDED).cast("int").alias("_ways")))
    n = crowded.count()
    if not n:
        return left.hint("merge").join(right.hint("merge"), cells)
    crowded = F.broadcast(crowded) if n <= BROADCAST_CELLS else crowded
    one = left.join(crowded, cells, "left").withColumn("_way", F.pmod(F.xxhash64(*left.columns), F.coalesce("_ways", F.lit(1))).cast("int")).drop("_ways")
    two = right.join(crowded, cells, "left").withColumn("_way", F.explode(F.sequence(F.lit(0), F.coalesce("_ways", F.lit(1)) - 1))).drop("_ways")
    return one.hint("merge").join(two.hint("merge"), [*cells, "_way"]).drop("_way")


def within_distance(left: DataFrame, right: DataFrame, metres: float, lx: str = "x", ly: str = "y", rx: str = "x2", ry: str = "y2", sheets: tuple[Column, Column] | None = None) -> DataFrame:
    """All pairs of points at most ``metres`` apart, with ``metres`` as a column. The smaller
    side should be ``left``: it is listed under nine cells. ``sheets``: the sheets of both."""
    on = sheets or (F.lit(0), F.lit(0))
    a = in_cells(left.withColumn("_sheet", on[0].cast("long")), F.col(lx), F.col(ly), metres, True)
    b = in_cells(right.withColumn("_sheet", on[1].cast("long")), F.col(rx), F.col(ry), metres, False)
    far = geo.haversine(F.col(lx), F.col(ly), F.col(rx), F.col(ry))
    return cell_join(a, b, ["_sheet", "_band", "_column"]).where(F.abs(F.col(ry) - F.col(ly)) <= cell_size(metres)).withColumn("metres", _once(far)).where(F.col("metres") <= metres).drop("_sheet", "_band", "_column")


def nearest(left: DataFrame, right: DataFrame, metres: float, left_id: str, right_id: str, k: int = 1, **xy: str) -> DataFrame:
    """The ``k`` nearest of ``right`` for each of ``left`` within ``metres``, with their rank;
    ties by id."""
    pairs = within_distance(left, right, metres, **xy)
    order = Window.partitionBy(left_id).orderBy("metres", right_id)
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def endpoints(lines: DataFrame, key: str = "trail_id", line: str = "coords") -> DataFrame:
    """(key, end, x, y, z): 'start' and 'end' rows of each line."""
    ends = F.array(F.struct(F.lit("start").alias("end"), geo.start_point(line).alias("p")), F.struct(F.lit("end").alias("end"), geo.end_point(line).alias("p")))
    return lines.select(key, F.explode(ends).alias("e")).select(key, "e.end", "e.p.x", "e.p.y", "e.p.z")


def segment_rows(lines: DataFrame, key: str = "trail_id", line: str = "coords") -> DataFrame:
    """(key, seg, a, b): the segments of each line, numbered from 0, without points twice."""
    return lines.select(key, F.posexplode(geo.segments(line)).alias("seg", "s")).select(key, "seg", F.col("s.a").alias("a"), F.col("s.b").alias("b")).where(~geo.same_place(F.col("a"), F.col("b")))


def covering(segments: DataFrame, size: float, margin: float = 0.0) -> DataFrame:
    """``segments`` with gx, gy: each cell that the segment's box, widened by ``margin`` degrees, meets."""
    low = lambda c: F.floor((F.least(F.col(f"a.{c}"), F.col(f"b.{c}")) - margin) / size)
    high = lambda c: F.floor((F.greatest(F.col(f"a.{c}"), F.col(f"b.{c}")) + margin) / size)
    return segments.withColumn("gx", F.explode(F.sequence(low("x"), high("x")))).withColumn("gy", F.explode(F.sequence(low("y"), high("y"))))


def crossings(lines: DataFrame, key: str = "trail_id", line: str = "coords", size: float = 0.02, sheet: Sheet = None) -> DataFrame:
    """(id1, id2, seg1, seg2, x, y, z, ratio, ratio2): points inside segments of two different
    lines, with their places on both segments. A crossing is taken in the cell that holds
    it, so each is found once.

    Segments travel as plain numbers. What the join compares is short, boxes only, and each later
    step is computed once: all in one condition, with the ratios written out in it, is a method that
    the JVM does not compile."""
    s = covering(segment_rows(lines, key, line), size).withColumn("_sheet", _sheet(sheet, key))

    def side(n: int) -> DataFrame:
        flat = [F.col(f"{p}.{c}").alias(f"{p}{c}{n}") for p in "ab" for c in "xyz"]
        return s.select(F.col(key).alias(f"id{n}"), F.col("seg").alias(f"seg{n}"), *flat, "_sheet", "gx", "gy")

    c = F.col
    apart = lambda v: (F.greatest(f"a{v}1", f"b{v}1") < F.least(f"a{v}2", f"b{v}2")) | (F.greatest(f"a{v}2", f"b{v}2") < F.least(f"a{v}1", f"b{v}1"))
    turn = lambda n, p, m: (c(f"bx{n}") - c(f"ax{n}")) * (c(f"{p}y{m}") - c(f"ay{n}")) - (c(f"by{n}") - c(f"ay{n}")) * (c(f"{p}x{m}") - c(f"ax{n}"))
    met = cell_join(side(1), side(2), ["_sheet", "gx", "gy"]).where("id1 < id2").where(~apart("x") & ~apart("y"))
    # on which side of the other segment its ends lie
    met = met.withColumn("_c", _once(F.struct(turn(2, "a", 1).alias("a1"), turn(2, "b", 1).alias("b1"), turn(1, "a", 2).alias("a2"), turn(1, "b", 2).alias("b2"))))
    met = met.where((c("_c.a1") * c("_c.b1") < 0) & (c("_c.a2") * c("_c.b2") < 0))
    met = met.withColumn("ratio", _once(F.try_divide(c("_c.a1"), c("_c.a1") - c("_c.b1"))))
    at = lambda v: c(f"a{v}1") + c("ratio") * (c(f"b{v}1") - c(f"a{v}1"))
    met = met.select("id1", "id2", "seg1", "seg2", at("x").alias("x"), at("y").alias("y"), at("z").alias("z"), "ratio", F.try_divide(c("_c.a2"), c("_c.a2") - c("_c.b2")).alias("ratio2"), "gx", "gy")
    return met.where((F.floor(c("x") / size) == c("gx")) & (F.floor(c("y") / size) == c("gy"))).drop("gx", "gy")


def points_on_lines(points: DataFrame, lines: DataFrame, metres: float, visitor: list[str], key: str = "trail_id", line: str = "coords", size: float = 0.02, sheets: tuple[Sheet, Sheet] = (None, None)) -> DataFrame:
    """(visitor columns, visited, metres, seg, t, x, y, z): for each of ``points`` (visitor
    columns, x, y, z) and each line within ``metres``, the nearest point of that line. ``sheets``: of the first visitor column, and of ``key``."""
    margin = metres / geo.METRES_PER_DEGREE * 2.5  # enough for longitudes up to 66 degrees north
    s = covering(segment_rows(lines, key, line), size, margin).select(F.col(key).alias("visited"), "seg", "a", "b", _sheet(sheets[1], key).alias("_sheet"), "gx", "gy")
    e = points.select(*visitor, geo.point(F.col("x"), F.col("y"), F.col("z")).alias("p"), _sheet(sheets[0], visitor[0]).alias("_sheet"), F.floor(F.col("x") / size).alias("gx"), F.floor(F.col("y") / size).alias("gy"))
    # the segment's box first; then each step once: a filter on plain columns would be pushed below them and repeat them all
    off = lambda c: F.greatest(F.least(F.col(f"a.{c}"), F.col(f"b.{c}")) - F.col(f"p.{c}"), F.col(f"p.{c}") - F.greatest(F.col(f"a.{c}"), F.col(f"b.{c}")))
    met = cell_join(e, s, ["_sheet", "gx", "gy"]).where((off("y") <= cell_size(metres)) & (off("x") <= margin))
    met = met.withColumn("t", _once(geo.nearest_ratio(F.col("p"), F.col("a"), F.col("b")))).withColumn("q", _once(geo.between(F.col("a"), F.col("b"), F.col("t"))))
    met = met.withColumn("metres", _once(geo.distance(F.col("p"), F.col("q")))).where(F.col("metres") <= metres)
    # a line that comes by one place twice is met where it comes first, whatever the elevations
    best = met.groupBy(*visitor, "visited").agg(F.min(F.struct("metres", F.col("q.x").alias("x"), F.col("q.y").alias("y"), "seg", "t", F.col("q.z").alias("z"))).alias("m"))
    return best.select(*visitor, "visited", "m.*")


def ends_on_lines(lines: DataFrame, metres: float, key: str = "trail_id", line: str = "coords", size: float = 0.02, sheet: Sheet = None) -> DataFrame:
    """(visitor, end, visited, metres, seg, t, x, y, z): for each end and each other line within
    ``metres``, the nearest point of that line."""
    ends = endpoints(lines, key, line).withColumnRenamed(key, "visitor")
    return points_on_lines(ends, lines, metres, ["visitor", "end"], key, line, size, (sheet, sheet)).where("visitor <> visited")
