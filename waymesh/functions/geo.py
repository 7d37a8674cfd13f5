"""Geometry of lines as Column expressions: a line is an array of (x, y, z) in degrees and
metres. Lengths are haversine metres. All run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M, METRES_PER_DEGREE = 6371008.8, 111320.0
POINT = "struct<x:double,y:double,z:double>"
LINE = f"array<{POINT}>"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def haversine(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Metres between two points; null where a coordinate is."""
    a = F.pow(F.sin(F.radians(y2 - y1) / 2), F.lit(2)) + F.cos(F.radians(y1)) * F.cos(F.radians(y2)) * F.pow(F.sin(F.radians(x2 - x1) / 2), F.lit(2))
    # not least(): it passes over nulls, and a missing point has no distance
    return 2 * EARTH_M * F.asin(F.when(a > 1, F.lit(1.0)).otherwise(F.sqrt(a)))


def distance(p: Column, q: Column) -> Column:
    return haversine(p["x"], p["y"], q["x"], q["y"])


def equirectangular(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Metres, flat approximation."""
    dx = (x2 - x1) * F.cos(F.radians((y1 + y2) / 2))
    return METRES_PER_DEGREE * F.sqrt(dx * dx + (y2 - y1) * (y2 - y1))


def point(x: Column | float, y: Column | float, z: Column | float = 0.0) -> Column:
    as_col = lambda v: v if isinstance(v, Column) else F.lit(float(v))
    return F.struct(as_col(x).alias("x"), as_col(y).alias("y"), as_col(z).alias("z"))


def num_points(line: Column | str) -> Column:
    return F.size(col(line))


def point_n(line: Column | str, n: int) -> Column:
    """1-based; negative from the end; null outside."""
    return F.try_element_at(col(line), F.lit(n))


def start_point(line: Column | str) -> Column:
    return point_n(line, 1)


def end_point(line: Column | str) -> Column:
    return point_n(line, -1)


def segments(line: Column | str) -> Column:
    """Array of (a, b), neighbouring points; empty for fewer than two points."""
    c = col(line)
    pairs = F.zip_with(F.slice(c, F.lit(1), F.greatest(F.size(c) - 1, F.lit(0))), F.slice(c, F.lit(2), F.greatest(F.size(c) - 1, F.lit(0))), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    return F.when(F.size(c) >= 2, pairs).otherwise(F.slice(pairs, 1, 0))


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + v)


def length_m(line: Column | str) -> Column:
    return total(F.transform(segments(line), lambda s: distance(s["a"], s["b"])))


def measures(line: Column | str) -> Column:
    """Metres from the start to each point."""
    steps = F.transform(segments(line), lambda s: distance(s["a"], s["b"]))
    return F.aggregate(steps, F.array(F.lit(0.0)), lambda a, v: F.array_append(a, F.element_at(a, -1) + v))


def bbox(line: Column | str) -> Column:
    """(min_lng, max_lng, min_lat, max_lat)."""
    xs, ys = F.transform(col(line), lambda p: p["x"]), F.transform(col(line), lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("min_lng"), F.array_max(xs).alias("max_lng"), F.array_min(ys).alias("min_lat"), F.array_max(ys).alias("max_lat"))


def boxes_meet(a: Column, b: Column) -> Column:
    return (a["min_lng"] <= b["max_lng"]) & (b["min_lng"] <= a["max_lng"]) & (a["min_lat"] <= b["max_lat"]) & (b["min_lat"] <= a["max_lat"])


def box_contains(a: Column, b: Column) -> Column:
    return (a["min_lng"] <= b["min_lng"]) & (b["max_lng"] <= a["max_lng"]) & (a["min_lat"] <= b["min_lat"]) & (b["max_lat"] <= a["max_lat"])


def envelope(min_x: float, min_y: float, max_x: float, max_y: float) -> Column:
    return F.struct(F.lit(min_x).alias("min_lng"), F.lit(max_x).alias("max_lng"), F.lit(min_y).alias("min_lat"), F.lit(max_y).alias("max_lat"))


def centroid(line: Column | str) -> Column:
    """Mean of the points."""
    c = col(line)
    return point(total(F.transform(c, lambda p: p["x"])) / F.size(c), total(F.transform(c, lambda p: p["y"])) / F.size(c), total(F.transform(c, lambda p: p["z"])) / F.size(c))


def force2d(line: Column | str) -> Column:
    return F.transform(col(line), lambda p: point(p["x"], p["y"], 0.0))


def force3d(line: Column | str, z: float = 0.0) -> Column:
    return F.transform(col(line), lambda p: point(p["x"], p["y"], F.coalesce(p["z"], F.lit(z))))


def reverse(line: Column | str) -> Column:
    return F.reverse(col(line))


def snap_to_grid(line: Column | str, size: float) -> Column:
    return F.transform(col(line), lambda p: point(F.round(p["x"] / size) * size, F.round(p["y"] / size) * size, p["z"]))


def same_place(p: Column, q: Column) -> Column:
    return (p["x"] == q["x"]) & (p["y"] == q["y"])


def without_repeats(line: Column | str) -> Column:
    """Consecutive points at one place count once."""
    c = col(line)
    return F.filter(c, lambda p, i: (i == 0) | ~same_place(p, F.get(c, i - 1)))


def set_point(line: Column | str, index: int, p: Column) -> Column:
    """0-based; -1 is the last point."""
    c = col(line)
    at = F.size(c) + index if index < 0 else F.lit(index)
    return F.transform(c, lambda q, i: F.when(i == at, p).otherwise(q))


def add_point(line: Column | str, p: Column) -> Column:
    return F.array_append(col(line), p)


def is_closed(line: Column | str) -> Column:
    return same_place(start_point(line), end_point(line))


def is_finite(v: Column) -> Column:
    return v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))


def is_valid(line: Column | str) -> Column:
    """Two different points at least, all finite."""
    c = col(line)
    return F.coalesce(F.forall(c, lambda p: is_finite(p["x"]) & is_finite(p["y"])) & F.exists(c, lambda p: ~same_place(p, F.get(c, F.lit(0)))), F.lit(False))


def cross(o: Column, a: Column, b: Column) -> Column:
    return (a["x"] - o["x"]) * (b["y"] - o["y"]) - (a["y"] - o["y"]) * (b["x"] - o["x"])


def proper_crossing(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Segments ab and cd cross in a point inside both."""
    return (cross(a, b, c) * cross(a, b, d) < 0) & (cross(c, d, a) * cross(c, d, b) < 0)


def crossing_ratio(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Where on ab, from 0 to 1, the lines ab and cd meet."""
    return F.try_divide(cross(c, d, a), cross(c, d, a) - cross(c, d, b))


def between(a: Column, b: Column, t: Column) -> Column:
    return point(a["x"] + t * (b["x"] - a["x"]), a["y"] + t * (b["y"] - a["y"]), a["z"] + t * (b["z"] - a["z"]))


def is_simple(line: Column | str) -> Column:
    """No two segments of the line cross inside both."""
    s = segments(line)
    return ~F.exists(F.transform(s, lambda p, i: F.exists(F.slice(s, i + 3, F.size(s)), lambda q: proper_crossing(p["a"], p["b"], q["a"], q["b"]))), lambda x: x)


def nearest_ratio(p: Column, a: Column, b: Column) -> Column:
    """Ratio on segment ab of the point nearest to p, on the local plane."""
    k = F.cos(F.radians(p["y"]))
    dx, dy = (b["x"] - a["x"]) * k, b["y"] - a["y"]
    squared = dx * dx + dy * dy
    t = F.try_divide((p["x"] - a["x"]) * k * dx + (p["y"] - a["y"]) * dy, squared)
    return F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(1.0), t)), F.lit(0.0))


def closest(line: Column | str, p: Column) -> Column:
    """(distance, at, point): metres to the nearest point of the line, metres from the
    start to it, and the point. The earliest wins ties."""
    m = measures(line)

    def one(s: Column, i: Column) -> Column:
        t = nearest_ratio(p, s["a"], s["b"])
        q = between(s["a"], s["b"], t)
        return F.struct(distance(p, q).alias("distance"), (F.get(m, i) + t * (F.get(m, i + 1) - F.get(m, i))).alias("at"), q.alias("point"))

    return F.array_min(F.transform(segments(line), one))


def distance_to_line(line: Column | str, p: Column) -> Column:
    return F.array_min(F.transform(segments(line), lambda s: distance(p, between(s["a"], s["b"], nearest_ratio(p, s["a"], s["b"])))))


def locate(line: Column | str, p: Column) -> Column:
    """Share of the line's length at the point nearest to p."""
    return closest(line, p)["at"] / F.nullif(length_m(line), F.lit(0.0))


def interpolate(line: Column | str, ratio: Column) -> Column:
    """The point at a share of the line's length."""
    m, c = measures(line), col(line)
    at = ratio * F.element_at(m, -1)
    k = F.greatest(F.lit(1), F.least(F.size(F.filter(m, lambda v: v <= at)), F.size(c) - 1))
    a, b = F.get(m, k - 1), F.get(m, k)
    return between(F.get(c, k - 1), F.get(c, k), F.when(b > a, (at - a) / (b - a)).otherwise(0.0))


def substring(line: Column | str, start: Column, stop: Column) -> Column:
    """The part between two shares of the length, with the ends interpolated."""
    m, c = measures(line), col(line)
    whole = F.element_at(m, -1)
    inside = F.filter(F.transform(c, lambda p, i: F.struct(F.get(m, i).alias("m"), p.alias("p"))), lambda v: (v["m"] > start * whole) & (v["m"] < stop * whole))
    return F.concat(F.array(interpolate(line, start)), F.transform(inside, lambda v: v["p"]), F.array(interpolate(line, stop)))


def split_at(line: Column | str, ratios: Column) -> Column:
    """All parts of a line cut at the given shares, in order."""
    cuts = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0.0), F.lit(1.0)), F.filter(ratios, lambda r: (r > 0) & (r < 1)))))
    return F.transform(F.slice(cuts, F.lit(1), F.size(cuts) - 1), lambda r, i: substring(line, r, F.get(cuts, i + 1)))


def elevation(line: Column | str, least: float = -1000.0, most: float = 10000.0) -> Column:
    """(gain, loss, min_z, max_z, avg_z) over points with a possible elevation."""
    z = F.filter(F.transform(col(line), lambda p: p["z"]), lambda v: v.isNotNull() & (v >= least) & (v <= most))
    steps = F.zip_with(F.slice(z, F.lit(2), F.size(z)), F.slice(z, F.lit(1), F.greatest(F.size(z) - 1, F.lit(0))), lambda b, a: b - a)
    return F.struct(
        total(F.transform(steps, lambda d: F.greatest(d, F.lit(0.0)))).alias("gain"), total(F.transform(steps, lambda d: F.greatest(-d, F.lit(0.0)))).alias("loss"),
        F.array_min(z).alias("min_z"), F.array_max(z).alias("max_z"), (total(z) / F.nullif(F.size(z), F.lit(0))).alias("avg_z"),
    )


def azimuth(p: Column, q: Column) -> Column:
    """Degrees clockwise from north on the local plane."""
    k = F.cos(F.radians((p["y"] + q["y"]) / 2))
    return F.pmod(F.degrees(F.atan2((q["x"] - p["x"]) * k, q["y"] - p["y"])) + 360.0, F.lit(360.0))


def area_m2(ring: Column | str) -> Column:
    """Area of the polygon with these corners, closed or not, on the plane around the first."""
    c = col(ring)
    k = F.cos(F.radians(F.get(c, F.lit(0))["y"])) * METRES_PER_DEGREE * METRES_PER_DEGREE
    origin = F.get(c, F.lit(0))
    turn = lambda p, i: (p["x"] - origin["x"]) * (F.get(c, (i + 1) % F.size(c))["y"] - origin["y"]) - (F.get(c, (i + 1) % F.size(c))["x"] - origin["x"]) * (p["y"] - origin["y"])
    return F.abs(total(F.transform(c, turn))) / 2 * k


def outside_box(line: Column | str, box: Column) -> Column:
    """The points of a line that a box (an ``envelope``) doesn't hold."""
    return F.filter(col(line), lambda p: (p["x"] < box["min_lng"]) | (p["x"] > box["max_lng"]) | (p["y"] < box["min_lat"]) | (p["y"] > box["max_lat"]))


def central_quarter(box: Column) -> Column:
    """The box of a quarter of the width and height around the middle; null for a box that is empty
    or turned over."""
    w, h = box["max_lng"] - box["min_lng"], box["max_lat"] - box["min_lat"]
    made = F.struct((box["min_lng"] + w * 0.375).alias("min_lng"), (box["min_lng"] + w * 0.625).alias("max_lng"), (box["min_lat"] + h * 0.375).alias("min_lat"), (box["min_lat"] + h * 0.625).alias("max_lat"))
    return F.when((w > 0) & (h > 0), made)


def translate(line: Column | str, dx: float, dy: float) -> Column:
    return F.transform(col(line), lambda p: point(p["x"] + dx, p["y"] + dy, p["z"]))


def web_mercator(p: Column) -> Column:
    half = 20037508.342789244
    return F.struct((p["x"] * half / 180).alias("x"), (F.log(F.tan(F.radians(45.0 + p["y"] / 2))) / F.pi() * half).alias("y"))


def within(line: Column | str, other: Column | str, metres: float) -> Column:
    """Every point of ``line`` lies within ``metres`` of ``other``."""
    return F.forall(col(line), lambda p: distance_to_line(other, p) <= metres)


def merge_ends(a: Column | str, b: Column | str) -> Column:
    """Two lines that share an end as one line; null if they share none."""
    a, b = col(a), col(b)
    rest = lambda line: F.slice(line, F.lit(2), F.size(line))
    return (
        F.when(same_place(end_point(a), start_point(b)), F.concat(a, rest(b)))
        .when(same_place(end_point(a), end_point(b)), F.concat(a, rest(F.reverse(b))))
        .when(same_place(start_point(a), end_point(b)), F.concat(b, rest(a)))
        .when(same_place(start_point(a), start_point(b)), F.concat(F.reverse(b), rest(a)))
    )


def as_wkt(line: Column | str) -> Column:
    return F.concat(F.lit("LINESTRING Z ("), F.array_join(F.transform(col(line), lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"), p["z"].cast("string"))), ", "), F.lit(")"))


def from_wkt(text: Column | str) -> Column:
    """LINESTRING or LINESTRING Z (an SRID prefix is passed over) to an array of points."""
    body = F.regexp_extract(col(text), r"LINESTRING\s*Z?\s*\(([^)]*)\)", 1)

    def one(part: Column) -> Column:
        n = F.split(F.trim(part), r"\s+")
        return point(F.get(n, F.lit(0)).cast("double"), F.get(n, F.lit(1)).cast("double"), F.coalesce(F.get(n, F.lit(2)).cast("double"), F.lit(0.0)))

    return F.when(body != "", F.transform(F.split(body, ","), one))


def as_geojson(line: Column | str) -> Column:
    return F.to_json(F.struct(F.lit("LineString").alias("type"), F.transform(col(line), lambda p: F.array(p["x"], p["y"], p["z"])).alias("coordinates")))


def from_geojson(text: Column | str) -> Column:
    read = F.from_json(col(text), "type string, coordinates array<array<double>>")
    return F.when(read["type"] == "LineString", F.transform(read["coordinates"], lambda c: point(F.get(c, F.lit(0)), F.get(c, F.lit(1)), F.coalesce(F.get(c, F.lit(2)), F.lit(0.0)))))
