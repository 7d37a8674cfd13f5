"""Scores, costs, tolerances, names and classes of routes as Column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lit(v: Column | float) -> Column:
    return v if isinstance(v, Column) else F.lit(float(v))


def edge_cost(gain: Column, km: Column, steep_weight: float, km_weight: float) -> Column:
    return F.when(km > 0, gain / km * steep_weight).otherwise(0.0) + km * km_weight


def in_band(value: Column, target: Column | float, percent: Column | float) -> Column:
    t, p = lit(target), lit(percent)
    return value.between(t * (1 - p / 100), t * (1 + p / 100))


def top(df: DataFrame, by: str, tie: str, n: int, descending: bool) -> DataFrame:
    return df.orderBy(F.desc(by) if descending else F.asc(by), tie).limit(n)


# ---- similarity to a target: four forms

def closeness(actual: Column, target: Column | float) -> Column:
    """1 at the target, 0 where it is missed by the target or more; 1 if nothing is asked for."""
    t = lit(target)
    return F.when(t == 0, 1.0).otherwise(F.greatest(F.lit(0.0), 1 - F.abs(actual - t) / t))


def similarity_distance(km: Column, target_km: Column | float) -> Column:
    return closeness(km, target_km)


def similarity_weighted(km: Column, target_km: Column | float, gain: Column, target_gain: Column | float, w_km: float = 0.5, w_gain: float = 0.3) -> Column:
    return (closeness(km, target_km) * w_km + closeness(gain, target_gain) * w_gain) / (w_km + w_gain)


def similarity_deviation(km: Column, target_km: Column | float, gain: Column, target_gain: Column | float) -> Column:
    miss = lambda a, t: F.abs(a - lit(t)) / F.nullif(lit(t), F.lit(0.0))
    return F.greatest(F.lit(0.0), 1 - (F.coalesce(miss(km, target_km), F.lit(0.0)) + F.coalesce(miss(gain, target_gain), F.lit(0.0))) / 2)


def similarity_mean(km: Column, target_km: Column | float, gain: Column, target_gain: Column | float) -> Column:
    return (closeness(km, target_km) + closeness(gain, target_gain)) / 2


# ---- cost modes

#: Weight of steepness, weight of distance, order.
MODES = {"standard": (2.0, 0.5, "asc"), "mostCost": (2.0, 0.5, "desc"), "elevationFocused": (5.0, 0.1, "desc"), "distanceFocused": (0.5, 2.0, "asc"), "balanced": (1.0, 1.0, "asc")}


def route_cost(gain: Column, km: Column, mode: str = "standard") -> Column:
    steep, far, _ = MODES[mode]
    return F.when(km > 0, gain / km).otherwise(0.0) * steep + km * far


def cost_ranked(routes: DataFrame, mode: str, n: int, tie: str, km: str = "total_km", gain: str = "total_gain", max_cost: float | None = None) -> DataFrame:
    made = routes.withColumn("cost", route_cost(F.col(gain), F.col(km), mode))
    if max_cost is not None:
        made = made.where(F.col("cost") <= max_cost)
    return top(made, "cost", tie, n, MODES[mode][2] == "desc")


# ---- preference cost

#: Fixed values: (low, high, cost) for metres of gain per kilometre and for kilometres.
GAIN_BANDS = ((0, 50, 0.2), (50, 100, 0.0), (100, 150, 0.1), (150, 200, 0.3), (200, 1e9, 0.5))
KM_BANDS = ((0, 2, 0.4), (2, 5, 0.2), (5, 15, 0.0), (15, 25, 0.1), (25, 1e9, 0.3))
#: Cost by shape, and of any other.
SHAPE_COST, OTHER_SHAPE_COST = {"loop": 0.0, "out-and-back": 0.1, "point-to-point": 0.3}, 0.5


def banded(value: Column, bands: tuple) -> Column:
    made = F.when(value.isNull() | (value < bands[0][0]), 0.5)
    for low, high, cost in bands:
        made = made.when((value >= low) & (value < high), cost)
    return made.otherwise(0.5).cast("double")


def deviation_cost(actual: Column, target: Column | float, weight: float, power: float) -> Column:
    t = lit(target)
    return F.pow(F.when(t > 0, F.abs(actual - t) / t).otherwise(0.0) * weight, F.lit(power))


def preference_cost(km: Column, gain: Column, shape: Column, target_km: Column | float, target_gain: Column | float, weights: tuple[float, float, float] = (0.35, 0.25, 0.4)) -> Column:
    """Weighted cost of gain rate, distance and shape, times 100: of the first two, 0.7 of the
    deviation and 0.3 of the band."""
    rate_of = lambda g, k: F.when(k > 0, g / k).otherwise(0.0)
    rate, target_rate = rate_of(gain, km), rate_of(lit(target_gain), lit(target_km))
    rate_cost = 0.7 * deviation_cost(rate, target_rate, 3.0, 1.5) + 0.3 * banded(rate, GAIN_BANDS)
    km_cost = 0.7 * deviation_cost(km, target_km, 2.0, 1.2) + 0.3 * banded(km, KM_BANDS)
    shape_cost = F.coalesce(F.create_map(*[F.lit(x) for pair in SHAPE_COST.items() for x in pair])[shape], F.lit(OTHER_SHAPE_COST))
    return (weights[0] * rate_cost + weights[1] * km_cost + weights[2] * shape_cost) * 100


# ---- composite score

def route_score(km: Column, gain: Column, n_trails: Column, target_km: Column | float, target_gain: Column | float, quality: Column | float) -> Column:
    """0 to 100, rounded."""
    tk, tg = lit(target_km), lit(target_gain)
    dk, dg = F.abs(km - tk), F.abs(gain - tg)
    base = lit(quality) * 100 + 15 * F.greatest(F.lit(0.0), 1 - dk / tk) + 15 * F.greatest(F.lit(0.0), 1 - dg / F.greatest(tg, F.lit(1.0)))
    base += F.least(n_trails / 2.0, F.lit(1.0)) * 15 + F.when(n_trails >= 3, 5.0).otherwise(0.0)
    base += F.greatest(F.lit(0.0), 15 - dk) + F.greatest(F.lit(0.0), 10 - dg / F.greatest(tg / 10, F.lit(1.0)))
    base += F.when(km >= 20, 15.0).when(km >= 15, 12.0).when(km >= 10, 8.0).when(km >= 5, 3.0).otherwise(0.0)
    base += F.when(gain >= 800, 8.0).when(gain >= 500, 5.0).when(gain >= 200, 2.0).otherwise(0.0)
    base -= F.when(km < 2, 10.0).when(km < 3, 5.0).otherwise(0.0)
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), F.round(base)))


@dataclass(frozen=True)
class Tolerance:
    name: str
    distance: float  # per cent
    elevation: float
    quality: float


TOLERANCES = (Tolerance("strict", 20, 20, 1.0), Tolerance("medium", 50, 50, 0.8), Tolerance("wide", 100, 100, 0.5))
#: A target of so many kilometres widens each tolerance by so much.
LONG_KM, LONG_FACTOR = 15.0, 1.5


def tolerance_rows(patterns: DataFrame, levels: tuple[Tolerance, ...] = TOLERANCES) -> DataFrame:
    """Each pattern (target_km, ...) with each level: level, quality, distance_pct, elevation_pct."""
    each = F.array(*[F.struct(F.lit(t.name).alias("level"), F.lit(t.quality).alias("quality"), F.lit(float(t.distance)).alias("d"), F.lit(float(t.elevation)).alias("e")) for t in levels])
    wider = F.when(F.col("target_km") >= LONG_KM, LONG_FACTOR).otherwise(1.0)
    return patterns.withColumn("t", F.explode(each)).select(*patterns.columns, "t.level", "t.quality", (F.col("t.d") * wider).alias("distance_pct"), (F.col("t.e") * wider).alias("elevation_pct"))


# ---- classes, names, times

def difficulty(rate: Column) -> Column:
    """By metres of gain per kilometre."""
    return F.when(rate.isNull(), None).when(rate < 50, "easy").when(rate < 100, "moderate").when(rate < 150, "hard").otherwise("expert")


def hours_by_factor(km: Column, rate: Column) -> Column:
    """4 km/h, slower where it is steep, between half an hour and a day; null without distance."""
    factor = F.when(rate.isNull() | (rate < 50), 1.0).when(rate < 100, 0.8).when(rate < 150, 0.6).otherwise(0.4)
    return F.when(km > 0, F.greatest(F.lit(0.5), F.least(F.lit(24.0), km / (factor * 4.0))))


def hours_by_speed(km: Column, rate: Column) -> Column:
    return km / F.when(rate < 50, 4.0).when(rate < 100, 3.0).when(rate < 150, 2.5).otherwise(2.0)


def connectivity(n_trails: Column, km: Column) -> Column:
    """Trails per kilometre, five being full marks; null without distance."""
    return F.when(km > 0, F.least(F.lit(1.0), n_trails / km / 5))


def shape_of(path: Column, edge_ids: Column) -> Column:
    """loop: back at the start, no edge twice; out-and-back: back at the start; else point-to-point."""
    back = F.element_at(path, 1) == F.element_at(path, -1)
    repeats = F.size(edge_ids) - F.size(F.array_distinct(edge_ids))
    return F.when(back & (F.size(edge_ids) >= 3) & (repeats == 0), "loop").when(back, "out-and-back").otherwise("point-to-point")


def shape_confidence(path: Column, edge_ids: Column) -> Column:
    repeats = (F.size(edge_ids) - F.size(F.array_distinct(edge_ids))) / F.greatest(F.size(edge_ids), F.lit(1))
    return F.when(F.element_at(path, 1) == F.element_at(path, -1), F.greatest(repeats, 1 - repeats)).otherwise(1 - repeats / 2)


def route_name(trail_names: Column, shape: Column) -> Column:
    """The only trail's name; else the first and last name in order, joined by a stroke, and
    "Route". The shape follows unless the name has it already."""
    n = F.array_sort(F.array_distinct(trail_names))
    made = F.when(F.size(n) == 1, F.get(n, F.lit(0))).when(F.size(n) >= 2, F.concat(F.element_at(n, 1), F.lit("/"), F.element_at(n, -1), F.lit(" Route")))
    return F.when(F.contains(made, shape), made).otherwise(F.concat(made, F.lit(" "), shape))
