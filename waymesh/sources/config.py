"""Settings of a run: thresholds, tolerances and patterns, from JSON or YAML text."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Pattern:
    name: str
    target_km: float
    target_gain: float
    shape: str = "any"
    tolerance: float = 20.0


@dataclass(frozen=True)
class Settings:
    intersection_tolerance_m: float = 3.0
    snap_tolerance_m: float = 10.0
    min_segment_m: float = 1.0
    node_tolerance_degrees: float = 0.000045
    max_hops: int = 8
    ksp_k: int = 3
    split: bool = True
    patterns: tuple[Pattern, ...] = field(default_factory=lambda: (Pattern("short loop", 4.0, 100.0, "loop"), Pattern("day trip", 10.0, 400.0), Pattern("long ridge", 18.0, 700.0, "point-to-point", 30.0)))

    def pattern_rows(self, spark: SparkSession) -> DataFrame:
        rows = [(k + 1, p.name, float(p.target_km), float(p.target_gain), p.shape, float(p.tolerance)) for k, p in enumerate(self.patterns)]
        return spark.createDataFrame(rows, "pattern long, name string, target_km double, target_gain double, shape string, tolerance double")


def load(text: str) -> Settings:
    """Settings with what the text says in place of defaults. Unknown names and values of another
    kind are errors."""
    try:
        said = json.loads(text)
    except ValueError:
        import yaml

        said = yaml.safe_load(text)
    said = said or {}
    known = {f.name: getattr(Settings(), f.name) for f in fields(Settings)}
    for name, value in said.items():
        if name not in known:
            raise ValueError(f"unknown setting {name}")
        if name == "patterns":
            said[name] = tuple(Pattern(**p) for p in value)
        elif isinstance(known[name], bool) != isinstance(value, bool) or not isinstance(value, (int, float)):
            raise ValueError(f"{name} can't be {value!r}")
        else:
            said[name] = type(known[name])(value)
    return Settings(**said)
