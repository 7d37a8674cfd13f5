"""Operators without SQL of their own, on small networks and lines, against plain Python."""

import itertools
import json
import math

import pytest
from pyspark.sql import functions as F

from waymesh.functions import geo
from waymesh.operators import components, graph, lines, repair, routes, spatial
from waymesh.plans import hot
from waymesh.plans.durable import prune, tables_of_runs, written
from waymesh.sources import config, exports, readers, shapefile, sqlite

EDGE = "id long, source long, target long, length_km double, elevation_gain double, elevation_loss double, trail_id long, trail_name string"


def network(spark, rows):
    return spark.createDataFrame([(i, s, t, float(km), 1.0, 1.0, i, f"t{i}") for i, s, t, km in rows], EDGE)


def line_rows(spark, rows):
    return spark.createDataFrame([(k, [(float(x), float(y), float(z[0]) if z else 0.0) for x, y, *z in c]) for k, c in rows], "trail_id long, coords array<struct<x:double,y:double,z:double>>")


def test_common_keys_join_like_others(spark, monkeypatch):
    monkeypatch.setattr(hot, "LEAST_ROWS", 5)
    rows = spark.createDataFrame([(0 if i % 3 else i, i) for i in range(300)], "k long, v long")
    unique = rows.groupBy("k").agg(F.count("*").alias("uses"), F.max("v").alias("most")).where("k <> 3")
    want = sorted((r["k"], r["v"], r["most"]) for r in rows.join(unique.drop("uses"), "k").collect())
    assert sorted((r["k"], r["v"], r["most"]) for r in hot.unique_join(rows, unique, "k", "uses").collect()) == want
    left = sorted(((r["k"], r["v"], r["most"]) for r in hot.counted_left_join(rows, unique.drop("uses"), "k").collect()), key=str)
    assert left == sorted(((r["k"], r["v"], r["most"]) for r in rows.join(unique.drop("uses"), "k", "left").collect()), key=str)


def test_components_around_a_hub(spark, monkeypatch):
    monkeypatch.setattr(components, "MANY_EDGES", 10)
    monkeypatch.setattr(hot, "LEAST_ROWS", 5)
    ways = [(500, k) for k in range(1, 400) if k % 7] + [(k, k + 1) for k in range(600, 640)] + [(7, 14), (14, 700)]
    got = {r["node"]: r["component"] for r in components.connected_components(spark.createDataFrame(ways, "source long, target long")).collect()}
    assert {got[k] for k in range(1, 400) if k % 7} == {1} == {got[500]}
    assert {got[k] for k in range(600, 641)} == {600} and {got[k] for k in (7, 14, 700)} == {7}


def test_a_crowded_cell_is_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(spatial, "CROWDED", 20)
    points = spark.range(150).select(F.col("id"), (F.col("id") % 13 * 1e-5).alias("x"), (F.col("id") % 11 * 1e-5).alias("y"))
    a, b = points.withColumnRenamed("id", "i"), points.select(F.col("id").alias("j"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    got = spatial.within_distance(a, b, 5.0)
    rows = [(r["i"], r["x"], r["y"]) for r in a.collect()]
    near = lambda p, q: 2 * geo.EARTH_M * math.asin(math.sqrt(math.sin(math.radians(q[2] - p[2]) / 2) ** 2 + math.cos(math.radians(p[2])) * math.cos(math.radians(q[2])) * math.sin(math.radians(q[1] - p[1]) / 2) ** 2)) <= 5.0
    assert sorted((r["i"], r["j"]) for r in got.collect()) == sorted((p[0], q[0]) for p in rows for q in rows if near(p, q))


def test_optimised_network_keeps_what_can_be_reached(spark):
    made, rounds = repair.optimised(network(spark, [(1, 1, 2, 1), (2, 2, 3, 1), (3, 3, 4, 1), (4, 4, 5, 1), (5, 4, 6, 2), (6, 5, 6, 9), (7, 5, 6, 1), (8, 9, 9, 1)]))
    rows = sorted((min(r["source"], r["target"]), max(r["source"], r["target"]), r["length_km"]) for r in made.collect())
    # 4-5-6 becomes parallel to 4-6 and goes; what is left is one way
    assert rounds > 1 and rows == [(1, 6, 5.0)]


def test_loops_by_return_share_no_edge(spark):
    e = network(spark, [(1, 1, 2, 1), (2, 2, 3, 1), (3, 3, 4, 1), (4, 4, 1, 1), (5, 1, 3, 5), (6, 4, 8, 1)])
    pairs = spark.createDataFrame([(1, 3), (1, 8)], "start long, goal long")
    got = routes.loops_by_return(e, pairs).collect()
    assert [(r["start"], r["goal"], r["total_km"]) for r in got] == [(1, 3, 4.0)]  # 8 has one way only
    assert sorted(got[0]["edge_ids"]) == [1, 2, 3, 4] and got[0]["path"][0] == got[0]["path"][-1] == 1
    loops = routes.anchor_loops(e, 2, 4.0, 1.0, 10.0, 2).collect()
    assert loops and all(len(set(r["edge_ids"])) == len(r["edge_ids"]) and r["n_trails"] >= 2 for r in loops)


def test_lollipops_against_all_paths(spark):
    ways = [(1, 1, 2, 2), (2, 2, 3, 2), (3, 3, 1, 3), (4, 3, 4, 1), (5, 2, 4, 2)]
    got = routes.lollipops(network(spark, ways), 8.0, 1, 3).collect()
    by = {}
    for i, s, t, km in ways:
        by.setdefault(s, []).append((t, i, km))
        by.setdefault(t, []).append((s, i, km))

    def simple(at, goal, path, used, km):
        if at == goal:
            yield km, used
            return
        for to, i, d in by[at]:
            if to not in path:
                yield from simple(to, goal, [*path, to], [*used, i], km + d)

    for r in got:
        ranked = sorted(simple(r["anchor"], r["goal"], [r["anchor"]], [], 0))[:3]
        out = ranked[0]
        best = min((len(set(u) & set(out[1])), -km) for km, u in ranked[1:])
        assert (r["overlap"], round(r["total_km"], 9)) == (best[0], round(out[0] - best[1], 9))
    assert got


def test_routes_apart_are_what_a_list_gives(spark):
    rows = [(k, float(k * 7919 % 101), (k * 37 % 50) * 1e-3, (k * 53 % 40) * 1e-3) for k in range(120)]
    got = {r["route_id"] for r in repair.apart(spark.createDataFrame(rows, "route_id long, score double, x double, y double"), 400.0).collect()}
    taken = []
    for k, s, x, y in sorted(rows, key=lambda r: (-r[1], r[0])):
        if all(math.hypot((x - a) * 111195.08, (y - b) * 111195.08) > 400 for _, a, b in taken):
            taken.append((k, x, y))
    assert got == {k for k, *_ in taken}


def test_connections_make_one_component(spark):
    nodes = spark.createDataFrame([(k, k * 1e-3, 0.0, 0.0) for k in range(8)], "id long, lng double, lat double, elevation double")
    e = network(spark, [(1, 0, 1, 1), (2, 2, 3, 1), (3, 4, 5, 1), (4, 6, 7, 1)])
    joined = repair.with_connections(nodes, e, 500.0)
    assert joined.count() == 7 and graph.components(joined).select("component").distinct().count() == 1


def test_split_until_stable_cuts_what_an_end_touches(spark):
    t = line_rows(spark, [(1, [(0, 0), (0.01, 0)]), (2, [(0.004, 0.00002), (0.004, 0.005)]), (3, [(0.00402, 0.003), (0.008, 0.003)])])
    parts = lines.split_until_stable(t, 10.0).collect()
    assert sorted(r["root"] for r in parts) == [1, 1, 2, 2, 3]
    ends = [(round(p["coords"][0]["x"], 6), round(p["coords"][0]["y"], 6)) for p in parts if p["root"] == 2]
    assert (0.004, 0.0) in ends  # the end was moved onto line 1


def test_proximity_groups_meet_in_one_point(spark):
    t = line_rows(spark, [(1, [(0, 0), (0.001, 0)]), (2, [(0.00102, 0), (0.002, 0)]), (3, [(0.001, 0.00003), (0.001, 0.002)])])
    parts = lines.proximity_groups(t, 10.0).collect()
    ends = {r["parent"]: {(round(c["x"], 7), round(c["y"], 7)) for c in (r["coords"][0], r["coords"][-1])} for r in parts}
    assert len(ends[1] & ends[2] & ends[3]) == 1


def test_split_keeps_points_and_lengths(spark):
    t = line_rows(spark, [(1, [(0, 0, 5), (0.01, 0, 7), (0.01, 0, 7), (0.02, 0, 9)]), (2, [(0.005, -0.01), (0.005, 0.01), (0.015, 0.01), (0.015, -0.01)]), (3, []), (4, [(9, 9)])])
    parts = lines.split_everywhere(t)
    assert sorted(r["parent"] for r in parts.collect()) == [1, 1, 1, 2, 2, 2, 3, 4]
    assert all(r["ok"] for r in lines.split_check(t, parts).collect())
    one = sorted((r["part"], r["coords"]) for r in parts.where("parent = 1").collect())
    assert [c[0]["x"] for _, c in one] == pytest.approx([0, 0.005, 0.015]) and one[0][1][-1]["z"] == pytest.approx(6.0)
    ledger = {r["trail_id"]: r["change"] for r in lines.split_rows(t, parts.where("parent <> 4")).collect()}
    assert ledger == {1: "split", 2: "split", 3: "kept", 4: "deleted"}


def test_simplified_keeps_within_the_distance():
    points = [{"x": k * 1e-3, "y": math.sin(k / 3) * 1e-4, "z": 0.0} for k in range(60)]
    kept = lines.thinned(points, 5.0)
    assert kept[0] == points[0] and kept[-1] == points[-1] and 2 < len(kept) < 60
    for p in points:
        between = [(a, b) for a, b in itertools.pairwise(kept) if a["x"] <= p["x"] <= b["x"]]
        assert any(abs(p["y"] - (a["y"] + (b["y"] - a["y"]) * (p["x"] - a["x"]) / (b["x"] - a["x"]))) * geo.METRES_PER_DEGREE <= 5.01 for a, b in between)


def test_cleaning_steps_report(spark):
    t = line_rows(spark, [(1, [(0, 0), (0, 0), (0.01, 0)]), (2, [(1, 1), (1, 1)])])
    report = lines.cleaned(t, [("repeated", lines.without_repeated_points), ("valid", lines.valid_lines)])[1].collect()
    assert [(r["step"], r["lines_before"], r["lines_after"]) for r in report] == [("repeated", 2, 2), ("valid", 2, 1)]


def test_collection_is_one_json_text(spark, tmp_path):
    t = line_rows(spark, [(k, [(k, 1, 2), (k, 2, 3)]) for k in range(5)]).repartition(3)
    exports.write_collection(t.select(exports.feature(F.col("coords"), F.struct("trail_id")).alias("feature")), f"file://{tmp_path}/c")
    text = "".join(p.read_text() for p in tmp_path.glob("c/part-*"))
    assert len(json.loads(text)["features"]) == 5
    assert readers.read_geojson(spark, f"file://{tmp_path}/c").count() == 5


def test_sqlite_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sqlite, "RANGE", 7)
    df = spark.createDataFrame([(k, None if k == 3 else f"n'{k}", k / 2, [k]) for k in range(20)], "id long, name string, v double, a array<long>")
    path = str(tmp_path / "x.sqlite")
    assert sqlite.write_sqlite(df, path, "t") == 20
    read = sqlite.read_sqlite(spark, path, "t", "id long, name string, v double, a string")
    assert sorted((r["id"], r["name"], r["v"], r["a"]) for r in read.collect()) == [(k, None if k == 3 else f"n'{k}", k / 2, f"[{k}]") for k in range(20)]
    assert ("none:exists", "FAIL", 0) in sqlite.validate_sqlite(path, {"t": "id", "none": "id"})


def test_settings():
    made = config.load('{"ksp_k": 7, "snap_tolerance_m": 2}')
    assert made.ksp_k == 7 and made.snap_tolerance_m == 2.0 and len(made.patterns) == 3
    for bad in ('{"nothing": 1}', '{"ksp_k": "x"}', '{"split": 3}'):
        with pytest.raises(ValueError):
            config.load(bad)


def test_postman_against_all_pairings(spark):
    import random

    rnd = random.Random(4)
    ways = [(k, rnd.randrange(9), rnd.randrange(9), rnd.randrange(1, 30) / 10) for k in range(16)]
    ways = [w for w in ways if w[1] != w[2]]
    got = {r["component"]: r for r in routes.postman(network(spark, ways)).collect()}
    least = {}
    for _, s, t, km in ways:
        least[s, t] = least[t, s] = min(km, least.get((s, t), 1e9))
    nodes = sorted({n for _, s, t, _ in ways for n in (s, t)})
    d = {(a, b): 0.0 if a == b else least.get((a, b), math.inf) for a in nodes for b in nodes}
    for k in nodes:
        for a in nodes:
            for b in nodes:
                d[a, b] = min(d[a, b], d[a, k] + d[k, b])
    for c, r in got.items():
        mine = [n for n in nodes if d[c, n] < math.inf]
        odd = [n for n in mine if sum((s == n) + (t == n) for _, s, t, _ in ways) % 2]

        def pair(left):
            return 0.0 if not left else min(d[left[0], left[k]] + pair(left[1:k] + left[k + 1 :]) for k in range(1, len(left)))

        assert r["exact"] and r["again_km"] == pytest.approx(pair(odd)) and r["once_km"] == pytest.approx(sum(w[3] for w in ways if w[1] in mine))
        rough, exact = routes.matched(d, odd, 0)
        assert (not odd or not exact) and rough >= r["again_km"] - 1e-9


def test_shapefile_lines(spark, tmp_path):
    import struct

    def record(n, kind, parts, z):
        points = [p for part in parts for p in part]
        firsts = [sum(map(len, parts[:k])) for k in range(len(parts))]
        body = struct.pack("<i4d2i", kind, 0, 0, 1, 1, len(parts), len(points)) + struct.pack(f"<{len(parts)}i", *firsts) + b"".join(struct.pack("<2d", p[0], p[1]) for p in points)
        body += struct.pack("<2d", 0, 9) + b"".join(struct.pack("<d", p[2]) for p in points) if z else b""
        return struct.pack(">ii", n, len(body) // 2) + body

    rows = record(1, 13, [[(1, 2, 3), (4, 5, 6)], [(7, 8, 9), (1, 1, 1), (2, 2, 2)]], True) + record(2, 3, [[(0, 0), (1, 1)]], False) + struct.pack(">ii", 3, 2) + struct.pack("<i", 0)
    (tmp_path / "a.shp").write_bytes(b"\0" * 100 + rows)
    field = b"name".ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([8]) + b"\0" * 15
    (tmp_path / "a.dbf").write_bytes(struct.pack("<4B I H H", 3, 1, 1, 1, 2, 32 + 32 + 1, 9) + b"\0" * 20 + field + b"\r" + b" " + b"ridge".ljust(8) + b" " + b"creek".ljust(8))
    got = sorted((r["record"], r["part"], r["properties"]["name"], [tuple(p) for p in r["coords"]]) for r in shapefile.read_shapefile(spark, f"file://{tmp_path}").collect())
    assert got == [(1, 0, "ridge", [(1, 2, 3), (4, 5, 6)]), (1, 1, "ridge", [(7, 8, 9), (1, 1, 1), (2, 2, 2)]), (2, 0, "creek", [(0, 0, 0), (1, 1, 0)])]


def test_old_tables_of_runs_go(spark):
    written(spark.range(3), "old")
    last = max(t for _, t in tables_of_runs(spark))
    assert prune(spark, 0) == 0 and prune(spark, last + 1) >= 1 and not any("waymesh-old" in p for p, _ in tables_of_runs(spark))


def test_rounds_leave_their_last_table_only(spark):
    """Every round left its whole network on disk."""
    before = set(tables_of_runs(spark))
    made, rounds = repair.optimised(network(spark, [(k, k, k + 1, 1) for k in range(1, 9)]))
    assert rounds > 2 and made.agg({"length_km": "sum"}).first()[0] == 8.0
    assert len(set(tables_of_runs(spark)) - before) == 1


def test_bypass_search_leaves_few_tables(spark):
    at = spark.createDataFrame([(k, k * 1e-4, 0.0, 0.0) for k in range(1, 7)], "id long, lng double, lat double, elevation double")
    before = set(tables_of_runs(spark))
    gone = repair.bypass_edges(at, network(spark, [(1, 1, 6, 1), *((k, k - 1, k, 1) for k in range(2, 7))]), 20.0)
    assert [x.id for x in gone.collect()] == [1]
    assert len(set(tables_of_runs(spark)) - before) == 5  # asked, allowed, ways, front, seen
