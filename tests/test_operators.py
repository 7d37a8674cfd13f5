"""Fixtures with known answers: crossings, tees, gaps, chains, components, paths, scores."""

import math

import pytest
from pyspark.sql import functions as F

from waymesh.functions import geo, scoring
from waymesh.operators import graph, lines, routes, spatial, validation
from waymesh.operators.components import connected_components
from waymesh.plans.prefix import running_totals


def trails(spark, **named):
    rows = [(k, [(float(x), float(y), float(z)) for x, y, z in pts]) for k, pts in named.items()]
    return spark.createDataFrame(rows, f"trail_id string, coords {geo.LINE}")


def network(spark, rows):
    return spark.createDataFrame([(i, s, t, float(km), float(g), float(g)) for i, s, t, km, g in rows], "id long, source long, target long, length_km double, elevation_gain double, elevation_loss double")


CROSS = {"a": [(-105.35, 39.95, 1000), (-105.15, 40.05, 1000)], "b": [(-105.35, 40.05, 1000), (-105.15, 39.95, 1000)]}


def test_two_lines_cross_once_and_split_in_two(spark):
    t = trails(spark, **CROSS)
    found = spatial.crossings(t).collect()
    assert len(found) == 1 and math.isclose(found[0]["x"], -105.25, abs_tol=1e-9) and math.isclose(found[0]["y"], 40.0, abs_tol=1e-9)
    parts = lines.split_everywhere(t)
    assert sorted((r["parent"], r["part"]) for r in parts.collect()) == [("a", 0), ("a", 1), ("b", 0), ("b", 1)]
    assert all(r["ok"] for r in lines.split_check(t, parts).collect())


def test_tee_splits_the_visited_line_only(spark):
    t = trails(spark, main=[(-105.3, 40.0, 0), (-105.2, 40.0, 0)], visitor=[(-105.25, 40.0, 0), (-105.25, 40.05, 0)])
    parts = lines.split_everywhere(t, 5.0).groupBy("parent").count().collect()
    assert {r["parent"]: r["count"] for r in parts} == {"main": 2, "visitor": 1}


def test_near_miss_gets_a_connector_within_tolerance_only(spark):
    step = 3 / geo.METRES_PER_DEGREE
    t = trails(spark, a=[(-105.3, 39.9, 0), (-105.3, 40.0, 0)], b=[(-105.3, 40.0 + step, 0), (-105.3, 40.1, 0)])
    assert [(r["id1"], r["end1"], r["id2"], r["end2"]) for r in lines.gap_connectors(t, 5.0).collect()] == [("a", "end", "b", "start")]
    assert lines.gap_connectors(t, 2.0).count() == 0


def test_zigzag_is_a_multipoint_crossing(spark):
    t = trails(spark, line=[(0.0, 40.0, 0), (0.1, 40.0, 0)], zigzag=[(0.01, 39.99, 0), (0.02, 40.01, 0), (0.03, 39.99, 0), (0.04, 40.01, 0)])
    assert [(r["n"], r["kind"]) for r in lines.multi_crossings(spatial.crossings(t)).collect()] == [(3, "p_intersection")]


def test_self_crossing_line_falls_into_simple_parts(spark):
    t = trails(spark, eight=[(0, 0, 0), (0.02, 0.02, 0), (0.02, 0, 0), (0, 0.02, 0)])
    assert not t.select(geo.is_simple("coords")).first()[0]
    parts = lines.self_split(t)
    assert parts.count() == 3 and all(r[0] for r in parts.select(geo.is_simple("coords")).collect())


def test_elevation(spark):
    e = trails(spark, t=[(0, 0, 10), (0, 1, 15), (0, 2, 12)]).select(geo.elevation("coords").alias("e")).first()["e"]
    assert (e["gain"], e["loss"], e["min_z"], e["max_z"]) == (5.0, 3.0, 10.0, 15.0)


def test_haversine_and_text_forms(spark):
    row = trails(spark, t=[(0, 0, 1.5), (0, 1, 2), (1, 1, 3)]).select(
        geo.length_m("coords").alias("m"), geo.from_wkt(geo.as_wkt("coords")).alias("w"), geo.from_geojson(geo.as_geojson("coords")).alias("g"), "coords",
        geo.locate("coords", geo.point(0.0, 0.5)).alias("l"), geo.interpolate("coords", F.lit(0.25)).alias("i"), geo.azimuth(geo.start_point("coords"), geo.point_n("coords", 2)).alias("az"),
    ).first()
    assert math.isclose(row["m"], 111195.08 * (1 + math.cos(math.radians(1))), rel_tol=1e-4)
    assert row["w"] == row["coords"] == row["g"] and row["az"] == 0.0
    assert 0.249 < row["l"] < 0.251 and 0.499 < row["i"]["y"] < 0.501


def test_cell_join_finds_what_brute_force_finds(spark):
    import random

    rnd = random.Random(4)
    pts = [(k, rnd.uniform(-105.3, -105.28), rnd.uniform(59.99, 60.01)) for k in range(150)]
    a, b = spark.createDataFrame(pts, "i long, x double, y double"), spark.createDataFrame(pts, "j long, x2 double, y2 double")
    got = {(r["i"], r["j"]) for r in spatial.within_distance(a, b, 150).collect()}
    want = {(r["i"], r["j"]) for r in a.crossJoin(b).where(geo.haversine(F.col("x"), F.col("y"), F.col("x2"), F.col("y2")) <= 150).collect()}
    assert got == want and len(got) > 150
    assert spatial.within_distance(a, b, 150).count() == len(got)


def test_chain_with_branch_becomes_one_edge(spark):
    e = network(spark, [(1, 1, 2, 1, 10), (2, 2, 3, 2, 20), (3, 3, 4, 3, 30), (4, 4, 5, 1, 0), (5, 4, 6, 1, 0)])
    made = {r["chain_id"]: r for r in graph.degree2_chains(e).collect()}
    assert len(made) == 3 and made[1]["n_edges"] == 3 and made[1]["length_km"] == 6.0 and {made[1]["source"], made[1]["target"]} == {1, 4}


def test_parallel_edges_keep_the_shortest(spark):
    e = network(spark, [(1, 1, 2, 3, 0), (2, 1, 2, 2, 0), (3, 2, 1, 2, 0)])
    assert [r["id"] for r in graph.dedupe_edges(e).collect()] == [2]
    assert sorted(r["id"] for r in graph.dedupe_edges(e, both_ways=False).collect()) == [2, 3]


def test_components_and_metrics(spark):
    e = network(spark, [(1, 1, 2, 1, 0), (2, 2, 3, 1, 0), (3, 3, 1, 1, 0), (4, 7, 8, 1, 0)])
    assert {(r["node"], r["component"]) for r in graph.components(e).collect()} == {(1, 1), (2, 1), (3, 1), (7, 7), (8, 7)}
    m = validation.connectivity(e).first()
    assert (m["components"], m["largest"], m["largest_pct"]) == (2, 3, 60.0)
    long = spark.createDataFrame([(k, k + 1) for k in range(300)] + [(900, 900)], "source long, target long")
    assert {r["component"] for r in connected_components(long).where("node < 900").collect()} == {0}
    assert connected_components(long).where("node = 900").first()["component"] == 900


def test_square_is_one_cycle(spark):
    e = network(spark, [(1, 1, 2, 1, 5), (2, 2, 3, 1, 5), (3, 3, 4, 1, 5), (4, 4, 1, 1, 5)])
    found = graph.cycles(e, 10, 6).collect()
    assert len(found) == 1 and found[0]["total_km"] == 4.0 and found[0]["path"][0] == 1


def test_diamond_paths_in_order_and_lollipop(spark):
    e = network(spark, [(1, 1, 2, 1, 0), (2, 2, 4, 2, 0), (3, 1, 3, 2, 0), (4, 3, 4, 2, 0)])
    pairs = spark.createDataFrame([(1, 4)], "start long, goal long")
    assert [(r["path_id"], r["cost"], r["path"]) for r in routes.ksp(e, pairs, 3).orderBy("path_id").collect()] == [(1, 3.0, [1, 2, 4]), (2, 4.0, [1, 3, 4])]
    best = graph.shortest_paths(e, spark.createDataFrame([(1,)], "id long"))
    assert {(r["node"], r["cost"]) for r in best.collect()} == {(1, 0.0), (2, 1.0), (3, 2.0), (4, 3.0)}
    found = routes.lollipops(e, 5.0, 4, 2).where("anchor = 1 AND goal = 4").first()
    assert found["overlap"] == 0 and found["total_km"] == 7.0


def test_bridges(spark):
    e = network(spark, [(1, 1, 2, 1, 0), (2, 2, 3, 1, 0), (3, 3, 1, 1, 0), (4, 3, 4, 1, 0)])
    assert {(r["kind"], r["id"]) for r in routes.bridges(e).collect()} == {("bridge", 4), ("articulation", 3)}


def test_orphans(spark):
    n = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    e = network(spark, [(1, 1, 2, 1, 0), (2, 2, 9, 1, 0)])
    assert [r["id"] for r in graph.orphan_nodes(n, e).collect()] == [3]
    assert [r["id"] for r in graph.orphan_edges(n, e).collect()] == [2]


def test_preferences(spark):
    cost = lambda km, gain, shape: spark.range(1).select(scoring.preference_cost(F.lit(float(km)), F.lit(float(gain)), F.lit(shape), 10.0, 750.0)).first()[0]
    assert cost(10, 750, "loop") == pytest.approx(0.0)
    assert cost(10, 750, "loop") < cost(10, 750, "out-and-back") < cost(10, 750, "point-to-point") < cost(10, 750, "x")
    assert cost(10, 750, "loop") < cost(12, 900, "loop") < cost(1, 300, "loop")


def test_running_totals(spark):
    made = running_totals(spark.range(0, 1000, 1, 7).select("id", (F.col("id") % 5).alias("v")), ["id"], ["v"]).orderBy("id").collect()
    total = 0
    for r in made:
        assert r["v_before"] == total
        total += r["v"]


def test_cell_joins_never_broadcast(spark):
    """Both sides come out of an explode, whose size the optimizer takes for that of its input."""
    at = spark.range(50).select("id", (F.col("id") * 1e-4).alias("x"), F.lit(0.0).alias("y"))
    other = at.select(F.col("id").alias("id2"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    plan = spatial.within_distance(at, other, 100)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_each_distance_is_written_once(spark):
    """A filter on the distance isn't pushed below the steps that lead to it, repeating them."""
    found = spatial.ends_on_lines(trails(spark, **CROSS), 200.0)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.upper().count("ASIN(") == 1


def test_split_makes_its_lines_once(spark):
    n = F.col("id")
    whole = spark.range(2).select(n.alias("trail_id"), F.array(geo.point(n * 0.01, 0.0), geo.point(0.01 - n * 0.01, 0.01)).alias("coords"))
    parts = lines.split_everywhere(whole)
    assert "Range (" not in parts._jdf.queryExecution().optimizedPlan().toString() and parts.count() == 4


def test_touch_on_a_line_that_comes_by_twice_is_where_it_comes_first(spark):
    """The elevation doesn't decide which of two visits to one place is cut."""
    t = trails(spark, visited=[(0.0, 40.0, 900), (0.01, 40.0, 900), (0.01, 40.01, 500), (0.0, 40.01, 500), (0.01, 40.0, 100), (0.02, 40.0, 100)], visitor=[(0.01, 39.9995, 0), (0.01, 39.9, 0)])
    found = spatial.ends_on_lines(t, 100.0).where("visitor = 'visitor' AND end = 'start'").collect()
    assert [(r["seg"], r["t"], r["z"]) for r in found] == [(0, 1.0, 900.0)]


def test_components_over_several_ranges(spark, monkeypatch):
    """Long paths, a hub and loops whose edges fall into many tasks, against a plain search; names as before."""
    from waymesh.operators import components

    monkeypatch.setattr(components, "OF_A_TASK", 7)
    pairs = [(k, k + 1) for k in range(40)] + [(1000, 100 + k) for k in range(60)] + [(-5, -5), (500, 90), (7, 7)] + [(2000 + 37 * k % 50, 2000 + 37 * (k + 1) % 50) for k in range(20)]
    want = {}
    for a, b in pairs * 60:
        want[a] = want[b] = min(want.get(a, a), want.get(b, b))
    edges = spark.createDataFrame([*pairs, (None, 3), (4, None)], "source long, target long")
    assert {r["node"]: r["component"] for r in connected_components(edges).collect()} == want
    named = spark.createDataFrame([(f"{a:05d}", f"{b:05d}") for a, b in pairs if a >= 0], "source string, target string")
    assert {r["node"]: r["component"] for r in connected_components(named).collect()} == {f"{a:05d}": f"{c:05d}" for a, c in want.items() if a >= 0}


def test_components_are_solved_without_rounds_of_joins(spark, monkeypatch):
    """Edges of near ids take no round of the distributed search, whose rounds filled the disk."""
    from waymesh.operators import components

    monkeypatch.setattr(components, "_by_stars", lambda *_: 1 / 0)
    edges = spark.createDataFrame([(24 * k + i, 24 * k + i + 1) for k in range(30) for i in range(5)], "source long, target long")
    assert {r["node"]: r["component"] for r in connected_components(edges).collect()} == {24 * k + i: 24 * k for k in range(30) for i in range(6)}


def test_crossings_join_compares_boxes_only(spark):
    """A condition with the ratios written out is a method too long for the JVM to compile: 24 microseconds a pair."""
    two = spark.createDataFrame([(1, [(0.0, 0.0, 0.0), (1.0, 1.0, 10.0)]), (2, [(0.0, 1.0, 0.0), (1.0, 0.0, 0.0)]), (3, [(2.0, 2.0, 0.0), (3.0, 2.0, 0.0)])], f"trail_id long, coords {geo.LINE}")
    made = spatial.crossings(two, size=5.0)
    joins = [x for x in made._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join Inner" in x]
    assert joins and all("*" not in x and "/" not in x for x in joins)
    assert [(x.id1, x.id2, x.x, x.y, x.z, x.ratio, x.ratio2) for x in made.collect()] == [(1, 2, 0.5, 0.5, 5.0, 0.5, 0.5)]
