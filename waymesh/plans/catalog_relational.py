"""Sources, exports, projections, joins, aggregations, windows, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymesh.operators import graph
from waymesh.plans.registry import query
from waymesh.plans.views import EDGES, NODES, TRAILS, edges, hav, nodes, same_tile, sheet_of_node, table, trails
from waymesh.sources.readers import expand_box, in_box, keep_latest, trigram_similarity

E_, N_, T_ = EDGES, NODES, TRAILS
BOX = (-99.9, -49.99, -97.5, -49.985)


def r6(c: Column | str, digits: int = 6) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


DEGREES = "deg AS (SELECT node, count(DISTINCT id) AS degree FROM (SELECT source AS node, id FROM edges UNION ALL SELECT target, id FROM edges) GROUP BY node)"


# ---- sources

@query("src01_scan_by_region_box", f"""WITH {T_}, {N_} SELECT trail_id, name, source FROM trails WHERE region = 'EUROPE' AND price BETWEEN 1000 AND 50000""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return trails(spark, sf).where((F.col("region") == "EUROPE") & F.col("price").between(1000, 50000)).select("trail_id", "name", "source")


@query("src02_box_expansion", f"""WITH {N_} SELECT id, lng, lat FROM nodes WHERE lng BETWEEN -99.9::DOUBLE - 0.01::DOUBLE AND -97.5::DOUBLE + 0.01::DOUBLE AND lat BETWEEN -49.99::DOUBLE - 0.01::DOUBLE AND -49.985::DOUBLE + 0.01::DOUBLE""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return in_box(nodes(spark, sf), expand_box(BOX, 0.01), "lng", "lat").select("id", "lng", "lat")


@query("src09_unit_adaptation", f"""WITH {T_} SELECT trail_id, round(price / 1000 * 1.60934, 6) AS length_km, coalesce(nullif(surface, '1-URGENT'), 'unknown') AS surface, 'import' AS source FROM trails t
    WHERE NOT EXISTS (SELECT 1 FROM trails o WHERE lower(o.name) = lower(t.name) AND o.trail_id < t.trail_id)""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    t = trails(spark, sf)
    first = t.groupBy(F.lower("name").alias("n")).agg(F.min("trail_id").alias("trail_id"))
    kept = t.join(first.select("trail_id"), "trail_id", "left_semi")
    return kept.select("trail_id", r6(F.col("price") / 1000 * 1.60934).alias("length_km"), F.coalesce(F.nullif("surface", F.lit("1-URGENT")), F.lit("unknown")).alias("surface"), F.lit("import").alias("source"))


@query("src10_upsert_keep_latest", f"""WITH {T_}, both_ AS (SELECT trail_id % 500 AS key, trail_id, price FROM trails WHERE difficulty = 'O' UNION ALL SELECT trail_id % 500, trail_id, price FROM trails WHERE difficulty = 'F')
    SELECT key, trail_id, price FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY trail_id DESC) AS k FROM both_) WHERE k = 1""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    t = trails(spark, sf).select((F.col("trail_id") % 500).alias("key"), "trail_id", "price", "difficulty")
    return keep_latest(t.where("difficulty = 'O'").drop("difficulty"), t.where("difficulty = 'F'").drop("difficulty"), ["key"], "trail_id")


TRI = "list_distinct(list_transform(range(1, length({0}) + 4), lambda i: substr('  ' || lower({0}) || '  ', i::BIGINT, 3)))"


@query("src11_cross_source_overlap", f"""WITH p AS (SELECT p_partkey, p_name, p_brand, p_type FROM part), pairs AS (
    SELECT a.p_partkey AS id1, b.p_partkey AS id2, {TRI.format('a.p_name')} AS ta, {TRI.format('b.p_name')} AS tb FROM p a JOIN p b ON a.p_brand = b.p_brand AND a.p_type = b.p_type AND a.p_partkey < b.p_partkey)
    SELECT id1, id2, round(len(list_intersect(ta, tb))::DOUBLE / len(list_distinct(list_concat(ta, tb))), 6) AS similarity FROM pairs WHERE len(list_intersect(ta, tb))::DOUBLE / len(list_distinct(list_concat(ta, tb))) > 0.3
    ORDER BY similarity DESC, id1, id2 LIMIT 100""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    block = ["p_brand", "p_type"]
    p = table(spark, sf, "part").select("p_partkey", "p_name", *block)
    a, b = p.select(F.col("p_partkey").alias("id1"), F.col("p_name").alias("n1"), *block), p.select(F.col("p_partkey").alias("id2"), F.col("p_name").alias("n2"), *block)
    pairs = a.join(b, block).where("id1 < id2").withColumn("similarity", trigram_similarity(F.col("n1"), F.col("n2"))).where("similarity > 0.3")
    return pairs.select("id1", "id2", r6("similarity").alias("similarity")).orderBy(F.desc("similarity"), "id1", "id2").limit(100)


@query("src12_merged_view_priority", """SELECT coalesce(a.key, b.key) AS key, coalesce(a.price, b.price) AS price, CASE WHEN a.key IS NOT NULL THEN 'first' ELSE 'second' END AS origin
    FROM (SELECT o_orderkey % 700 AS key, max(o_totalprice) AS price FROM orders WHERE o_orderstatus = 'O' GROUP BY 1) a FULL JOIN (SELECT o_orderkey % 900 AS key, max(o_totalprice) AS price FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) b ON a.key = b.key""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    from waymesh.sources.readers import merged_view

    o = table(spark, sf, "orders")
    part = lambda s, m: o.where(F.col("o_orderstatus") == s).groupBy((F.col("o_orderkey") % m).alias("key")).agg(F.max("o_totalprice").alias("price"))
    return merged_view(part("O", 700), part("F", 900), "key", ["price"], "first_priority")


# ---- exports

@query("snk01_nodes_with_degree", f"""WITH {E_}, {N_}, {DEGREES} SELECT n.id, n.lng, n.lat, coalesce(degree, 0) AS degree,
    CASE WHEN degree >= 3 THEN 'intersection' WHEN degree = 2 THEN 'connector' WHEN degree = 1 THEN 'endpoint' ELSE 'unknown' END AS node_type FROM nodes n LEFT JOIN deg ON n.id = deg.node""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return graph.nodes_with_degree(nodes(spark, sf), edges(spark, sf)).select("id", "lng", "lat", "degree", "node_type")


@query("snk03_edge_composition_json", f"""WITH {E_} SELECT trail_id, '[' || string_agg('{{"seq":' || k || ',"edge":' || id || '}}', ',' ORDER BY k) || ']' AS composition
    FROM (SELECT trail_id, id, row_number() OVER (PARTITION BY trail_id ORDER BY id) AS k FROM edges) GROUP BY trail_id""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    e = edges(spark, sf).withColumn("seq", F.row_number().over(Window.partitionBy("trail_id").orderBy("id")))
    return e.groupBy("trail_id").agg(F.to_json(F.sort_array(F.collect_list(F.struct("seq", F.col("id").alias("edge"))))).alias("composition"))


@query("snk04_edge_export", f"WITH {E_} SELECT id, source, target, round(length_km, 6) AS length_km, true AS is_bidirectional FROM edges")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return edges(spark, sf).select("id", "source", "target", r6("length_km").alias("length_km"), F.lit(True).alias("is_bidirectional"))


@query("snk05_route_display", """SELECT o_orderkey AS route_id, 'Route ' || o_orderkey || ' (' || lower(o_orderpriority) || ')' AS display_name, CASE o_orderstatus WHEN 'O' THEN '#00AA00' WHEN 'F' THEN '#AA0000' ELSE '#888888' END AS color FROM orders""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    color = F.coalesce(F.create_map(F.lit("O"), F.lit("#00AA00"), F.lit("F"), F.lit("#AA0000"))[F.col("o_orderstatus")], F.lit("#888888"))
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("route_id"), F.concat(F.lit("Route "), F.col("o_orderkey").cast("string"), F.lit(" ("), F.lower("o_orderpriority"), F.lit(")")).alias("display_name"), color.alias("color"))


@query("snk06_trail_export_defaults", f"WITH {T_} SELECT trail_id, coalesce(nullif(name, ''), 'Unnamed') AS name, CASE WHEN difficulty = 'P' THEN NULL ELSE difficulty END AS difficulty, coalesce(CASE WHEN price < 50000 THEN surface END, 'unknown') AS surface FROM trails")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return trails(spark, sf).select("trail_id", F.coalesce(F.nullif("name", F.lit("")), F.lit("Unnamed")).alias("name"), F.when(F.col("difficulty") != "P", F.col("difficulty")).alias("difficulty"), F.coalesce(F.when(F.col("price") < 50000, F.col("surface")), F.lit("unknown")).alias("surface"))


@query("snk07_routes_by_created", "SELECT o_orderkey AS route_id, CAST(NULL AS BIGINT) AS parent_id, o_totalprice AS score FROM orders ORDER BY o_orderdate DESC, o_orderkey")
def _(spark: SparkSession, sf: str) -> DataFrame:
    top = table(spark, sf, "orders").orderBy(F.desc("o_orderdate"), "o_orderkey")
    return top.select(F.col("o_orderkey").alias("route_id"), F.lit(None).cast("long").alias("parent_id"), F.col("o_totalprice").alias("score"))


@query("snk10_region_metadata", f"""WITH {T_}, {N_} SELECT region, count(*) AS total_trails, count(DISTINCT source) AS sources, round(min(price), 6) AS min_price, round(max(price), 6) AS max_price, round(sum(price) / 1000, 2) AS total_km FROM trails GROUP BY region""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return trails(spark, sf).groupBy("region").agg(F.count("*").alias("total_trails"), F.count_distinct("source").alias("sources"), r6(F.min("price")).alias("min_price"), r6(F.max("price")).alias("max_price"), r6(F.sum("price") / 1000, 2).alias("total_km"))


@query("snk11_route_stats", """SELECT count(*) AS total_routes, count(*) FILTER (o_orderstatus = 'O') AS open_routes, count(*) FILTER (o_orderstatus = 'F') AS loop_routes, round(avg(o_totalprice), 4) AS avg_score FROM orders""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").agg(F.count("*").alias("total_routes"), F.count_if(F.col("o_orderstatus") == "O").alias("open_routes"), F.count_if(F.col("o_orderstatus") == "F").alias("loop_routes"), r6(F.avg("o_totalprice"), 4).alias("avg_score"))


@query("snk12_route_trail_composition", f"""WITH {E_} SELECT o_orderkey AS route_id, id AS edge_id, row_number() OVER (PARTITION BY o_orderkey ORDER BY id) AS segment_order, trail_name, round(length_km, 6) AS length_km FROM orders JOIN edges ON trail_id = o_orderkey""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    joined = table(spark, sf, "orders").join(edges(spark, sf), F.col("trail_id") == F.col("o_orderkey"))
    return joined.select(F.col("o_orderkey").alias("route_id"), F.col("id").alias("edge_id"), F.row_number().over(Window.partitionBy("o_orderkey").orderBy("id")).alias("segment_order"), "trail_name", r6("length_km").alias("length_km"))


@query("snk13_export_statistics", f"""WITH {E_}, {N_} SELECT (SELECT count(*) FROM nodes) AS n_nodes, (SELECT count(*) FROM edges) AS n_edges, (SELECT round(sum(length_km), 4) FROM edges) AS total_km, (SELECT count(*) FROM orders) AS n_routes""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    one = [nodes(spark, sf).agg(F.count("*").alias("n_nodes")), edges(spark, sf).agg(F.count("*").alias("n_edges"), r6(F.sum("length_km"), 4).alias("total_km")), table(spark, sf, "orders").agg(F.count("*").alias("n_routes"))]
    return one[0].crossJoin(one[1]).crossJoin(one[2])


# ---- projections and filters

@query("prj03_edge_costs", f"""WITH {E_} SELECT id, round(CASE WHEN length_km > 0 THEN elevation_gain / length_km * 2.0 ELSE 0 END + length_km * 0.5, 6) AS cost, round(CASE WHEN length_km > 0 THEN elevation_loss / length_km * 2.0 ELSE 0 END + length_km * 0.5, 6) AS reverse_cost FROM edges""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    from waymesh.functions.scoring import edge_cost

    return edges(spark, sf).select("id", r6(edge_cost(F.col("elevation_gain"), F.col("length_km"), 2.0, 0.5)).alias("cost"), r6(edge_cost(F.col("elevation_loss"), F.col("length_km"), 2.0, 0.5)).alias("reverse_cost"))


@query("prj04_one_way_cost", f"WITH {E_} SELECT id, round(length_km, 6) AS cost, CASE WHEN id % 3 = 0 THEN -1.0::DOUBLE ELSE round(length_km, 6) END AS reverse_cost FROM edges")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return edges(spark, sf).select("id", r6("length_km").alias("cost"), F.when(F.col("id") % 3 == 0, F.lit(-1.0)).otherwise(r6("length_km")).alias("reverse_cost"))


@query("flt02_no_self_loops", f"WITH {E_} SELECT id, source, target FROM edges WHERE source <> target")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return graph.without_loops(edges(spark, sf)).select("id", "source", "target")


@query("flt04_name_patterns", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%a%' AND p_name ILIKE '%R%'")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").where(F.col("p_name").like("%a%") & F.col("p_name").ilike("%R%")).select("p_partkey", "p_name")


@query("flt05_optional_predicate", f"WITH {E_} SELECT id, round(length_km, 6) AS length_km FROM edges WHERE length_km <= 2.5")
def _(spark: SparkSession, sf: str) -> DataFrame:
    from waymesh.sources.readers import scan

    return scan(edges(spark, sf), max_values={"length_km": 2.5, "elevation_gain": None}).select("id", r6("length_km").alias("length_km"))


@query("flt06_tolerance_band", f"WITH {E_} SELECT id FROM edges WHERE length_km BETWEEN 2.0 * 0.8 AND 2.0 * 1.2")
def _(spark: SparkSession, sf: str) -> DataFrame:
    from waymesh.functions.scoring import in_band

    return edges(spark, sf).where(in_band(F.col("length_km"), 2.0, 20)).select("id")


# ---- joins

@query("jn01_edges_with_nodes", f"WITH {E_}, {N_} SELECT e.id, s.lat AS source_lat, t.lat AS target_lat FROM edges e JOIN nodes s ON e.source = s.id JOIN nodes t ON e.target = t.id")
def _(spark: SparkSession, sf: str) -> DataFrame:
    n = nodes(spark, sf)
    return edges(spark, sf).join(n.select(F.col("id").alias("source"), F.col("lat").alias("source_lat")), "source").join(n.select(F.col("id").alias("target"), F.col("lat").alias("target_lat")), "target").select("id", "source_lat", "target_lat")


@query("jn02_left_degree_default", f"WITH {E_}, {N_}, {DEGREES} SELECT n.id, coalesce(degree, 0) AS degree FROM nodes n LEFT JOIN deg ON node = n.id AND degree > 3")
def _(spark: SparkSession, sf: str) -> DataFrame:
    d = graph.degrees(edges(spark, sf)).where("degree > 3").withColumnRenamed("node", "id")
    return nodes(spark, sf).select("id").join(d, "id", "left").select("id", F.coalesce("degree", F.lit(0)).alias("degree"))


@query("jn03_full_outer_dead_ends", f"""WITH {E_}, o AS (SELECT source AS node, count(*) AS n_out FROM edges GROUP BY 1), i AS (SELECT target AS node, count(*) AS n_in FROM edges GROUP BY 1)
    SELECT coalesce(o.node, i.node) AS node, coalesce(n_in, 0) AS n_in, coalesce(n_out, 0) AS n_out FROM o FULL JOIN i ON o.node = i.node WHERE n_in IS NULL OR n_out IS NULL""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return graph.dead_ends(edges(spark, sf))


@query("jn04_incident_edges", f"WITH {E_}, {N_} SELECT n.id AS node, e.id FROM nodes n JOIN edges e ON e.source = n.id UNION SELECT n.id, e.id FROM nodes n JOIN edges e ON e.target = n.id")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return graph.incident(edges(spark, sf)).join(nodes(spark, sf).select(F.col("id").alias("node")), "node", "left_semi")


@query("jn05_pairs_below", f"WITH {E_} SELECT a.id AS id1, b.id AS id2 FROM edges a JOIN edges b ON a.trail_id = b.trail_id AND a.id < b.id")
def _(spark: SparkSession, sf: str) -> DataFrame:
    e = edges(spark, sf)
    return e.select("trail_id", F.col("id").alias("id1")).join(e.select("trail_id", F.col("id").alias("id2")), "trail_id").where("id1 < id2").select("id1", "id2")


@query("jn06_points_within_distance", f"WITH {N_} SELECT a.id AS id1, b.id AS id2, round({hav('a.lng', 'a.lat', 'b.lng', 'b.lat')}, 3) AS metres FROM nodes a JOIN nodes b ON {same_tile('a.id', 'b.id')} AND a.id < b.id WHERE {hav('a.lng', 'a.lat', 'b.lng', 'b.lat')} <= 3000")
def _(spark: SparkSession, sf: str) -> DataFrame:
    from waymesh.operators.spatial import within_distance

    n = nodes(spark, sf)
    a, b = n.select(F.col("id").alias("id1"), F.col("lng").alias("x"), F.col("lat").alias("y")), n.select(F.col("id").alias("id2"), F.col("lng").alias("x2"), F.col("lat").alias("y2"))
    return within_distance(a, b, 3000, sheets=(sheet_of_node(F.col("id1")), sheet_of_node(F.col("id2")))).where("id1 < id2").select("id1", "id2", F.round("metres", 3).alias("metres"))


KNN = f"""WITH {N_}, d AS (SELECT a.id AS id1, b.id AS id2, {hav('a.lng', 'a.lat', 'b.lng', 'b.lat')} AS metres FROM nodes a JOIN nodes b ON {same_tile('a.id', 'b.id')} AND a.id <> b.id), k AS (SELECT *, row_number() OVER (PARTITION BY id1 ORDER BY metres, id2) AS rank FROM d WHERE metres <= 6000)"""


@query("jn08_k_nearest", KNN + " SELECT id1, id2, rank, round(metres, 3) AS metres FROM k WHERE rank <= 3")
def _(spark: SparkSession, sf: str) -> DataFrame:
    from waymesh.operators.spatial import within_distance

    n = nodes(spark, sf)
    a, b = n.select(F.col("id").alias("id1"), F.col("lng").alias("x"), F.col("lat").alias("y")), n.select(F.col("id").alias("id2"), F.col("lng").alias("x2"), F.col("lat").alias("y2"))
    pairs = within_distance(a, b, 6000, sheets=(sheet_of_node(F.col("id1")), sheet_of_node(F.col("id2")))).where("id1 <> id2")
    return pairs.withColumn("rank", F.row_number().over(Window.partitionBy("id1").orderBy("metres", "id2"))).where("rank <= 3").select("id1", "id2", "rank", F.round("metres", 3).alias("metres"))


@query("jn09_nearest_node", KNN + " SELECT id1, id2, round(metres, 3) AS metres FROM k WHERE rank = 1")
def _(spark: SparkSession, sf: str) -> DataFrame:
    from waymesh.operators.spatial import within_distance

    n = nodes(spark, sf)
    a, b = n.select(F.col("id").alias("id1"), F.col("lng").alias("x"), F.col("lat").alias("y")), n.select(F.col("id").alias("id2"), F.col("lng").alias("x2"), F.col("lat").alias("y2"))
    best = within_distance(a, b, 6000, sheets=(sheet_of_node(F.col("id1")), sheet_of_node(F.col("id2")))).where("id1 <> id2").groupBy("id1").agg(F.min(F.struct("metres", "id2")).alias("m"))
    return best.select("id1", "m.id2", F.round("m.metres", 3).alias("metres"))


@query("jn10_cross_bounds", f"WITH {N_} SELECT id, round(lng - (SELECT min(lng) FROM nodes), 6) AS east, round(lat - (SELECT min(lat) FROM nodes), 6) AS north FROM nodes")
def _(spark: SparkSession, sf: str) -> DataFrame:
    n = nodes(spark, sf)
    low = n.agg(F.min("lng").alias("x0"), F.min("lat").alias("y0"))
    return n.crossJoin(F.broadcast(low)).select("id", r6(F.col("lng") - F.col("x0")).alias("east"), r6(F.col("lat") - F.col("y0")).alias("north"))


@query("jn11_unnest_series", "SELECT o_orderkey, k AS step FROM orders, LATERAL (SELECT unnest(range(1, (o_orderkey % 4 + 2)::BIGINT)) AS k)")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", F.explode(F.sequence(F.lit(1).cast("long"), F.col("o_orderkey") % 4 + 1)).alias("step"))


@query("jn12_orphan_nodes", f"WITH {E_}, {N_} SELECT id FROM nodes n WHERE id NOT IN (SELECT source FROM edges UNION SELECT target FROM edges)")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return graph.orphan_nodes(nodes(spark, sf), edges(spark, sf)).select("id")


@query("jn13_nodes_with_long_edge", f"WITH {E_}, {N_} SELECT id FROM nodes n WHERE EXISTS (SELECT 1 FROM edges e WHERE e.source = n.id AND length_km >= 4.9)")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return nodes(spark, sf).select("id").join(edges(spark, sf).where("length_km >= 4.9").select(F.col("source").alias("id")), "id", "left_semi")


@query("jn14_path_membership", f"""WITH {E_}, {N_}, paths AS (SELECT trail_id, list(source ORDER BY id) AS path FROM edges GROUP BY trail_id), steps AS (SELECT trail_id, unnest(path) AS node, unnest(range(len(path))) AS pos FROM paths)
    SELECT trail_id, pos, node, lat FROM steps JOIN nodes ON nodes.id = node""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    paths = edges(spark, sf).groupBy("trail_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("id", "source"))), lambda s: s["source"]).alias("path"))
    steps = paths.select("trail_id", F.posexplode("path").alias("pos", "node"))
    return steps.join(nodes(spark, sf).select(F.col("id").alias("node"), "lat"), "node").select("trail_id", "pos", "node", "lat")


@query("jn15_grid_cell_pairs", f"WITH {N_}, c AS (SELECT id, floor(lng / 0.05)::BIGINT AS cx, floor(lat / 0.05)::BIGINT AS cy FROM nodes) SELECT a.id AS id1, b.id AS id2 FROM c a JOIN c b ON a.cx = b.cx AND a.cy = b.cy AND a.id < b.id")
def _(spark: SparkSession, sf: str) -> DataFrame:
    c = nodes(spark, sf).select("id", F.floor(F.col("lng") / 0.05).alias("cx"), F.floor(F.col("lat") / 0.05).alias("cy"))
    return c.withColumnRenamed("id", "id1").join(c.withColumnRenamed("id", "id2"), ["cx", "cy"]).where("id1 < id2").select("id1", "id2")


@query("jn16_two_hops", f"WITH {E_} SELECT a.id AS id1, b.id AS id2, round(a.length_km + b.length_km, 6) AS km FROM edges a JOIN edges b ON a.target = b.source AND a.id <> b.id")
def _(spark: SparkSession, sf: str) -> DataFrame:
    e = edges(spark, sf)
    a, b = e.select(F.col("id").alias("id1"), F.col("target").alias("mid"), F.col("length_km").alias("k1")), e.select(F.col("id").alias("id2"), F.col("source").alias("mid"), F.col("length_km").alias("k2"))
    return a.join(b, "mid").where("id1 <> id2").select("id1", "id2", r6(F.col("k1") + F.col("k2")).alias("km"))


@query("jn17_array_overlap", f"""WITH {E_}, p AS (SELECT trail_id, list_distinct(list(source)) AS path FROM edges GROUP BY trail_id) SELECT a.trail_id AS id1, b.trail_id AS id2 FROM p a JOIN p b ON {same_tile('a.trail_id', 'b.trail_id', 8)} AND a.trail_id < b.trail_id AND list_has_any(a.path, b.path)""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    p = edges(spark, sf).select("trail_id", "source").distinct()
    return p.select(F.col("trail_id").alias("id1"), "source").join(p.select(F.col("trail_id").alias("id2"), "source"), "source").where("id1 < id2").select("id1", "id2").distinct()


# ---- aggregations

@query("agg01_totals", f"WITH {E_} SELECT count(*) AS n, round(sum(length_km), 4) AS total_km, round(avg(length_km), 6) AS avg_km, round(min(elevation_gain), 6) AS min_gain, round(max(elevation_gain), 6) AS max_gain FROM edges")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return edges(spark, sf).agg(F.count("*").alias("n"), r6(F.sum("length_km"), 4).alias("total_km"), r6(F.avg("length_km")).alias("avg_km"), r6(F.min("elevation_gain")).alias("min_gain"), r6(F.max("elevation_gain")).alias("max_gain"))


@query("agg02_counts_by_category", f"WITH {T_} SELECT difficulty, surface, count(*) AS n FROM trails GROUP BY 1, 2")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return trails(spark, sf).groupBy("difficulty", "surface").agg(F.count("*").alias("n"))


@query("agg03_conditional_counts", f"WITH {E_} SELECT trail_name, count(*) FILTER (length_km > 2.5) AS long_edges, sum(CASE WHEN elevation_gain >= 50 THEN 1 ELSE 0 END)::BIGINT AS steep FROM edges GROUP BY 1")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return edges(spark, sf).groupBy("trail_name").agg(F.count_if(F.col("length_km") > 2.5).alias("long_edges"), F.count_if(F.col("elevation_gain") >= 50).alias("steep"))


@query("agg04_distinct_counts", f"WITH {E_} SELECT trail_name, count(DISTINCT source) AS sources, count(DISTINCT target) AS targets FROM edges GROUP BY 1")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return edges(spark, sf).groupBy("trail_name").agg(F.count_distinct("source").alias("sources"), F.count_distinct("target").alias("targets"))


@query("agg05_ordered_arrays", f"WITH {E_} SELECT trail_id, array_to_string(list(target ORDER BY id), ',') AS targets, array_to_string(list_sort(list(DISTINCT trail_name)), ',') AS names FROM edges GROUP BY 1")
def _(spark: SparkSession, sf: str) -> DataFrame:
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("id", "target"))), lambda s: s["target"].cast("string"))
    return edges(spark, sf).groupBy("trail_id").agg(F.array_join(ordered, ",").alias("targets"), F.array_join(F.sort_array(F.collect_set("trail_name")), ",").alias("names"))


@query("agg06_string_agg", f"WITH {E_} SELECT trail_id, string_agg(trail_name, ' - ' ORDER BY id) AS label FROM edges GROUP BY 1")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return edges(spark, sf).groupBy("trail_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("id", "trail_name"))), lambda s: s["trail_name"]), " - ").alias("label"))


@query("agg07_json_agg", f"WITH {E_} SELECT trail_id, '[' || string_agg('{{\"id\":' || id || ',\"to\":' || target || '}}', ',' ORDER BY id) || ']' AS edges_json FROM edges GROUP BY 1")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return edges(spark, sf).groupBy("trail_id").agg(F.to_json(F.sort_array(F.collect_list(F.struct("id", F.col("target").alias("to"))))).alias("edges_json"))


@query("agg08_having", f"WITH {E_} SELECT source, target, count(*) AS n FROM edges GROUP BY 1, 2 HAVING count(*) >= 2")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return edges(spark, sf).groupBy("source", "target").agg(F.count("*").alias("n")).where("n >= 2")


@query("agg11_length_buckets", f"""WITH {E_} SELECT bucket, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM edges), 4) AS pct FROM (SELECT CASE WHEN length_km < 0.5 THEN 'short' WHEN length_km < 2 THEN 'medium' ELSE 'long' END AS bucket FROM edges) GROUP BY 1""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    e = edges(spark, sf).select(F.when(F.col("length_km") < 0.5, "short").when(F.col("length_km") < 2, "medium").otherwise("long").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))
    return e.crossJoin(F.broadcast(e.agg(F.sum("n").alias("all")))).select("bucket", "n", r6(F.col("n") * 100.0 / F.col("all"), 4).alias("pct"))


@query("agg12_name_prefix_summary", "SELECT split_part(p_name, ' ', 1) AS prefix, count(*) AS n, round(sum(p_retailprice), 2) AS total FROM part GROUP BY 1 ORDER BY n DESC, prefix LIMIT 5")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").groupBy(F.split_part("p_name", F.lit(" "), F.lit(1)).alias("prefix")).agg(F.count("*").alias("n"), F.round(F.sum("p_retailprice"), 2).alias("total")).orderBy(F.desc("n"), "prefix").limit(5)


@query("agg13_route_composition", f"WITH {E_}, s AS (SELECT trail_id, trail_name, sum(length_km::DECIMAL(18, 6)) AS km FROM edges GROUP BY 1, 2), p AS (SELECT trail_id, round(km::DOUBLE * 100 / (sum(km) OVER (PARTITION BY trail_id))::DOUBLE, 9) AS pct FROM s) SELECT trail_id, count(*) AS parts, round(sum(pct::DECIMAL(18, 9))::DOUBLE, 4) AS total_pct, round(min(pct), 4) AS min_pct, round(max(pct), 4) AS max_pct FROM p GROUP BY 1")
def _(spark: SparkSession, sf: str) -> DataFrame:
    s = edges(spark, sf).groupBy("trail_id", "trail_name").agg(F.sum(F.col("length_km").cast("decimal(18,6)")).alias("km"))
    # sums of decimals don't depend on the order of the rows
    p = s.withColumn("pct", F.round(F.col("km").cast("double") * 100 / F.sum("km").over(Window.partitionBy("trail_id")).cast("double"), 9))
    return p.groupBy("trail_id").agg(F.count("*").alias("parts"), r6(F.sum(F.col("pct").cast("decimal(18,9)")).cast("double"), 4).alias("total_pct"), r6(F.min("pct"), 4).alias("min_pct"), r6(F.max("pct"), 4).alias("max_pct"))


@query("agg15_distinct_trails_in_route", f"WITH {E_} SELECT source, len(list(DISTINCT trail_name)) AS trail_count FROM edges GROUP BY 1")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return edges(spark, sf).groupBy("source").agg(F.size(F.collect_set("trail_name")).cast("long").alias("trail_count"))


@query("agg16_stddev", f"WITH {E_} SELECT trail_name, round(stddev_samp(length_km), 6) AS sd FROM edges GROUP BY 1")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return edges(spark, sf).groupBy("trail_name").agg(r6(F.stddev_samp("length_km")).alias("sd"))


# ---- windows, sorts, sets

@query("win01_surrogate_ids", f"WITH {E_} SELECT id, row_number() OVER (ORDER BY id) AS n FROM edges")
def _(spark: SparkSession, sf: str) -> DataFrame:
    from waymesh.plans.prefix import running_totals

    counted = running_totals(edges(spark, sf).select("id", F.lit(1).cast("long").alias("one")), ["id"], ["one"])
    return counted.select("id", (F.col("one_before") + 1).alias("n"))


@query("win02_keep_best", f"WITH {E_} SELECT id, least(source, target) AS a, greatest(source, target) AS b FROM edges QUALIFY row_number() OVER (PARTITION BY least(source, target), greatest(source, target) ORDER BY length_km, id) = 1")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return graph.dedupe_edges(edges(spark, sf)).select("id", F.least("source", "target").alias("a"), F.greatest("source", "target").alias("b"))


@query("win03_duplicate_counts", f"WITH {E_} SELECT id, count(*) OVER (PARTITION BY source, target) AS same_ends FROM edges")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return edges(spark, sf).select("id", F.count("*").over(Window.partitionBy("source", "target")).alias("same_ends"))


@query("win04_lag_lead", "WITH p AS (SELECT o_custkey, o_orderkey, o_totalprice AS z FROM orders) SELECT o_orderkey, round(z - lag(z) OVER w, 4) AS up, round(lead(z) OVER w - z, 4) AS next_up FROM p WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)")
def _(spark: SparkSession, sf: str) -> DataFrame:
    w, z = Window.partitionBy("o_custkey").orderBy("o_orderkey"), F.col("o_totalprice")
    return table(spark, sf, "orders").select("o_orderkey", F.round(z - F.lag(z).over(w), 4).alias("up"), F.round(F.lead(z).over(w) - z, 4).alias("next_up"))


@query("win08_distinct_on", f"WITH {E_} SELECT DISTINCT ON (source) source, id, round(length_km, 6) AS length_km FROM edges ORDER BY source, length_km DESC, id")
def _(spark: SparkSession, sf: str) -> DataFrame:
    best = edges(spark, sf).groupBy("source").agg(F.max_by(F.struct("id", "length_km"), F.struct("length_km", -F.col("id"))).alias("b"))
    return best.select("source", "b.id", r6("b.length_km").alias("length_km"))


@query("top01_best_scores", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(50)


@query("top02_direction", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 50")
def _(spark: SparkSession, sf: str) -> DataFrame:
    from waymesh.functions.scoring import top

    return top(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", "o_orderkey", 50, descending=False)


@query("top03_top_anchors", f"WITH {E_}, {DEGREES} SELECT node, degree FROM deg ORDER BY degree DESC, node LIMIT 20")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return graph.degrees(edges(spark, sf)).orderBy(F.desc("degree"), "node").limit(20)


@query("top04_boundary_ends", f"""WITH {E_}, {N_}, {DEGREES},
    b AS (SELECT min(lng) AS x0, max(lng) AS x1, min(lat) AS y0, max(lat) AS y1 FROM nodes) SELECT id, round(least(lng - x0, x1 - lng, lat - y0, y1 - lat), 6) AS margin FROM nodes JOIN deg ON node = id CROSS JOIN b WHERE degree = 1 ORDER BY margin, id LIMIT 50""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    from waymesh.operators.routes import boundary_ends

    return boundary_ends(nodes(spark, sf), edges(spark, sf), 50)


@query("top06_seeded_sample", f"WITH {E_} SELECT id FROM edges ORDER BY md5(id::VARCHAR || ':7'), id LIMIT 100")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return edges(spark, sf).select("id").orderBy(F.md5(F.concat(F.col("id").cast("string"), F.lit(":7")).cast("binary")), "id").limit(100)


@query("top07_top_per_group", f"WITH {E_} SELECT trail_name, id, k FROM (SELECT trail_name, id, row_number() OVER (PARTITION BY trail_name ORDER BY length_km DESC, id) AS k FROM edges) WHERE k <= 5")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return edges(spark, sf).select("trail_name", "id", F.row_number().over(Window.partitionBy("trail_name").orderBy(F.desc("length_km"), "id")).alias("k")).where("k <= 5")


@query("set01_union_all", f"WITH {E_} SELECT source AS node, 'out' AS kind FROM edges UNION ALL SELECT target, 'in' FROM edges")
def _(spark: SparkSession, sf: str) -> DataFrame:
    e = edges(spark, sf)
    return e.select(F.col("source").alias("node"), F.lit("out").alias("kind")).unionByName(e.select(F.col("target").alias("node"), F.lit("in").alias("kind")))


@query("set02_union_distinct", f"WITH {E_} SELECT source AS node FROM edges UNION SELECT target FROM edges")
def _(spark: SparkSession, sf: str) -> DataFrame:
    e = edges(spark, sf)
    return e.select(F.col("source").alias("node")).union(e.select("target")).distinct()


@query("set03_distinct", f"WITH {E_} SELECT DISTINCT source, trail_name FROM edges")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return edges(spark, sf).select("source", "trail_name").distinct()


@query("set04_jaccard", f"""WITH {E_}, p AS (SELECT trail_id, list_distinct(list(node)) AS s FROM (SELECT trail_id, source AS node FROM edges UNION ALL SELECT trail_id, target FROM edges) GROUP BY 1)
    SELECT a.trail_id AS id1, b.trail_id AS id2, round(len(list_intersect(a.s, b.s))::DOUBLE / len(list_distinct(list_concat(a.s, b.s))), 6) AS jaccard FROM p a JOIN p b ON {same_tile('a.trail_id', 'b.trail_id', 8)} AND a.trail_id < b.trail_id WHERE len(list_intersect(a.s, b.s)) > 0 AND len(list_intersect(a.s, b.s))::DOUBLE / len(list_distinct(list_concat(a.s, b.s))) > 0.2""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    from waymesh.operators.routes import similar_sets

    e = edges(spark, sf)
    visited = e.select("trail_id", F.explode(F.array("source", "target")).alias("node"))
    return similar_sets(visited, "trail_id", "node", 0.2).select("id1", "id2", r6("jaccard").alias("jaccard"))
