"""A place is used again after a million tiles; what lies there is on another sheet of land."""

import duckdb
import pytest

from waymesh.plans import registry
from waymesh.plans.views import PER_TILE, TILES_PER_SHEET
from tests.test_queries import SF, plain

TABLES = {"orders": "o_orderkey", "lineitem": "l_orderkey"}
NAMES = [
    "agg10_endpoint_clusters", "jn07_l101_crossings", "l102_endpoint_near_misses", "l104_multipoint_classes", "l105_ends_on_lines", "net05_edges_by_nearest_node",
    "net11_bypass_candidates", "net15_post_noding_snap", "net16_gap_detection", "net22_degree_zero",
]


@pytest.fixture(scope="module")
def folded(tmp_path_factory):
    """Orders of a few tiles, and again a million tiles further, where other trails of them lie."""
    at, con = tmp_path_factory.mktemp("folded"), duckdb.connect()
    for t in ("customer", "nation", "region", "part", "supplier"):
        con.execute(f"COPY (SELECT * FROM '{SF}/{t}.parquet') TO '{at}/{t}.parquet' (FORMAT parquet)")
    for t, k in TABLES.items():
        rows = f"SELECT * FROM '{SF}/{t}.parquet' WHERE {k} < 160"
        again = f"SELECT * REPLACE ({k} - 80 + {PER_TILE * TILES_PER_SHEET} AS {k}) FROM '{SF}/{t}.parquet' WHERE {k} BETWEEN 80 AND 239"
        con.execute(f"COPY ({rows} UNION ALL {again}) TO '{at}/{t}.parquet' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{at}/{t}.parquet'")
    con.execute(f"CREATE VIEW part AS SELECT * FROM '{at}/part.parquet'")
    return str(at), con


@pytest.mark.parametrize("name", NAMES)
def test_sheets_are_apart(spark, folded, name):
    at, con = folded
    made = registry.queries()[name](spark, at)
    cols = sorted(made.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in made.collect()), key=str)
    asked = con.execute(registry.oracle_sql()[name])
    names = [d[0] for d in asked.description]
    want = sorted((tuple(plain(row[names.index(c)]) for c in cols) for row in asked.fetchall()), key=str)
    assert got == want
