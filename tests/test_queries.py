"""Every query of the library against its SQL in DuckDB, on the smallest tables."""

import math

import duckdb
import pytest

from rinkflow import catalog
from rinkflow.plans.adapters import TABLES, oracle


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    c.execute("set enable_progress_bar=false")
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return c


def _canon(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v


def _rows(rows, order):
    out = [tuple(_canon(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), 0 if x is None else x) for x in r))


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_sql(spark, sf_dir, con, name):
    df = catalog.QUERIES[name](spark, sf_dir)
    names = sorted(df.columns)
    cursor = con.execute(catalog.ORACLE_SQL[name])
    columns = [d[0] for d in cursor.description]
    assert names == sorted(columns)
    want = _rows(cursor.fetchall(), [columns.index(c) for c in names])
    got = _rows([tuple(r) for r in df.collect()], [df.columns.index(c) for c in names])
    assert got == want


@pytest.mark.parametrize("condition", [
    "select count(*) from v_known_ends where team1_score_this_end = 'X'",
    "select count(*) from v_shots s where not exists (select 1 from v_known_ends e where e.okey = s.okey)",
    "select count(*) from v_known where stone_id is null",
    "select count(*) from v_known where is_shot_stone = 1",
    "select count(*) from v_ghosts where x is null",
    "select count(*) from v_events where year is null",
    "select count(*) from v_pages where text like '%no end here%'",
    "select count(*) from v_shots where accuracy = ''",
    "select count(*) from v_places where gone = 1",
])
def test_views_reach_the_branches(con, condition):
    assert con.execute(oracle(condition)).fetchall()[0][0] > 0


def test_match_images_moves_no_stones(spark, sf_dir):
    plan = catalog.QUERIES["match_images"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(event_id") == 1  # of what the images show; stones lie by order
