"""Every registered query against its oracle, and the shape of its plan."""

import contextlib
import io

import pytest

import __spark_entry__ as entry
from leadrank import oracles, queries
from leadrank.compare import differences, duckdb_views

QUERIES = queries.all_queries()
ORACLES = oracles.all_oracles()
# Iterative, and tested against a dense decomposition.
ROWS_ONLY = {"d1_latent_embed", "l2_latent_rank", "l4_latent_sector"}


@pytest.fixture(scope="module")
def con(sf):
    return duckdb_views(sf)


def plan_text(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_only_the_known_queries_lack_an_oracle():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    plan = plan_text(df)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert node not in plan
    ours = df.toPandas()
    assert len(ours) > 0
    if name in ORACLES:
        assert differences(ours, con.execute(ORACLES[name]).df()) == ""


def test_the_entry_registers_them():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.columns == ["vec_id", "keyword_score", "sector_score", "score", "rank"]
    assert rows.count() == 500
