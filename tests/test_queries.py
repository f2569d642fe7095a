"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from oracle_compare import compare, duck
from pulseline.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, SF, name, E.queries()[name], E.oracle_sql().get(name), con)
    assert res["status"] in ("match", "rows-only"), res


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql()) and set(QUERIES) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["session_id", "window_start", "window_end", "avg_vst_ms", "pfr",
                          "rebuffering_ratio", "event_count"]
    assert df.count() > 0
