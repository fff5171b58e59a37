"""All registered queries against their SQL, and the plans they get."""

import os

import pytest

from panelspark.operators import quality, ranking
from panelspark.session import shared_dir
from panelspark.suite import ORACLES, QUERIES
from panelspark.suite.registry import table

from oracle import compare, connect

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ROWS_ONLY = set()


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


def plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_every_query_has_sql():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_sql_without_cross_join(spark, connection, name):
    df = QUERIES[name](spark, SF)
    state, detail = compare(df, connection, ORACLES.get(name))
    assert state != "FAIL", detail
    text = plan(df)
    assert "CartesianProduct" not in text and "BatchEvalPython" not in text
    assert "BroadcastNestedLoopJoin" not in text, text


def test_pushdown(spark):
    text = plan(QUERIES["facet_filter"](spark, SF))
    assert "l_linestatus" not in text.split("ReadSchema")[1]
    text = plan(QUERIES["column_values"](spark, SF))
    assert "PushedFilters: [IsNotNull(p_size), GreaterThan(p_size,10)]" in text
    assert "ReadSchema: struct<p_brand:string,p_size:int>" in text


def test_deduplicate_limits_groups_before_the_shuffle(spark):
    text = plan(QUERIES["deduplicate"](spark, SF))
    assert text.count("WindowGroupLimit") >= 2


def test_a_group_without_keys_is_never_gathered(spark):
    """Only the edges of the ranges may meet in one task."""
    values = table(spark, SF, "events").select("event_id")
    text = plan(ranking.value_neighbours(values, [], "event_id"))
    gathered = [p for p in text.split("\n\n") if "SinglePartition" in p]
    assert len(gathered) == 1 and "__range" in gathered[0] and "event_id" not in gathered[0]
    text = plan(quality.sequential_values(values, "event_id"))
    assert text.count("SinglePartition") == 1


def test_shared_folder_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_the_lines_are_read_once(spark):
    """Plans that need the panel twice store it; what is left to run reads no line."""
    for name in ("wide_panel", "specialist_panel", "zscore_features", "quadrants", "quadrants_median", "facet_values",
                 "peer_percentiles"):
        text = plan(QUERIES[name](spark, SF))
        assert "lineitem" not in text, name
